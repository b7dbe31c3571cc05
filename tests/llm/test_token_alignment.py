"""Token alignment against whole-text encoding and plain loops, the divide and conquer by itself, and odd input."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from rollbook.llm import token_alignment
from rollbook.llm.queries import QUERIES
from tests.llm.test_operators import ODD, ODD_SCHEMA, SMALL

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def letters():
    """The byte of each letter of byte-level BPE, as its authors' description has it."""
    from tokenizers.pre_tokenizers import ByteLevel

    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table, extra = {chr(b): b for b in own}, 0
    for b in range(256):
        if b not in own:
            table[chr(256 + extra)] = b
            extra += 1
    assert set(table) == set(ByteLevel.alphabet())
    return table


def brute(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    byte_of, groups = letters(), []
    for _, text in rows:
        got = []
        if text:
            a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            a_bytes = [bytes(byte_of[c] for c in a.id_to_token(k)) for k in a_ids]
            pieces = [b.id_to_piece(k) for k in b_ids]
            b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode() for k, p in zip(b_ids, pieces)]
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                i = j = at = to = 0
                left, right = [], []
                while i < len(a_ids) or j < len(b_ids):
                    if at <= to and i < len(a_ids):
                        at, i = at + len(a_bytes[i]), i + 1
                        left.append(a_ids[i - 1])
                    else:
                        to, j = to + len(b_bytes[j]), j + 1
                        right.append(b_ids[j - 1])
                    if at == to:
                        got.append((left, right))
                        left, right = [], []
        groups.append(got)
    held = Counter()
    for got in groups:
        held.update({(x, y) for left, right in got for x in left for y in right})
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for (doc, _), got in zip(rows, groups):
        links = [(x, y) for left, right in got for x in left for y in right]
        text = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in got)
        out.append((doc, sum(len(g[0]) for g in got), sum(len(g[1]) for g in got), len(got), len(links),
                    sum(held[x] == top[x[0]] for x in links), sum(held[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest() if got else ""))
    return sorted(out, key=str)


def result(df, **options):
    return sorted(map(tuple, token_alignment.align_tokens(df, *PATHS, ["doc_id"], **options).collect()), key=str)


@pytest.mark.parametrize("seed", range(6))
def test_shared_cuts_are_all_common_ends(seed):
    rng = random.Random(seed)
    for _ in range(60):
        n = rng.choice((1, 2, 5, 40, 400))
        a = sorted({n, *rng.sample(range(1, n + 1), rng.randint(0, n))})
        b = sorted({n, *rng.sample(range(1, n + 1), rng.randint(0, n))})
        i, j = token_alignment.shared_cuts(np.array(a), np.array(b))
        assert [a[k - 1] for k in i] == [b[k - 1] for k in j] == sorted(set(a) & set(b))


def test_places_come_back():
    for places in ([], [0], [0xFFFF], [1, 0xFFFF, 2, 0xFFFE, 70_000, 0x3FFFF], [65_535] * 50, list(range(100_000))):
        p = np.array(places, np.int64)
        blob = np.minimum(p, 0xFFFF).astype(np.uint16).tobytes() + p[p >= 0xFFFF].astype(np.uint32).tobytes()
        assert token_alignment._places(blob).tolist() == places


def test_whole_table_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted(map(tuple, QUERIES["op12_token_alignment"](spark, SMALL).collect()), key=str) == want
    assert result(docs, chunk_bytes=20_000, shard_pairs=500, most_shards=7) == want  # many chunks, shards and salts


def test_odd_texts_and_repeated_rows(spark):
    odd = ["▁ u", "a▁b c", "x  y   z", " lead and trail ", "tab\tnew\nline \n end", "<|endoftext|> <s> </s> <unk> <0x41>", "\x00 nul",
           "mid hard thin　wide x\x1cy z", "é́ combining ﬁ ligature ½", "\U0001F600" * 40 + " face 梦梦", "don't we'll I'm 've",
           "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa " * 3, "0123456789" * 30, "=" * 100 + " - " + "-" * 77, " ", "\n", "x"]
    rows = [(r[0], r[1]) for r in ODD if r[0] != 7] + [(100 + k, t) for k, t in enumerate(odd)] + [(100, "▁ u"), (104, odd[4]), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert result(df) == brute(rows)
    assert result(df, chunk_bytes=100) == brute(rows)


def test_extra_columns_and_empty_tables(spark):
    df = spark.createDataFrame(ODD, ODD_SCHEMA).withColumns({"chunk": F.lit(1), "kind": F.lit("x"), "n_a": F.lit(2)})
    out = token_alignment.align_tokens(df.drop("n_a"), *PATHS, ["doc_id", "score", "chunk", "kind"])
    assert out.columns[:4] == ["doc_id", "score", "chunk", "kind"] and out.filter("kind = 'x'").count() == len(ODD)
    assert token_alignment.align_tokens(df.limit(0), *PATHS, ["doc_id"]).count() == 0
