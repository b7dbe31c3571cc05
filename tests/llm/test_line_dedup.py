"""Line dedup against a brute-force version, the perfect hash by itself, and odd input."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollbook.llm import line_dedup
from rollbook.llm.common import materialise
from tests.llm.test_operators import ODD, ODD_SCHEMA, SMALL

BLANKS = " \t\n\r\x0b\x0c"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(rows, min_chars=20, least=3):
    """Sorted (doc_id, n_lines, n_dropped, text) with ids ordered null first."""
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= min_chars:
                holders[key_of(line)].add((doc is not None, doc or 0))
    owner = {k: max(v) for k, v in holders.items() if len(v) >= least}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        stay = [line for line in lines if owner.get(key_of(line), (doc is not None, doc or 0)) == (doc is not None, doc or 0)]
        out.append((doc, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def result(df, **options):
    out = line_dedup.dedup_lines(df, ["doc_id"], **options)
    return sorted(map(tuple, out.collect()), key=str)


SENTENCE = "A sentence that many documents share"


def test_perfect_hash_numbers_every_key_once():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 70_000):
        high, low = rng.integers(0, 1 << 63, (2, n)).astype(np.uint64)
        high[n // 2:] = 7  # equal halves: the other half must tell them apart
        made = line_dedup.PerfectHash.build(high, low)
        again = line_dedup.PerfectHash.unpack(*made.pack())
        assert sorted(again.index(high, low).tolist()) == list(range(n))
        assert sum(len(bits) for bits in made.levels) <= 4.5 * n + 2000  # bits a key
    with pytest.raises(ValueError):
        line_dedup.PerfectHash.build(np.array([1, 1], np.uint64), np.array([2, 2], np.uint64))


def test_lines_match_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows)
    assert sum(r[2] for r in want) > 0
    assert result(docs) == want
    assert result(docs, chunk_bytes=2000, shard_keys=64) == want  # many chunks, many shards
    assert result(docs, min_chars=5, least=2) == brute(rows, 5, 2)


def test_odd_rows_hot_lines_and_repeated_ids(spark):
    rows = [(r[0], r[1]) for r in ODD]
    rows += [(20 + i % 4, f"{'  ' * (i % 3)}{SENTENCE.upper() if i % 2 else SENTENCE}\t\nown line number {i:012d}\n") for i in range(200)]
    rows += [(None, SENTENCE), (None, SENTENCE), (-5, SENTENCE + "\r\n\n" + SENTENCE)]
    rows += [(30 + i, "ÀÉ çédille à vingt points" + ("" if i < 2 else "!")) for i in range(4)]  # twice each: stays
    rows += [(40 + i, "É" * 19 + " \nÉ" + "é" * 19) for i in range(3)]  # 19 and 20 code points
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert result(df) == brute(rows)
    assert result(df, chunk_bytes=300, shard_keys=16) == brute(rows)


def test_extra_columns_pass_and_empty_tables_give_no_rows(spark):
    df = spark.createDataFrame(ODD, ODD_SCHEMA).withColumn("chunk", F.lit(1)).withColumn("id", F.lit("z"))
    out = line_dedup.dedup_lines(df, ["doc_id", "score", "kept", "chunk", "id"])
    assert out.columns == ["doc_id", "score", "kept", "chunk", "id", "n_lines", "n_dropped", "text"]
    assert sorted((r.doc_id, r.score, r.id) for r in out.collect() if r.doc_id is not None) \
        == sorted((r[0], r[4], "z") for r in ODD if r[0] is not None)
    assert line_dedup.dedup_lines(df.limit(0), ["doc_id"]).count() == 0


def test_foreign_documents_probe_an_index(spark):
    known = spark.createDataFrame([(i, SENTENCE) for i in range(3)], "doc_id bigint, text string")
    chunks = line_dedup.write_chunks(known, ["doc_id"], 20, 3)
    index, bits = line_dedup.build_index(chunks, 3)
    other = line_dedup.write_chunks(spark.createDataFrame([(9, SENTENCE + "\nnever seen in the indexed documents")],
                                                          "doc_id bigint, text string"), ["doc_id"], 20, 3)
    got = materialise(line_dedup.probe(other, index, bits, 3), "answers").collect()
    assert len(got) == 1 and np.frombuffer(got[0].ids, np.int64).tolist() == [2]
