"""Token-id files: per-document zstandard frames with a shared dictionary and an offset index.

A file set is a folder on any store that Spark writes to:

``dictionary``  one row: the zstandard dictionary and its sha256.
``blocks``      rows in ascending doc_id order, (shard, block) being the order.
                A block holds up to ``BLOCK_DOCS`` documents: their ids, token
                counts, the offsets of their frames (one more than documents)
                and the frames themselves, one after another. Every frame
                decompresses on its own with the dictionary.
``index``       per block: its document range and the number of ids before it.

Parquet carries the byte blocks, so Spark's commit protocol makes a retried
task's output appear exactly once. A short document is read by its offsets:
only its own frame is decompressed (:func:`lookup`).

The dictionary is trained on the serialized ids of a bounded sample (the
``sample_docs`` documents with the smallest hash of their id; of each, at most
``SAMPLE_BYTES`` bytes at an offset given by the hash). All documents are then
encoded in one pass behind one range shuffle on doc_id and a hash of the text,
so rows that share an id, or have none, are spread over many tasks.

Texts are encoded with the tokenizers library. The vocabulary's normaliser
turns every white space into a token boundary and composes no character across
one, so a text's ids are those of its blank-separated parts one after another
(and a part's those of its word and of the stops behind it); each worker keeps
the ids of parts it has met in a bounded table.

Defined results: null and empty texts have the end id alone; null doc_ids come
first; rows that share a doc_id are ordered by a hash of their text; equal rows
are all written; too small a sample gives a raw-content dictionary; extra
columns are ignored; no rows give empty tables.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollbook.llm.common import Remembered, scratch, ship

BLOCK_DOCS = 1024
BLOCK_BYTES = 4_000_000
SAMPLE_BYTES = 16_384
#: Bytes of a generation of encoded parts that a worker keeps.
_CACHE_LIMIT = 128 << 20
_BLOCKS = ("shard int, block int, dict_hash string, first_doc bigint, last_doc bigint, block_tokens bigint, "
           "doc_ids array<bigint>, n_tokens array<bigint>, offsets array<bigint>, frames binary")


#: Stops behind a word of plain letters: letters and stops never share a token of the vocabulary's pattern.
_STOPS = re.compile(rb"[.,](?<=[a-z][.,])[.,]*(?=[\x20\x09-\x0D]|\Z)")


class PartEncoder:
    """Whole texts to little-endian unsigned 32-bit ids, by their blank-separated parts."""

    _loaded: dict[str, PartEncoder] = {}

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        #: ids that end a word
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True
        self.known = Remembered(_CACHE_LIMIT)

    @classmethod
    def load(cls, path: str) -> PartEncoder:
        """The worker's encoder: loaded once, its table warm for the next task."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __call__(self, texts: list[str | bytes]) -> list[bytes]:
        known = self.known
        raw = [t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass") for t in texts]
        # bytes: only \x20 and \x09-\x0D split, only A-Z fold (the vocabulary folds case itself; a text with the
        # mark of a special token is left as it is, since those are matched before folding)
        parts = [(r if b"<|" in r else _STOPS.sub(rb" \g<0>", r.lower())).split() for r in raw]
        made = {p: self._stem(p) for p in known.missing(set().union(*parts))}
        units = known.missing({u for pair in made.values() for u in pair}, same_batch=True)
        for k in range(0, len(units), 16384):
            self._encode(units[k:k + 16384])
        for p, (stem, tail) in made.items():
            known[p] = known[stem] + known[tail] if tail else known[stem]
        return [b"".join(map(known.__getitem__, ps)) for ps in parts]

    @staticmethod
    def _stem(part: bytes) -> tuple[bytes, ...]:
        """A word and the stops behind it: letters and stops never share a token of the vocabulary's pattern."""
        stem = part.rstrip(b".,")
        # a letter that stays one when folded: that of U+0130 ends in a mark, which would join the stops
        if len(stem) < len(part) and stem and stem.decode("utf-8", "replace")[-1].lower().isalpha():
            return stem, part[len(stem):]
        return part, b""

    def _encode(self, units: list[bytes]) -> None:
        """Ids of separate units in one call; where each is one word of the vocabulary's pattern, its last id is marked
        as a word's end, for the others word_ids tell which unit an id belongs to."""
        words, others = [], []
        for unit in units:
            text = unit.decode("utf-8", "replace")
            plain = unit.isalpha() or (text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text))
            (words if plain else others).append((unit, text))
        if words:
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join([t for _, t in words])], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(words) and ends[-1] == len(ids):
                raw, ends = ids.tobytes(), (4 * ends).tolist()
                self.known.update(zip([u for u, _ in words], [raw[a:b] for a, b in zip([0, *ends], ends)]))
            else:
                others += words
        if not others:
            return
        got = self.tokenizer.encode([t for _, t in others], is_pretokenized=True, add_special_tokens=False)
        cut = np.searchsorted(np.array(got.word_ids, np.int64), np.arange(len(others) + 1)) * 4
        ids, cut = np.array(got.ids, "<u4").tobytes(), cut.tolist()
        for (unit, _), start, end in zip(others, cut, cut[1:]):
            self.known[unit] = ids[start:end]


def _serial() -> None:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task


def train_dictionary(docs: DataFrame, tokenizer: str, sample_docs: int = 400, size: int = 65_536) -> bytes:
    """A zstandard dictionary (bytes) from the bounded sample."""
    import zstandard

    ship(docs.sparkSession)
    key = F.xxhash64(F.col("doc_id").cast("string"), F.lit("dictionary"))
    sample = docs.select(key.alias("k"), "text").orderBy("k", F.xxhash64("text")).limit(sample_docs)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _serial()
        encoder = PartEncoder.load(tokenizer)
        for pdf in batches:
            ids = encoder([t if isinstance(t, str) else "" for t in pdf["text"]])
            cut = []
            for k, b in zip(pdf["k"], ids):
                room = max(0, len(b) - SAMPLE_BYTES) // 4
                start = 4 * (int(k) % (room + 1))
                cut.append(b[start:start + SAMPLE_BYTES])
            yield pd.DataFrame({"k": pdf["k"], "ids": cut})

    got = sample.mapInPandas(encode, "k bigint, ids binary").toPandas()
    samples = sorted(bytes(b) for b in got["ids"] if len(b))
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few or too small samples
        return b"".join(samples)[:size]


def _dictionary(raw: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(raw) if raw else None


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, level: int = 3,
                      sample_docs: int = 400) -> str:
    """Write the file set of ``docs`` (doc_id, text) to ``path`` (a folder that does not exist yet)."""
    spark = docs.sparkSession
    raw = train_dictionary(docs, tokenizer, sample_docs)
    digest = hashlib.sha256(raw).hexdigest()
    spark.createDataFrame([(digest, bytearray(raw))], "dict_hash string, content binary").coalesce(1).write.parquet(
        f"{path}/dictionary")
    shared = spark.sparkContext.broadcast(raw)
    end = np.array([end_id], dtype="<u4").tobytes()

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        from pyspark import TaskContext

        _serial()
        shard, number = TaskContext.get().partitionId(), 0
        encoder, compress = PartEncoder.load(tokenizer), zstandard.ZstdCompressor(level, _dictionary(shared.value)).compress
        ids: list[int | None] = []
        counts: list[int] = []
        frames: list[bytes] = []

        def flush() -> pd.DataFrame:
            nonlocal number
            known = [i for i in ids if i is not None]
            out = pd.DataFrame({
                "shard": [shard], "block": [number], "dict_hash": [digest],
                "first_doc": pd.Series([known[0] if known else None], dtype="Int64"),
                "last_doc": pd.Series([known[-1] if known else None], dtype="Int64"),
                "block_tokens": [sum(counts)], "doc_ids": [list(ids)], "n_tokens": [list(counts)],
                "offsets": [[0, *np.cumsum([len(f) for f in frames]).tolist()]], "frames": [b"".join(frames)]})
            number += 1
            ids.clear(), counts.clear(), frames.clear()
            return out

        held = 0
        for pdf in batches:
            keys = pdf["doc_id"].astype("Int64")
            for k in range(0, len(pdf), 1024):
                texts = [b"" if t is None else bytes(t) for t in pdf["text"].iloc[k:k + 1024]]
                for key, got in zip(keys.iloc[k:k + 1024], encoder(texts)):
                    got += end
                    ids.append(None if key is pd.NA else int(key))
                    counts.append(len(got) // 4)
                    frames.append(compress(got))
                    held += len(frames[-1])
                    if len(ids) >= BLOCK_DOCS or held >= BLOCK_BYTES:
                        yield flush()
                        held = 0
        if ids:
            yield flush()

    ordered = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
               .repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text")))
    ordered.mapInPandas(blocks, _BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")
    # starts: prefix sums over shards (one row per shard), then within each shard
    sizes = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks").select(
        "shard", "block", "first_doc", "last_doc", "block_tokens")
    shards = sizes.groupBy("shard").agg(F.sum("block_tokens").alias("_all"))
    before = F.sum("_all").over(Window.orderBy("shard")) - F.col("_all")
    shards = shards.select("shard", before.alias("_before"))
    inner = F.sum("block_tokens").over(Window.partitionBy("shard").orderBy("block")) - F.col("block_tokens")
    index = sizes.join(shards, "shard").withColumn("start", F.col("_before") + inner).drop("_before")
    index.write.parquet(f"{path}/index")
    return path


def _frames(raw: bytes, digest: str):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        decompress = zstandard.ZstdDecompressor(_dictionary(raw)).decompress
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                if row.dict_hash != digest:
                    raise ValueError(f"block {row.shard}/{row.block} was written with another dictionary")
                at, counts = row.offsets, np.asarray(row.n_tokens, np.int64)
                starts = row.start + np.cumsum(counts) - counts
                wanted = getattr(row, "wanted", None)
                ids = pd.Series(list(row.doc_ids), dtype="object").astype("Int64")
                pick = range(len(counts)) if wanted is None else [
                    i for i in range(len(counts)) if ids[i] is not pd.NA and int(ids[i]) in set(wanted)]
                for k in range(0, len(pick), 256):
                    some = list(pick[k:k + 256])
                    yield pd.DataFrame({"doc_id": ids.iloc[some].to_numpy(dtype=object, na_value=None),
                                        "start": starts[some], "n_tokens": counts[some],
                                        "ids": [decompress(row.frames[at[i]:at[i + 1]]) for i in some]})

    return read


_DOCS = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


def _opened(spark: SparkSession, path: str):
    ship(spark)
    row = spark.read.parquet(f"{path}/dictionary").first()
    index = spark.read.parquet(f"{path}/index").select("shard", "block", "start")
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks").join(index, ["shard", "block"])
    return blocks, _frames(bytes(row["content"]), row["dict_hash"])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Every document: doc_id, start (ids before it), n_tokens, ids (with the end id)."""
    blocks, read = _opened(spark, path)
    return blocks.mapInPandas(read, _DOCS)


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """A few documents by id: only blocks whose range holds one are read, only their frames decompressed.

    Rows without an id have no id to be looked up by; ``read_token_files`` gives them."""
    blocks, read = _opened(spark, path)
    ids = [int(i) for i in doc_ids]
    inside = F.lit(False)
    for i in ids:
        inside = inside | ((F.col("first_doc") <= i) & (F.col("last_doc") >= i))
    return blocks.filter(inside).withColumn("wanted", F.array(*(F.lit(i).cast("bigint") for i in ids))
                                            ).mapInPandas(read, _DOCS)


def token_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write ``docs`` as token files and read them back: doc_id, start, n_tokens, ids_crc32."""
    path = write_token_files(docs, scratch(docs.sparkSession, "token-files"), tokenizer)
    return read_token_files(docs.sparkSession, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
