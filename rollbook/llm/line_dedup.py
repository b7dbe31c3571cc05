"""Line dedup: lines of many documents stay in one of them, by a sharded minimal perfect hash.

A line's key is the line with blanks stripped at both ends and ASCII letters
folded; keys of fewer than ``min_chars`` code points are never dropped. A key
found in ``least`` documents or more keeps its lines only in the document with
the largest id that holds it.

1. One pass writes the documents as chunks of about ``CHUNK_BYTES`` of text, and
   per chunk its distinct keys as 128-bit hashes with the ``least`` largest ids of
   the chunk's documents that hold them. Those ids merge exactly, so a line of
   a third of all documents is a few entries a chunk.
2. The hashes are dealt to shards by their leading bits, about ``SHARD_KEYS`` to a
   shard whatever the input. A shard's distinct hashes get a minimal perfect
   hash (levels of bits: a key rests at the first level where it is alone in its
   place, its number is the rank of its bit). The number indexes three arrays:
   16-bit fingerprints, counts up to ``least``, and the largest id.
3. Chunks probe the shards' arrays; one shard is in memory at a time and probes
   stream past it. Only keys to drop are answered, once per chunk.
4. A chunk's documents, streaming behind its answers, lose their lines.

No line text is shuffled for the comparison, none is joined, and nothing is collected on
the driver but the number of hashes, which sets the number of shards.

Defined results: null and empty texts are one empty line and come out empty;
rows with the same id are one document (all of them keep a line or none);
a null id is the smallest (as the id -2**63); ties cannot occur, ids being
compared; extra columns are passed on if named in ``keep``; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from rollbook.llm.common import dealt, materialise, nullable, scratch, ship

CHUNK_BYTES = 8 << 20
SHARD_KEYS = 1 << 17
NO_ID = -1 << 63
#: Odd factors that spread hashes over the places of a level.
_STEP, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys given as two halves.

    ``index`` gives each key of the set its own number below the set's size. A
    key outside the set may get any number, or -1; compare a fingerprint.
    """

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        ends = np.cumsum([np.count_nonzero(bits) for bits in levels])
        self.ranks = [np.cumsum(bits, dtype=np.int64) + before - 1 for bits, before in zip(levels, [0, *ends])]

    @staticmethod
    def _places(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = high * _SPREAD ^ low * (_STEP * np.uint64(2 * level + 1))
            x ^= x >> np.uint64(32)
            x *= _SPREAD
            x ^= x >> np.uint64(29)
        return (x % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        levels = []
        while len(high):
            if len(levels) > 200:
                raise ValueError("keys are not distinct")
            size = max(64, 2 * len(high))
            places = cls._places(high, low, len(levels), size)
            alone = np.bincount(places, minlength=size) == 1
            levels.append(alone)
            rest = ~alone[places]
            high, low = high[rest], low[rest]
        return cls(levels)

    def index(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        out, todo = np.full(len(high), -1, np.int64), np.arange(len(high))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            if not len(todo):
                break
            places = self._places(high[todo], low[todo], level, len(bits))
            hit = bits[places]
            out[todo[hit]] = ranks[places[hit]]
            todo = todo[~hit]
        return out

    def pack(self) -> tuple[bytes, bytes]:
        sizes = np.array([len(bits) for bits in self.levels], np.int64)
        return sizes.tobytes(), b"".join(np.packbits(bits).tobytes() for bits in self.levels)

    @classmethod
    def unpack(cls, sizes: bytes, packed: bytes) -> PerfectHash:
        levels, at, data = [], 0, np.frombuffer(packed, np.uint8)
        for size in np.frombuffer(sizes, np.int64).tolist():
            width = -(-size // 8)
            levels.append(np.unpackbits(data[at:at + width], count=size).astype(bool))
            at += width
        return cls(levels)


def _fingerprints(low: np.ndarray) -> np.ndarray:
    return (low >> np.uint64(48)).astype(np.uint16)


def _largest(high: np.ndarray, low: np.ndarray, ids: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries in order of key and falling id, with the ``least`` largest distinct ids of each key."""
    order = np.lexsort((~ids, low, high))
    high, low, ids = high[order], low[order], ids[order]
    first = np.ones(len(ids), bool)
    first[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    new = first.copy()
    new[1:] |= ids[1:] != ids[:-1]
    high, low, ids, first = high[new], low[new], ids[new], first[new]
    start = np.flatnonzero(first)
    place = np.arange(len(ids)) - np.repeat(start, np.diff([*start, len(ids)]))
    near = place < least
    return high[near], low[near], ids[near]


def _starts(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    first = np.ones(len(high), bool)
    first[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    return np.flatnonzero(first)


def _hashes(text: bytes, min_chars: int) -> list[bytes | None]:
    """A 128-bit hash per line; None for lines that are too short to count."""
    import xxhash

    out = []
    for line in text.split(b"\n"):
        key = line.strip().lower()  # bytes: exactly the six blanks, and A-Z only
        n = len(key)
        if n >= min_chars and (n >= 4 * min_chars or key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars):
            out.append(xxhash.xxh3_128_digest(key))
        else:
            out.append(None)
    return out


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), ">u8").astype(np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


_ENTRIES = "high binary, low binary, ids binary"


def _chunks(schema: pa.Schema, min_chars: int, least: int, chunk_bytes: int):
    """Documents with the number of their chunk, and after each chunk a row of its entries (``entries`` true)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        digests, owners, filled = [], [], 0

        def entries() -> pa.RecordBatch:
            arrays = _largest(*_halves(digests), np.array(owners, np.int64), least)
            made = {"chunk": [chunk], "entries": [True], **{k: [v.tobytes()] for k, v in zip(("high", "low", "ids"), arrays)}}
            return pa.RecordBatch.from_arrays([pa.array(made.get(f.name, [None]), f.type) for f in schema], schema=schema)

        for batch in batches:
            numbers = []
            done = 0
            ids, texts = batch.column("id").to_pylist(), batch.column("text").cast(pa.binary())

            def rows(upto: int) -> pa.RecordBatch:
                part = batch.slice(done, upto - done)
                made = {"chunk": pa.array(numbers, pa.int64()), "entries": pa.array([False] * len(numbers))}
                return pa.RecordBatch.from_arrays(
                    [part.column(f.name) if f.name in part.schema.names else made.get(f.name, pa.nulls(part.num_rows, f.type))
                     for f in schema], schema=schema)

            for k, (doc, text) in enumerate(zip(ids, texts)):
                text = text.as_py() or b""
                found = {d for d in _hashes(text, min_chars) if d is not None}
                digests += found
                owners += [NO_ID if doc is None else doc] * len(found)
                filled += len(text) + 64
                numbers.append(chunk)
                if filled >= chunk_bytes:
                    yield rows(k + 1)
                    done, numbers = k + 1, []
                    if digests:
                        yield entries()
                    chunk, digests, owners, filled = chunk + 1, [], [], 0
            if numbers:
                yield rows(len(ids))
        if digests:
            yield entries()

    return run


def write_chunks(docs: DataFrame, keep: list[str], min_chars: int, least: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, entries, id, text, rest, high, low, ids): the documents and the entries of their chunks, written once."""
    spark = docs.sparkSession
    ship(spark)
    rest = F.struct(*[F.col(c).alias(f"c{k}") for k, c in enumerate(keep)]) if keep else F.lit(None).cast("struct<c0:int>")
    given = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text"), rest.alias("rest"))
    shape = given.selectExpr("cast(0 AS bigint) AS chunk", "false AS entries", "id", "text", "rest",
                             "cast(NULL AS binary) AS high", "cast(NULL AS binary) AS low", "cast(NULL AS binary) AS ids")
    path = scratch(spark, "lines")
    made = nullable(shape.schema)
    out = given.mapInArrow(_chunks(to_arrow_schema(made), min_chars, least, chunk_bytes), made)
    out.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(made).parquet(path)


def _to_shards(bits: int, distinct: bool):
    """Entries cut by the leading ``bits`` of the hash; ``distinct``: without ids, a key once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                high, low, ids = (np.frombuffer(row[c], t) for c, t in (("high", np.uint64), ("low", np.uint64), ("ids", np.int64)))
                if distinct:
                    at = _starts(high, low)
                    high, low, ids = high[at], low[at], ids[:0]
                shard = (high >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(high), np.int64)
                found, first = np.unique(shard, return_index=True)
                ends = [*first[1:].tolist(), len(high)]
                cut = [slice(a, b) for a, b in zip(first.tolist(), ends)]
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array(found, pa.int64()), "chunk": pa.array([row["chunk"]] * len(found), pa.int64()),
                    **{k: pa.array([v[c].tobytes() for c in cut], pa.binary()) for k, v in (("high", high), ("low", low), ("ids", ids))}})

    return run


_INDEX = "shard bigint, size bigint, sizes binary, bits binary, fingerprints binary, counts binary, owners binary"


def _build(least: int):
    def index(shard: int, parts: list[dict]) -> pa.RecordBatch:
        high, low, ids = (np.concatenate([np.frombuffer(p[c], t) for p in parts])
                          for c, t in (("high", np.uint64), ("low", np.uint64), ("ids", np.int64)))
        high, low, ids = _largest(high, low, ids, least)
        at = _starts(high, low)
        counts, owners = np.diff([*at, len(ids)]), ids[at]
        high, low = high[at], low[at]
        perfect = PerfectHash.build(high, low)
        number = perfect.index(high, low)
        arrays = {"fingerprints": _fingerprints(low), "counts": counts.astype(np.uint32), "owners": owners}
        for name, values in arrays.items():
            placed = np.empty_like(values)
            placed[number] = values
            arrays[name] = placed
        if least < 256:
            arrays["counts"] = arrays["counts"].astype(np.uint8)
        sizes, bits = perfect.pack()
        made = {"shard": shard, "size": len(at), "sizes": sizes, "bits": bits, **{k: v.tobytes() for k, v in arrays.items()}}
        return pa.RecordBatch.from_pylist([made], schema=pa.schema(
            [("shard", pa.int64()), ("size", pa.int64()), *[(c, pa.binary()) for c in ("sizes", "bits", "fingerprints", "counts", "owners")]]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != now and parts:
                    yield index(now, parts)
                    parts = []
                now = row["shard"]
                parts.append(row)
        if parts:
            yield index(now, parts)

    return run


class Shard:
    """The arrays of one shard."""

    def __init__(self, row: dict, least: int) -> None:
        self.hash = PerfectHash.unpack(row["sizes"], row["bits"])
        self.fingerprints = np.frombuffer(row["fingerprints"], np.uint16)
        self.counts = np.frombuffer(row["counts"], np.uint8 if least < 256 else np.uint32)
        self.owners = np.frombuffer(row["owners"], np.int64)

    def probe(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, owner) of each key; a key that the index does not hold has count 0, but for one in 65,536."""
        number = self.hash.index(high, low)
        known = number >= 0
        known[known] = self.fingerprints[number[known]] == _fingerprints(low[known])
        counts, owners = np.zeros(len(high), np.int64), np.full(len(high), NO_ID)
        counts[known], owners[known] = self.counts[number[known]], self.owners[number[known]]
        return counts, owners


def build_index(chunks: DataFrame, least: int, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """The index, a row per shard, written to the shared folder; and the number of leading bits that name a shard."""
    entries = chunks.filter("entries").select("chunk", "high", "low", "ids")
    total = entries.agg(F.sum(F.octet_length("high"))).first()[0] or 0
    bits = max(0, (-(-total // (8 * shard_keys)) - 1).bit_length()) if total else 0
    parts = entries.mapInArrow(_to_shards(bits, False), f"shard bigint, chunk bigint, {_ENTRIES}")
    return materialise(dealt(parts, "shard").mapInArrow(_build(least), _INDEX), "line-index"), bits


def probe(chunks: DataFrame, index: DataFrame, bits: int, least: int) -> DataFrame:
    """(chunk, high, low, ids): per chunk and shard the keys of ``least`` documents or more, with their largest id."""
    keys = (chunks.filter("entries").select("chunk", "high", "low", "ids")
            .mapInArrow(_to_shards(bits, True), f"shard bigint, chunk bigint, {_ENTRIES}").drop("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["chunk"] is None:
                    shard = Shard(row, least)
                    continue
                high, low = np.frombuffer(row["high"], np.uint64), np.frombuffer(row["low"], np.uint64)
                counts, owners = shard.probe(high, low)
                many = counts >= least
                if many.any():
                    out.append({"chunk": row["chunk"], "high": high[many].tobytes(), "low": low[many].tobytes(), "ids": owners[many].tobytes()})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                    [("chunk", pa.int64()), ("high", pa.binary()), ("low", pa.binary()), ("ids", pa.binary())]))

    both = index.unionByName(keys, allowMissingColumns=True)
    return dealt(both, "shard", F.col("chunk").asc_nulls_first()).mapInArrow(run, f"chunk bigint, {_ENTRIES}")


def _drop(schema: pa.Schema, min_chars: int):
    """Documents without the lines that the answers before them name."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, drop = None, {}
        for batch in batches:
            made = {"n_lines": [], "n_dropped": [], "kept": []}
            texts, chunks, ids = batch.column("text").cast(pa.binary()), batch.column("chunk").to_pylist(), batch.column("id").to_pylist()
            answers, docs = batch.column("entries").to_pylist(), []
            for k, chunk in enumerate(chunks):
                if chunk != now:
                    now, drop = chunk, {}
                if answers[k]:
                    high, low = (np.frombuffer(batch.column(c)[k].as_py(), np.uint64) for c in ("high", "low"))
                    owners = np.frombuffer(batch.column("ids")[k].as_py(), np.int64)
                    both = np.stack([high, low], 1).astype(">u8").tobytes()
                    drop.update(zip((both[i:i + 16] for i in range(0, len(both), 16)), owners.tolist()))
                    continue
                docs.append(k)
                text, doc = texts[k].as_py() or b"", NO_ID if ids[k] is None else ids[k]
                n = text.count(b"\n") + 1
                kept = text
                if drop:
                    lines = text.split(b"\n")
                    stay = [line for line, h in zip(lines, _hashes(text, min_chars)) if h is None or drop.get(h, doc) == doc]
                    if len(stay) < n:
                        kept = b"\n".join(stay)
                    made["n_dropped"].append(n - len(stay))
                else:
                    made["n_dropped"].append(0)
                made["n_lines"].append(n)
                made["kept"].append(kept)
            if docs:
                rest = batch.column("rest").take(pa.array(docs))
                yield pa.RecordBatch.from_arrays([rest, *[pa.array(made[f.name], f.type) for f in list(schema)[1:]]], schema=schema)

    return run


def dedup_lines(docs: DataFrame, keep: list[str], min_chars: int = 20, least: int = 3,
                chunk_bytes: int = CHUNK_BYTES, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``keep`` columns of each document, n_lines (before), n_dropped, and text: the lines that stay.

    Reads ``doc_id`` and ``text``.
    """
    if min_chars < 1 or least < 1:
        raise ValueError("min_chars and least are 1 at least")
    spark: SparkSession = docs.sparkSession
    chunks = write_chunks(docs, keep, min_chars, least, chunk_bytes)
    index, bits = build_index(chunks, least, shard_keys)
    answers = probe(chunks, index, bits, least).withColumn("entries", F.lit(True))
    rows = chunks.filter("NOT entries").select("chunk", "entries", "id", "text", "rest")
    both = rows.unionByName(answers, allowMissingColumns=True)
    shape = chunks.selectExpr("rest", "0L AS n_lines", "0L AS n_dropped", "cast('' AS binary) AS kept")
    made = nullable(shape.schema)
    out = dealt(both, "chunk", F.desc("entries")).mapInArrow(_drop(to_arrow_schema(made), min_chars), made)
    return out.select(*[F.col(f"rest.c{k}").alias(c) for k, c in enumerate(keep)], "n_lines", "n_dropped",
                      F.col("kept").cast("string").alias("text"))
