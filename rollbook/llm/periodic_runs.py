"""Periodic runs of words, by tiles of one period octave each and boundary Z-functions.

A run is a stretch of consecutive words with smallest period q (words q apart
are the same) and a length of at least max(``MIN_LENGTH``, ``REPEATS`` * q) that no
neighbour extends. Its words after the first q are repeats and are dropped.

1. One pass numbers the words of whole texts and writes the documents. For the
   octave of periods [w, 2w), w = 1, 2, 4, ..., boundaries stand every 2w words.
   A run of the octave holds a boundary b where the w words at b stand again
   q words on, so the document is exploded into overlapping tiles of the octave
   (``_core`` words and 6w on either side) only where that is seen, and where the
   stretch holds for a run's length or 4w words on one side; equal blocks have equal
   hashes, so no run is lost, and what is no run falls later.
2. Tiles are dealt over all tasks by (document, octave, place) and solved by
   themselves: the Z-function to the right of a boundary and that of the
   reversed words to its left give, for each period, the stretch around the
   boundary, cut at 6w words. Periods that are multiples of a shorter one are left out.
3. Fragments are shuffled by (document, period) and stitched: fragments of one
   run overlap by q words or more, those of different runs of one period by
   fewer. Length decides; of equal stretches the shortest period stays.
4. The runs of a document (a bounded list: runs of one octave overlap little)
   meet the document's row by its number, which drops the repeats.

Tiles hold word numbers, never text, and a document of any length is spread
over as many tasks as it has tiles. Texts travel only for documents with tiles.

Defined results: null, empty and blank texts have no words and no runs; rows
with the same or no id are judged each; equal exponents are ordered by start,
then period; extra columns are passed on if named in ``keep``; no rows give none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rollbook.llm.common import nullable, scratch, ship

MIN_LENGTH, REPEATS = 6, 4
#: Words that are searched at once (a longer document is a batch by itself).
BATCH_WORDS = 1 << 18
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _core(octave: int) -> int:
    return max(8 << octave, 256)


class _Number(dict):
    def __missing__(self, word: bytes) -> int:
        got = self[word] = len(self)
        return got


def _is_power(words: np.ndarray, period: int) -> bool:
    """Whether the first ``period`` words are a shorter stretch repeated."""
    return any(np.array_equal(words[:period - d], words[d:period]) for d in _shorter(period))


def _shorter(period: int) -> list[int]:
    """The period divided by each of its prime factors: a power has one of these as a period."""
    out, rest, p = [], period, 2
    while p * p <= rest:
        if rest % p == 0:
            out.append(period // p)
            while rest % p == 0:
                rest //= p
        p += 1
    if rest > 1:
        out.append(period // rest)
    return out


def _reaches(words: np.ndarray, at: np.ndarray, period: np.ndarray, low: np.ndarray, high: np.ndarray, width: int) -> np.ndarray:
    """Whether the stretch of each boundary and period may be a run's length; looks 4 * ``width`` words to either side."""
    far, out = 4 * width, np.zeros(len(at), bool)
    block = max(1, (1 << 21) // far)
    for a in range(0, len(at), block):
        b, q, lo, hi = at[a:a + block, None], period[a:a + block, None], low[a:a + block, None], high[a:a + block, None]
        right, left = b + np.arange(far), b - 1 - np.arange(far)
        same = (right + q < hi) & (words[np.minimum(right, len(words) - 1)] == words[np.minimum(right + q, len(words) - 1)])
        r = np.where(same.all(1), far, same.argmin(1))
        same = (left >= lo) & (words[np.maximum(left, 0)] == words[np.maximum(left, 0) + q])
        n = np.where(same.all(1), far, same.argmin(1))
        q = q[:, 0]
        out[a:a + block] = (r == far) | (n == far) | (n + r + q >= np.maximum(MIN_LENGTH, REPEATS * q))
    return out


def boundaries(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(octave, boundaries) where a period of the octave may stand, over documents laid end to end."""
    longest = int((ends - starts).max()) if len(starts) else 0
    hashed = words.astype(np.uint64) * _FACTOR
    octave = 0
    while max(MIN_LENGTH, REPEATS << octave) <= longest:
        width, step = 1 << octave, 2 << octave
        if octave:
            half = width // 2
            with np.errstate(over="ignore"):
                hashed = hashed[:-half] * _FACTOR + hashed[half:]
                hashed = hashed ^ hashed >> np.uint64(31)
        full = np.zeros(-(-len(hashed) // step) * step, np.uint64)
        full[:len(hashed)] = hashed
        rows = full.reshape(-1, step)
        at, period = np.nonzero(rows[:, width:] == rows[:, :1])
        at, period = at * step, period + width
        doc = np.searchsorted(starts, at, side="right") - 1
        good = (at + period + width <= ends[doc]) & (ends[doc] - starts[doc] >= np.maximum(MIN_LENGTH, REPEATS * period))
        at, period, doc = at[good], period[good], doc[good]
        good = _reaches(words, at, period, starts[doc], ends[doc], width)
        at, period = at[good], period[good]
        if octave and len(at):
            places, first = np.unique(at, return_index=True)
            kept = []
            for place, a, b in zip(places.tolist(), first.tolist(), [*first[1:].tolist(), len(at)]):
                periods = period[a:b]
                if b - a > 1:  # many: the block itself is periodic; if its period holds throughout, all are multiples
                    d, reach = int(np.diff(periods).min()), int(periods[-1]) + width
                    if d < width and np.array_equal(words[place:place + reach - d], words[place + d:place + reach]):
                        continue
                    kept.append(place)
                elif not _is_power(words[place:place + int(periods[0])], int(periods[0])):
                    kept.append(place)
            at = np.array(kept, np.int64)
        if len(at):
            yield octave, np.unique(at)
        octave += 1


def _z(s: list[int], upto: int) -> list[int]:
    """Z-function: how far ``s`` and its rest from i agree, for i below ``upto``."""
    n, z, left, right = len(s), [0] * upto, 0, 0
    if upto:
        z[0] = n
    for i in range(1, upto):
        k = 0
        if i < right:
            k = z[i - left]
            if i + k < right:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[i + k] == s[k]:
            k += 1
        z[i], left, right = k, i, i + k
    return z


def solve_tile(words: list[int], octave: int, first: int, stop: int) -> list[tuple[int, int, int]]:
    """(period, start, end) of the stretches around the tile's boundaries first, first + 2w, ... below stop."""
    width, out = 1 << octave, []
    for b in range(first, stop, 2 * width):
        right = words[b:b + 6 * width]
        z = _z(right, min(len(right), 2 * width))
        periods = [q for q in range(width, len(z)) if z[q] >= width and not any(z[d] >= q - d for d in _shorter(q))]
        if not periods:
            continue
        far, low = periods[-1], max(0, b - 6 * width)
        back = words[low:b][::-1]
        zl = _z([*back, -1, *words[low:b + far][::-1]], len(back) + 2 + far - periods[0])
        for q in periods:
            start, end = b - zl[len(back) + 1 + far - q], b + q + z[q]
            if end - start >= 3 * q:  # any fragment of a run has three periods at least
                out.append((q, start, end))
    return out


_OUT = "row bigint, n_words bigint, digest binary, words binary, octave int, start bigint, first int, stop int, tile binary"


def _documents(schema: pa.Schema, with_text: bool):
    """A row per document, and behind them a row per tile (``octave`` not null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 32
        texts: list[list[bytes]] = []
        rests: list[pa.Array] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal row
            numbers = _Number()
            words = np.fromiter((numbers[w] for t in texts for w in t), np.int64, size)
            ends = np.cumsum([len(t) for t in texts])
            starts = ends - [len(t) for t in texts]
            tiles, found = [], set()
            for octave, places in boundaries(words, starts, ends):
                core, margin, step = _core(octave), 6 << octave, 2 << octave
                doc = np.searchsorted(starts, places, side="right") - 1
                for d, t in sorted(set(zip(doc.tolist(), ((places - starts[doc]) // core).tolist()))):
                    begin, end = int(starts[d]), int(ends[d])
                    low, high = begin + t * core, min(end, begin + (t + 1) * core)
                    window = slice(max(begin, low - margin), min(end, high + margin))
                    tiles.append({"row": row + d, "octave": octave, "start": window.start - begin, "first": -(-low // step) * step - window.start,
                                  "stop": high - window.start, "tile": words[window].astype(np.int32).tobytes()})
                    found.add(d)
            docs = []
            for d, t in enumerate(texts):
                joined = b" ".join(t)
                some = d in found
                docs.append({"row": row + d, "n_words": len(t), "digest": None if some else hashlib.sha256(joined).digest(),
                             "words": joined if some or with_text else None})
            n = len(docs)
            docs += tiles
            row += n
            rest = pa.concat_arrays([*rests, pa.nulls(len(tiles), rests[0].type)])
            return pa.RecordBatch.from_arrays(
                [rest if f.name == "rest" else pa.array([x.get(f.name) for x in docs], f.type) for f in schema], schema=schema)

        for batch in batches:
            seeds, column = batch.column("seed").to_pylist(), batch.column("text").cast(pa.binary())
            done = 0
            for k, text in enumerate(column):
                found = (text.as_py() or b"").split()  # bytes: exactly the six blanks
                n = len(found)
                if seeds[k] is not None and n:
                    a = seeds[k] % n
                    p = 1 + (n - a) // (3 + seeds[k] % 8)
                    found[a:] = (found[a:a + p] * (-(-(n - a) // p)))[:n - a]
                texts.append(found)
                size += n
                if size >= BATCH_WORDS or len(texts) >= 8192:
                    rests.append(batch.column("rest").slice(done, k + 1 - done))
                    done = k + 1
                    yield flush()
                    texts, rests, size = [], [], 0
            if done < len(seeds):
                rests.append(batch.column("rest").slice(done))
        if texts:
            yield flush()

    return run


def write_documents(docs: DataFrame, keep: list[str], seed: Column | None, with_text: bool) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    rest = F.struct(*[F.col(c).alias(f"c{k}") for k, c in enumerate(keep)]) if keep else F.lit(None).cast("struct<c0:int>")
    given = docs.select(F.col("text").cast("string").alias("text"), rest.alias("rest"),
                        (F.lit(None) if seed is None else seed).cast("bigint").alias("seed"))
    shape = StructType([*nullable(given.select("rest").schema), *StructType.fromDDL(_OUT)])
    path = scratch(spark, "runs")
    given.mapInArrow(_documents(to_arrow_schema(shape), with_text), shape).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(shape).parquet(path)


def fragments(written: DataFrame) -> DataFrame:
    """(row, period, start, end) of all tiles, each solved by itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            for tile in batch.to_pylist():
                words = np.frombuffer(tile["tile"], np.int32).tolist()
                out += [(tile["row"], q, tile["start"] + a, tile["start"] + e)
                        for q, a, e in solve_tile(words, tile["octave"], tile["first"], tile["stop"])]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["row", "period", "start", "end"])

    tiles = written.filter("octave IS NOT NULL").select("row", "octave", "start", "first", "stop", "tile")
    return tiles.repartition("row", "octave", "start").mapInArrow(run, "row bigint, period bigint, start bigint, end bigint")


def stitch(found: DataFrame) -> DataFrame:
    """(row, start, length, period) of the runs that the fragments are pieces of."""
    order = Window.partitionBy("row", "period").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = (found.withColumn("opens", F.coalesce(F.col("start") + F.col("period") > before, F.lit(True)).cast("int"))
               .withColumn("island", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0))))
    whole = (islands.groupBy("row", "period", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
             .filter(f"end - start >= greatest({MIN_LENGTH}, {REPEATS} * period)"))
    return (whole.groupBy("row", "start", "end").agg(F.min("period").alias("period"))
            .select("row", "start", (F.col("end") - F.col("start")).alias("length"), "period"))


def _collapse(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, texts, best = [], [], []
            for n, digest, words, runs in zip(*(batch.column(c).to_pylist() for c in ("n_words", "digest", "words", "runs"))):
                top = None
                if runs:
                    split, edge = words.split(b" "), np.zeros(n + 1, np.int64)
                    for r in runs:
                        edge[r["start"] + r["period"]] += 1
                        edge[r["start"] + r["length"]] -= 1
                        if top is None or r["length"] * top["period"] > top["length"] * r["period"]:
                            top = r  # runs come by start, then period: ties stay with the earlier
                    words = b" ".join([split[i] for i in np.flatnonzero(np.cumsum(edge[:n]) == 0).tolist()])
                digests.append(hashlib.sha256(words).hexdigest() if digest is None else digest.hex())
                texts.append(words if with_text else None)
                best.append(top)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rest"), batch.column("n_words"), batch.column("runs"), pa.array(best, batch.column("runs").type.value_type),
                 pa.array(texts, pa.binary()), pa.array(digests, pa.string())],
                names=["rest", "n_words", "runs", "best", "collapsed", "collapsed_sha256"])

    return run


def periodic_runs(docs: DataFrame, keep: list[str], seed: Column | None = None, with_text: bool = True) -> DataFrame:
    """``keep`` columns of each document, n_words, runs (array of start, length, period, in that order), best
    (the run with the greatest length / period), collapsed (words that stay, one space apart; null unless
    ``with_text``) and collapsed_sha256.

    ``seed``: where not null, a document of n words is read with a planted tail: words from a = seed % n
    on are those of a stretch of 1 + (n - a) / (3 + seed % 8) words over and over.
    """
    written = write_documents(docs, keep, seed, with_text)
    runs = stitch(fragments(written)).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    runs = runs.select(F.col("row").alias("of"), F.transform("runs", lambda r: F.struct(
        r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period"))).alias("runs"))
    both = (written.filter("octave IS NULL").select("row", "rest", "n_words", "digest", "words")
            .join(runs, F.col("row") == F.col("of"), "left").select("rest", "n_words", "digest", "words", "runs"))
    run = "struct<start:bigint,length:bigint,period:bigint>"
    shape = nullable(both.selectExpr("rest", "n_words", "runs", f"cast(NULL AS {run}) AS best", "cast(NULL AS binary) AS collapsed",
                                     "'' AS collapsed_sha256").schema)
    out = both.mapInArrow(_collapse(with_text), shape)
    return out.select(*[F.col(f"rest.c{k}").alias(c) for k, c in enumerate(keep)], "n_words",
                      F.coalesce("runs", F.array().cast(f"array<{run}>")).alias("runs"), "best",
                      F.col("collapsed").cast("string").alias("collapsed"), "collapsed_sha256")
