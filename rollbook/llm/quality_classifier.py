"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Score of a document with features x (sparse):
    sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2])
The bracket is the sum-of-squares identity: all pairwise interactions of the
features in time linear in their number.

The machine is fitted by Adam on a bounded sample of labelled documents: the
``max_train`` labels with the smallest hash of the document id (a documented
parameter; the sample, not the corpus, goes through the driver). Scoring is one
pass over whole texts without any shuffle; the model (some 600 KB whatever the
input) is broadcast. Labels, language, source and document id are never inputs.

Defined results: null and empty texts get a score from their (zero) statistics;
no usable labels give 0.5 for every document, labels of one class their
smoothed rate; repeated rows score alike; labels for unknown documents and null
labels are ignored, repeated labels for a document count once (the greatest);
extra columns pass through.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import ship

BUCKETS = 1 << 14
FACTORS = 8
_CACHE_LIMIT = 100_000
#: Byte classes counted for the structure statistics.
_CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"\n", b" \t\r\x0b\x0c",
            b"#*$%&|<>", b"!?", b".,;:'\"()-", bytes(range(128, 256)))
_CLASS_OF = np.full(256, len(_CLASSES), dtype=np.int64)
for _k, _members in enumerate(_CLASSES):
    _CLASS_OF[list(_members)] = _k
STATS = len(_CLASSES) + 1 + 8


def _stats(text: str, counts: Counter, n_words: int, n_chars: float) -> list[float]:
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    by_byte = np.bincount(raw, minlength=256)
    classes = np.bincount(_CLASS_OF, weights=by_byte, minlength=len(_CLASSES) + 1) / max(1, raw.size)
    lines = text.split("\n")
    n = max(1, n_words)
    return [*np.sqrt(classes), np.log1p(n_words), np.log1p(max(0.0, n_chars)), np.log1p(len(lines)),
            len(text) / n / 10, len(counts) / n, 1 - len(set(lines)) / len(lines),
            max(counts.values(), default=0) / n, np.log1p(n_words / len(lines))]


class Features:
    """Whole texts to a compressed sparse row block: hashed words, then statistics."""

    def __init__(self) -> None:
        self.bucket: dict[str, int] = {}

    def __call__(self, texts, n_chars) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        if len(self.bucket) > _CACHE_LIMIT:
            self.bucket.clear()
        known, ids, values, starts, stats = self.bucket, [], [], [0], []
        for text, length in zip(texts, n_chars):
            text = text if isinstance(text, str) else ""
            counts = Counter(text.split())
            got: dict[int, float] = {}
            for word, count in counts.items():
                b = known.get(word)
                if b is None:
                    b = known[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)
                got[b] = got.get(b, 0.0) + count
            x = np.log1p(np.fromiter(got.values(), dtype=np.float32, count=len(got)))
            ids.append(np.fromiter(got.keys(), dtype=np.int32, count=len(got)))
            values.append(x / max(1e-9, float(np.sqrt(np.dot(x, x)))))
            starts.append(starts[-1] + len(got))
            length = float(length) if length is not None and length == length else len(text)
            stats.append(_stats(text, counts, sum(counts.values()), length))
        empty = [np.zeros(0, np.int32)], [np.zeros(0, np.float32)]
        return (np.concatenate(ids or empty[0]), np.concatenate(values or empty[1]).astype(np.float32),
                np.array(starts, dtype=np.int64), np.array(stats, dtype=np.float32).reshape(len(stats), STATS))


class FactorisationMachine:
    """Weights of the machine; ``words`` part by hash bucket, ``stats`` part dense."""

    def __init__(self, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        size = BUCKETS + STATS
        self.w0, self.w = np.float32(0), np.zeros(size, np.float32)
        self.v = rng.normal(0, 0.05, (size, FACTORS)).astype(np.float32)
        self.mean, self.std = np.zeros(STATS, np.float32), np.ones(STATS, np.float32)
        self.constant: float | None = None

    def scaled(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.std, -6, 6) / 3

    @staticmethod
    def rows(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Sums of consecutive slices (empty slices: 0)."""
        total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
        return total[starts[1:]] - total[starts[:-1]]

    def margin(self, ids, x, starts, stats) -> tuple[np.ndarray, np.ndarray]:
        """Margins and the factor sums (sum_i v_if x_i), by the sum-of-squares identity."""
        vx = self.v[ids] * x[:, None]
        dense = self.v[BUCKETS:]
        sums = self.rows(vx, starts) + stats @ dense
        squares = self.rows(vx * vx, starts) + (stats ** 2) @ (dense ** 2)
        linear = self.rows(self.w[ids] * x, starts) + stats @ self.w[BUCKETS:]
        return self.w0 + linear + 0.5 * (sums ** 2 - squares).sum(axis=1), sums

    def score(self, ids, x, starts, raw_stats) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(starts) - 1, self.constant)
        m, _ = self.margin(ids, x, starts, self.scaled(raw_stats))
        return 1 / (1 + np.exp(-np.clip(m, -30, 30)))

    def fit(self, ids, x, starts, raw_stats, y, epochs: int = 12, batch: int = 256, rate: float = 0.02,
            l2: float = 1e-4, seed: int = 0) -> FactorisationMachine:
        n = len(y)
        if n == 0 or y.min() == y.max():
            self.constant = 0.5 if n == 0 else float((y.sum() + 1) / (n + 2))
            return self
        self.mean, self.std = raw_stats.mean(axis=0), raw_stats.std(axis=0) + 1e-3
        stats = self.scaled(raw_stats)
        self.w0 = np.float32(np.log(y.mean() / (1 - y.mean())))
        params = [self.w, self.v]
        m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        rng, step = np.random.default_rng(seed), 0
        for _ in range(epochs):
            order = rng.permutation(n)
            for k in range(0, n, batch):
                pick = order[k:k + batch]
                size = starts[pick + 1] - starts[pick]
                at = np.repeat(starts[pick] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                bi, bx, bs = ids[at], x[at], stats[pick]
                b0 = np.concatenate([[0], np.cumsum(size)])
                margin, sums = self.margin(bi, bx, b0, bs)
                g = ((1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[pick]) / len(pick)).astype(np.float32)
                row = np.repeat(np.arange(len(pick)), size)
                gx = g[row] * bx
                gw, gv = l2 * self.w, l2 * self.v
                gw[:BUCKETS] += np.bincount(bi, weights=gx, minlength=BUCKETS).astype(np.float32)
                gw[BUCKETS:] += bs.T @ g
                each = gx[:, None] * (sums[row].astype(np.float32) - self.v[bi] * bx[:, None])
                for f in range(FACTORS):
                    gv[:BUCKETS, f] += np.bincount(bi, weights=each[:, f], minlength=BUCKETS).astype(np.float32)
                gv[BUCKETS:] += (bs * g[:, None]).T @ sums.astype(np.float32) \
                    - self.v[BUCKETS:] * ((bs ** 2) * g[:, None]).sum(axis=0)[:, None]
                step += 1
                self.w0 -= np.float32(rate * g.sum())
                for p, grad, a, b in zip(params, (gw, gv), m1, m2):
                    a += 0.1 * (grad - a)
                    b += 0.01 * (grad * grad - b)
                    p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-6)
        return self


def held_out(doc_id: Column) -> Column:
    """Rows never used for fitting: crc32 of the id as text divisible by 5 (null ids: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, max_train: int = 8000, label: str = "quality",
                seed: int = 0) -> FactorisationMachine:
    """Fit on at most ``max_train`` labelled rows, none of them held out."""
    ship(docs.sparkSession)
    usable = labels.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    usable = usable.groupBy("doc_id").agg(F.max(label).alias("_y"))
    pick = usable.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(max_train)
    # at most max_train rows of two numbers: a proven bound for the broadcast
    n_chars = F.col("n_chars") if "n_chars" in docs.columns else F.lit(None).cast("bigint")
    rows = (docs.select("doc_id", F.col("text").alias("_text"), n_chars.cast("double").alias("_n"))
            .join(F.broadcast(pick), "doc_id"))
    schema = "doc_id bigint, y int, ids binary, x binary, stats binary"

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features()
        for pdf in batches:
            ids, x, starts, stats = features(pdf["_text"], pdf["_n"])
            cut = lambda a, i: a[starts[i]:starts[i + 1]].tobytes()
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "y": pdf["_y"].astype("int32"),
                                "ids": [cut(ids, i) for i in range(len(pdf))],
                                "x": [cut(x, i) for i in range(len(pdf))],
                                "stats": [s.tobytes() for s in stats]})

    got = rows.mapInPandas(extract, schema).toPandas()
    got = got.sort_values("doc_id").drop_duplicates("doc_id")
    ids = np.frombuffer(b"".join(got["ids"]), np.int32)
    x = np.frombuffer(b"".join(got["x"]), np.float32)
    starts = np.concatenate([[0], np.cumsum([len(b) // 4 for b in got["ids"]])]).astype(np.int64)
    stats = np.frombuffer(b"".join(got["stats"]), np.float32).reshape(-1, STATS)
    return FactorisationMachine(seed).fit(ids, x, starts, stats, got["y"].to_numpy(np.float32), seed=seed)


def score_quality(docs: DataFrame, model: FactorisationMachine, out: str = "score", text: str = "text",
                  n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` plus ``out`` (0 to 1; higher: label 1 likelier), scored over whole texts."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        machine, features = shared.value, Features()
        for texts, lengths in parts:
            pieces = []
            for k in range(0, len(texts), 512):  # bounds the feature block of a batch
                pieces.append(machine.score(*features(texts.iloc[k:k + 512], lengths.iloc[k:k + 512])))
            yield pd.Series(np.concatenate(pieces) if pieces else np.zeros(0), dtype="float64")

    known = n_chars is not None and n_chars in docs.columns
    length = F.col(n_chars).cast("double") if known else F.lit(None).cast("double")
    return docs.withColumn(out, score(F.col(text), length))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """Documents with a score of at least ``threshold``; columns of ``docs`` (pipeline stage)."""
    model = fit_quality(docs, labels, **options)
    names = {c: f"_doc{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*(F.col(c).alias(n) for c, n in names.items()))
    scored = score_quality(renamed, model, "_score", names["text"], names.get("n_chars"))
    return scored.filter(F.col("_score") >= threshold).select(*(F.col(n).alias(c) for c, n in names.items()))
