"""Cross-entropy difference of documents under matched target and background n-gram models.

Both models are bigram models with the same shared vocabulary (every distinct
word, keyed by a 64-bit hash; ASCII letters folded), the same smoothing (a
Dirichlet prior of weight ``mu`` on the unigram model, which is smoothed by one
over the corpus's distinct words, ``CLASSES`` at least) and the same counting;
the background is the whole corpus, the target the documents that a table of
ids names. A document's score is the mean over its tokens of target loss minus
background loss (in nats): low means near the target.

The word and bigram tables grow with the corpus, so none is broadcast:

1. One pass over whole texts writes chunks of documents in input order, at most
   ``CHUNK_DOCS`` of them and about ``CHUNK_TOKENS`` tokens: the chunk's words (eight bytes
   each) and the documents' tokens as places among them. They are written in
   buckets of the chunk's number and read where they lie from here on. Ids play no part, so null or repeated ones do not
   gather in a chunk.
2. A chunk counts its distinct bigrams and words for background and target and
   sends them, packed, to hash ranges of the 64-bit keys, as many as the corpus has ``RANGE_TOKENS``.
3. A range adds up the counts of all chunks, which gives the exact corpus
   counts, and answers each chunk with the counts of the keys that it asked
   about, in its order. The answers to a key of any frequency are one entry per
   chunk, so a frequent word or passage weighs no more than a rare one.
4. The chunk computes the losses of its documents' tokens from the answers.

The driver gets five numbers (tokens and documents of both models, distinct words).

Defined results: null, empty and wordless texts have no tokens and a null
score; an empty target gives the uniform target model; null document ids score
like others and are no targets; rows with the same id are scored each (all are
targets if the id is); extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import materialise, materialise_by, ship

#: Least size of the vocabulary that the unigram model is smoothed over.
CLASSES = 1 << 16
#: Tokens of the corpus to a hash range, and the least number of ranges (as leading bits of the 64-bit keys).
RANGE_TOKENS, RANGE_BITS = 1 << 20, 12
CHUNK_DOCS = 8192
CHUNK_TOKENS = 2 << 20
#: Stands before the first word; words have keys from 1.
START = 0
#: Odd factors that make the keys of bigrams and words out of word keys.
_PAIR, _WORD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_WIDE = 0xFFFF


class _WordClass(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        got = self[word] = xxhash.xxh3_64_intdigest(word) or 1
        return got


class _Place(dict):
    def __missing__(self, word: bytes) -> int:
        got = self[word] = len(self)
        return got


def _split(text) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if isinstance(text, str) else []


def word_classes(text, known: _WordClass) -> np.ndarray:
    """Word keys of a whole text."""
    found = _split(text)
    return np.fromiter(map(known.__getitem__, found), np.uint64, len(found))


_CHUNKS = "chunk bigint, ids binary, nulls binary, sizes binary, tokens binary, words binary"


def _chunks(chunk_docs: int):
    """Chunks of documents: ids, token counts, places of the tokens among the chunk's words, keys of the words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        chunk = TaskContext.get().partitionId() << 32
        known, ids, tokens, total = _Place(), [], [], 0

        def row() -> pa.RecordBatch:
            places = np.concatenate(tokens)
            far = places[places >= _WIDE]  # words in order of appearance: places of frequent ones are small
            words = np.fromiter((xxhash.xxh3_64_intdigest(w) or 1 for w in known), np.uint64, len(known))
            blobs = {"ids": np.array([i or 0 for i in ids], np.int64), "nulls": np.array([i is None for i in ids]),
                     "sizes": np.array([len(t) for t in tokens], np.int64)}
            made = {"chunk": pa.array([chunk], pa.int64()), **{k: pa.array([v.tobytes()], pa.binary()) for k, v in blobs.items()}}
            made["tokens"] = pa.array([np.minimum(places, _WIDE).astype(np.uint16).tobytes() + far.tobytes()], pa.binary())
            made["words"] = pa.array([words.tobytes()], pa.binary())
            return pa.RecordBatch.from_pydict(made)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                found = _split(text.as_py())
                ids.append(doc_id)
                tokens.append(np.fromiter(map(known.__getitem__, found), np.uint32, len(found)))
                total += len(found)
                if len(ids) >= chunk_docs or total >= CHUNK_TOKENS:
                    yield row()
                    chunk += 1
                    known, ids, tokens, total = _Place(), [], [], 0
        if ids:
            yield row()

    return run


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of the chunks: chunk, id and token count."""
    for batch in batches:
        for r in batch.to_pylist():
            ids, sizes = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["sizes"], np.int64)
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array(np.full(len(ids), r["chunk"], np.int64)),
                "doc_id": pa.array(ids, mask=np.frombuffer(r["nulls"], bool)), "n": pa.array(sizes)})


def _word_ranges(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in batch.column("words").to_pylist():
                keys = np.unique(np.frombuffer(words, np.uint64))
                first, last, ranges = _cuts(keys, bits)
                yield pa.RecordBatch.from_pydict({
                    "range": pa.array(ranges), "keys": pa.array([keys[s:e].tobytes() for s, e in zip(first, last)], pa.binary())})

    return run


def _distinct_words(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"n": [len(np.unique(np.frombuffer(b"".join(pdf["keys"]), np.uint64)))]})


def _cuts(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last place of each range (leading ``bits``) in sorted keys, and the ranges."""
    ranges = (keys >> np.uint64(64 - bits)).astype(np.int32)
    first = np.flatnonzero(np.concatenate([[True], ranges[1:] != ranges[:-1]])) if len(ranges) else np.zeros(0, np.int64)
    return first, np.append(first[1:], len(ranges)) if len(ranges) else first, ranges[first]


def _pack(counts: np.ndarray) -> bytes:
    """Counts as bytes, one each; those that do not fit follow with eight."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype(np.int64).tobytes()


def _unpack(packed, sizes) -> np.ndarray:
    """The four counts a key of several blobs in a row; ``sizes``: keys of each blob."""
    out = []
    for blob, n in zip(packed, sizes):
        counts = np.frombuffer(blob, np.uint8, 4 * n).astype(np.int64)
        counts[counts == 255] = np.frombuffer(blob[4 * n:], np.int64)
        out.append(counts.reshape(4, n))
    return np.concatenate(out, axis=1) if out else np.zeros((4, 0), np.int64)


def _pack_keys(keys: np.ndarray, first: np.ndarray, last: np.ndarray, bits: int) -> tuple[int, list[bytes]]:
    """Sorted keys as steps within their range (52 bits at most, ``bits`` being 12 or more), six or seven bytes each."""
    steps = np.diff(keys, prepend=keys[:1])
    steps[first] = keys[first] & np.uint64((1 << 64 - bits) - 1)
    width = 6 if not len(steps) or steps.max() < 1 << 48 else 7
    flat = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :width])
    return width, [flat[s:e].tobytes() for s, e in zip(first, last)]


def _unpack_keys(blobs, widths) -> tuple[np.ndarray, np.ndarray]:
    """The keys (without their range) of several blobs in a row, and how many each blob has."""
    out = []
    for blob, width in zip(blobs, widths):
        steps = np.zeros((len(blob) // width, 8), np.uint8)
        steps[:, :width] = np.frombuffer(blob, np.uint8).reshape(-1, width)
        out.append(np.cumsum(steps.view(np.uint64).ravel(), dtype=np.uint64))
    return np.concatenate(out), np.array([len(k) for k in out], np.int64)


class _Chunk:
    """A chunk's documents, tokens and distinct keys.

    ``places``, ``before``: of each token and of the one before it among the
    words (-1 at a document's start); ``pair``: its bigram among the distinct
    ones; ``keys``: distinct bigrams and words, sorted; ``order``: their places
    in the row of bigrams and words.
    """

    def __init__(self, row) -> None:
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.nulls = np.frombuffer(row["nulls"], bool)
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        n = int(self.sizes.sum())
        self.places = np.frombuffer(row["tokens"], np.uint16, n).astype(np.int32)
        self.places[self.places == _WIDE] = np.frombuffer(row["tokens"][2 * n:], np.uint32)
        self.ends = np.cumsum(self.sizes)
        full = self.sizes > 0
        self.last = self.ends[full] - 1
        self.before = np.empty_like(self.places)
        self.before[1:] = self.places[:-1]
        self.before[(self.ends - self.sizes)[full]] = -1
        words = np.frombuffer(row["words"], np.uint64)
        self.n_words = len(words)
        ahead = np.append(words, np.uint64(START))  # -1: the last entry
        pairs, self.pair = np.unique(ahead[self.before] * _PAIR + words[self.places], return_inverse=True)
        self.n_pairs = len(pairs)
        keys = np.concatenate([pairs, words * _WORD])
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]


_COUNTS = "chunk bigint, range int, width int, keys binary, counts binary"


def _count(bits: int):
    """A chunk's distinct bigrams and words with their counts, packed by range.

    Four counts a key: occurrences in background and target; of a word also as a document's last.
    """
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        chunk = _Chunk(left.iloc[0])
        aim = np.isin(chunk.ids, right["target"].to_numpy(np.int64)) & ~chunk.nulls
        counts = np.zeros((4, len(chunk.keys)), np.int64)
        for r, of, last in ((0, slice(None), slice(None)), (1, np.repeat(aim, chunk.sizes), aim[chunk.sizes > 0])):
            counts[r, :chunk.n_pairs] = np.bincount(chunk.pair[of], minlength=chunk.n_pairs)
            counts[r, chunk.n_pairs:] = np.bincount(chunk.places[of], minlength=chunk.n_words)
            counts[r + 2, chunk.n_pairs:] = np.bincount(chunk.places[chunk.last[last]], minlength=chunk.n_words)
        counts = counts[:, chunk.order]
        first, last, ranges = _cuts(chunk.keys, bits)
        width, keys = _pack_keys(chunk.keys, first, last, bits)
        return pd.DataFrame({"chunk": np.full(len(first), left["chunk"].iloc[0], np.int64), "range": ranges,
                             "width": np.full(len(first), width, np.int32), "keys": keys,
                             "counts": [_pack(counts[:, s:e].ravel()) for s, e in zip(first, last)]})

    return run


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """Corpus counts of the keys that each chunk sent."""
    keys, sizes = _unpack_keys(pdf["keys"], pdf["width"])
    unique, inverse = np.unique(keys, return_inverse=True)
    counts = _unpack(pdf["counts"], sizes)
    total = np.stack([np.bincount(inverse, weights=c, minlength=len(unique)).astype(np.int64) for c in counts])
    ends = np.cumsum(sizes)
    return pd.DataFrame({"chunk": pdf["chunk"], "range": pdf["range"], "counts": [
        _pack(total[:, inverse[s:e]].ravel()) for s, e in zip(ends - sizes, ends)]})


def loss(pair: np.ndarray, context: np.ndarray, word: np.ndarray, total: int, vocabulary: int, mu: float) -> np.ndarray:
    """-log p(second | first): counts of the pair, of its first and of its second word, and of all tokens."""
    unigram = (word + 1.0) / (total + vocabulary)
    return -np.log((pair + mu * unigram) / (context + mu))


def _score(totals: tuple, starts: tuple, vocabulary: int, mu: float, bits: int):
    """``totals``, ``starts``: tokens and documents with tokens, of background and target."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        chunk = _Chunk(left.iloc[0])
        first, last, _ = _cuts(chunk.keys, bits)
        counts = np.empty((4, len(chunk.keys)), np.int64)
        counts[:, chunk.order] = _unpack(right.sort_values("range")["counts"], (last - first).tolist())
        diff = np.zeros(len(chunk.places))
        for r, sign in ((0, -1), (1, 1)):
            word = counts[r, chunk.n_pairs:]
            context = np.append(word - counts[r + 2, chunk.n_pairs:], starts[r])
            diff += sign * loss(counts[r, chunk.pair], context[chunk.before], word[chunk.places], totals[r], vocabulary, mu)
        running = np.concatenate([[0.0], np.cumsum(diff)])
        sizes = chunk.sizes
        with np.errstate(invalid="ignore"):
            score = (running[chunk.ends] - running[chunk.ends - sizes]) / np.where(sizes > 0, sizes, np.nan)
        return pd.DataFrame({"doc_id": pd.arrays.IntegerArray(chunk.ids.copy(), chunk.nulls.copy()), "n_tokens": sizes,
                             "ce_difference": pd.Series(score).astype(object).where(sizes > 0, None)})

    return run


def cross_entropy_difference(docs: DataFrame, targets: DataFrame, mu: float = 50.0,
                             chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """doc_id, n_tokens, ce_difference per row of ``docs`` (doc_id, text); ``targets`` has a doc_id column."""
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chunks = materialise_by(texts.mapInArrow(_chunks(chunk_docs), _CHUNKS), "word-chunks", "chunk")
    each = chunks.select("chunk", "ids", "nulls", "sizes").mapInArrow(_documents, "chunk bigint, doc_id bigint, n bigint")
    each = each.groupBy("chunk", "doc_id").agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("full"))
    each = materialise(each, "chunk-documents")
    named = targets.select(F.col("doc_id").cast("bigint").alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
    aims = materialise(each.filter("doc_id IS NOT NULL").join(named, "doc_id", "left_semi"), "chunk-targets")
    sums = [df.agg(F.sum("n"), F.sum("full")).first() for df in (each, aims)]
    totals, starts = zip(*((s[0] or 0, s[1] or 0) for s in sums))
    bits = max(RANGE_BITS, (-(-totals[0] // RANGE_TOKENS) - 1).bit_length())
    vocabulary = (chunks.select("words").mapInArrow(_word_ranges(bits), "range int, keys binary")
                  .groupBy("range").applyInPandas(_distinct_words, "n bigint").agg(F.sum("n")).first()[0] or 0)
    marks = aims.select("chunk", F.col("doc_id").alias("target"))
    counts = chunks.groupBy("chunk").cogroup(marks.groupBy("chunk")).applyInPandas(_count(bits), _COUNTS)
    answers = counts.groupBy("range").applyInPandas(_answer, "chunk bigint, range int, counts binary")
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        _score(totals, starts, max(CLASSES, vocabulary), mu, bits), "doc_id bigint, n_tokens bigint, ce_difference double")
