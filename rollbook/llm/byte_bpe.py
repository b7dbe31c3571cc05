"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The texts of an Arrow batch are split into pieces by the vocabulary's pattern;
the batch's distinct new pieces form one corpus of byte positions. An inverted
index leads from each mergeable token pair to the positions where it stands.
Merges are applied corpus-wide in rank order: the lowest-ranked pair present is
taken, all its positions are merged, and only the touched neighbours' pairs are
entered anew. Encoded pieces are kept in a bounded table per worker, so a word
is replayed once per worker, not once per occurrence. The job is one pass
without a shuffle; pieces are independent, so the split into batches cannot
change a result.

Exactness: the usual encoder merges the leftmost lowest-ranked pair of a piece
at a time. Replay differs only if a merge makes a pair of a lower rank than its
own; pieces where that happens are encoded again one merge at a time.

Defined results: null and empty texts give no ids; bytes come back exactly;
repeated rows and extra columns pass through; no rows give no rows.
"""

from __future__ import annotations

import base64
import gc
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from rollbook.llm.common import Remembered, ship

#: Bytes of a generation of encoded pieces that a worker keeps, and texts that are replayed at once.
_CACHE_LIMIT = 24 << 20
_TEXTS = 256


class Vocabulary:
    """Ranks of a tiktoken file and the pattern that makes pieces; loaded once per worker."""

    _loaded: dict[tuple[str, str], Vocabulary] = {}

    def __init__(self, path: str, pattern: str) -> None:
        import regex

        self.tokens: dict[bytes, int] = {}
        with open(path, "rb") as lines:
            for line in lines:
                token, _, rank = line.strip().partition(b" ")
                if token:
                    self.tokens[base64.b64decode(token)] = int(rank)
        self.text = {rank: token for token, rank in self.tokens.items()}
        self.byte = np.array([self.tokens[bytes([b])] for b in range(256)], dtype=np.int64)
        self.span = max(self.text) + 1
        #: rank (and id) of the token that a pair of tokens merges to; key: first * span + second
        self.merged = {self.tokens[t[:k]] * self.span + self.tokens[t[k:]]: rank
                       for t, rank in self.tokens.items() for k in range(1, len(t))
                       if t[:k] in self.tokens and t[k:] in self.tokens}
        self.of_bytes = np.full(65536, -1, dtype=np.int64)
        for t, rank in self.tokens.items():
            if len(t) == 2:
                self.of_bytes[t[0] * 256 + t[1]] = rank
        self.split = regex.compile(pattern).findall
        self.known = Remembered(_CACHE_LIMIT)

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        if (path, pattern) not in cls._loaded:
            cls._loaded[path, pattern] = cls(path, pattern)
        return cls._loaded[path, pattern]

    # -------------------------------------------------------------- replay

    def replay(self, corpus: list[bytes]) -> list[bytes]:
        """Ids of each piece: all merges in rank order over the whole corpus at once.

        ``index[r]`` lists the positions where a pair that merges to token ``r``
        was seen; ``at[i]`` is the rank of the pair that starts at ``i`` now.
        """
        if not corpus:
            return []
        raw = np.frombuffer(b"".join(corpus), dtype=np.uint8).astype(np.int64)
        ends = np.cumsum([len(p) for p in corpus])
        n = len(raw)
        last = np.zeros(n + 1, dtype=bool)
        last[ends - 1] = True  # pieces are not empty
        last = last[:n]
        pair = np.full(n, -1, dtype=np.int64)
        pair[:-1] = self.of_bytes[raw[:-1] * 256 + raw[1:]]
        pair[last] = -1
        order = np.argsort(pair, kind="stable")
        order = order[np.searchsorted(pair[order], 0):]
        ranks, cuts = np.unique(pair[order], return_index=True)
        index: list[list[int] | None] = [None] * self.span
        for rank, places in zip(ranks.tolist(), np.split(order, cuts[1:]) if len(ranks) else []):
            index[rank] = places.tolist()
        symbol, at = self.byte[raw].tolist(), pair.tolist()
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        nxt[last] = -1
        prv[0] = -1
        prv[1:][last[:-1]] = -1
        nxt, prv = nxt.tolist(), prv.tolist()
        merged, span, odd = self.merged.get, self.span, []
        for rank in range(span):
            places = index[rank]
            if places is None:
                continue
            if len(places) > 1:
                places.sort()
            for i in places:  # left to right, for pairs that overlap
                if at[i] != rank:
                    continue  # a neighbour's merge took one side
                j = nxt[i]
                k = nxt[j]
                symbol[i], symbol[j], at[j], nxt[i] = rank, -1, -1, k
                if k >= 0:
                    prv[k] = i
                    new = merged(rank * span + symbol[k], -1)
                    at[i] = new
                    if new >= 0:
                        if new <= rank:
                            odd.append(i)
                        elif index[new] is None:
                            index[new] = [i]
                        else:
                            index[new].append(i)
                else:
                    at[i] = -1
                h = prv[i]
                if h >= 0:
                    new = merged(symbol[h] * span + rank, -1)
                    at[h] = new
                    if new >= 0:
                        if new <= rank:
                            odd.append(h)
                        elif index[new] is None:
                            index[new] = [h]
                        else:
                            index[new].append(h)
            index[rank] = None
        final = np.array(symbol, dtype=np.int64)
        alive = final >= 0
        data = final[alive].astype("<u4").tobytes()
        cut = (np.cumsum(alive)[ends - 1] * 4).tolist()
        out = [data[s:e] for s, e in zip([0, *cut], cut)]
        for k in np.unique(np.searchsorted(ends, odd, side="right")).tolist() if odd else []:
            out[k] = np.array(self.one_by_one(corpus[k]), dtype="<u4").tobytes()
        return out

    def one_by_one(self, text: bytes) -> list[int]:
        """Ids of one piece, always merging its leftmost lowest-ranked pair."""
        symbol = self.byte[np.frombuffer(text, dtype=np.uint8)].tolist()
        n = len(symbol)
        rank_of = lambda a, b: self.merged.get(a * self.span + b)
        nxt, prv = [*range(1, n), -1], list(range(-1, n - 1))
        queue = [(r, i) for i in range(n - 1) if (r := rank_of(symbol[i], symbol[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            rank, i = heapq.heappop(queue)
            j = nxt[i]
            if symbol[i] < 0 or j < 0 or rank_of(symbol[i], symbol[j]) != rank:
                continue
            symbol[i], symbol[j] = rank, -1
            nxt[i] = nxt[j]
            if nxt[i] >= 0:
                prv[nxt[i]] = i
            for left in (prv[i], i):
                if left >= 0 and nxt[left] >= 0 and (r := rank_of(symbol[left], symbol[nxt[left]])) is not None:
                    heapq.heappush(queue, (r, left))
        return [s for s in symbol if s >= 0]

    # -------------------------------------------------------------- texts

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        known, split, out = self.known, self.split, []
        pieces = [split(t) for t in texts]
        new = known.missing(set().union(*pieces))
        raw = [p.encode("utf-8", "surrogatepass") for p in new]
        whole = [self.tokens.get(r) for r in raw]  # a piece that is a token is taken as it is
        gc.disable()  # the index is many small lists, none of them in a cycle
        try:
            ids = iter(self.replay([r for r, w in zip(raw, whole) if w is None]))
        finally:
            gc.enable()
        for p, w in zip(new, whole):
            known[p] = w.to_bytes(4, "little") if w is not None else next(ids)
        for ps in pieces:
            out.append(b"".join([known[p] for p in ps]))
        return out

    def decode(self, ids: bytes) -> bytes:
        text = self.text
        return b"".join([text[i] for i in np.frombuffer(ids, "<u4").tolist()])


def _encode_all(vocabulary: Vocabulary, texts: pd.Series) -> list[bytes]:
    got: list[bytes] = []
    for k in range(0, len(texts), _TEXTS):
        got += vocabulary.encode([t if isinstance(t, str) else "" for t in texts.iloc[k:k + _TEXTS]])
    return got


def encoder(path: str, pattern: str):
    """Column function: text to binary ids (little-endian unsigned 32-bit; null: empty)."""
    ship(SparkSession.getActiveSession())

    @F.pandas_udf("binary")
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = Vocabulary.load(path, pattern)
        for texts in parts:
            yield pd.Series(_encode_all(vocabulary, texts), dtype=object)

    return encode


def round_trip(path: str, pattern: str):
    """Column function: text to a struct of its ids and of the bytes decoded from them, in one worker."""
    ship(SparkSession.getActiveSession())

    @F.pandas_udf("ids binary, decoded binary")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vocabulary = Vocabulary.load(path, pattern)
        for texts in parts:
            ids = _encode_all(vocabulary, texts)
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object),
                                "decoded": pd.Series([vocabulary.decode(x) for x in ids], dtype=object)})

    return run


def decoder(path: str, pattern: str):
    """Column function: binary ids to the text's bytes."""
    ship(SparkSession.getActiveSession())

    @F.pandas_udf("binary")
    def decode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = Vocabulary.load(path, pattern)
        for ids in parts:
            yield pd.Series([vocabulary.decode(x if x is not None else b"") for x in ids], dtype=object)

    return decode


def n_ids(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("bigint")
