"""Cross-tokenizer alignment: token groups of two tokenizers between shared cuts, and counts of linked ids.

A is a byte-level BPE of the ``tokenizers`` library and encodes space + text; B is
a ``sentencepiece`` BPE and encodes text, before which it puts a space. Byte
offsets where tokens of both end are cuts; the tokens between two neighbouring
cuts are a group, and all its A-B pairs are linked. A pair's count is the number
of documents of the whole table that hold it linked.

1. Texts are cut where a space stands between two characters that are neither
   blank nor U+2581: no token of either tokenizer reaches over such a place (the
   vocabularies are looked through for it), so a stretch between has the same
   tokens wherever it stands. A chunk's distinct stretches are encoded together.
2. Divide and conquer finds the cuts: in every open interval the end of the middle A token
   is looked up among B's ends by bisection, from there A's and B's next ends
   in turn to the right, then to the left, until both agree; the interval falls
   into two, and one without a cut is a leaf group. All intervals of a level are
   searched at once.
3. A chunk writes its documents (places of their stretches, sums, digest of the
   groups) and its stretches (links as places among the chunk's distinct pairs,
   each with the number of the chunk's documents that hold it).
4. Pairs are dealt to shards by A id, so a shard knows the highest count of its A
   ids. ``SHARD_PAIRS`` set the number of shards; beyond ``MOST_SHARDS`` of them, a
   shard's rows are salted, summed per salt, then per shard. A pair of any
   frequency is one entry per chunk. Chunks are answered the counts of their pairs.
5. Sums over a document's links are sums over its stretches.

Nothing but the number of entries reaches the driver, no table is broadcast,
and a task holds one chunk or the distinct pairs of one shard.

Defined results: null and empty texts, and texts whose joined token bytes differ from space +
text (say, with U+2581), have no tokens: zeros, and '' for the digest; rows with the same or no id are documents
each; extra columns are passed on if named in ``keep``; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rollbook.llm.common import dealt, materialise, nullable, scratch, ship

CHUNK_BYTES = 8 << 20
SHARD_PAIRS = 1 << 19
MOST_SHARDS = 4096
#: Characters of distinct stretches that are encoded at once; links of a group that are listed without counting ids.
_BATCH, _SMALL = 200_000, 256
#: Stretches that a worker keeps solved (some 200 MB) before it starts anew.
_KNOWN = 500_000
_WIDE = 0xFFFF
_CUT = re.compile("(?<=[^\\s▁]) (?=[^\\s▁])")


def _byte_letters() -> dict[str, int]:
    """Byte-level BPE's letter of each byte: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class _Place(dict):
    def __missing__(self, part: str) -> int:
        got = self[part] = len(self)
        return got


class Tokenizers:
    """Both tokenizers and the bytes of their ids; loaded once per worker."""

    _loaded: dict[tuple[str, str], Tokenizers] = {}

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        letters, vocabulary = _byte_letters(), self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            self.a_bytes[k] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.width = len(self.b_bytes)
        if len(self.a_bytes) * self.width >= 1 << 32:
            raise ValueError("pairs of ids do not fit 32 bits")
        with open(a_path, encoding="utf-8") as file:
            before = json.load(file)["pre_tokenizer"]
        #: No A token reaches over a space behind a letter (its pattern starts a piece there), no B piece has a space inside.
        self.cuts = (before.get("type") == "ByteLevel" and before.get("use_regex", True)
                     and not any("▁" in p.lstrip("▁") for p in pieces))
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        most = max(len(self.a_bytes), self.width)
        self.text = [b"%d%s" % (k, mark) for k in range(most) for mark in (b",", b"|", b";")]
        self.known = Known()
        self.text_sizes = np.array([len(t) for t in self.text], np.int64)

    @classmethod
    def load(cls, a_path: str, b_path: str) -> Tokenizers:
        if (a_path, b_path) not in cls._loaded:
            cls._loaded[a_path, b_path] = cls(a_path, b_path)
        return cls._loaded[a_path, b_path]

    def stretches(self, text: str) -> list[str]:
        return _CUT.split(text) if self.cuts else [text]

    def encode(self, text: str) -> tuple[list[int], list[int], bool]:
        """A's and B's ids of space + text, and whether both give its bytes back."""
        a, b = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.b.encode(text)
        raw = b" " + text.encode()
        return a, b, b"".join([self.a_bytes[k] for k in a]) == raw == b"".join([self.b_bytes[k] for k in b])


def shared_cuts(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token counts of both sides up to each common end of the rising ends ``a`` and ``b``, whose last ones agree."""
    cuts = [(np.array([len(a)]), np.array([len(b)]))] if len(a) else []
    a0, a1, b0, b1 = (np.array([x]) for x in (0, len(a), 0, len(b)))
    while True:
        wide = (a1 - a0 > 1) & (b1 - b0 > 1)
        a0, a1, b0, b1 = a0[wide], a1[wide], b0[wide], b1[wide]
        if not len(a0):
            break
        middle = (a0 + a1) // 2 - 1
        at, of = np.full(len(a0), -1), np.full(len(a0), -1)
        todo, i = np.arange(len(a0)), middle
        while len(todo):  # to the right: the next end of B, then of A, until they agree or the interval ends
            j = np.searchsorted(b, a[i])
            hit = b[j] == a[i]
            at[todo[hit]], of[todo[hit]] = i[hit], j[hit]
            i, todo = np.searchsorted(a, b[j[~hit]]), todo[~hit]
            inside = i < a1[todo] - 1
            i, todo = i[inside], todo[inside]
        right = at >= 0
        todo = np.flatnonzero(~right)
        i = middle[todo]
        while len(todo):  # to the left: the last end of B before, then of A
            j = np.searchsorted(b, a[i], side="right") - 1
            inside = j >= b0[todo]
            j, todo = j[inside], todo[inside]
            i = np.searchsorted(a, b[j], side="right") - 1
            inside = i >= a0[todo]
            i, j, todo = i[inside], j[inside], todo[inside]
            hit = a[i] == b[j]
            at[todo[hit]], of[todo[hit]] = i[hit], j[hit]
            i, todo = i[~hit], todo[~hit]
        found = at >= 0
        at, of, right = at[found] + 1, of[found] + 1, right[found]
        a0, a1, b0, b1 = a0[found], a1[found], b0[found], b1[found]
        cuts.append((at, of))
        # what a search to the left left behind holds no further cut
        a0, a1, b0, b1 = (np.concatenate(x) for x in ((a0, at[right]), (at, a1[right]), (b0, of[right]), (of, b1[right])))
    if not cuts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.sort(np.concatenate([c[0] for c in cuts])), np.sort(np.concatenate([c[1] for c in cuts]))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] of them), starts[1], ..."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - starts, sizes)


class Stretches:
    """Tokens, groups and links of a list of stretches (each read with a space before it)."""

    def __init__(self, tokenizers: Tokenizers, texts: list[str]) -> None:
        t, n = tokenizers, len(texts)
        self.good = np.ones(n, bool)
        self.n_a, self.n_b = np.zeros(n, np.int64), np.zeros(n, np.int64)
        plain = [k for k, u in enumerate(texts) if t.cuts and u and not (u[0].isspace() or u[-1].isspace() or "▁" in u)]
        ids: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
        order, batch, size = [], [], 0
        for k in [*plain, -1]:
            if batch and (k < 0 or size >= _BATCH):
                order += self._together(t, texts, batch, ids)
                batch, size = [], 0
            if k >= 0:
                batch.append(k)
                size += len(texts[k])
        rest = np.ones(n, bool)
        rest[plain] = False
        order += self._one_by_one(t, texts, np.flatnonzero(rest).tolist(), ids)
        self._align(t, np.array(order, np.int64), *(np.concatenate([np.zeros(0, np.int64), *x]) for x in ids))

    def _together(self, t: Tokenizers, texts: list[str], some: list[int], ids: tuple[list, list]) -> list[int]:
        """Encode stretches that may stand side by side as one text."""
        parts = [texts[k] for k in some]
        a, b, good = t.encode(" ".join(parts))
        ends = np.cumsum([1 + len(u) for u in parts]) if good and sum(map(len, parts)) == len("".join(parts).encode()) \
            else np.cumsum([1 + len(u.encode()) for u in parts])
        for sizes, x, out, counts in ((t.a_sizes, a, ids[0], self.n_a), (t.b_sizes, b, ids[1], self.n_b)):
            x = np.array(x, np.int64)
            at = np.searchsorted(np.cumsum(sizes[x]), ends) + 1
            good = good and at[-1] == len(x)
            if good:
                counts[some] = np.diff(at, prepend=0)
                out.append(x)
        if good:
            return some
        if len(ids[0]) > len(ids[1]):
            ids[0].pop()
        return self._one_by_one(t, texts, some, ids)

    def _one_by_one(self, t: Tokenizers, texts: list[str], some: list[int], ids: tuple[list, list]) -> list[int]:
        kept = []
        for k in some:
            a, b, self.good[k] = t.encode(texts[k])
            self.n_a[k] = self.n_b[k] = 0
            if self.good[k]:
                self.n_a[k], self.n_b[k] = len(a), len(b)
                ids[0].append(np.array(a, np.int64))
                ids[1].append(np.array(b, np.int64))
                kept.append(k)
        return kept

    def _align(self, t: Tokenizers, order: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """Groups, their text and links, per stretch in its first order."""
        n = len(self.good)
        ga, gb = shared_cuts(np.cumsum(t.a_sizes[a]), np.cumsum(t.b_sizes[b]))
        na, nb = np.diff(ga, prepend=0), np.diff(gb, prepend=0)
        ua, ub = np.cumsum(self.n_a[order]), np.cumsum(self.n_b[order])
        last = np.searchsorted(ga, ua)  # every stretch ends with a group
        if not (np.array_equal(ga[last], ua) and np.array_equal(gb[last], ub)):
            raise ValueError("a token reaches over the end of a stretch")
        groups = np.diff(last, prepend=-1)
        self.n_groups, self.n_links = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.n_groups[order] = groups
        linked = np.cumsum(na * nb)
        self.n_links[order] = np.diff(linked[last], prepend=0)
        # text of the groups: A's ids, then B's, with the mark behind each
        marks = np.empty(len(a) + len(b), np.int64)
        a_last, b_last = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        a_last[ga - 1], b_last[gb - 1] = 1, 2
        marks[np.arange(len(a)) + np.repeat(gb - nb, na)] = 3 * a + a_last
        marks[np.arange(len(b)) + np.repeat(ga, nb)] = 3 * b + b_last
        joined = b"".join([t.text[k] for k in marks.tolist()])
        ends = np.cumsum(t.text_sizes[marks])
        stops = ends[ua + ub - 1].tolist() if len(order) else []
        self.text: list[bytes] = [b""] * n
        for k, x, y in zip(order.tolist(), [0, *stops], stops):
            self.text[k] = joined[x:y]
        # links: (stretch, pair, times)
        of = np.repeat(order, groups)
        few = na * nb <= _SMALL
        k, start_a, start_b, width = (na * nb)[few], (ga - na)[few], (gb - nb)[few], nb[few]
        place = _ranges(np.zeros(len(k), np.int64), k)
        wide = np.repeat(width, k)
        pairs = [a[np.repeat(start_a, k) + place // wide] * t.width + b[np.repeat(start_b, k) + place % wide]]
        owner, times = [np.repeat(of[few], k)], [np.ones(len(place), np.int64)]
        for g in np.flatnonzero(~few).tolist():  # distinct ids with their numbers in place of all occurrences
            ia, ca = np.unique(a[ga[g] - na[g]:ga[g]], return_counts=True)
            ib, cb = np.unique(b[gb[g] - nb[g]:gb[g]], return_counts=True)
            pairs.append((ia[:, None] * t.width + ib).ravel())
            times.append((ca[:, None] * cb).ravel())
            owner.append(np.full(len(pairs[-1]), of[g]))
        owner = np.concatenate(owner)
        by = np.argsort(owner, kind="stable")
        self.pairs, self.times = np.concatenate(pairs)[by].astype(np.uint32), np.concatenate(times)[by]
        self.sizes = np.bincount(owner, minlength=n)


class Known:
    """The stretches that a worker has met, solved once each; emptied beyond ``_KNOWN`` of them after a chunk."""

    _COLUMNS = ("good", "n_a", "n_b", "n_groups", "n_links", "sizes", "pairs", "times")

    def __init__(self) -> None:
        self.place = _Place()
        self.text: list[bytes] = []
        self.good = np.zeros(0, bool)
        self.n_a = self.n_b = self.n_groups = self.n_links = self.sizes = self.times = np.zeros(0, np.int64)
        self.pairs = np.zeros(0, np.uint32)

    def solve(self, t: Tokenizers) -> None:
        """Align the stretches that came since the last call."""
        new = list(itertools.islice(self.place, len(self.text), None))
        if new:
            made = Stretches(t, new)
            self.text += made.text
            for c in self._COLUMNS:
                setattr(self, c, np.concatenate([getattr(self, c), getattr(made, c)]))
        self.starts = np.cumsum(self.sizes) - self.sizes


_OUT = ("chunk bigint, kind int, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, places binary, "
        "pairs binary, holders binary, links binary, sizes binary, times binary")


def _chunks(paths: tuple[str, str], schema: pa.Schema, chunk_bytes: int):
    """A row per document (kind 2) and behind each chunk's documents a row of its stretches and pairs (kind 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Tokenizers.load(*paths)
        chunk = TaskContext.get().partitionId() << 32
        known = t.known
        docs: list[np.ndarray] = []
        rests: list[pa.Array] = []
        filled = 0

        def flush() -> Iterator[pa.RecordBatch]:
            known.solve(t)
            used = np.unique(np.concatenate(docs))
            local = np.zeros(len(known.text), np.int64)
            local[used] = np.arange(len(used))
            sizes, entries = known.sizes[used], _ranges(known.starts[used], known.sizes[used])
            pairs, links = np.unique(known.pairs[entries], return_inverse=True)
            starts = np.cumsum(sizes) - sizes
            holders = np.zeros(len(pairs), np.int64)
            rows, held, spread = [], [], 0

            def count() -> None:
                ids = np.repeat(np.arange(len(held)), [len(h) for h in held])
                units = np.concatenate(held)
                ids = np.repeat(ids, sizes[units])
                both = np.unique(ids * len(pairs) + links[_ranges(starts[units], sizes[units])])
                holders[:] += np.bincount(both % len(pairs), minlength=len(pairs))

            for places in docs:
                row = {"chunk": chunk, "kind": 2, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": "", "places": b""}
                if len(places) and known.good[places].all():
                    row |= {c: int(getattr(known, c)[places].sum()) for c in ("n_a", "n_b", "n_groups", "n_links")}
                    row["groups_sha256"] = hashlib.sha256(b"".join([known.text[p] for p in places.tolist()])[:-1]).hexdigest()
                    places = local[places]
                    far = places[places >= _WIDE]  # in order of first appearance: places of frequent stretches are small
                    row["places"] = np.minimum(places, _WIDE).astype(np.uint16).tobytes() + far.astype(np.uint32).tobytes()
                    held.append(np.unique(places))
                    spread += int(sizes[held[-1]].sum())
                    if spread > 1 << 20:
                        count()
                        held, spread = [], 0
                rows.append(row)
            if held:
                count()
            times = known.times[entries]
            other = np.flatnonzero(times != 1)
            rows.append({"chunk": chunk, "kind": 1, "pairs": pairs.tobytes(), "holders": holders.astype(np.uint32).tobytes(),
                         "links": links.astype(np.uint32).tobytes(), "sizes": sizes.astype(np.uint32).tobytes(),
                         "times": np.stack([other, times[other]]).astype(np.int64).tobytes()})
            rest = pa.concat_arrays([*rests, pa.nulls(1, rests[0].type)])
            yield pa.RecordBatch.from_arrays(
                [rest if f.name == "rest" else pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)

        for batch in batches:
            done = 0
            for k, text in enumerate(batch.column("text")):
                text = text.as_py()
                parts = t.stretches(text) if text else []
                docs.append(np.fromiter(map(known.place.__getitem__, parts), np.int64, len(parts)))
                filled += 64 + len(text or "")
                if filled >= chunk_bytes:
                    rests.append(batch.column("rest").slice(done, k + 1 - done))
                    done = k + 1
                    yield from flush()
                    chunk, docs, rests, filled = chunk + 1, [], [], 0
                    if len(known.text) > _KNOWN:
                        known.__init__()
            if done < batch.num_rows:
                rests.append(batch.column("rest").slice(done))
        if docs:
            yield from flush()

    return run


def write_chunks(docs: DataFrame, keep: list[str], paths: tuple[str, str], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    rest = F.struct(*[F.col(c).alias(f"c{k}") for k, c in enumerate(keep)]) if keep else F.lit(None).cast("struct<c0:int>")
    given = docs.select(F.col("text").cast("string").alias("text"), rest.alias("rest"))
    shape = StructType([*nullable(given.select("rest").schema), *StructType.fromDDL(_OUT)])
    path = scratch(spark, "alignment")
    (given.mapInArrow(_chunks(paths, to_arrow_schema(shape), chunk_bytes), shape)
     .write.option("compression", "zstd").parquet(path))
    return spark.read.schema(shape).parquet(path)


def _by_shard(pairs: np.ndarray, width: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs' shards, by A id, and the order that puts the shards one after the other."""
    shard = (pairs // width).astype(np.int64) * 2_654_435_761 % (1 << 32) * shards >> 32
    return shard, np.argsort(shard, kind="stable")


def _asked(width: int, shards: int, salts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs, holders = (np.frombuffer(row[c], np.uint32) for c in ("pairs", "holders"))
                shard, order = _by_shard(pairs, width, shards)
                found, first = np.unique(shard[order], return_index=True)
                cut = [order[a:b] for a, b in zip(first.tolist(), [*first[1:].tolist(), len(order)])]
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array(found, pa.int64()), "salt": pa.array([(row["chunk"] * 31 + (row["chunk"] >> 32)) % salts] * len(cut), pa.int64()),
                    "chunk": pa.array([row["chunk"]] * len(cut), pa.int64()),
                    **{k: pa.array([v[c].tobytes() for c in cut], pa.binary()) for k, v in (("pairs", pairs), ("counts", holders.astype(np.int64)))}})

    return run


_TOTALS = "shard bigint, salt bigint, pairs binary, counts binary, best binary"


def _sum_up(width: int, keys: tuple[str, ...]):
    """Counts added up per pair, for rows that come one key after the other; and which are their A id's highest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pairs, counts, waiting = None, [], [], 0

        def add() -> tuple[np.ndarray, np.ndarray]:
            found, place = np.unique(np.concatenate(pairs), return_inverse=True)
            total = np.zeros(len(found), np.int64)
            np.add.at(total, place, np.concatenate(counts))
            return found, total

        def row() -> pa.RecordBatch:
            found, total = add()
            a = found // width
            first = np.flatnonzero(np.diff(a, prepend=-1 - a[:1].astype(np.int64)))
            top = np.repeat(np.maximum.reduceat(total, first), np.diff([*first, len(a)]))
            made = {"shard": now[0], "salt": now[-1], "pairs": found.tobytes(), "counts": total.tobytes(), "best": (total == top).tobytes()}
            return pa.RecordBatch.from_pylist([made], schema=pa.schema(
                [("shard", pa.int64()), ("salt", pa.int64()), ("pairs", pa.binary()), ("counts", pa.binary()), ("best", pa.binary())]))

        for batch in batches:
            for part in batch.to_pylist():
                key = tuple(part[k] for k in keys)
                if key != now and pairs:
                    yield row()
                    pairs, counts, waiting = [], [], 0
                now = key
                pairs.append(np.frombuffer(part["pairs"], np.uint32))
                counts.append(np.frombuffer(part["counts"], np.int64))
                waiting += len(pairs[-1])
                if waiting > 1 << 22:  # memory: the distinct pairs and as many waiting ones
                    found, total = add()
                    pairs, counts, waiting = [found], [total], 0
        if pairs:
            yield row()

    return run


_ANSWER = "chunk bigint, shard bigint, counts binary, best binary"


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each chunk's pairs; the totals of a shard come before what chunks ask of it."""
    known = counts = best = None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            pairs = np.frombuffer(row["pairs"], np.uint32)
            if row["chunk"] is None:
                known, counts, best = pairs, np.frombuffer(row["counts"], np.int64), np.frombuffer(row["best"], bool)
                continue
            at = np.searchsorted(known, pairs)
            out.append({"chunk": row["chunk"], "shard": row["shard"], "counts": counts[at].tobytes(), "best": np.packbits(best[at]).tobytes()})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("chunk", pa.int64()), ("shard", pa.int64()), ("counts", pa.binary()), ("best", pa.binary())]))


def _finish(width: int, shards: int, schema: pa.Schema):
    """Documents with the sums over their links; a chunk's answers and pairs come before its documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best, answers = np.zeros(0, np.int64), np.zeros(0, np.int64), []
        for batch in batches:
            kinds, docs, sums = batch.column("kind").to_pylist(), [], []
            get = lambda c, k, kind: np.frombuffer(batch.column(c)[k].as_py(), kind)  # noqa: E731, B023
            for k, kind in enumerate(kinds):
                if kind == 0:
                    some = get("counts", k, np.int64)
                    answers.append((some, np.unpackbits(get("best", k, np.uint8), count=len(some))))
                elif kind == 1:
                    pairs, links, sizes = (get(c, k, np.uint32) for c in ("pairs", "links", "sizes"))
                    _, order = _by_shard(pairs, width, shards)
                    count, top = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
                    if answers:
                        count[order], top[order] = (np.concatenate(x) for x in zip(*answers))
                    answers, times = [], np.ones(len(links), np.int64)
                    places, values = get("times", k, np.int64).reshape(2, -1)
                    times[places] = values
                    ends = np.cumsum(sizes, dtype=np.int64)
                    counts, best = (np.diff(np.concatenate([[0], np.cumsum(times * x[links])])[np.concatenate([[0], ends])]) for x in (count, top))
                else:
                    docs.append(k)
                    blob = batch.column("places")[k].as_py()
                    sums.append(_of_document(blob, counts, best))
            if docs:
                part = batch.take(pa.array(docs))
                made = {"n_best": [s[0] for s in sums], "count_sum": [s[1] for s in sums]}
                yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) if f.name in made else part.column(f.name) for f in schema], schema=schema)

    return run


def _of_document(blob: bytes, counts: np.ndarray, best: np.ndarray) -> tuple[int, int]:
    places = _places(blob)
    return int(best[places].sum()), int(counts[places].sum())


def _places(blob: bytes) -> np.ndarray:
    """Places written in two bytes each, those of ``_WIDE`` and more in four behind them."""
    n = len(blob) // 2
    short = np.frombuffer(blob, np.uint16, n)
    wide = _WIDE
    # the first m entries are short; every entry equal to _WIDE takes two further ones
    low, high = n // 3, n
    ahead = np.cumsum(short == wide)
    while low < high:  # m + 2 * (number of wide ones among the first m) rises with m
        m = (low + high) // 2
        if m + 2 * (int(ahead[m - 1]) if m else 0) < n:
            low = m + 1
        else:
            high = m
    out = short[:low].astype(np.int64)
    out[out == wide] = np.frombuffer(blob, np.uint32, offset=2 * low)
    return out


def align_tokens(docs: DataFrame, a_path: str, b_path: str, keep: list[str], chunk_bytes: int = CHUNK_BYTES,
                 shard_pairs: int = SHARD_PAIRS, most_shards: int = MOST_SHARDS) -> DataFrame:
    """``keep`` columns of each document, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    written = write_chunks(docs, keep, (a_path, b_path), chunk_bytes)
    width = Tokenizers.load(a_path, b_path).width
    asked = written.filter("kind = 1").select("chunk", "pairs", "holders")
    total = asked.agg(F.sum(F.octet_length("pairs"))).first()[0] or 0
    shards = min(most_shards, max(1, -(-total // (4 * shard_pairs))))
    salts = max(1, -(-total // (4 * shard_pairs * shards)))
    parts = asked.mapInArrow(_asked(width, shards, salts), "shard bigint, salt bigint, chunk bigint, pairs binary, counts binary")
    salted = dealt(parts.drop("chunk"), ["shard", "salt"]).mapInArrow(_sum_up(width, ("shard", "salt")), _TOTALS)
    totals = materialise(dealt(salted, "shard").mapInArrow(_sum_up(width, ("shard",)), _TOTALS), "pair-totals")
    copies = totals.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    both = copies.unionByName(parts.drop("counts"), allowMissingColumns=True)
    answers = dealt(both, ["shard", "salt"], F.col("chunk").asc_nulls_first()).mapInArrow(_answer, _ANSWER)
    rows = written.drop("holders").unionByName(answers.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    shape = nullable(written.select("rest", "n_a", "n_b", "n_groups", "n_links").selectExpr("*", "0L AS n_best", "0L AS count_sum", "'' AS groups_sha256").schema)
    out = dealt(rows, "chunk", "kind", "shard").mapInArrow(_finish(width, shards, to_arrow_schema(shape)), shape)
    return out.select(*[F.col(f"rest.c{k}").alias(c) for k, c in enumerate(keep)], "n_a", "n_b", "n_groups", "n_links",
                      "n_best", "count_sum", "groups_sha256")
