"""Near-duplicate documents by bottom-k sketches from one hash function.

A document is the set of its distinct 3-word shingles (ASCII letters folded),
each hashed once to 64 bits. Two documents are linked if the Jaccard similarity
of their full sets is at least ``percent`` per cent; groups are the connected
components of all links.

1. One pass over whole texts writes per document the set's size, a 128-bit
   digest of the set and its ``k`` smallest hashes (the sketch; the whole set
   if it is smaller). No text is shuffled.
2. Documents with equal sets become one representative (partial aggregate on
   the digest, so thousands of copies cost one row).
3. Inverted lists: the ``PROBES`` smallest retained values of each
   representative are counted over the corpus, and the representative enters
   the lists of the rarer half of its own (values that no other document
   retains use up the half first and have no list). Two sets that share more
   than half of these values meet in a list, since in one common order of
   rarity the rarer halves of both cannot miss each other. At similarity 0.85
   and 32 values fewer are shared with a probability of about 3e-6; smaller
   sets are retained whole and never miss. Passages that many documents share
   thus make no candidates unless they are most of a document. Within a list,
   overlaps of the retained values and then the union sketch (the k smallest of
   both together, compared by their high 32 bits) filter the pairs, with a
   margin that a true pair misses with a probability of about 1e-7.
4. A list does not give out its pairs, only a spanning forest of those that
   pass. The components of these forests are candidate clusters: every true
   link lies within one of them.
5. Each cluster gets the full sets of its members once and confirms links by
   exact Jaccard, walking breadth-first so that members already reached are not
   compared again; it gives out a spanning forest of the true links. Their
   components are the result.

Hot lists and clusters are cut into blocks of bounded size, and every pair of
blocks is a task group of its own: no group's size is limited, no group meets
in one task, and no more than a forest (rows, not pairs) leaves a task.

Defined results: null, empty and wordless texts have size 0 and link with
nothing; with one or two words the sequence is the one shingle; rows that share
a doc_id are one document; rows with a null doc_id link with nothing, have a
null component and are kept; extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import materialise, ship
from rollbook.llm.components import components

K = 64
PROBES = 32
#: Share of shared values in the union sketch that a pair must reach to be confirmed on full sets.
MARGIN = 38 / 64
BLOCK_ROWS = 1024
BLOCK_SHINGLES = 2_000_000
_CACHE_LIMIT = 100_000
_PAD = np.uint32(0xFFFFFFFF)


# ------------------------------------------------------------------ sets of shingle hashes

class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class ShingleSets:
    """Whole texts to sorted arrays of distinct 64-bit shingle hashes."""

    def __init__(self) -> None:
        self.words = _WordHashes()

    def __call__(self, text) -> np.ndarray:
        if not isinstance(text, str):
            return np.zeros(0, np.uint64)
        if len(self.words) > _CACHE_LIMIT:
            self.words.clear()
        found = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z fold, only \x20 \x09-\x0D split
        n = len(found)
        if not n:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(self.words.__getitem__, found), np.uint64, n)
        if n < 3:
            h = np.concatenate([h, np.full(3 - n, n, np.uint64)])
        mixed = _mix(_mix(_mix(h[:-2]) + h[1:-1]) + h[2:])
        return np.unique(mixed)


_SKETCH_SCHEMA = "doc_id bigint, n bigint, probes array<bigint>, digest binary, sketch binary"


def _sketch_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sets = ShingleSets()
    for pdf in batches:
        got = [sets(t) for t in pdf["text"]]
        yield pd.DataFrame({
            "doc_id": pdf["doc_id"], "n": np.array([len(s) for s in got], np.int64),
            "probes": [s[:PROBES].view(np.int64) for s in got],
            "digest": [hashlib.md5(s.tobytes(), usedforsecurity=False).digest() for s in got],
            "sketch": [(s[:K] >> np.uint64(32)).astype(np.uint32).tobytes() for s in got]})


# ------------------------------------------------------------------ streaming over sorted groups

def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Consecutive frames that hold whole groups only (the partition is sorted by ``keys``)."""
    rest: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        last = np.ones(len(pdf), bool)
        for k in keys:
            last &= (pdf[k] == pdf[k].iloc[-1]).to_numpy()
        if last.all() and (not rest or all(rest[-1][k].iloc[-1] == pdf[k].iloc[-1] for k in keys)):
            rest.append(pdf)
            continue
        yield pd.concat([*rest, pdf[~last]], ignore_index=True)
        rest = [pdf[last]]
    if rest:
        yield pd.concat(rest, ignore_index=True)


def _bounds(pdf: pd.DataFrame, keys: list[str]) -> np.ndarray:
    new = np.ones(len(pdf), bool)
    if len(pdf) > 1:
        new[1:] = False
        for k in keys:
            v = pdf[k].to_numpy()
            new[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(new), len(pdf))


# ------------------------------------------------------------------ candidates: overlaps and union sketches

def _passes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether the union sketches of paired rows reach the margin (rows: padded sorted sketches)."""
    both = np.sort(np.concatenate([left, right], axis=1), axis=1)
    real = both != _PAD
    twice = (both[:, 1:] == both[:, :-1]) & real[:, 1:]
    new = real.copy()
    new[:, 1:] &= ~twice
    rank = np.cumsum(new, axis=1)
    size = np.minimum(rank[:, -1], K)
    shared = (twice & (rank[:, 1:] <= size[:, None])).sum(axis=1)
    return shared >= np.floor(MARGIN * size)


def _list_forest(ids: np.ndarray, sketches: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of the pairs of one list (or block pair) that pass the filters.

    Overlaps of all pairs come from one product of the 0/1 matrix of values that
    occur at least twice in the list.
    """
    n = len(ids)
    values, where = np.unique(sketches.ravel(), return_inverse=True)
    often = np.bincount(where, minlength=len(values)) >= 2
    often[values == _PAD] = False
    column = np.cumsum(often) - 1
    row = np.repeat(np.arange(n), sketches.shape[1])
    use = often[where]
    member = np.zeros((n, int(often.sum())), np.float32)
    member[row[use], column[where[use]]] = 1
    kept = np.minimum(sizes, K)
    out, left = [], np.ones(n, bool)
    for start in np.argsort(-member.sum(axis=1), kind="stable"):  # the most connected first
        if not left[start]:
            continue
        left[start] = False
        queue = [start]
        while queue:
            i = queue.pop()
            open_ = np.flatnonzero(left)
            if not len(open_):
                return out
            overlap = member[open_] @ member[i]
            near = open_[(overlap >= np.floor(MARGIN * np.minimum(kept[open_], kept[i])))
                         & (100 * np.minimum(sizes[open_], sizes[i]) >= 80 * np.maximum(sizes[open_], sizes[i]))]
            if len(near):
                near = near[_passes(sketches[near], np.broadcast_to(sketches[i], (len(near), sketches.shape[1])))]
                left[near] = False
                queue.extend(near.tolist())
                out.extend((int(ids[i]), int(ids[j])) for j in near if ids[i] != ids[j])
    return out


_LIST_KEYS = ["value", "bi", "bj"]


def _list_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in _groups(batches, _LIST_KEYS):
        bounds = _bounds(pdf, _LIST_KEYS)
        ids, sizes = pdf["rep"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
        sketches = np.full((len(pdf), K), _PAD, np.uint32)
        for r, raw in enumerate(pdf["sketch"]):
            s = np.frombuffer(raw, np.uint32)
            sketches[r, :len(s)] = s
        counts = np.diff(bounds)
        edges: list[tuple[int, int]] = []
        group = np.repeat(np.arange(len(counts)), counts)
        small = counts <= 12
        for step in range(1, 12):  # short lists: pairs of rows at one distance, for all lists at once
            a = np.flatnonzero(group[:-step] == group[step:]) if len(group) > step else np.zeros(0, np.int64)
            a = a[small[group[a]]]
            b = a + step
            a, b = (x[(100 * np.minimum(sizes[a], sizes[b]) >= 80 * np.maximum(sizes[a], sizes[b])) & (ids[a] != ids[b])]
                    for x in (a, b))
            for k in range(0, len(a), 4096):
                pa, pb = a[k:k + 4096], b[k:k + 4096]
                ok = _passes(sketches[pa], sketches[pb])
                edges.extend(zip(ids[pa[ok]].tolist(), ids[pb[ok]].tolist()))
        for g in np.flatnonzero(~small):
            s = slice(bounds[g], bounds[g + 1])
            edges.extend(_list_forest(ids[s], sketches[s], sizes[s]))
        yield pd.DataFrame(edges, columns=["a", "b"], dtype=np.int64).drop_duplicates()


# ------------------------------------------------------------------ exact links within clusters

def exact_forest(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the pairs with 100 * intersection >= percent * union."""
    n, sizes = len(ids), np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    _, element = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(element, kind="stable")
    posting = owner[order]  # documents of each element, element by element
    ends = np.cumsum(np.bincount(element))
    begins = np.concatenate([[0], ends[:-1]])
    at = np.concatenate([[0], np.cumsum(sizes)])
    out, left = [], np.ones(n, bool)
    shared_most = np.argsort(-np.add.reduceat((ends - begins)[element], at[:-1]) / np.maximum(sizes, 1), kind="stable")
    for start in shared_most:
        if not left[start]:
            continue
        left[start] = False
        queue = [start]
        while queue:
            i = queue.pop()
            if not left.any():
                return out
            own = element[at[i]:at[i + 1]]
            length = ends[own] - begins[own]
            first = np.concatenate([[0], np.cumsum(length)[:-1]])
            places = np.repeat(begins[own] - first, length) + np.arange(length.sum())
            inter = np.bincount(posting[places], minlength=n)
            near = np.flatnonzero(left & (100 * inter >= percent * (sizes + sizes[i] - inter)) & (inter > 0))
            left[near] = False
            queue.extend(near.tolist())
            out.extend((int(ids[i]), int(ids[j])) for j in near if ids[i] != ids[j])
    return out


_CLUSTER_KEYS = ["cluster", "bi", "bj"]


def _cluster_links(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _groups(batches, _CLUSTER_KEYS):
            bounds = _bounds(pdf, _CLUSTER_KEYS)
            ids = pdf["rep"].to_numpy(np.int64)
            sets = [np.frombuffer(x, np.uint64) for x in pdf["hashes"]]
            edges: list[tuple[int, int]] = []
            for s, e in zip(bounds[:-1], bounds[1:]):
                edges.extend(exact_forest(ids[s:e], sets[s:e], percent))
            yield pd.DataFrame(edges, columns=["a", "b"], dtype=np.int64).drop_duplicates()

    return run


def _hash_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sets = ShingleSets()
    for pdf in batches:
        got = [sets(t) for t in pdf["text"]]
        yield pd.DataFrame({"cluster": pdf["cluster"], "blocks": pdf["blocks"], "rep": pdf["rep"],
                            "hashes": [s.tobytes() for s in got]})


def _block_pairs(df: DataFrame, blocks: Column, own: Column) -> DataFrame:
    """A row for each pair of blocks (bi <= bj) that its own block is part of; one block: the pair (0, 0)."""
    other = F.explode(F.when(blocks <= 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), blocks - 1), lambda x: x != own)))
    df = df.withColumn("_own", F.when(blocks <= 1, F.lit(0)).otherwise(own)).withColumn("_other", other)
    return (df.withColumn("bi", F.least("_own", "_other").cast("int"))
            .withColumn("bj", F.greatest("_own", "_other").cast("int")).drop("_own", "_other"))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """Groups of near-duplicates; ``percent`` is at least 85 (the candidate margins are made for it).

    doc_id, n_shingles, component_id (smallest doc_id of its group), kept (doc_id = component_id) per row."""
    if not 85 <= percent <= 100:
        raise ValueError("percent is 85 to 100: below that, lists and sketch margins would miss links")
    ship(docs.sparkSession)
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    rows = materialise(ids.mapInPandas(_sketch_rows, _SKETCH_SCHEMA), "sketches")
    # representatives of equal sets
    live = rows.filter("doc_id IS NOT NULL AND n > 0")
    reps = live.groupBy("digest").agg(F.min(F.struct("doc_id", "n", "probes", "sketch")).alias("r"))
    reps = materialise(reps.select("digest", F.col("r.doc_id").alias("rep"), F.col("r.n").alias("n"),
                                   F.col("r.probes").alias("probes"), F.col("r.sketch").alias("sketch")), "reps")
    # inverted lists of the smallest retained values
    entries = reps.select("rep", F.size("probes").alias("had"), F.explode("probes").alias("value"))
    common = entries.groupBy("value").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    ranked = entries.join(common, "value").groupBy("rep", "had").agg(
        F.sort_array(F.collect_list(F.struct("size", "value"))).alias("by_rarity"))  # PROBES values at most
    half = F.ceil(F.col("had") / 2).cast("int") - (F.col("had") - F.size("by_rarity"))
    chosen = ranked.select("rep", F.explode(F.slice("by_rarity", 1, F.greatest(half, F.lit(0))).getField("value")).alias("value"))
    chosen = materialise(chosen, "probes")
    lists = (chosen.groupBy("value").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
             .withColumn("blocks", F.ceil(F.col("size") / BLOCK_ROWS).cast("int")).drop("size"))
    listed = chosen.join(lists, "value").join(reps.select("rep", "n", "sketch"), "rep")
    listed = _block_pairs(listed, F.col("blocks"), F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    listed = (listed.select(*_LIST_KEYS, "rep", "n", "sketch").repartition(*_LIST_KEYS)
              .sortWithinPartitions(*_LIST_KEYS))
    candidates = listed.mapInPandas(_list_links, "a bigint, b bigint")
    clusters = materialise(components(candidates), "clusters")
    # exact links within clusters
    members = clusters.join(reps.select("rep", "n"), F.col("node") == F.col("rep"))
    sizes = members.groupBy("component").agg(F.greatest(
        F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)) / BLOCK_ROWS)).cast("int").alias("blocks"))
    members = materialise(members.join(sizes, "component")
                          .select("rep", F.col("component").alias("cluster"), "blocks").distinct(), "members")
    full = (ids.join(members, F.col("doc_id") == F.col("rep"))
            .mapInPandas(_hash_rows, "cluster bigint, blocks int, rep bigint, hashes binary"))
    full = _block_pairs(full, F.col("blocks"), F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    full = (full.select(*_CLUSTER_KEYS, "rep", "hashes").repartition(*_CLUSTER_KEYS)
            .sortWithinPartitions(*_CLUSTER_KEYS))
    links = full.mapInPandas(_cluster_links(percent), "a bigint, b bigint")
    # rows that share a doc_id but not a set are one document: link their representatives
    shared = (live.select("doc_id", "digest").distinct().join(reps.select("digest", "rep"), "digest")
              .filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    several = (live.select("doc_id", "digest").distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("k"))
               .filter("k > 1").select(F.col("doc_id").alias("a")))
    twice = shared.join(several, "a", "left_semi")
    groups = materialise(components(links.unionByName(twice)), "groups")
    out = rows.select("doc_id", "n", "digest").join(reps.select("digest", "rep"), "digest", "left")
    out = out.join(groups, F.when(F.col("n") > 0, F.col("rep")) == F.col("node"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.least(F.col("doc_id"), F.coalesce(
        F.col("component"), F.when(F.col("n") > 0, F.col("rep")), F.col("doc_id"))))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """One document of each group (the smallest doc_id); columns of ``docs`` (pipeline stage).

    Rows that share a kept doc_id become one row; rows with a null doc_id stay.
    """
    kept = near_duplicates(docs, **options).filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = docs.filter("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.select(*docs.columns).unionByName(docs.filter("doc_id IS NULL"))
