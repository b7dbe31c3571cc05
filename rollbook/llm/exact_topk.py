"""Exact top-k inner products by no-random-access aggregation over sorted lists.

Vectors become integers (floor of ``scale`` times each component). Queries and
candidates are dealt to blocks of bounded size, and each pair of a query block
and a candidate block is one task group. Within a group every dimension has a
list of its candidates sorted by value. For a query the lists are read from
their best ends, a stretch of every list at a time. What has been read of a
candidate is summed; the values at the reading positions bound what its unread
components can add from above, the values at the lists' far ends from below.
Once no candidate outside the contenders (those whose upper bound reaches the
k-th lower bound, ties included) can qualify and the contenders are few, or the
lists are read to the end, the contenders' final scores are resolved exactly in
integers. The block winners (k per query and block) are merged by a keyed rank.

Defined results: vectors null or holding null or non-finite components take no
part; vectors meet only vectors of the same length; equal rows (id and vector)
count once, other rows with the query's id are no candidates either; ties go to
the smaller id; fewer than k candidates give them all; extra columns are
ignored; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollbook.llm.common import materialise, ship

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 2048
#: Shares of the lists at which the bounds are compared, and queries whose bounds are held at once.
DEPTHS, TOGETHER = (0.25, 0.5, 0.75, 0.875, 1.0), 256
_OUT = "query_id bigint, vec_id bigint, score bigint"


def integer_vector(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * component) as array<bigint>; null for vectors that take no part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.when(vector.isNotNull() & finite, F.transform(vector, lambda x: F.floor(scale * x.cast("double"))))


class SortedLists:
    """The candidates of a block with one sorted list per dimension; ``read`` counts list entries that queries read."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        self.values = vectors.astype(np.float64)
        order = np.argsort(vectors, axis=0, kind="stable")
        self.place = np.empty_like(order)  # of each candidate in each list, ascending
        np.put_along_axis(self.place, order, np.arange(len(ids))[:, None], axis=0)
        self.sorted = np.take_along_axis(self.values, order, axis=0)
        self.read = 0

    def _bounds(self, queries: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all scores once ``depth`` entries of every list are read from their best ends."""
        n = len(self.ids)
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        if depth >= n:
            exact = queries @ self.values.T
            return exact, exact
        top, bottom = self.place >= n - depth, self.place < depth
        fill = lambda from_top, from_bottom: (up @ np.where(top, self.values, from_top).T
                                              + down @ np.where(bottom, self.values, from_bottom).T)
        low = fill(self.sorted[0], self.sorted[-1])
        high = fill(self.sorted[n - depth], self.sorted[depth - 1])
        return low, high

    def top(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query the ids and exact scores of its k best candidates, ties to smaller ids."""
        n = len(self.ids)
        found: list = [None] * len(queries)
        q = queries.astype(np.float64)
        reach = np.maximum(np.abs(self.sorted[0]), np.abs(self.sorted[-1])) if n else np.zeros(queries.shape[1])
        for a in range(0, len(queries), TOGETHER):
            todo = np.arange(a, min(len(queries), a + TOGETHER))
            for share in DEPTHS:
                if not len(todo):
                    break
                depth = max(1, min(n, int(np.ceil(share * n)))) if n else 0
                low, high = self._bounds(q[todo], depth)
                own = self.ids == query_ids[todo][:, None]
                low[own] = high[own] = -np.inf
                kth = np.partition(low, n - k, axis=1)[:, n - k] if n > k else np.full(len(todo), -np.inf)
                slack = 1e-9 * (1 + np.abs(q[todo]) @ reach)
                contend = (high >= (kth - slack)[:, None]) & ~own
                done = (contend.sum(axis=1) <= max(4 * k, n // 32)) | (depth >= n)
                for row in np.flatnonzero(done).tolist():
                    some = np.flatnonzero(contend[row])
                    scores = self.vectors[some] @ queries[todo[row]]
                    best = np.lexsort((self.ids[some], -scores))[:k]
                    found[todo[row]] = self.ids[some][best], scores[best]
                self.read += int(done.sum()) * depth * queries.shape[1]
                todo = todo[~done]
        return found


def _block(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        is_query = pdf["is_query"].to_numpy(bool)
        ids = pdf["vec_id"].to_numpy(np.int64)
        vectors = np.stack(pdf["vector"].to_numpy()).astype(np.int64) if len(pdf) else np.zeros((0, 0), np.int64)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if is_query.any() and not is_query.all():
            lists = SortedLists(ids[~is_query], vectors[~is_query])
            for query_id, (best, scores) in zip(ids[is_query], lists.top(ids[is_query], vectors[is_query], k)):
                out.append((np.full(len(best), query_id), best, scores))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), cols)))

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
          scale: int = 1024, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """For each row that ``is_query`` marks, its ``k`` best other rows: query_id, rank, vec_id, score."""
    ship(vectors.sparkSession)
    rows = (vectors.withColumn("_query", F.coalesce(is_query, F.lit(False)))
            .select(F.col(vec_id).cast("bigint").alias("vec_id"), integer_vector(F.col(vector), scale).alias("vector"),
                    F.col("_query").alias("_query"))
            .filter("vec_id IS NOT NULL AND vector IS NOT NULL").dropDuplicates(["vec_id", "vector"]))
    rows = materialise(rows.withColumn("dims", F.size("vector")), "vectors")
    n, q = rows.agg(F.count(F.lit(1)), F.count_if("_query")).first()
    n_c, n_q = max(1, -(-n // candidate_block)), max(1, -(-q // query_block))
    dealt = lambda m, salt: F.pmod(F.xxhash64("vec_id", "vector", F.lit(salt)), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    queries = rows.filter("_query").select("dims", dealt(n_q, 1).alias("bq"), every(n_c).alias("bc"),
                                           F.lit(True).alias("is_query"), "vec_id", "vector")
    candidates = rows.select("dims", every(n_q).alias("bq"), dealt(n_c, 2).alias("bc"),
                             F.lit(False).alias("is_query"), "vec_id", "vector")
    winners = queries.unionByName(candidates).groupBy("dims", "bq", "bc").applyInPandas(_block(k), _OUT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (winners.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
