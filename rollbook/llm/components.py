"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is a keyed minimum and a join; every round is written to the shared
folder, so the plan stays short and a lost executor re-reads the last round.
Only two numbers per round reach the driver. The number of rounds grows with
the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import materialise


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: bigint); component is its smallest node.

    Empty links give no rows; self-links and repeated links change nothing.
    """
    now = materialise(links.select("a", "b").filter("a <> b").distinct(), "links")
    mark = None
    while True:
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == mark or not new[0]:
            break
        mark = new
        now = materialise(_small_star(_large_star(now)), "stars")
    return (now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
