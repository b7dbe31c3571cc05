"""Equi-joins in which heavy keys, and only those, are dealt to several tasks.

A key is heavy when the left side has more than ``rows_per_task`` rows of it.
Its left rows are dealt to so many parts that each holds about that many, and its
right rows are copied to each part; all other keys are joined as they are. Keys
are counted exactly, by a partial aggregate: both sides of the join must agree on
the parts, and approximate counts depend on the order in which rows arrive. The
table of heavy keys has one row per ``rows_per_task`` left rows at most; it is not
hinted, Catalyst broadcasts it by size.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Left rows of a key that one task joins.
ROWS_PER_TASK = 50_000

_PART, _PARTS = "__part", "__parts"


def heavy_keys(df: DataFrame, on: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(on, parts) of the keys with more than ``rows_per_task`` rows; null keys join nothing and are left out."""
    parts = F.ceil(F.count(F.lit(1)) / F.lit(rows_per_task)).cast("int")
    return df.dropna(subset=list(on)).groupBy(*on).agg(parts.alias(_PARTS)).filter(F.col(_PARTS) > 1)


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
                rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``left.join(right, on, how)`` for inner and left joins, heavy keys of ``left`` in parts.

    Extra columns pass through; an empty side gives what the plain join gives.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join makes inner and left joins")
    on = list(on)
    heavy = heavy_keys(left, on, rows_per_task)
    parts = F.coalesce(_PARTS, F.lit(1))
    dealt = left.join(heavy, on, "left").withColumn(_PART, F.pmod(F.xxhash64(*left.columns), parts).cast("int")).drop(_PARTS)
    copied = right.join(heavy, on, "left") \
        .withColumn(_PART, F.explode(F.sequence(F.lit(0), parts - 1))).drop(_PARTS)
    return dealt.join(copied, [*on, _PART], how).drop(_PART)
