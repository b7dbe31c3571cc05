"""Dimension helpers: SCD-2 current rows, latest row per key, semi-join."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def current_rows(df: DataFrame, current: str = "edw_is_current",
                 deleted: str = "edw_is_deleted") -> DataFrame:
    """``current IS TRUE AND deleted IS FALSE``: NULL flags exclude the row."""
    return df.filter(F.col(current).eqNullSafe(F.lit(True)) & F.col(deleted).eqNullSafe(F.lit(False)))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   tie_breakers: Sequence[str | Column] = ()) -> DataFrame:
    """Top row per key by ``order`` descending (``QUALIFY ROW_NUMBER() ... = 1``).

    Written as ``max(struct(order, tie_breakers, row))`` so it is a hash
    aggregate with map-side combine: a key holding a third of the rows is
    reduced in every task before the shuffle, unlike a row_number window
    that sorts the whole key in one task. NULL order values rank lowest,
    as ``ORDER BY x DESC`` puts NULLs last.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordering = [F.col(c) if isinstance(c, str) else c for c in [*order, *tie_breakers]]
    ordering = [c.alias(f"__o{i}") for i, c in enumerate(ordering)]
    best = F.max(F.struct(*ordering, F.struct(*[F.col(c) for c in rest]).alias("__row")))
    return df.groupBy(*keys).agg(best.alias("__best")).select(*keys, "__best.__row.*") \
        .select(*df.columns)


def semi(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """``WHERE key IN (SELECT key FROM other)`` as a left-semi join (repeats on the right change nothing)."""
    return df.join(other.select(*on), on=list(on), how="left_semi")
