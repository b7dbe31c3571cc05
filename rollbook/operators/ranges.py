"""Joins of points to the spans that hold them, as equi-joins on bins.

A span is entered in every bin that it covers, a point looks up its own bin, and
the span's bounds decide among the few that meet there. The bins are as wide as
``bin_days`` (dates) or ``bin_seconds`` (timestamps): a span of average width
should cover a handful. No key is needed besides the bin, but equal keys keep
the groups small. Both bounds are inclusive, as in BETWEEN; a span with a null
bound or one that ends before it starts holds nothing.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BIN = "__bin"


def _place(value: Column, kind: T.DataType, width: int) -> Column:
    number = F.unix_date(value) if isinstance(kind, T.DateType) else F.unix_seconds(value.cast("timestamp"))
    return F.floor(number / F.lit(width)).cast("bigint")


def span_join(points: DataFrame, spans: DataFrame, eq: Sequence[tuple[str, str]], point: str, low: str, high: str,
              how: str = "left", bin_days: int = 7, bin_seconds: int = 3600) -> DataFrame:
    """``p.key = s.key AND p.point BETWEEN s.low AND s.high``; inner or left, a row per pair.

    Column names of ``spans`` must not clash with those of ``points``, but for
    keys of the same name, which are kept once. Dates meet dates and timestamps timestamps.
    """
    if how not in ("inner", "left"):
        raise ValueError("span_join makes inner and left joins")
    kinds = points.schema[point].dataType, spans.schema[low].dataType, spans.schema[high].dataType
    if len({isinstance(k, T.DateType) for k in kinds}) > 1:
        raise ValueError("points and bounds must all be dates or all be timestamps")
    width = bin_days if isinstance(kinds[0], T.DateType) else bin_seconds
    first, last = _place(F.col(low), kinds[1], width), _place(F.col(high), kinds[2], width)
    entered = spans.withColumn(_BIN, F.explode(F.when(F.col(low) <= F.col(high), F.sequence(first, last))))
    same = [a for a, b in eq if a == b]
    entered = entered.withColumnsRenamed({**{c: f"__s_{c}" for c in same}, _BIN: "__s_bin"})
    looked = points.withColumn(_BIN, _place(F.col(point), kinds[0], width))
    conditions = [F.col(a) == F.col(f"__s_{b}" if b in same else b) for a, b in eq]
    conditions += [F.col(_BIN) == F.col("__s_bin"), F.col(point).between(F.col(low), F.col(high))]
    return looked.join(entered, reduce(lambda a, b: a & b, conditions), how).drop(_BIN, "__s_bin", *[f"__s_{c}" for c in same])
