"""Name -> (Spark builder, DuckDB oracle SQL) registry for the driver-table queries.

Temporal output columns are rendered as ISO text on both sides (dates as
``yyyy-MM-dd``, timestamps with six fractional digits) so the two engines'
results compare value for value whatever client library reads them.
"""

from __future__ import annotations

import functools
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE_SQL: dict[str, str] = {}

STAMP_FORMAT_SPARK = "yyyy-MM-dd HH:mm:ss.SSSSSS"
STAMP_FORMAT_DUCK = "%Y-%m-%d %H:%M:%S.%f"


def temporal_as_text(df: DataFrame) -> DataFrame:
    cols = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DateType):
            cols[f.name] = F.col(f.name).cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols[f.name] = F.date_format(F.col(f.name), STAMP_FORMAT_SPARK)
    return df.withColumns(cols) if cols else df


def _wrap_sql(sql: str, dates: Sequence[str], stamps: Sequence[str], doubles: Sequence[str] = (),
              texts: Sequence[str] = ()) -> str:
    parts = [f"CAST({c} AS VARCHAR) AS {c}" for c in [*dates, *texts]] + \
            [f"strftime({c}, '{STAMP_FORMAT_DUCK}') AS {c}" for c in stamps] + \
            [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles]
    if not parts:
        return sql.strip()
    return f"SELECT * REPLACE ({', '.join(parts)}) FROM (\n{sql.strip()}\n)"


def register(name: str, sql: str | None = None, dates: Sequence[str] = (),
             stamps: Sequence[str] = (), doubles: Sequence[str] = (), texts: Sequence[str] = ()):
    """``doubles``: integer columns that can hold NULLs, rendered as DOUBLE on both
    sides; ``texts``: boolean columns that can hold NULLs, rendered as 'true' /
    'false' text (client libraries map both kinds of nullable column to different
    pandas types per engine)."""
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")

        @functools.wraps(fn)
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = temporal_as_text(fn(spark, sf_dir))
            casts = {**{c: out[c].cast("double") for c in doubles}, **{c: out[c].cast("string") for c in texts}}
            return out.withColumns(casts) if casts else out

        QUERIES[name] = build
        if sql is not None:
            ORACLE_SQL[name] = _wrap_sql(sql, dates, stamps, doubles, texts)
        return fn
    return deco
