"""Incremental, day-partitioned snapshot writes without a row-level catalog.

The reference merges today's rows into a date-partitioned table on a
four-column key, scanning only today's partition. On plain parquet the same
effect is: read the partitions that the batch names, keep the rows whose key is not in
the batch (left anti), add the batch, and overwrite only those partitions with
dynamic partition overwrite. The merged rows are checkpointed to the shared
checkpoint folder first, so the overwrite never reads the files it replaces
and a lost executor recomputes from the checkpoint.
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.context import RunContext
from rollbook.session import cut_lineage


class FullRefreshNotAllowed(RuntimeError):
    pass


def guard_full_refresh(ctx: RunContext) -> None:
    """Full rebuilds are only allowed in the dev environment."""
    if ctx.full_refresh and ctx.env != "dev":
        raise FullRefreshNotAllowed(
            "Full refresh is not allowed for this model. Use direct DDL/DML on the table instead.")


def has_data(spark: SparkSession, path: str) -> bool:
    """Does ``path`` hold a data file? A folder left by an empty first run does not count.

    Files are listed by Spark's reader, whatever the store; no content is read."""
    files = spark.read.format("binaryFile").options(pathGlobFilter="*.parquet", recursiveFileLookup="true")
    try:
        return not files.load(path).select("path").isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The snapshot with the union of all partitions' columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def snapshot_exists(spark: SparkSession, path: str, day: dt.date,
                    partition_col: str = "snapshot_date") -> bool:
    """Is there any row for ``day``? Partition pruning reads one directory at most."""
    if not has_data(spark, path):
        return False
    return spark.read.parquet(path).filter(F.col(partition_col) == F.lit(day)).limit(1).count() > 0


def gate_open(friday, month_end, exists_today):
    """The gate's rule for booleans or Columns of them: a Friday or a month's last day, without a snapshot so far."""
    return (friday | month_end) & (exists_today == False)  # noqa: E712 (works for Columns too)


def should_snapshot(ctx: RunContext, exists_today: bool) -> bool:
    """Gate: override, or (Friday or last day of month) and no snapshot yet today."""
    if ctx.override:
        return True
    day = ctx.as_of_date
    return gate_open(day.isoweekday() == 5, (day + dt.timedelta(days=1)).month != day.month, exists_today)


def _with_columns_of(df: DataFrame, other: DataFrame) -> DataFrame:
    """``df`` plus typed NULLs for the columns that only ``other`` has."""
    have = {c.lower() for c in df.columns}
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in other.schema.fields
                           if f.name.lower() not in have})


def snapshot_merge(new_rows: DataFrame, path: str, key: Sequence[str],
                   partition_col: str = "snapshot_date") -> int:
    """Merge ``new_rows`` into the partitions they are dated at ``path``.

    Every partition that the batch names is merged: rows with a key of the
    batch are replaced, all others stay. Columns are the union of the table's
    and the batch's; what one side lacks is NULL there, and nothing is dropped.
    Rows without a date have no partition and are refused. Other partitions are
    untouched; running twice with the same batch gives the same partitions.
    Returns the number of rows in the merged partitions.
    """
    spark = new_rows.sparkSession
    undated = F.raise_error(F.lit(f"snapshot_merge: a row has no {partition_col}"))
    dated = F.when(F.col(partition_col).isNull(), undated.cast("date")).otherwise(F.col(partition_col))
    batch = new_rows.withColumn(partition_col, dated.cast(new_rows.schema[partition_col].dataType))
    merged = batch
    if has_data(spark, path):
        batch = cut_lineage(batch)  # its dates, its keys and its rows are read: computed once
        table = read_snapshot(spark, path)
        current = table.join(batch.select(partition_col).distinct(), partition_col, "left_semi")
        kept = _with_columns_of(current, batch).join(batch.select(*key), on=list(key), how="left_anti")
        merged = kept.unionByName(_with_columns_of(batch, table))
    merged = cut_lineage(merged)
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(partition_col).parquet(path)
    return merged.count()


def evolve_table_schema(spark: SparkSession, table: str, df: DataFrame) -> list[str]:
    """``on_schema_change='append_new_columns'`` for a catalog table: add, never drop."""
    have = set(spark.table(table).columns)
    added = [f for f in df.schema.fields if f.name not in have]
    if added:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")
    return [f.name for f in added]


def clustered(df: DataFrame, cluster_by: Sequence[str]) -> DataFrame:
    """The rows in ranges of ``cluster_by``, sorted: each file written from it holds one range of the
    columns, so min/max statistics prune scans. Ranges are cut by sampled row counts,
    so a programme with a third of all rows is spread over many files."""
    return df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)


def write_clustered(df: DataFrame, path: str, cluster_by: Sequence[str], mode: str = "overwrite") -> None:
    """Full rebuild in the layout of ``clustered``."""
    clustered(df, cluster_by).write.mode(mode).parquet(path)
