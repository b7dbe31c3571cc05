"""Logical table names resolved to parquet locations or catalog tables.

The reference reaches every input through ``ref('name')``/``source(...)``;
here a ``TableRegistry`` maps those names to a parquet path or a catalog
table and returns lazy DataFrames (column pruning and filters reach the scan).
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


class TableRegistry:
    """``ref(name)``: parquet path, catalog table, or an in-memory DataFrame."""

    def __init__(self, spark: SparkSession, locations: Mapping[str, str | DataFrame] | None = None):
        self.spark = spark
        self.locations = dict(locations or {})

    def register(self, name: str, where: str | DataFrame) -> "TableRegistry":
        self.locations[name] = where
        return self

    def ref(self, name: str) -> DataFrame:
        where = self.locations.get(name)
        if where is None:
            raise KeyError(f"no location registered for table {name!r}")
        if isinstance(where, DataFrame):
            return where
        if "/" in where or where.endswith(".parquet"):
            return self.spark.read.parquet(where)
        return self.spark.table(where)

    __getitem__ = ref

    def exists(self, name: str) -> bool:
        return name in self.locations
