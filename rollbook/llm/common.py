"""Helpers shared by the training-data operators: tables, scratch tables, words.

Intermediate results that are read more than once are written as Parquet below
``spark.checkpoint.dir`` and read back. The written table cuts the lineage (a
lost executor re-reads files instead of recomputing the scan) and, unlike a
cached frame, it has a known size, so Catalyst plans the joins on it by size.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from rollbook.session import ensure_checkpoint_dir

#: Fixed: the characters between words in every contract (space and \x09-\x0D).
BLANKS = r"[\x20\x09-\x0D]+"

#: Bytes of rows that a Python worker is handed at once (a longer row is handed alone).
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; never reused, so a rerun finds no old rows."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/rollbook-llm/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a frame that reads it."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """Like ``materialise``, in buckets of ``key`` (as many as shuffle partitions): groups and joins by ``key``
    read the rows where they lie, without a shuffle. The table's entry stays in the session's catalog."""
    spark = df.sparkSession
    entry = f"rollbook_{name.replace('-', '_')}_{uuid.uuid4().hex}"
    df.write.format("parquet").option("path", scratch(spark, name)) \
        .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).saveAsTable(entry)
    return spark.table(entry)


def dealt(df: DataFrame, key: str | list[str], *order: Column | str) -> DataFrame:
    """The rows of a key in one partition, one key after the other, each in the given order; readers stream them."""
    keys = [key] if isinstance(key, str) else key
    return df.repartition(*keys).sortWithinPartitions(*keys, *order)


def nullable(schema: StructType) -> StructType:
    """The schema with every column nullable: what Python makes may hold nulls."""
    return StructType([StructField(f.name, f.dataType, True) for f in schema])


def ship(spark: SparkSession) -> None:
    """Ready the session for Python in tasks: Arrow batches of at most ``BATCH_BYTES``, so that long texts do not pile
    up in a worker, and, once per application, this package's source on the executors (their Python may not have it)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if getattr(context, "_rollbook_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="rollbook-src-"), "rollbook_src.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("rollbook", os.path.relpath(full, root)))
    context.addPyFile(path)
    context._rollbook_shipped = True


def words(text: Column) -> Column:
    """The words of a whole text as an array (null or empty text: no words)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


class Remembered(dict):
    """A bounded table of a worker: at most two generations of about ``limit`` bytes each, and a batch.

    When the younger generation is full it becomes the older one; entries that
    are asked for again move over, so frequent ones stay and rare ones go.
    """

    #: Bytes of an entry besides its text and what is kept for it, and of the latter for each character.
    ENTRY, CHARACTER = 200, 6

    def __init__(self, limit: int) -> None:
        super().__init__()
        self.limit, self.older, self.size = limit, {}, 0

    def missing(self, keys: set, same_batch: bool = False) -> list:
        """The ``keys`` that neither generation holds; the others are in the younger one afterwards."""
        if self.size > self.limit and not same_batch:
            self.older = dict(self)
            self.clear()
            self.size = 0
        older, out, moved = self.older, [], 0
        for key in keys:
            if key not in self:
                if key in older:
                    self[key] = older[key]
                    moved += len(key)
                else:
                    out.append(key)
        before = len(self)
        self.size = max(self.size, self.ENTRY * (before + len(out))) + self.CHARACTER * (moved + sum(map(len, out)))
        return out
