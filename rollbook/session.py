"""Session construction and lineage cutting.

Settings follow the engine's needs: UTC session clock, ANSI casts, AQE with
skew-join splitting. Dynamic partition overwrite is set on the snapshot
writer itself, not on the session. ``spark.checkpoint.dir`` is read from the session; it is set here
only when the cluster left it unset (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "rollbook") -> SparkSession:
    """Get or create a session with the engine settings applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (idempotent)."""
    for key, value in SESSION_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder named by the cluster for checkpoints and scratch tables."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return conf


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder.

    A private folder is created only for a ``local[...]`` session without one
    (tests, laptops); on a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``, so its absence is an error.
    """
    current = checkpoint_dir(spark)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return spark.sparkContext.getCheckpointDir()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: point it at shared storage "
                           "(checkpoints and merge scratch tables are written there)")
    local = tempfile.mkdtemp(prefix="rollbook-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for a written intermediate table under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/rollbook/{name}-{os.getpid()}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the reliable checkpoint folder and return it.

    Used between the long staging and gold stages so a lost executor
    recomputes from the checkpoint, not from the raw scans.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
