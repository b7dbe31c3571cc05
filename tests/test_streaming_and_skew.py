"""The daily merge driven by Structured Streaming, and islands on a hot key."""

import datetime as dt
import os
import random
import tempfile

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from rollbook.operators import intervals
from rollbook.operators.intervals import _entries, hull_intervals, islands
from rollbook.streaming import snapshot_sink
from tests.conftest import rows_of
from tests.test_intervals import ISLANDS_SQL


def test_snapshot_sink_foreach_batch(spark):
    base = tempfile.mkdtemp(prefix="rollbook-stream-")
    src, target, ckpt = (os.path.join(base, p) for p in ("src", "target", "ckpt"))
    day = dt.date(2025, 12, 5)
    rows = [("P1", "DEU", 10, dt.datetime(2025, 12, 5, 15)), ("P1", "FRA", 20, dt.datetime(2025, 12, 5, 15))]
    df = spark.createDataFrame(rows, "program_code string, country string, admitted long, "
                                     "last_snapshot_ts_est timestamp_ntz").withColumn("snapshot_date", F.lit(day))
    df.write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    key = ["snapshot_date", "program_code", "country", "last_snapshot_ts_est"]
    q = (stream.writeStream.foreachBatch(snapshot_sink(target, key))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    df.write.mode("append").parquet(src)  # same rows again: the merge keeps one copy per key
    q = (stream.writeStream.foreachBatch(snapshot_sink(target, key))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.parquet(target)
    assert sorted((r.country, r.admitted) for r in out.collect()) == [("DEU", 10), ("FRA", 20)]


def test_islands_hot_key_spans_many_buckets(spark):
    """One key holds nearly all rows; its borders split it over some 70 window partitions."""
    rnd = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        k1 = 0 if i < 2900 else rnd.randrange(1, 4)
        s = base + dt.timedelta(seconds=rnd.randrange(0, 86400))
        rows.append((k1, "m", "x", i, s, s + dt.timedelta(seconds=rnd.choice([0, 30, 120, 900, 3600]))))
    pdf = pd.DataFrame(rows, columns=["k1", "k2", "lab", "id", "s", "e"])
    expected = duckdb.query_df(pdf, "s", ISLANDS_SQL).df()
    sdf = spark.createDataFrame(pdf, "k1 long, k2 string, lab string, id long, s timestamp_ntz, e timestamp_ntz")
    got = islands(sdf, ["k1", "k2"], "s", "e", "id", bucket_rows=40)
    cols = ["k1", "k2", "island_start", "island_end", "n_sessions"]
    assert rows_of(got, cols) == rows_of(expected, cols)


def test_hull_spreads_a_key_with_a_third_of_the_rows_inside_one_hour(spark):
    """Borders follow the rows: no bucket holds more than a few times its share, and the rows stay right."""
    rnd = random.Random(8)
    base = dt.datetime(2024, 1, 1, 9)
    rows = []
    for i in range(6000):
        k1 = 0 if i % 3 == 0 else i
        s = base + dt.timedelta(seconds=rnd.randrange(3600), microseconds=i)
        rows.append((k1, "m", rnd.choice("xyz"), i, s, s + dt.timedelta(seconds=rnd.choice([0, 5, 60, 600]))))
    pdf = pd.DataFrame(rows, columns=["k1", "k2", "lab", "id", "s", "e"])
    sdf = spark.createDataFrame(pdf, "k1 long, k2 string, lab string, id long, s timestamp_ntz, e timestamp_ntz")
    args = (["k1", "k2"], ["lab"], "s", "e", "id")
    deep = [r.n for r in _entries(sdf, *args, bucket_rows=50).filter("k1 = 0").select(F.size("entries").alias("n")).collect()]
    assert len(deep) >= 20 and max(deep) <= 500  # 2,000 sessions, most of them in two buckets
    cols = ["k1", "k2", "lab", "join_time", "leave_time"]
    got = hull_intervals(sdf, ["k1", "k2"], "s", "e", "id", labels=["lab"], bucket_rows=50)
    whole = hull_intervals(sdf, ["k1", "k2"], "s", "e", "id", labels=["lab"], bucket_rows=10**9)
    assert rows_of(got, cols) == rows_of(whole, cols)


def test_hull_thins_borders_of_a_giant_key(spark, monkeypatch):
    monkeypatch.setattr(intervals, "MOST_BORDERS", 4)
    base = dt.datetime(2024, 1, 1)
    rows = [(1, "m", "x", i, base + dt.timedelta(minutes=i), base + dt.timedelta(minutes=i + i % 90)) for i in range(400)]
    sdf = spark.createDataFrame(rows, "k1 long, k2 string, lab string, id long, s timestamp_ntz, e timestamp_ntz")
    buckets = _entries(sdf, ["k1", "k2"], ["lab"], "s", "e", "id", bucket_rows=10).select("__bucket").distinct().count()
    assert 2 <= buckets <= 6
    cols = ["k1", "k2", "lab", "join_time", "leave_time"]
    got, whole = (hull_intervals(sdf, ["k1", "k2"], "s", "e", "id", labels=["lab"], bucket_rows=n) for n in (10, 10**9))
    assert rows_of(got, cols) == rows_of(whole, cols)
