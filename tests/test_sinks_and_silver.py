"""Clustered write, schema append on a catalog table, stored failures, silver builders."""

import datetime as dt
import os
import tempfile
import uuid

from pyspark.sql import functions as F

from rollbook.plans.bronze import meeting_instance_dim, participant_fact
from rollbook.quality import store_failures, unique
from rollbook.sinks.snapshot import evolve_table_schema, write_clustered


def test_write_clustered_groups_programmes(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="rollbook-cluster-"), "gold")
    df = spark.createDataFrame([(p, f"t{i}") for i in range(20) for p in ("A", "B", "C")],
                               "program_code string, lesson_title string")
    write_clustered(df, path, ["program_code", "lesson_title"])
    back = spark.read.parquet(path).withColumn("f", F.input_file_name())
    # every programme's rows sit together in one file (files may hold several programmes)
    per_prog = back.groupBy("program_code").agg(F.count_distinct("f").alias("n")).collect()
    assert all(r.n == 1 for r in per_prog) and back.count() == 60


def test_append_new_columns_on_table(spark):
    name = f"rb_evolve_{uuid.uuid4().hex[:8]}"
    loc = tempfile.mkdtemp(prefix="rollbook-tbl-")
    spark.sql(f"CREATE TABLE {name} (a BIGINT, b STRING) USING parquet LOCATION '{loc}'")
    try:
        new = spark.createDataFrame([(1, "x", 2.5)], "a long, b string, c double")
        assert evolve_table_schema(spark, name, new) == ["c"]
        assert evolve_table_schema(spark, name, new) == []  # idempotent, never drops
        assert spark.table(name).columns == ["a", "b", "c"]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_store_failures_with_limit(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="rollbook-fail-"), "cpl")
    df = spark.range(100).withColumn("k", F.col("id") % 10)
    store_failures(unique(df, ["k"]), path, limit=5)
    assert spark.read.parquet(path).count() == 5


def test_participant_fact_and_instance_dim(spark):
    parts = spark.createDataFrame([
        ("i1", "p1", " Ann@X.org ", dt.datetime(2025, 1, 1, 10), dt.datetime(2025, 1, 1, 10, 30)),
        ("i1", "p2", "bob@x.org", dt.datetime(2025, 1, 1, 10), dt.datetime(2025, 1, 1, 10, 0, 59)),
        ("i2", "p3", "nobody@x.org", dt.datetime(2025, 1, 2, 10), dt.datetime(2025, 1, 2, 11)),
    ], "meeting_instance_id string, participant_meeting_instance_id string, user_email string, "
       "join_time timestamp_ntz, leave_time timestamp_ntz")
    users = spark.createDataFrame([("ann@x.org", "u1"), ("bob@x.org", "u2")],
                                  "email string, primary_user_service_id string")
    fact = {r.participant_meeting_instance_id: r for r in participant_fact(parts, users).collect()}
    assert fact["p1"].primary_user_service_id == "u1" and fact["p1"].duration == 1800
    assert fact["p2"].duration == 59 and fact["p3"].primary_user_service_id is None
    assert fact["p1"].user_email == " Ann@X.org "  # original kept for verification
    inst = spark.createDataFrame([
        ("i1", dt.datetime(2025, 1, 1, 5), dt.datetime(2025, 1, 1, 6), "America/New_York"),
        ("i3", dt.datetime(2025, 1, 3, 5), dt.datetime(2025, 1, 3, 5, 30), "UTC"),
    ], "meeting_instance_id string, start_time timestamp, end_time timestamp, tz string")
    dim = {r.meeting_instance_id: r for r in meeting_instance_dim(inst, parts, tz_col="tz").collect()}
    assert dim["i1"].participants_count == 2 and dim["i3"].participants_count == 0
    assert dim["i1"].start_time == dt.datetime(2025, 1, 1, 10) and dim["i1"].meeting_duration_seconds == 3600
