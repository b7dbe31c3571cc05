"""Data tests, contracts, JSON extraction and bronze/silver helpers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.functions.json import json_bool, json_query, json_scalar
from rollbook.functions.safe import safe_int, seconds_between
from rollbook.functions.text import is_staff_email
from rollbook.operators.dims import latest_per_key
from rollbook.operators.grid import expand_date_range
from rollbook.operators.status import phase_bucket
from rollbook.operators.weeks import week_spine
from rollbook.plans.bronze import bronze_extract, host_dim, latest_batch, valid_meetings
from rollbook.quality import Check, ContractError, append_log, conform, format_check, not_null, run_checks, unique


def test_format_check_reasons(spark):
    codes = ["ABCD-EFGH-123", None, "ABCDEFGH123", "abcd-EFGH-123", "ABCD-EFG-123", "ABCD-EFGH-12",
             "xxABCD-EFGH-123zz", "ab12-EFG-123"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "id int, program_id string")
    got = {r.id: r.failure_reason for r in format_check(df, "program_id", ["id"]).collect()}
    # The segment patterns are unanchored: in 'abcd-EFGH-123' the first-segment
    # test matches 'EFGH-', so the reason falls through to 'Unknown format issue'.
    assert got == {1: "NULL value", 2: "Missing hyphens", 3: "Unknown format issue",
                   4: "Second segment not 4 uppercase letters", 5: "Third segment not 3 digits",
                   7: "First segment not 4 uppercase letters"}


def test_thresholds_and_severity(spark):
    df = spark.range(100).withColumn("k", F.when(F.col("id") < 20, F.lit(1)).otherwise(F.col("id")))
    checks = [
        Check("dup_warn", lambda: unique(df, ["k"]), "k", severity="warn", warn_if=">10", error_if=">=70"),
        Check("nulls", lambda: not_null(df, "k"), "k"),
        Check("pct_error", lambda: df.filter("id < 75"), "id", severity="error", warn_if=">10",
              error_if=">=70", unit="percent", total=lambda: df),
        Check("rows_warn", lambda: df.filter("id < 20"), "id", severity="error", warn_if=">10",
              error_if=">=70"),
    ]
    got = {r.test_name: (r.failures, r.status) for r in run_checks(checks).collect()}
    assert got == {"dup_warn": (1, "pass"), "nulls": (0, "pass"), "pct_error": (75, "fail"),
                   "rows_warn": (20, "warn")}


def test_conform_contract(spark):
    df = spark.createDataFrame([(1, "2025-01-02", "x")], "a int, d string, extra string")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("d", T.DateType())])
    out = conform(df, schema, cast=True)
    assert out.schema == schema and out.first().d == dt.date(2025, 1, 2)
    with pytest.raises(ContractError):
        conform(df, schema)
    with pytest.raises(ContractError):
        conform(df.drop("d"), schema, cast=True)


def test_json_value_semantics(spark):
    df = spark.createDataFrame([
        ('{"is_required": false}',), ('{"is_required": "TRUE"}',), ('{"is_required": {"x": 1}}',),
        (None,), ('not json',), ('{"is_required": "yes"}',), ('{"optional": "true"}',)], "o string")
    got = [(r.v, r.b) for r in df.select(json_scalar("o", "$.is_required").alias("v"),
                                         json_bool("o", "$.is_required", strict=False).alias("b")).collect()]
    assert got == [("false", False), ("TRUE", True), (None, None), (None, None), (None, None),
                   ("yes", None), (None, None)]
    with pytest.raises(Exception, match="not a boolean: yes"):  # the warehouse's cast raises
        df.select(json_bool("o", "$.is_required")).collect()


def test_staff_email_filter(spark):
    df = spark.createDataFrame([("a@company.com",), ("Company Test <t@x.io>",), ("me+test3@x.io",),
                                ("a@internal.com",), ("ann@companyx.com",), (None,)], "e string")
    flags = [r.f for r in df.select(is_staff_email("e").alias("f")).collect()]
    assert flags == [True, True, True, True, False, None]


def test_phase_bucket_values(spark):
    vals = ["Ongoing", "0", "6", "7", "12", "13", "18", "19", "-1", "abc", None]
    df = spark.createDataFrame([(v,) for v in vals], "m string")
    got = [r.p for r in df.select(phase_bucket(F.col("m")).alias("p")).collect()]
    assert got == ["Ongoing", "0-6 MO. SINCE GRADUATION", "0-6 MO. SINCE GRADUATION",
                   "7-12 MO. SINCE GRADUATION", "7-12 MO. SINCE GRADUATION", "13-18 MO. SINCE GRADUATION",
                   "13-18 MO. SINCE GRADUATION", "Concluded", "-1", "abc", None]
    assert df.select(safe_int(F.col("m")).alias("i")).first().i is None


def test_week_spine_edges(spark):
    p = spark.createDataFrame([
        ("A", dt.datetime(2025, 1, 5), dt.datetime(2025, 1, 6)),   # Sunday -> Monday: 2 weeks
        ("B", dt.datetime(2025, 2, 1), dt.datetime(2025, 1, 1)),   # ends before it starts: none
        ("C", None, dt.datetime(2025, 1, 1)),                        # null start: none
    ], "p string, s timestamp_ntz, e timestamp_ntz")
    rows = sorted((r.p, r.week_start_date, r.week_end_date, r.week_number)
                  for r in week_spine(p, "p", "s", "e").collect())
    assert rows == [("A", dt.date(2024, 12, 30), dt.date(2025, 1, 5), 1),
                    ("A", dt.date(2025, 1, 6), dt.date(2025, 1, 12), 2)]


def test_expand_date_range_edges(spark):
    df = spark.createDataFrame([(1, dt.date(2025, 1, 1), dt.date(2025, 1, 3)),
                                (2, dt.date(2025, 1, 3), dt.date(2025, 1, 1)), (3, None, dt.date(2025, 1, 1))],
                               "k int, s date, e date")
    got = sorted((r.k, r.d) for r in expand_date_range(df, "s", "e", "d").collect())
    assert got == [(1, dt.date(2025, 1, 1)), (1, dt.date(2025, 1, 2)), (1, dt.date(2025, 1, 3))]


def test_latest_per_key_ties_and_nulls(spark):
    df = spark.createDataFrame([
        ("f", "e", dt.date(2025, 1, 1), dt.datetime(2025, 1, 1, 9), "a"),
        ("f", "e", dt.date(2025, 1, 1), dt.datetime(2025, 1, 1, 9), "b"),   # tie: larger reason wins
        ("f", "e", dt.date(2025, 1, 2), None, "c"),
        ("f", "e", dt.date(2025, 1, 2), dt.datetime(2025, 1, 1, 8), "d"),   # non-null beats null
    ], "form string, email string, day date, ts timestamp_ntz, reason string")
    got = sorted((r.day, r.reason) for r in latest_per_key(df, ["form", "email", "day"], ["ts"],
                                                           ["reason"]).collect())
    assert got == [(dt.date(2025, 1, 1), "b"), (dt.date(2025, 1, 2), "d")]


def test_seconds_truncate(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 1, 1, 0, 0, 0, 900000), dt.datetime(2025, 1, 1, 0, 0, 2, 100000))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(seconds_between("a", "b").alias("s")).first().s == 1


def test_bronze_and_silver(spark):
    landing = spark.createDataFrame([
        ("meetings", '{"id": "m1", "duration": 45, "topic": {"t": 1}}', dt.date(2025, 1, 1)),
        ("meetings", '{"id": "m1", "duration": 50}', dt.date(2025, 1, 2)),
        ("meetings", '{"id": "m2", "duration": "bad"}', dt.date(2025, 1, 2)),
        ("users", '{"id": "h1"}', dt.date(2025, 1, 2)),
    ], "endpoint_url string, data string, execution_date date")
    b = bronze_extract(landing, "meetings", {"id": ("$.id", "string"), "duration": ("$.duration", "int"),
                                             "topic": ("$.topic", "string")})
    assert b.count() == 3
    latest = sorted((r.id, r.duration, r.topic) for r in latest_batch(b).collect())
    assert latest == [("m1", 50, None), ("m2", None, None)]

    inst = spark.createDataFrame([("i1", "P", 3600), ("i2", "P", 1000), ("i3", "P", 3600)],
                                 "meeting_instance_id string, program_code string, meeting_duration_seconds long")
    parts = spark.createDataFrame([("i1", "u1"), ("i1", "u2"), ("i2", "u1"), ("i2", "u2"), ("i3", "u1")],
                                  "meeting_instance_id string, primary_user_service_id string")
    fellows = spark.createDataFrame([("P", "u1"), ("P", "u2"), ("P", "u3"), ("P", "u4")],
                                    "program_code string, primary_user_service_id string")
    ok = sorted(r.meeting_instance_id for r in valid_meetings(inst, parts, fellows).collect())
    assert ok == ["i1"]  # i2 too short, i3 only 25 % of fellows

    hosts = spark.createDataFrame([("h1", dt.date(2025, 1, 1), 1, "old"), ("h1", dt.date(2025, 1, 2), 1, "new")],
                                  "host_id string, execution_date date, updated_at int, email string")
    assert [r.email for r in host_dim(hosts).collect()] == ["new"]


def test_json_query_subdocuments(spark):
    df = spark.createDataFrame([('{"a": {"b": [1, 2]}, "s": "x"}',), ("bad",), (None,)], "d string")
    got = [(r.o, r.s, r.m) for r in df.select(json_query("d", "$.a").alias("o"), json_query("d", "$.s").alias("s"),
                                              json_query("d", "$.zz").alias("m")).collect()]
    assert got == [('{"b":[1,2]}', '"x"', None), (None, None, None), (None, None, None)]
    landing = spark.createDataFrame([("polls", '{"id": "p1", "questions": [{"q": 1}]}', dt.date(2025, 1, 1))],
                                    "endpoint_url string, data string, execution_date date")
    row = bronze_extract(landing, "polls", {"id": ("$.id", "string"), "questions": ("$.questions", "json")}).first()
    assert row.questions == '[{"q":1}]'
    with pytest.raises(ValueError):
        Check("x", lambda: landing, quality_dimension="speed")


def test_row_checks_share_a_scan_with_where_and_context(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("b", None, None)], "g string, n int, t string")
    checks = [Check("t_known", rows=df, broken=F.col("t").isNull(), column="t", quality_dimension="completeness",
                    where="g = 'a'", context=["n"]),
              Check("n_known", rows=df, broken=F.col("n").isNull(), column="n", unit="percent", warn_if=">50"),
              Check("g_known", rows=df, broken=F.col("g").isNull())]
    assert [tuple(r) for r in checks[0].failures().collect()] == [(1,)]
    got = {r.test_name: (r.failures, r.status) for r in run_checks(checks).collect()}
    assert got == {"t_known": (1, "warn"), "n_known": (1, "warn"), "g_known": (0, "pass")}
    log = str(tmp_path / "log")
    for run in ("r1", "r2"):
        append_log(run_checks(checks), log, run, F.lit(dt.datetime(2025, 1, 1)))
    assert spark.read.parquet(log).groupBy("run_id").count().count() == 2 and spark.read.parquet(log).count() == 6
    with pytest.raises(ValueError):
        Check("neither")
