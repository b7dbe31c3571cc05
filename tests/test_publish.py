"""Tables tested while they are written, and the published attendance products."""

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

from rollbook.context import RunContext
from rollbook.plans import attendance, mbr
from rollbook.quality import Check, CheckFailed, checked_write, parse_test_name, run_checks, test_name as name_of
from tests.conftest import rows_of
from tests.fixtures import attendance_tables, mbr_tables

CTX = RunContext.at("2025-01-22 12:00")


def _write(spark, df, checks, base, run_id="r1", **options):
    return checked_write(df, lambda f: f.write.mode("overwrite").parquet(f"{base}/t"), lambda: spark.read.parquet(f"{base}/t"),
                         checks, f"{base}/log", run_id, F.lit("2025-01-22 12:00:00").cast("timestamp"),
                         failures_path=f"{base}/bad", **options)


def _checks():
    return [
        Check("tst_t__v", column="v", broken=F.col("v") < 0, where="k <> 'c'", context=["k"]),
        Check("cpl_t__v", column="v", broken=F.col("v").isNull(), severity="error", warn_if=">10", error_if=">=50", unit="percent"),
        Check("tst_t", column="k", key=["k"], quality_dimension="uniqueness"),
        Check("tst_t__n", column="k,v", key=["k", "v"], quality_dimension="uniqueness", where="v IS NOT NULL"),
    ]


def test_checked_write_logs_and_stores_failures(spark, tmp_path):
    base = str(tmp_path)
    rows = [("a", -1), ("a", 2), ("b", None), ("c", -5), ("c", -5), ("d", 1)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(3)
    log = {r.test_name: (r.failures, r.status) for r in _write(spark, df, _checks(), base).collect()}
    assert log == {"tst_t__v": (1, "warn"), "cpl_t__v": (1, "warn"), "tst_t": (2, "warn"), "tst_t__n": (1, "warn")}
    assert rows_of(spark.read.parquet(f"{base}/t")) == rows_of(df)
    assert [tuple(r) for r in spark.read.parquet(f"{base}/bad/tst_t__v").collect()] == [("a",)]
    assert sorted(r.k for r in spark.read.parquet(f"{base}/bad/tst_t").collect()) == ["a", "c"]
    # an error is raised after the log is written; the limit bounds what is stored
    worse = spark.createDataFrame([("a", None)] * 5 + [("b", 1)], "k string, v int")
    with pytest.raises(CheckFailed, match="cpl_t__v"):
        _write(spark, worse, _checks(), base, "r2", limit=2)
    assert spark.read.parquet(f"{base}/bad/cpl_t__v").count() == 2
    runs = spark.read.parquet(f"{base}/log")
    assert runs.count() == 8 and runs.filter("run_id = 'r2' AND test_name = 'cpl_t__v'").first().failures == 5
    # an empty table passes
    assert {r.status for r in _write(spark, df.limit(0), _checks(), base, "r3").collect()} == {"pass"}


def test_all_checks_of_a_table_share_one_scan(spark, tmp_path):
    spark.range(50).selectExpr("id % 7 AS a", "id % 11 AS b", "id").write.parquet(str(tmp_path / "x"))
    df = spark.read.parquet(str(tmp_path / "x"))
    checks = [Check(f"tst_x__{i}", rows=df, key=k) for i, k in enumerate((["a"], ["b"], ["a", "b"], ["id"], ["b", "a"]))]
    checks.append(Check("tst_x__six", rows=df, broken=F.col("a") == 6))
    log = run_checks(checks)
    assert [(r.test_name[-3:], r.failures) for r in sorted(log.collect())] == [
        ("__0", 7), ("__1", 11), ("__2", 0), ("__3", 0), ("__4", 0), ("six", 7)]
    assert log._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("FileScan") == 1
    assert {r.failures for r in run_checks([Check(c.name, rows=df.limit(0), key=c.key, broken=c.broken)
                                            for c in checks]).collect()} == {0}


def test_names_of_tests():
    assert name_of("general", "attendance", "program_code") == "tst_attendance__program_code"
    assert parse_test_name("cpl_generic__program_code") == {
        "kind": "compliance", "level": "column", "subject": "generic", "column": "program_code"}
    assert parse_test_name("cpl_slv_meetings__program_code")["subject"] == "slv_meetings"
    assert parse_test_name("tst_ops")["level"] == "model"
    with pytest.raises(ValueError):
        parse_test_name("check_ops")


def test_publish_writes_both_tables_and_logs(spark, tmp_path):
    tables, base = attendance_tables(spark), str(tmp_path)
    got = attendance.publish(tables, CTX, f"{base}/staging", f"{base}/gold", staging_table=f"staging_{uuid.uuid4().hex}")
    assert rows_of(got) == rows_of(attendance.gold(tables, CTX))
    assert got.columns == list(attendance.GOLD_COLUMNS)
    log = {r.test_name: (r.failures, r.status) for r in spark.read.parquet(f"{base}/gold_log").collect()}
    assert set(log) == {c.name for c in attendance.gold_checks()}
    duplicates = got.groupBy(*attendance.GOLD_KEY).count().filter("count > 1").count()
    assert log["tst_attendance__primary_key"] == (duplicates, "warn" if duplicates else "pass")


def test_gold_reads_written_staging_without_an_exchange(spark, tmp_path):
    tables, name = attendance_tables(spark), f"staging_{uuid.uuid4().hex}"
    staged = attendance.write_staging(attendance.staging(tables, CTX), str(tmp_path / "s"), name, 8)
    assert rows_of(staged) == rows_of(attendance.staging(tables, CTX))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with attendance.partial_key_joins(spark):
            plan = attendance.gold(tables, CTX, staged=staged, buckets=8)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    lines = plan.splitlines()
    depth = lambda line: len(re.match(r"[ :]*", line).group())
    above = []
    for at, line in enumerate(lines):
        if name in line:
            path, now = [], depth(line)
            for other in reversed(lines[:at]):
                if depth(other) < now:
                    path.append(other)
                    now = depth(other)
            above.append(path)
    # staging is read twice: its distinct days and titles are shuffled after a partial aggregate, its rows are not moved
    # up to the aggregate behind the join to the participants' lessons
    assert len(above) == 2, plan
    rows = [p[:next(i for i, x in enumerate(p) if "max(" in x) + 1] for p in above]
    still = [p for p in rows if not any("Exchange" in x for x in p)]
    assert len(still) == 1 and any("SortMergeJoin" in x for x in still[0]), rows
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_snapshot_runs_log_their_primary_key(spark, tmp_path):
    tables = mbr_tables(spark)
    target, log = str(tmp_path / "snap"), str(tmp_path / "log")
    mbr.run_snapshot(tables, RunContext.at("2025-12-04 20:00"), target, log_path=log)  # backfill
    friday = RunContext(now_utc=dt.datetime(2025, 12, 5, 20, tzinfo=dt.timezone.utc))
    assert mbr.run_snapshot(tables, friday, target, log_path=log)["written"]
    got = {r.test_name: r.status for r in spark.read.parquet(log).collect()}
    assert got["tst_mbr_snapshot__primary_key"] == "pass" and len(got) == 4
    # a programme and country that stand twice in the summary break the key
    tables.register("mbr_summary", tables.ref("mbr_summary").unionByName(tables.ref("mbr_summary")))
    again = RunContext(now_utc=dt.datetime(2025, 12, 12, 20, tzinfo=dt.timezone.utc))
    with pytest.raises(CheckFailed, match="primary_key"):
        mbr.run_snapshot(tables, again, target, log_path=log, severity="error", run_id="x")
    assert spark.read.parquet(log).filter("run_id = 'x' AND status = 'fail'").count() >= 1
