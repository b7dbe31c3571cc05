"""MBR snapshot: first run, gate, EUR roll-up, rates, merge idempotence (FIXTURES.md §E)."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from rollbook.context import RunContext
from rollbook.plans.mbr import (
    SNAPSHOT_COLUMNS, certification_percentages, current_rows, history_report, ongoing_programs, run_snapshot,
    summary_formulas,
)
from rollbook.sinks.snapshot import (
    FullRefreshNotAllowed, has_data, read_snapshot, should_snapshot, snapshot_merge,
)
from tests.fixtures import mbr_tables

# Friday 2025-12-05 20:00 UTC = 15:00 in New York
FRIDAY = RunContext.at("2025-12-05 20:00")


@pytest.fixture(scope="module")
def tables(spark):
    return mbr_tables(spark)


@pytest.fixture(scope="module")
def today(tables):
    return {(r.program_code, r.country, r.phase): r for r in current_rows(tables, FRIDAY).collect()}


def test_eur_rows_need_two_member_countries(today):
    eur = {k for k in today if k[1] == "EUR"}
    # PX: DEU (phase 7-12) and FRA (phase 7-12) -> one EUR row; PY only ITA -> none;
    # PZ: ESP and GBR, phase 'abc' -> one EUR row
    assert eur == {("PX", "EUR", "7-12 MO. SINCE GRADUATION"), ("PZ", "EUR", "abc")}


def test_eur_weighted_cost_and_sums(today):
    px = today[("PX", "EUR", "7-12 MO. SINCE GRADUATION")]
    assert px.admitted == 30 and px.placed_fellows == 4
    assert px.direct_beyond == 1  # sum(coalesce(null, 0) + 1)
    assert px.cost_per_placement == pytest.approx((100 * 4 + 200 * 0) / 4)
    assert px.program_nps == pytest.approx(50.0)  # avg over non-null only
    assert px.program_revenue == pytest.approx(1000.0)
    assert px.months_since_completion == "7"  # string max: '7' > '12'
    pz = today[("PZ", "EUR", "abc")]
    assert pz.cost_per_placement == pytest.approx(20.0)  # nobody placed -> plain average


def test_rates_and_phase(today):
    deu = today[("PX", "DEU", "7-12 MO. SINCE GRADUATION")]
    assert deu.placement_rate == pytest.approx(0.5) and deu.retention_rate == pytest.approx(0.8)
    assert deu.run_rate == pytest.approx(4 / (8 * 7))
    usa = today[("PX", "USA", "Ongoing")]
    assert usa.run_rate is None
    ita = today[("PY", "ITA", "0-6 MO. SINCE GRADUATION")]
    assert ita.placement_rate is None and ita.run_rate is None  # 0 enrolled, 0 months
    esp = today[("PZ", "ESP", "abc")]
    assert esp.run_rate == 0.0  # unparsable months count as 1


def test_certificates_attach_with_zero(today):
    deu = today[("PX", "DEU", "7-12 MO. SINCE GRADUATION")]
    assert deu.certification_attempted == 4 and deu.certification_received == 2
    assert deu.percent_of_graduated == pytest.approx(0.1)  # avg(coalesce(x, 0))
    assert today[("PX", "EUR", "7-12 MO. SINCE GRADUATION")].certification_attempted == 0  # Q14
    assert deu.certification_name == "Cloud Cert"
    assert deu.snapshot_date == dt.date(2025, 12, 5) and deu.mbr_reference == "December 2025"
    assert deu.last_snapshot_ts_est == dt.datetime(2025, 12, 5, 15, 0)


def test_gate():
    assert should_snapshot(FRIDAY, exists_today=False)
    assert not should_snapshot(FRIDAY, exists_today=True)
    assert should_snapshot(RunContext.at("2025-12-31 18:00"), exists_today=False)  # month end
    assert not should_snapshot(RunContext.at("2025-12-03 18:00"), exists_today=False)  # Wednesday
    assert should_snapshot(RunContext.at("2025-12-03 18:00", override=True), exists_today=True)
    # 2025-12-06 03:00 UTC is still Friday 2025-12-05 in New York
    assert should_snapshot(RunContext.at("2025-12-06 03:00"), exists_today=False)


def test_full_refresh_guard(tables):
    with pytest.raises(FullRefreshNotAllowed):
        run_snapshot(tables, RunContext.at("2025-12-05 20:00", full_refresh=True), "/nonexistent")  # not "dev" by default


def test_first_run_then_incremental(spark, tables):
    target = os.path.join(tempfile.mkdtemp(prefix="rollbook-mbr-"), "snapshot")
    assert run_snapshot(tables, FRIDAY, target)["mode"] == "initial"
    first = spark.read.parquet(target)
    # backfill months before December 2025; null snapshot_date filled with today
    assert sorted(r.mbr_reference for r in first.collect()) == ["November 2025", "October 2025"]
    assert {r.snapshot_date for r in first.collect()} == {dt.date(2025, 10, 31), dt.date(2025, 12, 5)}

    wed = RunContext.at("2025-12-03 18:00")
    assert run_snapshot(tables, wed, target)["written"] is False  # gate closed

    # today's partition already holds the backfilled November row: gate closed
    assert run_snapshot(tables, FRIDAY, target)["written"] is False
    forced = RunContext.at("2025-12-05 20:00", override=True)
    res = run_snapshot(tables, forced, target)
    assert res["written"] and res["rows_today"] == 1 + 8  # backfilled row kept + 6 base + 2 EUR
    again = run_snapshot(tables, forced, target)
    assert again["rows_today"] == 9  # same run timestamp: merge replaces, no duplicates
    later = RunContext.at("2025-12-05 21:00", override=True)
    assert run_snapshot(tables, later, target)["rows_today"] == 17  # Q11: new timestamp adds rows
    snap = spark.read.parquet(target)
    assert tuple(sorted(snap.columns)) == tuple(sorted(SNAPSHOT_COLUMNS))
    assert snap.filter("snapshot_date = date'2025-10-31'").count() == 1  # other days untouched


def test_full_refresh_in_dev_rebuilds_from_the_backfill(spark, tables):
    target = os.path.join(tempfile.mkdtemp(prefix="rollbook-mbr-"), "snapshot")
    run_snapshot(tables, FRIDAY, target)
    run_snapshot(tables, RunContext.at("2025-12-05 20:00", override=True), target)
    assert spark.read.parquet(target).count() == 2 + 8
    again = run_snapshot(tables, RunContext.at("2025-12-05 20:00", env="dev", full_refresh=True), target)
    assert again == {"mode": "full_refresh", "written": True}
    assert sorted(r.mbr_reference for r in spark.read.parquet(target).collect()) == ["November 2025", "October 2025"]


def test_empty_first_run_does_not_break_later_runs(spark, tables):
    target = os.path.join(tempfile.mkdtemp(prefix="rollbook-mbr-"), "snapshot")
    early = RunContext.at("2020-01-03 20:00")  # no backfill month lies before it
    assert run_snapshot(tables, early, target)["mode"] == "initial"
    assert not has_data(spark, target)
    assert run_snapshot(tables, FRIDAY, target)["mode"] == "initial"
    assert spark.read.parquet(target).count() == 2


def test_merge_keeps_columns_and_merges_every_day(spark):
    target = os.path.join(tempfile.mkdtemp(prefix="rollbook-merge-"), "t")
    schema = "k string, v int, extra double, snapshot_date date"
    d1, d2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
    key = ["snapshot_date", "k"]
    snapshot_merge(spark.createDataFrame([("a", 1, 2.5, d1), ("b", 2, 3.5, d1), ("c", 3, 4.5, d2)], schema), target, key)
    # a batch without ``extra``, with a late row of the first day and a new column
    late = spark.createDataFrame([("a", 9, d1, "n"), ("d", 4, d2, "n")], "k string, v int, snapshot_date date, note string")
    assert snapshot_merge(late, target, key) == 4
    got = {r.k: (r.v, r.extra, r.note) for r in read_snapshot(spark, target).collect()}
    assert got == {"a": (9, None, "n"), "b": (2, 3.5, None), "c": (3, 4.5, None), "d": (4, None, "n")}
    with pytest.raises(Exception, match="has no snapshot_date"):
        snapshot_merge(late.withColumn("snapshot_date", F.lit(None).cast("date")), target, key)
    assert read_snapshot(spark, target).count() == 4


def test_review_queries(spark, tables):
    ongoing = sorted((r.program_code, r.country) for r in ongoing_programs(tables.ref("mbr_summary")).collect())
    assert ongoing == [("PX", "USA")]
    snap = current_rows(tables, FRIDAY).unionByName(current_rows(tables, RunContext.at("2025-11-28 20:00")))
    order = [(r.snapshot_date, r.months_since_completion) for r in history_report(snap).collect()]
    assert order[0][0] == dt.date(2025, 12, 5) and order[-1][0] == dt.date(2025, 11, 28)
    months_first_day = [m for d, m in order if d == dt.date(2025, 12, 5)]
    # unparsable months sort first (NULL), then numbers ascending, 'Ongoing' (999) last
    assert months_first_day[0] == "abc" and months_first_day[-1] == "Ongoing"


def test_contract_formulas(spark):
    df = spark.createDataFrame([(10, 4, 1, 1000.0, 8, 3, 6, 5, 2), (0, 0, None, 50.0, 0, 0, 0, 0, 0)],
                               "placed_fellows long, beyond long, indirect_beyond long, program_cost double, "
                               "enrolled_or_graduated long, certification_attempted long, cert_eligible long, "
                               "certification_received long, job_transitions_with_certificate long")
    a, b = certification_percentages(summary_formulas(df)).collect()
    assert (a.placed_without_indirect, a.beyond_without_indirect) == (9, 3)
    assert a.cost_per_placement == 100.0 and a.cost_per_placement_without_beyond == pytest.approx(1000 / 6)
    assert a.percent_exam_attempted == 0.5 and a.percent_of_graduated == 5 / 8
    assert a.percent_of_job_transitions_with_certificate == 0.2
    assert b.cost_per_placement is None and b.percent_of_graduated is None
