"""Monthly business review (MBR) snapshot: an incremental, day-partitioned history.

Logical tables: ``mbr_summary`` (one row per programme and country),
``programs`` (certificate name), ``cert_updates`` (certification counts),
``mbr_backfill`` (first-run history sheet, PascalCase columns) and the
target snapshot itself (a parquet path, partitioned by ``snapshot_date``).

Run order (``run_snapshot``):

1. refuse a full refresh outside dev;
2. first run (no data in the target yet) or full refresh in dev: write the
   backfill history, all partitions;
3. later runs: evaluate the gate on the driver first (override, or Friday or
   month end with no snapshot yet today; the existence probe reads one
   partition) and start no heavy job when it is closed;
4. build today's rows (summary + EUR roll-up + certificates + rates) and
   merge them into today's partition only.

All aggregates are partial/final hash aggregates; the EUR member list is a
literal, dimension joins are left to the size-aware planner, the certification
table is pre-aggregated to one row per (programme, country) before its join.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.context import RunContext
from rollbook.functions.dates import format_month, month_start, parse_month
from rollbook.functions.safe import safe_divide
from rollbook.operators.rollup import regional_rollup, weighted_avg_or_avg
from rollbook.operators.status import phase_bucket, placement_rate, retention_rate, run_rate
from rollbook.quality import Check, CheckFailed, append_log, conform, run_checks, test_name
from rollbook.sinks.snapshot import (
    guard_full_refresh, has_data, read_snapshot, should_snapshot, snapshot_exists, snapshot_merge,
)
from rollbook.sources.tables import TableRegistry

# Fixed values that must equal the reference's.
EUROPEAN_COUNTRIES = ("DEU", "ESP", "FRA", "GBR", "ITA")
EUROPE_CODE = "EUR"
MERGE_KEY = ("snapshot_date", "program_code", "country", "last_snapshot_ts_est")

_INT = T.LongType()
_DBL = T.DoubleType()
_STR = T.StringType()
_DATE = T.DateType()
# Output contract, in column order (name, type).
SNAPSHOT_CONTRACT = T.StructType([T.StructField(n, t) for n, t in [
    ("snapshot_date", _DATE), ("mbr_reference", _STR), ("phase", _STR), ("program_name", _STR),
    ("program_code", _STR), ("country", _STR), ("start_date", _DATE), ("end_date", _DATE),
    ("months_since_completion", _STR), ("admitted", _INT), ("enrolled_or_graduated", _INT),
    ("dropped_out", _INT), ("placed_fellows", _INT), ("beyond", _INT), ("direct_beyond", _INT),
    ("indirect_beyond", _INT), ("internal_hire", _INT), ("external_qualifying", _INT),
    ("internal_training", _INT), ("placement_rate", _DBL), ("retention_rate", _DBL), ("run_rate", _DBL),
    ("certification_name", _STR), ("certification_attempted", _INT), ("certification_received", _INT),
    ("percent_exam_attempted", _DBL), ("percent_of_graduated", _DBL),
    ("job_transitions_with_certificate", _INT), ("percent_of_job_transitions_with_certificate", _DBL),
    ("external_qualifying_with_certificate", _INT), ("internal_hire_with_certificate", _INT),
    ("beyond_with_certificate", _INT), ("internal_training_with_certificate", _INT),
    ("cert_eligible", _INT), ("program_revenue", _DBL), ("cost_per_placement", _DBL),
    ("cost_per_placement_without_beyond", _DBL), ("program_nps", _DBL),
    ("placed_without_indirect", _INT), ("beyond_without_indirect", _INT),
    ("last_snapshot_ts_est", T.TimestampNTZType()),
]])
SNAPSHOT_COLUMNS = tuple(f.name for f in SNAPSHOT_CONTRACT.fields)

# Backfill sheet column -> snapshot column (columns not listed keep their name).
BACKFILL_RENAMES = {
    "Phase": "phase", "Program_name": "program_name", "Program_Code": "program_code",
    "Country": "country", "Start_date": "start_date", "End_Date": "end_date",
    "Months_Since_Completion": "months_since_completion", "Admitted": "admitted",
    "Enrolled": "enrolled_or_graduated", "Dropped_Out": "dropped_out",
    "Placed_Fellows": "placed_fellows", "Beyond": "beyond", "Internal_Hire": "internal_hire",
    "External_Qualifying": "external_qualifying", "Internal_Training": "internal_training",
    "Placement_Rate": "placement_rate", "Retention_Rate": "retention_rate", "Run_Rate": "run_rate",
    "Certificate_Name": "certification_name", "Certification_Attempted": "certification_attempted",
    "Certification_Received": "certification_received", "Percent_Exam_Attempted": "percent_exam_attempted",
    "Percent_Of_Graduated": "percent_of_graduated",
    "Job_transitions_with_Certificate": "job_transitions_with_certificate",
    "Percent_Of_Job_transitions_with_Certificate": "percent_of_job_transitions_with_certificate",
    "External_Qualifying_with_Certificate": "external_qualifying_with_certificate",
    "Internal_Hire_with_Certificate": "internal_hire_with_certificate",
    "Beyond_with_Certificate": "beyond_with_certificate",
    "Internal_Training_with_Certificate": "internal_training_with_certificate",
    "Cert_Eligible": "cert_eligible", "Program_Revenue": "program_revenue",
    "Cost_Per_Placement": "cost_per_placement",
    "Cost_Per_Placement_Without_Beyond": "cost_per_placement_without_beyond",
    "Program_NPS": "program_nps",
}
_BACKFILL_NULLS = ("direct_beyond", "indirect_beyond", "placed_without_indirect", "beyond_without_indirect")

_CERT_SUMS = ("certification_attempted", "certification_received", "cert_eligible",
              "job_transitions_with_certificate", "external_qualifying_with_certificate",
              "internal_hire_with_certificate", "beyond_with_certificate",
              "internal_training_with_certificate")
_CERT_AVGS = ("percent_exam_attempted", "percent_of_graduated",
              "percent_of_job_transitions_with_certificate")


def history_baseline(t: TableRegistry, ctx: RunContext, target: str | None) -> DataFrame:
    """Earlier months: the target itself on incremental runs, else the backfill sheet."""
    if target and has_data(t.spark, target):
        hist = read_snapshot(t.spark, target)
        for f in SNAPSHOT_CONTRACT.fields:
            if f.name not in hist.columns:
                hist = hist.withColumn(f.name, F.lit(None).cast(f.dataType))
    else:
        sheet = t.ref("mbr_backfill")
        hist = sheet.withColumnsRenamed({k: v for k, v in BACKFILL_RENAMES.items() if k in sheet.columns})
        for c in _BACKFILL_NULLS:
            hist = hist.withColumn(c, F.lit(None).cast(_INT))
    hist = hist.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SNAPSHOT_CONTRACT.fields])
    return hist.filter(parse_month(F.col("mbr_reference")) < month_start(ctx.as_of()))


def summary_base(t: TableRegistry, ctx: RunContext) -> DataFrame:
    s = t.ref("mbr_summary")
    air = t.ref("programs").select(F.col("program_code").alias("__air_pc"), "sponsored_industry_certification")
    j = s.join(air, s["program_code"] == air["__air_pc"], "left")
    return j.select(
        ctx.as_of().alias("snapshot_date"), format_month(ctx.as_of()).alias("mbr_reference"),
        phase_bucket(F.col("months_since_completion")).alias("phase"),
        F.col("client_program_name").alias("program_name"), "program_code", "country", "start_date",
        "end_date", "months_since_completion", "admitted", "enrolled_or_graduated", "dropped_out",
        "placed_fellows", "beyond", "direct_beyond", "indirect_beyond", "internal_hire",
        "external_qualifying", "internal_training",
        F.col("sponsored_industry_certification").alias("certification_name"),
        "program_revenue", "cost_per_placement", "cost_per_placement_without_beyond", "program_nps",
        "placed_without_indirect", "beyond_without_indirect")


def with_europe(base: DataFrame, members=EUROPEAN_COUNTRIES) -> DataFrame:
    """Base rows plus one EUR row per (snapshot, reference, phase, name, programme)
    for programmes present in more than one member country."""
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    aggs = {
        "start_date": F.max("start_date"), "end_date": F.max("end_date"),
        "months_since_completion": F.max("months_since_completion"),
        "admitted": F.sum("admitted"), "enrolled_or_graduated": F.sum("enrolled_or_graduated"),
        "dropped_out": F.sum("dropped_out"), "placed_fellows": F.sum("placed_fellows"),
        "beyond": F.sum("beyond"), "direct_beyond": F.sum(z("direct_beyond")),
        "indirect_beyond": F.sum(z("indirect_beyond")), "internal_hire": F.sum("internal_hire"),
        "external_qualifying": F.sum("external_qualifying"), "internal_training": F.sum("internal_training"),
        "certification_name": F.max("certification_name"), "program_revenue": F.sum(z("program_revenue")),
        "cost_per_placement": weighted_avg_or_avg("cost_per_placement", "placed_fellows"),
        "cost_per_placement_without_beyond": weighted_avg_or_avg("cost_per_placement_without_beyond",
                                                                 "placed_fellows"),
        "program_nps": F.avg("program_nps"),
        "placed_without_indirect": F.sum(z("placed_without_indirect")),
        "beyond_without_indirect": F.sum(z("beyond_without_indirect")),
    }
    group = ["snapshot_date", "mbr_reference", "phase", "program_name", "program_code"]
    return regional_rollup(base, key="program_code", group_cols=group, member_col="country",
                           members=members, region_code=EUROPE_CODE, aggs=aggs)


def cert_aggregates(t: TableRegistry) -> DataFrame:
    c = t.ref("cert_updates")
    return c.groupBy("program_code", "country").agg(
        *[F.sum(F.coalesce(F.col(x), F.lit(0))).alias(x) for x in _CERT_SUMS],
        *[F.avg(F.coalesce(F.col(x), F.lit(0))).alias(x) for x in _CERT_AVGS])


def current_rows(t: TableRegistry, ctx: RunContext, members=EUROPEAN_COUNTRIES) -> DataFrame:
    """Today's snapshot rows in contract order."""
    s = with_europe(summary_base(t, ctx), members)
    cu = cert_aggregates(t)
    cu = cu.select(*[F.col(c).alias(f"__cu_{c}") for c in cu.columns])
    j = s.join(cu, (s["program_code"] == cu["__cu_program_code"]) & (s["country"] == cu["__cu_country"]), "left")
    cert = {c: F.coalesce(F.col(f"__cu_{c}"), F.lit(0)) for c in (*_CERT_SUMS, *_CERT_AVGS)}
    cols = {
        "placement_rate": placement_rate(F.col("placed_fellows"), F.col("enrolled_or_graduated")),
        "retention_rate": retention_rate(F.col("enrolled_or_graduated"), F.col("admitted")),
        "run_rate": run_rate(F.col("placed_fellows"), F.col("enrolled_or_graduated"),
                             F.col("months_since_completion")),
        **cert,
        "last_snapshot_ts_est": ctx.local_stamp(),
    }
    out = j.withColumns(cols)
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SNAPSHOT_CONTRACT.fields])


def snapshot_rows(t: TableRegistry, ctx: RunContext, target: str | None,
                  members=EUROPEAN_COUNTRIES) -> DataFrame:
    """What the model selects: history on a first run or full refresh; today's rows afterwards.

    On incremental runs history rows only survive when dated today, which
    the month filter never lets through, so history is not read at all.
    """
    incremental = bool(target) and not ctx.full_refresh and has_data(t.spark, target)
    if not incremental:
        rows = history_baseline(t, ctx, None)
    else:
        rows = current_rows(t, ctx, members).filter(F.col("snapshot_date") == ctx.as_of())
    rows = rows.withColumn("snapshot_date", F.coalesce(F.col("snapshot_date"), ctx.as_of()))
    return conform(rows, SNAPSHOT_CONTRACT)


#: Fixed value: the contract's primary key (declared, not enforced, in the original).
PRIMARY_KEY = ("program_code", "country", "snapshot_date")


def snapshot_checks(rows: DataFrame, severity: str = "warn") -> list[Check]:
    """Tests of a snapshot's rows: the primary key and its columns' nulls."""
    return [Check(test_name("general", "mbr_snapshot", "primary_key"), column=",".join(PRIMARY_KEY), rows=rows, key=PRIMARY_KEY,
                  severity=severity, quality_dimension="uniqueness", tags=("tst",)),
            *[Check(test_name("general", "mbr_snapshot", c), column=c, rows=rows, broken=F.col(c).isNull(), severity=severity,
                    quality_dimension="completeness", tags=("tst",)) for c in PRIMARY_KEY]]


def log_snapshot(spark: SparkSession, target: str, ctx: RunContext, log_path: str, severity: str, run_id: str | None) -> None:
    """Test the written rows of today in one scan, append the log, and raise if a check of severity 'error' failed."""
    rows = read_snapshot(spark, target).filter(F.col("snapshot_date") == ctx.as_of())
    results = run_checks(snapshot_checks(rows, severity)).collect()  # a row per check
    append_log(spark.createDataFrame(results), log_path, run_id or uuid.uuid4().hex, ctx.created_at())
    failed = [r["test_name"] for r in results if r["status"] == "fail"]
    if failed:
        raise CheckFailed(f"failed checks: {failed}")


def run_snapshot(t: TableRegistry, ctx: RunContext, target: str, members=EUROPEAN_COUNTRIES,
                 log_path: str | None = None, severity: str = "warn", run_id: str | None = None) -> dict:
    """Build and write the snapshot; returns what happened (for logs and tests).

    With ``log_path`` today's rows are tested after the write (primary key,
    nulls) and a row per test is appended there; with ``severity="error"`` a broken
    key raises ``CheckFailed``.
    """
    guard_full_refresh(ctx)
    spark = t.spark
    first = not has_data(spark, target)
    if first or ctx.full_refresh:  # rebuilt from the backfill; the target is not read
        rows = snapshot_rows(t, ctx, target, members)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static") \
            .partitionBy("snapshot_date").parquet(target)
        return {"mode": "initial" if first else "full_refresh", "written": True}
    exists = snapshot_exists(spark, target, ctx.as_of_date)
    if not should_snapshot(ctx, exists):
        return {"mode": "incremental", "written": False, "snapshot_exists": exists}
    rows = snapshot_rows(t, ctx, target, members)
    n = snapshot_merge(rows, target, MERGE_KEY)
    if log_path:
        log_snapshot(spark, target, ctx, log_path, severity, run_id)
    return {"mode": "incremental", "written": True, "rows_today": n}


def history_report(snapshot: DataFrame) -> DataFrame:
    """Review order: newest snapshot first, then months (Ongoing last), then programme."""
    months = F.when(F.col("months_since_completion") == "Ongoing", F.lit(999)) \
        .otherwise(F.col("months_since_completion").try_cast("long"))
    return snapshot.orderBy(F.col("snapshot_date").desc(), months.asc_nulls_first(), F.col("program_code").asc())


def ongoing_programs(summary: DataFrame) -> DataFrame:
    """Programmes still running, per country."""
    return summary.filter(F.col("months_since_completion") == "Ongoing").select("program_code", "country")


def summary_formulas(df: DataFrame, program_cost: str = "program_cost") -> DataFrame:
    """Derived summary columns as the output contract defines them (the summary's
    builder is not part of the original; only these formulas are).

    placed / beyond without the indirect-beyond category, cost per placed fellow,
    and cost per placed fellow outside the beyond category. Divisions by zero give NULL.
    """
    indirect = F.coalesce(F.col("indirect_beyond"), F.lit(0))
    return df.withColumns({
        "placed_without_indirect": F.col("placed_fellows") - indirect,
        "beyond_without_indirect": F.col("beyond") - indirect,
        "cost_per_placement": safe_divide(program_cost, "placed_fellows"),
        "cost_per_placement_without_beyond": safe_divide(
            F.col(program_cost), F.col("placed_fellows") - F.coalesce(F.col("beyond"), F.lit(0))),
    })


def certification_percentages(df: DataFrame) -> DataFrame:
    """Certification shares as the contract defines them: attempted out of eligible,
    received out of enrolled-or-graduated, job transitions with a certificate out of placed."""
    return df.withColumns({
        "percent_exam_attempted": safe_divide("certification_attempted", "cert_eligible"),
        "percent_of_graduated": safe_divide("certification_received", "enrolled_or_graduated"),
        "percent_of_job_transitions_with_certificate": safe_divide("job_transitions_with_certificate",
                                                                   "placed_fellows"),
    })
