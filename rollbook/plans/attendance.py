"""Attendance products: the staging learner x lesson table and the gold weekly grid.

Both are lazy DataFrame plans over a ``TableRegistry``. Logical table names:

==================  ==============================================================
alt_accounts        primary_user_service_id, primary_alt_account_user_service_id,
                    primary_id_email, alt_account_email
user_links          primary_user_service_id, user_service_id
participant_sessions meeting_id, meeting_instance_id, primary_user_service_id,
                    participant_email, participant_name, participant_meeting_instance_id,
                    join_time, leave_time, duration, is_infered_optional_meeting
meeting_instances   meeting_instance_id, program_code, lesson_id, lesson_title, start_time_ts,
                    end_time_ts, meeting_duration_seconds, is_infered_optional_meeting
learners            user_service_id, email, first_name, last_name, program_code,
                    enrollments_status, edw_is_current, edw_is_deleted
lectures            lesson_id, lesson_title, lesson_start_date_ts, lesson_end_date_ts,
                    program_code, edw_is_current, edw_is_deleted
program_content     lesson_event, program_code, delivery_ts, lecture_end_ts, category
excused_absences    form_id, program_code, excused_attendance_date, submitted_at,
                    excuse_reason, email, first_name, last_name
learner_activity    learner_id, program_id, activity_id, activity_type, overrides (JSON)
programs            program_code, program_start_ts, program_end_ts, sponsored_industry_certification
form_questions      question_id, form_id
form_responses      question_id, form_id, submitted_at, response
==================  ==============================================================

Scale notes: the grid (learners x lessons of a programme) is the product
itself; it is salted over ``grid_salt`` sub-keys so one large programme is
built by many tasks. Every other join is an equi-join on ids or on
(day, normalised e-mail); look-up sides are reduced to distinct keys first.
Both plans are lazy; ``publish`` writes the staging table and builds gold from it.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from typing import Callable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.context import RunContext
from rollbook.functions.dates import day_name, week_start
from rollbook.functions.json import json_bool, json_scalar
from rollbook.functions.text import STAFF_EMAIL_PATTERN, normalize_email
from rollbook.operators.dims import current_rows, latest_per_key
from rollbook.operators.grid import entity_grid, expand_date_range
from rollbook.operators.intervals import BUCKET_ROWS, merge_intervals, presence_ratio
from rollbook.operators.joins import match_null_safe, substring_join
from rollbook.operators.rollup import pivot_form
from rollbook.operators.skew import ROWS_PER_TASK, salted_join
from rollbook.operators.status import overall_status, row_status
from rollbook.operators.weeks import UPCOMING, upcoming_scaffold, week_label, week_spine
from rollbook.quality import Check, checked_write, conform, test_name
from rollbook.sinks.snapshot import clustered
from rollbook.sources.tables import TableRegistry

# Fixed values that must equal the reference's (placeholders it ships for the
# waiver form and its questions, in question order).
WAIVER_FORM_IDS = ("FORM_ID_001",)
WAIVER_QUESTIONS = {
    "QUESTION_ID_1": "program_code",
    "QUESTION_ID_2": "learner_email",
    "QUESTION_ID_3": "waived_class_day",
    "QUESTION_ID_4": "waived_period_start",
    "QUESTION_ID_5": "waived_period_end",
    "QUESTION_ID_6": "waived_reason",
}

STAGING_COLUMNS = (
    "program_code", "meeting_id", "meeting_instance_id", "lesson_id", "lesson_title",
    "lesson_start_date_ts", "lesson_end_date_ts", "primary_user_service_id",
    "user_service_id_in_program_service", "participant_email", "participant_name",
    "enrollments_status", "meeting_start_time_ts", "meeting_end_time_ts", "meeting_duration_seconds",
    "attendance_duration_seconds", "attendance_percentage", "has_participant_attended_flag",
    "has_excused_attendance", "excuse_submitted_date", "excuse_reason", "is_exempt", "edw_created_at",
)
GOLD_COLUMNS = (
    "program_code", "week_number", "week_range", "primary_user_service_id", "participant_name",
    "participant_email", "lesson_title", "week_attendance", "has_excused_attendance", "is_exempt",
    "has_waived_attendance", "attendance_percentage", "attendance_overall_status",
)


#: Columns that the written staging table is bucketed and sorted by.
STAGING_LAYOUT = ("program_code", "primary_user_service_id")

# The gold contract's types (all others are strings).
_GOLD_TYPES = {"has_excused_attendance": T.BooleanType(), "is_exempt": T.BooleanType(),
               "has_waived_attendance": T.BooleanType(), "attendance_percentage": T.DoubleType()}
GOLD_CONTRACT = T.StructType([T.StructField(c, _GOLD_TYPES.get(c, T.StringType())) for c in GOLD_COLUMNS])


@dataclass(frozen=True)
class AttendanceOptions:
    """Switches for the reference's quirks (defaults reproduce it)."""
    merge_mode: str = "hull"            # "islands": true merge of overlapping sessions (Q1/Q2)
    alt_key: str = "primary"            # "alternate": look up the alternate account id (Q3)
    match_attendance_on: str = "weekday"  # "date": re-attach attendance by date (Q5)
    staff_pattern: str = STAFF_EMAIL_PATTERN
    grid_salt: int = 8
    bucket_rows: int = BUCKET_ROWS
    rows_per_task: int = ROWS_PER_TASK  # learners of a programme that one task joins to its lessons or weeks
    strict_form_dates: bool = True      # DATE(text) raises on bad text, as the warehouse does
    waiver_form_ids: Sequence[str] = WAIVER_FORM_IDS
    waiver_questions: Mapping[str, str] = field(default_factory=lambda: dict(WAIVER_QUESTIONS))


def _concat_name(first: str, last: str):
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def users(t: TableRegistry) -> DataFrame:
    """Current learners linked to their primary account (one row per enrolment)."""
    learn = current_rows(t.ref("learners"))
    link = t.ref("user_links").select("primary_user_service_id", "user_service_id")
    return learn.join(link, "user_service_id").select(
        "primary_user_service_id",
        F.col("user_service_id").alias("user_service_id_in_program_service"),
        F.col("email").alias("participant_email"),
        _concat_name("first_name", "last_name").alias("participant_name"),
        "program_code", "enrollments_status").distinct()


def lessons(t: TableRegistry, as_date: bool = False) -> DataFrame:
    """Current lectures; content-ops delivery times override lecture times."""
    lec = current_rows(t.ref("lectures")).filter(F.col("lesson_title").isNotNull())
    lxd = t.ref("program_content").select(
        F.col("lesson_event").alias("__ev"), F.col("program_code").alias("__pc"),
        "delivery_ts", "lecture_end_ts", "category")
    j = lec.join(lxd, (lec["lesson_title"] == lxd["__ev"]) & (lec["program_code"] == lxd["__pc"]), "left")
    if as_date:
        start = F.coalesce(F.to_date("delivery_ts"), F.to_date("lesson_start_date_ts"))
        end = F.coalesce(F.to_date("lecture_end_ts"), F.to_date("lesson_end_date_ts"))
        extra = [F.col("category")]
    else:
        start = F.coalesce(F.col("delivery_ts"), F.col("lesson_start_date_ts"))
        end = F.coalesce(F.col("lecture_end_ts"), F.col("lesson_end_date_ts"))
        extra = []
    return j.select("lesson_id", "lesson_title", *extra, start.alias("lesson_start_date_ts"),
                    end.alias("lesson_end_date_ts"), "program_code").distinct()


def session_attendance(t: TableRegistry, o: AttendanceOptions) -> DataFrame:
    """Attended seconds and share per participant and meeting instance."""
    ps = t.ref("participant_sessions")
    facts = ps.filter(
        F.col("duration").isNotNull()
        & ~F.lower(F.col("participant_email")).rlike(o.staff_pattern)
        & (F.col("is_infered_optional_meeting") == F.lit(False))
    ).select("meeting_id", "meeting_instance_id", "primary_user_service_id", "participant_email",
             "participant_name", "participant_meeting_instance_id", "join_time", "leave_time")
    intervals = facts.filter(F.col("primary_user_service_id").isNotNull()).distinct()
    combined = merge_intervals(
        intervals, ["meeting_id", "meeting_instance_id", "primary_user_service_id"],
        "join_time", "leave_time", "participant_meeting_instance_id", mode=o.merge_mode,
        labels=["participant_email", "participant_name"], bucket_rows=o.bucket_rows)
    md = t.ref("meeting_instances").filter(F.col("is_infered_optional_meeting") == F.lit(False)).select(
        "meeting_instance_id", "program_code", "lesson_id", "lesson_title",
        F.col("start_time_ts").alias("meeting_start_time_ts"),
        F.col("end_time_ts").alias("meeting_end_time_ts"), "meeting_duration_seconds")
    group = ["program_code", "meeting_id", "meeting_instance_id", "lesson_id", "lesson_title",
             "primary_user_service_id", "participant_email", "participant_name",
             "meeting_start_time_ts", "meeting_end_time_ts", "meeting_duration_seconds"]
    return presence_ratio(combined, md, on=["meeting_instance_id"], group_cols=group, meeting_cols=[])


_MEASURES = ("meeting_id", "meeting_instance_id", "meeting_start_time_ts", "meeting_end_time_ts",
             "meeting_duration_seconds", "attendance_duration_seconds", "attendance_percentage",
             "has_participant_attended_flag")


def _excuses(t: TableRegistry) -> DataFrame:
    """Latest submission per (form, e-mail, day); ties broken by reason, programme."""
    ex = t.ref("excused_absences").filter(
        F.col("excused_attendance_date").isNotNull() & F.col("email").isNotNull())
    ex = ex.select("form_id", "program_code", "excused_attendance_date", "submitted_at",
                   "excuse_reason", "email")
    latest = latest_per_key(ex, ["form_id", "email", "excused_attendance_date"], order=["submitted_at"],
                            tie_breakers=["excuse_reason", "program_code"])
    return latest.drop("form_id")


#: Column of a learner's part of the grid, and the most parts.
_PART, _MOST_PARTS = "__bucket_part", 1 << 30
_CELL = ("primary_user_service_id", "program_code", "lesson_id")


def _pairs_filled(own: Column, other: Column) -> Column:
    """The original's combinations of two lists of rows: per measure the first non-null. A row without a gap stays itself."""
    row = lambda a, b: F.struct(*[F.coalesce(a[m], b[m]).alias(m) for m in _MEASURES])
    whole = lambda a: reduce(lambda x, y: x & y, [a[m].isNotNull() for m in _MEASURES])
    return F.flatten(F.transform(own, lambda a: F.when(whole(a), F.array(row(a, a))).otherwise(
        F.transform(other, lambda b: row(a, b)))))


def _attended(t: TableRegistry, compute: DataFrame, o: AttendanceOptions) -> DataFrame:
    """Attendance per (learner, programme, lesson), own sessions first, then those found through the alias table.

    One row per cell, with its distinct rows of measures in the array ``__attended``.

    ``compute`` is used once: a cell's label rows become one array, each account
    is joined once to what the alias table says of it, and the original's
    combinations (per measure the first non-null) are made inside the cell.
    Cells that neither lookup reaches are absent. With ``alt_key="primary"``
    the second lookup is the cell itself, so the alias table only tells whose
    gaps are filled from their other rows. Rows move once, to their account: cells
    are made there and meet the alias table there, be it broadcast or not.
    """
    rows = compute.repartition("primary_user_service_id").groupBy(*_CELL).agg(F.collect_set(F.struct(*_MEASURES)).alias("__rows"))
    alias = t.ref("alt_accounts").filter(F.col("primary_alt_account_user_service_id").isNotNull())
    if o.alt_key == "primary":
        named = alias.select("primary_user_service_id", F.lit(True).alias("__named")).distinct()
        cells = rows.join(named, "primary_user_service_id", "left")
        got = F.when(F.col("__named"), _pairs_filled(F.col("__rows"), F.col("__rows"))).otherwise(F.col("__rows"))
    else:
        # what an account is to others: the primaries that look it up, each with the number of accounts it looks up
        looks = alias.select("primary_user_service_id", F.col("primary_alt_account_user_service_id").alias("__look")).distinct()
        counts = looks.groupBy("primary_user_service_id").agg(F.count(F.lit(1)).alias("__n"))
        known = looks.join(counts, "primary_user_service_id").groupBy(F.col("__look").alias("__account")).agg(
            F.collect_list(F.struct("primary_user_service_id", "__n")).alias("__lookers"))
        use = F.struct("primary_user_service_id", F.lit(True).alias("own"), F.lit(None).cast("bigint").alias("n"))
        lent = F.transform(F.coalesce("__lookers", F.array().cast(known.schema["__lookers"].dataType)), lambda k: F.struct(
            k["primary_user_service_id"].alias("primary_user_service_id"), F.lit(False).alias("own"), k["__n"].alias("n")))
        uses = rows.join(known, F.col("primary_user_service_id") == F.col("__account"), "left") \
            .select(F.explode(F.concat(F.array(use), lent)).alias("u"), *_CELL[1:], "__rows")
        none = F.array(F.struct(*[F.lit(None).cast(compute.schema[m].dataType).alias(m) for m in _MEASURES]))
        cells = uses.groupBy(F.col("u.primary_user_service_id").alias("primary_user_service_id"), *_CELL[1:]).agg(
            F.first(F.when(F.col("u.own"), F.col("__rows")), ignorenulls=True).alias("__own"),
            F.collect_list(F.when(~F.col("u.own"), F.col("__rows"))).alias("__others"), F.max("u.n").alias("__n"))
        # an account that is looked up and was not there lends a row of nulls
        cells = cells.join(counts.withColumnRenamed("__n", "__all"), "primary_user_service_id", "left")
        absent = F.size("__others") < F.coalesce("__all", F.lit(0))
        others = F.concat(F.flatten("__others"), F.when(absent | (F.size("__others") == 0), none).otherwise(F.slice(none, 1, 0)))
        got = _pairs_filled(F.coalesce("__own", none), others)
    return cells.select(*_CELL, F.array_distinct(got).alias("__attended"))


def attended_cells(t: TableRegistry, compute: DataFrame, o: AttendanceOptions) -> DataFrame:
    """The rows of ``_attended``, one by one."""
    return _attended(t, compute, o).select(*_CELL, F.explode("__attended").alias("__row")).select(*_CELL, "__row.*")


def excused_days(t: TableRegistry, learners: DataFrame) -> DataFrame:
    """Excuses per (learner, address, programme, day) over three routes: own address, primary address, alias address.

    Built from the excuses, which are few, so the grid is joined once. A learner
    with several alias rows keeps one row per alias on a day that any of them
    is excused, as the original's joins do.
    """
    ex = _excuses(t).withColumnRenamed("excused_attendance_date", "__day")
    who = learners.select("primary_user_service_id", "participant_email", "program_code").distinct()
    ids = t.ref("alt_accounts").select("primary_user_service_id", F.col("primary_id_email").alias("__m1"),
                                       F.col("alt_account_email").alias("__m2")).distinct()
    who = who.join(ids, "primary_user_service_id", "left").withColumn("__m0", F.col("participant_email"))
    key = ["primary_user_service_id", "participant_email", "program_code"]
    named = who.select(*key, F.explode(F.array_compact(F.array("__m0", "__m1", "__m2"))).alias("email")).distinct()
    days = named.join(ex.select("email", "program_code", "__day").distinct(), ["email", "program_code"]) \
        .select(*key, "__day").distinct()
    cur = match_null_safe(days, who, key)
    for i in range(3):
        route = ex.select(F.col("email").alias(f"__m{i}"), "program_code", "__day",
                          F.col("submitted_at").alias(f"__s{i}"), F.col("excuse_reason").alias(f"__r{i}"),
                          F.lit(True).alias(f"__hit{i}"))
        cur = cur.join(route, [f"__m{i}", "program_code", "__day"], "left")
    any_hit = F.coalesce(*[F.col(f"__hit{i}") for i in range(3)], F.lit(False))
    return cur.select(*key, "__day", any_hit.alias("has_excused_attendance"),
                      F.to_date(F.coalesce(*[F.col(f"__s{i}") for i in range(3)])).alias("excuse_submitted_date"),
                      F.coalesce(*[F.col(f"__r{i}") for i in range(3)]).alias("excuse_reason")).distinct()


def exempt_lessons(t: TableRegistry) -> DataFrame:
    """Whether a learner's lesson activity is required, per (learner, programme, lesson)."""
    linked = t.ref("user_links").select(F.col("primary_user_service_id").alias("learner_id"))
    act = t.ref("learner_activity").filter(F.col("activity_type") == "lesson").join(linked, "learner_id", "left_semi")
    return act.select(F.col("learner_id").alias("primary_user_service_id"), F.col("program_id").alias("program_code"),
                      F.col("activity_id").alias("lesson_id"),
                      json_bool("overrides", "$.is_required").alias("__required")).distinct()


def _met(learners: DataFrame, attended: DataFrame, exempt: DataFrame, excused: DataFrame, part: Column,
         lay_out: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The learners with what is known of each, as maps that no two rows of a learner share an entry of.

    Learners and facts lie in one table, so all of them move once, to their part, and no
    learner is moved with its maps. A null account or programme has neither attendance nor
    exemptions; excuses meet the learner's address, null or not.
    """
    person = ["primary_user_service_id", "program_code"]
    told = [c for c in learners.columns if c not in person]

    def facts(rows: DataFrame, name: str, *kept: str) -> DataFrame:
        return rows.select(*person, F.struct(*kept).alias(name))

    known = lambda rows: rows.dropna(subset=list(_CELL))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [
        facts(learners, "__who", *told), facts(known(attended), "__attended", "lesson_id", "__attended"),
        facts(known(exempt), "__exempt", "lesson_id", "__exempt"),
        facts(excused.filter(F.col("__day").isNotNull()), "__excused", "participant_email", "__day", "__excused")])
    per = lay_out(rows.withColumn(_PART, part)).groupBy(_PART, *person).agg(
        *[F.collect_list(c).alias(c) for c in ("__who", "__attended", "__exempt", "__excused")])
    own = F.filter("__excused", lambda x: x["participant_email"].eqNullSafe(F.col("__one.participant_email")))
    return per.withColumn("__one", F.explode("__who")).select(
        _PART, *person, *[F.col(f"__one.{c}") for c in told],
        F.map_from_entries("__attended").alias("__attended"), F.map_from_entries("__exempt").alias("__exempt"),
        F.map_from_entries(F.transform(own, lambda x: F.struct(x["__day"], x["__excused"]))).alias("__excused"))


def staging(t: TableRegistry, ctx: RunContext, o: AttendanceOptions = AttendanceOptions(),
            buckets: int | None = None) -> DataFrame:
    """Learner x lesson attendance with excuses and exemptions (23 columns), lazy.

    What is known of a learner (attendance and exemptions by lesson, excuses by day)
    is brought to the learner as maps before the grid is made, so no row of the grid is
    moved after it: each looks up its lesson and its day. Learners and lessons are
    distinct and so is each list that is looked up, hence the rows are too.

    Learners lie in parts by the hash of programme and account, and the grid is made there. Each task
    has those of one of ``buckets`` (default: as many as shuffle partitions), the same as in
    ``write_staging`` of as many, so the rows need not be moved to be written.
    """
    lesson, n = "lesson_id", buckets or int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    learners = users(t)
    address = ["primary_user_service_id", "participant_email", "program_code"]
    exempt = exempt_lessons(t).groupBy(*_CELL).agg(
        F.collect_set(F.coalesce(~F.col("__required"), F.lit(False))).alias("__exempt"))
    told = ["has_excused_attendance", "excuse_submitted_date", "excuse_reason"]
    excused = excused_days(t, learners).groupBy(*address, "__day").agg(F.collect_set(F.struct(*told)).alias("__excused"))
    # the task is the part modulo n, that is the bucket; the rest keeps the programmes of a bucket apart
    part = F.pmod(F.hash(*STAGING_LAYOUT), F.lit(n)) + F.lit(n) * F.pmod(F.hash("program_code"), F.lit(_MOST_PARTS // n))

    def lay_out(rows: DataFrame) -> DataFrame:
        return rows.repartitionById(n, F.col(_PART))

    who = _met(learners, _attended(t, session_attendance(t, o), o), exempt, excused, part, lay_out)
    grid = entity_grid(who, lessons(t), on=["program_code"], salt_buckets=o.grid_salt,
                       counted=learners.withColumn(_PART, part), part=_PART, lay_out=lay_out)
    out = grid.withColumns({
        "__attended": F.try_element_at("__attended", F.col(lesson)), "__exempt": F.try_element_at("__exempt", F.col(lesson)),
        "__excused": F.try_element_at("__excused", F.to_date("lesson_start_date_ts"))})
    for found in ("__attended", "__exempt", "__excused"):
        out = out.withColumn(found, F.explode_outer(found))
    return out.withColumns({
        **{m: F.col(f"__attended.{m}") for m in _MEASURES}, **{c: F.col(f"__excused.{c}") for c in told[1:]},
        "has_excused_attendance": F.coalesce("__excused.has_excused_attendance", F.lit(False)),
        "is_exempt": F.coalesce("__exempt", F.lit(False)),
        "edw_created_at": ctx.created_at(),
    }).select(*STAGING_COLUMNS)


def weeks(t: TableRegistry) -> DataFrame:
    return week_spine(t.ref("programs"), "program_code", "program_start_ts", "program_end_ts")


def participants(t: TableRegistry) -> DataFrame:
    learn = current_rows(t.ref("learners")).filter(F.col("enrollments_status") == "ENROLLED")
    prog = t.ref("programs").select("program_code", "program_start_ts")
    return learn.join(prog, "program_code").select(
        F.col("user_service_id").alias("primary_user_service_id"),
        _concat_name("first_name", "last_name").alias("participant_name"),
        F.col("email").alias("participant_email"), "program_code", "program_start_ts").distinct()


def waivers(t: TableRegistry, o: AttendanceOptions) -> DataFrame:
    """One row per waived day from the waiver form (pivoted answers, expanded range)."""
    form = pivot_form(t.ref("form_responses"), t.ref("form_questions"), o.waiver_questions,
                      ["form_id", "submitted_at"], o.waiver_form_ids)
    to_day = F.to_date if o.strict_form_dates else F.try_to_date
    form = form.withColumn("waived_period_start", to_day(F.col("waived_period_start"))) \
        .withColumn("waived_period_end", to_day(F.col("waived_period_end")))
    return expand_date_range(form, "waived_period_start", "waived_period_end", "waived_day")


def waived_days(t: TableRegistry, o: AttendanceOptions, people: DataFrame) -> DataFrame:
    """(learner, address, day) that a waiver names by any of the learner's three addresses.

    Driven from the waivers, which are few: each learner's addresses become
    keys of one equi-join instead of an OR over the participant x lesson rows.
    """
    alias = t.ref("alt_accounts").select("primary_user_service_id", "primary_id_email", "alt_account_email")
    mails = F.array_compact(F.array(*[normalize_email(c) for c in
                                      ("participant_email", "primary_id_email", "alt_account_email")]))
    keys = people.join(alias, "primary_user_service_id", "left").select(*people.columns, F.explode(mails).alias("__mail"))
    days = waivers(t, o).select(normalize_email("learner_email").alias("__mail"), F.col("waived_day").alias("lesson_date"))
    return keys.distinct().join(days.distinct(), "__mail").select(*people.columns, "lesson_date") \
        .distinct().withColumn("__waived", F.lit(True))


def exemptions(t: TableRegistry) -> DataFrame:
    """Learner x lesson pairs marked optional in the grading overrides."""
    les = lessons(t, as_date=True).select("lesson_id", F.col("lesson_title").alias("fe_title")).distinct()
    act = t.ref("learner_activity").filter(F.col("activity_type") == "lesson").select(
        "learner_id", "activity_id", json_scalar("overrides", "$.optional").alias("optional"))
    return act.join(les, act["activity_id"] == les["lesson_id"]).filter(F.col("optional") == "true") \
        .select("learner_id", "optional", "fe_title").distinct()


def gold(t: TableRegistry, ctx: RunContext, o: AttendanceOptions = AttendanceOptions(),
         staged: DataFrame | None = None, buckets: int | None = None) -> DataFrame:
    """Participant x week x weekday attendance with statuses, plus upcoming weeks (13 columns).

    ``staged``: the staging table if it is written already; ``buckets``: of how many
    buckets in the layout of ``write_staging``. The participants' lessons are then
    brought to that layout, and neither the join to staging nor the aggregate
    behind it moves staging rows (plan it within ``partial_key_joins``).
    """
    today = ctx.today_utc()
    # the rows of staging() are distinct, they need no second dedupe
    stg = staged.distinct() if staged is not None else staging(t, ctx, o)
    day = F.to_date(F.coalesce(F.to_date("lesson_start_date_ts"), F.to_date("meeting_start_time_ts")))
    raw = stg.withColumn("lesson_date", day).withColumn("day_of_week", day_name(day)) \
        .filter(F.to_date("lesson_start_date_ts").isNull() | (F.to_date("lesson_start_date_ts") <= today))
    lbw = raw.filter(F.col("lesson_title").isNotNull()) \
        .select("program_code", "lesson_date", "day_of_week", "lesson_title").distinct()

    wk = weeks(t)
    part = participants(t)
    # weeks meet the lessons and waived days the participants before the product of both; all that follows are maxima,
    # so a row of the product may come twice
    w = wk.select(F.col("program_code").alias("__w_pc"), "week_start_date", "week_end_date", "week_number").distinct()
    lbw = lbw.withColumn("__wk", week_start("lesson_date"))
    lbw = lbw.join(w, (lbw["program_code"] == w["__w_pc"]) & (lbw["__wk"] == w["week_start_date"]), "left").drop("__w_pc", "__wk")
    who = ["primary_user_service_id", "participant_email"]
    waived = waived_days(t, o, part.select(*who).distinct()).groupBy(*who).agg(F.collect_set("lesson_date").alias("__waived_days"))
    pl = salted_join(match_null_safe(part, waived, who, "left"), lbw, ["program_code"], rows_per_task=o.rows_per_task)
    number, rng = week_label(F.col("lesson_date"), F.col("program_start_ts"), F.col("week_number"),
                             F.col("week_start_date"), F.col("week_end_date"))
    plc = pl.select("program_code", "primary_user_service_id", "participant_name", "participant_email",
                    "lesson_title", "day_of_week", "lesson_date", number.alias("week_number"),
                    rng.alias("week_range"), F.array_contains("__waived_days", F.col("lesson_date")).alias("__waived"))

    match = "day_of_week" if o.match_attendance_on == "weekday" else "lesson_date"
    a = raw.select(F.col("program_code").alias("__a_pc"), F.col("primary_user_service_id").alias("__a_pid"),
                   F.col("lesson_title").alias("__a_title"), F.col(match).alias("__a_match"),
                   "has_participant_attended_flag", "has_excused_attendance", "is_exempt",
                   "attendance_percentage")
    if buckets:
        plc = plc.repartition(buckets, *STAGING_LAYOUT)
    j = plc.join(a, (plc["program_code"] == a["__a_pc"]) & (plc["primary_user_service_id"] == a["__a_pid"])
                 & (plc["lesson_title"] == a["__a_title"]) & (plc[match] == a["__a_match"]), "left")
    hit = F.col("__a_pid").isNotNull()
    keys8 = ["program_code", "week_number", "week_range", "primary_user_service_id", "participant_name",
             "participant_email", "lesson_title", "day_of_week"]
    ag = j.groupBy(*keys8).agg(
        F.max(F.when(hit, F.col("has_participant_attended_flag"))).alias("has_participant_attended_flag"),
        F.max(F.when(hit, F.col("has_excused_attendance"))).alias("has_excused_attendance"),
        F.max(F.when(hit, F.col("is_exempt"))).alias("is_exempt"),
        F.max(F.when(hit, F.col("attendance_percentage"))).alias("attendance_percentage"),
        F.max(F.coalesce("__waived", F.lit(False))).alias("has_waived_attendance"))

    # a learner's exemptions hold in all programmes; entered under each, they meet rows laid out by programme and learner
    fe = exemptions(t).join(part.select(F.col("program_code").alias("__fe_pc"), F.col("primary_user_service_id").alias("learner_id"))
                            .distinct(), "learner_id")
    fj = substring_join(ag, fe, eq=[("program_code", "__fe_pc"), ("primary_user_service_id", "learner_id")],
                        left_text="lesson_title", right_text="fe_title")
    status = row_status(F.col("optional") == "true", F.col("has_excused_attendance"),
                        F.col("has_participant_attended_flag"))
    keys7 = [k for k in keys8 if k != "lesson_title"]
    final = fj.groupBy(*keys7).agg(
        F.array_join(F.sort_array(F.collect_set("lesson_title")), " / ").alias("lesson_title"),
        F.max(status).alias("week_attendance"),
        F.max("has_excused_attendance").alias("has_excused_attendance"),
        F.when(F.max("optional") == "true", F.lit("true")).otherwise(F.lit("false")).alias("is_exempt"),
        F.max("attendance_percentage").alias("attendance_percentage"),
        F.max("has_waived_attendance").alias("has_waived_attendance"))
    overall = overall_status(F.col("lesson_title"), F.col("is_exempt") == "true",
                             F.col("has_excused_attendance") == F.lit(True), F.col("has_waived_attendance"),
                             F.col("week_attendance"), F.col("attendance_percentage"))
    actual = final.select(
        "program_code", "week_number", "week_range", "primary_user_service_id", "participant_name",
        "participant_email", "lesson_title", "week_attendance", "has_excused_attendance",
        F.col("is_exempt").cast("boolean").alias("is_exempt"), "has_waived_attendance",
        "attendance_percentage", overall.alias("attendance_overall_status")).distinct()

    upcoming = upcoming_scaffold(part, wk, "program_code", today,
                                 ["primary_user_service_id", "participant_name", "participant_email"], o.rows_per_task)
    upcoming = upcoming.select(
        "program_code", "week_number", "week_range", "primary_user_service_id", "participant_name",
        "participant_email", F.lit(None).cast("string").alias("lesson_title"),
        F.lit(None).cast("string").alias("week_attendance"),
        F.lit(None).cast("boolean").alias("has_excused_attendance"),
        F.lit(None).cast("boolean").alias("is_exempt"),
        F.lit(None).cast("boolean").alias("has_waived_attendance"),
        F.lit(None).cast("double").alias("attendance_percentage"),
        F.lit(UPCOMING).alias("attendance_overall_status"))
    out = actual.unionByName(upcoming).filter(F.col("week_number").isNotNull()).select(*GOLD_COLUMNS)
    return conform(out, GOLD_CONTRACT)


#: Fixed value: the gold contract's primary key (declared, not enforced, in the original).
GOLD_KEY = ("program_code", "primary_user_service_id", "week_number", "lesson_title")


def gold_checks(severity: str = "warn") -> list[Check]:
    """Tests of the gold table: its primary key, and its key columns' nulls."""
    checks = [Check(test_name("general", "attendance", "primary_key"), column=",".join(GOLD_KEY), key=GOLD_KEY,
                    severity=severity, quality_dimension="uniqueness", tags=("tst",))]
    for c in GOLD_KEY[:3]:
        checks.append(Check(test_name("general", "attendance", c), column=c, broken=F.col(c).isNull(), severity=severity,
                            quality_dimension="completeness", tags=("tst",), context=GOLD_KEY))
    # a lesson that has been held has a title; weeks to come have none
    checks.append(Check(test_name("general", "attendance", "lesson_title"), column="lesson_title",
                        broken=F.col("lesson_title").isNull(), where=f"attendance_overall_status <> '{UPCOMING}'",
                        severity=severity, quality_dimension="completeness", tags=("tst",), context=GOLD_KEY))
    return checks


def write_staging(staged: DataFrame, path: str, table: str, buckets: int | None = None, laid_out: bool = False) -> DataFrame:
    """Staging as an external table at ``path``: a bucket per (programme, learner) hash, sorted, by default as many as
    shuffle partitions. Gold's join and aggregates on these columns then read it without an exchange; a large programme is
    spread over all buckets by its learners. Rows that are ``laid_out`` (``staging`` with as many buckets) are written where
    they are."""
    spark = staged.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (staged if laid_out else staged.repartition(n, *STAGING_LAYOUT)).write.format("parquet").mode("overwrite").option("path", path) \
        .bucketBy(n, *STAGING_LAYOUT).sortBy(*STAGING_LAYOUT).saveAsTable(table)
    return spark.table(table)


@contextmanager
def partial_key_joins(spark: SparkSession) -> Iterator[None]:
    """While open, a join may use a side's partitioning by some of its keys (the staging table's layout)."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def publish(t: TableRegistry, ctx: RunContext, staging_path: str, gold_path: str,
            o: AttendanceOptions = AttendanceOptions(), staging_table: str = "rollbook_attendance_staging",
            log_path: str | None = None, failures_path: str | None = None, limit: int | None = 500,
            severity: str = "warn", run_id: str | None = None) -> DataFrame:
    """Build both attendance tables and return gold as it was written.

    Staging is made and written in gold's layout and read back (a lost executor re-reads
    files, and gold's plan starts from a table of known size). Gold is checked
    against its contract, laid out by programme and lesson, and tested while it is
    written: one row per test is appended at ``log_path`` (default: beside
    gold), failing rows go to ``failures_path``. With ``severity="error"`` a broken
    key raises ``CheckFailed`` after the log is written.
    """
    spark = t.spark
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged = write_staging(staging(t, ctx, o, buckets), staging_path, staging_table, buckets, laid_out=True)
    with partial_key_joins(spark):
        laid_out = clustered(gold(t, ctx, o, staged, buckets), ["program_code", "lesson_title"])
        checked_write(laid_out, lambda df: df.write.mode("overwrite").parquet(gold_path), lambda: spark.read.parquet(gold_path),
                      gold_checks(severity), log_path or f"{gold_path.rstrip('/')}_log", run_id or uuid.uuid4().hex,
                      ctx.created_at(), failures_path, limit)
    return spark.read.parquet(gold_path)
