"""Staging and gold attendance plans on hand-built rows (edge cases of FIXTURES.md §E)."""

import datetime as dt

import pytest

from rollbook.context import RunContext
from rollbook.plans.attendance import GOLD_COLUMNS, STAGING_COLUMNS, gold, staging
from tests.fixtures import attendance_tables

CTX = RunContext.at("2025-01-22 12:00")


@pytest.fixture(scope="module")
def tables(spark):
    return attendance_tables(spark)


@pytest.fixture(scope="module")
def stg(tables):
    return {(r.primary_user_service_id, r.lesson_id): r for r in staging(tables, CTX).collect()}


def test_staging_columns(tables):
    assert tuple(staging(tables, CTX).columns) == STAGING_COLUMNS


def test_grid_is_learners_times_lessons(stg):
    # 3 current learners x 3 titled lessons (the untitled lecture is dropped)
    assert set(stg) == {(u, l) for u in ("u1", "u2", "u3") for l in ("A", "B", "C")}


def test_overlapping_devices_merge_to_hull(stg):
    r = stg[("u1", "A")]
    assert r.attendance_duration_seconds == 2400  # 10:00-10:40
    assert r.has_participant_attended_flag is True


def test_exactly_half_is_not_attended(stg):
    r = stg[("u2", "A")]
    assert r.attendance_percentage == 0.5 and r.has_participant_attended_flag is False


def test_excuse_latest_submission_wins(stg):
    r = stg[("u2", "A")]
    assert r.has_excused_attendance is True and r.excuse_reason == "doctor"
    assert r.excuse_submitted_date == dt.date(2025, 1, 5)


def test_excuse_by_alternate_email(stg):
    r = stg[("u1", "B")]
    assert r.has_excused_attendance is True and r.excuse_reason == "trip"


def test_exemption_from_overrides(stg):
    assert stg[("u3", "B")].is_exempt is True
    assert stg[("u3", "A")].is_exempt is False


def test_content_time_overrides_lecture_time(stg):
    assert stg[("u3", "B")].lesson_start_date_ts == dt.datetime(2025, 1, 13, 9, 0)


def test_unmatched_lesson_has_null_measures(stg):
    r = stg[("u2", "C")]
    assert r.meeting_id is None and r.has_participant_attended_flag is None
    assert r.has_excused_attendance is False


@pytest.fixture(scope="module")
def gld(tables):
    return gold(tables, CTX).collect()


def test_gold_columns(tables):
    assert tuple(gold(tables, CTX).columns) == GOLD_COLUMNS


def test_gold_week_labels(gld):
    labels = {(r.primary_user_service_id, r.lesson_title): (r.week_number, r.week_range) for r in gld}
    # programme starts Wed 2025-01-08, so week 1 is Mon 2025-01-06; lesson A on 01-06 is week 1
    assert labels[("u1", "Lesson A")] == ("1", "Jan 06 - Jan 12")
    assert labels[("u1", "Lesson B")] == ("2", "Jan 13 - Jan 19")
    assert labels[("u1", "Spring break")] == ("3", "Jan 20 - Jan 26")


def test_gold_statuses(gld):
    st = {(r.primary_user_service_id, r.lesson_title): r.attendance_overall_status for r in gld}
    assert st[("u1", "Lesson A")] == "attended"
    assert st[("u1", "Lesson B")] == "excused"     # excuse filed under the alternate e-mail
    assert st[("u3", "Lesson A")] == "exempted"    # optional override
    assert st[("u3", "Lesson B")] == "waived"      # waiver form 13-14 Jan, padded upper-case e-mail
    assert st[("u1", "Spring break")] == "break"
    # Q6: gold keys learners by their program-service id; L2 differs from its
    # primary id u2, so staging attendance and the excuse do not re-attach.
    assert st[("L2", "Lesson A")] == "absent"


def test_gold_upcoming_weeks(gld):
    up = [r for r in gld if r.attendance_overall_status == "upcoming lesson"]
    # weeks starting after 2025-01-22: Jan 27, Feb 03, Feb 10 for 3 enrolled learners
    assert sorted({r.week_number for r in up}) == ["4", "5", "6"]
    assert len(up) == 9 and all(r.lesson_title is None for r in up)


def test_activity_rows_differing_only_in_helper_values_collapse(spark):
    """Two activity rows for one learner and lesson, one with is_required true and one
    with no override: both mean 'not exempt', so the learner x lesson row appears once."""
    t = attendance_tables(spark)
    extra = spark.createDataFrame([("u1", "P1", "A", "lesson", '{"is_required": true}'),
                                   ("u1", "P1", "A", "lesson", '{"other": 1}')],
                                  t.ref("learner_activity").schema)
    t.register("learner_activity", t.ref("learner_activity").unionByName(extra))
    rows = [r for r in staging(t, CTX).collect() if r.primary_user_service_id == "u1" and r.lesson_id == "A"]
    assert len(rows) == 1 and rows[0].is_exempt is False
