"""Corrected modes of the attendance plans against the defaults."""

import datetime as dt

from rollbook.context import RunContext
from rollbook.plans.attendance import AttendanceOptions, staging
from tests.fixtures import TS, attendance_tables

CTX = RunContext.at("2025-01-22 12:00")


def _tables(spark):
    t = attendance_tables(spark)
    extra = spark.createDataFrame([
        # a second overlap cluster for u1 in lesson A: 10:50-10:58
        ("m1", "i1", "u1", "ann@x.org", "Ann", "p7", TS(2025, 1, 6, 10, 50), TS(2025, 1, 6, 10, 55), 300, False),
        ("m1", "i1", "u1", "ann@x.org", "Ann", "p8", TS(2025, 1, 6, 10, 52), TS(2025, 1, 6, 10, 58), 360, False),
        # u1's alternate account attends lesson B
        ("m2", "i2", "u1alt", "ann2@x.org", "Ann", "p9", TS(2025, 1, 13, 10, 0), TS(2025, 1, 13, 10, 45), 2700,
         False),
    ], t.ref("participant_sessions").schema)
    t.register("participant_sessions", t.ref("participant_sessions").unionByName(extra))
    return t


def _row(df, user, lesson):
    return [r for r in df.collect() if r.primary_user_service_id == user and r.lesson_id == lesson]


def test_islands_mode_does_not_bridge_clusters(spark):
    t = _tables(spark)
    hull = _row(staging(t, CTX), "u1", "A")
    isl = _row(staging(t, CTX, AttendanceOptions(merge_mode="islands")), "u1", "A")
    # hull: one hull per person spans both clusters, 10:00-10:58 (Q1)
    assert [r.attendance_duration_seconds for r in hull] == [58 * 60]
    # islands: 10:00-10:40 plus 10:50-10:58
    assert [r.attendance_duration_seconds for r in isl] == [48 * 60]


def test_alternate_account_lookup(spark):
    t = _tables(spark)
    default = _row(staging(t, CTX), "u1", "B")
    alternate = _row(staging(t, CTX, AttendanceOptions(alt_key="alternate")), "u1", "B")
    # Q3: the default route looks up the primary id again, so the alt account's session is unused
    assert [r.attendance_duration_seconds for r in default] == [None]
    assert [(r.attendance_duration_seconds, r.has_participant_attended_flag) for r in alternate] == [(2700, True)]
    assert alternate[0].meeting_instance_id == "i2"
