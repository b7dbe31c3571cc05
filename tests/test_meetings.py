"""Bronze in one pass, failovers, hosts, lesson links and range joins, against plain loops."""

import datetime as dt
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from rollbook.operators.intervals import sessionize
from rollbook.operators.joins import week_join
from rollbook.operators.ranges import span_join
from rollbook.plans import bronze


def _at(minutes):
    return dt.datetime(2025, 1, 1) + dt.timedelta(minutes=minutes)


def stays(records, gap):
    """(join, leave, present seconds, failovers, records, last status) of one key's (start, end, id, status)."""
    out = []
    for s, e, i, status in sorted(records, key=lambda r: (r[0], -r[1].timestamp(), r[2])):
        if out and s <= out[-1][1] + gap:
            now = out[-1]
            if s > now[1]:
                now[2] += (e - s).total_seconds()
                now[3] += 1
            else:
                now[2] += max(0.0, (e - now[1]).total_seconds())
            now[1] = max(now[1], e)
            now[4] += 1
            now[5] = max(now[5], (s, e, i, status))
        else:
            out.append([s, e, (e - s).total_seconds(), 0, 1, (s, e, i, status)])
    return [(a, b, int(p), f, n, last[3]) for a, b, p, f, n, last in out]


@pytest.mark.parametrize("seed,bucket", [(1, 2048), (2, 5), (3, 1)])
def test_sessions_match_loops(spark, seed, bucket):
    rnd = random.Random(seed)
    rows = []
    for i in range(500):
        s = rnd.randrange(0, 3000)
        rows.append((rnd.choice("abc"), _at(s), _at(s + rnd.choice([0, 1, 5, 30])), i, f"s{i % 4}"))
    rows += [("a", None, _at(5), 900, "x"), ("a", _at(5), None, 901, "y"), (None, _at(5), _at(6), 902, "z")]
    df = spark.createDataFrame(rows, "k string, s timestamp_ntz, e timestamp_ntz, id long, status string")
    got = sessionize(df, ["k"], "s", "e", "id", 240, last=["status"], bucket_rows=bucket)
    want = [(k, *x) for k in "abc" for x in stays([r[1:] for r in rows if r[0] == k and r[1] and r[2]], dt.timedelta(seconds=240))]
    want += [("a", None, _at(5), None, 0, 1, "x"), ("a", _at(5), None, None, 0, 1, "y"), (None, _at(5), _at(6), 60, 0, 1, "z")]
    assert max(r[4] for r in want) > 1
    cols = ["k", "join_time", "leave_time", "duration_seconds", "failover_count", "n_records", "status"]
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == sorted(want, key=str)


def test_participant_sessions_keep_people_apart(spark):
    rows = [("m", "u1", "a@x", "Ann", "1", _at(0), _at(10), "in"), ("m", "u1", "a@x", "Ann", "2", _at(12), _at(20), "out"),
            ("m", None, "a@x", "Ann", "3", _at(12), _at(20), "in"), ("m", "", "a@x", "Ann", "4", _at(12), _at(20), "in"),
            ("m", "u1", "a@x", "Ann", "5", _at(40), _at(41), "in"), ("n", "u1", "a@x", "Ann", "6", _at(21), _at(22), "in")]
    df = spark.createDataFrame(rows, "meeting_instance_id string, primary_user_service_id string, user_email string, name string, "
                                     "participant_meeting_instance_id string, join_time timestamp_ntz, leave_time timestamp_ntz, status string")
    got = bronze.participant_sessions(df)
    assert sorted((r.meeting_instance_id, r.primary_user_service_id is None, r.primary_user_service_id or "", r.duration_seconds,
                   r.failover_count, r.failover_seconds, r.participant_status) for r in got.collect()) == [
        ("m", False, "", 480, 0, 0, "in"), ("m", False, "u1", 60, 0, 0, "in"), ("m", False, "u1", 1080, 1, 120, "out"),
        ("m", True, "", 480, 0, 0, "in"), ("n", False, "u1", 60, 0, 0, "in")]
    assert bronze.participant_sessions(df.limit(0)).count() == 0


def test_span_join_equals_between(spark):
    rnd = random.Random(9)
    day = lambda n: dt.date(2024, 12, 25) + dt.timedelta(days=n)
    points = [(rnd.choice("ab"), i, None if i % 17 == 0 else day(rnd.randrange(80))) for i in range(200)]
    spans = []
    for i in range(40):
        low = rnd.randrange(-5, 80)
        spans.append((rnd.choice("ab"), i, None if i == 7 else day(low), None if i == 9 else day(low + rnd.choice([-3, 0, 4, 10, 33]))))
    p = spark.createDataFrame(points, "k string, id int, d date")
    s = spark.createDataFrame(spans, "k string, nr int, low date, high date")
    hit = [(*a, b[1], b[2], b[3]) for a in points for b in spans if a[0] == b[0] and a[2] and b[2] and b[3] and b[2] <= a[2] <= b[3]]
    rest = [(*a, None, None, None) for a in points if not any(h[:2] == a[:2] for h in hit)]
    rows_of = lambda df: sorted(map(tuple, df.collect()), key=str)
    order = lambda rows: sorted(rows, key=str)
    for bins in (1, 7, 100):
        assert rows_of(span_join(p, s, [("k", "k")], "d", "low", "high", "inner", bin_days=bins)) == order(hit)
        assert rows_of(span_join(p, s, [("k", "k")], "d", "low", "high", bin_days=bins)) == order(hit + rest)
    assert rows_of(week_join(p, s, [("k", "k")], "d", "low", "left", "high", monday_weeks=False)) == order(hit + rest)
    plan = span_join(p, s, [("k", "k")], "d", "low", "high")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(ValueError):
        span_join(p.withColumn("d", F.lit("x")), s, [("k", "k")], "d", "low", "high")


def test_bronze_tables_in_one_scan(spark, tmp_path):
    records = {
        "users": [{"id": "h1", "email": "a@x.io", "updated_at": "2025-01-02T03:04:05Z"}, {"id": 7, "email": {"no": 1}}],
        "past_meetings": [{"uuid": "i1", "id": "m1", "start_time": "2025-01-02T09:00:00Z", "duration": "60", "participants_count": "many"}],
        "participants": [{"id": "p1", "meeting_uuid": "i1", "join_time": "2025-01-02T09:00:00Z", "failover": True, "status": "in_meeting"}],
        "polls": [{"id": "q1", "questions": [{"name": "?"}]}], "poll_results": [{"poll_id": "q1", "question_details": {"a": 1}}],
        "meetings": [{"id": "m1", "topic": "Intro", "type": 2}], "other": [{"id": "nobody"}]}
    rows = [(e, json.dumps(r), day) for day in ("2025-01-01", "2025-01-02") for e, rs in records.items() for r in rs
            if day == "2025-01-02" or e != "polls"] + [("users", "{broken", "2025-01-02"), ("users", None, "2025-01-01")]
    spark.createDataFrame(rows, "endpoint_url string, data string, execution_date string").selectExpr(
        "endpoint_url", "data", "date(execution_date) AS execution_date").write.parquet(str(tmp_path / "landing"))
    landing = spark.read.parquet(str(tmp_path / "landing"))
    fields = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    plan = bronze.bronze_fan_out(landing)._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.debug.maxToStringFields", fields)
    assert plan.count("Relation [") == 1 and len(re.findall(r"parseJson|parse_json", plan)) == 1, plan
    path = str(tmp_path / "bronze")
    bronze.write_bronze(landing, path)
    for name, table in bronze.BRONZE_TABLES.items():
        got = bronze.read_bronze(spark, path, name)
        want = bronze.bronze_extract(landing, table.endpoint, table.fields)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
        last = bronze.read_bronze(spark, path, name, latest=True)
        assert {str(r.execution_date) for r in last.collect()} == {"2025-01-02"}
    hosts = {r.host_id: r for r in bronze.read_bronze(spark, path, "hosts", latest=True).filter("host_id IS NOT NULL").collect()}
    assert hosts["7"].email is None and hosts["h1"].updated_at == dt.datetime(2025, 1, 2, 3, 4, 5)
    one = bronze.read_bronze(spark, path, "meeting_instances").first()
    assert one.duration_minutes == 60 and one.participants_count is None
    assert json.loads(bronze.read_bronze(spark, path, "polls").first().questions) == [{"name": "?"}]


def test_hosts_and_users_are_settled_one_to_one(spark):
    hosts = spark.createDataFrame([("h1", " A@x ", 1), ("h2", "a@X", 3), ("h3", "a@x", 3), ("h4", "b@x", 1), ("h5", "zz", 1), ("h6", None, 1),
                                   ("h7", "c@x", None)], "host_id string, email string, updated_at int")
    users = spark.createDataFrame([("u1", "a@x"), ("u2", "a@x"), ("u3", "b@x"), ("u3", "B@x"), ("u4", "c@x"), (None, "zz")],
                                  "primary_user_service_id string, email string")
    got = {r.host_id: (r.n_users, r.n_hosts, r.primary_user_service_id) for r in bronze.host_user_map(hosts, users).collect()}
    assert got == {"h1": (2, 3, None), "h2": (2, 3, "u1"), "h3": (2, 3, None), "h4": (1, 1, "u3"), "h5": (0, 0, None),
                   "h6": (0, 0, None), "h7": (1, 1, "u4")}
    pairs = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", 2), ("c", 3), (None, 3), ("d", None)], "l string, r int")
    assert sorted(map(tuple, bronze.one_to_one_violations(pairs, "l", "r").collect())) == [("l", "a", 2), ("r", "2", 2)]


def test_instances_take_the_nearest_lesson_of_their_programme(spark):
    lessons = spark.createDataFrame([("l1", "One", "P", _at(540), _at(600)), ("l2", "Two", "P", _at(600), _at(660)),
                                     ("l3", "Three", "Q", _at(545), _at(600)), ("l4", "Odd", None, _at(540), _at(600))],
                                    "lesson_id string, lesson_title string, program_code string, lesson_start_ts timestamp_ntz, lesson_end_ts timestamp_ntz")
    starts = {"a": ("P", 541), "b": ("P", 512), "c": ("P", 500), "d": (None, 544), "e": ("P", 590), "f": ("R", 541), "g": ("P", None)}
    rows = [(k, p, None if m is None else _at(m), "h" + k) for k, (p, m) in starts.items()]
    inst = spark.createDataFrame(rows, "meeting_instance_id string, program_code string, start_time timestamp_ntz, host_id string")
    hosts = spark.createDataFrame([("ha", "u1", "a@x")], "host_id string, primary_user_service_id string, email string")
    got = {r.meeting_instance_id: (r.lesson_id, r.program_code, r.host_user_service_id)
           for r in bronze.link_instances(inst, lessons, hosts).collect()}
    assert got == {"a": ("l1", "P", "u1"), "b": ("l1", "P", None), "c": (None, "P", None), "d": ("l3", "Q", None), "e": ("l2", "P", None),
                   "f": (None, "R", None), "g": (None, "P", None)}
