"""Interval merging vs the rule stated in plain loops, and islands vs window SQL in DuckDB."""

import datetime as dt
import random

import duckdb
import pandas as pd
import pytest

from rollbook.operators.intervals import hull_intervals, islands, presence_ratio
from tests.conftest import rows_of

def hull_by_rule(pdf):
    """The hull rule by plain loops over each key's sessions (rows: k1, k2, lab, join_time, leave_time).

    A session reaches another one that starts within it. A label's hull starts
    with its first reaching session; its end is the last end among those and
    the sessions they reach, or unknown when no reached session has an end.
    """
    out = []
    rows = [tuple(None if x is None or x != x else x for x in r)
            for r in pdf.drop_duplicates().astype(object).itertuples(index=False)]
    for key in sorted({r[:2] for r in rows}):
        group = [r[2:] for r in rows if r[:2] == key]

        def reaches(a, b):
            return a[1] != b[1] and a[3] is not None and a[2] <= b[2] <= a[3]

        hulls = []
        for label in sorted({g[0] for g in group}):
            mine = [a for a in group if a[0] == label and any(reaches(a, b) for b in group)]
            reached = [b for b in group if any(reaches(a, b) for a in mine)]
            if mine:
                known = [b[3] for b in reached if b[3] is not None]
                hulls.append((label, min(a[2] for a in mine), max([*known, *(a[3] for a in mine)]) if known else None))
        out += [(*key, *h) for h in hulls]
        for lab, _, s, e in group:
            out += [(*key, lab, s, e) for _, h0, h1 in hulls
                    if s < h0 or (e is not None and h1 is not None and e > h1)] if hulls else [(*key, lab, s, e)]
    return pd.DataFrame(out, columns=["k1", "k2", "lab", "join_time", "leave_time"]).astype(object)


ISLANDS_SQL = """
WITH t AS (
  SELECT *, max(e) OVER (PARTITION BY k1, k2 ORDER BY s, e DESC, id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_e
  FROM s WHERE s IS NOT NULL AND e IS NOT NULL AND k1 IS NOT NULL),
g AS (SELECT *, sum(CASE WHEN prev_e IS NULL OR s > prev_e THEN 1 ELSE 0 END)
        OVER (PARTITION BY k1, k2 ORDER BY s, e DESC, id ROWS UNBOUNDED PRECEDING) AS isl FROM t)
SELECT k1, k2, min(s) AS island_start, max(e) AS island_end, count(*) AS n_sessions
FROM g GROUP BY k1, k2, isl
"""


def _random_sessions(seed, n=400, labels=("x",), keys=6, with_bad=True):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1, 9, 0, 0)
    out = []
    for i in range(n):
        k1 = rnd.randrange(keys)
        k2 = rnd.choice(["m1", "m2"])
        s = base + dt.timedelta(minutes=rnd.randrange(0, 600, rnd.choice([1, 5, 30])))
        e = s + dt.timedelta(minutes=rnd.choice([0, 5, 10, 30, 45, 90, 200]))
        if with_bad and rnd.random() < 0.04:
            e = s - dt.timedelta(minutes=7)  # inverted
        if with_bad and rnd.random() < 0.03:
            e = None
        out.append((k1, k2, rnd.choice(labels), i, s, e))
    df = pd.DataFrame(out, columns=["k1", "k2", "lab", "id", "s", "e"])
    return df


def _spark_df(spark, pdf):
    return spark.createDataFrame(
        pdf, "k1 long, k2 string, lab string, id long, s timestamp_ntz, e timestamp_ntz")


@pytest.mark.parametrize("seed,labels,bucket", [
    (1, ("x",), 2048), (2, ("x",), 20), (3, ("x", "y"), 2048), (4, ("x", "y", "z"), 10),
    (5, ("x",), 2), (6, ("x", "y"), 1), (12, ("x", "y", "z", "w"), 4),
    (13, ("x",), 8), (14, ("x", "y"), 3), (15, ("x",), 2048), (16, ("x", "y", "z"), 1),
])
def test_hull_matches_rule(spark, seed, labels, bucket):
    pdf = _random_sessions(seed, labels=labels)
    expected = hull_by_rule(pdf)
    got = hull_intervals(_spark_df(spark, pdf), ["k1", "k2"], "s", "e", "id", labels=["lab"],
                         bucket_rows=bucket)
    cols = ["k1", "k2", "lab", "join_time", "leave_time"]
    assert rows_of(got, cols) == rows_of(expected, cols)


def test_hull_without_labels_equals_single_label(spark):
    pdf = _random_sessions(11)
    expected = hull_by_rule(pdf)
    got = hull_intervals(_spark_df(spark, pdf), ["k1", "k2"], "s", "e", "id", bucket_rows=5)
    cols = ["k1", "k2", "join_time", "leave_time"]
    assert rows_of(got, cols) == rows_of(expected, cols)


@pytest.mark.parametrize("seed,bucket", [(7, 2048), (8, 10), (9, 2), (10, 1)])
def test_islands_match_window_sql(spark, seed, bucket):
    pdf = _random_sessions(seed, with_bad=False)
    expected = duckdb.query_df(pdf, "s", ISLANDS_SQL).df()
    got = islands(_spark_df(spark, pdf), ["k1", "k2"], "s", "e", "id", bucket_rows=bucket)
    cols = ["k1", "k2", "island_start", "island_end", "n_sessions"]
    assert rows_of(got, cols) == rows_of(expected, cols)


def test_islands_invariants(spark):
    pdf = _random_sessions(21, n=600, with_bad=False)
    got = islands(_spark_df(spark, pdf), ["k1", "k2"], "s", "e", "id", bucket_rows=3).toPandas()
    assert got["n_sessions"].sum() == len(pdf)
    for _, grp in got.groupby(["k1", "k2"]):
        grp = grp.sort_values("island_start")
        ends = grp["island_end"].tolist()
        starts = grp["island_start"].tolist()
        assert all(starts[i + 1] > ends[i] for i in range(len(starts) - 1))


def test_edge_cases(spark):
    t = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    rows = [
        (1, "m", "a", 1, t(9, 0), t(9, 30)),   # touching chain 1-2
        (1, "m", "a", 2, t(9, 30), t(10, 0)),
        (1, "m", "a", 3, t(9, 40), t(9, 50)),  # inside 2
        (1, "m", "a", 4, t(12, 0), t(12, 10)),  # separate cluster, joins the hull (Q1)
        (1, "m", "a", 5, t(12, 5), t(12, 20)),
        (2, "m", "a", 6, t(9, 0), t(9, 10)),    # alone
        (3, "m", "a", 7, t(9, 0), t(9, 10)),    # same join time
        (3, "m", "a", 8, t(9, 0), t(9, 20)),
        (4, "m", "a", 9, t(9, 0), None),        # null leave, no hull in key
        (5, "m", "a", 10, t(9, 0), t(10, 0)),   # covers only a session without an end: unknown end
        (5, "m", "a", 11, t(9, 30), None),
    ]
    pdf = pd.DataFrame(rows, columns=["k1", "k2", "lab", "id", "s", "e"])
    got = hull_intervals(_spark_df(spark, pdf), ["k1", "k2"], "s", "e", "id", labels=["lab"])
    by_key = {}
    for r in got.collect():
        by_key.setdefault(r.k1, []).append((r.join_time, r.leave_time, r.duration_seconds))
    assert by_key[1] == [(t(9, 0), t(12, 20), 12000)]
    assert by_key[2] == [(t(9, 0), t(9, 10), 600)]
    assert by_key[3] == [(t(9, 0), t(9, 20), 1200)]
    assert by_key[4] == [(t(9, 0), None, None)]
    assert by_key[5] == [(t(9, 0), None, None)]
    isl = islands(_spark_df(spark, pdf), ["k1", "k2"], "s", "e", "id").filter("k1 = 1")
    assert sorted((r.island_start, r.island_end, r.n_sessions) for r in isl.collect()) == [
        (t(9, 0), t(10, 0), 3), (t(12, 0), t(12, 20), 2)]


def test_presence_ratio_boundaries(spark):
    iv = spark.createDataFrame(
        [("i1", "u1", 1800), ("i1", "u2", 1801), ("i2", "u1", 100), ("i3", "u1", None)],
        "meeting_instance_id string, user string, duration_seconds long")
    md = spark.createDataFrame(
        [("i1", 3600), ("i2", 0), ("i3", 50)],
        "meeting_instance_id string, meeting_duration_seconds long")
    out = {(r.meeting_instance_id, r.user): r for r in presence_ratio(
        iv, md, ["meeting_instance_id"], ["meeting_instance_id", "user"],
        ["meeting_duration_seconds"]).collect()}
    assert out[("i1", "u1")].has_participant_attended_flag is False  # exactly half
    assert out[("i1", "u1")].attendance_percentage == 0.5
    assert out[("i1", "u2")].has_participant_attended_flag is True
    assert out[("i2", "u1")].attendance_percentage is None  # zero-length meeting
    assert out[("i2", "u1")].has_participant_attended_flag is True  # 100 > 0
    assert out[("i3", "u1")].has_participant_attended_flag is False  # null duration
