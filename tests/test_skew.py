"""Heavy keys are dealt to several tasks; joins keep their rows."""

import random

from pyspark.sql import functions as F

from rollbook.context import RunContext
from rollbook.operators import skew
from rollbook.operators.weeks import upcoming_scaffold
from tests.conftest import rows_of


def _sides(spark, n=4000):
    rnd = random.Random(2)
    left = [("big" if i % 2 else rnd.choice(["a", "b", None]), i, "x") for i in range(n)]
    right = [("big", k) for k in range(3)] + [("a", 9), ("a", 9), ("c", 1), (None, 5)]
    return spark.createDataFrame(left, "k string, id long, part string"), spark.createDataFrame(right, "k string, v long")


def test_salted_join_equals_plain_join(spark):
    left, right = _sides(spark)
    for how in ("inner", "left"):
        for bound in (100, 10**9):
            assert rows_of(skew.salted_join(left, right, ["k"], how, rows_per_task=bound)) == rows_of(left.join(right, ["k"], how))
    assert skew.salted_join(left.limit(0), right, ["k"]).count() == 0
    assert skew.salted_join(left, right.limit(0), ["k"], "left", 100).count() == left.count()


def test_only_heavy_keys_are_dealt(spark):
    left, _ = _sides(spark)
    heavy = {r.k: r["__parts"] for r in skew.heavy_keys(left, ["k"], 900).collect()}
    assert set(heavy) == {"big"} and heavy["big"] == 3  # 2,000 rows; a and b have some 670 each


def test_half_of_all_learners_in_one_programme_are_spread(spark):
    """Gold's grids: no task holds more than a bound of the programme's learners."""
    left, _ = _sides(spark)
    people = left.filter("k IS NOT NULL").select(F.col("k").alias("program_code"), F.col("id").alias("person"))
    spine = spark.createDataFrame([("big", i) for i in range(4)], "program_code string, week_number long").select(
        "program_code", "week_number", F.to_date(F.lit("2030-01-07")).alias("week_start_date"),
        F.to_date(F.lit("2030-01-13")).alias("week_end_date"))
    today = RunContext.at("2025-12-05 20:00").today_utc()
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = upcoming_scaffold(people, spine, "program_code", today, ["person"], rows_per_task=100)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 2000 * 4 and len(sizes) >= 6 and max(sizes) <= 8000 / 2


def test_attended_cells_make_the_originals_combinations(spark):
    """Own rows first, then those of the accounts that the alias table names; stated in plain loops."""
    from rollbook.plans import attendance as plan

    rnd = random.Random(4)
    gap = lambda v: None if rnd.random() < 0.3 else v
    rows = [(f"u{rnd.randrange(6)}", f"P{rnd.randrange(2)}", f"L{rnd.randrange(2)}", gap("m"), gap(f"i{rnd.randrange(3)}"), gap(1),
             gap(2), gap(3), gap(rnd.randrange(3)), gap(0.5), gap(True)) for _ in range(60)]
    alias = [(f"u{rnd.randrange(8)}", gap(f"u{rnd.randrange(8)}")) for _ in range(12)]
    compute = spark.createDataFrame(rows, "primary_user_service_id string, program_code string, lesson_id string, meeting_id string, "
                                          "meeting_instance_id string, meeting_start_time_ts int, meeting_end_time_ts int, "
                                          "meeting_duration_seconds int, attendance_duration_seconds int, "
                                          "attendance_percentage double, has_participant_attended_flag boolean")
    table = spark.createDataFrame(alias, "primary_user_service_id string, primary_alt_account_user_service_id string")

    class Registry:
        def ref(self, name):
            return table

    nothing = (None,) * 8
    for mode in ("primary", "alternate"):
        looks = {(p, p if mode == "primary" else a) for p, a in alias if a is not None}
        cells = {r[:3] for r in rows} | {(p, *r[1:3]) for p, look in looks for r in rows if r[0] == look}
        want = set()
        for who, *rest in cells:
            own = [r[3:] for r in rows if r[:3] == (who, *rest)] or [nothing]
            for look in {k for p, k in looks if p == who} or {None}:
                other = [r[3:] for r in rows if r[:3] == (look, *rest)] or [nothing]
                want |= {(who, *rest, *(x if x is not None else y for x, y in zip(a, b))) for a in own for b in other}
        got = plan.attended_cells(Registry(), compute, plan.AttendanceOptions(alt_key=mode)).collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want
