"""Gold's product of participants and lessons: what is joined to it, and how often it is moved."""

import re

from pyspark.sql import functions as F

from rollbook.context import RunContext
from rollbook.operators.joins import substring_join
from rollbook.plans import attendance
from tests.conftest import rows_of
from tests.fixtures import attendance_tables

CTX = RunContext.at("2025-01-22 12:00")


def test_gold_is_the_same_from_repeated_programmes(spark):
    """Weeks meet the lessons before the product: a programme that is listed twice changes nothing."""
    t, once = attendance_tables(spark), attendance.gold(attendance_tables(spark), CTX)
    t.register("programs", t.ref("programs").unionAll(t.ref("programs")))
    actual = f"attendance_overall_status <> '{attendance.UPCOMING}'"
    assert rows_of(attendance.gold(t, CTX).filter(actual)) == rows_of(once.filter(actual))


def test_gold_rows_of_the_product_meet_staging_without_a_distinct(spark, tmp_path):
    """From the product to the join with staging, rows move once: no DISTINCT, weeks or waivers in between."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    staged = str(tmp_path / "staged")
    attendance.staging(attendance_tables(spark), CTX).write.parquet(staged)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = attendance.gold(attendance_tables(spark), CTX, staged=spark.read.parquet(staged))
        lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    at = next(i for i, x in enumerate(lines) if re.search(r"SortMergeJoin .*__a_pc", x))
    until = next(i for i, x in enumerate(lines) if i > at and re.search(r"SortMergeJoin .*__part", x))
    between = lines[at + 1:until]
    assert sum("Exchange" in x for x in between) == 1 and not any("Aggregate" in x or "Join" in x for x in between), between


def test_substring_join_equals_like_for_plain_and_wild_texts(spark):
    texts = ["a%b", "a_b", "axb", "a\\%b", "lesson 1", "lesson 10\nend", "", "%", "_", "\\_", None, "b"]
    left = spark.createDataFrame([(k, x) for k in (1, None) for x in texts], "k int, t string")
    right = spark.createDataFrame([(1, x) for x in ["a%b", "a_b", "x", "\\%", "lesson 1", "", "%", "\\_", "1_", None]], "j int, p string")
    for how in ("inner", "left"):
        want = left.join(right, F.expr("k = j AND t LIKE concat('%', p, '%')"), how)
        assert rows_of(substring_join(left, right, [("k", "j")], "t", "p", how)) == rows_of(want)


def test_published_gold_is_not_moved_for_the_exemptions(spark, tmp_path):
    """Rows laid out by programme and learner for staging stay there up to the join with the exemptions, and behind it."""
    tables, name = attendance_tables(spark), "staging_of_test_gold_grid"
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    staged = attendance.write_staging(attendance.staging(tables, CTX), str(tmp_path / "s"), name, 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with attendance.partial_key_joins(spark):
            plan = attendance.gold(tables, CTX, staged=staged, buckets=8)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql(f"DROP TABLE {name}")
    lines = plan.splitlines()
    until = next(i for i, x in enumerate(lines) if re.search(r"SortMergeJoin .*__a_pc", x))
    assert any(re.search(r"SortMergeJoin .*learner_id", x) for x in lines[:until])
    assert not any("Exchange" in x for x in lines[:until]), lines[:until]


def test_published_staging_is_made_where_it_is_written(spark, tmp_path, monkeypatch):
    """Learners lie in the table's buckets before they meet their facts and lessons: no row of the grid, and no learner with
    its maps, is moved to be joined or written, and each bucket is one file."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    name = "staging_of_test_made_where_written"
    try:
        rows = attendance.staging(attendance_tables(spark), CTX, buckets=16)
        plan = rows._jdf.queryExecution().executedPlan().toString().splitlines()
        staged = attendance.write_staging(rows, str(tmp_path / "s"), name, 16, laid_out=True)
        assert rows_of(staged) == rows_of(attendance.staging(attendance_tables(spark), CTX))
        buckets = [int(re.search(r"_(\d{5})\.", x).group(1)) for x in staged.inputFiles()]
        assert len(buckets) == len(set(buckets)) > 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    join = next(i for i, x in enumerate(plan) if "SortMergeJoin" in x)
    assert not any("Exchange" in x for x in plan[:join])
    maps = next(i for i, x in enumerate(plan) if i > join and "Generate" in x)  # the learners' side comes first
    first = next(i for i, x in enumerate(plan) if i > join and "Exchange" in x)
    assert maps < first and "REPARTITION_BY_NUM" in plan[first], plan[join:first + 1]
    published, write = [], attendance.write_staging
    monkeypatch.setattr(attendance, "write_staging", lambda *a, **k: published.append((a[3], k)) or write(*a, **k))
    attendance.publish(attendance_tables(spark), CTX, str(tmp_path / "p"), str(tmp_path / "g"), staging_table=f"{name}_p")
    spark.sql(f"DROP TABLE IF EXISTS {name}_p")
    assert published == [(int(spark.conf.get("spark.sql.shuffle.partitions")), {"laid_out": True})]
