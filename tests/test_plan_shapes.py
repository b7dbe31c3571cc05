"""Guardrails on physical plans: the scale properties the operators promise."""

import datetime as dt
import re

from pyspark.sql import functions as F

from rollbook.operators.dims import latest_per_key
from rollbook.operators.intervals import hull_intervals, islands
from rollbook.operators.joins import any_key_match


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _sessions(spark):
    rows = [(k % 3, "m", f"e{k % 2}", k, dt.datetime(2024, 1, 1, 9) + dt.timedelta(minutes=7 * k),
             dt.datetime(2024, 1, 1, 9) + dt.timedelta(minutes=7 * k + 20)) for k in range(60)]
    return spark.createDataFrame(rows, "k1 long, k2 string, lab string, id long, s timestamp_ntz, e timestamp_ntz")


def _windows(plan: str):
    return [line for line in plan.splitlines() if re.search(r"\bWindow \[", line)]


def test_island_windows_never_span_a_whole_key(spark):
    wins = _windows(_plan(islands(_sessions(spark), ["k1", "k2"], "s", "e", "id")))
    assert wins, "expected window operators"
    # row-level windows are partitioned by the bucket; the only windows keyed
    # by the key alone run over the one-row-per-bucket summary, ordered by bucket
    assert all("__bucket" in w for w in wins), wins


def _executed(df) -> str:
    df.collect()
    return _plan(df).split("== Initial Plan ==")[0]


def test_hull_moves_rows_once_and_copies_none_per_label(spark):
    """Shuffles: borders, sessions to (key, bucket), bucket tables, hulls; the others are reuses of these."""
    for labels in (["lab"], []):
        plan = _executed(hull_intervals(_sessions(spark), ["k1", "k2"], "s", "e", "id", labels=labels))
        moved = [line for line in plan.splitlines() if re.search(r"\bExchange (hash|range|single)", line)]
        assert len([line for line in moved if "ReusedExchange" not in line]) <= 4, plan
        assert not _windows(plan)
        # what is aggregated by label comes from the sessions' own entries: no join brings labels to sessions
        assert not re.search(r"Join \[.*lab", plan)


def test_interval_plans_have_no_pair_join(spark):
    df = _sessions(spark)
    plan = _plan(hull_intervals(df, ["k1", "k2"], "s", "e", "id", labels=["lab"]))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    # no join condition compares a start with another row's end (the overlap self-join)
    assert not re.search(r"Join .*\(s#\d+ <= s#\d+\)", plan)


def test_latest_per_key_is_a_partial_aggregate(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"),
                                  (F.col("id") * 3).alias("w"))
    plan = _plan(latest_per_key(df, ["k"], ["v"]))
    assert "Window" not in plan
    assert re.search(r"(HashAggregate|SortAggregate|ObjectHashAggregate).*partial_max", plan)


def test_or_join_is_planned_as_equi_joins(spark):
    left = spark.createDataFrame([(1, dt.date(2024, 1, 1), "a", "b", "c")],
                                 "u int, day date, e1 string, e2 string, e3 string")
    right = spark.createDataFrame([(dt.date(2024, 1, 1), "b")], "d date, k string")
    plan = _plan(any_key_match(left, right, [("day", "d")], ["e1", "e2", "e3"], "k", "w"))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_rollup_reads_its_base_once(spark, tmp_path):
    from rollbook.operators.rollup import regional_rollup

    rows = [("P1", "DEU", "x", 1), ("P1", "FRA", "x", 2), ("P1", "FRA", "x", 2), ("P2", "DEU", "x", 4), (None, "DEU", "x", 5),
            (None, "FRA", "x", 6), ("P1", "USA", "y", 7), ("P3", None, "x", 8), ("P1", "ITA", "y", 9)]
    spark.createDataFrame(rows, "program string, country string, phase string, n int").write.parquet(str(tmp_path / "base"))
    base = spark.read.parquet(str(tmp_path / "base"))
    region = [("P1", "EUR", "x", 5), ("P1", "EUR", "y", 9)]
    codes = spark.createDataFrame([("DEU",), ("FRA",), ("ITA",), ("DEU",)], "code string")
    for members in (["DEU", "FRA", "ITA", "DEU"], codes, [*"ABCDEFGH", *map(str, range(70)), "DEU", "FRA", "ITA"]):
        out = regional_rollup(base, "program", ["program", "phase"], "country", members, "EUR", {"n": F.sum("n")})
        assert sorted(map(tuple, out.collect()), key=str) == sorted(rows + region, key=str)
        assert _plan(out).split("== Initial Plan ==")[0].count("FileScan parquet") == 1
    three = regional_rollup(base, "program", ["program", "phase"], "country", ["DEU", "FRA", "ITA"], "EUR", {"n": F.sum("n")}, 4)
    assert three.count() == len(rows)
