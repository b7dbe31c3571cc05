"""

1. Interval hull: the original's overlap self-join (as Spark SQL) vs the
   pair-free operator, on events as sessions keyed by (user, day), and on a
   dense key (day only, ~3,300 sessions per key at sf0.1) where the self-join
   emits every overlapping pair.
2. OR join: ``day = d AND key IN (e1, e2, e3)`` as one OR-residual join vs
   ``any_key_match`` (one equi-join per key).

Prints one JSON line with median seconds (noop sink, one warm-up).
Usage: python tools/compare_forms.py [sf_dir] [runs]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

SELF_JOIN_SQL = """
WITH ov AS (
  SELECT a.k1, a.k2, least(min(a.join_time), min(b.join_time)) AS join_time,
         greatest(max(a.leave_time), max(b.leave_time)) AS leave_time
  FROM s a JOIN s b ON a.k1 = b.k1 AND a.k2 = b.k2 AND a.join_time <= b.join_time
   AND a.leave_time >= b.join_time AND a.session_id <> b.session_id
  GROUP BY a.k1, a.k2),
non AS (
  SELECT s.* FROM s LEFT JOIN ov ON s.k1 = ov.k1 AND s.k2 = ov.k2
  WHERE ov.k1 IS NULL OR s.join_time < ov.join_time OR s.leave_time > ov.leave_time)
SELECT k1, k2, join_time, leave_time FROM ov
UNION ALL SELECT k1, k2, join_time, leave_time FROM non"""


def timed(build, runs):
    out = []
    for i in range(runs + 1):
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        if i:
            out.append(time.perf_counter() - t0)
    return round(statistics.median(out), 3)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    runs = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    from rollbook.catalog.attendance import sessions
    from rollbook.functions.text import normalize_email
    from rollbook.operators.intervals import hull_intervals
    from rollbook.operators.joins import any_key_match
    from rollbook.session import build_session
    from rollbook.sources.tables import read_table
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    s = sessions(spark, sf)
    res = {}
    for name, k1 in (("user_day", F.col("user_id")), ("day_only", F.lit(0).cast("long"))):
        v = s.select(k1.alias("k1"), F.col("session_day").alias("k2"), "session_id", "join_time", "leave_time")
        v.createOrReplaceTempView("s")
        pairs = spark.sql("SELECT count(*) AS n FROM s a JOIN s b ON a.k1 = b.k1 AND a.k2 = b.k2 "
                          "AND a.join_time <= b.join_time AND a.leave_time >= b.join_time "
                          "AND a.session_id <> b.session_id").first().n
        res[f"hull_{name}_overlap_pairs"] = pairs
        res[f"hull_{name}_self_join_s"] = timed(lambda: spark.sql(SELF_JOIN_SQL), runs)
        res[f"hull_{name}_pair_free_s"] = timed(
            lambda: hull_intervals(v, ["k1", "k2"], "join_time", "leave_time", "session_id"), runs)

    ev = read_table(spark, sf, "events")
    cu = read_table(spark, sf, "customer").select("c_custkey", "c_name")
    left = ev.join(cu, ev["user_id"] == cu["c_custkey"]).select(
        "user_id", F.to_date("ts").alias("day"), F.lower("c_name").alias("e1"),
        F.concat(F.lower("c_name"), F.lit("@primary")).alias("e2"),
        F.concat(F.lower("c_name"), F.lit("@alt")).alias("e3")).distinct()
    right = ev.filter(F.col("event_type") == "signup").join(cu, ev["user_id"] == cu["c_custkey"]).select(
        F.to_date("ts").alias("waived_day"),
        F.when(F.col("value") < 100, F.lower("c_name")).when(F.col("value") < 300,
               F.concat(F.lower("c_name"), F.lit("@primary")))
        .otherwise(F.concat(F.lower("c_name"), F.lit("@alt"))).alias("k"))

    def or_join():
        j = left.join(right, (left["day"] == right["waived_day"])
                      & ((right["k"] == left["e1"]) | (right["k"] == left["e2"]) | (right["k"] == left["e3"])),
                      "left")
        return j.groupBy("user_id", "day", "e1", "e2", "e3").agg(F.max(F.col("k").isNotNull()).alias("w"))

    res["or_join_residual_s"] = timed(or_join, runs)
    res["or_join_equi_per_key_s"] = timed(
        lambda: any_key_match(left, right, [("day", "waived_day")],
                              [normalize_email("e1"), normalize_email("e2"), normalize_email("e3")], "k", "w"),
        runs)
    res["sf"] = sf
    print(json.dumps(res))


if __name__ == "__main__":
    main()
