"""Meeting platform: sessions with failovers, hosts and users, lesson links, and joins to other calendars."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollbook.catalog.attendance import SESSIONS_SQL, sessions
from rollbook.catalog.registry import register
from rollbook.operators.joins import week_join
from rollbook.plans.bronze import host_user_map, link_instances, one_to_one_violations, participant_sessions
from rollbook.sources.tables import read_table

#: Stand-in parameters (fixed so Spark and the oracle agree).
FAILOVER_GAP = 2 * 3600
SPRINT_DAYS = 10


# D4 ------------------------------------------------------------------------------------
@register("participant_failover", dates=["session_day"], stamps=["join_time", "leave_time"], sql=f"""
WITH {SESSIONS_SQL},
before AS (
  SELECT *, max(leave_time) OVER (PARTITION BY user_id, session_day ORDER BY join_time, leave_time DESC, session_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gone
  FROM sessions),
marks AS (
  SELECT *, sum(CASE WHEN gone IS NULL OR join_time > gone THEN 1 ELSE 0 END) OVER w AS stretch,
         sum(CASE WHEN gone IS NULL OR join_time > gone + INTERVAL {FAILOVER_GAP} SECOND THEN 1 ELSE 0 END) OVER w AS stay
  FROM before WINDOW w AS (PARTITION BY user_id, session_day ORDER BY join_time, leave_time DESC, session_id ROWS UNBOUNDED PRECEDING)),
stretches AS (SELECT user_id, session_day, stay, stretch, min(join_time) AS j, max(leave_time) AS l, count(*) AS n FROM marks GROUP BY ALL),
lasts AS (SELECT user_id, session_day, stay, label FROM marks
          QUALIFY row_number() OVER (PARTITION BY user_id, session_day, stay ORDER BY join_time DESC, leave_time DESC, session_id DESC) = 1)
SELECT user_id, session_day, min(j) AS join_time, max(l) AS leave_time, sum(date_sub('second', j, l))::BIGINT AS duration_seconds,
       count(*) - 1 AS failover_count, (date_sub('second', min(j), max(l)) - sum(date_sub('second', j, l)))::BIGINT AS failover_seconds,
       sum(n)::BIGINT AS n_records, any_value(label) AS participant_status
FROM stretches JOIN lasts USING (user_id, session_day, stay) GROUP BY user_id, session_day, stay""")
def participant_failover(spark, d):
    """A user's day is a meeting instance; the event type stands for the status."""
    return participant_sessions(sessions(spark, d).withColumnRenamed("label", "status"), "session_day", ["user_id"], "session_id",
                                gap_seconds=FAILOVER_GAP)


# D6 ------------------------------------------------------------------------------------
_HOSTS_SQL = """
hosts AS (SELECT s_suppkey AS host_id, ' User' || (s_suppkey - (s_suppkey % 5 = 0)::INT) || '@Example.org' AS email,
                 DATE '2024-01-01' + CAST(s_suppkey % 5 AS INTEGER) AS updated_at FROM supplier),
users AS (SELECT c_custkey AS uid, 'user' || (c_custkey - (c_custkey % 7 = 0)::INT) || '@example.org' AS email FROM customer),
pairs AS (SELECT host_id, uid, updated_at FROM hosts JOIN users ON lower(trim(hosts.email)) = users.email)"""


def _hosts(spark, d):
    # every so often a host or a user has the address of the one before
    mail = lambda key, n, name, at: F.concat(
        F.lit(name), (F.col(key) - (F.col(key) % n == 0).cast("int")).cast("string"), F.lit(at))
    hosts = read_table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("host_id"),
        mail("s_suppkey", 5, " User", "@Example.org").alias("email"),
        F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("s_suppkey") % 5).cast("int")).alias("updated_at"))
    users = read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("primary_user_service_id"), mail("c_custkey", 7, "user", "@example.org").alias("email"))
    return hosts, users


@register("host_user_map", doubles=["primary_user_service_id"], sql=f"""
WITH {_HOSTS_SQL},
firsts AS (SELECT host_id, count(DISTINCT uid) AS n_users, min(uid) AS uid, max(updated_at) AS upd FROM pairs GROUP BY host_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY upd DESC, host_id) AS place, count(*) OVER (PARTITION BY uid) AS n_hosts FROM firsts)
SELECT h.host_id, ifnull(n_users, 0) AS n_users, ifnull(n_hosts, 0) AS n_hosts,
       CASE WHEN place = 1 THEN uid END AS primary_user_service_id
FROM hosts h LEFT JOIN ranked r USING (host_id)""")
def host_user_map_q(spark, d):
    hosts, users = _hosts(spark, d)
    return host_user_map(hosts, users).select("host_id", "n_users", "n_hosts", F.col("primary_user_service_id").cast("double"))


@register("one_to_one_violations", sql=f"""
WITH {_HOSTS_SQL}
SELECT 'host_id' AS side, host_id::VARCHAR AS value, count(DISTINCT uid) AS n_partners FROM pairs GROUP BY host_id HAVING count(DISTINCT uid) > 1
UNION ALL
SELECT 'primary_user_service_id', uid::VARCHAR, count(DISTINCT host_id) FROM pairs GROUP BY uid HAVING count(DISTINCT host_id) > 1""")
def one_to_one_violations_q(spark, d):
    hosts, users = _hosts(spark, d)
    pairs = hosts.select("host_id", F.lower(F.trim("email")).alias("mail")).join(
        users.select("primary_user_service_id", F.col("email").alias("mail")), "mail")
    return one_to_one_violations(pairs, "host_id", "primary_user_service_id")


# D5 ------------------------------------------------------------------------------------
@register("instance_links", texts=[], doubles=["host_user_service_id"], sql="""
WITH lessons AS (
  SELECT DISTINCT event_type || '-' || CAST(ts AS DATE) AS lesson_id, 'lesson ' || event_type AS lesson_title, event_type AS program_code,
         CAST(ts AS DATE) + INTERVAL 8 HOUR AS s, CAST(ts AS DATE) + INTERVAL 16 HOUR AS e FROM events),
instances AS (
  SELECT event_id, user_id, ts, CASE WHEN event_id % 5 <> 0 THEN event_type END AS program_code FROM events),
best AS (
  SELECT event_id, min(l.lesson_id) AS lesson_id FROM instances i JOIN lessons l
  ON ts BETWEEN s - INTERVAL 30 MINUTE AND e AND ifnull(i.program_code = l.program_code, TRUE) GROUP BY event_id)
SELECT i.event_id AS meeting_instance_id, b.lesson_id, l.lesson_title, ifnull(i.program_code, l.program_code) AS program_code,
       c_custkey AS host_user_service_id, 'c' || c_custkey || '@example.org' AS host_email
FROM instances i LEFT JOIN best b USING (event_id) LEFT JOIN lessons l ON l.lesson_id = b.lesson_id
LEFT JOIN customer ON c_custkey = i.user_id""")
def instance_links(spark, d):
    """Events are instances, every fifth without a programme; a lesson per event type and day."""
    ev = read_table(spark, d, "events")
    day = F.to_date("ts").cast("timestamp_ntz")
    lessons = ev.select(
        F.concat_ws("-", "event_type", F.to_date("ts").cast("string")).alias("lesson_id"),
        F.concat(F.lit("lesson "), "event_type").alias("lesson_title"), F.col("event_type").alias("program_code"),
        (day + F.expr("INTERVAL 8 HOUR")).alias("lesson_start_ts"), (day + F.expr("INTERVAL 16 HOUR")).alias("lesson_end_ts")).distinct()
    instances = ev.select(F.col("event_id").alias("meeting_instance_id"), F.col("user_id").alias("host_id"),
                          F.col("ts").cast("timestamp_ntz").alias("start_time"),
                          F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("program_code"))
    hosts = read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("host_id"), F.col("c_custkey").cast("double").alias("primary_user_service_id"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.org")).alias("email"))
    return link_instances(instances, lessons, hosts).select(
        "meeting_instance_id", "lesson_id", "lesson_title", "program_code", "host_user_service_id", "host_email")


# J18, C10 ------------------------------------------------------------------------------
@register("calendar_range_join", dates=["day", "span_start", "span_end"], sql=f"""
WITH days AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS day FROM events),
bounds AS (SELECT event_type, min(day) AS first, max(day) AS last FROM days GROUP BY event_type),
sprints AS (
  SELECT event_type AS of, n AS nr, (first + CAST(n * {SPRINT_DAYS} AS INTEGER)) AS span_start,
         (first + CAST(n * {SPRINT_DAYS} + {SPRINT_DAYS} + n % 3 AS INTEGER)) AS span_end
  FROM bounds, range(0, 3) r(n) WHERE first IS NOT NULL)
SELECT event_type, day, nr, span_start, span_end FROM days LEFT JOIN sprints ON event_type = of AND day BETWEEN span_start AND span_end""",
          doubles=["nr"])
def calendar_range_join(spark, d):
    """Sprints of ten days and more, some overlapping, some days after the last one."""
    days = read_table(spark, d, "events").select("event_type", F.to_date("ts").alias("day")).distinct()
    first = days.groupBy(F.col("event_type").alias("of")).agg(F.min("day").alias("first"))
    n = (F.col("nr") * SPRINT_DAYS).cast("int")
    sprints = first.withColumn("nr", F.explode(F.sequence(F.lit(0), F.lit(2)))).select(
        "of", "nr", F.date_add("first", n).alias("span_start"), F.date_add("first", n + SPRINT_DAYS + F.col("nr") % 3).alias("span_end"))
    out = week_join(days, sprints, [("event_type", "of")], "day", "span_start", "left", "span_end", monday_weeks=False)
    return out.select("event_type", "day", F.col("nr").cast("double").alias("nr"), "span_start", "span_end")
