"""Bronze and silver transforms described for the meeting-platform data.

The landing table holds one JSON document per API record:
``endpoint_url, data (JSON text), execution_date``. Bronze models pick one
endpoint, extract typed fields, and keep ``execution_date``; silver models
keep the latest batch and build the participant fact and the meeting and
host dimensions.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.functions.json import parsed, variant_query, variant_scalar
from rollbook.functions.safe import seconds_between
from rollbook.operators.dims import latest_per_key
from rollbook.operators.intervals import sessionize
from rollbook.operators.ranges import span_join

# Fixed values that must equal the reference's.
VALID_MEETING_MIN_SECONDS = 20 * 60
VALID_MEETING_MIN_RATIO = 0.3


@dataclass(frozen=True)
class BronzeTable:
    """An endpoint and what is taken from its documents: ``{column: (path, Spark type or "json")}``."""
    endpoint: str
    fields: Mapping[str, tuple[str, str]]


# The meeting platform's public field names.
BRONZE_TABLES = {
    "meetings": BronzeTable("meetings", {
        "meeting_id": ("$.id", "string"), "meeting_uuid": ("$.uuid", "string"), "host_id": ("$.host_id", "string"),
        "topic": ("$.topic", "string"), "meeting_type": ("$.type", "int"), "start_time": ("$.start_time", "timestamp"),
        "duration_minutes": ("$.duration", "int"), "timezone": ("$.timezone", "string"), "join_url": ("$.join_url", "string"),
        "created_at": ("$.created_at", "timestamp")}),
    "meeting_instances": BronzeTable("past_meetings", {
        "meeting_instance_id": ("$.uuid", "string"), "meeting_id": ("$.id", "string"), "host_id": ("$.host_id", "string"),
        "topic": ("$.topic", "string"), "meeting_type": ("$.type", "int"), "start_time": ("$.start_time", "timestamp"),
        "end_time": ("$.end_time", "timestamp"), "duration_minutes": ("$.duration", "int"),
        "participants_count": ("$.participants_count", "int"), "total_minutes": ("$.total_minutes", "int"),
        "source": ("$.source", "string")}),
    "participants": BronzeTable("participants", {
        "participant_meeting_instance_id": ("$.id", "string"), "meeting_instance_id": ("$.meeting_uuid", "string"),
        "user_id": ("$.user_id", "string"), "name": ("$.name", "string"), "user_email": ("$.user_email", "string"),
        "join_time": ("$.join_time", "timestamp"), "leave_time": ("$.leave_time", "timestamp"),
        "duration_seconds": ("$.duration", "int"), "status": ("$.status", "string"), "failover": ("$.failover", "boolean")}),
    "hosts": BronzeTable("users", {
        "host_id": ("$.id", "string"), "email": ("$.email", "string"), "display_name": ("$.display_name", "string"),
        "first_name": ("$.first_name", "string"), "last_name": ("$.last_name", "string"),
        "created_at": ("$.created_at", "timestamp"), "updated_at": ("$.updated_at", "timestamp"), "status": ("$.status", "string")}),
    "polls": BronzeTable("polls", {
        "poll_id": ("$.id", "string"), "meeting_id": ("$.meeting_id", "string"), "title": ("$.title", "string"),
        "status": ("$.status", "string"), "anonymous": ("$.anonymous", "boolean"), "questions": ("$.questions", "json")}),
    "poll_results": BronzeTable("poll_results", {
        "meeting_instance_id": ("$.meeting_uuid", "string"), "poll_id": ("$.poll_id", "string"), "name": ("$.name", "string"),
        "user_email": ("$.email", "string"), "question_details": ("$.question_details", "json")}),
}


def _extracted(doc: Column, fields: Mapping[str, tuple[str, str]]) -> list[Column]:
    return [(variant_query(doc, path) if kind == "json" else variant_scalar(doc, path).try_cast(kind)).alias(out)
            for out, (path, kind) in fields.items()]


def bronze_extract(landing: DataFrame, endpoint: str, fields: Mapping[str, tuple[str, str]],
                   endpoint_col: str = "endpoint_url", data_col: str = "data",
                   batch_col: str = "execution_date") -> DataFrame:
    """Rows of one endpoint with ``{out: (json_path, spark_type)}`` fields extracted.

    Values that do not convert become NULL (``try_cast``); objects and arrays
    at a scalar path are NULL, as ``JSON_VALUE`` gives. Kind ``"json"`` keeps
    the node as JSON text (``JSON_QUERY``), for nested documents. Each document is parsed once.
    """
    rows = landing.filter(F.col(endpoint_col) == endpoint).select(parsed(data_col).alias("__doc"), batch_col)
    return rows.select(*_extracted(F.col("__doc"), fields), F.col(batch_col))


def bronze_fan_out(landing: DataFrame, tables: Mapping[str, BronzeTable] = BRONZE_TABLES, endpoint_col: str = "endpoint_url",
                   data_col: str = "data", batch_col: str = "execution_date") -> DataFrame:
    """All bronze tables in one pass: ``bronze_table``, the batch, and a struct column per table, null but for the row's own.

    Every document is parsed once. Records of endpoints that no table names are left out.
    """
    of = F.create_map(*[F.lit(x) for name, t in tables.items() for x in (t.endpoint, name)])
    rows = landing.filter(F.col(endpoint_col).isin([t.endpoint for t in tables.values()])) \
        .select(of[F.col(endpoint_col)].alias("bronze_table"), F.col(batch_col), parsed(data_col).alias("__doc"))
    return rows.select("bronze_table", batch_col, *[
        F.when(F.col("bronze_table") == name, F.struct(*_extracted(F.col("__doc"), t.fields))).alias(name)
        for name, t in tables.items()])


def write_bronze(landing: DataFrame, path: str, tables: Mapping[str, BronzeTable] = BRONZE_TABLES,
                 batch_col: str = "execution_date", **columns: str) -> None:
    """Write all bronze tables with one scan of the landing table, a folder per table and batch."""
    bronze_fan_out(landing, tables, batch_col=batch_col, **columns).write.mode("overwrite") \
        .partitionBy("bronze_table", batch_col).parquet(path)


def read_bronze(spark: SparkSession, path: str, table: str, latest: bool = False, batch_col: str = "execution_date") -> DataFrame:
    """One bronze table as written; ``latest``: its last batch alone (found from the folders, no column is read for it)."""
    rows = spark.read.parquet(path).filter(F.col("bronze_table") == table)
    if latest:
        rows = latest_batch(rows, batch_col)
    return rows.select(f"{table}.*", batch_col)


def latest_batch(df: DataFrame, batch_col: str = "execution_date",
                 per: Sequence[str] = ()) -> DataFrame:
    """Rows of the most recent batch (overall, or per ``per`` key).

    The max is a tiny aggregate applied back with a semi-join, so no window
    has to hold a whole key.
    """
    latest = df.groupBy(*per).agg(F.max(batch_col).alias(batch_col))
    return df.join(latest, on=[*per, batch_col], how="left_semi")


def valid_meetings(instances: DataFrame, participants: DataFrame, fellows: DataFrame,
                   instance_key: str = "meeting_instance_id", program_key: str = "program_code",
                   person_key: str = "primary_user_service_id",
                   min_seconds: int = VALID_MEETING_MIN_SECONDS,
                   min_ratio: float = VALID_MEETING_MIN_RATIO) -> DataFrame:
    """Meetings longer than ``min_seconds`` attended by more than ``min_ratio`` of the fellows.

    ``instances``: one row per meeting instance with ``program_key`` and
    ``meeting_duration_seconds``; ``participants``: attendance rows;
    ``fellows``: the learners per programme.
    """
    attended = participants.groupBy(instance_key).agg(F.count_distinct(person_key).alias("n_participants"))
    roster = fellows.groupBy(program_key).agg(F.count_distinct(person_key).alias("n_fellows"))
    j = instances.join(attended, instance_key, "left").join(roster, program_key, "left")
    ratio = F.try_divide(F.coalesce(F.col("n_participants"), F.lit(0)).cast("double"),
                         F.col("n_fellows").cast("double"))
    return j.withColumn("attendance_ratio", ratio).filter(
        (F.col("meeting_duration_seconds") > min_seconds) & (F.col("attendance_ratio") > min_ratio))


#: A drop and a re-join at most so far apart are one session.
FAILOVER_GAP_SECONDS = 5 * 60


def participant_fact(participants: DataFrame, user_map: DataFrame, email_col: str = "user_email",
                     join_col: str = "join_time", leave_col: str = "leave_time") -> DataFrame:
    """Participant sessions linked to user ids by e-mail, with duration in seconds.

    ``user_map``: ``email, primary_user_service_id`` (one row per e-mail).
    The original name and e-mail are kept for verification.
    """
    m = user_map.select(F.lower(F.trim("email")).alias("__email"), "primary_user_service_id")
    p = participants.withColumn("__email", F.lower(F.trim(F.col(email_col))))
    return p.join(m, "__email", "left").drop("__email") \
        .withColumn("duration", seconds_between(join_col, leave_col))


def participant_sessions(fact: DataFrame, instance_key: str = "meeting_instance_id",
                         person_cols: Sequence[str] = ("primary_user_service_id", "user_email", "name"),
                         id_col: str = "participant_meeting_instance_id", join_col: str = "join_time", leave_col: str = "leave_time",
                         status_col: str | None = "status", gap_seconds: int = FAILOVER_GAP_SECONDS) -> DataFrame:
    """One row per participant session of a meeting instance, with failovers and status.

    A participant's records that follow each other within ``gap_seconds`` are one
    session: ``failover_count`` and ``failover_seconds`` tell how often and for how
    long the participant was gone, ``duration_seconds`` how long they were there,
    ``participant_status`` is the status of the last record. A participant is
    the combination of ``person_cols``; those missing are compared as values.
    """
    marks = {c: f"__has_{c}" for c in person_cols}
    filled = fact.withColumns({m: F.col(c).isNotNull() for c, m in marks.items()}) \
        .withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in person_cols})
    out = sessionize(filled, [instance_key, *person_cols, *marks.values()], join_col, leave_col, id_col, gap_seconds,
                     last=[status_col] if status_col else [])
    out = out.withColumns({c: F.when(F.col(m), F.col(c)).cast(fact.schema[c].dataType) for c, m in marks.items()}).drop(*marks.values())
    return out.withColumnRenamed(status_col, "participant_status") if status_col else out


def meeting_instance_dim(instances: DataFrame, participants: DataFrame,
                         instance_key: str = "meeting_instance_id", tz_col: str | None = None,
                         start_col: str = "start_time", end_col: str = "end_time") -> DataFrame:
    """Instance metadata with UTC start/end, participant count and duration."""
    counts = participants.groupBy(instance_key).agg(F.count_distinct("participant_meeting_instance_id")
                                                    .alias("participants_count"))
    i = instances
    if tz_col:
        i = i.withColumn(start_col, F.to_utc_timestamp(F.col(start_col), F.col(tz_col))) \
            .withColumn(end_col, F.to_utc_timestamp(F.col(end_col), F.col(tz_col)))
    return i.join(counts, instance_key, "left") \
        .withColumn("participants_count", F.coalesce(F.col("participants_count"), F.lit(0))) \
        .withColumn("meeting_duration_seconds", seconds_between(start_col, end_col))


def link_instances(instances: DataFrame, lessons: DataFrame, hosts: DataFrame | None = None,
                   instance_key: str = "meeting_instance_id", start_col: str = "start_time", host_key: str = "host_id",
                   early_seconds: int = 30 * 60) -> DataFrame:
    """Instances with the lesson and programme they held, and their host's user.

    ``instances`` carry ``program_code`` (or none), ``lessons`` ``lesson_id,
    lesson_title, program_code, lesson_start_ts, lesson_end_ts``. An instance belongs
    to the lesson of its programme in whose time, or up to ``early_seconds`` before it,
    the instance starts; of several, to the one that starts nearest (then the
    smaller id). An instance without a programme takes the programme of the lesson found.
    """
    spans = lessons.select(F.col("lesson_id").alias("__lesson"), F.col("lesson_title").alias("__title"),
                           F.col("program_code").alias("__program"), F.col("lesson_start_ts").alias("__start"),
                           (F.col("lesson_start_ts") - F.make_dt_interval(secs=F.lit(early_seconds))).alias("__low"),
                           F.col("lesson_end_ts").alias("__high"))
    points = instances.select(instance_key, F.col("program_code").alias("__own"), F.col(start_col).alias("__at"))
    named, nameless = (points.filter(c) for c in (F.col("__own").isNotNull(), F.col("__own").isNull()))
    held = span_join(named, spans, [("__own", "__program")], "__at", "__low", "__high", how="inner") \
        .unionByName(span_join(nameless, spans, [], "__at", "__low", "__high", how="inner"))
    away = F.abs(seconds_between("__start", "__at"))
    # the nearest is a partial aggregate, not a window over an instance's lessons
    nearest = held.groupBy(instance_key).agg(F.min(F.struct(away.alias("away"), "__lesson", "__title", "__program")).alias("n"))
    out = instances.join(nearest, instance_key, "left").withColumns({
        "lesson_id": F.col("n.__lesson"), "lesson_title": F.col("n.__title"),
        "program_code": F.coalesce("program_code", F.col("n.__program"))}).drop("n")
    if hosts is not None:
        h = hosts.select(host_key, F.col("primary_user_service_id").alias("host_user_service_id"),
                         F.col("email").alias("host_email"))
        out = out.join(h, host_key, "left")
    return out


def host_dim(hosts: DataFrame, host_key: str = "host_id", order: str = "execution_date",
             tie_breakers: Sequence[str] = ("updated_at",)) -> DataFrame:
    """Latest record per host: one row per host (one host <-> one user)."""
    return latest_per_key(hosts, [host_key], order=[order], tie_breakers=list(tie_breakers))


def one_to_one_violations(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Values of either side with more than one partner: ``side, value, n_partners``.

    Both directions are counted in one pass over the distinct pairs (two grouping sets).
    """
    distinct = pairs.select(left, right).dropna().distinct()
    sides = distinct.groupingSets([[F.col(left)], [F.col(right)]], F.col(left), F.col(right)) \
        .agg(F.grouping_id().alias("g"), F.count(F.lit(1)).alias("n_partners")).filter(F.col("n_partners") > 1)
    is_left = F.col("g") == 1  # the left column is kept, the right one is not
    return sides.select(F.when(is_left, F.lit(left)).otherwise(F.lit(right)).alias("side"),
                        F.when(is_left, F.col(left).cast("string")).otherwise(F.col(right).cast("string")).alias("value"), "n_partners")


def host_user_map(hosts: DataFrame, users: DataFrame, host_key: str = "host_id", user_key: str = "primary_user_service_id",
                  email_col: str = "email", order: Sequence[str] = ("updated_at",)) -> DataFrame:
    """One row per host with at most one user, and no user at two hosts.

    Hosts meet users by e-mail (trimmed, any case). Where the mapping is not
    one-to-one it is settled alike in every run: a host takes its user of the
    smallest id, a user stays with the host whose ``order`` columns are latest (then
    the smallest host id), and a host that loses its user has none. ``n_users`` and
    ``n_hosts`` (of that user) show where it had to be settled. ``hosts``: a row per host (``host_dim``).
    """
    u = users.select(F.lower(F.trim(F.col(email_col))).alias("__mail"), F.col(user_key).alias("__user")).dropna().distinct()
    pairs = hosts.select(host_key, F.lower(F.trim(F.col(email_col))).alias("__mail"), *order).join(u, "__mail")
    first = pairs.groupBy(host_key).agg(F.count_distinct("__user").alias("n_users"), F.min("__user").alias("__user"),
                                        *[F.max(c).alias(f"__o_{c}") for c in order])
    # latest first, then the smallest id: a maximum of the order, then a minimum among those that have it
    rank = F.struct(*[F.col(f"__o_{c}") for c in order])
    best = first.groupBy("__user").agg(F.count(F.lit(1)).alias("n_hosts"), F.max(rank).alias("__best"))
    settled = first.join(best, "__user").withColumn("__is", F.struct(*[F.col(f"__o_{c}") for c in order]).eqNullSafe(F.col("__best")))
    keeper = settled.filter("__is").groupBy("__user").agg(F.min(host_key).alias("__keeper"))
    out = settled.join(keeper, "__user", "left").select(
        host_key, "n_users", "n_hosts", F.when(F.col(host_key) == F.col("__keeper"), F.col("__user")).alias(user_key))
    return hosts.join(out, host_key, "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_users", "n_hosts")})
