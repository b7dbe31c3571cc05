"""Interval merging and presence ratios (multi-device meeting sessions).

Both merges split a key by start time into buckets of about ``bucket_rows``
rows: every row is, by its hash, a border with probability 1 / ``bucket_rows``,
so the borders of a key are a sample of its start times and its buckets equally
deep wherever the rows lie. A key below that size has no border and one bucket; a
key with a third of all rows has many, be it inside one hour. Borders per key
are thinned to ``MOST_BORDERS``; rows with one start time share a bucket.

``islands``: true merge of overlapping or touching closed intervals per key.
It is a prefix scan (running max of the end time), written as two levels so
that no single key has to fit into one task:

1. a window over ``(key, bucket)`` gives the running max end *within* the bucket;
2. a per-``(key, bucket)`` summary (one row per bucket) carries the max end
   of all earlier buckets of the key and their last island start;
3. a row opens a new island when its start is after both; an island is named
   by its first row, found by a running max inside the bucket or the carried
   start from earlier buckets.

``hull``: the reference's multi-device rule. Per key and label it takes the
earliest join and latest leave over every session taking part in an overlap
pair (``a.join <= b.join <= a.leave``, ``a != b``), then keeps the sessions
that stick out of that hull. It never forms the pairs, and copies no row per
label: what a session ``a`` reaches is a range of the key's sessions in order of
start, and only the last end in that range matters. A sparse table per bucket
and one over the buckets of a key give that range maximum; a range over several
buckets is the rest of its first one, the buckets between, and the beginning of
its last one, to which the session is entered a second time. As a maximum falls
into parts, each part goes to the label's aggregate by itself. Rows move once, to
``(key, bucket)``; bucket tables and hulls are brought to them.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions.arrays import count_before, max_table, range_max
from rollbook.functions.safe import seconds_between

_B, _BORDERS = "__bucket", "__borders"

#: Rows of a bucket, on average, and the most borders of a key (a key's buckets grow beyond the product of both).
BUCKET_ROWS, MOST_BORDERS = 2048, 1024


def _any_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols]) if cols else F.lit(False)


def _bordered(rows: DataFrame, keys: Sequence[str], start: str, bucket_rows: int) -> DataFrame:
    """The rows with their key's borders in order (null: none), a sample of its start times."""
    chance = F.pmod(F.xxhash64(*rows.columns), F.lit(bucket_rows))
    borders = rows.filter((chance == 0) & F.col(start).isNotNull()).groupBy(*keys) \
        .agg(F.array_sort(F.collect_set(start)).alias(_BORDERS))
    step = F.ceil(F.size(_BORDERS) / F.lit(MOST_BORDERS)).cast("int")
    thin = F.when(step <= 1, F.col(_BORDERS)).otherwise(F.filter(_BORDERS, lambda _, i: i % step == 0))
    return rows.join(borders.withColumn(_BORDERS, thin), list(keys), "left")


def _bucket_of(time: Column) -> Column:
    return F.coalesce(F.when(F.col(_BORDERS).isNotNull(), count_before(F.col(_BORDERS), time, inclusive=True)), F.lit(0))


def _row_key(start: str, end: str, id_col: str) -> Column:
    """Struct that sorts like the scan order (start asc, end desc, id asc)."""
    return F.struct(F.col(start).alias("s"),
                    (-F.unix_micros(F.col(end).cast("timestamp"))).alias("ne"),
                    F.col(id_col).alias("i"))


def scan_islands(df: DataFrame, keys: Sequence[str], start: str, end: str, id_col: str,
                 bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Tag each row with ``island_key`` (its island's first row) and ``is_island_start``.

    Rows must have non-null keys, start and end. Order inside a key is
    (start asc, end desc, id asc): touching ends (``start == previous max end``)
    stay in one island, as in the closed-interval overlap test.

    One pass per ``(key, bucket)`` gives the running max end before each row
    and the bucket's last *local* start (a row after every earlier row of its
    bucket). Local starts later in a bucket have later starts, so whether the
    bucket's last local start is a real start only depends on the max end of
    the earlier buckets. The per-bucket summary therefore needs no second
    pass: two running aggregates over the (small) summary give each bucket
    the earlier buckets' max end and their last real start.
    """
    keys = list(keys)
    # Same explicit filter on both uses of ``rows`` so their shuffles are reused.
    rows = _bordered(df, keys, start, bucket_rows).withColumn(_B, _bucket_of(F.col(start))).drop(_BORDERS) \
        .filter(F.col(_B).isNotNull())
    order = [F.col(start).asc(), F.col(end).desc(), F.col(id_col).asc()]
    w_local = Window.partitionBy(*keys, _B).orderBy(*order)
    key = _row_key(start, end, id_col)

    rows = rows.withColumn("__m", F.max(end).over(w_local.rowsBetween(Window.unboundedPreceding, -1))) \
        .withColumn("__local_start", F.col("__m").isNull() | (F.col(start) > F.col("__m")))
    summary = rows.groupBy(*keys, _B).agg(
        F.max(end).alias("__bmax"),
        F.max(F.when(F.col("__local_start"), key)).alias("__last_local"))
    earlier = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("__carry", F.max("__bmax").over(earlier))
    real = F.col("__last_local").isNotNull() & (
        F.col("__carry").isNull() | (F.col("__last_local.s") > F.col("__carry")))
    summary = summary.withColumn("__start_carry", F.max(F.when(real, F.col("__last_local"))).over(earlier)) \
        .select(*keys, _B, "__carry", "__start_carry")

    rows = rows.join(summary, on=[*keys, _B], how="inner")
    is_start = F.col("__local_start") & (F.col("__carry").isNull() | (F.col(start) > F.col("__carry")))
    rows = rows.withColumn("is_island_start", is_start) \
        .withColumn("__own", F.max(F.when(F.col("is_island_start"), key)).over(
            w_local.rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("island_key", F.coalesce(F.col("__own"), F.col("__start_carry")))
    return rows.drop("__m", "__local_start", "__carry", "__start_carry", "__own", _B)


def islands(df: DataFrame, keys: Sequence[str], start: str, end: str, id_col: str,
            bucket_rows: int = BUCKET_ROWS, carry: Sequence[str] = ()) -> DataFrame:
    """Merge overlapping/touching intervals per key.

    Returns one row per island: ``keys, island_start, island_end, n_sessions,
    duration_seconds`` plus ``first(carry)`` columns. Rows with a null key or
    bound are not merged; each comes out as its own island.
    """
    keys = list(keys)
    bad = _any_null([*keys, start, end])
    good = df.filter(~bad)
    tagged = scan_islands(good, keys, start, end, id_col, bucket_rows)
    merged = tagged.groupBy(*keys, "island_key").agg(
        F.min(start).alias("island_start"), F.max(end).alias("island_end"),
        F.count(F.lit(1)).alias("n_sessions"),
        *[F.first(c, ignorenulls=True).alias(c) for c in carry])
    single = df.filter(bad).select(
        *keys, F.lit(None).cast(tagged.schema["island_key"].dataType).alias("island_key"),
        F.col(start).alias("island_start"), F.col(end).alias("island_end"),
        F.lit(1).cast("long").alias("n_sessions"), *carry)
    out = merged.unionByName(single)
    return out.withColumn("duration_seconds", seconds_between("island_start", "island_end")) \
        .drop("island_key")


def sessionize(df: DataFrame, keys: Sequence[str], start: str, end: str, id_col: str, gap_seconds: int,
               last: Sequence[str] = (), bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Stitch drops and re-joins: records of a key that are at most ``gap_seconds`` apart are one session.

    Returns per session: ``keys, join_time, leave_time, duration_seconds`` (present,
    without the gaps), ``failover_count`` (gaps stitched over; overlapping or touching
    records are none), ``failover_seconds`` (their length), ``n_records`` and the
    ``last`` columns of its last record (by start, end, id). Two bucketed island scans: records
    to stretches of presence, stretches to sessions. A record with a null key or
    bound is a session of its own, without failovers.
    """
    keys, last = list(keys), list(last)
    bad = _any_null([*keys, start, end])
    latest = F.struct(F.col(start).alias("s"), F.col(end).alias("e"), F.col(id_col).alias("i"), *[F.col(c) for c in last])
    present = scan_islands(df.filter(~bad), keys, start, end, id_col, bucket_rows).groupBy(*keys, "island_key").agg(
        F.min(start).alias("__s"), F.max(end).alias("__e"), F.count(F.lit(1)).alias("__n"), F.max(latest).alias("__last"))
    present = present.withColumn("__until", F.col("__e") + F.make_dt_interval(secs=F.lit(gap_seconds))).drop("island_key")
    whole = scan_islands(present, keys, "__s", "__until", "__s", bucket_rows).groupBy(*keys, "island_key").agg(
        F.min("__s").alias("join_time"), F.max("__e").alias("leave_time"),
        F.sum(seconds_between("__s", "__e")).alias("duration_seconds"), (F.count(F.lit(1)) - 1).alias("failover_count"),
        F.sum("__n").alias("n_records"), F.max("__last").alias("__last"))
    whole = whole.withColumn("failover_seconds", seconds_between("join_time", "leave_time") - F.col("duration_seconds"))
    out = ["join_time", "leave_time", "duration_seconds", "failover_count", "failover_seconds", "n_records"]
    single = df.filter(bad).select(
        *keys, F.col(start).alias("join_time"), F.col(end).alias("leave_time"), seconds_between(start, end).alias("duration_seconds"),
        F.lit(0).cast("bigint").alias("failover_count"), F.lit(0).cast("bigint").alias("failover_seconds"),
        F.lit(1).cast("bigint").alias("n_records"), *last)
    return whole.select(*keys, *out, *[F.col(f"__last.{c}").alias(c) for c in last]).unionByName(single)


_START, _REACH, _LOOSE = 0, 1, 2


def _entries(rows: DataFrame, keys: Sequence[str], labels: Sequence[str], start: str, end: str, id_col: str,
             bucket_rows: int) -> DataFrame:
    """One row per key and bucket with its sorted ``entries``: sessions that start in it, then those of
    earlier buckets that end in it, then sessions without a start (dealt to the key's buckets by hash)."""
    rows = _bordered(rows, keys, start, bucket_rows)
    buckets = F.coalesce(F.size(_BORDERS), F.lit(0)) + 1
    spread = F.pmod(F.xxhash64(*rows.columns[:-1]), buckets).cast("int")
    rows = rows.withColumns({
        "__of": F.when(F.col(start).isNull(), spread).otherwise(_bucket_of(F.col(start))),
        # a session that ends before it starts, or never, reaches nothing
        "__until": F.when(F.col(end) >= F.col(start), _bucket_of(F.col(end))), "__buckets": buckets}).drop(_BORDERS)
    placed = rows.withColumn(_B, F.explode(F.when(
        F.col("__until") > F.col("__of"), F.array("__of", "__until")).otherwise(F.array("__of"))))
    kind = F.when(F.col(start).isNull(), _LOOSE).when(F.col(_B) > F.col("__of"), _REACH).otherwise(_START)
    entry = F.struct(kind.alias("kind"), F.col(start).alias("s"), F.col(end).alias("e"), F.col("__of").alias("of"),
                     F.col("__until").alias("until"), F.col("__buckets").alias("buckets"),
                     *[F.col(c).alias(f"label{k}") for k, c in enumerate(labels)], F.col(id_col).alias("id"))
    return placed.groupBy(*keys, _B).agg(F.sort_array(F.collect_list(entry)).alias("entries"))


def _hulls(entries: DataFrame, keys: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """(keys, labels, hull_start, hull_end, buckets): per label what its reaching sessions span."""
    kept = {f"__l{k}": f"label{k}" for k in range(len(labels))}
    of_kind = lambda kind: F.filter("entries", lambda x: x["kind"] == kind)
    entries = entries.withColumn("buckets", F.col("entries")[0]["buckets"])
    # buckets of a key lie side by side: each but the first starts with a border, which is a session's start
    ends = F.transform(of_kind(_START), lambda x: x["e"])
    over = entries.filter((F.col("buckets") > 1) & (F.col("entries")[0]["kind"] == _START)) \
        .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(_B, F.array_max(ends).alias("e")))).alias("all"))
    over = over.select(*keys, F.col("all")[0][_B].alias("lowest"), max_table(F.transform("all", lambda x: x["e"])).alias("over"),
                       F.explode("all").alias("one")).select(*keys, F.col(f"one.{_B}").alias(_B), "lowest", "over")
    tables = entries.filter((F.size("entries") > 1) | (F.col("buckets") > 1)) \
        .select(*keys, _B, "buckets", of_kind(_START).alias("rows"), of_kind(_REACH).alias("reach"),
                max_table(ends).alias("table")) \
        .withColumn("starts", F.transform("rows", lambda x: x["s"])).join(over, [*keys, _B], "left")
    starts, table, here, lowest = F.col("starts"), F.col("table"), F.col(_B), F.col("lowest")

    def seen(x: Column, partner: Column, reached: Column) -> Column:
        return F.struct(*[x[v].alias(k) for k, v in kept.items()], x["s"].alias("s"), x["e"].alias("e"),
                        partner.alias("partner"), reached.alias("reached"))

    def from_start(x: Column, place: Column) -> Column:
        first = count_before(starts, x["s"], inclusive=False)
        last = F.when(x["until"] > here, F.size(starts)).otherwise(count_before(starts, x["e"], inclusive=True)) - 1
        between = F.when(x["until"] - here > 1, range_max(F.col("over"), here + 1 - lowest, x["until"] - 1 - lowest))
        return seen(x, (last > first) | (x["until"] - here > 1),
                    F.greatest(range_max(table, first, place - 1), range_max(table, place + 1, last), between))

    def from_before(x: Column) -> Column:
        n = count_before(starts, x["e"], inclusive=True)
        return seen(x, n > 0, range_max(table, F.lit(0), n - 1))

    parts = F.concat(F.transform(F.filter(F.transform("rows", lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
                                          lambda r: r["x"]["until"].isNotNull()), lambda r: from_start(r["x"], r["i"])),
                     F.transform("reach", from_before))
    found = tables.select(*keys, "buckets", F.explode(F.filter(parts, lambda p: p["partner"])).alias("p"))
    # GREATEST with a NULL is NULL in the original: no end when none of the reached sessions has one
    return found.groupBy(*keys, *[F.col(f"p.{k}").alias(k) for k in kept]).agg(
        F.min("p.s").alias("hull_start"), F.max("buckets").alias("buckets"),
        F.when(F.count("p.reached") > 0, F.greatest(F.max("p.e"), F.max("p.reached"))).alias("hull_end")) \
        .select(*keys, *[F.col(k).alias(c) for k, c in zip(kept, labels)], "hull_start", "hull_end", "buckets")


def hull_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str, id_col: str,
                   labels: Sequence[str] = (), bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The reference's combined intervals: hull rows plus sessions outside the hull.

    Output columns: ``keys, labels, join_time, leave_time, duration_seconds``.
    ``df`` should already be distinct (the reference dedupes before merging).
    Sessions are compared to every hull row of their key (labels ignored), as
    the reference does, so a key with hulls for two labels can emit a
    session twice. A session without a start has no partner, one without an
    end can still be reached; sessions with a null key come out as they are.
    """
    keys, labels = list(keys), list(labels)
    rows = df.select(*keys, *labels, id_col, start, end)
    entries = _entries(rows.filter(~_any_null(keys)), keys, labels, start, end, id_col, bucket_rows)
    # each hull is brought to the buckets of its key; in the last one, which is never empty, it comes out itself
    beside = _hulls(entries, keys, labels).withColumnsRenamed({c: f"__h{k}" for k, c in enumerate(labels)}) \
        .withColumn(_B, F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)))
    span = lambda label, s, e: F.struct(*[label(k).alias(f"label{k}") for k in range(len(labels))],
                                        s.alias("s"), e.alias("e"))
    outside = F.transform(F.filter("entries", lambda x: (x["kind"] != _REACH) & (
        F.col("hull_start").isNull() | (x["s"] < F.col("hull_start")) | (x["e"] > F.col("hull_end")))),
        lambda x: span(lambda k: x[f"label{k}"], x["s"], x["e"]))
    hull = F.when(F.col(_B) == F.col("buckets") - 1, F.array(
        span(lambda k: F.col(f"__h{k}"), F.col("hull_start"), F.col("hull_end"))))
    out = entries.join(beside, [*keys, _B], "left") \
        .select(*keys, F.explode(F.when(hull.isNotNull(), F.concat(outside, hull)).otherwise(outside)).alias("x")) \
        .select(*keys, *[F.col(f"x.label{k}").alias(c) for k, c in enumerate(labels)],
                F.col("x.s").alias("join_time"), F.col("x.e").alias("leave_time"))
    keyless = rows.filter(_any_null(keys)).select(*keys, *labels, F.col(start).alias("join_time"), F.col(end).alias("leave_time"))
    return out.unionByName(keyless) \
        .withColumn("duration_seconds", seconds_between("join_time", "leave_time"))


def merge_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str, id_col: str,
                    mode: str = "hull", labels: Sequence[str] = (),
                    bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Collapse multi-device sessions. ``mode='hull'`` reproduces the reference;
    ``mode='islands'`` is the true merge (one row per connected cluster)."""
    if mode == "hull":
        return hull_intervals(df, keys, start, end, id_col, labels, bucket_rows)
    if mode == "islands":
        out = islands(df, [*keys, *labels], start, end, id_col, bucket_rows)
        return out.withColumnsRenamed({"island_start": "join_time", "island_end": "leave_time"})
    raise ValueError(f"unknown mode {mode!r}")


def presence_ratio(intervals: DataFrame, meetings: DataFrame, on: Sequence[str],
                   group_cols: Sequence[str], meeting_cols: Sequence[str],
                   duration_col: str = "duration_seconds",
                   meeting_duration_col: str = "meeting_duration_seconds",
                   threshold: float = 0.5) -> DataFrame:
    """Attended seconds, share of the meeting, and the attended flag.

    ``attendance_percentage = sum(duration) / nullif(meeting_duration, 0)``;
    the flag is strictly greater than ``threshold`` of the meeting and false
    (not null) when either side is null. Exactly half is not attended.
    """
    joined = intervals.join(meetings, on=list(on), how="inner")
    cols = [*group_cols, *[c for c in meeting_cols if c not in group_cols]]
    if meeting_duration_col not in cols:
        cols.append(meeting_duration_col)
    agg = joined.groupBy(*cols).agg(F.sum(duration_col).alias("attendance_duration_seconds"))
    total = F.col("attendance_duration_seconds")
    md = F.col(meeting_duration_col)
    return agg.withColumn(
        "attendance_percentage", total.cast("double") / F.nullif(md, F.lit(0)).cast("double")
    ).withColumn(
        "has_participant_attended_flag",
        F.when(total > F.lit(threshold) * md, F.lit(True)).otherwise(F.lit(False)))
