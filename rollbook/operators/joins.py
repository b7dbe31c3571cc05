"""Join patterns of the reference, each kept on an equi-key.

* ``fallback_join``: first non-null value over ordered lookup routes;
* ``any_key_match``: ``day = d AND key IN (k1, k2, k3)`` as one equi-join per key;
* ``substring_join``: equal key plus ``LIKE '%' || t || '%'`` residual;
* ``week_join``: ``date BETWEEN week_start AND week_end`` as an equi-join on
  the Monday of the date (the spine's weeks are Monday-aligned and 7 days), or on
  bins for any other calendar.

None of them uses a nested-loop join; Catalyst and AQE choose broadcast or
sort-merge per side from sizes in bytes, so no side is hinted.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.dates import week_start
from rollbook.operators.ranges import span_join


def _and(conds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def match_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other; the left side's key columns are kept."""
    r = right.withColumnsRenamed({c: f"__k_{c}" for c in on})
    return left.join(r, _and([F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in on]), how) \
        .drop(*[f"__k_{c}" for c in on])


def fallback_join(left: DataFrame, routes: Sequence[tuple[DataFrame, Sequence[tuple[str | Column, str]]]],
                  columns: Sequence[str], matched_col: str | None = None,
                  match_on: str | None = None) -> DataFrame:
    """Left-join ``left`` to each route in turn; ``columns`` take the first non-null.

    A route is ``(right_df, [(left_expr, right_col), ...])``. ``match_on``
    names a right column whose non-null value marks a match (default: the
    first key); ``matched_col`` gets ``TRUE`` when any route matched.
    Right sides should be distinct on their keys when a fan-out is not wanted.
    """
    out = left
    matched = []
    for i, (right, pairs) in enumerate(routes):
        p = f"__r{i}_"
        keep = {rc for _, rc in pairs} | set(columns) | ({match_on} if match_on else set())
        r = right.select(*[F.col(c).alias(p + c) for c in keep if c in right.columns])
        conds = [(F.col(lc) if isinstance(lc, str) else lc) == F.col(p + rc) for lc, rc in pairs]
        out = out.join(r, _and(conds), "left")
        flag_col = p + (match_on or pairs[0][1])
        matched.append(F.col(flag_col).isNotNull())
    coalesced = {c: F.coalesce(*[F.col(f"__r{i}_{c}") for i in range(len(routes))]) for c in columns}
    out = out.withColumns(coalesced)
    if matched_col:
        out = out.withColumn(matched_col, reduce(lambda a, b: a | b, matched))
    return out.drop(*[c for c in out.columns if c.startswith("__r")])


def any_key_match(left: DataFrame, right: DataFrame, eq: Sequence[tuple[str, str]],
                  left_keys: Sequence[str | Column], right_key: str, out: str) -> DataFrame:
    """Flag ``out`` = exists right row with equal ``eq`` columns and
    ``right_key`` equal to any of ``left_keys`` (an OR join).

    The right side is reduced to its distinct ``(eq..., key)`` tuples and
    joined once per left key on an equi-key, instead of one join whose OR
    residual defeats hashing.
    """
    rcols = [rc for _, rc in eq]
    keyset = right.select(*[F.col(c) for c in rcols], F.col(right_key).alias("__k")) \
        .filter(F.col("__k").isNotNull()).distinct()
    cur = left
    flags = []
    for i, lk in enumerate(left_keys):
        lk = F.col(lk) if isinstance(lk, str) else lk
        p = f"__m{i}_"
        r = keyset.select(*[F.col(c).alias(p + c) for c in rcols], F.col("__k").alias(p + "k"),
                          F.lit(True).alias(p + "hit"))
        conds = [F.col(lc) == F.col(p + rc) for lc, rc in eq] + [lk == F.col(p + "k")]
        cur = cur.join(r, _and(conds), "left")
        flags.append(F.coalesce(F.col(p + "hit"), F.lit(False)))
    cur = cur.withColumn(out, reduce(lambda a, b: a | b, flags))
    return cur.drop(*[c for c in cur.columns if c.startswith("__m")])


def substring_join(left: DataFrame, right: DataFrame, eq: Sequence[tuple[str, str]],
                   left_text: str, right_text: str, how: str = "left") -> DataFrame:
    """``l.key = r.key AND l.text LIKE CONCAT('%', r.text, '%')``.

    ``%`` and ``_`` inside the right text stay wildcards, as in the SQL.
    The equi-key keeps this a hash/sort-merge join; only rows of one key
    are tested against each other. A right text without wildcards or escapes
    is searched as it is, only others are compiled to a pattern per pair.
    """
    l, r = left.alias("__l"), right.alias("__r")
    conds = [F.col(f"__l.{a}") == F.col(f"__r.{b}") for a, b in eq]
    text, part = F.col(f"__l.{left_text}"), F.col(f"__r.{right_text}")
    plain = F.translate(part, "%_\\", "") == part
    like = F.expr(f"`__l`.`{left_text}` LIKE concat('%', `__r`.`{right_text}`, '%')")
    return l.join(r, _and(conds) & F.when(plain, text.contains(part)).otherwise(like), how)


def week_join(dates: DataFrame, weeks: DataFrame, eq: Sequence[tuple[str, str]], date_col: str,
              week_start_col: str = "week_start_date", how: str = "left", week_end_col: str = "week_end_date",
              monday_weeks: bool = True) -> DataFrame:
    """``d.key = w.key AND d.date BETWEEN w.week_start AND w.week_end`` as an equi-join.

    With ``monday_weeks`` every spine row must span Monday..Sunday, which
    ``week_spine`` guarantees, and the date's Monday is the key. Any other calendar
    (weeks from Sunday, sprints of ten days, overlapping spans) is joined on the
    bins that its spans cover (``ranges.span_join``).
    """
    if not monday_weeks:
        return span_join(dates, weeks, eq, date_col, week_start_col, week_end_col, how)
    d = dates.withColumn("__wk", week_start(date_col))
    conds = [d[a] == weeks[b] for a, b in eq] + [d["__wk"] == weeks[week_start_col]]
    return d.join(weeks, _and(conds), how).drop("__wk")
