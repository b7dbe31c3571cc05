"""Roll-ups: regional aggregate rows, weighted averages, form pivots, zero-filled attach."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions.safe import safe_divide


def weighted_avg_or_avg(value: str, weight: str) -> Column:
    """sum(value x weight) / sum(weight) when the weights sum above 0, else avg(value).

    Missing values and weights count as 0 in the weighted branch; the
    fallback is the plain ``avg`` over non-null values (``avg(coalesce(x, null))``).
    """
    w = F.coalesce(F.col(weight), F.lit(0))
    v = F.coalesce(F.col(value), F.lit(0))
    return F.when(F.sum(w) > 0, safe_divide(F.sum(v * w), F.sum(w))).otherwise(F.avg(F.col(value)))


def _numbered(base: DataFrame, member_col: str, members) -> tuple[DataFrame, Column, bool]:
    """``base``, whether a row's member is in the set, and whether the set is a short list that fits 63 bits."""
    if isinstance(members, DataFrame):
        codes = members.select(F.col(members.columns[0]).alias("__code")).distinct()
        return base.join(codes, F.col(member_col) == F.col("__code"), "left"), F.col("__code").isNotNull(), False
    members = list(dict.fromkeys(members))
    return base, F.coalesce(F.col(member_col).isin(members), F.lit(False)), len(members) <= 63


def regional_rollup(base: DataFrame, key: str, group_cols: Sequence[str], member_col: str,
                    members, region_code: str, aggs: Mapping[str, Column],
                    min_members: int = 2) -> DataFrame:
    """Append one region row per group whose key spans at least ``min_members`` members.

    ``base`` rows pass through unchanged; region rows group the member rows
    by ``group_cols`` (which include ``key``) and set ``member_col`` to
    ``region_code``. ``members`` is a literal list (the reference's five
    country codes) or a DataFrame of codes.

    ``base`` is read once: every member row is expanded to itself and a copy
    for its region group, one aggregate makes the region rows (equal base rows
    are counted and come out as often as they went in), and the members of a
    key are bits that are joined by OR, per group and then over the key's
    groups, and counted (sets of codes beyond 63 listed ones).
    """
    rows, is_member, short = _numbered(base, member_col, members)
    copies = rows.withColumn("__region", F.explode(F.when(is_member, F.array(F.lit(False), F.lit(True))).otherwise(
        F.array(F.lit(False)))))
    region = F.col("__region")
    own = F.when(~region, F.struct(*[F.col(c) for c in base.columns]))
    if short:
        place = F.array_position(F.array(*[F.lit(m) for m in dict.fromkeys(members)]), F.col(member_col)).cast("int") - 1
        seen = F.bit_or(F.when(region, F.call_function("shiftleft", F.lit(1).cast("bigint"), place)))
        count = lambda w: F.bit_count(F.bit_or("__seen").over(w))
    else:
        seen = F.collect_set(F.when(region, F.col(member_col)))
        count = lambda w: F.size(F.array_distinct(F.flatten(F.collect_set("__seen").over(w))))
    grouped = copies.groupBy(own.alias("__own"), *[F.when(region, F.col(c)).alias(f"__g_{c}") for c in group_cols]).agg(
        F.count(F.lit(1)).alias("__n"), seen.alias("__seen"), *[expr.alias(f"__a_{name}") for name, expr in aggs.items()])
    # base rows stand alone in the window of the keys: their partition is the row itself
    spanned = grouped.withColumn("__members", count(Window.partitionBy("__own", f"__g_{key}")))
    made = {**{c: F.col(f"__g_{c}") for c in group_cols}, **{c: F.col(f"__a_{c}") for c in aggs}, member_col: F.lit(region_code)}
    # columns take the wider of the two types, as a union does
    empty = lambda df: base.sparkSession.createDataFrame([], df.schema)
    wide = empty(base).unionByName(empty(spanned.select(*[made[c].alias(c) for c in base.columns]))).schema
    own_row, region_row = (F.struct(*[source[c].cast(wide[c].dataType).alias(c) for c in base.columns])
                           for source in ({c: F.col("__own")[c] for c in base.columns}, made))
    out = F.when(F.col("__own").isNotNull(), F.array_repeat(own_row, F.col("__n").cast("int"))).when(
        F.col(f"__g_{key}").isNotNull() & (F.col("__members") >= min_members), F.array(region_row))
    return spanned.select(F.explode(out).alias("r")).select("r.*")


def pivot_form(responses: DataFrame, questions: DataFrame, mapping: Mapping[str, str],
               group_cols: Sequence[str], form_ids: Sequence[str] | None = None,
               question_col: str = "question_id", form_col: str = "form_id",
               response_col: str = "response", rest: str | None = None) -> DataFrame:
    """Long form answers -> one column per question (``MAX(CASE WHEN q = id THEN r END)``).

    Questions and responses are joined case-insensitively on (question, form);
    ``form_ids`` keeps forms whose upper-cased id is listed. ``rest`` names a column
    for the answers to questions that ``mapping`` does not name: a sorted array
    of ``question=answer``; without it they are left out, as in the original.
    """
    q = questions.select(F.col(question_col).alias("__qid"), F.col(form_col).alias("__qform"))
    r = responses
    if form_ids is not None:
        r = r.filter(F.upper(F.col(form_col)).isin([f.upper() for f in form_ids]))
    j = r.join(q, (F.lower(r[question_col]) == F.lower(q["__qid"]))
               & (F.lower(r[form_col]) == F.lower(q["__qform"])), "inner")
    cols = [F.max(F.when(F.col("__qid") == qid, F.col(response_col))).alias(out)
            for qid, out in mapping.items()]
    if rest:
        other = F.concat(F.col("__qid"), F.lit("="), F.col(response_col))
        cols.append(F.array_sort(F.collect_set(F.when(~F.col("__qid").isin(list(mapping)), other))).alias(rest))
    return j.groupBy(*group_cols).agg(*cols)


def attach_zero(left: DataFrame, right: DataFrame, on: Sequence[str], cols: Sequence[str],
                zero=0) -> DataFrame:
    """Left-join per-key aggregates and show ``zero`` where the key had none."""
    j = left.join(right.select(*on, *cols), on=list(on), how="left")
    return j.withColumns({c: F.coalesce(F.col(c), F.lit(zero)) for c in cols})
