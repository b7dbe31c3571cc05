"""Quality rules by robust multivariate outliers (native, DataFrame functions only).

Every document gets five counts (words, characters in words, symbols, duplicate
lines, words in repeated 3-word windows). Their transformed rates form a vector
of four statistics. Per language and source a minimum covariance determinant
(MCD) estimate of centre and scatter is fitted to the vectors of the documents
that pass the base rules, and a document whose squared Mahalanobis distance
exceeds ``cutoff`` is rejected.

MCD on Spark
    A concentration step needs the ``h`` documents nearest to the present
    centre. Distances are put in logarithmic bins, one partial aggregate per
    (group, bin) keeps count, sums and cross products of the statistics, and a
    running count over the bins (some hundreds per group, whatever the group's
    size) tells which bins make up the nearest ``h``. Their moments are added
    up, which is the next estimate. A group holding a third of all rows is thus
    never sorted, never collected and never in one task. The statistics are
    fixed-point integers, so the sums are exact and the result depends on
    neither partitioning nor task order.
    Two deterministic starts are concentrated side by side (the classical
    moments, and medians with interquartile scales); the smaller determinant
    wins, as in deterministic MCD.

Defined results for odd input
    * null or empty text: no words, all counts 0, base rule fails, not kept;
    * null language or source: a value of its own (null-safe group key);
    * fewer than ``CELL`` base-passing documents in a (language, source): they
      are judged by the estimate of their whole language (large cells included),
      and those of a language with fewer than ``LEAST`` by that of all documents;
      only a table with fewer than ``LEAST`` in all has no estimate;
    * repeated rows count as often as they occur; ties at the ``h``-th distance
      are all taken in (whole bins);
    * extra columns pass through untouched.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollbook.llm.common import materialise, words

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Fixed-point steps per unit of a transformed statistic.
SCALE = 1024
#: Least standard deviation of (log word length, log symbol rate, log duplicate
#: lines, arcsine repeat share): most statistics are zero for most documents,
#: and a scatter of exactly zero would reject every document that differs.
FLOORS = (0.03, 0.2, 0.35, 0.25)
P = len(FLOORS)
#: Documents from which a (language, source) has an estimate of its own, and which any estimate needs.
CELL, LEAST = 10 * P, 10 * P
_SYMBOLS = r"[#*$%&|<>]"
_X = [f"_x{i}" for i in range(P)]


# ------------------------------------------------------------------ the counts

def _repeat_words(w: Column, hashes: Column, bits: Column, room: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    Equal windows have equal hashes, so a text whose window hashes are all
    different needs no more work. Otherwise each hash gives its low bits to the
    window's place, the numbers are sorted, and places whose remaining hash
    bits equal a neighbour's become candidates. Only the candidates' windows
    (three words joined by a space, which no word contains) are then sorted
    with their places, equal neighbours are marked, and the union of the marked
    windows is measured from the distances between successive places. ``bits``, ``room``:
    the bits a place needs, and two to that power.
    """
    def candidates(packed: Column) -> Column:
        part = lambda x: F.call_function("shiftright", x, bits)
        near = F.filter(packed, lambda x, j: (part(F.get(packed, j + 1)) == part(x))
                        | F.coalesce(part(F.get(packed, j - 1)) == part(x), F.lit(False)))
        return F.transform(near, lambda x: F.pmod(x, room).cast("int"))

    def windows(places: Column) -> Column:
        return F.sort_array(F.transform(places, lambda i: F.struct(
            F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("t"), i.alias("i"))))

    def marked(s: Column) -> Column:
        same = F.filter(s, lambda x, j: (F.get(s, j + 1)["t"] == x["t"])
                        | F.coalesce(F.get(s, j - 1)["t"] == x["t"], F.lit(False)))
        return F.sort_array(F.transform(same, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    # each transform over a one-element array binds an intermediate array once per row
    bound = F.array(F.sort_array(F.transform(hashes, lambda x, i: x - F.pmod(x, room) + i)))
    for step in (candidates, windows, marked, covered):
        bound = F.transform(bound, step)
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(F.get(bound, F.lit(0)))


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the five counts (bigint) over the whole ``text`` of each row."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = docs.withColumns({"_w": words(F.col(text)), "_lines": lines})
    step = step.withColumns({"_h": F.when(F.size("_w") >= 3, F.transform(
        F.slice("_w", 1, F.size("_w") - 2),
        lambda x, i: F.xxhash64(x, F.get(F.col("_w"), i + 1), F.get(F.col("_w"), i + 2))))
        .otherwise(F.array().cast("array<bigint>"))})
    bits = F.ceil(F.log2(F.size("_h") + F.lit(1))).cast("int")
    step = step.withColumn("_bits", bits)
    step = step.withColumn("_room", F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_bits")))
    repeats = _repeat_words(F.col("_w"), F.col("_h"), F.col("_bits"), F.col("_room"))
    counts = {
        "n_words": F.size("_w"),
        "word_chars": F.length(F.array_join("_w", "")),
        "n_symbols": F.regexp_count(t, F.lit(_SYMBOLS)),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.when(F.size("_w") >= 4, repeats).otherwise(F.lit(0)),
    }
    step = step.withColumns({k: v.cast("bigint") for k, v in counts.items()}).drop("_w", "_lines", "_h", "_bits", "_room")
    return step.withColumn("base_failed", (F.col("n_words") < 50)
                           | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _vector() -> list[Column]:
    """The transformed statistics as fixed-point integers."""
    n, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    stats = [F.log(chars / n),
             F.log1p(100.0 * F.col("n_symbols") / chars),
             F.log1p(F.col("n_dup_lines").cast("double")),
             F.asin(F.sqrt(F.least(F.lit(1.0), F.col("n_repeat_words") / n)))]
    return [F.round(SCALE * s).cast("bigint").alias(x) for s, x in zip(stats, _X)]


# ------------------------------------------------------------------ the estimates

def _sum(columns) -> Column:
    return reduce(lambda a, b: a + b, columns)


def _moment_aggs() -> list[Column]:
    pairs = [(i, j) for i in range(P) for j in range(i + 1)]
    return [F.sum("_n").alias("_n"), *(F.sum(f"_s{i}").alias(f"_s{i}") for i in range(P)),
            *(F.sum(f"_q{i}{j}").alias(f"_q{i}{j}") for i, j in pairs)]


def _row_moments(df: DataFrame) -> DataFrame:
    pairs = [(i, j) for i in range(P) for j in range(i + 1)]
    return df.withColumns({"_n": F.lit(1).cast("bigint"), **{f"_s{i}": F.col(_X[i]) for i in range(P)},
                           **{f"_q{i}{j}": F.col(_X[i]) * F.col(_X[j]) for i, j in pairs}})


def _estimate(df: DataFrame, keys: list[str]) -> DataFrame:
    """Centre ``_m*``, Cholesky factor ``_l*`` of the scatter and its log determinant, from moments.

    The squared floors are added to the diagonal, so the factor always exists.
    """
    mean = {f"_m{i}": F.col(f"_s{i}") / F.col("_n") for i in range(P)}
    df = df.withColumns(mean)
    df = df.withColumns({f"_c{i}{j}": F.col(f"_q{i}{j}") / F.col("_n") - F.col(f"_m{i}") * F.col(f"_m{j}")
                         + (F.lit((FLOORS[i] * SCALE) ** 2) if i == j else F.lit(0.0))
                         for i in range(P) for j in range(i + 1)})
    return _cholesky(df).select(*keys, *(f"_m{i}" for i in range(P)),
                                *(f"_l{i}{j}" for i in range(P) for j in range(i + 1)), "_logdet")


def _cholesky(df: DataFrame) -> DataFrame:
    for j in range(P):
        cols = {}
        diag = F.col(f"_c{j}{j}") - _sum([F.lit(0.0)] + [F.col(f"_l{j}{k}") ** 2 for k in range(j)])
        df = df.withColumn(f"_l{j}{j}", F.sqrt(F.greatest(diag, F.lit((FLOORS[j] * SCALE) ** 2 * 1e-3))))
        for i in range(j + 1, P):
            rest = F.col(f"_c{i}{j}") - _sum([F.lit(0.0)] + [F.col(f"_l{i}{k}") * F.col(f"_l{j}{k}") for k in range(j)])
            cols[f"_l{i}{j}"] = rest / F.col(f"_l{j}{j}")
        if cols:
            df = df.withColumns(cols)
    return df.withColumn("_logdet", 2 * _sum([F.log(F.col(f"_l{i}{i}")) for i in range(P)]))


def _distance(df: DataFrame) -> DataFrame:
    """Adds ``_d2``, the squared Mahalanobis distance, by forward substitution."""
    for i in range(P):
        rest = F.col(_X[i]) - F.col(f"_m{i}") - _sum([F.lit(0.0)] + [F.col(f"_l{i}{k}") * F.col(f"_y{k}")
                                                                   for k in range(i)])
        df = df.withColumn(f"_y{i}", rest / F.col(f"_l{i}{i}"))
    return df.withColumn("_d2", _sum([F.col(f"_y{i}") ** 2 for i in range(P)]))


def _starts(rows: DataFrame) -> DataFrame:
    """Start 0: classical moments. Start 1: medians and interquartile scales from per-statistic histograms."""
    classical = _estimate(_row_moments(rows).groupBy("_g").agg(*_moment_aggs()), ["_g"]).withColumn("_start", F.lit(0))
    bins = (rows.select("_g", F.posexplode(F.array(*(F.shiftright(F.col(x), 3) for x in _X))).alias("_k", "_b"))
            .groupBy("_g", "_k", "_b").agg(F.count(F.lit(1)).alias("_n")))
    run = Window.partitionBy("_g", "_k").orderBy("_b")
    whole = Window.partitionBy("_g", "_k")
    bins = bins.withColumns({"_cum": F.sum("_n").over(run), "_all": F.sum("_n").over(whole)})
    quart = [F.min(F.when(F.col("_cum") >= q * F.col("_all"), F.col("_b") * 8 + 4)).alias(f"_p{i}")
             for i, q in enumerate((0.25, 0.5, 0.75))]
    coords = bins.groupBy("_g", "_k").agg(*quart)
    at = lambda i, c: F.max(F.when(F.col("_k") == i, c))
    robust = coords.groupBy("_g").agg(
        *(at(i, F.col("_p1").cast("double")).alias(f"_m{i}") for i in range(P)),
        *(at(i, ((F.col("_p2") - F.col("_p0")) / 1.349) ** 2 + (FLOORS[i] * SCALE) ** 2).alias(f"_c{i}{i}")
          for i in range(P)))
    robust = robust.withColumns({f"_c{i}{j}": F.lit(0.0) for i in range(P) for j in range(i)})
    robust = _cholesky(robust).withColumn("_start", F.lit(1)).select(*classical.columns)
    return classical.unionByName(robust)


def _chi2_cdf(x: float, dof: int) -> float:
    """Chi-squared distribution function for an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dof // 2))


def consistency(share: float) -> float:
    """Factor that makes the scatter of the nearest ``share`` consistent at the normal distribution."""
    low, high = 0.0, 200.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_cdf(mid, P) < share else (low, mid)
    return share / _chi2_cdf(low, P + 2)


def fit_mcd(rows: DataFrame, share: float = 0.75, max_steps: int = 30, tolerance: float = 1e-3) -> DataFrame:
    """One MCD estimate per group ``_g`` of ``rows`` (statistics in ``_x*``).

    ``share``: part of the documents in the nearest subset. Concentration goes
    on until no group's log determinant changes by ``tolerance`` any more
    (``max_steps`` at most); one number a step reaches the driver.
    """
    sizes = rows.groupBy("_g").agg(F.count(F.lit(1)).alias("_all"))
    params = materialise(_starts(rows).join(sizes, "_g"), "mcd-start")
    for _ in range(max_steps):
        near = _row_moments(_distance(rows.join(params, "_g")))
        near = near.withColumn("_bin", F.floor(16 * F.log2(1 + 1024 * F.col("_d2"))).cast("int"))
        near = near.groupBy("_g", "_start", "_bin").agg(
            *_moment_aggs(), F.max("_all").alias("_all"), F.max("_logdet").alias("_old"))
        run = Window.partitionBy("_g", "_start").orderBy("_bin")
        near = near.withColumn("_before", F.sum("_n").over(run) - F.col("_n"))
        near = near.filter(F.col("_before") < F.ceil(share * F.col("_all"))).groupBy("_g", "_start").agg(
            *_moment_aggs(), F.max("_all").alias("_all"), F.max("_old").alias("_old"))
        new = materialise(_estimate(near, ["_g", "_start", "_all", "_old"]), "mcd-step")
        params = new.drop("_old")
        moved = new.agg(F.max(F.abs(F.col("_logdet") - F.col("_old")))).first()[0]
        if moved is None or moved < tolerance:
            break
    best = Window.partitionBy("_g").orderBy("_logdet", "_start")
    return (params.withColumn("_rank", F.row_number().over(best)).filter("_rank = 1")
            .drop("_rank", "_start", "_all"))


def _nested(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells, whole languages and all documents: who is fitted in which, who is judged by which."""
    cells = materialise(cells.withColumn("_pool", F.sum("_n").over(Window.partitionBy("_lang"))), "quality-cells")
    total = cells.agg(F.sum("_n")).first()[0] or 0
    own, whole = F.concat_ws(" ", F.lit("own"), "_lang", "_source"), F.concat_ws(" ", F.lit("lang"), "_lang")
    group = F.when(F.col("_n") >= CELL, own).when(F.col("_pool") >= LEAST, whole)
    group = group.when(F.lit(total >= LEAST), F.lit("all"))
    judges = materialise(cells.select("_lang", "_source", group.alias("_g")).filter("_g IS NOT NULL"), "quality-groups")
    within = cells.select("_lang", "_source", F.explode(F.array(own, whole, F.lit("all"))).alias("_g"))
    return within.join(judges.select("_g").distinct(), "_g", "left_semi"), judges


def robust_outliers(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
                    keep: list[str] | None = None, share: float = 0.75,
                    cutoff: float = 45.0, max_steps: int = 30, tolerance: float = 1e-3) -> DataFrame:
    """Counts, base rule, squared distance and verdict for every row of ``docs``.

    ``keep``: columns passed through (default: all). Every document that passes the
    base rules is judged. ``cutoff`` is compared with
    the squared Mahalanobis distance over four statistics; 45 leaves a tail
    of 4e-9 at the normal distribution, so only gross departures go.
    Returns ``keep`` + counts + ``base_failed``, ``distance2`` (null without an
    estimate), ``kept``.
    """
    keep = list(docs.columns) if keep is None else keep
    src = docs.select(*(F.col(c).alias(f"_in{i}") for i, c in enumerate(keep)), F.col(text).alias("_text"),
                      F.to_json(F.struct(F.col(lang).alias("l")), {"ignoreNullFields": "false"}).alias("_lang"),
                      F.to_json(F.struct(F.col(source).alias("s")), {"ignoreNullFields": "false"}).alias("_source"))
    stats = with_counts(src, "_text").drop("_text")
    stats = materialise(stats.select("*", *_vector()), "quality-stats")

    good = stats.filter(~F.col("base_failed"))
    cells = good.groupBy("_lang", "_source").agg(F.count(F.lit(1)).alias("_n"))
    fitted, judges = _nested(cells)

    rows = good.select("_lang", "_source", *_X).join(fitted, ["_lang", "_source"]).select("_g", *_X)
    rows = materialise(rows, "mcd-rows")
    params = materialise(fit_mcd(rows, share, max_steps, tolerance), "mcd")
    judged = _distance(stats.join(judges, ["_lang", "_source"], "left").join(params, "_g", "left"))
    d2 = F.when(~F.col("base_failed"), F.col("_d2") / consistency(share))
    judged = judged.withColumn("distance2", d2)
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance2") <= cutoff, F.lit(True))
    clash = {*COUNTS, "base_failed", "distance2", "kept"}
    return judged.select(*(F.col(f"_in{i}").alias(c) for i, c in enumerate(keep) if c not in clash),
                         *COUNTS, "base_failed", "distance2", kept.alias("kept"))


def keep_inliers(docs: DataFrame, **options) -> DataFrame:
    """The documents that pass, with exactly the columns of ``docs`` (pipeline stage)."""
    names = {c: f"_doc{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*(F.col(c).alias(n) for c, n in names.items()))
    judged = robust_outliers(renamed, names["text"], names["lang"], names["source"], **options)
    return judged.filter("kept").select(*(F.col(n).alias(c) for c, n in names.items()))
