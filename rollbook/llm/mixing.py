"""Mixing sources to target weights by iterative proportional fitting (native).

Documents fall into cells (source, language, topic). The cells' token weights
are raked: in turn each of the three marginals is scaled to its targets, for
``iterations`` rounds. Only the small cell table is iterated on (one keyed
aggregate over all documents makes it); documents are joined to their cell once
at the end and drawn independently with the calibrated probability of the cell,
by a hash of the document id, so a rerun or a lost executor draws the same.

Targets: a marginal's target share is its token share to the power ``tau``,
normalised (1 keeps the natural mix, 0 makes all values equal); a caller may
give explicit shares instead. ``budget`` is the share of all tokens wanted.
The probability of a cell is ``min(1, lambda * weight / tokens)``; ``lambda``
is raised until the expected tokens meet the budget although some cells are
taken whole.

Defined results: null source or language is a value of its own; a text without
words has topic ``none`` and no tokens; a cell without tokens has probability
0; null document ids all draw the same number; no rows give no rows; repeated
rows count and draw like the first; extra columns pass through. Targets that
no weights can meet (empty cells) give the last round's weights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollbook.llm.common import materialise, words

AXES = ("source", "lang", "topic")
#: Cell tables of at most so many rows are raked in one task instead of many shuffles (same result).
ONE_TASK_CELLS = 20_000


def topic_of(w: Column, topics: int) -> Column:
    """Topic class of a text: its longest word (ties: greatest) hashed to ``topics`` classes."""
    longest = F.array_max(F.transform(w, lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))
    digit = F.conv(F.substring(F.md5(longest["x"].cast("binary")), 1, 4), 16, 10).cast("int")
    return F.when(F.size(w) == 0, "none").otherwise(F.concat(F.lit("t"), (digit % topics).cast("string")))


def draw(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the document id alone."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f"#{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 4294967296.0


def rake(cells: DataFrame, tau: dict[str, float], iterations: int,
         targets: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """Adds ``weight`` (sums to 1 over cells with tokens) to cells (_source, _lang, _topic, tokens)."""
    cells = materialise(cells, "cells")
    total, n = cells.agg(F.sum("tokens").cast("double"), F.count(F.lit(1))).first()
    if not total:
        return cells.withColumn("weight", F.lit(0.0))
    few = n <= ONE_TASK_CELLS
    cells = cells.coalesce(1) if few else cells
    for axis in AXES:
        by = Window.partitionBy(f"_{axis}")
        share = F.sum("tokens").over(by) / F.lit(total)
        given = (targets or {}).get(axis)
        if given:
            pairs = F.create_map(*(F.lit(x) for kv in given.items() for x in (str(kv[0]), float(kv[1]))))
            cells = cells.withColumn(f"_t_{axis}", F.coalesce(pairs[F.col(f"_{axis}")], F.lit(0.0)))
        else:
            norm = (cells.groupBy(f"_{axis}").agg((F.sum("tokens") / F.lit(total)).alias("s"))
                    .agg(F.sum(F.when(F.col("s") > 0, F.pow("s", F.lit(tau[axis]))))).first()[0])
            cells = cells.withColumn(f"_t_{axis}", F.when(share > 0, F.pow(share, F.lit(tau[axis])) / F.lit(norm))
                                     .otherwise(F.lit(0.0)))
    cells = cells.withColumn("weight", F.col("tokens") / F.lit(total))
    for k in range(iterations):
        for axis in AXES:
            now = F.sum("weight").over(Window.partitionBy(f"_{axis}"))
            cells = cells.withColumn("weight", F.when(now > 0, F.col("weight") * F.col(f"_t_{axis}") / now)
                                     .otherwise(F.lit(0.0)))
        if k % 4 == 3:  # keeps the plan short
            cells = materialise(cells, "cells")
            cells = cells.coalesce(1) if few else cells
    return cells


def probabilities(cells: DataFrame, budget: float) -> DataFrame:
    """Adds ``probability`` to raked cells; ends when no further cell is taken whole, after as many rounds as cells at most."""
    cells = materialise(cells, "raked")
    ratio = F.col("weight") / F.col("tokens")
    total, weight = cells.agg(F.sum("tokens").cast("double"), F.sum("weight")).first()
    wanted = budget * (total or 0.0)
    scale = wanted / weight if weight else 0.0
    while True:  # cells taken whole leave their share of the budget to the others
        full = F.lit(scale) * ratio >= 1
        whole, rest = cells.filter("tokens > 0").agg(
            F.sum(F.when(full, F.col("tokens"))).cast("double"), F.sum(F.when(~full, F.col("weight")))).first()
        new = (wanted - (whole or 0.0)) / rest if rest else scale
        if new <= scale * (1 + 1e-12):
            break
        scale = new
    return cells.withColumn("probability", F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.lit(scale) * ratio))
                            .otherwise(F.lit(0.0)))


def mix(docs: DataFrame, budget: float = 0.5, tau: dict[str, float] | None = None, iterations: int = 12,
        topics: int = 8, seed: int = 7, targets: dict[str, dict[str, float]] | None = None,
        keep: list[str] | None = None) -> DataFrame:
    """Every row with ``topic``, ``tokens`` (words), ``probability`` of its cell and ``sampled``.

    ``keep``: columns of ``docs`` passed through (default: all but text).
    """
    tau = {"source": 0.5, "lang": 0.7, "topic": 0.0} | (tau or {})
    keep = [c for c in docs.columns if c != "text"] if keep is None else keep
    kept = [F.col(c).alias(f"_in{i}") for i, c in enumerate(keep)]
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null"))
    rows = docs.select(*kept, F.col("doc_id").alias("_id"), key("source").alias("_source"),
                       key("lang").alias("_lang"), words(F.col("text")).alias("_w"))
    rows = rows.select(*(c for c in rows.columns if c != "_w"), F.size("_w").cast("bigint").alias("_tokens"),
                       topic_of(F.col("_w"), topics).alias("_topic"))
    rows = materialise(rows, "mix-rows")
    cells = rows.groupBy(*(f"_{a}" for a in AXES)).agg(F.sum("_tokens").alias("tokens"))
    given = targets and {a: {(v if a == "topic" else f"={v}"): s for v, s in t.items()} for a, t in targets.items()}
    raked = probabilities(rake(cells, tau, iterations, given), budget)
    raked = materialise(raked.select(*(f"_{a}" for a in AXES), "probability"), "mix-cells")
    out = rows.join(raked, [f"_{a}" for a in AXES])
    clash = {"topic", "tokens", "probability", "sampled"}
    return out.select(*(F.col(f"_in{i}").alias(c) for i, c in enumerate(keep) if c not in clash),
                      F.col("_topic").alias("topic"), F.col("_tokens").alias("tokens"), "probability",
                      (draw(F.col("_id"), seed) < F.col("probability")).alias("sampled"))


def sample_mix(docs: DataFrame, **options) -> DataFrame:
    """The sampled documents, with exactly the columns of ``docs`` (pipeline stage)."""
    names = {c: f"_doc{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select("doc_id", "source", "lang", "text", *(F.col(c).alias(n) for c, n in names.items()))
    out = mix(inner, keep=list(names.values()), **options)
    return out.filter("sampled").select(*(F.col(n).alias(c) for c, n in names.items()))


def mix_sql(table: str = "documents", budget: float = 0.5, iterations: int = 12, topics: int = 8, seed: int = 7,
            tau: dict[str, float] | None = None, rounds: int = 8) -> str:
    """DuckDB SQL of :func:`mix` with derived targets (doc_id, topic, tokens, probability, sampled)."""
    tau = {"source": 0.5, "lang": 0.7, "topic": 0.0} | (tau or {})
    ctes = [f"""rows_ AS MATERIALIZED (SELECT doc_id, coalesce('=' || source, 'null') AS source, coalesce('=' || lang, 'null') AS lang,
 len(w) AS tokens, CASE WHEN len(w) = 0 THEN 'none' ELSE
 't' || (('0x' || substr(md5(list_max(list_transform(w, lambda x: {{'n': length(x), 'x': x}})).x), 1, 4))::INT % {topics}) END AS topic
 FROM (SELECT *, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM {table}))""",
            "c0 AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM rows_ GROUP BY ALL)",
            "tot AS MATERIALIZED (SELECT sum(tokens) AS total FROM c0)"]
    for axis in AXES:
        ctes.append(f"m_{axis} AS MATERIALIZED (SELECT {axis}, CASE WHEN s > 0 THEN pow(s, {tau[axis]}) / "
                    f"sum(CASE WHEN s > 0 THEN pow(s, {tau[axis]}) END) OVER () ELSE 0 END AS t FROM "
                    f"(SELECT {axis}, sum(tokens) / (SELECT total FROM tot) AS s FROM c0 GROUP BY {axis}))")
    ctes.append("w0 AS MATERIALIZED (SELECT c0.*, tokens / (SELECT total FROM tot) AS weight FROM c0)")
    n = 0
    for _ in range(iterations):
        for axis in AXES:
            ctes.append(f"w{n + 1} AS MATERIALIZED (SELECT w.source, w.lang, w.topic, w.tokens, "
                        f"CASE WHEN now > 0 THEN weight * t / now ELSE 0 END AS weight FROM "
                        f"(SELECT *, sum(weight) OVER (PARTITION BY {axis}) AS now FROM w{n}) w JOIN m_{axis} USING ({axis}))")
            n += 1
    ctes.append(f"l0 AS MATERIALIZED (SELECT {budget} * sum(tokens) / sum(weight) AS v FROM w{n})")
    for k in range(rounds):
        ctes.append(f"l{k + 1} AS MATERIALIZED (SELECT greatest((SELECT v FROM l{k}), coalesce(({budget} * (SELECT total FROM tot) - "
                    f"coalesce(sum(CASE WHEN f THEN tokens END), 0)) / sum(CASE WHEN NOT f THEN weight END), 0)) AS v FROM "
                    f"(SELECT *, (SELECT v FROM l{k}) * weight / tokens >= 1 AS f FROM w{n} WHERE tokens > 0))")
    return ("WITH " + ",\n".join(ctes) + f"""
SELECT r.doc_id, r.topic, r.tokens, round(p, 9) AS probability,
 (('0x' || substr(md5(coalesce(r.doc_id::VARCHAR, '') || '#{seed}'), 1, 8))::BIGINT / 4294967296.0) < p AS sampled
FROM rows_ r JOIN (SELECT source, lang, topic, CASE WHEN tokens > 0 THEN
 least(1.0, (SELECT v FROM l{rounds}) * weight / tokens) ELSE 0.0 END AS p FROM w{n}) USING (source, lang, topic)""")
