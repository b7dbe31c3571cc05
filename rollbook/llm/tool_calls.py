"""Tool-call linking and canonical chat records (native, DataFrame functions only).

Calls (conv_id, call_id, name, arguments, depends_on, turn) and results
(call_id, content, turn) are linked by a hash join on the identifier. Calls are
ordered topologically: level 0 depends on nothing, any other call stands one
level above its highest dependency. A dependency that a later dependency of the same
call depends on itself cannot be the highest and is left out (only among
dependencies on earlier turns, which form no cycle). Runs of single dependencies are contracted by
pointer doubling, then each round settles the calls whose dependencies are
settled (keyed joins on call_id, never a group per conversation). Arguments are parsed and checked against the tool's schema
(required names, types, no unknown names unless the schema allows them). Each
call becomes one canonical JSON record: keys sorted, no blanks, arguments with
sorted keys; (conv_id, level, turn, call_id) is the order of a chat's records.

Defined results
    * repeated calls of an id: the first by (turn, name, arguments) stands,
      the number of repeats is kept; results likewise;
    * a call without a result has ``linked`` false and a null result; a result
      without a call is not a record;
    * dependencies on unknown ids count as settled (level 0) and are reported
      in ``missing_dependencies``; calls on a cycle, or above one, have a null
      level and ``ordered`` false;
    * null or unparsable arguments, and tools without a schema, are invalid;
    * null call ids are no calls; extra columns are ignored; no rows give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import materialise


def _firsts(rows: DataFrame, key: str, order: list[str], count: str) -> DataFrame:
    """One row per key, the smallest by ``order``: a partial aggregate, so a hot key costs one row a task."""
    rest = [c for c in rows.columns if c != key]
    packed = F.struct(*(F.col(c) for c in order), *(F.col(c) for c in rest if c not in order))
    got = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(packed).alias("_r"), F.count(F.lit(1)).alias(count))
    return got.select(key, *(F.col(f"_r.{c}").alias(c) for c in rest), count)


def _chains(single: DataFrame) -> DataFrame:
    """(call_id, head, dist): the first call above a run of single dependencies, by pointer doubling.

    ``single``: (call_id, on), one dependency a call. The rounds grow with the
    logarithm of the longest run; heads of cycles are calls of the run itself.
    """
    cur = materialise(single.select("call_id", F.col("on").alias("head"), F.lit(1).cast("bigint").alias("dist")), "chains")
    rounds = cur.count().bit_length() + 1
    for _ in range(rounds):
        above = cur.select(F.col("call_id").alias("head"), F.col("head").alias("_up"), F.col("dist").alias("_more"))
        step = cur.join(above, "head", "left")
        cur = materialise(step.select("call_id", F.coalesce("_up", "head").alias("head"),
                                      (F.col("dist") + F.coalesce("_more", F.lit(0))).alias("dist"),
                                      F.col("_up").isNotNull().alias("_moved")), "chains")
        moved, cur = cur.filter("_moved"), cur.drop("_moved")
        if moved.isEmpty():
            break
    return cur


def _without_shortcuts(links: DataFrame, turns: DataFrame) -> DataFrame:
    """``links`` (call_id, on) without those that lead where another link leads in two steps, turn by turn downwards.

    Such a link is never the highest dependency's: what is two steps down lies a level lower.
    """
    placed = materialise(links.join(turns, "call_id").join(turns.select(F.col("call_id").alias("on"), F.col("turn").alias("on_turn")), "on")
                         .select("call_id", "turn", "on", "on_turn"), "call-turns")
    down = placed.filter("on_turn < turn")
    two = down.select("call_id", F.col("on").alias("mid")).join(
        down.select(F.col("call_id").alias("mid"), "on"), "mid").select("call_id", "on").distinct()
    return placed.join(two.join(down.select("call_id", "on"), ["call_id", "on"], "left_semi"), ["call_id", "on"], "left_anti") \
        .select("call_id", "on")


def levels(calls: DataFrame) -> DataFrame:
    """(call_id, level, missing_dependencies) for calls with ``depends_on`` (array of call ids or null).

    Runs of calls with a single dependency are contracted to their heads first,
    so a conversation of thousands of turns takes a few rounds; the remaining
    rounds are as many as there are layers of calls with several dependencies.
    With a ``turn`` column, dependencies that others imply are left out before.
    """
    ids = calls.select("call_id")
    wanted = calls.select("call_id", F.explode(F.array_distinct(
        F.filter(F.coalesce("depends_on", F.array().cast("array<string>")), lambda d: d.isNotNull()))).alias("on"))
    known = wanted.join(ids.select(F.col("call_id").alias("on"), F.lit(True).alias("_known")), "on", "left")
    links = materialise(known, "call-links")
    missing = links.filter("_known IS NULL").groupBy("call_id").agg(F.count(F.lit(1)).alias("missing_dependencies"))
    links = links.filter("_known").select("call_id", "on")
    if "turn" in calls.columns:
        links = materialise(_without_shortcuts(links, calls.select("call_id", "turn")), "call-links")
    degree = links.groupBy("call_id").agg(F.count(F.lit(1)).alias("n"), F.min("on").alias("on"))
    degree = materialise(degree, "call-degree")
    chains = _chains(degree.filter("n = 1"))
    several = links.join(degree.filter("n > 1").select("call_id"), "call_id", "left_semi")
    several = several.join(chains.select(F.col("call_id").alias("on"), "head", "dist"), "on", "left")
    several = materialise(several.select("call_id", F.coalesce("head", "on").alias("on"),
                                         F.coalesce("dist", F.lit(0)).alias("dist")), "call-several")
    settled = ids.join(degree.select("call_id"), "call_id", "left_anti").withColumn("level", F.lit(0).cast("bigint"))
    settled = materialise(settled, "call-level")
    while not several.isEmpty():
        ready = (several.join(settled.select(F.col("call_id").alias("on"), "level"), "on", "left")
                 .groupBy("call_id").agg(F.max(F.col("level") + F.col("dist")).alias("_top"),
                                         F.count_if(F.col("level").isNull()).alias("_open"))
                 .filter("_open = 0").select("call_id", (F.col("_top") + 1).alias("level")))
        ready = materialise(ready, "call-ready")
        if ready.isEmpty():
            break  # what is left stands on a cycle
        settled = materialise(settled.unionByName(ready), "call-level")
        several = materialise(several.join(ready.select("call_id"), "call_id", "left_anti"), "call-several")
    run = chains.join(settled.select(F.col("call_id").alias("head"), "level"), "head")
    every = settled.unionByName(run.select("call_id", (F.col("level") + F.col("dist")).alias("level")))
    return (ids.join(every, "call_id", "left").join(missing, "call_id", "left")
            .withColumn("missing_dependencies", F.coalesce("missing_dependencies", F.lit(0).cast("bigint"))))


def schema_violations(arguments: Column, schema: dict) -> Column:
    """Names of the schema rules that a JSON object text breaks (array of strings, sorted).

    ``schema``: {"properties": {name: type}, "required": [names], "additional":
    bool}; types: string, integer, number, boolean, object, array.
    """
    parsed = F.try_parse_json(arguments)
    names = F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>"))
    fits = {"string": ["STRING"], "integer": ["BIGINT"], "boolean": ["BOOLEAN"], "object": ["OBJECT"], "array": ["ARRAY"],
            "number": ["BIGINT", "DOUBLE", "DECIMAL"]}
    rules = []
    for name in sorted(schema.get("required", [])):
        rules.append(F.when(~F.array_contains(names, name), F.lit(f"required:{name}")))
    for name, kind in sorted(schema.get("properties", {}).items()):
        found = F.schema_of_variant(F.try_variant_get(parsed, f'$["{name}"]', "variant"))
        ok = F.lit(False)
        for want in fits[kind]:
            ok = ok | found.startswith(want)
        rules.append(F.when(F.array_contains(names, name) & ~F.coalesce(ok, F.lit(False)), F.lit(f"type:{name}")))
    if not schema.get("additional", False):
        extra = F.array_except(names, F.array(*(F.lit(n) for n in schema.get("properties", {}))).cast("array<string>"))
        rules.append(F.when(F.size(extra) > 0, F.lit("additional")))
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    broken = F.array_sort(F.array_compact(F.array(*rules))) if rules else F.array().cast("array<string>")
    return F.when(~is_object, F.array(F.lit("not an object"))).otherwise(broken)


def canonical(value: Column) -> Column:
    """A JSON text with sorted keys and without blanks (null: unparsable)."""
    return F.to_json(F.try_parse_json(value))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One canonical record per call."""
    calls = materialise(_firsts(calls.select("conv_id", "call_id", "name", "arguments", "depends_on", "turn"), "call_id",
                                ["turn", "name", "arguments"], "n_calls"), "calls")
    results = _firsts(results.select("call_id", "content", F.col("turn").alias("result_turn")), "call_id",
                      ["result_turn", "content"], "n_results")
    violations = F.array(F.lit("no schema"))
    for name, schema in sorted(schemas.items()):
        violations = F.when(F.col("name") == name, schema_violations(F.col("arguments"), schema)).otherwise(violations)
    out = calls.join(levels(calls), "call_id", "left").join(results, "call_id", "left")
    out = out.withColumns({"linked": F.col("n_results").isNotNull(), "ordered": F.col("level").isNotNull(),
                           "violations": violations, "n_results": F.coalesce("n_results", F.lit(0).cast("bigint"))})
    out = out.withColumn("valid", F.size("violations") == 0)
    record = F.to_json(F.struct(
        F.try_parse_json(F.col("arguments")).alias("arguments"), F.col("call_id").alias("call_id"),
        F.col("content").alias("content"), F.col("conv_id").alias("conv_id"), F.col("level").alias("level"),
        F.col("name").alias("name"), F.col("valid").alias("valid")), {"ignoreNullFields": "false"})
    return out.select("conv_id", "call_id", "name", "turn", "level", "ordered", "linked", "valid", "violations",
                      "missing_dependencies", "n_calls", "n_results", record.alias("record"))
