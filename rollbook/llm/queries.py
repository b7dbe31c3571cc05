"""The ``opN_<name>`` queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import (byte_bpe, exact_topk, html_text, line_dedup, lm_scoring, mixing, near_duplicates, periodic_runs,
                          quality_classifier, robust_outliers, token_alignment, token_files, tool_calls)
from rollbook.llm.common import table

#: The contract's decision threshold of the quality score.
KEEP_SCORE = 0.3


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_files.token_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


#: The tool that user turns call: what its arguments must look like.
REPLY_SCHEMA = {"reply": {"properties": {"prompt": "string", "turn": "integer"}, "required": ["prompt", "turn"]}}


def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn calls the tool ``reply``; the assistant's next turn is its result, and a call depends on the
    calls two and four turns before it. By the text's length modulo 7 the arguments lack the prompt (0), have a
    number in its place (1), have a name too many (2), or are right. The record goes out as its md5."""
    turns = table(spark, sf_dir, "conversations")
    call = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"),
                                 (F.col("turn") + turn).cast("string"))
    rest = F.length("text") % 7
    arguments = (F.when(rest == 0, F.to_json(F.struct("turn")))
                 .when(rest == 1, F.to_json(F.struct("turn", F.length("text").alias("prompt"))))
                 .when(rest == 2, F.to_json(F.struct("turn", F.col("text").alias("prompt"), F.lit(True).alias("note"))))
                 .otherwise(F.to_json(F.struct("turn", F.col("text").alias("prompt")))))
    calls = turns.filter("role = 'user'").select(
        "conv_id", call(0).alias("call_id"), F.lit("reply").alias("name"), arguments.alias("arguments"),
        F.when(F.col("turn") >= 4, F.array(call(-2), call(-4))).when(F.col("turn") >= 2, F.array(call(-2))).alias("depends_on"), "turn")
    results = turns.filter("role = 'assistant'").select(call(-1).alias("call_id"), F.col("text").alias("content"), "turn")
    out = tool_calls.link_calls(calls, results, REPLY_SCHEMA)
    return out.select("conv_id", "call_id", "turn", F.col("level").cast("bigint").alias("level"), "linked", "valid",
                      F.array_join("violations", ",").alias("violations"),
                      "missing_dependencies", F.md5(F.col("record").cast("binary")).alias("record_md5"))


_OP2_SQL = """WITH RECURSIVE u0 AS (SELECT DISTINCT conv_id, turn, text, 'c' || conv_id || '-' || turn AS call_id
  FROM conversations WHERE role = 'user'),
u AS (SELECT *, CASE WHEN text IS NULL THEN 0 WHEN length(text) % 7 < 3 THEN length(text) % 7 ELSE 3 END AS form FROM u0),
a AS (SELECT conv_id, turn - 1 AS turn, min(text) AS content FROM conversations WHERE role = 'assistant' GROUP BY ALL),
near AS (SELECT u.*, CASE WHEN b.turn IS NOT NULL THEN u.turn - 2 WHEN d.turn IS NOT NULL THEN u.turn - 4 END AS below,
                (u.turn >= 2 AND b.turn IS NULL)::BIGINT + (u.turn >= 4 AND d.turn IS NULL)::BIGINT AS missing_dependencies
         FROM u LEFT JOIN u b ON b.conv_id = u.conv_id AND b.turn = u.turn - 2 LEFT JOIN u d ON d.conv_id = u.conv_id AND d.turn = u.turn - 4),
l AS (SELECT conv_id, turn, 0 AS level FROM near WHERE below IS NULL
  UNION ALL SELECT n.conv_id, n.turn, l.level + 1 FROM l JOIN near n ON n.conv_id = l.conv_id AND n.below = l.turn)
SELECT n.conv_id, n.call_id, n.turn, l.level::BIGINT AS level, a.content IS NOT NULL AS linked, form = 3 AS valid,
  ['required:prompt', 'type:prompt', 'additional', ''][form + 1] AS violations, missing_dependencies,
  md5('{"arguments":{' || CASE form WHEN 0 THEN '' WHEN 1 THEN '"prompt":' || length(text) || ',' ELSE
      CASE form WHEN 2 THEN '"note":true,' ELSE '' END || '"prompt":' || to_json(text) || ',' END || '"turn":' || n.turn || '},"call_id":' ||
      to_json(n.call_id) || ',"content":' || coalesce(to_json(a.content)::VARCHAR, 'null') || ',"conv_id":' || n.conv_id ||
      ',"level":' || l.level || ',"name":"reply","valid":' || (form = 3)::VARCHAR || '}') AS record_md5
FROM near n JOIN l USING (conv_id, turn) LEFT JOIN a USING (conv_id, turn)"""


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.withColumn("probability", F.round("probability", 9))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = quality_classifier.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality_classifier.score_quality(docs, model)
    return scored.select("doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"))


def op5_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robust_outliers.robust_outliers(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def bpe_files() -> tuple[str, str]:
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", byte_bpe.round_trip(*bpe_files())("text").alias("bpe"))
    return docs.select("doc_id", byte_bpe.n_ids(F.col("bpe.ids")).alias("n_tokens"),
                       F.sha2("bpe.ids", 256).alias("ids_sha256"), F.sha2("bpe.decoded", 256).alias("decoded_sha256"))


def op9_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents labelled good; background: all documents."""
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return lm_scoring.cross_entropy_difference(table(spark, sf_dir, "documents").select("doc_id", "text"), good)


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    out = pages.select("page_id", "url", html_text.extract_text(F.col("html")).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("bigint"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, by crc32 of the id, are read with a planted periodic tail."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), ["doc_id"],
                                        seed=F.when(crc % 10 == 0, F.floor(crc / 10)), with_text=False)
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))))
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
                        F.sha2(listed, 256).alias("runs_sha256"), "collapsed_sha256")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                        public_tokenizers.path("piece_bpe_32k.model"), ["doc_id"])


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), ["doc_id"], min_chars=20, least=3)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_OP13_SQL = """WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE r.owner <> k.doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE r.owner IS NULL OR r.owner = k.doc_id), '')) AS kept_sha256
FROM k LEFT JOIN r USING (key) GROUP BY k.doc_id"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_token_files, op2_tool_calls, op3_source_mix, op4_quality_classifier, op5_robust_outliers, op6_near_duplicates,
    op7_exact_topk, op8_byte_bpe, op9_cross_entropy, op10_main_text, op11_periodic_runs, op12_token_alignment,
    op13_line_dedup)}

ORACLE_SQL: dict[str, str] = {"op2_tool_calls": _OP2_SQL, "op3_source_mix": mixing.mix_sql(), "op13_line_dedup": _OP13_SQL}
