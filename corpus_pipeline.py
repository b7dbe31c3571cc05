"""A training-corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of
``documents``; the last returns per document its id, token count and the
digests of its token ids and of the bytes decoded from them.

Defined results: null, empty and short texts fail the base rules and go; rows
with a null id are judged like others, link with nothing and stay through the
near-duplicate stage; rows that share an id come out of it as one; null
languages and sources are values of their own; further columns of ``documents``,
whatever their names, pass through the first four stages and are left out by
the last; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import byte_bpe, mixing, near_duplicates, quality_classifier, robust_outliers
from rollbook.llm.common import materialise, table
from rollbook.llm.queries import KEEP_SCORE, bpe_files


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (fitted on the labelled ones) does not reject."""
    return quality_classifier.keep_quality(docs, table(spark, sf_dir, "labels"), KEEP_SCORE)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no robust outliers of their language and source."""
    return robust_outliers.keep_inliers(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_duplicates.keep_one_of_each(docs)


def blend(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample by probabilities calibrated to source, language and topic targets."""
    return mixing.sample_mix(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each whole text; their digest and that of the decoded bytes."""
    bpe = docs.select("doc_id", "lang", "source", byte_bpe.round_trip(*bpe_files())("text").alias("bpe"))
    return bpe.select("doc_id", "lang", "source", byte_bpe.n_ids(F.col("bpe.ids")).alias("n_tokens"),
                      F.sha2("bpe.ids", 256).alias("ids_sha256"), F.sha2("bpe.decoded", 256).alias("decoded_sha256"))


STAGES = [("quality classifier", classify), ("quality rules", rules), ("near-duplicates", deduplicate),
          ("mixing", blend), ("byte-level BPE", tokenise)]

#: SQL cannot fit a classifier or concentrate a covariance estimate; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name.split()[0]}")
    return docs
