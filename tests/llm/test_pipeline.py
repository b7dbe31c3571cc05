"""The pipeline stage by stage against brute-force versions, its queries' SQL, and its registration."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from rollbook.llm import mixing, queries, quality_classifier, robust_outliers
from rollbook.llm.common import materialise, table
from tests.llm.test_operators import brute_components, brute_counts, reference_bpe

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SF, "documents")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF), "stage-test")
        out.append(docs)
    return out


def test_stages_pass_documents_on(stages):
    for frame in stages[1:-1]:
        assert frame.columns == stages[0].columns
    counts = [frame.count() for frame in stages]
    assert counts == sorted(counts, reverse=True) and counts[-1] == counts[-2] > 0


def test_classifier_stage(spark, stages):
    model = quality_classifier.fit_quality(stages[0], table(spark, SF, "labels"))
    rows = stages[0].select("doc_id", "text", "n_chars").toPandas()
    ids, x, starts, stats = quality_classifier.Features()(rows["text"], rows["n_chars"])
    want = set(rows.doc_id[model.score(ids, x, starts, stats) >= 0.3])
    assert {r.doc_id for r in stages[1].select("doc_id").collect()} == want


def test_rules_stage_keeps_clean_documents(spark, stages):
    before = {r.doc_id: r.text for r in stages[1].select("doc_id", "text").collect()}
    kept = {r.doc_id for r in stages[2].select("doc_id").collect()}
    verdict = robust_outliers.robust_outliers(stages[1], keep=["doc_id"]).toPandas().set_index("doc_id").kept
    assert kept == set(verdict.index[verdict])
    labels = pd.read_parquet(f"{SF}/labels.parquet").set_index("doc_id").quality
    for i, text in before.items():
        n, _, _, _, repeated = brute_counts(text)
        if n < 50 or 100 * repeated > 50 * n:
            assert i not in kept
        elif labels.get(i) == 1:
            assert i in kept


def test_near_duplicate_stage(stages):
    groups = brute_components([tuple(r) for r in stages[2].select("doc_id", "text").collect()])
    assert {r.doc_id for r in stages[3].select("doc_id").collect()} == {i for i, g in groups.items() if g[2]}


def test_mixing_stage(stages):
    con = duckdb.connect()
    con.register("documents", stages[3].toPandas())
    want = {r[0] for r in con.sql(mixing.mix_sql()).fetchall() if r[4]}
    assert {r.doc_id for r in stages[4].select("doc_id").collect()} == want


def test_tokenising_stage(stages):
    import hashlib

    encoding = reference_bpe()
    texts = {r.doc_id: r.text for r in stages[4].select("doc_id", "text").collect()}
    for r in stages[5].collect():
        ids = np.array(encoding.encode_ordinary(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_pipeline_on_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels"):
        table(spark, SF, name).limit(0).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Null texts and ids, repeated rows, null language and source, and columns with the stages' own names."""
    docs = table(spark, SF, "documents").filter("doc_id < 400").withColumns(
        {"score": F.lit("mine"), "kept": F.col("doc_id"), "_g": F.lit(1), "rest": F.lit(None).cast("string"), "probability": F.lit("p")})
    good = table(spark, SF, "labels").filter("quality = 1 AND doc_id < 400").limit(3).select("doc_id")
    some = docs.join(good, "doc_id", "left_semi")
    odd = docs.limit(4).withColumn("doc_id", F.col("doc_id") + 10_000)
    every = docs.unionByName(some).unionByName(  # repeated rows; rows without an id; odd texts
        some.withColumn("doc_id", F.lit(None).cast("bigint"))).unionByName(
        odd.withColumns({"text": F.lit(None).cast("string"), "lang": F.lit(None).cast("string")})).unionByName(
        odd.withColumns({"doc_id": F.col("doc_id") + 10, "text": F.lit(" \t\n"), "source": F.lit(None).cast("string")}))
    every.write.parquet(str(tmp_path / "documents.parquet"))
    table(spark, SF, "labels").write.parquet(str(tmp_path / "labels.parquet"))
    now = table(spark, str(tmp_path), "documents")
    for name, stage in corpus_pipeline.STAGES:
        before, now = now, materialise(stage(spark, now, str(tmp_path)), "odd")
        if name != "byte-level BPE":
            assert now.columns == every.columns, name
            assert now.filter("score <> 'mine' OR probability <> 'p' OR rest IS NOT NULL").count() == 0
        if name == "quality rules":
            assert now.filter("text IS NULL OR doc_id >= 10000").count() == 0  # no words: the base rules fail
            assert now.filter("doc_id IS NULL").count() == before.filter("doc_id IS NULL").count() == 3
        if name == "near-duplicates":
            assert now.filter("doc_id IS NULL").count() == 3
            assert now.filter("doc_id IS NOT NULL").count() == now.filter("doc_id IS NOT NULL").select("doc_id").distinct().count()
    assert now.columns == ["doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256"] and now.count() > 0


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and {f"op{n}_" for n in range(1, 14)} <= {k.split("_")[0] + "_" for k in names if k.startswith("op")}
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES) and len(queries.QUERIES) == 13
    assert set(__spark_entry__.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(SF, t)}.parquet'")
    want = con.sql(queries.ORACLE_SQL[name]).df()
    got = queries.QUERIES[name](spark, SF).toPandas()
    key = sorted(want.columns)
    assert sorted(got.columns) == key and len(got) > 0
    order = [c for c in ("doc_id", "call_id") if c in key]
    pd.testing.assert_frame_equal(got[key].sort_values(order).reset_index(drop=True),
                                  want[key].sort_values(order).reset_index(drop=True), check_dtype=False)
