"""The ten operators against brute-force versions, exact round trips or held-out accuracy, and odd input."""

import base64
import hashlib
import json
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from rollbook.llm import (byte_bpe, components, exact_topk, html_text, lm_scoring, mixing, near_duplicates,
                          quality_classifier, robust_outliers, token_files, tool_calls)
from rollbook.llm.common import scratch

SMALL = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(60_000))
#: doc_id, text, lang, source, and columns whose names clash with the operators' own
ODD = [(None, "no id here", "en", "a", 1, "x"), (1, None, "en", "a", 2, "x"), (2, "", None, "a", 3, "x"),
       (3, " \t\n \r", "en", None, 4, "x"), (4, "one", "en", "a", 5, "x"), (5, "one two", "en", "a", 6, "x"),
       (6, "same line\nsame line\nsame line", "en", "a", 7, "x"), (7, LONG, "en", "a", 8, "x"),
       (7, LONG, "en", "a", 8, "x"), (8, "naïve Café ÀÉ \U0001F600 ½ <|endoftext|> tab\tend", "fr", "b", 9, None)]
ODD_SCHEMA = "doc_id bigint, text string, lang string, source string, score bigint, kept string"
EMPTY_SCHEMA = ODD_SCHEMA


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, ODD_SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], EMPTY_SCHEMA)


# ------------------------------------------------------------------ 1 token files

def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.path("word_bpe_49k.json"))


def test_token_files_match_whole_text_encoding(spark, docs, odd):
    path = P.path("word_bpe_49k.json")
    for frame in (docs, odd.filter("doc_id IS NOT NULL")):
        rows = frame.select("doc_id", "text").collect()
        rows.sort(key=lambda r: r.doc_id)
        encoded = tokenizer().encode_batch([r.text or "" for r in rows], add_special_tokens=False)
        start, want = 0, []
        for r, e in zip(rows, encoded):
            ids = np.array([*e.ids, 2], "<u4")
            want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
        got = [tuple(r) for r in token_files.token_digests(frame, path).collect()]
        assert sorted(got) == sorted(want)


def test_part_encoder_equals_whole_texts_of_odd_characters():
    import random

    rnd, whole, parts = random.Random(3), tokenizer(), token_files.PartEncoder(P.path("word_bpe_49k.json"))
    letters = "aàÀ\u0130ıßẞσςΣǅʰªｆ①e\u0301\u0308ŉ'.,!<|>-_0９ \u00a0\u2003\n한각\u1100\u1161梦\u00ad\u200b\u0345ᲀꙋ"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 40))) for _ in range(4000)]
    for text, got in zip(texts, parts(texts)):
        assert np.frombuffer(got, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_token_files_with_a_third_of_the_rows_on_one_id(spark):
    rows = [(7 if i % 3 == 0 else i, f"text number {i}") for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is small
    path = token_files.write_token_files(frame, scratch(spark, "t"), P.path("word_bpe_49k.json"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert spark.read.parquet(f"{path}/blocks").filter("first_doc <= 7 AND last_doc >= 7").select("shard").distinct().count() > 1
    got = token_files.read_token_files(spark, path).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    ends = sorted((r.start, r.n_tokens, r.doc_id) for r in got)
    assert all(a[0] + a[1] == b[0] and a[2] <= b[2] for a, b in zip(ends, ends[1:]))


def test_token_files_short_document_access_and_empty_table(spark, docs, odd, none):
    path = token_files.write_token_files(docs, scratch(spark, "t"), P.path("word_bpe_49k.json"))
    everything = {r.doc_id: (r.start, r.n_tokens, bytes(r.ids)) for r in token_files.read_token_files(spark, path).collect()}
    some = sorted(everything)[3::40]
    assert {r.doc_id: (r.start, r.n_tokens, bytes(r.ids)) for r in token_files.lookup(spark, path, some).collect()} \
        == {i: everything[i] for i in some}
    first = [r for r in token_files.token_digests(odd, P.path("word_bpe_49k.json")).collect() if r.start == 0]
    assert first[0].doc_id is None  # null ids come first
    assert token_files.token_digests(none, P.path("word_bpe_49k.json")).count() == 0


# ------------------------------------------------------------------ 2 tool calls

def test_tool_calls_order_validate_and_serialise(spark):
    schema = {"add": {"properties": {"a": "integer", "b": "number", "tag": "string"}, "required": ["a", "b"]}}
    calls = spark.createDataFrame([
        ("c", "1", "add", '{"b": 1.5, "a": 1}', None, 0, 9), ("c", "2", "add", '{"a": "x", "b": 2}', ["1"], 1, 9),
        ("c", "3", "add", '{"a": 1, "z": 2}', ["1", "2", None], 2, 9), ("c", "4", "add", "not json", ["gone"], 3, 9),
        ("c", "5", "other", "{}", ["6"], 4, 9), ("c", "6", "add", None, ["5"], 5, 9),
        ("c", "1", "add", '{"b": 7, "a": 7}', None, 8, 9), ("c", None, "add", "{}", None, 6, 9)],
        "conv_id string, call_id string, name string, arguments string, depends_on array<string>, turn bigint, level int")
    results = spark.createDataFrame([("1", "late", 5, 0), ("1", 'said "1"\né', 1, 0), ("9", "nobody asked", 1, 0),
                                     (None, "x", 1, 0)], "call_id string, content string, turn bigint, linked int")
    got = {r.call_id: r for r in tool_calls.link_calls(calls, results, schema).collect()}
    assert set(got) == {"1", "2", "3", "4", "5", "6"}
    assert [got[c].level for c in "123456"] == [0, 1, 2, 0, None, None]
    assert [got[c].valid for c in "123456"] == [True, False, False, False, False, False]
    assert got["2"].violations == ["type:a"] and got["3"].violations == ["additional", "required:b"]
    assert got["4"].violations == ["not an object"] and got["4"].missing_dependencies == 1
    assert got["5"].violations == ["no schema"] and not got["5"].ordered
    assert got["1"].linked and got["1"].n_calls == 2 and got["1"].n_results == 2 and not got["2"].linked
    want = {"arguments": {"a": 1, "b": 1.5}, "call_id": "1", "content": 'said "1"\né', "conv_id": "c", "level": 0,
            "name": "add", "valid": True}
    assert got["1"].record == json.dumps(want, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert tool_calls.link_calls(calls.limit(0), results.limit(0), schema).count() == 0


def test_levels_of_long_chains_layers_and_cycles(spark):
    rows = [(f"c{i}", [f"c{i - 1}"] if i else None) for i in range(300)]
    rows += [("m1", ["c299", "c5"]), ("m2", ["m1", "c0"]), ("m3", ["m2"]), ("m4", ["m3", "m2", "m2"])]
    rows += [("x", ["y"]), ("y", ["z"]), ("z", ["x"]), ("above", ["x", "c1"]), ("top", ["above"]), ("self", ["self"])]
    frame = spark.createDataFrame(rows, "call_id string, depends_on array<string>")
    got = {r.call_id: r.level for r in tool_calls.levels(frame).collect()}
    want = {f"c{i}": i for i in range(300)} | {"m1": 300, "m2": 301, "m3": 302, "m4": 303}
    assert got == want | dict.fromkeys(("x", "y", "z", "above", "top", "self"))


def test_levels_with_turns_equal_levels_without(spark):
    """Calls on several earlier ones, cycles and links to later turns among them."""
    import random

    rnd = random.Random(6)
    rows = [(f"a{i}", [f"a{i - k}" for k in (1, 2, 5) if i >= k] or None, i) for i in range(120)]  # settled without a round a layer
    rows += [(f"r{i}", [f"r{rnd.randrange(40)}" for _ in range(rnd.randrange(3))], rnd.randrange(9)) for i in range(40)]
    rows += [(f"d{i}", [f"d{rnd.randrange(i)}" for _ in range(rnd.randrange(4))] if i else None, i // 2) for i in range(60)]
    rows += [("x", ["y", "z"], 1), ("y", ["z", "x"], 2), ("z", ["x", "y"], 3), ("n", ["a3", "a2"], None)]
    frame = spark.createDataFrame(rows, "call_id string, depends_on array<string>, turn int")
    with_turns = {r.call_id: r.level for r in tool_calls.levels(frame).collect()}
    on = {c: set(d or ()) for c, d, _ in rows}
    want: dict = {}
    while True:  # plain rounds
        new = {c: 1 + max((want[d] for d in ds), default=-1) for c, ds in on.items() if c not in want and all(d in want for d in ds)}
        if not new:
            break
        want |= new
    assert with_turns == {c: want.get(c) for c in on} and with_turns["a119"] == 119


# ------------------------------------------------------------------ 3 mixing

def test_mix_meets_its_marginals(spark, docs):
    cells = docs.select(F.concat(F.lit("="), "source").alias("_source"), F.concat(F.lit("="), "lang").alias("_lang"),
                        (F.col("doc_id") % 3).cast("string").alias("_topic"), F.length("text").alias("tokens"))
    cells = cells.groupBy("_source", "_lang", "_topic").agg(F.sum("tokens").alias("tokens")).filter("tokens > 0")
    tau = {"source": 1.0, "lang": 0.5, "topic": 0.0}
    raked = mixing.rake(cells, tau, 60).toPandas()
    for axis, t in tau.items():
        share = raked.groupby(f"_{axis}")["tokens"].sum() / raked["tokens"].sum()
        want = share ** t / (share ** t).sum()
        assert np.allclose(raked.groupby(f"_{axis}")["weight"].sum(), want, atol=2e-3)


def test_mix_odd_input_and_stage(spark, odd, none):
    got = mixing.mix(odd, keep=["doc_id", "score", "kept"]).collect()
    assert len(got) == len(ODD) and all(0 <= r.probability <= 1 for r in got)
    assert {r.topic for r in got if r.tokens == 0} == {"none"}
    copies = [tuple(r) for r in got if r.doc_id == 7]
    assert len(copies) == 2 and copies[0] == copies[1]
    out = mixing.sample_mix(odd, budget=1.0)
    assert out.columns == odd.columns and out.filter("doc_id = 7").count() == 2
    assert mixing.mix(none).count() == 0 and mixing.sample_mix(none).columns == none.columns


# ------------------------------------------------------------------ 4 quality classifier

def test_factorisation_machine_identity():
    fm = quality_classifier.FactorisationMachine(3)
    rng = np.random.default_rng(1)
    fm.w[:] = rng.normal(size=fm.w.shape)
    ids, x, starts = np.array([5, 9, 700, 5], np.int32), np.array([.5, -1, 2, 3], np.float32), np.array([0, 3, 3, 4])
    stats = rng.normal(size=(3, quality_classifier.STATS)).astype(np.float32)
    got, _ = fm.margin(ids, x, starts, stats)
    for row in range(3):
        feature = list(zip(ids[starts[row]:starts[row + 1]].tolist(), x[starts[row]:starts[row + 1]].tolist()))
        feature += [(quality_classifier.BUCKETS + k, float(v)) for k, v in enumerate(stats[row])]
        want = float(fm.w0) + sum(float(fm.w[i]) * v for i, v in feature)
        want += sum(float(fm.v[i] @ fm.v[j]) * a * b for m, (i, a) in enumerate(feature) for j, b in feature[m + 1:])
        assert math.isclose(got[row], want, rel_tol=1e-4, abs_tol=1e-3)


def test_classifier_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = quality_classifier.fit_quality(docs, labels)
    held = labels.filter(quality_classifier.held_out(F.col("doc_id")))
    got = quality_classifier.score_quality(docs.join(held, "doc_id"), model).select("quality", "score").toPandas()
    bad, good = got[got.quality == 0].score, got[got.quality == 1].score
    assert (good >= 0.3).mean() > 0.99 and (bad < 0.3).mean() > 0.9
    order = np.concatenate([good, bad]).argsort().argsort()
    auc = (order[:len(good)].sum() - len(good) * (len(good) - 1) / 2) / (len(good) * len(bad))
    assert auc > 0.98


def test_classifier_odd_input(spark, odd, none):
    labels = spark.createDataFrame([(4, 1, 0), (5, None, 0), (6, 0, 0), (6, 0, 1), (99, 1, 1), (None, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    model = quality_classifier.fit_quality(odd, labels)
    scored = quality_classifier.score_quality(odd, model, "_s").collect()
    assert len(scored) == len(ODD) and all(0 <= r["_s"] <= 1 for r in scored)
    assert quality_classifier.fit_quality(odd, labels.limit(0)).constant == 0.5
    assert quality_classifier.keep_quality(odd, labels.limit(0)).columns == odd.columns
    assert quality_classifier.keep_quality(none, labels).count() == 0


# ------------------------------------------------------------------ 5 robust outliers

def brute_counts(text):
    text = text or ""
    w = WORDS.findall(text)
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def brute_mcd(x, share=0.75, steps=30):
    """The binned concentration of the operator on one group, in plain loops over numpy arrays."""
    floors = np.diag([(f * robust_outliers.SCALE) ** 2 for f in robust_outliers.FLOORS])
    x = x.astype(float)
    starts = [(x.mean(axis=0), np.cov(x.T, bias=True) + floors)]
    bins = np.floor(x / 8)
    quart = [np.sort(bins, axis=0)[math.ceil(q * len(x)) - 1] * 8 + 4 for q in (.25, .5, .75)]
    starts.append((quart[1], np.diag(((quart[2] - quart[0]) / 1.349) ** 2) + floors))
    found = []
    for mean, cov in starts:
        old = None
        for _ in range(steps):
            d = x - mean
            d2 = np.einsum("ij,ij->i", d @ np.linalg.inv(cov), d)
            b = np.floor(16 * np.log2(1 + 1024 * d2))
            near = x[b <= np.sort(b)[math.ceil(share * len(x)) - 1]]
            mean, cov = near.mean(axis=0), np.cov(near.T, bias=True) + floors
            det = np.linalg.slogdet(cov)[1]
            if old is not None and abs(det - old) < 1e-9:
                break
            old = det
        found.append((det, mean, cov))
    _, mean, cov = min(found, key=lambda f: f[0])
    d = x - mean
    return np.einsum("ij,ij->i", d @ np.linalg.inv(cov), d) / robust_outliers.consistency(share)


def test_counts_match_brute_force(spark, docs, odd):
    for frame in (docs, odd):
        got = robust_outliers.with_counts(frame.select("text")).select("text", *robust_outliers.COUNTS).collect()
        for r in got:
            assert tuple(r)[1:] == brute_counts(r.text)


@pytest.mark.parametrize("table, source", [(SMALL, "source"), ("/root/testdata/sf0.01", "if(doc_id % 7 = 0, 'rare', 'big')"),
                                           ("/root/testdata/sf0.1", "source")])
def test_every_base_passing_document_is_judged(spark, table, source):
    """(language, source) cells by themselves, small ones by their whole language, small languages by all documents."""
    docs = spark.read.parquet(f"{table}/documents.parquet").withColumn("source", F.expr(source))
    got = robust_outliers.robust_outliers(docs, keep=["doc_id", "lang", "source"], tolerance=1e-9).toPandas()
    rows = got[~got.base_failed].reset_index(drop=True)
    n, chars = rows.n_words.to_numpy(), rows.word_chars.to_numpy()
    x = np.round(robust_outliers.SCALE * np.stack([
        np.log(chars / n), np.log1p(100 * rows.n_symbols / chars), np.log1p(rows.n_dup_lines),
        np.arcsin(np.sqrt(rows.n_repeat_words / n))], axis=1))
    cell, whole = (rows.groupby(k).doc_id.transform("size").to_numpy() for k in (["lang", "source"], "lang"))
    want = np.empty(len(rows))
    for of in set(zip(rows.lang, rows.source)):
        here = ((rows.lang == of[0]) & (rows.source == of[1])).to_numpy()
        fit = here if cell[here][0] >= robust_outliers.CELL else (rows.lang == of[0]).to_numpy()
        fit = fit if whole[here][0] >= robust_outliers.LEAST else np.ones(len(rows), bool)
        want[here] = brute_mcd(x[fit])[here[fit]]
    assert np.allclose(rows.distance2, want, rtol=1e-5, atol=1e-6)
    assert (rows.kept == (rows.distance2 <= 45)).all() and not rows.kept.all()
    judged = rows.merge(pd.read_parquet(f"{table}/labels.parquet"), on="doc_id")
    assert judged[judged.quality == 1].kept.all() and not judged[judged.quality == 0].kept.all()


def test_outliers_odd_input(spark, odd, none):
    got = robust_outliers.robust_outliers(odd, keep=["doc_id", "score"]).collect()
    assert len(got) == len(ODD) and all(r.base_failed for r in got if r.n_words < 50)
    assert robust_outliers.keep_inliers(odd).columns == odd.columns
    assert robust_outliers.keep_inliers(odd).count() <= 2
    assert robust_outliers.robust_outliers(none).count() == 0


# ------------------------------------------------------------------ 6 near-duplicates

def brute_components(rows):
    sets = {}
    for i, text in rows:
        w = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets[i] = {tuple(w[k:k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    seen = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in seen[s])
        for s in sets[i]:
            seen[s].append(i)
        for j, n in shared.items():
            if 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def near(frame):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates.near_duplicates(frame).collect()}


def test_near_duplicates_match_brute_force(spark, docs):
    assert near(docs) == brute_components([tuple(r) for r in docs.select("doc_id", "text").collect()])


def variants(seed=0):
    """A base text in growing distortions, truncations and exact copies, short texts and unrelated ones."""
    rng = np.random.default_rng(seed)
    base = [f"w{rng.integers(400)}" for _ in range(160)]
    out = []
    for k in range(60):
        w = list(base)
        for _ in range(k // 6):
            w[rng.integers(len(w))] = f"n{rng.integers(10**6)}"
        out.append(" ".join(w[: len(w) - int(rng.integers(0, 30))]))
    out += out[:5] + ["A b", "a B", "a b c", "A b c d", "", "  "]
    out += [" ".join([*base[:20], *(f"u{k}-{i}" for i in range(60))]) for k in range(20)]
    return [(int(i) * 3, t) for i, t in enumerate(out)]


def test_hot_lists_and_clusters_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK_ROWS", 8)
    rows = variants()
    assert near(spark.createDataFrame(rows, "doc_id bigint, text string")) == brute_components(rows)


def test_union_sketch_filter_and_forests():
    rows = variants(1)
    sets = near_duplicates.ShingleSets()
    got = [sets(t) for _, t in rows[:60]]
    forest = near_duplicates.exact_forest(np.arange(60), got, 85)
    assert len(forest) < 60
    sketches = np.full((60, near_duplicates.K), 0xFFFFFFFF, np.uint32)
    for k, s in enumerate(got):
        s = (s[:near_duplicates.K] >> np.uint64(32)).astype(np.uint32)
        sketches[k, :len(s)] = s
    for a in range(0, 60, 7):
        for b in range(60):
            inter = len(np.intersect1d(got[a], got[b]))
            if 100 * inter >= 85 * (len(got[a]) + len(got[b]) - inter):
                assert near_duplicates._passes(sketches[a:a + 1], sketches[b:b + 1])[0]


def test_near_duplicates_odd_input(spark, odd, none):
    got = near_duplicates.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: r for r in got}
    assert by[None].component_id is None and by[None].kept
    assert [by[i].n_shingles for i in (1, 2, 3, 4, 5)] == [0, 0, 0, 1, 1]
    assert all(by[i].component_id == i for i in range(1, 9))
    kept = near_duplicates.keep_one_of_each(odd)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 1  # the repeated row goes
    assert near_duplicates.near_duplicates(none).count() == 0
    two = spark.createDataFrame([(1, "a b c d"), (1, "x y z w"), (2, "x y z w"), (3, "a b c d")], "doc_id bigint, text string")
    assert {r.component_id for r in near_duplicates.near_duplicates(two).collect()} == {1}


def test_components_on_random_graphs(spark):
    rng = np.random.default_rng(5)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(40)]
    root = {}

    def find(a):
        while root.setdefault(a, a) != a:
            a = root[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {n: find(n) for a, b in links for n in (a, b) if a != b}


# ------------------------------------------------------------------ 7 exact top-k

def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(0, .3, (6, 16))
    vectors = [(int(i), (centres[i % 6] + rng.normal(0, .05, 16)).tolist(), "x") for i in range(500)]
    vectors += [(1000 + i, vectors[3][1], "x") for i in range(40)]  # ties
    vectors += [vectors[0], (2000, None, "x"), (2001, [None] * 16, "x"), (2002, [float("nan")] * 16, "x"),
                (2003, [float("inf")] * 16, "x"), (None, [0.0] * 16, "x"), (2100, [0.5, 0.5], "x"), (2101, [0.1, 0.2], "x")]
    frame = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>, rank string")
    got = exact_topk.top_k(frame, F.col("vec_id") % 100 == 0, query_block=4, candidate_block=64).toPandas()
    live = {i: np.floor(1024 * np.array(v)).astype(int) for i, v, _ in vectors
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in (i for i in live if i % 100 == 0):
        scored = sorted((-int(live[q] @ v), i) for i, v in live.items() if i != q and len(v) == len(live[q]))[:10]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored)]
    assert sorted(map(tuple, got.itertuples(index=False))) == sorted(want)
    assert exact_topk.top_k(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0


# ------------------------------------------------------------------ 8 byte-level BPE

def reference_bpe():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_matches_tiktoken_and_decodes(spark, docs, odd, none):
    files, encoding = (P.path("byte_bpe_50k.tiktoken"), P.PATTERN), reference_bpe()
    for frame in (docs, odd):
        ids = frame.select("text", byte_bpe.encoder(*files)("text").alias("ids"))
        got = ids.select("text", "ids", byte_bpe.n_ids(F.col("ids")).alias("n"), byte_bpe.decoder(*files)("ids").alias("back"))
        for r in got.collect():
            text = r.text or ""
            want = encoding.encode_ordinary(text)
            assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n == len(want) and bytes(r.back) == text.encode()
    assert none.select(byte_bpe.encoder(*files)("text")).count() == 0


def test_replay_equals_one_merge_at_a_time():
    vocabulary, encoding = byte_bpe.Vocabulary(P.path("byte_bpe_50k.tiktoken"), P.PATTERN), reference_bpe()
    rng = np.random.default_rng(0)
    corpus = [bytes(rng.choice(list(b"aabtheing  n"), size=int(rng.integers(1, 60))).tolist()) for _ in range(400)]
    corpus += [b"a" * 5000, b"the" * 700, bytes(range(256)), b"=" * 333]
    for piece, ids in zip(corpus, vocabulary.replay(corpus)):
        want = vocabulary.one_by_one(piece)
        assert np.frombuffer(ids, "<u4").tolist() == want
        if piece not in vocabulary.tokens:
            assert want == encoding._encode_single_piece(piece)


def test_replay_repairs_pieces_whose_merges_run_backwards(tmp_path):
    # "bc" ranks after "abc": merging b+c makes a pair (a, bc) of a lower rank
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"bc", b"cd", b"bcd"]
    path = tmp_path / "odd.tiktoken"
    path.write_text("".join(f"{base64.b64encode(t).decode()} {k}\n" for k, t in enumerate(tokens)))
    vocabulary = byte_bpe.Vocabulary(str(path), r".+")
    corpus = [b"abcabcd", b"bcdabc", b"aabcbcd"]
    assert [np.frombuffer(x, "<u4").tolist() for x in vocabulary.replay(corpus)] == [vocabulary.one_by_one(p) for p in corpus]


# ------------------------------------------------------------------ 9 LM scoring

def brute_scores(rows, targets, mu=50.0):
    known = lm_scoring._WordClass()
    seqs = [lm_scoring.word_classes(t, known).tolist() for _, t in rows]
    models = []
    for keep in (lambda i: True, lambda i: i in targets):
        pair, context, word = Counter(), Counter(), Counter()
        for (i, _), s in zip(rows, seqs):
            if keep(i):
                for a, b in zip([0, *s], s):
                    pair[a, b] += 1
                    context[a] += 1
                    word[b] += 1
        total = sum(word.values())
        models.append(lambda a, b, p=pair, c=context, w=word, n=total: -math.log(
            (p[a, b] + mu * (w[b] + 1) / (n + lm_scoring.CLASSES)) / (c[a] + mu)))
    return [(i, len(s), sum(models[1](a, b) - models[0](a, b) for a, b in zip([0, *s], s)) / len(s) if s else None)
            for (i, _), s in zip(rows, seqs)]


def test_cross_entropy_difference_matches_brute_force(spark, docs, odd, none):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").filter("quality = 1").select("doc_id")
    targets = {r.doc_id for r in labels.collect()}
    for frame, ids, aim in ((docs, labels, targets), (odd, odd.limit(0).select("doc_id"), set())):
        rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
        key = lambda r: (r[0] is None, r[0] or 0, r[1])
        got = sorted(map(tuple, lm_scoring.cross_entropy_difference(frame, ids, chunk_docs=64).collect()), key=key)
        want = sorted(brute_scores(rows, aim), key=key)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        for g, w in zip(got, want):
            assert (g[2] is None) == (w[2] is None) and (w[2] is None or math.isclose(g[2], w[2], rel_tol=1e-4, abs_tol=1e-5))
    assert lm_scoring.cross_entropy_difference(none, none.select("doc_id")).count() == 0


def test_cross_entropy_keeps_every_word_apart(spark):
    """More distinct words than 2 ** 16: a rare word never gets the counts of another one."""
    rare = [" ".join(f"r{d}w{k}" for k in range(1000)) for d in range(80)]
    rows = [(d, t) for d, t in enumerate(rare)] + [(None, "seen often " * 300), (2 ** 53 + 1, "seen often unseen")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    aim = spark.createDataFrame([(3,), (2 ** 53 + 1,)], "doc_id bigint")
    got = {r.doc_id: (r.n_tokens, r.ce_difference) for r in lm_scoring.cross_entropy_difference(frame, aim, chunk_docs=7).collect()}
    mu, models = 50.0, []
    vocabulary = len({w for _, t in rows for w in t.split()})
    assert vocabulary > 1 << 16
    for keep in (lambda d: True, lambda d: d in (3, 2 ** 53 + 1)):
        pair, context, word = Counter(), Counter(), Counter()
        for d, t in rows:
            if keep(d):
                s = t.split()
                pair.update(zip(["", *s], s))
                context.update(["", *s[:-1]])
                word.update(s)
        models.append((pair, context, word, sum(word.values())))
    for d, t in rows:
        s, loss = t.split(), []
        for pair, context, word, n in models:
            loss.append(sum(-math.log((pair[a, b] + mu * (word[b] + 1) / (n + vocabulary)) / (context[a] + mu))
                            for a, b in zip(["", *s], s)) / len(s))
        assert got[d][0] == len(s) and math.isclose(got[d][1], loss[1] - loss[0], rel_tol=1e-9, abs_tol=1e-9)


def test_chunks_do_not_depend_on_ids(spark):
    for doc_id in ("NULL", "7"):
        frame = spark.range(95).selectExpr(f"CAST({doc_id} AS BIGINT) AS doc_id", "'a b' AS text").coalesce(1)
        rows = frame.mapInArrow(lm_scoring._chunks(10), lm_scoring._CHUNKS).collect()
        assert len({r.chunk for r in rows}) == 10 and max(len(r.nulls) for r in rows) == 10


# ------------------------------------------------------------------ 10 HTML

def test_main_text_of_given_pages(spark):
    for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        inner = r.html[r.html.index("<article>") + 9:r.html.index("</article>")]
        blocks = (html_text._BLANK.sub(" ", html_text.html.unescape(re.sub(r"<[^>]*>", "", b))).strip()
                  for b in re.split(r"</?(?:p|h1)>", inner))
        assert html_text.main_text(r.html) == "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p>a", "a"), ("<nav><p>menu<article><p>text of the page</p></article>", "text of the page"),
    ("<article><p>A &amp; B &lt; C&nbsp;&eacute;</p>x &am</article>", "A & B < C é\nx &am"),
    ("<body><header><h1>Site</h1></header><aside>side</aside><article><h1>T</h1><p>One\n\n two<br>three</p>"
     "<div class='ad'>Buy now</div><p>4.</p><section class='comments'><article><p>nice</p></article></section></article>"
     "<div class='cookie-notice'>We use cookies</div><form>Name</form><footer>f</footer></body>", "T\nOne two three\n4."),
    ("<body><ul><li><a href=x>Home</a></li><li><a href=y>News and views of the day in a long link text</a></li></ul>"
     "<div><p>" + "real text " * 20 + "</p><p>short</p></div><ul><li><a href=z>About</a></li></ul></body>",
     ("real text " * 20).strip() + "\nshort"),
    ("<script>if (a < b) document.write('</p><article>')</script><style>p{}</style><article>kept</article>", "kept"),
    ("<article><p>cut in the mid", "cut in the mid"), ("<article><p>cut <a href='x", "cut"),
    ("<article><p hidden>no</p><p>yes</p><!-- no --><p style='display: none'>no</p></article>", "yes")])
def test_main_text_cases(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("page, text", [
    # a small closing paragraph after boilerplate, a short block, a paragraph that is mostly a link
    ("<body><div><p>" + "body " * 400 + "</p></div><form>f</form><ul><li><a href=a>A</a> | <a href=b>B</a></li>"
     "<li><a href=c>C</a></li></ul><form>g</form><div><p>" + "close " * 50 + "</p></div><form>h</form><form>i</form>"
     "<form>j</form><p>The end</p><p><a href=d>See the whole of the long story</a> here</p></body>",
     ("body " * 400).strip() + "\n" + ("close " * 50).strip() + "\nThe end\nSee the whole of the long story here"),
    # one teaser card beside a body without an article element
    ("<div><p>" + "body " * 100 + "</p></div><article><p>Teaser</p></article><p>last</p>",
     ("body " * 100).strip() + "\nTeaser\nlast"),
    # no end of head; letters that grow in lower case before a script's end tag
    ("<html><head><title>T</title><body><p>first</p><header>site</header><p>second</p></body></html>", "first\nsecond"),
    ("<p>" + "\u0130" * 9 + "</p><script>x</SCRIPT><p>after</p>", "\u0130" * 9 + "\nafter"),
    ("<script>'</scripts>'</script><p>after</p>", "after"), ("<a name=top><div>one</div><div>two</div>", "one\ntwo")])
def test_main_text_drops_boilerplate_only(page, text):
    assert html_text.main_text(page) == text


def test_main_text_column(spark):
    frame = spark.createDataFrame([(1, None), (2, "<p>x</p>" * 30_000), (2, "<article>y</article>")], "page_id int, html string")
    got = [tuple(r) for r in frame.select("page_id", html_text.extract_text(F.col("html"))).collect()]
    assert got[0] == (1, "") and got[1][1].count("x") == 30_000 and got[2] == (2, "y")
    assert frame.limit(0).select(html_text.extract_text(F.col("html"))).count() == 0


def test_draw_is_fixed():
    assert hashlib.md5(b"12#7").hexdigest()[:8]  # the draw is this number over 2 ** 32


def test_near_duplicates_refuse_a_similarity_that_they_cannot_find(docs):
    with pytest.raises(ValueError, match="85"):
        near_duplicates.near_duplicates(docs, percent=80)
