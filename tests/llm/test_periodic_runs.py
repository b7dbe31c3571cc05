"""Periodic runs against a brute-force version: random texts over few words, planted tails, odd input."""

import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from rollbook.llm import periodic_runs
from rollbook.llm.queries import QUERIES
from tests.llm.test_operators import ODD, ODD_SCHEMA, SMALL

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def planted(doc, words):
    n = len(words)
    if doc is None or not n:
        return words
    h = zlib.crc32(str(doc).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def runs_of(words):
    """(start, length, period) of every run, each period by itself."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)  # a longer period of the same stretch is a multiple
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def brute(doc, text, plant=True):
    words = WORDS.findall(text or "")
    words = planted(doc, words) if plant else words
    runs = sorted(runs_of(words), key=lambda r: (r[0], r[2]))
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = (None, None, None, None)
    for s, length, q in runs:
        if best[0] is None or length * best[2] > best[1] * q:
            best = (s, length, q, 1000 * length // q)
    collapsed = " ".join(w for i, w in enumerate(words) if i not in drop)
    return runs, (doc, len(runs), *best, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
                  hashlib.sha256(collapsed.encode()).hexdigest())


def found(df):
    out = periodic_runs.periodic_runs(df, ["doc_id"]).collect()
    return sorted(((r.doc_id, r.n_words, [(x.start, x.length, x.period) for x in r.runs], r.collapsed) for r in out), key=str)


def texts(seed, many):
    """Random texts with nested, touching and overlapping repetition."""
    rng = random.Random(seed)
    for k in range(many):
        words = []
        while len(words) < rng.choice((3, 30, 300, 1500)):
            block = [rng.choice("ab" if rng.random() < 0.5 else "abcdefgh") for _ in range(rng.choice((1, 2, 3, 5, 8, 21, 64, 100)))]
            if rng.random() < 0.5 and len(block) < 30:  # repetition inside repetition
                block = (block * rng.randint(2, 9))[:rng.randint(len(block), 9 * len(block))] + ["z"]
            copies = block * rng.randint(1, 11)
            words += copies[:rng.randint(1, len(copies))]
        yield k, " ".join(words)


def test_random_texts_match_brute_force(spark):
    rows = list(texts(5, 300))
    want = []
    for doc, text in rows:
        runs, _ = brute(doc, text, plant=False)
        words = text.split(" ")
        drop = {i for s, length, q in runs for i in range(s + q, s + length)}
        want.append((doc, len(words), runs, " ".join(w for i, w in enumerate(words) if i not in drop)))
    assert max(q for _, _, runs, _ in want for _, _, q in runs) >= 100
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)) == sorted(want, key=str)


def test_long_runs_need_several_tiles(spark):
    odd = [f"w{i * i % 1009}" for i in range(1500)]
    rows = [(1, " ".join((odd * 5)[:6700])), (2, " ".join(["x"] * 50_000)), (3, " ".join(["p", "q", "r"] * 9000 + ["end"] + odd * 4))]
    want = [(1, 6700, [(0, 6700, 1009)], None)] if len(set(odd)) == 1009 else None
    got = found(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert got[1][2] == [(0, 50_000, 1)] and got[1][3] == "x"
    assert (0, 27_000, 3) in got[2][2] and any(n >= 6000 and q == 1500 for _, n, q in got[2][2])
    assert got[0][2] and (want is None or got == want)


def test_query_matches_brute_force_on_whole_documents(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(brute(*r)[1] for r in rows)
    assert sum(r[1] for r in want) > 20
    assert sorted(map(tuple, QUERIES["op11_periodic_runs"](spark, SMALL).collect())) == want


def test_odd_rows_and_empty_tables(spark):
    df = spark.createDataFrame(ODD, ODD_SCHEMA).withColumns({"row": F.lit(1), "runs": F.lit("x"), "rest": F.lit(2)})
    out = periodic_runs.periodic_runs(df, ["doc_id", "score", "row", "rest"])
    rows = out.collect()
    assert len(rows) == len(ODD) and out.columns[:4] == ["doc_id", "score", "row", "rest"]
    for doc, text, *_ in ODD:
        runs, _ = brute(doc, text, plant=False) if doc != 7 else (None, None)
        mine = [r for r in rows if r.doc_id == doc]
        assert len(mine) == sum(r[0] == doc for r in ODD)
        assert all(r.n_words == len(WORDS.findall(text or "")) for r in mine)
        if runs is not None:
            assert [(x.start, x.length, x.period) for x in mine[0].runs] == runs
        else:  # 60,000 words of period 997 * 31
            assert mine[0].runs == mine[1].runs == []
    assert periodic_runs.periodic_runs(df.limit(0), ["doc_id"]).count() == 0


def test_boundaries_leave_out_powers():
    words = np.array([0, 1, 2] * 200)
    starts, ends = np.array([0]), np.array([600])
    assert {octave for octave, _ in periodic_runs.boundaries(words, starts, ends)} == {1}  # 6, 9, 12, ... are multiples of 3
