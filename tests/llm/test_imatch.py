import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import imatch as I


def corpus(n=120, seed=3):
    r = random.Random(seed)
    vocab = [f"w{i}é" for i in range(300)]
    rows = [(i, " ".join(r.choices(vocab, k=r.randint(1, 150)))) for i in range(n)]
    rows += [(5, rows[5][1])] * 3 + [(n + 1, rows[7][1]), (n + 2, None), (n + 3, ""), (n + 4, "!? 😀"), (None, "Some Words"), (None, None),
             (n + 9, "x" * 50000), (n + 10, "one ONE One.")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "e") for r in rows], "doc_id long, text string, Fingerprint string")


@pytest.mark.parametrize("bucket", [20000, 7])
def test_next_and_edits_match_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(I, "BUCKET_ROWS", bucket)
    r = random.Random(bucket)
    rows = [(i, "".join(r.choices("ab😀é c", k=r.randint(0, 30)))) for i in r.sample(range(10**6), 100)]
    got = {x.doc_id: (x.n_chars, x.edited_sha256) for x in I.compare_with_edits(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    rows.sort(reverse=True)
    for (d, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
        cut = len(t) // 2
        assert got[d] == (len(t), hashlib.sha256((t[:len(t) - cut] + nxt[:cut]).encode()).hexdigest())


@pytest.mark.parametrize("bucket", [20000, 5])
def test_nulls_ties_and_repeated_rows(spark, monkeypatch, bucket):
    monkeypatch.setattr(I, "BUCKET_ROWS", bucket)
    rows = corpus()
    got = I.compare_with_edits(frame(spark, rows).repartition(4)).collect()
    assert sorted(repr(x.doc_id) for x in got) == sorted(repr(d) for d, _ in rows)
    assert all(0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1 for x in got)
    assert {x.fingerprint for x in got if x.n_chars == 0} == {"-"}


def test_equal_texts_have_equal_fingerprints_and_edits_are_nearer_than_others(spark):
    df = frame(spark, corpus(200))
    lex = I.lexicon(df, low=0.01)
    prints = {}
    for x in I.fingerprints(df, lex).collect():
        assert prints.setdefault(x.text or "", x.fingerprint) == x.fingerprint
    got = I.compare_with_edits(df, low=0.01).where("n_chars > 200").agg(F.avg("near_edited"), F.avg("near_next")).first()
    assert got[0] > 5 * got[1]


def test_lexicon_is_the_band(spark):
    rows = corpus(80)
    df = frame(spark, rows)
    slots = I.lexicon(df, low=0.05, high=0.3).first().slots
    import re

    docs = {}
    for _, t in rows:
        for w in set(x for x in re.split(r"[\W_]+", (t or "").lower()) if x):
            docs[w] = docs.get(w, 0) + 1
    band = [w for w, n in docs.items() if 0.05 * len(rows) <= n <= 0.3 * len(rows)]
    want = {x[0] for x in spark.createDataFrame([(w,) for w in band], "w string").select(F.xxhash64("w")).collect()}
    assert {t for s in slots for t in s} == want and len(slots) == I.LOOKUP_SLOTS


def test_rank_among_edges(spark):
    edges = [1, 3, 3, 3, 3, 7, 9, 9, 12, 20, 21]
    df = spark.range(0, 25).coalesce(1)
    got = df.select("id", I._rank(edges, F.col("id"), lambda x, k: x <= k), I._rank(edges, F.col("id"), lambda x, k: x < k)).collect()
    assert [(a, b) for _, a, b in got] == [(sum(e <= k for e in edges), sum(e < k for e in edges)) for k in range(25)]


def test_likeness(spark):
    pairs = [("-", "-", 1.0), ("-", "1:a|2:b", 0.0), ("1:a,b,,|2:,b", "1:a,b,,|2:,b", 1.0), ("1:a,b,,|2:,b", "1:a,c,,|2:,b", 2 / 3),
             ("1:a|2:b", "2:b|3:c", 1.0), ("1:a|2:b", "4:b|5:c", 0.0), ("1:,|2:,", "2:,|3:x", 0.0)]
    df = spark.createDataFrame([p[:2] for p in pairs], "a string, b string").coalesce(1)
    assert [x[0] for x in df.select(I.likeness(F.col("a"), F.col("b"))).collect()] == [p[2] for p in pairs]


def test_plan_is_native_and_looks_up_once(spark):
    df = frame(spark, corpus(20))
    plan = I.fingerprints(df, I.lexicon(df, low=0.01))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and "__slots" not in plan.split("Subquery")[0]


def test_empty_table(spark):
    assert I.compare_with_edits(spark.createDataFrame([], "doc_id long, text string")).count() == 0
