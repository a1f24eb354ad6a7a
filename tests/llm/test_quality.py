import random

import numpy as np
import pytest

from ledgerline.llm import quality as Q


def corpus(n=500, seed=1):
    r = random.Random(seed)
    vocab = ["alpha", "beta", "of", "the", "and", "river", "stone", "Über", "quiet"]
    rows, labels = [], []
    for i in range(n):
        good = r.random() < 0.8
        w = r.choices(vocab, k=r.randint(20, 200))
        t = " ".join(w) + "."
        if not good:
            t = r.choice([t.upper().replace(" ", "!! "), " ".join(w[:3] * 40), " | ".join(w), " ".join(x + "$$$" for x in w)])
        rows.append((i, t, "x", 0.1))
        labels.append((i, int(good)))
    return rows, labels


SCHEMA = "doc_id long, text string, score string, s_words double"


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    seen = spark.createDataFrame([x for x in labels if x[0] % 5], "doc_id long, quality int")
    got = {r.doc_id: r for r in Q.classify(docs, seen).collect()}
    truth = dict(labels)
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= Q.THRESHOLD) for r in got.values())
    unseen = [i for i in truth if i % 5 == 0]
    assert np.mean([got[i].predicted == truth[i] for i in unseen]) > 0.97


def test_distributed_sums_give_the_direct_solution(spark):
    rows, labels = corpus(200, 2)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    measured = Q.measure(docs.drop("s_words"), keep=["doc_id"])
    model = Q.fit(measured, spark.createDataFrame(labels, "doc_id long, quality int"))
    x = np.array([Q.statistics(t) for _, t, *_ in rows])
    y = np.array([v for _, v in labels], float)
    f = Q.fourier(x, x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3))
    pen = np.eye(f.shape[1]) * Q.RIDGE
    pen[0, 0] = 1e-9
    direct = np.linalg.solve(f.T @ f + pen, f.T @ y)
    assert np.abs(f @ model["weights"] - f @ direct).max() < 1e-6


def test_features_approximate_the_gaussian_kernel():
    r = np.random.default_rng(0)
    x = r.normal(0, 0.7, (60, len(Q.STATS)))
    old = Q.FEATURES
    try:
        Q.FEATURES = 20_000
        f = Q.fourier(x, 0.0, 1.0)[:, 1:]
    finally:
        Q.FEATURES = old
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * Q.BANDWIDTH ** 2))
    assert np.abs(f @ f.T - want).max() < 0.05


def test_isotonic_matches_brute_force():
    r = np.random.default_rng(1)
    for _ in range(30):
        m = r.integers(1, 12)
        x, n = np.arange(m, dtype=float), r.integers(1, 5, m)
        y = np.minimum(r.integers(0, 5, m), n)
        at, v = Q.isotonic(x, y, n)
        got = np.interp(x, at, v)
        want = [max(min(y[a:b + 1].sum() / n[a:b + 1].sum() for b in range(i, m)) for a in range(i + 1)) for i in range(m)]
        want = [max(min(y[a:b + 1].sum() / n[a:b + 1].sum() for b in range(i, m)) for a in range(0, i + 1)) for i in range(m)]
        assert np.allclose(got, want) and (np.diff(v) >= -1e-12).all()


EDGE = [(1, None, "x", 0.0), (2, "", "x", 0.0), (2, "", "x", 0.0), (None, "some words", "x", 0.0), (3, " \n", "x", 0.0), (4, "y" * 200000, "x", 0.0), (5, "a b " * 50000, "x", 0.0)]


@pytest.mark.parametrize("labels, want", [([], 0.5), ([(1, 1), (2, 1)], 1.0), ([(1, 0)], 0.0), ([(None, 1), (3, None)], 0.5), ([(1, 0), (2, 1), (2, 0)], None)])
def test_edges(spark, labels, want):
    got = Q.classify(spark.createDataFrame(EDGE, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    assert want is None or {r.score for r in got} == {want}


def test_empty_table(spark):
    assert Q.classify(spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, 1)], "doc_id long, quality int")).count() == 0
