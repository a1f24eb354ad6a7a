"""Collocations against plain Python; summaries against their guarantee."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def brute(rows, threshold=10, contained=50, top=2000, longest=3):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= threshold}
    over = defaultdict(int)
    for (lang, w), a in cand.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                over[lang, w[i:i + k]] = max(over[lang, w[i:i + k]], a)
    out = defaultdict(list)
    for (lang, w), a in cand.items():
        if 100 * over[lang, w] >= contained * a:
            continue
        cuts = [(1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
        s, _, left, right = min(cuts)
        out[lang].append((-s, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(found)[:top]))


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "lang string, text string")
    return sorted(tuple(r) for r in C.collocations(df, **more).collect())


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    words = ["The", "the", "cat", "CAT", "né", "É", "x#", "sat\x85on", "of", "zu", "\U0001d400", "a_b", "mat"]
    rows = [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice([" "] * 6 + ["\t", ". ", ",", "\n", "  ", "\x0b", "\r\n", " ? "])
                                                            for _ in range(rng.randint(0, 60)))) for _ in range(400)]
    rows += [("en", None), ("en", ""), ("en", " \t "), ("en", "..,,"), ("xx", "only once here"), (None, "the cat")]
    rows += [("fr", "mot clé " * 7000)] * 2 + [("hot", "same hot phrase again.")] * 500
    return rows


def test_matches_plain_python(spark, corpus):
    assert run(spark, corpus) == brute(corpus)


def test_other_parameters(spark, corpus):
    assert run(spark, corpus, threshold=25, contained=80, top=7) == brute(corpus, 25, 80, 7)
    assert run(spark, corpus, longest=4, threshold=12) == brute(corpus, 12, longest=4)


def test_small_partitions_chunks_windows_and_filter_change_nothing(spark, corpus, monkeypatch):
    want = brute(corpus)
    for name, value in (("CHUNK_WORDS", 700), ("PART_MASS", 400), ("WINDOW_BYTES", 37)):
        monkeypatch.setattr(C, name, value)
    assert run(spark, corpus) == want
    assert run(spark, corpus, filter_words=C.SLICE_WORDS) == want


def test_words_of_windows_match_regex(corpus, monkeypatch):
    texts = [t or "" for _, t in corpus[:420]]

    def cut():
        got = []
        for words, groups, follows in C.windows(pa.array([str(i) for i in range(len(texts))]), pa.array(texts)):
            for w, g, f in zip(words.to_pylist(), groups.to_pylist(), follows):
                got.append((int(g), w.decode(), bool(f)))
        return got

    want = [(i, w, k + 1 < len(p)) for i, t in enumerate(texts) for p in pieces(t) for k, w in enumerate(p)]
    assert cut() == want
    for size in (1, 2, 7, 100):
        monkeypatch.setattr(C, "WINDOW_BYTES", size)
        assert cut() == want
    sliced = pa.array(["zz zz", *texts[:5]]).slice(1)
    assert sum(len(w) for w, _, _ in C.windows(pa.array(["g"] * 5), sliced)) == sum(len(p) for t in texts[:5] for p in pieces(t))


@pytest.mark.parametrize("seed", range(8))
def test_summaries_keep_every_frequent_key(seed):
    rng = np.random.default_rng(seed)
    keys = (rng.zipf(1.3, 20000) % 9000).astype(np.uint64)
    true, threshold = Counter(keys.tolist()), 10
    summary = C.MisraGries(len(keys) // threshold + 1)
    pieces_of = np.array_split(keys, 37)
    for p in pieces_of:
        summary.merge(*C.summed(p, np.ones(len(p), np.int64)))
    assert summary.lost < threshold and len(summary.keys) <= summary.capacity
    assert all(0 <= true[k] - c <= summary.lost for k, c in zip(summary.keys.tolist(), summary.counts.tolist()))
    assert {k for k, c in true.items() if c >= threshold} <= set(summary.frequent(threshold).tolist())


def test_summaries_of_distinct_keys_stay_within_capacity():
    summary = C.MisraGries(100)
    for s in range(0, 1000, 50):
        summary.merge(np.arange(s, s + 50, dtype=np.uint64), np.ones(50, np.int64))
    assert len(summary.keys) <= 100 and summary.lost < 10


def test_parts_and_marks_cover_their_range():
    hashes = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2)
    for parts in (1, 3, 1000):
        p = C.part_of(np.sort(hashes), parts)
        assert p.max() < parts and (np.diff(p.astype(np.int64)) >= 0).all()
    place, bits = C.marks(hashes, C.FILTER_WORDS)
    assert place.max() < C.FILTER_WORDS and (bits > 0).all()


def test_score_is_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    cases = [(3, 7, 9), (10**9 + 7, 10**9 + 9, 10**10 + 19), (10**15, 10**15, 10**15), (999_999_999_999_989, 10**15 + 37, 10**15 + 91)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, a long, l long, r long").repartition(2)
    got = {r.i: r.s for r in df.select("i", C.score("a", "l", "r").alias("s")).where(F.col("s").isNotNull()).collect()}
    assert got == {i: 1000000 * a * a // (x * y) for i, (a, x, y) in enumerate(cases)}


def test_empty_and_wide_tables(spark):
    ddl = "score int, lang string, text string, n string, phrase string"
    assert C.collocations(spark.createDataFrame([], ddl)).collect() == []
    df = spark.createDataFrame([(1, "en", "big cat.", "n", "p")] * 12, ddl)
    assert [tuple(r) for r in C.collocations(df).collect()] == [("en", 1, "big cat", 12, 12, 12, 24, 1000000)]
    assert C.collocations(spark.createDataFrame([("en", None)], "lang string, text string")).collect() == []
