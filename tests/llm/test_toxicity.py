import random

import pytest

from ledgerline.llm import toxicity as X

VOCAB = [f"{a}{b}{c}" for a in ("ri", "sto", "ma", "lu") for b in ("ver", "ne", "ka") for c in ("", "s", "ly")]


def corpus(n=600, seed=2):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w = r.choices(VOCAB, k=r.randint(10, 80))
        bad = r.random() < 0.25
        if bad:
            for _ in range(r.randint(2, 4)):
                w.insert(r.randrange(len(w)), r.choice(["Vilefolk", "scrubhead!", "v1lefolk", "scrubhеad" if i % 7 == 0 else "scrubheads"]))
        elif r.random() < 0.3:
            w.insert(0, "scrubheadington")
        rows.append((i, " ".join(w), "k", 3))
        labels.append((i, int(bad)))
    return rows, labels


SCHEMA = "doc_id long, text string, score string, other int"


@pytest.fixture(scope="module")
def model(spark):
    rows, labels = corpus()
    return X.fit(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([x for x in labels if x[0] % 3 != 1], "doc_id long, toxic int"))


def test_held_out_documents(spark, model):
    rows, labels = corpus()
    got = {r.doc_id: r for r in X.score(spark.createDataFrame(rows, SCHEMA).repartition(3), model).collect()}
    truth = {i: y for i, y in labels if i % 3 == 1}
    assert all(got[i].predicted == y for i, y in truth.items())
    assert all(0 <= r.score <= 1 and r.other == 3 for r in got.values())


def test_lexicon_and_exceptions(model):
    assert any("vilefolk".startswith(p) for p in model["lexicon"]) and any("scrubhead ".startswith(p) for p in model["lexicon"])
    assert "scrubheadington" in model["exceptions"] or not any("scrubheadington".startswith(p) for p in model["lexicon"])


@pytest.mark.parametrize("text, folded", [("1d10t", "idiot"), ("l00s3r!", "looser"), ("the$$$ owl", "the"), ("ｆｏｏ", "foo"), ("іdіоt", "idiot"),
                                          ("a​b", "ab"), ("", ""), (None, ""), ("2024 1 b4", "b"), ("A$$hat", "asshat")])
def test_fold(text, folded):
    assert X.fold(text).split()[:1] == ([folded] if folded else [])


def brute(text, lexicon, exceptions):
    words = X.fold(text).split()
    shielded = set()
    for e in exceptions:
        e = e.split()
        for i in range(len(words) - len(e) + 1):
            if words[i:i + len(e)] == e:
                shielded |= set(range(i, i + len(e)))
    hits = [w for i, x in enumerate(words) for p, w in lexicon.items() if f"{x} ".startswith(p) and i not in shielded]
    return len(words), len(hits), round(sum(hits), 9)


def test_matcher_against_brute_force():
    r = random.Random(9)
    lexicon, exceptions = {"abc": 1.5, "abcd": 2.0, "xy": 0.7, "q ": 0.2, "abc ": 0.1}, ["abcde", "xyz abc", "q xy"]
    matcher = X.Matcher(lexicon, exceptions)
    for _ in range(300):
        t = " ".join(r.choices(["abc", "abcd", "abcde", "xy", "xyz", "q", "Abc,", "7", "é"], k=r.randint(0, 12)))
        n, k, _, w = matcher.features(t)
        want = brute(t, lexicon, exceptions)
        assert (n, k, round(w, 9)) == want, t


def test_given_exceptions_and_long_text():
    m = X.Matcher({"bad": 1.0}, ["not bad at all"])
    assert m.features("this is not bad at all, truly")[1] == 0 and m.features("bad " * 100000)[1] == 100000


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0)], [(None, 1), (2, None)]])
def test_without_both_kinds_of_labels(spark, labels):
    docs = spark.createDataFrame([(1, None, "k", 1), (2, "", "k", 1), (2, "", "k", 1), (None, "words", "k", 1)], SCHEMA)
    model = X.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert [(r.score, r.predicted) for r in X.score(docs, model).collect()] == [(0.0, 0)] * 4


def test_empty_table(spark, model):
    empty = spark.createDataFrame([], SCHEMA)
    assert X.score(empty, model).count() == 0
    assert X.fit(empty, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"))["curve"] is None


def test_fit_rows_bounds_the_sample(spark):
    rows, labels = corpus(300)
    assert X.fit(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int"), fit_rows=100)["lexicon"]
