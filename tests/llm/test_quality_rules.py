"""Quality rules against plain Python over whole texts."""

import re
from collections import Counter

import pytest

from conftest import SF_SMALL
from ledgerline.llm.quality_rules import RULES, Rule, apply_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = set()
    for i in range(len(words) - 4):
        if grams[tuple(words[i:i + 5])] > 1:
            hit |= set(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit),
            n < 10 or 100 * len(hit) > 20 * n)


COLS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
CASES = [
    None, "", " \t\n\x0b\x0c\r", "one", "a b c d e", "a b c d e f", "a a a a a a", "a b c d e a b c d e", "x y z w v u " * 3,
    "a b c d e f a b c d e g a b c d e", "line\nline\n \n\nline \nline", "é b   c\x85d # * $ % & | < >", "…\nx...\ny… \nz",
    "p q r s t " * 2000, " ".join(f"w{i}" for i in range(30000)), " ".join(f"w{i % 9000}" for i in range(20000)), "x" * 200000,
    "\U0001d400\U0001d401 \U0001f600", "the the the the the the the the the the the",
]


def test_counts_match_plain_python(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "doc_id long, text string")
    got = {r.doc_id: tuple(r[c] for c in COLS) for r in apply_rules(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(CASES)}


def test_counts_of_the_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = apply_rules(docs, keep=["doc_id"]).collect()
    assert {r.doc_id: tuple(r[c] for c in COLS) for r in rows} == {k: brute(t) for k, t in texts.items()}
    assert len(rows) == docs.count()


def test_verdict_follows_the_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = apply_rules(docs, keep=["doc_id"]).join(labels, "doc_id").where("NOT base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.1


def test_each_rule_names_itself(spark):
    plain = "the cat sat on a mat and it was good for them"
    cases = {
        "n_words": "the cat", "repeat_share": "a b c d e " * 5, "mean_word_length": "the " + "x" * 300 + " " + plain,
        "symbol_share": plain + " ## || %%", "letter_word_share": plain + " 12 13 14 15 16 17", "upper_share": plain.upper() + " the",
        "mark_share": plain + "." * 20, "dup_line_share": plain + "\nhe was\nhe was\nhe was", "ellipsis_line_share": plain + "...",
        "unstopped_words": " ".join(f"zq{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(40)),
    }
    df = spark.createDataFrame(list(cases.items()), "name string, text string")
    got = {r.name: r for r in apply_rules(df).collect()}
    for name, r in got.items():
        assert name in r.broken_rules.split(","), (name, r)
        assert not r.kept
    assert sorted(cases) == sorted(r.measure for r in RULES)


def test_own_table_and_clashing_columns(spark):
    df = spark.createDataFrame([("x", "short one", 7, True), ("x", "short one", 7, True), ("y", None, None, None)],
                               "doc_id string, text string, n_words int, KEPT boolean")
    out = apply_rules(df, rules=(Rule("n_words", low=1),))
    assert [c for c in out.columns if c.lower() in ("n_words", "kept")] == ["n_words", "kept"]
    assert sorted((r.doc_id, r.n_words, r.broken_rules, r.kept) for r in out.collect()) == [
        ("x", 2, "", False), ("x", 2, "", False), ("y", 0, "n_words", False)]  # the base rules hold in any case


def test_empty_table(spark):
    assert apply_rules(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_one_projection_without_python_or_shuffle(spark):
    plan = apply_rules(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Python", "Arrow", "Join"))


@pytest.mark.parametrize("n", [20000])
def test_long_repeating_text_is_linear(spark, n):
    import time

    def seconds(k):
        df = spark.createDataFrame([(0, " ".join(f"w{i % (k // 2)}" for i in range(k)))], "doc_id long, text string")
        t = time.time()
        assert apply_rules(df).first().n_repeat_words == k
        return time.time() - t

    seconds(n)
    assert seconds(4 * n) < 12 * max(seconds(n), 0.25)
