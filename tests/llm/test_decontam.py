import hashlib
import re

import pytest
from pyspark.sql import functions as F

from ledgerline.llm.decontam import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, n_hit string, Items int"


def tokens(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, window):
    out = []
    pats = []
    for item, text in items:
        w = tokens(text)
        pats += [(item, w[i:i + window]) for i in range(max(1, len(w) - window + 1))] if w else []
    for doc_id, text in docs:
        w, hit, ids = tokens(text), set(), set()
        for item, p in pats:
            for i in range(len(w) - len(p) + 1):
                if w[i:i + len(p)] == p:
                    hit |= set(range(i, i + len(p)))
                    if item is not None:
                        ids.add(str(item))
        key = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(ids), key, bool(hit)))
    return sorted(out, key=repr)


ITEMS = [(1, "one two three four five six"), (2, "two three four"), (3, None), (4, "!?"), (5, "Ünï Çode 7x"),
         (5, "Ünï Çode 7x"), (None, "nobody knows me"), (10, "a a a a a"), (9, "")]
LONG = " ".join(f"w{i}" for i in range(30000)) + " two three four " + "z" * 100000
ROWS = [(0, "zero ONE, two-three four. Five six seven"), (1, None), (2, ""), (3, "two three four two three four"),
        (3, "two three four two three four"), (4, "Ünï çode 7x ünï Çode 7X"), (5, "nobody knows me"), (None, "a a a a a a a"),
        (6, LONG), (7, "__--"), (8, "thirteen two three for")]


@pytest.mark.parametrize("shard_windows", [100000, 3])
def test_matches_brute_force(spark, shard_windows):
    docs = spark.createDataFrame([(*r, "x", 5) for r in ROWS], DOCS).drop("n_hit", "Items").repartition(3)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    for window in (4, 10):
        got = decontaminate(docs, bench, window=window, shard_windows=shard_windows).select(
            "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
        assert sorted(map(tuple, got.collect()), key=repr) == brute(ROWS, ITEMS, window)


def test_spans_map_to_the_original(spark):
    docs = spark.createDataFrame([(0, "É -- ONE, two-three four. x")], "doc_id long, text string")
    row = decontaminate(docs, spark.createDataFrame([(1, "one two three four")], "item_id long, text string")).first()
    assert [row.text[s.start:s.end] for s in row.hit_spans] == ["ONE, two-three four"]


def test_clashing_columns_give_way_and_others_stay(spark):
    docs = spark.createDataFrame([(*r, "x", 5) for r in ROWS], DOCS).withColumn("extra", F.lit(1))
    got = decontaminate(docs, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert got.columns[:3] == ["doc_id", "text", "extra"] and dict(got.dtypes)["n_hit"] == "bigint"


@pytest.mark.parametrize("rows, items", [([], ITEMS), (ROWS, []), ([], [])])
def test_empty_tables(spark, rows, items):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = decontaminate(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(got) == len(rows) and not any(r.contaminated for r in got)
