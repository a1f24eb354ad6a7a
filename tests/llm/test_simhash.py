import random

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerline.llm import simhash as S


def brute_fp(text):
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if x]
    grams = [w[i:i + 3] for i in range(len(w) - 2)] or ([w] if w else [])
    h = [xxhash.xxh64_intdigest(" ".join(g).encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(rows, radius=2):
    fps = [brute_fp(t) for _, t in rows]
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                comp[root(i)] = root(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((d, f"{fps[i]:016x}", min(ids, default=None)))
    return sorted(out, key=repr)


def corpus(seed=1):
    r = random.Random(seed)
    vocab = [f"{a}{b}" for a in "abcdefgh" for b in ("one", "Two", "é", "x1")]
    base = [" ".join(r.choices(vocab, k=r.randint(60, 160))) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(base)]
    for k in range(60):
        w = r.choice(base).split(" ")
        w[r.randrange(len(w))] = r.choice(vocab)
        rows.append((100 + k, " ".join(w)))
    rows += [(500 + k, base[3]) for k in range(5)] + [(7, base[7]), (None, base[0]), (None, "lonely words here now"), (900, None), (901, ""),
             (902, " \t\n"), (903, "One"), (904, "one\x0bTWO"), (905, "the " * 5000), (906, "x" * 200000), (907, "a\x1cb c d"), (908, "a b c d")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_size", [4096, 2])
def test_matches_brute_force(spark, shard_size):
    rows = corpus()
    got = S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), shard_size=shard_size)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_groups(rows)


@pytest.mark.parametrize("radius, shard_size", [(0, 2), (2, 2), (2, 50), (3, 4096)])
def test_links_connect_what_all_pairs_connect(spark, radius, shard_size):
    r = random.Random(radius)
    values = set()
    for _ in range(30):
        x = r.getrandbits(64)
        values.add(x)
        for _ in range(8):
            x ^= 1 << r.randrange(64)
            values.add(x)
    df = spark.createDataFrame([(S._signed(v),) for v in values], "fp long")
    star = {row.u: row.root for row in S.components(S.links(df, radius, shard_size)).collect()}
    vals = [S._signed(v) for v in values]
    comp = {v: v for v in vals}

    def root(v):
        while comp[v] != v:
            v = comp[v]
        return v

    for i, a in enumerate(vals):
        for b in vals[:i]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= radius:
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    assert {v: star.get(v, v) for v in vals} == {v: root(v) for v in vals}


def test_tree_search_is_exact():
    r = random.Random(5)
    tree, values = S.BKTree(), list({r.getrandbits(12) for _ in range(500)})
    for v in values:
        tree.add(v)
    for q in values[:60]:
        assert {tree.values[i] for i in tree.search(q, 2)} == {v for v in values if (v ^ q).bit_count() <= 2}


def test_hash_is_that_of_spark(spark):
    texts = ["", "a", "abcd", "abcdefgh", "x" * 31, "é" * 40, "one two three"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t")).collect()
    assert [g[0] for g in got] == [S._signed(xxhash.xxh64_intdigest(t.encode(), seed=42)) for t in texts]


def test_deduplicate_keeps_one_of_each_group(spark):
    rows = corpus(2)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("u", F.lit("u")).withColumn("fp", F.lit(1))
    got = S.deduplicate(df)
    assert got.columns == ["doc_id", "text", "u", "fp"]
    want = brute_groups(rows)
    kept = [r.doc_id for r in got.collect()]
    groups = {c for _, _, c in want if c is not None}
    alone = {f for _, f, c in want if c is None}
    assert sorted(k for k in kept if k is not None) == sorted(groups)
    assert sum(k is None for k in kept) == len(alone)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(df).count() == 0 and S.deduplicate(df).count() == 0
