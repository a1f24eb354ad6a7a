import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerline.llm import katz as K

SCHEMA = "doc_id long, text string, held_out boolean, score string"


def toks(t):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    for c in "\t\n\r\x0b\x0c":
        w = w.replace(c, " ")
    return [x for x in w.split(" ") if x] + ["<end>"]


class Brute:
    """Katz backoff over bigrams by dictionaries, evaluated recursively."""

    def __init__(self, texts, split=None):
        self.c, self.pairs = Counter(), Counter()
        for t in texts:
            prev = "<s>"
            for w in toks(t):
                self.c[w] += 1
                self.pairs[prev, w] += 1
                prev = w
        self.n, self.v, self.docs = sum(self.c.values()), len(self.c), len(texts)
        low = Counter(self.c.values())
        self.uni = K.discounts([0] + [low[r] for r in range(1, 7)])
        kept = sum(c * (self.uni[c] if c <= 5 else 1) for c in self.c.values())
        self.total = self.n if kept < self.n else self.n + 1
        self.unk = 1 - kept / self.total if self.n else 1.0
        low = Counter(self.pairs.values())
        self.bi = K.discounts([0] + [low[r] for r in range(1, 7)])
        self.after = defaultdict(list)
        for (h, w), c in self.pairs.items():
            self.after[h].append((w, c))
        self.split = split

    def p1(self, w):
        c = self.c[w]
        return c * (self.uni[c] if c <= 5 else 1) / self.total if c else self.unk

    def h_total(self, h):
        ch = sum(c for _, c in self.after[h])
        return ch + (self.split is not None and ch >= self.split or all(c > 5 for _, c in self.after[h]))

    def p(self, w, h):
        if not self.after.get(h):
            return self.p1(w)
        total = self.h_total(h)
        c = self.pairs[h, w]
        if c:
            return c * (self.bi[c] if c <= 5 else 1) / total
        kept = sum(c * (self.bi[c] if c <= 5 else 1) for _, c in self.after[h]) / total
        return (1 - kept) / (1 - sum(self.p1(x) for x, _ in self.after[h])) * self.p1(w)

    def score(self, t):
        prev, out = "<s>", 0.0
        for w in toks(t):
            out += math.log10(self.p(w, prev))
            prev = w
        return out


def corpus(n=150, seed=1):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(80)]
    weight = [1 / (i + 1) for i in range(80)]
    rows = [(i, " ".join(r.choices(vocab, weight, k=r.randint(0, 60))) + (f" rare{i}" if i % 3 else ""), r.random() < 0.2) for i in range(n)]
    rows += [(n, None, False), (n + 1, "", True), (n + 2, " \t ", False), (3, rows[3][1], rows[3][2]), (None, "w1 unseen w2", None), (n + 3, "W0 w0 " * 500, False),
             (n + 4, "x" * 100000, True), (n + 5, "w0 é\x1cb w1", True)]
    return rows


@pytest.mark.parametrize("chunk, split, short, hot", [(10**6, 10**6, 20000, 1e-4), (300, 40, 30, 0.02), (100, 1, 0, 0.9)])
def test_matches_brute_force(spark, monkeypatch, chunk, split, short, hot):
    for name, value in (("CHUNK_TOKENS", chunk), ("SPLIT", split), ("SHORT_KEY", short), ("HOT_PAIR", hot)):
        monkeypatch.setattr(K, name, value)
    rows = corpus()
    b = Brute([t for _, t, h in rows if h is False], split)
    got = K.score(spark.createDataFrame([(*x, "s") for x in rows], SCHEMA).repartition(3)).collect()
    assert got[0].asDict().keys() == {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"}
    want = []
    for d, t, h in rows:
        w = toks(t)
        want.append((repr(d), h is not False, len(w), sum(b.c[x] > 0 for x in w), b.n, sum(math.log10((b.c[x] + 1) / (b.n + b.v + 1)) for x in w), b.score(t)))
    have = sorted((repr(x[0]), *x[1:]) for x in got)
    for a, e in zip(have, sorted(want), strict=True):
        assert a[:5] == e[:5] and np.allclose(a[5:], e[5:], rtol=1e-9)


def test_every_distribution_adds_up_to_one():
    b = Brute([t for _, t, h in corpus(60) if h is False], 40)
    for h in list(b.after)[:40] + ["unseen"]:
        assert abs(sum(b.p(w, h) for w in [*b.c, "<unknown>"]) - 1) < 1e-9


def test_better_than_the_base_on_held_out_rows(spark):
    r = random.Random(2)
    rows = []
    for i in range(300):
        w, out = "w0", []
        for _ in range(60):
            w = f"w{(int(w[1:]) * 7 + r.choice([1, 1, 1, 2])) % 50}"
            out.append(w)
        rows.append((i, " ".join(out), i % 7 == 2, "s"))
    held = [x for x in K.score(spark.createDataFrame(rows, SCHEMA)).collect() if x.held_out]
    assert sum(x.score for x in held) > 0.6 * sum(x.base_score for x in held)


@pytest.mark.parametrize("rows", [[], [(1, "a b", True, "s")], [(1, None, None, "s"), (1, None, None, "s")]])
def test_without_training_rows(spark, rows):
    got = K.score(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows) and all(x.score == 0 and x.base_score == 0 and x.train_tokens == 0 for x in got)


def test_discounts_fall_back_within_range():
    for n in ([0] * 7, [0, 5, 0, 0, 0, 0, 0], [0, 1, 9, 9, 9, 9, 9], [0, 1000, 300, 120, 70, 50, 30]):
        d = K.discounts(n)
        assert d[0] == 1 and all(0 < x < 1 for x in d[1:])


def good_turing(types):
    """Discounts from a counter of counts, by the formulas of the books."""
    n = [types[r] for r in range(7)]

    def ratio(r, n_r, n_next, share):
        return ((r + 1) * n_next / (r * n_r) - share) / (1 - share)

    x, y = ([math.log(v) for v in z] for z in (range(1, 7), n[1:]))
    mx, my = sum(x) / 6, sum(y) / 6
    b = sum((p - mx) * (q - my) for p, q in zip(x, y)) / sum((p - mx) ** 2 for p in x)
    out = [1.0]
    for r in range(1, 6):
        d = ratio(r, n[r], n[r + 1], 6 * n[6] / n[1])
        out.append(d if 0 < d < 1 else ratio(r, r**b, (r + 1)**b, 6 * 6**b))
    return out


class OwnBrute(Brute):
    """With its own Good-Turing discounts."""

    def __init__(self, texts, split=None):
        super().__init__(texts, split)
        self.uni, self.bi = (good_turing(Counter(x.values())) for x in (self.c, self.pairs))
        kept = sum(c * (self.uni[c] if c <= 5 else 1) for c in self.c.values())
        self.total = self.n if kept < self.n else self.n + 1
        self.unk = 1 - kept / self.total


def bumped(r):
    """Numbers of words and of pairs fall with their count, but for groups of five copies."""
    rows = [(i, " ".join(f"p{times}x{k}" for k in range(first)), False) for times, first in ((1, 400), (2, 90), (3, 35), (4, 14), (5, 20), (6, 6))
            for i in range(times)]
    return [(i, t, h) for i, (_, t, h) in enumerate(rows)] + [(100 + i, " ".join(r.choices([f"p{r.randint(1, 6)}x1", "p2x3", "p2x4", "new"], k=9)), True) for i in range(9)]


def test_one_bump_leaves_the_other_counts_good_turing(spark):
    rows = bumped(random.Random(4))
    b = OwnBrute([t for _, t, h in rows if not h])
    for types, d in ((Counter(b.c.values()), b.uni), (Counter(b.pairs.values()), b.bi)):
        assert 5 * types[5] / types[4] / 4 > 1  # the Good-Turing ratio of 4 alone is out of range
        share = 6 * types[6] / types[1]
        got = K.discounts([0] + [types[r] for r in range(1, 7)])
        assert np.allclose(got, d) and all(0 < x < 1 for x in got[1:])
        for r in (1, 2, 3, 5):
            assert math.isclose(got[r], ((r + 1) * types[r + 1] / types[r] / r - share) / (1 - share))
    got = {x.doc_id: x.score for x in K.score(spark.createDataFrame([(*x, "s") for x in rows], SCHEMA)).collect()}
    assert all(math.isclose(got[i], b.score(t), rel_tol=1e-9) for i, t, _ in rows)


def test_smoothed_ratios_with_gaps_and_repeated_corpora():
    twice = K.discounts([0, 0, 900, 0, 150, 0, 40])  # every document twice
    assert all(0 < x < 1 for x in twice[1:]) and twice[1:] == sorted(twice[1:])
    assert K.discounts([0, 10, 8, 7, 7, 7, 9])[1:] == [(r - 10 / 26) / r for r in range(1, 6)]  # the numbers hardly fall
