import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import packing as K

ODD = ["a\x85b\xa0C d", "İstanbul Ǆ É́e", "a\x1cb <|endoftext|>x", "ﬁ Ⅷ ² x²y", "\x00\x7f a\x01", "it's they'LL", "", "  ", "日本 Привет ΣΑΣ",
       "😀é́ ́x", "<|startoftext|>", "don't can’t", "x" * 5000, "word, " * 3000, "7 77 7.7"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(K.TOKENIZER))


def want_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("text", ODD)
def test_word_by_word_ids_are_the_tokenizers(tokenizer, text):
    for by_word in (True, False):
        got = K.encoder(public_tokenizers.path(K.TOKENIZER), by_word).ids(text)
        assert np.frombuffer(got, "<u4").tolist() == want_ids(tokenizer, text)[:-1]


def test_memory_is_bounded_and_exact():
    calls = []
    m = K._Memory(lambda k: calls.append(k) or k * 2, 10)
    r = random.Random(0)
    for _ in range(2000):
        k = r.randrange(60)
        assert m[k] == 2 * k and len(m) + len(m.old) <= 20


def check_packed(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_round_trip(spark, tokenizer):
    r = random.Random(3)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, None), (None, "null id"), (7, "twice here"), (7, "twice here")]
    rows += [(200 + i, " ".join(r.choices(["river", "Stone,", "été", "ab12"], k=r.randint(0, 60)))) for i in range(200)]
    docs = spark.createDataFrame([(*x, 9, "s") for x in rows], "doc_id long, text string, length int, sequence_id string").repartition(5)
    for capacity in (64, 2048):
        got = K.pack(docs, capacity=capacity, with_ids=True).collect()
        assert set(got[0].asDict()) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"}
        texts = Counter((repr(d), tuple(want_ids(tokenizer, t))) for d, t in rows)
        parts = defaultdict(list)
        for p in got:
            ids = np.frombuffer(bytes(p.ids), "<u4")
            assert len(ids) == p.length <= capacity and p.start == p.piece * capacity and p.ids_crc32 == zlib.crc32(ids.tobytes())
            parts[repr(p.doc_id)].append((p.piece, tuple(ids.tolist())))
        for key in parts:
            own = [ids for (d, ids), n in texts.items() if d == key for _ in range(n)]
            pieces = Counter((k // capacity, ids[k:k + capacity]) for ids in own for k in range(0, len(ids), capacity))
            assert Counter(parts[key]) == pieces
        bins = check_packed(got, capacity)
        assert bins <= 1.05 * sum(p.length for p in got) / capacity + 1


def optimum(items, capacity):
    """Least number of bins, by branch and bound."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for room in sorted(set(bins)):
            if room >= items[i]:
                k = bins.index(room)
                go(i + 1, bins[:k] + [room - items[i]] + bins[k + 1:])
        go(i + 1, bins + [capacity - items[i]])

    go(0, [])
    return best[0]


def test_reduction_keeps_the_optimum():
    r = random.Random(11)
    for _ in range(150):
        capacity = r.randint(10, 40)
        items = [r.randint(1, capacity) for _ in range(r.randint(1, 9))]
        plan = K.Plan(dict(Counter(items)), capacity)
        K.reduce(plan)
        left = [n for n, c in plan.left.items() for _ in range(c)]
        assert plan.sequences + optimum(left, capacity) == optimum(items, capacity)


def test_plans_are_valid_and_near_the_bound():
    r = random.Random(12)
    for _ in range(30):
        capacity = r.choice([50, 200, 2048])
        counts = Counter(min(capacity, 1 + int(r.expovariate(4 / capacity))) for _ in range(r.randint(1, 3000)))
        plan = K.plan_for(dict(counts), capacity)
        fill, seen = defaultdict(list), Counter()
        for length, rank, sequence, each, offset in sorted(plan.places):
            assert rank == seen[length]
            nxt = min((p[1] for p in plan.places if p[0] == length and p[1] > rank), default=counts[length])
            for i in range(nxt - rank):
                fill[sequence + i // each].append((offset + i % each * length, length))
            seen[length] = nxt
        assert seen == counts and len(fill) == plan.sequences
        for places in fill.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= capacity
        lower = -(-sum(n * c for n, c in counts.items()) // capacity)
        assert plan.sequences <= max(lower + 2, 1.25 * lower)


def test_empty_table(spark):
    assert K.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_words_are_encoded_but_not_kept(tokenizer):
    enc = K.Encoder(public_tokenizers.path(K.TOKENIZER))
    long = ["".join(random.Random(i).choices("abcdefgh0123", k=3000)) for i in range(20)]
    text = " ".join([*long, "short", *long, "short,"])
    assert np.frombuffer(enc.ids(text), "<u4").tolist() == want_ids(tokenizer, text)[:-1]
    kept = {*enc.words, *enc.words.old, *enc.pieces, *enc.pieces.old}
    assert {"short", "short,"} <= kept and max(map(len, kept)) <= K.CACHE_LETTERS


def test_words_of_one_piece_are_kept_once():
    enc = K.Encoder(public_tokenizers.path(K.TOKENIZER))
    enc.ids(" ".join(f"word{'abcdefghij'[i]}" for i in range(10)) + " ends,")
    assert len(enc.words) == 11 and set(enc.pieces) == {"ends", ","}


def test_places_are_looked_up_without_sorting_pieces(spark):
    docs = spark.createDataFrame([(i, "river stone " * (i % 7)) for i in range(60)], "doc_id long, text string").repartition(4)
    for with_ids in (False, True):
        plan = K.pack(docs, with_ids=with_ids)._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "BuildRight" in plan and "SortMergeJoin" not in plan, plan


def test_counts_of_a_task_come_with_its_pieces(spark):
    docs = spark.createDataFrame([(i, "river stone " * (i % 7)) for i in range(60)], "doc_id long, text string").repartition(4)
    rows = K.pieces(docs, id_col="doc_id", text_col="text", capacity=8, end_id=0, with_ids=False, by_word=True,
                    tokenizer_file=public_tokenizers.path(K.TOKENIZER)).collect()
    assert Counter((r.task, r.length) for r in rows if r.piece >= 0) == {(r.task, r.length): r.rank for r in rows if r.piece < 0}
    assert "Aggregate" not in K.pack(docs, capacity=8)._jdf.queryExecution().executedPlan().toString()
