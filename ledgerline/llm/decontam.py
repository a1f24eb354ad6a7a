"""Benchmark decontamination with one Aho-Corasick automaton.

Texts are normalised to words (A-Z lower-cased; a word is a run of digits,
letters and non-ASCII characters). Every run of ``window`` consecutive words
of a benchmark item, or the whole item when it is shorter, is a pattern over
word numbers. A document becomes one sequence of word numbers and is scanned
once; each occurrence marks its words as hit, and word positions map back to
character offsets of the original text.

Scale: the distinct windows are computed in Spark and dealt into shards of at
most ``shard_windows`` patterns, so an automaton has a proven size bound. One
shard (the usual case) is broadcast and the documents are scanned with no
shuffle. With more shards the documents are scanned once per shard, and only
documents with hits are merged.

Defined cases: a null or empty text has no words and no hits. An item without
words has no windows. A null item id still marks words but is no member of the
item list. Repeated items count once; each document row gets its own result
row. Columns of the input that are named like a result column give way.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shared import annotate, as_bytes, kept_columns, prepare

WINDOW = 10
SHARD_WINDOWS = 200_000

#: Bytes of words stay (A-Z in lower case), all others become blanks.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                    for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_AZ = {c: c + 32 for c in range(65, 91)}

RESULT = ("n_words long, n_hit long, n_items long, items string, items_sha256 string, contaminated boolean, "
          "hit_spans array<struct<start:int,end:int>>")
RESULT_NAMES = ["n_words", "n_hit", "n_items", "items", "items_sha256", "contaminated", "hit_spans"]


def words(text: str | None) -> list[bytes]:
    return as_bytes(text).translate(_WORD_BYTES).split()


def benchmark_windows(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(gram, items): each distinct window with the sorted ids it occurs in."""
    def make():
        def fn(texts):
            out = []
            for t in texts:
                w = [x.decode("utf-8", "replace") for x in words(t)]
                n = max(1, len(w) - window + 1) if w else 0
                out.append(([" ".join(w[i:i + window]) for i in range(n)],))
            return out
        return fn

    per_item = annotate(benchmark.select(F.col(item_col).cast("string").alias("__item"), F.col(text_col).alias("__t")),
                        "__t", "grams array<string>", make, keep=["__item"])
    return (per_item.select("__item", F.explode("grams").alias("gram"))
            .groupBy("gram").agg(F.sort_array(F.collect_set("__item")).alias("items")))


def _automaton(patterns: list[tuple[list[bytes], list[str]]]):
    numbers: dict[bytes, int] = {}
    auto = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for gram, items in patterns:
        key = tuple(numbers.setdefault(w, len(numbers) + 1) for w in gram)
        auto.add_word(key, (len(key), items))
    if patterns:
        auto.make_automaton()
    return numbers, auto


class _Numbers(dict):
    def __missing__(self, _):
        return 0


_built: dict[str, tuple] = {}  # the automaton of the last shard seen by this worker


def _scanner(shard, key: str):
    """Function from a text to (n_words, hit word mask or None, item ids)."""
    if key not in _built:
        _built.clear()
        numbers, auto = _automaton([(g.encode().split(b" "), i) for g, i in shard])
        _built[key] = (_Numbers(numbers).__getitem__, auto)
    number, auto = _built[key]
    empty = len(auto) == 0

    def scan(text):
        w = words(text)
        if empty or not w:
            return len(w), None, ()
        edges, items = None, set()
        for end, (n, ids) in auto.iter(tuple(map(number, w))):
            if edges is None:
                edges = np.zeros(len(w) + 1, np.int32)
            edges[end - n + 1] += 1
            edges[end + 1] -= 1
            items.update(ids)
        return len(w), None if edges is None else np.cumsum(edges[:-1]) > 0, items

    return scan


def _spans(text: str, mask) -> list[dict]:
    """Character ranges of maximal runs of hit words in the original text."""
    at = [m.span() for m in _WORD.finditer(text.translate(_AZ))]
    step = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return [{"start": at[a][0], "end": at[b - 1][1]} for a, b in zip(step[::2], step[1::2])]


def _row(text, n, mask, items):
    ids = ",".join(sorted(items))
    return (n, int(mask.sum()) if mask is not None else 0, len(items), ids,
            hashlib.sha256(ids.encode()).hexdigest(), mask is not None, _spans(text, mask) if mask is not None else [])


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, shard_windows: int = SHARD_WINDOWS,
                  keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns in ``keep``) with the columns of ``RESULT``."""
    spark = prepare(docs.sparkSession)
    grams = benchmark_windows(benchmark, item_col, item_text_col, window)
    grams = grams.checkpoint()
    shards = max(1, -(-grams.count() // shard_windows))
    cast = []
    for s in range(shards):
        part = grams if shards == 1 else grams.where(F.pmod(F.xxhash64("gram"), F.lit(shards)) == s)
        rows = sorted((r.gram, list(r["items"])) for r in part.toLocalIterator())
        key = hashlib.sha256(repr(rows).encode()).hexdigest()
        cast.append((spark.sparkContext.broadcast(rows), key))
    if shards == 1:
        shard, key = cast[0]

        def make():
            scan = _scanner(shard.value, key)
            return lambda texts: [_row(t, *scan(t)) for t in texts]

        return annotate(docs, text_col, RESULT, make, keep)
    return _many_shards(docs, text_col, cast, keep)


def _many_shards(docs: DataFrame, text_col: str, cast, keep) -> DataFrame:
    """One scan per shard; word masks of documents with hits are merged by the
    digest of the text, so equal texts share one merge."""
    found = None
    for shard, key in cast:
        def make(shard=shard, key=key):
            scan = _scanner(shard.value, key)

            def fn(texts):
                out = []
                for t in texts:
                    _, mask, items = scan(t)
                    hit = mask is not None
                    out.append((hit, np.flatnonzero(mask).tolist() if hit else [], sorted(items)))
                return out
            return fn

        one = annotate(docs.select(F.col(text_col).alias("__t"), F.sha2(F.coalesce(text_col, F.lit("")), 256).alias("__key")),
                       "__t", "hit boolean, at array<int>, ids array<string>", make, keep=["__key"])
        one = one.where("hit").dropDuplicates(["__key"])
        found = one if found is None else found.unionByName(one)
    merged = found.groupBy("__key").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("__at"),
                                        F.array_distinct(F.flatten(F.collect_list("ids"))).alias("__ids"))
    carried = kept_columns(docs, RESULT_NAMES, keep)
    joined = (docs.select(*[F.col(f"`{c}`") for c in carried], F.col(text_col).alias("__t"),
                          F.sha2(F.coalesce(text_col, F.lit("")), 256).alias("__key"))
              .join(merged, "__key", "left")
              .select(*[F.col(f"`{c}`") for c in carried],
                      F.to_json(F.struct(F.coalesce("__t", F.lit("")).alias("t"), F.col("__at").alias("at"),
                                         F.col("__ids").alias("ids"))).alias("__packed")))

    def make_final():
        import json

        def fn(packed):
            out = []
            for p in packed:
                x = json.loads(p)
                n, at = len(words(x["t"])), x.get("at")
                mask = None
                if at:
                    mask = np.zeros(n, bool)
                    mask[at] = True
                out.append(_row(x["t"], n, mask, x.get("ids") or []))
            return out
        return fn

    return annotate(joined, "__packed", RESULT, make_final, keep=carried)
