"""Phrase collocations, mined with mergeable Misra-Gries summaries.

First pass: tasks count the n-grams of chunks of text exactly, by 64-bit hash,
and deal them out by ranges of the hash. Each hash partition merges what it
gets into one Misra-Gries summary, whose capacity exceeds the partition's mass
divided by the threshold: all subtractions together then stay under the
threshold, so every n-gram that is frequent enough survives. What is left, a
superset of the frequent n-grams, marks a bit filter of a fixed size
(``FILTER_WORDS``), the one thing that is broadcast. Second pass: the n-grams
that the filter lets through (longer ones only if their parts pass) are counted
exactly, by their words. Hash collisions, lossy counters and a full filter only
let more through; they never change a count.

Scale: the number of hash partitions grows with the text, so a partition's
memory does not; a chunk pre-aggregates, so a phrase that makes up a third of
all rows is one row a chunk. A filter that is too small for a corpus costs
shuffled rows, not results; ``filter_words`` enlarges it.

Defined cases: a null text counts as empty, a null group as ``und`` (which it
joins if that occurs); a group without candidates has no rows. Words and pieces
are cut at ASCII characters only, of whole texts. Texts may be of any length:
a batch is worked through in windows that end where pieces end. Repeated rows
count as often as they occur. Columns other than text and group are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shared import LOWER

#: Words of a chunk that one task counts at once, and n-grams of a partition.
CHUNK_WORDS = 1 << 18
PART_MASS = 8_000_000
#: 64-bit words of the filter (16 MB), in slices that are merged one by one.
FILTER_WORDS = 1 << 21
SLICE_WORDS = 1 << 11
WINDOW_BYTES = 1 << 22
SALTS = 64

_BREAK, _BLANK = b".,;:!?\n\x0b\x0c\r", b" \t"
_CLASS = np.zeros(256, np.uint8)
_CLASS[list(_BLANK)] = 1
_CLASS[list(_BREAK)] = 2
_LOWER = np.frombuffer(LOWER, np.uint8)


# --- words of a batch --------------------------------------------------------------
def windows(groups: pa.Array, texts: pa.Array):
    """Cut texts into words: (words, group of each word, does the next word
    follow in the same piece), window by window."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or offsets[0] == offsets[-1]:
        return
    data = _LOWER[np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]]
    offsets = offsets - offsets[0]
    kind = _CLASS[data]
    starts_text = np.zeros(len(data), bool)
    starts_text[offsets[:-1][offsets[:-1] < len(data)]] = True
    parts = starts_text | (kind == 2)  # a window may start at any of these
    at = 0
    while at < len(data):
        end = min(at + WINDOW_BYTES, len(data))
        if end < len(data):
            back = np.flatnonzero(parts[at + 1:end + 1])
            if len(back):
                end = at + 1 + int(back[-1])
            else:
                ahead = np.argmax(parts[end:])
                end = end + int(ahead) if parts[end + ahead] else len(data)
        is_word = kind[at:end] == 0
        begins, ends = is_word.copy(), is_word.copy()
        begins[1:] &= ~is_word[:-1] | starts_text[at + 1:end]
        ends[:-1] &= ~is_word[1:] | starts_text[at + 1:end]
        first, last = np.flatnonzero(begins), np.flatnonzero(ends)
        if len(first):
            piece = np.cumsum(parts[at:end], dtype=np.int64)[first]
            follows = np.zeros(len(first), bool)
            follows[:-1] = piece[1:] == piece[:-1]
            places = np.zeros(len(first) + 1, np.int64)
            np.cumsum(last - first + 1, out=places[1:])
            words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(places), pa.py_buffer(data[at:end][is_word])])
            text = np.searchsorted(offsets, first + at, "right") - 1
            yield words, groups.take(pa.array(text)), follows
        at = end


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


class Chunk:
    """Words of many texts, and their n-grams with exact counts."""

    def __init__(self):
        self.words, self.groups, self.follows, self.n = [], [], [], 0

    def add(self, words, groups, follows) -> None:
        self.words.append(words)
        self.groups.append(groups)
        self.follows.append(follows)
        self.n += len(words)

    def grams(self, longest: int, passes=None):
        """For n = 1 to ``longest``: (n, ids of the n words of each distinct
        n-gram, hashes, counts); ids are numbers of (group, word) pairs. With
        ``passes``, a test of hashes, only n-grams whose parts and self pass;
        without it the ids of the words are not made up."""
        words = pa.chunked_array(self.words).dictionary_encode().combine_chunks()
        groups = pa.chunked_array(self.groups).dictionary_encode().combine_chunks()
        follows = np.concatenate(self.follows)
        pair, ids, counts = np.unique(groups.indices.to_numpy().astype(np.int64) * len(words.dictionary) + words.indices.to_numpy(), return_inverse=True, return_counts=True)
        if passes is not None:
            self.word_of = words.dictionary.take(pa.array(pair % len(words.dictionary)))
            self.group_of = groups.dictionary.take(pa.array(pair // len(words.dictionary)))
        of_word = np.array([xxhash.xxh64_intdigest(w) for w in words.dictionary.to_pylist()], np.uint64)
        of_group = np.array([xxhash.xxh64_intdigest(g.encode(), seed=1) for g in groups.dictionary.to_pylist()], np.uint64)
        one = _joined(of_group[pair // len(words.dictionary)], of_word[pair % len(words.dictionary)])
        members, hashes = np.arange(len(pair))[:, None] if passes is not None else None, one
        at, gram = np.arange(len(ids)), ids  # where n-grams start, and their numbers
        for n in range(1, longest + 1):
            if n > 1:
                after = at + n - 1  # the word behind the shorter n-gram
                more = after < len(ids)
                at, gram, after = at[more], gram[more], after[more]
                more = follows[after - 1]
                if passes is not None and len(at):  # the part without its first word passes as well
                    begins = np.zeros(len(ids) + 1, bool)
                    begins[starts] = True
                    more = more & begins[at + 1]
                at, gram, after = at[more], gram[more], after[more]
                key, gram, counts = np.unique(gram * len(pair) + ids[after], return_inverse=True, return_counts=True)
                shorter = key // len(pair)
                if passes is not None:
                    members = np.column_stack([members[shorter], key % len(pair)])
                hashes = _joined(hashes[shorter], one[key % len(pair)])
            if passes is not None:
                ok = passes(hashes)
                number = np.cumsum(ok) - 1
                held = ok[gram]
                at, gram = at[held], number[gram[held]]
                members, hashes, counts = members[ok], hashes[ok], counts[ok]
                starts = at
            yield n, members, hashes, counts

    def totals(self):
        return pc.value_counts(pa.chunked_array(self.groups)).to_pylist()


def chunks(batches):
    chunk = Chunk()
    for b in batches:
        for found in windows(b.column(0), b.column(1)):
            chunk.add(*found)
            if chunk.n >= CHUNK_WORDS:
                yield chunk
                chunk = Chunk()
    if chunk.n:
        yield chunk


# --- first pass ---------------------------------------------------------------------
def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of distinct keys."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


class MisraGries:
    """At most ``capacity`` counters; each falls short of the true count by
    ``lost`` at most, which is at most the mass divided by capacity + 1."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys, self.counts = summed(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))
        if len(self.keys) > self.capacity:
            less = int(np.partition(self.counts, -self.capacity - 1)[-self.capacity - 1])
            self.lost += less
            kept = self.counts > less
            self.keys, self.counts = self.keys[kept], self.counts[kept] - less

    def frequent(self, threshold: int) -> np.ndarray:
        """Every key whose true count may reach the threshold."""
        return self.keys[self.counts + self.lost >= threshold]


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Partition by range of the hash: 0 to ``parts`` - 1."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


#: Most n-grams of a chunk occur once in it; they go without a count.
_PACKED = ["part", "mass", "ones", "hashes", "counts"]


def _summaries(longest: int, parts: int):
    """Each chunk's n-grams, a row for each hash partition, and a row ahead of
    them with their mass."""
    def run(batches):
        for chunk in chunks(batches):
            hashes, counts = map(np.concatenate, zip(*[(h, c) for _, _, h, c in chunk.grams(longest)]))
            hashes, counts = summed(hashes, counts.astype(np.int64))
            borders = np.searchsorted(part_of(hashes, parts), np.arange(parts + 1).astype(np.uint64))
            used = np.flatnonzero(np.diff(borders))
            mass = np.add.reduceat(counts, borders[used])
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(mass), *[pa.nulls(len(used), pa.binary()) for _ in range(3)]], names=_PACKED)
            for p in used:
                h, c = hashes[borders[p]:borders[p + 1]], counts[borders[p]:borders[p + 1]]
                packed = (h[c == 1], h[c > 1], c[c > 1].astype(np.uint32))
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.nulls(1, pa.int64()), *[pa.array([x.tobytes()], pa.binary()) for x in packed]],
                                                 names=_PACKED)

    return run


def marks(hashes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Filter word and four bits in it for each hash."""
    place = ((hashes >> np.uint64(32)) * np.uint64(words)) >> np.uint64(32)
    bits = np.zeros(len(hashes), np.uint64)
    for k in range(4):
        bits |= np.uint64(1) << ((hashes >> np.uint64(6 * k)) & np.uint64(63))
    return place.astype(np.int64), bits


def _frequent(threshold: int, words: int):
    """One summary a partition, and the filter's slices that it marks."""
    def run(batches):
        part, mass, summary, keys, counts = None, 0, None, [], []

        def merged():
            if keys:
                summary.merge(np.concatenate(keys), np.concatenate(counts).astype(np.int64))
                keys.clear()
                counts.clear()

        def slices():
            merged()
            place, bits = marks(summary.frequent(threshold), words)
            for s in np.unique(place // SLICE_WORDS):
                mine = place // SLICE_WORDS == s
                out = np.zeros(SLICE_WORDS, np.uint64)
                np.bitwise_or.at(out, place[mine] % SLICE_WORDS, bits[mine])
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([out.tobytes()], pa.binary())], names=["slice", "bits"])

        for b in batches:
            for p, m, one, h, c in zip(*[x.to_pylist() for x in b.columns]):
                if p != part:
                    if summary is not None:
                        yield from slices()
                    part, mass, summary = p, 0, None
                if m is not None:
                    mass += m
                    continue
                if summary is None:
                    summary = MisraGries(mass // threshold + 1)
                keys += [np.frombuffer(one, np.uint64), np.frombuffer(h, np.uint64)]
                counts += [np.ones(len(keys[-2]), np.uint32), np.frombuffer(c, np.uint32)]
                if sum(map(len, keys)) >= max(summary.capacity, 1 << 18):
                    merged()
        if summary is not None:
            yield from slices()

    return run


def candidate_filter(texts: DataFrame, longest: int, threshold: int, words: int) -> np.ndarray:
    """First pass: a bit filter that every frequent n-gram passes."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-longest * size // 6 // PART_MASS))  # of about six bytes a word
    rows = texts.mapInArrow(_summaries(longest, parts), "part int, mass long, ones binary, hashes binary, counts binary")
    rows = rows.repartition("part").sortWithinPartitions("part", F.col("hashes").isNotNull())
    slices = rows.mapInArrow(_frequent(threshold, words), "slice int, bits binary")
    out = np.zeros(words, np.uint64)
    # At most FILTER_WORDS / SLICE_WORDS rows of one slice each.
    for r in slices.groupBy("slice").applyInArrow(_either_of, "slice int, bits binary").collect():
        out[r["slice"] * SLICE_WORDS:(r["slice"] + 1) * SLICE_WORDS] = np.frombuffer(r["bits"], np.uint64)
    return out


def _either_of(key, table):
    """The bits of one slice, from all partitions that mark it."""
    out = np.zeros(SLICE_WORDS, np.uint64)
    for x in table.column("bits").to_pylist():
        out |= np.frombuffer(x, np.uint64)
    return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([out.tobytes()], pa.binary())})


# --- second pass --------------------------------------------------------------------
def _exact(longest: int, filter_bits):
    """Exact counts of a chunk's n-grams that pass the filter; n = 0 has the
    number of words of each group."""
    def run(batches):
        bits = filter_bits.value

        def passes(hashes):
            place, want = marks(hashes, len(bits))
            return (bits[place] & want) == want

        def batch(group, n, phrase, count):
            return pa.RecordBatch.from_arrays([group.cast(pa.string()), pa.array(np.full(len(group), n), pa.int32()), phrase, pa.array(count, pa.int64())],
                                              names=["lang", "n", "phrase", "f"])

        for chunk in chunks(batches):
            total = chunk.totals()
            yield batch(pa.array([x["values"] for x in total], pa.string()), 0, pa.array([""] * len(total), pa.string()), [x["counts"] for x in total])
            for n, members, _, counts in chunk.grams(longest, passes):
                for s in range(0, len(counts), 1 << 16):
                    some = members[s:s + (1 << 16)]
                    columns = [chunk.word_of.take(pa.array(some[:, k])) for k in range(n)]
                    phrase = columns[0] if n == 1 else pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary()))
                    yield batch(chunk.group_of.take(pa.array(some[:, 0])), n, phrase.cast(pa.binary()).cast(pa.string()), counts[s:s + (1 << 16)])

    return run


def frequent_ngrams(docs: DataFrame, longest: int = 3, threshold: int = 10, text_col: str = "text", group_col: str = "lang",
                    filter_words: int = FILTER_WORDS) -> DataFrame:
    """(lang, n, phrase, f): exact counts of all n-grams of up to ``longest``
    words that occur ``threshold`` times or more in their group, and the number
    of words of each group (n = 0, empty phrase)."""
    texts = docs.select(F.coalesce(F.col(f"`{group_col}`").cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    found = candidate_filter(texts, longest, threshold, filter_words)
    shared = docs.sparkSession.sparkContext.broadcast(found)
    counts = texts.mapInArrow(_exact(longest, shared), "lang string, n int, phrase string, f long")
    return counts.groupBy("lang", "n", "phrase").agg(F.sum("f").alias("f")).where((F.col("n") == 0) | (F.col("f") >= threshold))


def _exact_number(c: str) -> Column:
    return F.col(c).cast("decimal(19,0)")


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (left right)), in decimals: exact up to a product of
    38 digits, beyond which the cast raises. The quotient is at most 1000000,
    as no part occurs less often than the phrase."""
    top = (_exact_number(a) * _exact_number(a)) * F.lit(1000000).cast("decimal(7,0)")
    bottom = _exact_number(left) * _exact_number(right)
    return F.call_function("div", top, bottom).cast("bigint")


def _words(first, count) -> Column:
    return F.array_join(F.slice("w", first, count), " ")


def collocations(docs: DataFrame, longest: int = 3, threshold: int = 10, contained: int = 50, top: int = 2000, text_col: str = "text",
                 group_col: str = "lang", filter_words: int = FILTER_WORDS) -> DataFrame:
    """The best ``top`` phrases of each group: 2 to ``longest`` words, found
    ``threshold`` times or more, scored at the weakest cut; those that lie in a
    longer phrase with ``contained`` percent of their count or more are out."""
    grams = frequent_ngrams(docs, longest, threshold, text_col, group_col, filter_words).checkpoint()
    phrases = grams.where("n > 1").select("lang", "n", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = phrases.select("lang", "phrase", "a", F.explode(F.transform(
        F.sequence(F.lit(1), F.col("n") - 1),
        lambda k: F.struct(k.alias("cut"), _words(F.lit(1), k).alias("p"), _words(k + 1, F.col("n") - k).alias("q")))).alias("x")).select(
            "lang", "phrase", "a", "x.*")
    counts = grams.where("n > 0")
    cuts = (cuts.join(counts.select("lang", F.col("phrase").alias("p"), F.col("f").alias("l")), ["lang", "p"])
            .join(counts.select("lang", F.col("phrase").alias("q"), F.col("f").alias("r")), ["lang", "q"]))
    best = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct(score("a", "l", "r").alias("score"), "cut", "l", "r")).alias("b"))
    # All shorter phrases inside each candidate, with its count.
    inner = phrases.where("n > 2").select("lang", "a", "w", "n", F.explode(F.sequence(F.lit(2), F.col("n") - 1)).alias("k")).select(
        "lang", "a", F.explode(F.transform(F.sequence(F.lit(1), F.col("n") - F.col("k") + 1), lambda i: _words(i, F.col("k")))).alias("phrase"))
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = (best.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < contained * F.col("a")))
            .select("lang", "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), F.col("b.score").alias("score")))
    # A group may hold most phrases: the best of each of its shares first.
    kept = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    order = "ORDER BY score DESC, a DESC, phrase"
    kept = kept.select("*", F.expr(f"row_number() OVER (PARTITION BY lang, salt {order})").alias("k")).where(F.col("k") <= top).drop("salt", "k")
    kept = kept.select("*", F.expr(f"CAST(row_number() OVER (PARTITION BY lang {order}) AS BIGINT)").alias("rank")).where(F.col("rank") <= top)
    totals = grams.where("n = 0").select("lang", F.col("f").alias("n"))
    return kept.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
