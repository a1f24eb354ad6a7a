"""Packing of tokenised documents: dominance reduction, then best fit.

Documents become token ids plus an end id; only those longer than a sequence
are cut. For packing only the count of pieces of each length matters (at most
``capacity`` numbers, whatever the corpus), so the plan is made on counts:

1. Martello-Toth reduction: for the largest remaining length, a small set
   with it that provably dominates every other feasible set is fixed, as many
   times as the counts allow. It looks at sets of up to three pieces.
2. Best-fit decreasing packs what is left: each piece goes to the fullest
   sequence that still holds it.

The plan is a short list of rank ranges per length. A piece's rank among those
of its length is its rank within the map task that made it plus the number in
earlier tasks, so a length that most documents share is ranked by many tasks
and no window ever holds all pieces of a length. The numbers of earlier tasks
are looked up in a small hash table per partition, under task and length packed
into one long; no piece is sorted. Texts are read once and never shuffled;
pieces are checkpointed (the ids themselves only on request).

Defined cases: a null or empty text is the end id alone. Repeated rows are
packed one by one. Pieces of equal length are interchangeable, any of them may
take a place. An empty table gives no rows. Input columns other than the id
and the text are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from ledgerline.llm.shared import prepare

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
#: Words that a worker remembers, in each of two generations.
CACHE_WORDS = 400_000
#: Longer words are rare and encoded anew, so that a cache of them stays small.
CACHE_LETTERS = 40


class _Memory(dict):
    """Cache of a function in two generations, so that its size is bounded.
    With ``letters``, keys of more letters are not kept."""

    def __init__(self, compute, size, letters=None):
        super().__init__()
        self.compute, self.size, self.letters, self.old = compute, size, letters, {}

    def seen(self, key):
        """The value, which is not kept if it is new."""
        value = self.get(key) or self.old.get(key)
        return self.compute(key) if value is None else value

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if self.letters and len(key) > self.letters:
            return value
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def _byte_letters() -> dict[int, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others
    for the letters from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: 0x100 + i for i, b in enumerate(hidden)}


class Encoder:
    """Token ids of texts as little-endian bytes. With ``by_word``, for a
    tokenizer that drops white space, the ids of a text are those of its words
    in turn, and frequent words are encoded once."""

    # Information separators are white space for Python but not for the tokenizer.
    _whole = re.compile(r"[\x1c-\x1f]|<\|")

    def __init__(self, path: str, by_word: bool = True):
        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = by_word
        self.pieces = _Memory(self._piece, CACHE_WORDS, CACHE_LETTERS)
        self.words = _Memory(self._word, CACHE_WORDS, CACHE_LETTERS)
        self.pattern = self._known_form(json.loads(self.tokenizer.to_str()))
        self.shown = _byte_letters()

    @staticmethod
    def _known_form(form: dict):
        """The splitting pattern, if the tokenizer lower-cases, splits by one
        pattern and shows bytes as letters; such words need fewer calls."""
        steps = [n["type"] for n in (form["normalizer"] or {}).get("normalizers", [])]
        splits = (form["pre_tokenizer"] or {}).get("pretokenizers", [])
        if steps == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in splits] == ["Split", "ByteLevel"] and splits[0][
                "behavior"] == "Removed" and splits[0]["invert"] and "Regex" in splits[0]["pattern"] and not (
                splits[1]["use_regex"] or splits[1]["add_prefix_space"]):
            return regex.compile(splits[0]["pattern"]["Regex"])
        return None

    def _plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        return np.array([t.id for t in self.tokenizer.model.tokenize(piece)], dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if self.pattern and max(word) < "\u0250":  # letters that normal form C leaves as they are
            found = self.pattern.findall(word.lower())
            if found == [word] and word.isascii() and word.isprintable():
                return self.pieces.seen(word)  # kept among the words
            if not (word.isascii() and word.isprintable()):
                found = [p.encode().decode("latin-1").translate(self.shown) for p in found]
            return b"".join([self.pieces[p] for p in found])
        normal = self.tokenizer.normalizer.normalize_str(word)
        return b"".join([self.pieces[p] for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)])

    def ids(self, text: str) -> bytes:
        if not self.by_word or self._whole.search(text):
            return self._plain(text)
        return b"".join(map(self.words.__getitem__, text.split()))


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, by_word: bool = True) -> Encoder:
    """The worker's encoder, kept between tasks."""
    if (path, by_word) not in _encoders:
        _encoders[path, by_word] = Encoder(path, by_word)
    return _encoders[path, by_word]


def pieces(docs: DataFrame, *, id_col: str, text_col: str, capacity: int, end_id: int, tokenizer_file: str,
           by_word: bool, with_ids: bool) -> DataFrame:
    """One row per piece, with the task that made it and its rank among the
    pieces of that task and length; and one per task and length, with piece -1
    and the number of such pieces as rank."""
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = src.schema["id"].dataType
    schema = T.StructType([T.StructField("id", kind)]).add("piece", "integer").add("start", "long").add("length", "long").add(
        "ids_crc32", "long").add("task", "integer").add("rank", "long")
    if with_ids:
        schema = schema.add("ids", "binary")
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        enc, task, seen = encoder(tokenizer_file, by_word), TaskContext.get().partitionId(), Counter()

        def table(ids, out):
            cols = list(zip(*out)) if out else [()] * 7
            arrays = [ids] + [
                pa.array(c, t) for c, t in zip(cols, [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()])]
            names = ["id", "piece", "start", "length", "ids_crc32", "task", "rank"]
            if with_ids:
                arrays.append(pa.array(cols[6], pa.binary()))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for b in batches:
            out, take = [], []
            for row, text in enumerate(b.column(1).to_pylist()):
                ids = enc.ids(text or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    n = len(part) // 4
                    take.append(row)
                    out.append((k, at // 4, n, zlib.crc32(part), task, seen[n], part if with_ids else None))
                    seen[n] += 1
            yield table(b.column(0).take(pa.array(take, pa.int64())), out)
        if seen:
            yield table(pa.nulls(len(seen), b.column(0).type), [(-1, None, n, None, task, c, None) for n, c in seen.items()])

    return src.mapInArrow(run, schema)


class Plan:
    """Places for pieces: ranges of ranks of a length in runs of sequences."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = {n: c for n, c in counts.items() if c > 0}
        self.capacity, self.sequences = capacity, 0
        self.used: Counter = Counter()
        #: (length, first rank, first sequence, pieces per sequence, first offset)
        self.places: list[tuple[int, int, int, int, int]] = []

    def put(self, length: int, how_many: int, sequence: int, each: int, offset: int) -> None:
        self.places.append((length, self.used[length], sequence, each, offset))
        self.used[length] += how_many
        self.left[length] -= how_many
        if not self.left[length]:
            del self.left[length]

    def fix(self, members: list[int]) -> None:
        """As many sequences of just these lengths as the counts allow."""
        need = Counter(members)
        times, offset = min(self.left[n] // c for n, c in need.items()), 0
        for n, c in sorted(need.items(), reverse=True):
            self.put(n, times * c, self.sequences, c, offset)
            offset += n * c
        self.sequences += times


def dominating(left: dict[int, int], order: list[int], j: int, capacity: int) -> list[int] | None:
    """A set with length ``j`` that dominates all others with it, if the
    criterion finds one. ``order``: the lengths left, ascending."""
    def others(n):
        return left[n] - (n == j)

    room, smallest = capacity - j, []
    for n in order:
        smallest += [n] * min(3 - len(smallest), others(n))
        if len(smallest) == 3:
            break
    fits, total = 0, 0
    for n in smallest:
        total += n
        fits += total <= room
    if not fits:
        return [j]
    at = bisect_left(order, room + 1) - 1
    while not others(order[at]):
        at -= 1
    a = order[at]
    if fits == 1 or a == room:
        return [j, a]
    if fits > 2:
        return None
    best, lo, hi = (0, 0, 0), 0, at
    while lo <= hi:  # the pair of the largest sum that fits
        x, y = order[lo], order[hi]
        if x + y > room:
            hi -= 1
        elif not others(x) or lo == hi and others(x) < 2:
            lo += 1
        elif not others(y):
            hi -= 1
        else:
            best = max(best, (x + y, y, x))
            lo += 1
    if a >= best[0]:
        return [j, a]
    with_a = [n for n in order[:bisect_left(order, room - a + 1)] if others(n) - (n == a) > 0]
    if with_a and a + with_a[-1] == best[0]:
        b = with_a[-1]
        above = [n for n in order[bisect_left(order, b + 1):] for _ in range(min(2, others(n)))][:2]
        if len(above) < 2 or sum(above) > room:
            return [j, a, b]
    return None


def reduce(plan: Plan) -> None:
    """Fix dominating sets from the largest length down, until none is found."""
    again = True
    while again:
        again = False
        for j in sorted(plan.left, reverse=True):
            while j in plan.left:
                found = dominating(plan.left, sorted(plan.left), j, plan.capacity)
                if not found:
                    break
                plan.fix(found)
                again = True


def best_fit(plan: Plan) -> None:
    """Best-fit decreasing of what is left; sequences of equal room are kept as
    runs, so the work depends on the number of lengths, not of pieces."""
    rooms: list[int] = []
    runs: dict[int, list[tuple[int, int]]] = {}

    def keep(room, sequence, how_many):
        if how_many and room:
            if room not in runs:
                insort(rooms, room)
            runs.setdefault(room, []).append((sequence, how_many))

    for length in sorted(plan.left, reverse=True):
        while n := plan.left.get(length):
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = plan.capacity // length
                room, sequence, how_many = plan.capacity, plan.sequences, -(-n // each)
                plan.sequences += how_many
            else:
                room = rooms[at]
                sequence, how_many = runs[room].pop()
                if not runs[room]:
                    del runs[room], rooms[at]
                each = room // length
            taken = min(n, how_many * each)
            plan.put(length, taken, sequence, each, plan.capacity - room)
            full, part = divmod(taken, each)
            keep(room - each * length, sequence, full)
            if part:
                keep(room - part * length, sequence + full, 1)
            keep(room, sequence + full + bool(part), how_many - full - bool(part))


def plan_for(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    plan = Plan(counts, capacity)
    reduce(plan)
    best_fit(plan)
    return plan


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 0,
         tokenizer_file: str | None = None, by_word: bool = True, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id,
    offset (and the ids as little-endian bytes if asked for)."""
    spark = prepare(docs.sparkSession)
    made = pieces(docs, id_col=id_col, text_col=text_col, capacity=capacity, end_id=end_id, with_ids=with_ids,
                  tokenizer_file=tokenizer_file or public_tokenizers.path(TOKENIZER), by_word=by_word).checkpoint()
    per_task = made.where("piece < 0").withColumnRenamed("rank", "n")
    key = (F.col("task").cast("long") * (capacity + 1) + F.col("length")).alias("key")
    before = per_task.withColumn("before", F.sum("n").over(
        Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))).select(
        key, F.coalesce("before", F.lit(0)).alias("before")).hint("shuffle_hash")
    counts = {r.length: r.n for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    places = sorted(plan_for(counts, capacity).places)
    table = spark.sparkContext.broadcast(np.array(places, dtype=np.int64).reshape(-1, 5))
    ranked = made.where("piece >= 0").withColumn("key", key).join(before, "key").withColumn("rank", F.col("rank") + F.col("before"))
    ranked = ranked.select("id", "piece", "start", "length", "ids_crc32", "rank", *(["ids"] if with_ids else []))
    schema = T.StructType([f for f in ranked.schema if f.name not in ("rank", "ids")]).add("sequence_id", "long").add("offset", "long")
    if with_ids:
        schema = schema.add("ids", "binary")

    def run(batches):
        p = table.value
        keys = (p[:, 0] << 40) + p[:, 1]
        for b in batches:
            length, rank = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 5))
            row = p[np.searchsorted(keys, (length << 40) + rank, side="right") - 1]
            i = rank - row[:, 1]
            sequence, offset = row[:, 2] + i // row[:, 3], row[:, 4] + i % row[:, 3] * length
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset), *b.columns[6:]], names=schema.names)

    return ranked.mapInArrow(run, schema).withColumnRenamed("id", id_col)
