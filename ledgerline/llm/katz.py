"""Language-model scoring: Katz backoff over bigrams.

P(w | h) is the Good-Turing discounted share of ``h w`` among the training
bigrams after ``h`` if there are any, else the backoff weight of ``h`` times
P(w); P(w) is the discounted share of ``w`` among the training tokens, and the
mass the discounts free belongs to the unknown word. The weight of ``h`` is
(1 - sum of its seen P(w | h)) / (1 - sum of P(w) over the words seen after
it), so each distribution adds up to 1 exactly. A history without any
discounted bigram reserves one pseudo-count, so that its weight is not 0.

All counts cover the whole training corpus. Work flows in blocks: documents
are cut into chunks of about ``CHUNK_TOKENS`` tokens; a chunk's distinct words
or bigrams are dealt to partitions as compressed arrays, where the counts of
all chunks meet. Three exchanges:

1. words, by word: counts of each word, sent back to the chunks that hold it;
2. bigrams, by history (but for histories of one chunk only): the partitioned
   table of bigram counts, its sums per history, and for each document the sums
   of its bigrams in that partition;
3. those sums, by chunk: one row per document.

Counting adds up within a chunk first, so a word or pair that a third of all
documents share arrives once per chunk. A history of more than ``SPLIT``
tokens (or a millionth of all) is split by its next word over several
partitions and its sums meet in a table of at most a million rows. A pair that
makes up ``HOT_PAIR`` of the tokens of some chunk is kept with its documents
and looked up in a broadcast table of at most 2 / ``HOT_PAIR`` rows, so its
documents do not meet in one partition.

Words are identified by 64-bit hashes; next words by 32 bits of a hash within
a history of under ``SHORT_KEY`` tokens, else by 64.

Defined cases: a null or empty text is the end token alone. A null id is like
any other id; whether a row trains is said by ``held_out`` (null: held out).
Repeated rows count and are scored each time. Without training rows every
token is the unknown word of probability 1. Columns other than the id, the
flag and the text are ignored. Chunks depend only on the order of rows in
their input split, so a lost task makes the same ones again.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.shared import as_bytes, prepare

CHUNK_TOKENS = 2_500_000
BUCKET_ENTRIES = 2_200_000
SPLIT = 250_000
SHORT_KEY = 20_000
HOT_PAIR = 1e-4
TOP = 5  # counts up to this are discounted

_END, _START = b" ", b"\x00 "  # no words, as they hold a blank


#: Arrays of small numbers, which compress better byte by byte of their width.
_BY_BYTE = {"tokens", "cw", "ch", "ct", "entries", "doc", "times"}


def _pack(**arrays) -> bytes:
    for name in _BY_BYTE & arrays.keys():
        x = np.ascontiguousarray(arrays[name])
        arrays[name] = (x.dtype.str, np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T))
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(arrays, 5))


def _unpack(data) -> dict:
    arrays = pickle.loads(zstandard.ZstdDecompressor().decompress(bytes(data)))
    for name in _BY_BYTE & arrays.keys():
        kind, planes = arrays[name]
        arrays[name] = np.ascontiguousarray(planes.T).view(kind).reshape(-1)
    return arrays


def _hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 42)


def _mix(*parts) -> np.ndarray:
    """64-bit mix of arrays of numbers (the finaliser of splitmix64)."""
    x = np.uint64(0)
    with np.errstate(over="ignore"):
        for p in parts:
            x = x + np.asarray(p, np.uint64) + np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x = x ^ (x >> np.uint64(31))
    return x


START_HASH = np.uint64(_hash(_START))


def _ratios(n) -> list[float]:
    """Katz's ratios (r*/r - share) / (1 - share) of the counts 1 to ``TOP``,
    with r* = (r + 1) n[r + 1] / n[r]; 0 where undefined."""
    share = (TOP + 1) * n[TOP + 1] / n[1] if n[1] else 1.0
    return [((r + 1) * n[r + 1] / n[r] / r - share) / (1 - share) if n[r] and share < 1 else 0.0 for r in range(1, TOP + 1)]


def _smoothed(n) -> list[float] | None:
    """n by a line through log n[r] over log r, as in Simple Good-Turing (each
    n[r] averaged over the gap to its neighbours that are not 0); None if the
    line does not fall faster than 1 / r, so that it gives no discounts."""
    r = [i for i in range(1, TOP + 2) if n[i] > 0]
    if len(r) < 2:
        return None
    after = [*r[1:], 2 * r[-1] - r[-2]]
    z = [2 * n[i] / (b - a) for i, a, b in zip(r, [0, *r[:-1]], after)]
    slope, level = np.polyfit(np.log(r), np.log(z), 1)
    return [0.0, *(float(np.exp(level + slope * np.log(i))) for i in range(1, TOP + 2))] if slope < -1 else None


def discounts(counts_of_counts) -> list[float]:
    """Katz's discount ratios of the counts 0 to ``TOP`` from the numbers of
    types of each count (index 1 to ``TOP`` + 1). Each count keeps its own
    Good-Turing ratio where that lies between 0 and 1. Where it does not, as
    groups of copies make bumps in those numbers, this count alone takes the
    ratio of the smoothed numbers, which is always in range. Only where these
    give none either (fewer than two counts occur, or the numbers hardly fall)
    an absolute discount estimated from the first two numbers stands in."""
    n = [float(x) for x in counts_of_counts]
    cut = min(0.9, max(0.1, n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5))
    line = _smoothed(n)
    spare = _ratios(line) if line else [(r - cut) / r for r in range(1, TOP + 1)]
    return [1.0, *[x if 0 < x < 1 else y for x, y in zip(_ratios(n), spare)]]


class Unigrams:
    """Discounted word probabilities from a count."""

    def __init__(self, tokens: int, types: int, counts_of_counts):
        self.tokens, self.types = tokens, types
        self.d = np.array(discounts(counts_of_counts))
        kept = sum(self.d[r] * r * counts_of_counts[r] for r in range(1, TOP + 1)) + (
            tokens - sum(r * counts_of_counts[r] for r in range(1, TOP + 1)))
        self.total = tokens if kept < tokens else tokens + 1
        self.unknown = 1.0 if not tokens else 1 - kept / self.total

    def p(self, count: np.ndarray) -> np.ndarray:
        c = np.asarray(count, float)
        d = self.d[np.minimum(np.asarray(count, np.int64), TOP)]
        d = np.where(c > TOP, 1.0, d)
        return np.where(c > 0, d * c / max(self.total, 1), self.unknown)


# ---- chunks ----

class _Numbers(dict):
    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def _source(docs: DataFrame, id_col: str, text_col: str, held_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{held_col}`"), F.lit(True)), F.col(f"`{text_col}`").cast("string"))


def _chunks(batches):
    """(chunk, arrays): the documents of a task in chunks of tokens: tokens as
    numbers of the chunk's words, and the documents' ids, flags and lengths."""
    task, seq = TaskContext.get().partitionId(), 0
    number, tokens, lengths, held, ids, size = _Numbers({_END: 0}), [], [], [], [], 0

    def chunk():
        words = np.fromiter(map(_hash, number), np.uint64, len(number))
        table = pa.Table.from_arrays([pa.chunked_array(ids)], names=["id"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as w:
            w.write_table(table)
        return (task << 24) + seq, {"words": words, "tokens": np.concatenate(tokens), "lengths": np.array(lengths, np.int64),
                                    "held": np.array(held, bool), "ids": sink.getvalue().to_pybytes()}

    for b in batches:
        first = 0
        flags = b.column(1).to_pylist()
        for i, text in enumerate(b.column(2).to_pylist()):
            w = as_bytes(text).lower().split()
            w.append(_END)
            tokens.append(np.fromiter(map(number.__getitem__, w), np.uint32, len(w)))
            lengths.append(len(w))
            held.append(flags[i])
            size += len(w)
            if size >= CHUNK_TOKENS:
                ids.append(b.column(0).slice(first, i + 1 - first))
                yield chunk()
                number, tokens, lengths, held, ids, size, first, seq = _Numbers({_END: 0}), [], [], [], [], 0, i + 1, seq + 1
        if first < b.num_rows:
            ids.append(b.column(0).slice(first))
    if lengths:
        yield chunk()


def _sent_chunks(src: DataFrame) -> DataFrame:
    """(chunk, bucket, payload) with bucket -1."""
    def run(batches):
        for chunk, u in _chunks(batches):
            yield _row(-1, chunk, _pack(**u))

    return src.mapInArrow(run, "bucket long, chunk long, payload binary").select("chunk", "bucket", "payload")


def _by_bucket(bucket: np.ndarray):
    """(bucket, positions) for each bucket present, positions ascending."""
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    for b, a, z in zip(found.tolist(), first, [*first[1:], len(order)]):
        yield b, order[a:z]


def _pairs(u: dict):
    """Starts of documents, and for each token the number of its bigram, which
    is history * (words + 1) + word; the history after the last word's number
    is the start of a document."""
    start = np.concatenate(([0], np.cumsum(u["lengths"])[:-1]))
    n = len(u["words"])
    key = np.empty(len(u["tokens"]), np.int64)
    key[1:] = u["tokens"][:-1]
    key[start] = n
    key *= n + 1
    key += u["tokens"]
    return start, key


def _kinds(key: np.ndarray):
    """(distinct values, position of each value among them), like np.unique,
    with 32-bit positions and little memory."""
    order = np.argsort(key, kind="stable")
    new = np.ones(len(key), bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    kind = np.empty(len(key), np.int32)
    kind[order] = np.cumsum(new, dtype=np.int32) - 1
    return key[order[new]], kind


def _runs(batches, width: int):
    """Rows of sorted batches, grouped by their first column."""
    key, rows = None, []
    for b in batches:
        for row in zip(*[b.column(i).to_pylist() for i in range(width)]):
            if rows and row[0] != key:
                yield key, rows
                rows = []
            key = row[0]
            rows.append(row)
    if rows:
        yield key, rows


def _dealt(df: DataFrame, number: int, key: str, *then: str) -> DataFrame:
    return df.repartition(number, key).sortWithinPartitions(key, *then)


# ---- words ----

#: Kinds of rows: counts sent back to a chunk, numbers about the words, a pair that is frequent in some chunk.
REPLY, NUMBERS, PAIR = 0, 1, 2


def _word_counts(src: DataFrame, buckets: int, partitions: int) -> DataFrame:
    """(kind, chunk, bucket, payload, numbers): replies, numbers and pairs."""
    def ask(batches):
        for chunk, u in _chunks(batches):
            train = np.repeat(~u["held"], u["lengths"])
            counts = np.bincount(u["tokens"][train], minlength=len(u["words"]))
            every = np.bincount(u["tokens"], minlength=len(u["words"]))
            rows = [(k, chunk, 0, _pack(w=u["words"][at], c=counts[at].astype(np.uint32), a=every[at].astype(np.uint32)))
                    for k, at in _by_bucket(u["words"] % np.uint64(buckets))]
            key = _pairs(u)[1][train]
            key.sort()
            first = np.flatnonzero(np.concatenate((np.ones(min(len(key), 1), bool), key[1:] != key[:-1])))
            n = np.diff(np.append(first, len(key)))
            often = n >= max(2, HOT_PAIR * len(train))
            if often.any():
                names = np.append(u["words"], START_HASH)
                h, w = (names[x] for x in np.divmod(key[first[often]], len(names)))
                rows += [(k, chunk, 1, _pack(h=h[at], w=w[at], c=n[often][at])) for k, at in _by_bucket(_mix(h, w) % np.uint64(buckets))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int64(), pa.int32(), pa.binary()])],
                                             names=["bucket", "chunk", "pairs", "payload"])

    def answer(batches):
        for bucket, rows in _runs(batches, 4):
            asked = [(chunk, _unpack(data)) for _, chunk, pairs, data in rows if not pairs]
            out = []
            if asked:
                words, place = np.unique(np.concatenate([a["w"] for _, a in asked]), return_inverse=True)
                total, every = (np.bincount(place, np.concatenate([a[x] for _, a in asked]), len(words)).astype(np.int64) for x in "ca")
                at = 0
                for chunk, a in asked:
                    own = place[at:at + len(a["w"])]
                    out.append((REPLY, chunk, bucket, _pack(c=total[own].astype(np.uint32 if total.max() < 1 << 32 else np.int64),
                                                            only=np.packbits(every[own] == a["a"])), None))
                    at += len(a["w"])
                low = np.bincount(total[total <= TOP + 1], minlength=TOP + 2)
                out.append((NUMBERS, 0, bucket, None, [int(total.sum()), int((total > 0).sum()), *low[1:TOP + 2].tolist()]))
            if len(asked) < len(rows):
                found = [_unpack(data) for _, _, pairs, data in rows if pairs]
                both = np.stack([np.concatenate([f[x] for f in found]) for x in "hw"])
                kinds, place = np.unique(both, axis=1, return_inverse=True)
                n = np.bincount(place.ravel(), np.concatenate([f["c"] for f in found])).astype(np.int64)
                out += [(PAIR, 0, bucket, None, [int(c), *x]) for c, x in zip(n, kinds.astype(np.int64).T.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [
                pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())])], names=["kind", "chunk", "bucket", "payload", "numbers"])

    asked = src.mapInArrow(ask, "bucket long, chunk long, pairs int, payload binary")
    return _dealt(asked, partitions, "bucket").mapInArrow(answer, "kind int, chunk long, bucket long, payload binary, numbers array<long>")


# ---- bigrams ----

def _split_bound(tokens: int) -> int:
    return max(SPLIT, tokens // 1_000_000)


def _bigrams(src: DataFrame, replies: DataFrame, words: Unigrams, train_docs: int, hot, buckets: int, buckets2: int, partitions: int) -> DataFrame:
    """(bucket, chunk, payload): each chunk's bigrams by history bucket, and
    under a negative bucket the sums of its documents."""
    n, v, bound = words.tokens, words.types, _split_bound(words.tokens)

    def run(batches):
        hot_keys = hot.value
        for chunk, rows in _runs(batches, 3):
            u = _unpack(rows[0][2])
            names = np.append(u["words"], START_HASH)
            nv = len(u["words"])
            counts, only = np.zeros(nv + 1, np.int64), np.zeros(nv + 1, bool)
            places = dict(_by_bucket(u["words"] % np.uint64(buckets)))
            for _, bucket, data in rows[1:]:
                at, reply = places[bucket], _unpack(data)
                counts[at], only[at] = reply["c"], np.unpackbits(reply["only"], count=len(at)).astype(bool)
            c = counts[u["tokens"]]
            start, key = _pairs(u)
            sums = {"base": np.add.reduceat(np.log10((c + 1) / (n + v + 1)), start), "known": np.add.reduceat((c > 0).astype(np.int64), start)}
            del c
            counts[nv] = train_docs
            keys, kind = _kinds(key)
            h, w = (x.astype(np.int32) for x in np.divmod(keys, nv + 1))
            del key, keys
            train = np.repeat(~u["held"], u["lengths"])
            ct = np.bincount(kind[train], minlength=len(h)).astype(np.uint32)
            entry = kind.astype(np.int64) * len(start)
            entry += np.repeat(np.arange(len(start), dtype=np.int32), u["lengths"])
            del kind, train
            entry.sort()
            first = np.flatnonzero(np.concatenate((np.ones(1, bool), entry[1:] != entry[:-1])))
            times = np.diff(np.append(first, len(entry))).astype(np.uint32)
            entry_kind, entry_doc = (x.astype(np.int32) for x in np.divmod(entry[first], len(start)))
            del entry, first
            name = _mix(names[h], names[w])
            hot_at = np.searchsorted(hot_keys, name)
            is_hot = hot_keys[np.minimum(hot_at, len(hot_keys) - 1)] == name if len(hot_keys) else np.zeros(len(h), bool)
            del name
            e = is_hot[entry_kind]
            documents = _pack(ids=u["ids"], held=u["held"], lengths=u["lengths"], **sums, hot=hot_at[entry_kind[e]], hot_doc=entry_doc[e], hot_n=times[e])
            entries = np.where(is_hot, 0, np.bincount(entry_kind, minlength=len(h)))
            entry_at = np.concatenate(([0], np.cumsum(entries)))
            entry_doc, times = entry_doc[~e].astype(np.uint32), times[~e]
            del entry_kind, e
            ch = counts[h]
            key = _mix(names[w])
            bucket = _mix(names[h], key % (1 + ch // bound).astype(np.uint64)) % np.uint64(buckets2)
            key = np.where(ch < SHORT_KEY, key & np.uint64(0xFFFFFFFF), key)
            small = np.uint32 if n < 1 << 32 else np.int64

            def block(at):
                own = np.repeat(entry_at[at], entries[at]) + _within(entries[at])
                return {"h": names[h[at]], "low": (key[at] & np.uint64(0xFFFFFFFF)).astype(np.uint32), "high": (key[at] >> np.uint64(32)).astype(np.uint32),
                        "cw": counts[w[at]].astype(small), "ch": ch[at].astype(small), "ct": ct[at], "entries": entries[at].astype(np.uint32),
                        "doc": entry_doc[own], "times": times[own], "hot": np.where(is_hot[at], hot_at[at], -1).astype(np.int32)}

            # Histories that occur in this chunk only need no exchange: their sums are complete here.
            alone = np.flatnonzero(only[h])
            local = list(bucket_sums([(chunk, block(alone))], words, bound)) if len(alone) else []
            yield _row(-1 - chunk, chunk, _pack(rows=[(DOCS, chunk, documents, None, None), *local]))
            rest = np.flatnonzero(~only[h])
            for b, at in _by_bucket(bucket[rest]):
                yield _row(b, chunk, _pack(**block(rest[at])))

    sent = _sent_chunks(src).unionByName(replies.select("chunk", "bucket", "payload"))
    return _dealt(sent, partitions, "chunk", "bucket").mapInArrow(run, "bucket long, chunk long, payload binary")


def _row(bucket, chunk, data):
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([chunk], pa.int64()), pa.array([data], pa.binary())],
                                      names=["bucket", "chunk", "payload"])


def _within(n: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each n, one after the other."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


#: Kinds of rows after the second exchange: a chunk's documents, sums of its documents from a bucket, numbers of bigrams of small
#: counts, sums of a split history, count of a hot pair.
DOCS, SUMS, LOW_COUNTS, HISTORY, HOT = 0, 1, 2, 3, 4


def bucket_sums(parts, words: Unigrams, bound: int):
    """Rows of a bucket, which holds all bigrams of its histories (of a split one
    all with some next words): ``parts`` has a block of each chunk."""
    h, low, high, cw, ch, ct, hot = (np.concatenate([p[x] for _, p in parts]) for x in ("h", "low", "high", "cw", "ch", "ct", "hot"))
    for _, p in parts:
        p["n"] = len(p["h"])
        for x in ("h", "low", "high", "cw", "ch", "ct", "hot"):
            del p[x]
    cw, ch = cw.astype(np.int64), ch.astype(np.int64)
    key = high.astype(np.uint64) << np.uint64(32) | low
    order = np.lexsort((key, h))
    new = np.ones(len(order), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (key[order][1:] != key[order][:-1])
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1
    one = order[new]  # a row of each kind of bigram, by history
    total = np.bincount(kind, ct, len(one)).astype(np.int64)
    h, cw, ch, hot = h[one], cw[one], ch[one], hot[one]
    new_h = np.ones(len(one), bool)
    new_h[1:] = h[1:] != h[:-1]
    hist, first = np.cumsum(new_h) - 1, np.flatnonzero(new_h)
    seen = total > 0
    m = np.stack([np.bincount(hist, total == r, len(first)) for r in range(1, TOP + 1)], axis=1).astype(np.int64)
    big = np.bincount(hist, np.where(total > TOP, total, 0), len(first)).astype(np.int64)
    covered = np.bincount(hist, np.where(seen, words.p(cw), 0.0), len(first))
    split = ch[first] >= bound
    # The pseudo-count of a history: split ones always have it, others if no count is discounted.
    total_h = ch[first] + (split | (m.sum(axis=1) == 0))
    yield (LOW_COUNTS, 0, None, np.bincount(total[seen & (total <= TOP + 1)], minlength=TOP + 2).tolist(), None)
    for i in np.flatnonzero(split):
        yield (HISTORY, 0, None, [int(h[first[i]].astype(np.int64)), int(total_h[i]), int(big[i]), *m[i].tolist()], float(covered[i]))
    for i in np.flatnonzero((hot >= 0) & seen):
        yield (HOT, 0, None, [int(hot[i]), int(total[i]), int(total_h[hist[i]])], None)
    with np.errstate(divide="ignore"):
        value = np.where(seen, np.log10(np.maximum(total, 1)) - np.log10(np.maximum(total_h[hist], 1)), np.log10(words.p(cw)))
    at = 0
    for chunk, p in parts:
        k = np.repeat(kind[at:at + p["n"]], p["entries"])
        at += p["n"]
        doc, times = p["doc"].astype(np.int64), p["times"].astype(np.int64)
        if not len(k):
            continue
        docs, place = np.unique(doc, return_inverse=True)
        ratios = [np.bincount(place, np.where(total[k] == r, times, 0), len(docs)).astype(np.uint32) for r in range(1, TOP + 1)]
        back = np.flatnonzero(~seen[k] & (ch[k] > 0))  # tokens that need a backoff weight
        f = hist[k[back]]
        yield (SUMS, chunk, _pack(
            docs=docs.astype(np.uint32), value=np.bincount(place, times * value[k], len(docs)), ratios=ratios,
            back_doc=doc[back].astype(np.uint32), back_n=times[back].astype(np.uint32), history=np.where(split[f], h[k[back]], 0),
            split=split[f], total=total_h[f], big=big[f], m=m[f].astype(np.uint32), covered=covered[f]), None, None)


def _sums(bigrams: DataFrame, words: Unigrams, partitions: int) -> DataFrame:
    """(kind, chunk, payload, numbers, value): see the kinds above."""
    bound = _split_bound(words.tokens)

    def run(batches):
        for bucket, rows in _runs(batches, 3):
            if bucket < 0:
                out = [r for _, _, data in rows for r in _unpack(data)["rows"]]
            else:
                out = bucket_sums([(chunk, _unpack(data)) for _, chunk, data in rows], words, bound)
            for r in out:
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(r, [pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.float64()])],
                                                 names=["kind", "chunk", "payload", "numbers", "value"])

    return _dealt(bigrams, partitions, "bucket", "chunk").mapInArrow(run, "kind int, chunk long, payload binary, numbers array<long>, value double")


def backoff(d: np.ndarray, total, big, m, covered) -> np.ndarray:
    """Backoff weights of histories from their sums; ``d``: discounts."""
    kept = (np.asarray(big, float) + (np.asarray(m, float) * (np.arange(1, TOP + 1) * d[1:])).sum(axis=-1)) / np.maximum(total, 1)
    return np.maximum(1 - kept, 1e-300) / np.maximum(1 - np.asarray(covered, float), 1e-300)


def _final(summed: DataFrame, low_counts, histories, hot_counts, words: Unigrams, schema: T.StructType, partitions: int) -> DataFrame:
    d = np.array(discounts(low_counts))
    log_d = np.log10(d)
    sc = summed.sparkSession.sparkContext
    split_table = sc.broadcast(histories)
    hot_table = sc.broadcast(hot_counts)
    n = words.tokens

    def run(batches):
        split_h, split_weight = split_table.value
        hot_total, hot_history = hot_table.value
        for _, rows in _runs(batches, 3):
            u = _unpack(next(data for _, kind, data in rows if kind == DOCS))
            score = np.zeros(len(u["held"]))
            for data in (data for _, kind, data in rows if kind == SUMS):
                s = _unpack(data)
                score[s["docs"]] += s["value"] + sum(r * log_d[i + 1] for i, r in enumerate(s["ratios"]))
                if len(s["back_doc"]):
                    weight = backoff(d, s["total"], s["big"], s["m"], s["covered"])
                    if s["split"].any():
                        at = np.searchsorted(split_h, s["history"][s["split"]])
                        weight[s["split"]] = split_weight[at]
                    np.add.at(score, s["back_doc"], s["back_n"] * np.log10(weight))
            if len(u["hot"]):
                t = hot_total[u["hot"]]
                value = np.log10(t) - np.log10(hot_history[u["hot"]]) + np.where(t <= TOP, log_d[np.minimum(t, TOP)], 0.0)
                np.add.at(score, u["hot_doc"], u["hot_n"] * value)
            ids = pa.ipc.open_stream(u["ids"]).read_all().column(0).combine_chunks()
            held = u["held"]
            yield pa.RecordBatch.from_arrays([ids if isinstance(ids, pa.Array) else ids.chunk(0), pa.array(held), pa.array(u["lengths"]), pa.array(u["known"]),
                                              pa.array(np.full(len(held), n, np.int64)), pa.array(u["base"]), pa.array(score)], names=schema.names)

    rows = summed.where(F.col("kind").isin(DOCS, SUMS)).select("chunk", "kind", "payload")
    return _dealt(rows, partitions, "chunk", "kind").mapInArrow(run, schema)


def score(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", held_col: str = "held_out") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of
    each row; rows that are not held out train the model."""
    spark = prepare(docs.sparkSession)
    src = _source(docs, id_col, text_col, held_col)
    flag = F.coalesce(F.col(f"`{held_col}`"), F.lit(True))
    size, train_docs = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")) + 6), F.count_if(~flag)).first()
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (size or 0) // (8 * BUCKET_ENTRIES) + 1)
    buckets = buckets2 = partitions
    counted = _word_counts(src, buckets, partitions).checkpoint()
    sums = [r.n for r in counted.where(F.col("kind") == NUMBERS).select(F.posexplode("numbers").alias("i", "x")).groupBy("i")
            .agg(F.sum("x").alias("n")).orderBy("i").collect()] or [0] * (TOP + 3)
    words = Unigrams(sums[0], sums[1], [0, *sums[2:]])
    often = counted.where((F.col("kind") == PAIR) & (F.col("numbers")[0] >= int(HOT_PAIR * words.tokens / 2))).select("numbers").collect()
    pairs = np.array([r.numbers[1:] for r in often], np.int64).reshape(-1, 2).view(np.uint64)
    hot_keys = np.sort(_mix(pairs[:, 0], pairs[:, 1])) if len(pairs) else np.zeros(0, np.uint64)
    replies = counted.where(F.col("kind") == REPLY)
    bigrams = _bigrams(src, replies, words, train_docs, spark.sparkContext.broadcast(hot_keys), buckets, buckets2, partitions)
    summed = _sums(bigrams, words, partitions).checkpoint()
    low = [r.n for r in summed.where(F.col("kind") == LOW_COUNTS).select(F.posexplode("numbers").alias("i", "x")).groupBy("i")
           .agg(F.sum("x").alias("n")).orderBy("i").collect()] or [0] * (TOP + 2)
    d = np.array(discounts(low))
    x = F.col("numbers")
    parts = (summed.where(F.col("kind") == HISTORY).groupBy(x[0].alias("h"), x[1].alias("total"))
             .agg(*[F.sum(x[i + 2]).alias(f"n{i}") for i in range(TOP + 1)], F.sum("value").alias("covered")).toPandas())
    at = np.argsort(parts.h.to_numpy(np.int64).view(np.uint64)) if len(parts) else []
    parts = parts.iloc[at]
    histories = (parts.h.to_numpy(np.int64).view(np.uint64), backoff(
        d, parts.total.to_numpy(float), parts.n0.to_numpy(float), parts[[f"n{i}" for i in range(1, TOP + 1)]].to_numpy(float), parts.covered.to_numpy(float)))
    hot = np.ones((2, max(len(hot_keys), 1)), np.int64)
    for r in summed.where(F.col("kind") == HOT).select("numbers").collect():
        hot[:, r.numbers[0]] = r.numbers[1:]
    schema = T.StructType([docs.select(F.col(f"`{id_col}`")).schema[0]]).add("held_out", "boolean").add("n_tokens", "long").add(
        "n_known", "long").add("train_tokens", "long").add("base_score", "double").add("score", "double")
    return _final(summed, low, histories, hot, words, schema, partitions)
