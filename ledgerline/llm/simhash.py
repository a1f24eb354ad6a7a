"""SimHash fingerprints and near-duplicate groups by BK-trees over shards.

Fingerprint: A-Z lower-cased, words split at ASCII white space, shingles of
``shingle`` words (repeats included; a shorter text is one shingle), hashed by
XXH64 with seed 42. Bit b is set when it is set in more than half the hashes.

Groups: fingerprints within ``radius`` bits are linked; a group is a connected
component of links. Work is done on distinct fingerprints, so copies cost one
row each. With ``radius + 2`` blocks of bits, two linked fingerprints agree on
at least two whole blocks, so they meet in the shard of that pair of blocks.
Each shard gets one BK-tree (children keyed by the Hamming distance to their
parent); a search follows only the edges within the radius. A shard larger
than ``shard_size`` is split again by pairs of blocks of its free bits, which
bounds it by the number of values of what is then still free (2**16 for radius
2) and loses no link. The trees are built in the task that the shard is dealt
to, not broadcast: all trees together are as large as the corpus. Inside a
shard a union-find turns links into one edge per fingerprint, never all pairs.
Components of these edges come from alternating large-star and small-star
steps, each cut by a checkpoint.

Defined cases: a null or empty text has fingerprint zero, which is linked like
any other. A null id is no candidate for a component id; a group of null ids
only has a null one. Repeated rows share a fingerprint. Ties cannot occur: the
smallest id names the group. Extra columns are carried by ``deduplicate`` and
ignored by ``near_duplicates``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shared import annotate, as_bytes, prepare

SHINGLE = 3
RADIUS = 2
SEED = 42
SHARD_SIZE = 4096
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of one text."""
    w = as_bytes(text).lower().split()
    if not w:
        return 0
    if len(w) < shingle:
        grams = [b" ".join(w)]
    else:
        grams = list(map(b" ".join, zip(*(w[i:] for i in range(shingle)))))
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(grams), _CHUNK):
        h = np.array([digest(g, SEED) for g in grams[at:at + _CHUNK]], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(grams), bitorder="little").view("<u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def with_fingerprint(docs: DataFrame, text_col: str, name: str, shingle: int, keep=None) -> DataFrame:
    def make():
        return lambda texts: [(_signed(fingerprint(t, shingle)),) for t in texts]

    return annotate(docs, text_col, f"{name} long", make, keep)


class BKTree:
    """Burkhard-Keller tree over integers with the Hamming distance."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def search(self, x: int, radius: int) -> list[int]:
        """Positions of the values within ``radius`` of ``x``."""
        found, todo = [], [0] if self.values else []
        while todo:
            i = todo.pop()
            d = (self.values[i] ^ x).bit_count()
            if d <= radius:
                found.append(i)
            for edge, child in self.children[i].items():
                if d - radius <= edge <= d + radius:
                    todo.append(child)
        return found

    def add(self, x: int) -> int:
        """Insert a value that is not in the tree yet; its position."""
        at = len(self.values)
        if at:
            i = 0
            while True:
                d = (self.values[i] ^ x).bit_count()
                nxt = self.children[i].get(d)
                if nxt is None:
                    self.children[i][d] = at
                    break
                i = nxt
        self.values.append(x)
        self.children.append({})
        return at


def shard_edges(values: list[int], radius: int) -> list[tuple[int, int]]:
    """(value, smallest value of its group) for the linked values of a shard;
    ``values`` are distinct."""
    tree, parent = BKTree(), []

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for x in sorted(values):  # ascending: the root of a group is its smallest value
        near = tree.search(x, radius)
        parent.append(tree.add(x))
        for j in near:
            a, b = sorted((root(j), root(len(parent) - 1)))
            parent[b] = a
    return [(x, tree.values[root(i)]) for i, x in enumerate(tree.values) if root(i) != i]


def _pair_masks(bits: list[int], blocks: int) -> list[int]:
    """Masks of all pairs of ``blocks`` nearly equal runs of the given bits."""
    runs = [sum(1 << int(b) for b in part) for part in np.array_split(bits, blocks)]
    return [a | b for a, b in combinations(runs, 2)]


def _bits_of(mask: int) -> list[int]:
    return [b for b in range(64) if not mask >> b & 1]


def _keyed(df: DataFrame, masks: list[int]) -> DataFrame:
    """One row per mask: its number and the bits of ``fp`` under it."""
    keys = F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                     for i, m in enumerate(masks)])
    return df.select("*", F.explode(keys).alias("k")).select(*df.columns, "k.mask", "k.key")


def links(fps: DataFrame, radius: int, shard_size: int = SHARD_SIZE) -> DataFrame:
    """(fp, other): edges that connect exactly the fingerprints (column ``fp``,
    distinct) that links within ``radius`` bits connect."""
    masks = _pair_masks(list(range(64)), radius + 2)
    first = _keyed(fps.select("fp"), masks)
    sizes = first.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1").checkpoint()
    shards = first.join(sizes, ["mask", "key"])
    small = shards.where(F.col("n") <= shard_size).select("mask", "key", F.lit(-1).alias("mask2"),
                                                          F.lit(0).cast("long").alias("key2"), "fp")
    second = None
    for i, m in enumerate(masks):
        part = _keyed(shards.where((F.col("n") > shard_size) & (F.col("mask") == i))
                      .select(F.col("mask").alias("m1"), F.col("key").alias("k1"), "fp"),
                      _pair_masks(_bits_of(m), radius + 2))
        part = part.select(F.col("m1").alias("mask"), F.col("k1").alias("key"), F.col("mask").alias("mask2"),
                           F.col("key").alias("key2"), "fp")
        second = part if second is None else second.unionByName(part)
    by = ["mask", "key", "mask2", "key2"]
    dealt = (small.unionByName(second) if _any_large(sizes, shard_size) else small).repartition(*by).sortWithinPartitions(*by)

    def run(batches):
        current, values = None, []

        def flush():
            if len(values) > 1:
                pairs = shard_edges([v & (1 << 64) - 1 for v in values], radius)
                if pairs:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([_signed(p[i]) for p in pairs], pa.int64()) for i in (0, 1)], names=["fp", "other"])

        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(5)]
            for *shard, fp in zip(*cols):
                if shard != current:
                    yield from flush()
                    current, values = shard, []
                values.append(fp)
        yield from flush()

    return dealt.mapInArrow(run, "fp long, other long").distinct()


def _any_large(sizes: DataFrame, shard_size: int) -> bool:
    return sizes.where(F.col("n") > shard_size).limit(1).count() > 0


def components(edges: DataFrame) -> DataFrame:
    """(v, root): the smallest node of each connected component, for every node
    that has an edge and is not that smallest node. Large-star and small-star
    steps in turn until nothing changes, in as many rounds as that takes."""
    e = edges.select(F.greatest("fp", "other").alias("u"), F.least("fp", "other").alias("v")).where("u != v").distinct().checkpoint()
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = small.checkpoint()
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return e.select("u", F.col("v").alias("root"))
        mark = now


def _groups(narrow: DataFrame, radius: int, shard_size: int) -> DataFrame:
    """(fp, root, component_id) for each distinct fingerprint of (id, fp) rows."""
    fps = narrow.groupBy("fp").agg(F.min("id").alias("least_id")).checkpoint()
    star = components(links(fps, radius, shard_size))
    rooted = fps.join(star, fps.fp == star.u, "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    low = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rooted.join(low, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, shard_size: int = SHARD_SIZE) -> DataFrame:
    """(id, fingerprint, component_id), one row per document row."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("__text"))
    narrow = with_fingerprint(rows, "__text", "fp", shingle, keep=["id"]).checkpoint()
    return (narrow.join(_groups(narrow, radius, shard_size).drop("root"), "fp", "left")
            .select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                radius: int = RADIUS, shard_size: int = SHARD_SIZE) -> DataFrame:
    """``docs`` with one row of each group: the one with the group's smallest
    id (of repeated rows with that id, one). A group of null ids keeps one row
    of its smallest fingerprint."""
    prepare(docs.sparkSession)
    marked = with_fingerprint(docs, text_col, "__fp", shingle)
    narrow = marked.select(F.col(f"`{id_col}`").alias("id"), F.col("__fp").alias("fp")).checkpoint()
    groups = _groups(narrow, radius, shard_size)
    # One (fingerprint, id) per group: the smallest id, then the smallest fingerprint that carries it.
    stay = (narrow.distinct().join(groups, "fp").where(F.col("id").eqNullSafe(F.col("component_id")))
            .groupBy("root").agg(F.min(F.struct("fp", "id")).alias("s")).select("s.fp", "s.id"))

    def key(of, fp, i):  # plain keys, so that the join and the dropping of repeated rows share one exchange
        return of.withColumns({"__k1": F.col(fp), "__k2": F.coalesce(F.col(i).cast("string"), F.lit("")), "__k3": F.col(i).isNull()})

    keys = ["__k1", "__k2", "__k3"]
    kept = key(marked, "__fp", f"`{id_col}`").join(key(stay, "fp", "id").select(*keys), keys, "left_semi")
    return kept.dropDuplicates(keys).select(*[F.col(f"`{c}`") for c in docs.columns])
