"""WARC fixity audit with Merkle trees over ordered offset ranges.

Every record of an archive has an offset, a length and a SHA-256 digest. A
leaf of the tree is a range of ``RANGE`` bytes of the archive; it hashes, in
order of offset, the records that begin in it. A node above hashes the
``FANOUT`` ranges below it, up to one root per archive. Two replicas whose
roots agree are equal. Where roots differ, the audit goes down level by level
and compares only the children of nodes that differ, then the records of the
differing ranges, which locates each damaged record.

Scale: payloads are hashed where they are read; only (archive, offset, length,
digest) rows move. A range holds at most ``RANGE`` / (least record length)
records and a node ``FANOUT`` children, so no group grows with an archive. Each
level is one grouping by (archive, range); each step down is a semi-join with
the few nodes that differ. There is no Python on the way.

Defined cases: a null payload counts as empty. Records that are the same in
archive, offset and content count once. Two records at one offset are ordered
by length and digest. An archive that only one replica has differs at its
root, all its records are reported. Empty replicas give no rows. Columns other
than the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.shared import prepare

RANGE = 65_536
FANOUT = 16
LEVELS = 4
ARCHIVE_PAGES = 64
MAX_RECORDS = 4096


def record_text(page_id: Column, url: Column, html: Column) -> Column:
    """The bytes of a WARC response record, as text."""
    body = F.coalesce(html, F.lit(""))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")),
                    F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head, body, F.lit("\r\n\r\n"))


def archives(pages: DataFrame, html: Column | None = None) -> DataFrame:
    """(archive, volume, record, offset, length, digest): pages written one
    after the other, ``ARCHIVE_PAGES`` ids to an archive, by id and digest.

    ``html``: what the records hold in place of the pages' own html (for the
    copy of a replica); the offsets are those of the given html. Pages without
    an id are dealt by content. A range of ids with over ``MAX_RECORDS``
    records is dealt to volumes by content, so that none grows without bound.
    Repeated rows are one record with as many copies behind each other; they
    count once, with their total length."""
    text = record_text(F.col("page_id"), F.col("url"), F.col("html") if html is None else html)
    narrow = pages.select(F.col("page_id").alias("record"), F.sha2(text, 256).alias("digest"), F.octet_length(text).cast("long").alias("one"))
    narrow = narrow.groupBy("record", "digest", "one").agg(F.count("*").alias("copies"))
    by_content = F.conv(F.substring("digest", 1, 12), 16, 10).cast("long")
    narrow = narrow.withColumn("archive", F.coalesce(F.floor(F.col("record") / ARCHIVE_PAGES).cast("long"), -1 - by_content))
    large = (narrow.groupBy("archive").agg(F.count("*").alias("n")).where(F.col("n") > MAX_RECORDS)
             .select("archive", F.ceil(F.col("n") / MAX_RECORDS).alias("volumes")))
    narrow = narrow.join(large, "archive", "left").withColumn("volume", F.pmod(by_content, F.coalesce("volumes", F.lit(1))))
    before = Window.partitionBy("archive", "volume").orderBy("record", "digest").rowsBetween(Window.unboundedPreceding, -1)
    length = F.col("one") * F.col("copies")
    return narrow.select("archive", "volume", "record", F.coalesce(F.sum(length).over(before), F.lit(0)).alias("offset"),
                         length.alias("length"), "digest")


def _levels(*replicas: DataFrame) -> int:
    """Levels above the ranges, so that one node spans any archive."""
    most = max((r.agg(F.max(F.col("offset"))).first()[0] or 0) for r in replicas)
    levels = LEVELS
    while most >= RANGE * FANOUT ** levels:
        levels += 1
    return levels


def tree(records: DataFrame, levels: int) -> list[DataFrame]:
    """The nodes of each level, from ranges up: (archive, volume, node, hash)."""
    key = ["archive", "volume"]
    row = F.struct("offset", "length", "digest")
    ranges = (records.groupBy(*key, F.floor(F.col("offset") / RANGE).alias("node"))
              .agg(F.array_sort(F.collect_set(row)).alias("rows"))
              .select(*key, "node", F.sha2(F.array_join(F.transform("rows", lambda r: F.concat_ws(":", r["offset"], r["length"], r["digest"])), ";"), 256).alias("hash")))
    out = [ranges.checkpoint()]
    for _ in range(levels):
        up = (out[-1].groupBy(*key, F.floor(F.col("node") / FANOUT).alias("up"))
              .agg(F.array_sort(F.collect_list(F.struct("node", "hash"))).alias("rows"))
              .select(*key, F.col("up").alias("node"),
                      F.sha2(F.array_join(F.transform("rows", lambda r: F.concat_ws(":", r["node"], r["hash"])), ";"), 256).alias("hash")))
        out.append(up.checkpoint())  # read twice by the comparison and by the level above
    return out


def _compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes of both replicas side by side, with ``differs``."""
    key = ["archive", "volume", "node"]
    both = a.withColumnRenamed("hash", "hash_a").join(b.withColumnRenamed("hash", "hash_b"), key, "full")
    return both.withColumn("differs", ~F.col("hash_a").eqNullSafe(F.col("hash_b")))


def audit(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(archives, damage) of two replicas' records.

    archives: archive, volume, root_a, root_b, same, nodes_compared. damage:
    archive, volume, offset, length, record, kind (altered; missing: only in
    a; extra: only in b) for each record that differs."""
    prepare(a.sparkSession)
    key = ["archive", "volume"]
    a, b = (r.select(*key, "record", "offset", "length", "digest").distinct().checkpoint() for r in (a, b))
    levels = _levels(a, b)
    tree_a, tree_b = tree(a, levels), tree(b, levels)
    roots = _compare(tree_a[-1], tree_b[-1]).checkpoint()
    compared = roots.select(*key, F.lit(1).cast("long").alias("n"))
    at = roots.where("differs").select(*key, "node")
    for below_a, below_b in zip(tree_a[-2::-1], tree_b[-2::-1]):
        up = at.select(*key, F.col("node").alias("up"))
        # Only the children of nodes that differ go on.
        kids = [x.withColumn("up", F.floor(F.col("node") / FANOUT)).join(up, [*key, "up"], "left_semi").drop("up") for x in (below_a, below_b)]
        found = _compare(*kids).checkpoint()
        compared = compared.unionByName(found.groupBy(*key).agg(F.count("*").alias("n")))
        at = found.where("differs").select(*key, "node")
    inside = [r.withColumn("node", F.floor(F.col("offset") / RANGE)).join(at, [*key, "node"], "left_semi").drop("node") for r in (a, b)]
    record = [*key, "offset"]
    side = [x.groupBy(*record).agg(F.array_sort(F.collect_set(F.struct("length", "digest", "record"))).alias(f"rows_{n}")) for n, x in zip("ab", inside)]
    both = side[0].join(side[1], record, "full").where(~F.col("rows_a").eqNullSafe(F.col("rows_b")))
    one = F.coalesce("rows_a", "rows_b")[0]
    damage = both.select(*record, one["length"].alias("length"), one["record"].alias("record"),
                         F.when(F.col("rows_b").isNull(), "missing").when(F.col("rows_a").isNull(), "extra").otherwise("altered").alias("kind"))
    steps = compared.groupBy(*key).agg(F.sum("n").alias("nodes_compared"))
    heads = roots.select(*key, F.col("hash_a").alias("root_a"), F.col("hash_b").alias("root_b"), (~F.col("differs")).alias("same"))
    return heads.join(steps, key), damage


def audit_report(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row per archive with its damage, "record@offset+length:kind" by
    offset, comma-joined (empty if none). A volume has at most
    ``MAX_RECORDS`` records, which bounds the list."""
    key = ["archive", "volume"]
    heads, damage = audit(a, b)
    line = F.concat(F.coalesce(F.col("record").cast("string"), F.lit("none")), F.lit("@"), F.col("offset"), F.lit("+"), F.col("length"), F.lit(":"), F.col("kind"))
    listed = (damage.groupBy(*key).agg(F.count("*").alias("n_damaged"), F.array_sort(F.collect_list(F.struct("offset", line.alias("line")))).alias("rows"))
              .select(*key, "n_damaged", F.array_join(F.transform("rows", lambda r: r["line"]), ",").alias("damaged")))
    return (heads.join(listed, key, "left")
            .select(*key, "root_a", "root_b", "same", "nodes_compared", F.coalesce("n_damaged", F.lit(0)).alias("n_damaged"),
                    F.coalesce("damaged", F.lit("")).alias("damaged")))
