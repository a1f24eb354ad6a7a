"""CSV feed scan: every column as text, plus the file position of each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import csv as _csv

import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from ledgerline.schemas import ROW_ID, ROW_ORD
from ledgerline.session import workspace_root
from ledgerline.sources import fs


class FeedError(ValueError):
    """The feed cannot be loaded (empty, unreadable, malformed rows, missing columns)."""


def files_of(spark: SparkSession, path: str | list[str]) -> tuple[str | None, int]:
    """(first file by name, greatest length) of the non-empty files of a feed."""
    found = [fs.data_files(spark, p) for p in ([path] if isinstance(path, str) else path)]
    return min((p for p, _, _ in found if p), default=None), max((n for _, n, _ in found), default=0)


def few_files(spark: SparkSession, path: str | list[str]) -> list[tuple[str, int]] | None:
    """(file, length) of the feed's files by path, if the driver may list them."""
    found: list[tuple[str, int]] = []
    todo = [path] if isinstance(path, str) else list(path)
    while todo:
        here = fs.listing(spark, todo.pop())
        if here is None or len(found) + len(todo) + len(here) > fs.FEW:
            return None
        shown = [x for x in here if fs.shown(x[0])]
        found += [(p, n) for p, folder, n in shown if not folder]
        todo += [p for p, folder, _ in shown if folder]
    return sorted(found)


def header_columns(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names from the first file's header line (read on the driver, no
    Spark job). The scan checks that every other file has the same header."""
    if isinstance(path, str) and not fs.exists(spark, path):
        raise FileNotFoundError(path)
    first, _ = files_of(spark, path)
    line = fs.first_line(spark, first) if first else None
    if line is None or not line.strip():
        raise FeedError(f"empty file: {path}")
    try:
        return next(_csv.reader([line.lstrip("\ufeff")]))
    except _csv.Error as e:
        raise FeedError(f"unreadable header in {path}: {e}") from e


def _split_bytes(spark: SparkSession) -> int:
    text = spark.conf.get("spark.sql.files.maxPartitionBytes").lower().rstrip("b")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(text[-1:], 1)
    return int(text.rstrip("kmg")) * unit


def has_quoted_newline(spark: SparkSession, path: str | list[str]) -> bool:
    """Does any line of the feed hold an odd number of quotes, so that a quoted
    field may go on in the next line? (A scan of lines that stops early.)"""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).limit(1).isEmpty()


def spans_lines(spark: SparkSession, path: str | list[str]) -> bool:
    """Must the feed be parsed with an eye to quoted newlines? Only feeds that
    Spark would split are looked at: those that fit one split lose nothing by
    being parsed whole."""
    if files_of(spark, path)[1] <= min(_split_bytes(spark), SMALL_FEED):
        return True
    return has_quoted_newline(spark, path)


#: Files up to this size are parsed whole when they may hold quoted newlines.
SMALL_FEED = 8 << 20


def text_schema(cols: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols]
                        + [T.StructField("_corrupt_record", T.StringType(), True)])


def csv_options(reader, multiline: bool = False):
    return (reader.option("header", True)
                  .option("enforceSchema", False)
                  .option("escape", '"')
                  .option("multiLine", multiline)
                  .option("mode", "PERMISSIVE")
                  .option("columnNameOfCorruptRecord", "_corrupt_record"))


#: A place in a feed: file (10 bits), block of 64 KiB (20 bits), row (33 bits).
_BLOCK, _BLOCKS, _FILES, _ROWS = 1 << 16, 1 << 20, 1 << 9, 1 << 33


def with_position(df: DataFrame, files: list[tuple[str, int]] | None = None) -> DataFrame:
    """Add ``_row_id`` (unique) and ``row_ord``, a total order equal to the order
    of the rows in their files, files by path. With the sorted ``files`` (path
    and length) at hand it is one BIGINT, else, or if the scan reads any other
    file, a struct (file, block, row id)."""
    df = df.withColumn(ROW_ID, F.monotonically_increasing_id())
    block = F.col("_metadata.file_block_start")
    names = [fs.uri_name(df.sparkSession, p) for p, _ in files or []]
    if (names and len(set(names)) == len(names) < _FILES and all(n < _BLOCK * _BLOCKS for _, n in files)
            and {p.rsplit("/", 1)[-1] for p in df.inputFiles()} <= set(names)):
        number = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("_metadata.file_name")) - 1
        place = number * F.lit(_ROWS * _BLOCKS) + F.floor(block / F.lit(_BLOCK)) * F.lit(_ROWS) + F.pmod(F.col(ROW_ID), F.lit(_ROWS))
        return df.withColumn(ROW_ORD, place.cast("bigint"))
    return df.withColumn(ROW_ORD, F.struct(F.col("_metadata.file_path").alias("file"), block.alias("block"), F.col(ROW_ID).alias("pos")))


_FRAGMENT = T.StructType([T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("at", T.LongType()),
                         T.StructField("record", T.StringType()), T.StructField("kind", T.StringType())])


def _records(batches):
    """The records of splits, from their lines in order and whether a split
    begins inside quotes: whole ones; the ``head`` that ends a record of an
    earlier split; the ``tail`` that goes on in a later one; ``inner`` where a
    split has neither a beginning nor an end of the record it lies in."""
    schema = to_arrow_schema(_FRAGMENT)
    key, held, quoted, at, headless, out, size = None, [], False, 0, False, [], 0

    def add(kind):
        nonlocal held, at, size
        record = "\n".join(held)
        out.append((*key, at, record, kind))
        held, at, size = [], at + 1, size + len(record) + 50

    def end():
        if held:
            add("inner" if headless else "tail")

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    for b in batches:
        for file, block, enters, line in zip(*[c.to_pylist() for c in b.columns]):
            if key != (file, block):
                end()
                key, quoted, headless, at = (file, block), enters, enters, 0
            held.append(line)
            quoted ^= line.count('"') % 2 == 1
            if not quoted:
                add("head" if headless else "whole")
                headless = False
            if size > 1 << 23:
                yield batch()
                out, size = [], 0
    end()
    if out:
        yield batch()


#: Splits beginning inside quotes that are sent to the tasks; a feed with more
#: is parsed file by file.
MOST_INSIDE = 200_000


def quoted_records(spark: SparkSession, path: str | list[str]) -> DataFrame | None:
    """(file, block, at, record): the records of CSV files whose quoted fields
    may hold newlines, read in splits of lines; None beyond ``MOST_INSIDE``.

    Whether a split begins inside quotes follows from the number of quotes in
    all splits before it: one pass counts them for each split, a running sum
    over the (few) splits of a file carries them on, and each task then cuts
    its lines into records. What crosses a split, at most two pieces of each,
    is put together by a grouping."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    odd = F.pmod(F.sum(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))), F.lit(2))
    splits = lines.groupBy("file", "block").agg(odd.alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    workspace_root(spark)
    splits = splits.select("file", "block", (F.pmod(F.coalesce(F.sum("odd").over(before), F.lit(0)), F.lit(2)) == 1).alias("enters")).checkpoint()
    # Splits (of some 128 MB) that begin inside quotes, about 100 bytes each;
    # the lines are not shuffled, so that they reach the tasks in order.
    found = splits.where("enters").limit(MOST_INSIDE + 1).collect()
    if len(found) > MOST_INSIDE:
        return None
    inside = {(r.file, r.block) for r in found}
    shared = spark.sparkContext.broadcast(inside)

    def cut(batches):
        def entered():
            for b in batches:
                keys = zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([k in shared.value for k in keys], pa.bool_()), b.column(2)],
                                                 names=["file", "block", "enters", "value"])

        yield from _records(entered())

    found = lines.mapInArrow(cut, _FRAGMENT)
    pieces = found.where("kind <> 'whole'")
    order = Window.partitionBy("file").orderBy("block", "at")
    begun = pieces.withColumn("chain", F.sum((F.col("kind") == "tail").cast("int")).over(order))
    joined = (begun.groupBy("file", "chain").agg(F.sort_array(F.collect_list(F.struct("block", "at", "record"))).alias("p"))
              .select("file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["at"].alias("at"),
                      F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record")))
    return found.where("kind = 'whole'").select("file", "block", "at", "record").unionByName(joined)


def read_quoted(spark: SparkSession, path: str | list[str], cols: list[str], files: list[tuple[str, int]] | None) -> DataFrame | None:
    """The feed by ``quoted_records``, with the columns of ``read_feed``."""
    records = quoted_records(spark, path)
    if records is None:
        return None
    records = records.where(F.btrim("record", F.lit("\r")) != "")
    first = (F.col("block") == 0) & (F.col("at") == 0)
    text = F.regexp_replace("record", "\r$", "")
    ddl = ", ".join("`{}` STRING".format(c.replace("`", "``")) for c in text_schema(cols).names)
    parsed = F.from_csv(text, ddl, {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "maxCharsPerColumn": "-1"})
    heads = records.where(first).select(F.regexp_replace(text, "^\ufeff", "").alias("h")).distinct().limit(2).collect()
    if any(next(_csv.reader([r.h])) != cols for r in heads):
        raise FeedError(f"files with differing headers in {path}")
    rows = records.where(~first).select("file", "block", "at", parsed.alias("r")).select("file", "block", "at", "r.*")
    rows = rows.withColumn(ROW_ID, F.monotonically_increasing_id())
    names = [fs.uri_name(spark, p) for p, _ in files or []]
    if names and len(set(names)) == len(names) < _FILES:
        number = F.array_position(F.array(*[F.lit(n) for n in names]), F.regexp_extract("file", "[^/]+$", 0)) - 1
        # A record takes a byte at least, so start of the split + number in it orders all records of a file.
        place = number * F.lit(_ROWS * _BLOCKS) + F.col("block") + F.col("at")
        return rows.withColumn(ROW_ORD, place.cast("bigint")).drop("file", "block", "at")
    return rows.withColumn(ROW_ORD, F.struct("file", "block", F.col("at").alias("pos"))).drop("file", "block", "at")


def read_feed(spark: SparkSession, path: str | list[str], multiline: bool | None = None,
              columns: list[str] | None = None) -> DataFrame:
    """All columns as STRING (types come from explicit parsing, never inference).

    Adds ``row_ord``, a total order equal to the file order, and ``_row_id``,
    unique per row. Both are taken at the scan, stored in Bronze and read back
    from there, so they are computed once.
    Short rows are padded with NULL; rows with too many fields fail the load,
    and so does a file whose header differs from the first one's (the scan
    raises it).

    ``multiline``: None finds out whether there are quoted newlines (see
    ``spans_lines``) and then cuts large files at records (``read_quoted``;
    compressed files are parsed whole); True always parses whole files; False
    splits files at lines and refuses a feed with a quoted newline.
    """
    cols = columns if columns is not None else header_columns(spark, path)
    if multiline is None:
        multiline = spans_lines(spark, path)
        first, largest = files_of(spark, path)
        if multiline and largest > min(_split_bytes(spark), SMALL_FEED) and fs.splittable(spark, first):
            cut = read_quoted(spark, path, cols, few_files(spark, path))
            if cut is not None:
                return cut
    elif not multiline and has_quoted_newline(spark, path):
        raise FeedError(f"quoted newline in {path}: it cannot be split at lines")
    df = csv_options(spark.read.schema(text_schema(cols)), multiline).csv(path)
    return with_position(df, few_files(spark, path))


def too_long(corrupt: Column, n_cols: int) -> Column:
    """True for a malformed row with more fields than the header.

    Spark flags short and long rows alike; short rows are kept (padded with
    NULL), long rows fail the load.
    """
    # Commas outside double-quoted sections separate fields.
    plain = F.regexp_replace(corrupt, r'"[^"]*+(?:"|$)', "")
    commas = F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit("")))
    return corrupt.isNotNull() & (commas >= n_cols)


def write_feed(df: DataFrame, path: str, order_by: str | None = None) -> None:
    """Write a feed as CSV text (header, RFC-4180 quoting), in ``order_by`` order."""
    if order_by is not None:
        df = df.orderBy(order_by).drop(order_by)
    (df.write.mode("errorifexists")
       .option("header", True)
       .option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False)
       .option("ignoreTrailingWhiteSpace", False)
       .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
       .csv(path))
