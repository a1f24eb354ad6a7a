"""Zone folders and versioned Golden tables in the shared workspace.

A Golden table is a set of Parquet folders ``golden/<table>/v=<version>/`` and
a log ``_versions/<number>.json``. Each log entry names the folder that holds
each part of the table, so a new version writes only the parts it changes and
shares the others with the version before it. Parts are hash buckets of the
table's leading key (inside the years of a fact); a table gets more of them as
it grows, so that a part stays a few files at any size.

Commits. An entry is written whole under a hidden name and then published
under its number in one step that fails if the number is taken. Whoever built
on an older entry gets ``StaleBase``: no update is lost, and a reader never
sees a half-written table. A killed driver leaves hidden files and unused data
folders only. Entries that are torn all the same (a full disk, another tool)
are skipped: the newest whole entry counts, and the next load is published
behind the torn one. ``_newest`` and ``_numbers`` only save time; if they are
lost, torn or stale, the log itself is listed. Nothing about a table is cached,
so a long-running process sees the versions of others. Old versions stay
readable until ``expire`` is called.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources import fs

_LOG_SCHEMA = T.StructType([
    T.StructField("number", T.LongType(), False),
    T.StructField("version", T.StringType(), False),
    T.StructField("committed_at", T.TimestampType(), False),
    T.StructField("rows", T.LongType(), True),
    T.StructField("parts", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("buckets", T.IntegerType(), True),
    T.StructField("total", T.LongType(), True),
])
_NAME = re.compile(r"(\d{12})\.json")
BUCKET = "bucket"


class StaleBase(RuntimeError):
    """Another writer published a version since the base of this one was read."""


@dataclass(frozen=True)
class Entry:
    """One version: its number, id, time, rows written, and partition folders."""

    number: int
    version: str
    committed_at: str
    rows: int
    parts: dict[str, str] = field(default_factory=dict)
    buckets: int = 1
    total: int = 0


#: Rows that a bucket may reach before a table gets twice as many, and the
#: most buckets a table gets: a part beyond that holds more files.
BUCKET_ROWS, MOST_BUCKETS = 4_000_000, 1024


def buckets_for(rows: int, now: int = 1) -> int:
    """Buckets of a table (of one year of it): a power of two, never fewer than
    it has."""
    while rows > now * BUCKET_ROWS and now < MOST_BUCKETS:
        now *= 2
    return now


def bucket_of(keys: list[str], buckets: int) -> Column:
    """Bucket of a row by its leading key columns. Buckets are powers of two,
    so doubling them parts each one in two."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


class Store:
    def __init__(self, spark: SparkSession, root: str, least_buckets: int = 1):
        """``least_buckets``: buckets that new tables start with (a power of two)."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.least_buckets = least_buckets

    # --- zones ---------------------------------------------------------------
    def zone_path(self, zone: str, entity: str, load_uuid: str) -> str:
        return f"{self.root}/zones/{zone}/{entity}/load_uuid={load_uuid}"

    def write_observed(self, df: DataFrame, path: str, metrics: dict, partition_by=None,
                       mode: str = "errorifexists", drop_after_observe=(),
                       sort_within: list[str] | None = None) -> dict:
        """Write ``df`` once and return the named aggregates seen on the way."""
        obs = Observation()
        observed = df.observe(obs, *[expr.alias(name) for name, expr in metrics.items()])
        if drop_after_observe:
            observed = observed.drop(*drop_after_observe)
        if sort_within:
            observed = observed.sortWithinPartitions(*sort_within)
        w = observed.write.mode(mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        return obs.get

    # --- golden tables ---------------------------------------------------------
    def table_path(self, table: str) -> str:
        return f"{self.root}/golden/{table}"

    def exists(self, path: str) -> bool:
        return fs.exists(self.spark, path)

    def _log(self, table: str) -> str:
        return f"{self.table_path(table)}/_versions"

    def _entry(self, table: str, number: int) -> Entry | None:
        """A whole log entry, or None if it is absent or torn."""
        text = fs.read_text(self.spark, f"{self._log(table)}/{number:012d}.json")
        try:
            entry = Entry(**json.loads(text)) if text else None
        except (ValueError, TypeError):
            return None
        return entry if entry is not None and entry.number == number else None

    def _taken(self, table: str, number: int) -> bool:
        return fs.exists(self.spark, f"{self._log(table)}/{number:012d}.json")

    def _numbers(self, table: str) -> list[int]:
        """Numbers in the log, of whole and torn entries, by listing it."""
        return sorted(int(m[1]) for m in map(_NAME.fullmatch, fs.names(self.spark, self._log(table))) if m)

    def _hint(self, path: str) -> int | None:
        """The number in a note beside the log, if there is a readable one."""
        text = fs.read_text(self.spark, path)
        return int(text) if text and text.strip().isdigit() else None

    def _last(self, table: str) -> int:
        """The last number taken in the log, -1 if none is: from the noted one
        on, which may lag. A note that is lost, torn or expired is replaced by
        a listing."""
        number = self._hint(f"{self.table_path(table)}/_newest")
        if number is None or not self._taken(table, number):
            number = max(self._numbers(table), default=-1)
        while self._taken(table, number + 1):
            number += 1
        return number

    def current(self, table: str) -> Entry | None:
        """The newest whole log entry, read anew at each call."""
        last = self._last(table)
        if last < 0:
            return None
        entry = self._entry(table, last)
        if entry is None:  # torn: the one before it counts
            entry = next((e for n in reversed(self._numbers(table)) if n < last and (e := self._entry(table, n))), None)
        return entry

    def current_version(self, table: str) -> str | None:
        entry = self.current(table)
        return entry.version if entry else None

    def entry_of(self, table: str, version: str) -> Entry | None:
        """The log entry of a version id, by the number noted beside the log
        before it was published. A torn note is made up for by reading the log."""
        note = f"{self.table_path(table)}/_numbers/{version}"
        number = self._hint(note)
        if number is None:
            if not fs.exists(self.spark, note):
                return None  # never published
            row = self.versions(table).where(F.col("version") == version).select("number").first()
            number = row[0] if row else -1
        entry = self._entry(table, number)
        return entry if entry and entry.version == version else None

    def committed(self, table: str, version: str) -> bool:
        """Is ``version`` in the table's version log?"""
        return self.entry_of(table, version) is not None

    def read(self, table: str, schema: T.StructType | None = None, version: str | None = None,
             entry: Entry | None = None, parts: list[str] | None = None, partition_col: str | None = None) -> DataFrame | None:
        """A version of a table (default: the current one), or some parts of
        it: only their folders are listed and read. ``partition_col`` adds the
        outer partition as a column, by which the scan prunes folders."""
        entry = entry or (self.entry_of(table, version) if version else self.current(table))
        if version and entry is None:
            raise ValueError(f"{table} has no version {version}")
        shown = [T.StructField(partition_col, T.StringType())] if partition_col else []
        if entry is None:
            return self.spark.createDataFrame([], T.StructType([*schema.fields, *shown])) if schema is not None else None
        found = {p: v for p, v in entry.parts.items() if parts is None or p in parts}
        if not found:
            return self.spark.createDataFrame([], T.StructType([*schema.fields, *shown]))
        folders = [f"{self.table_path(table)}/v={v}" + (f"/{p}" if p else "") for p, v in sorted(found.items())]
        reader = self.spark.read.option("basePath", self.table_path(table))
        if schema is not None:
            reader = reader.schema(T.StructType([*schema.fields, *shown]))
        df = reader.parquet(*folders)
        return df.drop("v", BUCKET) if schema is None else df.select(*schema.names, *[f.name for f in shown])

    def publish(self, table: str, df: DataFrame, version: str, metrics: dict | None = None,
                sort_within: list[str] | None = None, drop_after_observe=(),
                mode: str = "errorifexists", base: Entry | None = None, partition_by: list[str] | None = None,
                parts: list[str] | None = None, buckets: int = 1, replace: bool = False) -> dict:
        """Write the changed part of a table, then append the version to the log.

        ``base``: the entry that ``df`` was built on (None: an empty table).
        ``partition_by`` / ``parts``: ``df`` holds exactly the rows of these
        parts and replaces their folders; all other folders of ``base`` stay,
        unless ``replace`` says that ``df`` is the whole table (it has other
        parts now). Rows are dealt by part before the write: a part is one file
        whatever the number of tasks, or several where it is large (adaptive
        execution splits it).
        ``mode="overwrite"`` rewrites an uncommitted folder of the same version
        left by a failed attempt (never a committed one).
        """
        path = f"{self.table_path(table)}/v={version}"
        if mode == "overwrite" and self.committed(table, version):
            raise ValueError(f"{table} version {version} is already committed")
        if partition_by:
            df = df.hint("rebalance", *partition_by)
            sort_within = [*partition_by, *(sort_within or [])]
        seen = self.write_observed(df, path, {"rows": F.count(F.lit(1)), **(metrics or {})},
                                   drop_after_observe=drop_after_observe, sort_within=sort_within,
                                   mode=mode, partition_by=partition_by)
        new = {p: version for p in parts} if partition_by else {"": version}
        kept = {} if base is None or replace or not partition_by else {p: v for p, v in base.parts.items() if p not in new}
        now = self.current(table)
        if (now.number if now else -1) != (base.number if base else -1):
            raise StaleBase(f"{table}: version {now.number if now else -1} was published by another writer")
        number = self._last(table) + 1
        rows = int(seen["rows"])
        total = (base.total if base else 0) + int(seen["inserted"]) if "inserted" in seen else base.total if base and kept else rows
        entry = Entry(number, version, datetime.now(timezone.utc).replace(tzinfo=None).isoformat(), rows, {**kept, **new}, buckets, total)
        fs.write_over(self.spark, f"{self.table_path(table)}/_numbers/{version}", f"{number}\n")
        # Commit: one small entry under a number that must be free.
        if not fs.write_new(self.spark, f"{self._log(table)}/{number:012d}.json", json.dumps(entry.__dict__) + "\n"):
            raise StaleBase(f"{table}: version {number} was published by another writer")
        fs.write_over(self.spark, f"{self.table_path(table)}/_newest", f"{number}\n")
        return seen

    def version_at(self, table: str, instant: datetime) -> str | None:
        """The version that was current at ``instant`` (UTC, naive), if any:
        a binary search over the numbered entries."""
        entry = self._entry_at(table, instant)
        return entry.version if entry else None

    def _entry_at(self, table: str, instant: datetime) -> Entry | None:
        lo, hi, best = 0, self._last(table) + 1, None
        while lo < hi:
            mid = at = (lo + hi) // 2
            entry = self._entry(table, at)
            while entry is None and at > lo and self._taken(table, at):  # torn: the one before it
                at -= 1
                entry = self._entry(table, at)
            if entry is None:  # expired, or torn down to the lower end
                lo = mid + 1
            elif datetime.fromisoformat(entry.committed_at) <= instant:
                lo, best = mid + 1, entry
            else:
                hi = at
        return best

    def read_as_of(self, table: str, instant: datetime, schema: T.StructType | None = None) -> DataFrame | None:
        """Time travel: the table as it was at ``instant``."""
        entry = self._entry_at(table, instant)
        if entry is None:
            return self.spark.createDataFrame([], schema) if schema is not None else None
        return self.read(table, schema, entry=entry)

    def versions(self, table: str) -> DataFrame:
        """The whole entries of the log."""
        return self.spark.read.schema(_LOG_SCHEMA).json(self._log(table)).where(
            "version IS NOT NULL AND _metadata.file_name = concat(lpad(CAST(number AS STRING), 12, '0'), '.json')")

    def expire(self, table: str, keep: int = 1) -> list[str]:
        """Drop all but the newest ``keep`` versions, and torn entries before
        them; the folders that none of them uses are deleted. An entry goes
        before its folders do, so an interrupted run leaves no entry without
        its data. Gives the deleted folders' version ids."""
        numbers = self._numbers(table)
        kept, used = 0, set()
        gone: set[str] = set()
        for number in reversed(numbers):
            entry = self._entry(table, number)
            if kept < keep:
                if entry is not None:
                    kept += 1
                    used |= set(entry.parts.values())
                continue
            if entry is not None:
                gone |= {entry.version, *entry.parts.values()} - used
                fs.delete(self.spark, f"{self.table_path(table)}/_numbers/{entry.version}")
            fs.delete(self.spark, f"{self._log(table)}/{number:012d}.json")
        for version in gone:
            fs.delete(self.spark, f"{self.table_path(table)}/v={version}")
        return sorted(gone)

    # --- audit -----------------------------------------------------------------
    def audit_path(self) -> str:
        return f"{self.root}/dataload_audit"
