"""Audit trail: one row per (load, stage), appended; reads with filters.

Each stage appends a small JSON file of its own, so writers never meet.
``roll`` turns many of them into a Parquet segment and publishes a numbered
entry that names the live segments and the files they took in. Readers take the
segments of the newest whole entry and the small files it does not name, so a
record is seen once whatever has been deleted. Files and segments that an entry
retires stay until the roll after it: a read that began before a roll still
finds them. A new segment takes in the newer ones up to twice its size, which
leaves a number of segments in the logarithm of the records.
"""

from __future__ import annotations

import json
import logging
import os
import re
import uuid
import traceback
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.sources import fs

log = logging.getLogger(__name__)


def error_text(exc: BaseException | None) -> str | None:
    """'Type: message' plus the traceback, cut to the column limit."""
    if exc is None:
        return None
    text = f"{type(exc).__name__}: {exc}\n" + "".join(
        traceback.format_exception(type(exc), exc, exc.__traceback__))
    return text[:S.ERROR_TEXT_LIMIT]


def audit_row(entity: str, source_path: str | None, load_uuid: str, stage: str, status: str,
              row_count: int, exc: BaseException | None = None) -> tuple:
    """One audit record, stamped with the time the stage ended."""
    return (entity, os.path.basename(source_path.rstrip("/")) if source_path else None,
            load_uuid, stage, status, int(row_count), error_text(exc),
            datetime.now(timezone.utc).replace(tzinfo=None))


def append(spark: SparkSession, audit_path: str, rows: list[tuple]) -> None:
    """Append audit records as one new JSON-lines file (a driver-side write of
    a few hundred bytes, no Spark job). Errors are logged and swallowed:
    auditing never fails a load."""
    if not rows:
        return
    names = [f.name for f in S.DATALOAD_AUDIT.fields]
    lines = []
    for r in rows:
        rec = dict(zip(names, r))
        rec["run_at"] = rec["run_at"].isoformat()
        lines.append(json.dumps(rec))
    try:
        fname = f"{rows[0][-1].strftime('%Y%m%dT%H%M%S%f')}-{rows[0][2]}-{uuid.uuid4().hex[:8]}.json"
        if not fs.write_new(spark, f"{audit_path}/{fname}", "\n".join(lines) + "\n"):
            log.error("audit file %s exists", fname)
    except Exception:  # noqa: BLE001 - audit must not break the load
        log.exception("audit write failed for %s", [r[3] for r in rows])


def record(spark: SparkSession, audit_path: str, entity: str, source_path: str | None,
           load_uuid: str, stage: str, status: str, row_count: int,
           exc: BaseException | None = None) -> None:
    """Append one audit record."""
    append(spark, audit_path, [audit_row(entity, source_path, load_uuid, stage, status, row_count, exc)])


#: Small files that start a roll, and the most that one segment takes in.
ROLL_AT, ROLL_MOST = 256, 20_000
_ENTRY = re.compile(r"(\d{12})\.json")


@dataclass(frozen=True)
class Roll:
    """One state of the rolled trail: (segment, rows) from old to new, the small
    files (percent-encoded names) and segments that it retired."""

    number: int = -1
    segments: list[list] = field(default_factory=list)
    files: list[str] = field(default_factory=list)
    retired: list[str] = field(default_factory=list)


def _rolls(audit_path: str) -> str:
    return f"{audit_path}_rolled"


def _newest(spark: SparkSession, audit_path: str) -> tuple[Roll, int]:
    """The newest whole entry, and the first number that is free. Torn entries
    are passed over."""
    log_path = f"{_rolls(audit_path)}/log"
    numbers = sorted((int(m[1]) for m in map(_ENTRY.fullmatch, fs.names(spark, log_path)) if m), reverse=True)
    for n in numbers:
        text = fs.read_text(spark, f"{log_path}/{n:012d}.json")
        try:
            found = Roll(**json.loads(text)) if text else None
        except (ValueError, TypeError):
            found = None
        if found is not None and found.number == n:
            return found, numbers[0] + 1
    return Roll(), numbers[0] + 1 if numbers else 0


def _small(spark: SparkSession, audit_path: str, state: Roll) -> DataFrame:
    """Records of the small files that no segment holds, with their file."""
    df = spark.read.schema(S.DATALOAD_AUDIT).json(audit_path).select("*", F.col("_metadata.file_name").alias("_file"))
    return df.where(~F.col("_file").isin(state.files)) if state.files else df


def _segments(spark: SparkSession, audit_path: str, names: list[str]) -> DataFrame:
    return spark.read.schema(S.DATALOAD_AUDIT).parquet(*[f"{_rolls(audit_path)}/{n}" for n in names])


def roll(spark: SparkSession, audit_path: str, at_least: int = 1) -> bool:
    """Roll the small files into a segment if there are ``at_least`` so many.
    False if there are too few or another roll was published first. A roll that
    is killed anywhere changes nothing that is read; the next one begins anew.
    """
    present = fs.count(spark, audit_path)
    if present < at_least:
        return False
    state, number = _newest(spark, audit_path)
    root = _rolls(audit_path)
    kept_back = bool(state.files) and fs.exists(spark, f"{audit_path}/{unquote(state.files[-1])}")
    if kept_back and present - len(state.files) < at_least:
        return False
    # What the entry before retired: no reader is two rolls behind.
    for name in state.files:
        fs.delete(spark, f"{audit_path}/{unquote(name)}")
    for name in state.retired:
        fs.delete(spark, f"{root}/{name}")
    small = _small(spark, audit_path, state)
    files = [r[0] for r in small.select("_file").distinct().orderBy("_file").limit(ROLL_MOST).collect()]
    if len(files) < at_least:
        return False
    rows = small.where(F.col("_file").isin(files)).drop("_file")
    n, kept, merged = rows.count(), list(state.segments), []
    while kept and kept[-1][1] <= 2 * n:
        name, more = kept.pop()
        merged.append(name)
        n += more
    if merged:
        rows = rows.unionByName(_segments(spark, audit_path, merged))
    segment = f"segment-{uuid.uuid4().hex}"
    rows.repartitionByRange(max(1, n // ROLL_ROWS), "run_at").sortWithinPartitions("run_at").write.parquet(f"{root}/{segment}")
    new = Roll(number, [*kept, [segment, n]], files, merged)
    if not fs.write_new(spark, f"{root}/log/{number:012d}.json", json.dumps(asdict(new)) + "\n"):
        fs.delete(spark, f"{root}/{segment}")
        return False
    if state.number >= 0:  # only the newest two entries are ever needed
        fs.delete(spark, f"{root}/log/{state.number - 1:012d}.json")
    return True


#: Records of a file of a segment.
ROLL_ROWS = 1_000_000


def roll_if_many(spark: SparkSession, audit_path: str) -> None:
    """Roll once ``ROLL_AT`` small files have gathered; errors are logged and
    swallowed like those of ``append``."""
    try:
        roll(spark, audit_path, ROLL_AT)
    except Exception:  # noqa: BLE001 - audit must not break the load
        log.exception("audit roll failed")


def read_audit(spark: SparkSession, audit_path: str, entity: str | None = None,
               load_uuid: str | None = None, stage: str | None = None,
               status: str | None = None) -> DataFrame:
    """Filtered audit rows, newest first (ties by load and stage)."""
    if fs.exists(spark, audit_path):
        state, _ = _newest(spark, audit_path)
        df = _small(spark, audit_path, state).drop("_file")
        if state.segments:
            df = df.unionByName(_segments(spark, audit_path, [name for name, _ in state.segments]))
    else:  # no audit written yet
        df = spark.createDataFrame([], S.DATALOAD_AUDIT)
    if entity:
        df = df.where(F.col("entity") == entity)
    if load_uuid:
        df = df.where(F.col("load_uuid") == load_uuid)
    if stage:
        df = df.where(F.col("stage") == stage.upper())
    if status:
        df = df.where(F.col("status") == status.upper())
    return df.orderBy(F.col("run_at").desc(), F.col("load_uuid"), F.col("stage"))
