"""Incremental intake of feed files with Structured Streaming.

The stream follows the files of a folder, not their rows: a micro-batch is a
list of new files, and each batch runs the same load as a batch of files
(Bronze -> zones -> Golden), with the same checks of every header and of quoted
newlines and the same handling of compressed files. The stream's checkpoint
records which files were taken; the Golden tables are the state, so no
watermark or state store is needed. A batch's load id is derived from the
checkpoint and the batch id, so a batch retried after a failure rewrites its
own staging folders and is skipped once its Golden version is committed.

A file that cannot be loaded (other header, no header, rows too long) does not
stop the stream: it is noted in ``<root>/_intake_rejected/<entity>`` and its
batch is loaded without it.
"""

from __future__ import annotations

import json
import uuid
from collections import deque

from pyspark.sql import DataFrame, SparkSession

from ledgerline.plans.cleanse import missing_columns
from ledgerline.plans.entities import SPECS, CleansePolicy
from ledgerline.plans.loader import AlreadyLoaded, LoadResult, load_frame
from ledgerline.sources import fs
from ledgerline.sources.csv import FeedError, header_columns, read_feed
from ledgerline.sources.store import Store

_FILES = "path string, modificationTime timestamp, length long, content binary"
#: Results kept for the caller; a long-running stream forgets older ones.
KEPT_RESULTS = 100


def batch_load_id(checkpoint: str, batch_id: int) -> str:
    return str(uuid.uuid5(uuid.NAMESPACE_URL, f"{checkpoint}#{batch_id}"))


def _reject(spark: SparkSession, store: Store, entity: str, load_id: str, path: str, why: str) -> None:
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{load_id}#{path}").hex
    fs.write_new(spark, f"{store.root}/_intake_rejected/{entity}/{name}.json", json.dumps({"file": path, "reason": why}) + "\n")


def rejected_files(spark: SparkSession, store: Store, entity: str) -> DataFrame:
    """(file, reason) of the files that the intake could not load."""
    folder = f"{store.root}/_intake_rejected/{entity}"
    schema = "file string, reason string"
    return spark.read.schema(schema).json(folder) if fs.exists(spark, folder) else spark.createDataFrame([], schema)


def intake(spark: SparkSession, store: Store, entity: str, folder: str, columns: list[str] | None = None,
           checkpoint: str | None = None, policy: CleansePolicy = CleansePolicy(),
           available_now: bool = True, max_files_per_trigger: int = 1000, trigger_interval: str = "1 minute",
           multiline: bool | None = None):
    """Start the intake; with ``available_now`` it processes every file
    present and stops, else it looks for files every ``trigger_interval``.
    ``columns``: the header that files must have (default: that of the first
    file of a batch). Returns (query, the last ``KEPT_RESULTS`` LoadResults)."""
    spec = SPECS[entity]
    checkpoint = checkpoint or f"{store.root}/_intake/{spec.name}"
    files = (spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", True)
             .option("maxFilesPerTrigger", max_files_per_trigger).load(folder).select("path", "length"))
    results: deque[LoadResult] = deque(maxlen=KEPT_RESULTS)

    def fit_for_load(paths: list[str], load_id: str) -> tuple[list[str], list[str] | None]:
        good, want = [], columns
        for p in paths:
            try:
                cols = header_columns(spark, p)
                missing = missing_columns(cols, spec)
                if missing:
                    raise FeedError(f"missing required columns {missing}")
                if want is not None and cols != want:
                    raise FeedError(f"header {cols} instead of {want}")
                want = cols
                good.append(p)
            except FeedError as e:
                _reject(spark, store, spec.name, load_id, p, str(e))
        return good, want

    def load(paths: list[str], cols: list[str], load_id: str) -> None:
        feed = read_feed(spark, paths, multiline, columns=cols)
        results.append(load_frame(spark, store, entity, feed, len(cols), f"{folder}#{load_id}", policy, load_uuid=load_id, stage_mode="overwrite"))

    def run_batch(df: DataFrame, batch_id: int) -> None:
        # One row per new file, at most max_files_per_trigger.
        paths = sorted(r.path for r in df.where("length > 0").collect() if not r.path.rsplit("/", 1)[-1].startswith((".", "_")))
        load_id = batch_load_id(checkpoint, batch_id)
        good, cols = fit_for_load(paths, load_id)
        if not good:
            return
        try:
            load(good, cols, load_id)
        except AlreadyLoaded:
            pass
        except FeedError:
            # Some file holds malformed rows: load the others one by one, note those that fail.
            for k, p in enumerate(good):
                try:
                    load([p], cols, f"{load_id}-{k}")
                except AlreadyLoaded:
                    pass
                except FeedError as e:
                    _reject(spark, store, spec.name, load_id, p, str(e))

    writer = files.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger_interval)
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query, results
