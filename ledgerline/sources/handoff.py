"""CSV hand-off: a frame as a folder of ordered CSV files that appears at once.

The files are written into a hidden folder beside the target, a manifest with
their names, lengths and rows is added, and the folder is renamed to its name
in one step that fails if the name is taken. So whoever sees the folder sees
all of it; a run that dies leaves a hidden folder only. Files are ranges of
the order, numbered in that order, so reading them by name gives the rows in
order at any size. The manifest's counts are checked when it is read back, and
the folder is a feed like any other: the loads read it as it is.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources import fs
from ledgerline.sources.csv import FeedError, read_feed

MANIFEST = "_manifest.json"


class Exists(RuntimeError):
    """The folder of a hand-off is there already."""


def hand_off(df: DataFrame, folder: str, order_by: list[str] | None = None) -> dict:
    """Write ``df`` as CSV (header, RFC-4180 quoting) to a new ``folder`` and
    return its manifest: columns, rows, and (name, length) of each file.
    NULL is an empty field, an empty text a quoted one. The folder's files each
    carry the header; an empty frame is one file with the header alone."""
    spark = df.sparkSession
    if fs.exists(spark, folder):
        raise Exists(folder)
    parent, name = folder.rstrip("/").rsplit("/", 1)
    hidden = f"{parent}/.{name}.{uuid.uuid4().hex}"
    obs = Observation()
    # Ranges: file n holds what comes before file n + 1. Counted behind the sort, whose sampling reads the rows as well.
    ordered = df.orderBy(*order_by) if order_by else df
    out = ordered.observe(obs, F.count(F.lit(1)).alias("rows"))
    (out.write.option("header", True).option("escape", '"').option("emptyValue", '""').option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(hidden))
    files = sorted((p.rsplit("/", 1)[-1], n) for p, _, n in fs.files(spark, hidden) if fs.shown(p))
    manifest = {"columns": df.columns, "rows": int(obs.get["rows"]), "files": files}
    fs.write_over(spark, f"{hidden}/{MANIFEST}", json.dumps(manifest) + "\n")
    if not fs.rename_new(spark, hidden, folder):
        fs.delete(spark, hidden)
        raise Exists(folder)
    return manifest


def read_hand_off(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of a hand-off as ``read_feed`` gives them, after its files and
    their lengths were held against the manifest."""
    text = fs.read_text(spark, f"{folder}/{MANIFEST}")
    if text is None:
        raise FileNotFoundError(f"{folder}/{MANIFEST}")
    manifest = json.loads(text)
    found = sorted([p.rsplit("/", 1)[-1], n] for p, _, n in fs.files(spark, folder) if fs.shown(p))
    if found != [list(f) for f in manifest["files"]]:
        raise FeedError(f"{folder}: files differ from the manifest")
    return read_feed(spark, folder, columns=manifest["columns"])
