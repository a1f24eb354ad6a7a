"""Spark session defaults and the shared working folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on for correct results (not tuning).
REQUIRED_CONF = {
    # All run instants and month strings are UTC; pin it so date_format is stable.
    "spark.sql.session.timeZone": "UTC",
    # try_cast / try_divide are used everywhere, so ANSI mode can stay on.
    "spark.sql.ansi.enabled": "true",
}

# Tuning for large inputs: AQE re-plans joins (broadcast only when the
# measured size is below the threshold), coalesces small shuffle partitions
# and splits skewed join partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Small inputs still split across all cores; at scale the 128m cap rules.
    "spark.sql.files.openCostInBytes": "131072",
    "spark.sql.parquet.filterPushdown": "true",
    # A zone write has two folders: two open files per task instead of a sort.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}


def get_spark(master: str | None = None, app: str = "ledgerline",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**SCALE_CONF, **REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    """Session-level settings every query needs; safe to call repeatedly."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def workspace_root(spark: SparkSession) -> str:
    """Shared folder for staged tables, zones and Golden snapshots.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (a
    shared file system every executor can reach). Only when the session has
    none, as in local tests, a fresh local folder is made and registered.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A unique sub-folder of the workspace for one run (never reused)."""
    import uuid

    return f"{workspace_root(spark)}/ledgerline/{name}-{uuid.uuid4().hex[:12]}"


def held(df: DataFrame, name: str) -> DataFrame:
    """``df``, computed once: written as Parquet under the workspace and read
    back, for a frame that several jobs read. Unlike a checkpoint it is read by
    column. The folder stays until the owner of the workspace removes it, as
    the returned frame is lazy."""
    path = new_run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
