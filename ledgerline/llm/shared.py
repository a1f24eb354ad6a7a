"""Small helpers of the training-data operators."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows that one Arrow batch may hold; long texts make larger batches heavy.
BATCH_ROWS = 500


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that the operators rely on: small Arrow batches and a
    checkpoint folder. The folder is the one in ``spark.checkpoint.dir``; only
    a local session that names none gets a temporary one of its own."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="ledgerline-llm-")
        sc.setCheckpointDir(root)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def kept_columns(df: DataFrame, new: list[str], keep: list[str] | None) -> list[str]:
    """Columns of ``df`` to carry along: all, or those in ``keep``; a column
    whose name (in any case) is that of a new one gives way to it."""
    taken = {n.lower() for n in new}
    return [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]


def annotate(df: DataFrame, text_col: str, ddl: str, make: Callable, keep: list[str] | None = None) -> DataFrame:
    """``df`` plus the columns of ``ddl``, computed from one text column in
    Arrow batches. ``make()`` runs once per task and gives a function from a
    list of texts (None for null) to a list of tuples in ``ddl``'s order."""
    fields = T.StructType.fromDDL(ddl)
    carried = kept_columns(df, fields.names, keep)
    src = df.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{text_col}`").cast("string").alias("__text"))
    schema = T.StructType([src.schema[c] for c in carried] + fields.fields)
    added = to_arrow_schema(fields)

    def run(batches):
        fn = make()
        for b in batches:
            rows = fn(b.column(b.num_columns - 1).to_pylist())
            cols = list(zip(*rows)) if rows else [() for _ in added]
            arrays = b.columns[:-1] + [pa.array(list(c), type=f.type) for c, f in zip(cols, added)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*carried, *fields.names])

    return src.mapInArrow(run, schema)


#: One byte map: A-Z to a-z, other bytes as they are.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def as_bytes(text: str | None) -> bytes:
    """UTF-8; a lone surrogate (which Spark strings cannot hold) becomes '?'."""
    return (text or "").encode("utf-8", "replace")
