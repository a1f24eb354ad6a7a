"""Prioritised row classification and the referential (orphan) check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.schemas import REASON, ROW_ID

KNOWN = "_known"


def first_reason(rules: Sequence[tuple[Column, str]]) -> Column:
    """One expression for a prioritised rule list (highest priority first).

    The first predicate that holds names the reason; NULL means clean.
    """
    if not rules:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(pred, F.lit(reason)) for pred, reason in rules])


def classify(df: DataFrame, rules: Sequence[tuple[Column, str]], reason_col: str = REASON) -> DataFrame:
    return df.withColumn(reason_col, first_reason(rules))


def flag_known(df: DataFrame, dim_keys: DataFrame | None, key: str, dim_key: str | None = None,
               dim_unique: bool = True, row_id: str = ROW_ID) -> DataFrame:
    """Add boolean ``_known``: does the row's key exist in the dimension?

    A left join on the key instead of ``left_anti``: rows must stay so that
    the rule priority can be applied to every row. NULL keys never match;
    they are spread over the cluster with a per-row join key so that a large
    share of NULL keys does not land in one shuffle partition. No broadcast
    hint: AQE broadcasts the dimension only if its measured size is below
    ``spark.sql.autoBroadcastJoinThreshold``, else a sort-merge join runs
    (with skewed partitions of the feed split by AQE).
    """
    if dim_keys is None:
        return df.withColumn(KNOWN, F.col(key).isNotNull())
    dk = dim_key or key
    ids = (dim_keys.select(F.col(dk).cast("string").alias("_jk"), F.lit(True).alias(KNOWN))
                   .where(F.col("_jk").isNotNull()))
    if not dim_unique:
        ids = ids.dropDuplicates(["_jk"])
    spread = F.coalesce(F.col(key).cast("string"),
                        F.concat(F.lit("\u0000null:"), F.col(row_id).cast("string")))
    joined = df.withColumn("_jk", spread).join(ids, "_jk", "left")
    return joined.select(*df.columns, F.coalesce(F.col(KNOWN), F.lit(False)).alias(KNOWN))


def orphan_rows(df: DataFrame, dim_keys: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Rows whose key is NULL or absent from the dimension (report form)."""
    dk = dim_key or key
    ids = dim_keys.select(F.col(dk).cast("string").alias(key)).where(F.col(key).isNotNull())
    present = df.where(F.col(key).isNotNull()).join(ids, key, "left_anti")
    return present.unionByName(df.where(F.col(key).isNull()))


def split_by_reason(classified: DataFrame, reason_col: str = REASON) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined) views of one classified frame."""
    return (classified.where(F.col(reason_col).isNull()),
            classified.where(F.col(reason_col).isNotNull()))
