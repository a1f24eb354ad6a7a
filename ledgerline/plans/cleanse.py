"""The cleanse plan shared by all feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.classify import KNOWN, first_reason, flag_known
from ledgerline.operators.dedup import mark_superseded
from ledgerline.plans.entities import CleansePolicy, EntitySpec
from ledgerline.schemas import REASON, ROW_ID, ZONE, ZONE_QUARANTINE, ZONE_SILVER
from ledgerline.session import held


def missing_columns(df_or_columns, spec: EntitySpec) -> list[str]:
    """Required columns absent from the feed (checked on the schema, no job)."""
    cols = df_or_columns.columns if isinstance(df_or_columns, DataFrame) else list(df_or_columns)
    return [c for c in spec.required if c not in cols]


def value_rules(df: DataFrame, spec: EntitySpec, dim_keys: DataFrame | None = None,
                policy: CleansePolicy = CleansePolicy(), row_id: str = ROW_ID) -> DataFrame:
    """Normalise and apply the prioritised value rules (no dedup yet)."""
    n = spec.normalise(df, policy)
    if spec.uses_dim:
        n = flag_known(n, dim_keys, "company_id", row_id=row_id)
    keep = [c for c in n.columns if c not in (KNOWN, REASON)]
    return n.select(*keep, first_reason(spec.rules(policy)).alias(REASON))


def cleanse(df: DataFrame, spec: EntitySpec, dim_keys: DataFrame | None = None,
            policy: CleansePolicy = CleansePolicy(), row_id: str = ROW_ID) -> DataFrame:
    """Every input row once, with ``quarantine_reason`` NULL for clean rows.

    Both the contested keys and the marking read the ruled rows; they are held,
    so that the feed is derived, normalised and joined with the dimension once."""
    ruled = held(value_rules(df, spec, dim_keys, policy, row_id), "ruled")
    marked = mark_superseded(ruled, spec.keys, spec.order(policy), row_id=row_id)
    return spec.finish(marked)


def with_zone(classified: DataFrame) -> DataFrame:
    return classified.withColumn(
        ZONE, F.when(F.col(REASON).isNull(), F.lit(ZONE_SILVER)).otherwise(F.lit(ZONE_QUARANTINE)))
