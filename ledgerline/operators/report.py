"""Load reports: counts per reason, quarantine report rows, zone counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.schemas import REASON


def reason_breakdown(classified: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows per quarantine reason, largest first (ties by reason name)."""
    by = list(by or [])
    return (classified.where(F.col(REASON).isNotNull())
            .groupBy(*by, REASON).agg(F.count(F.lit(1)).alias("rows"))
            .orderBy(*by, F.col("rows").desc(), F.col(REASON)))


def report_projection(rejected: DataFrame, spec) -> DataFrame:
    """The feed's key columns that exist, plus the reason; NaN shown as NULL."""
    cols = [c for c in spec.report_cols if c in rejected.columns]
    out = []
    for c in cols:
        dtype = rejected.schema[c].dataType.typeName()
        col = F.col(c)
        out.append(F.when(~F.isnan(col), col).alias(c) if dtype in ("double", "float") else col)
    return rejected.select(*out, REASON)


def zone_counts(classified: DataFrame, by: list[str] | None = None) -> DataFrame:
    """raw / clean / quarantined counts in one aggregate (one pass)."""
    by = list(by or [])
    r = F.col(REASON)
    return classified.groupBy(*by).agg(F.count(F.lit(1)).alias("raw_rows"),
                                       F.count_if(r.isNull()).alias("clean_rows"),
                                       F.count_if(r.isNotNull()).alias("quarantined_rows"))
