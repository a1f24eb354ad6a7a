"""Derived financial metrics on the (company_id, month) fact table.

One window specification (partition by company, order by month) serves the
previous-row lag and the 3-row rolling sum, so the plan has one shuffle and
one Window node. A company partition holds one row per distinct month text (the
fact key is unique). Well-formed months bound it by the calendar; by default odd
month text is kept as well, so only ``CleansePolicy(strict_months=True)``
bounds it for any feed; ``spread_metrics`` gives the same result with the rows
of one company spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.normalise import month_start
from ledgerline.schemas import METRIC_COLUMNS
from ledgerline.session import held


def month_window(key: str = "company_id"):
    # Unparsable months sort last, ties by the month text (deterministic).
    return Window.partitionBy(key).orderBy(F.col("_month_dt").asc_nulls_last(), F.col("month").asc())


def compute_metrics(fact: DataFrame, key: str = "company_id") -> DataFrame:
    """Overwrite gross_profit, gross_margin_pct, mom_revenue_growth_pct and
    rolling_3m_revenue. Rows lacking revenue or expenses get NULL metrics, yet
    their revenue still feeds their neighbours' lag and rolling sum.
    """
    w = month_window(key)
    return _derived(fact.withColumn("_month_dt", month_start(F.col("month"))), w, fact.columns)


def _derived(rows: DataFrame, w, columns: list[str]) -> DataFrame:
    """The metrics of rows that have their ``_month_dt``, along a window."""
    rev, exp = F.col("revenue"), F.col("expenses")
    eligible = rev.isNotNull() & exp.isNotNull()
    profit = rev - exp
    cols = [c for c in columns if c not in METRIC_COLUMNS]
    rows = rows.withColumn("_prev", F.lag(rev).over(w)).withColumn("_roll", F.sum(rev).over(w.rowsBetween(-2, 0)))
    if HALO in rows.columns:
        rows = rows.where(~F.col(HALO))
    out = (rows.select(*cols,
                       F.when(eligible, profit).alias("gross_profit"),
                       F.when(eligible, F.try_divide(profit, rev) * 100).alias("gross_margin_pct"),
                       F.when(eligible & F.col("_prev").isNotNull() & (F.col("_prev") != 0),
                              (rev - F.col("_prev")) / F.col("_prev") * 100)
                        .alias("mom_revenue_growth_pct"),
                       F.when(eligible, F.col("_roll")).alias("rolling_3m_revenue")))
    # Keep the fact's column order when it already has the metric columns.
    return out.select(*columns) if set(METRIC_COLUMNS) <= set(columns) else out


#: Rows of a range of ``spread_metrics``.
RANGE_ROWS = 500_000
#: Rows before a row that its metrics look at.
LOOK_BACK = 2
HALO, PART = "_halo", "_part"


def spread_metrics(fact: DataFrame, key: str = "company_id", ranges: int | None = None) -> DataFrame:
    """``compute_metrics`` with bounded window partitions: rows are dealt into
    ranges of (company, month), each range also gets the ``LOOK_BACK`` rows
    before it (its halo), and the window runs within a range. A company of any
    number of months spreads over as many tasks as it has ranges.

    The fact is written first (see ``held``): counting it, sampling it for the
    ranges and dealing it out then read that copy instead of computing it three
    times. The ranges are written to the checkpoint folder, as two consumers must
    see the same ones. Only the last rows of each range, two times the number of
    ranges, meet in one task to find whose halo they are. (company, month) is
    unique in a fact; with repeated keys the order among them is open, as it is
    in ``compute_metrics``.
    """
    columns = fact.columns
    fact = held(fact, "fact")
    n = ranges or max(fact.sparkSession.sparkContext.defaultParallelism, -(-fact.count() // RANGE_ROWS))
    month_dt = F.col("_month_dt")
    forth = [F.col(key).asc_nulls_first(), month_dt.asc_nulls_last(), F.col("month").asc_nulls_first()]
    back = [F.col(key).desc_nulls_last(), month_dt.desc_nulls_first(), F.col("month").desc_nulls_last()]
    rows = (fact.withColumn("_month_dt", month_start(F.col("month"))).repartitionByRange(n, *forth)
            .withColumn(PART, F.spark_partition_id()).checkpoint())
    last = (rows.select(key, "_month_dt", "month", "revenue", PART)
            .withColumn("_n", F.row_number().over(Window.partitionBy(PART).orderBy(*back))).where(F.col("_n") <= LOOK_BACK))
    last = last.withColumn("_pos", F.row_number().over(Window.orderBy(PART, F.col("_n").desc())))
    needs = (last.groupBy(F.col(PART).alias("_to")).agg(F.min("_pos").alias("_first"))
             .select("_to", F.explode(F.sequence(F.col("_first") - LOOK_BACK, F.col("_first") - 1)).alias("_pos")))
    halo = last.drop(PART).join(needs, "_pos").select(key, "_month_dt", "month", "revenue", F.col("_to").alias(PART), F.lit(True).alias(HALO))
    both = rows.withColumn(HALO, F.lit(False)).unionByName(halo, allowMissingColumns=True)
    w = Window.partitionBy(PART, key).orderBy(month_dt.asc_nulls_last(), F.col("month").asc())
    return _derived(both, w, columns)


def longest_run(fact: DataFrame, key: str = "company_id") -> int:
    """Rows of the company that has the most."""
    return fact.groupBy(key).count().agg(F.max("count")).first()[0] or 0


def recompute_scope(fact: DataFrame, company_id: str | None = None, spread: bool = False) -> DataFrame:
    """New fact table with metrics recomputed for one company or all.

    With a company, the filter sits on the window's partition key, so Catalyst
    pushes it below the window (and into the Parquet scan); other companies'
    rows pass through untouched. ``spread``: see ``spread_metrics``.
    """
    compute = spread_metrics if spread else compute_metrics
    if company_id is None:
        return compute(fact)
    one = F.col("company_id") == F.lit(str(company_id))
    return compute(fact.where(one)).unionByName(fact.where(~one | F.col("company_id").isNull()))


def metrics_summary(fact: DataFrame) -> DataFrame:
    eligible = F.col("revenue").isNotNull() & F.col("expenses").isNotNull()
    return fact.agg(F.count(F.lit(1)).alias("total_rows"),
                    F.count_if(eligible).alias("eligible_rows"),
                    F.count_if(F.col("mom_revenue_growth_pct").isNotNull()).alias("rows_with_growth"),
                    F.count_if(F.col("rolling_3m_revenue").isNotNull()).alias("rows_with_rolling"))
