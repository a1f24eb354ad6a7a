"""Base-currency conversion of the monthly financials.

A row's rate is the one of its currency that was last known by the end of its
month (as-of), from the rates into the base currency; the base currency itself
converts at 1. Without a rate, or a month, the converted values are NULL and
the row counts as missing.

Rates are first reduced to the last one of each (currency, month), and the fact
to its distinct (currency, month) pairs; only these two small tables, bounded
by currencies times months, meet in a window. The fact is joined once with the
result, whose measured size lets adaptive execution broadcast it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.functions.normalise import month_start

#: Amounts that are converted; each gets a column of that name with ``_base``.
AMOUNTS = ("revenue", "expenses", "gross_profit", "rolling_3m_revenue")


def monthly_rates(fx: DataFrame, base: str) -> DataFrame:
    """(currency, first, rate_date, rate): the last rate of each month."""
    day = F.col("date").try_cast("date")
    rates = fx.where((F.col("base_currency") == base) & day.isNotNull()).select(
        F.col("local_currency").alias("currency"), F.trunc(day, "month").alias("first"), F.struct(day.alias("d"), F.col("date").alias("t"), "fx_rate").alias("r"))
    last = rates.groupBy("currency", "first").agg(F.max("r").alias("r"))
    return last.select("currency", "first", F.col("r.d").alias("rate_date"), F.col("r.fx_rate").alias("rate"))


def rates_as_of(pairs: DataFrame, fx: DataFrame, base: str) -> DataFrame:
    """(currency, month, rate, rate_date) for each pair (currency, month) that
    has a rate."""
    wanted = pairs.where("currency IS NOT NULL").select("currency", "month", month_start(F.col("month")).alias("first")).where("first IS NOT NULL")
    known = monthly_rates(fx, base).select("currency", F.lit(None).cast("string").alias("month"), "first", F.struct("rate", "rate_date").alias("r"))
    both = known.unionByName(wanted.withColumn("r", F.lit(None).cast(known.schema["r"].dataType)))
    # Of one month the rate comes first; a window holds one currency's months.
    order = Window.partitionBy("currency").orderBy("first", F.col("month").asc_nulls_first())
    seen = both.withColumn("r", F.last("r", ignorenulls=True).over(order)).where("month IS NOT NULL")
    own = F.col("currency") == base
    return seen.select("currency", "month", F.when(own, 1.0).otherwise(F.col("r.rate")).alias("rate"),
                       F.when(~own, F.col("r.rate_date")).alias("rate_date")).where("rate IS NOT NULL")


def to_base_currency(fact: DataFrame, fx: DataFrame, base: str = "USD") -> DataFrame:
    """The fact with ``rate``, ``rate_date`` and its amounts in ``base``."""
    base = base.upper()
    rates = rates_as_of(fact.select("currency", "month").distinct(), fx, base)
    amounts = [(F.col(a) * F.col("rate")).alias(f"{a}_base") for a in AMOUNTS if a in fact.columns]
    return fact.join(rates, ["currency", "month"], "left").select(*fact.columns, "rate", "rate_date", *amounts)


def missing_rates(converted: DataFrame) -> DataFrame:
    """Rows and rows without a rate, by currency."""
    return converted.groupBy("currency").agg(F.count("*").alias("row_count"), F.count_if(F.col("rate").isNull()).alias("missing_rate"))
