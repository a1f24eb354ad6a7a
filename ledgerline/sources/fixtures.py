"""Raw feeds derived from the shared star-schema tables.

The shared tables are clean, so deterministic dirt is injected by rule (NULL
keys, unknown companies, untrimmed text, odd currency spellings, negative and
missing values, blank codes, older duplicate versions). Every input row is
kept; the rules only change values. The same definitions exist as SQL in
``__spark_entry__`` for the DuckDB cross-check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the derived feeds (also spelled out in FIXTURES.md).
REVENUE_CURRENCIES = ["USD", "usd", " EURO ", "EUR", "gbp", "GBR", "INRR", "AEDX", "CAD", "CHF"]
FX_CURRENCIES = ["EUR", "gbp", "INR ", "AED", "CAD", "SGD", "CHF", "JPY"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _pick(values: list[str], index_col):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.lit(1) + index_col).cast("int"))


def company_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer x nation, NULL ids, padded names, an older version of some companies."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cn = c.join(n, c.c_nationkey == n.n_nationkey)
    k = F.col("c_custkey")
    current = cn.select(
        F.when(k % 97 == 0, F.lit(None).cast("string")).otherwise(k.cast("string")).alias("company_id"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("name"),
        F.col("c_mktsegment").alias("industry"),
        F.col("n_name").alias("country"),
        _ntz("2024-01-02").alias("created_at"),
        (k * 2).alias("row_ord"))
    older = cn.where((k % 40 == 0) & (k % 97 != 0)).select(
        k.cast("string").alias("company_id"),
        F.concat(F.col("c_name"), F.lit(" OLD")).alias("name"),
        F.col("c_mktsegment").alias("industry"),
        F.col("n_name").alias("country"),
        _ntz("2024-01-01").alias("created_at"),
        (k * 2 + 1).alias("row_ord"))
    return current.unionByName(older)


def company_batch2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later company feed: every customer, renamed, under an id 50 higher, so
    that some ids are known and some are new."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .select((F.col("c_custkey") + 50).cast("string").alias("company_id"),
                     F.upper(F.col("c_name")).alias("name"),
                     F.col("c_mktsegment").alias("industry"),
                     F.col("n_name").alias("country"),
                     _ntz("2024-02-01").alias("created_at"),
                     F.col("c_custkey").alias("row_ord")))


def company_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A company feed with quotes, commas and newlines inside its fields, also
    in the last column."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    tail = (F.when(k % 4 == 0, F.lit(', "Ltd"')).when(k % 4 == 1, F.lit("\nInc, 2,b,c")).when(k % 4 == 2, F.lit('"\n"')).otherwise(F.lit("")))
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .select(k.cast("string").alias("company_id"), F.concat("c_name", tail).alias("name"), F.col("c_mktsegment").alias("industry"),
                     F.concat("n_name", F.when(k % 5 == 0, F.lit("\n9,x,y,z")).otherwise(F.lit(""))).alias("country"), k.alias("row_ord")))


def revenue_batch2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later revenue feed: every order again, twice the amount; records of even
    orders are dated 10 days earlier, of odd ones 10 days later."""
    r = revenue_raw(spark, sf_dir)
    even = F.col("row_ord") % 2 == 0
    shift = F.when(even, F.expr("INTERVAL -10 DAYS")).otherwise(F.expr("INTERVAL 10 DAYS"))
    return r.withColumn("updated_at", F.col("updated_at") + shift).withColumn("revenue", F.col("revenue") * 2)


def revenue_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    k = F.col("o_orderkey")
    return o.select(
        F.when(k % 211 == 0, F.lit(None).cast("string"))
         .when(k % 101 == 0, (F.col("o_custkey") + 1000000).cast("string"))
         .otherwise(F.col("o_custkey").cast("string")).alias("company_id"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.when(k % 103 == 0, F.lit(None).cast("double"))
         .when(k % 107 == 0, -F.col("o_totalprice"))
         .otherwise(F.col("o_totalprice")).alias("revenue"),
        F.when(k % 109 == 0, F.lit("XXX"))
         .otherwise(_pick(REVENUE_CURRENCIES, k % 10)).alias("currency"),
        F.col("o_orderdate").alias("updated_at"),
        k.alias("row_ord"))


def order_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net line amount per order, summed exactly in DECIMAL then returned as DOUBLE."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    net = F.round(F.col("l_extendedprice").cast("decimal(18,2)")
                  * (F.lit(1) - F.col("l_discount").cast("decimal(18,2)")), 2)
    return li.groupBy("l_orderkey").agg(F.sum(net).cast("double").alias("amt"))


def expense_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    amt = order_amounts(spark, sf_dir)
    k = F.col("o_orderkey")
    return (o.join(amt, o.o_orderkey == amt.l_orderkey)
             .select(F.when(k % 199 == 0, F.lit(None).cast("string"))
                      .otherwise(F.col("o_custkey").cast("string")).alias("company_id"),
                     F.date_format("o_orderdate", "yyyy-MM").alias("month"),
                     F.when(k % 127 == 0, F.lit(None).cast("double"))
                      .when(k % 113 == 0, -F.col("amt"))
                      .otherwise(F.col("amt")).alias("expenses"),
                     F.col("o_orderdate").alias("updated_at"),
                     k.alias("row_ord")))


def fx_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    k = F.col("event_id")
    return e.select(
        F.when(k % 131 == 0, F.lit("  ")).otherwise(_pick(FX_CURRENCIES, F.col("user_id") % 8))
         .alias("local_currency"),
        F.lit("usd").alias("base_currency"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.when(k % 139 == 0, F.lit(None).cast("double"))
         .when(k % 137 == 0, F.lit(0.0))
         .otherwise(F.col("value")).alias("fx_rate"),
        k.alias("row_ord"))


def fx_batch2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later FX feed: every event shifted 15 days, rate + 0.5."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    return e.select(
        _pick(FX_CURRENCIES, F.col("user_id") % 8).alias("local_currency"),
        F.lit("USD").alias("base_currency"),
        F.date_format(F.col("ts") + F.expr("INTERVAL 15 DAYS"), "yyyy-MM-dd").alias("date"),
        (F.col("value") + F.lit(0.5)).alias("fx_rate"),
        F.col("event_id").alias("row_ord"))


RAW_FEEDS = {
    "company": company_raw,
    "revenue": revenue_raw,
    "expense": expense_raw,
    "fx_rate": fx_raw,
}
