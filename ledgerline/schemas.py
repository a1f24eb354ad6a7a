"""Table schemas, quarantine reasons and other fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the source system's for identical results.
# ---------------------------------------------------------------------------

# Quarantine reasons.
NULL_COMPANY_ID = "NULL_COMPANY_ID"
ORPHAN_COMPANY_ID = "ORPHAN_COMPANY_ID"
MALFORMED_CURRENCY = "MALFORMED_CURRENCY"
NULL_REVENUE = "NULL_REVENUE"
NEGATIVE_REVENUE = "NEGATIVE_REVENUE"
NULL_EXPENSE = "NULL_EXPENSE"
NEGATIVE_EXPENSE = "NEGATIVE_EXPENSE"
INVALID_CURRENCY = "INVALID_CURRENCY"
INVALID_FX_RATE = "INVALID_FX_RATE"
SUPERSEDED_BY_CORRECTION = "SUPERSEDED_BY_CORRECTION"

# Currency spellings accepted in the revenue feed and their canonical code.
# Input is trimmed and upper-cased before the lookup, so only upper-case
# spellings can match.
CURRENCY_MAP = {
    "EUR": "EUR", "EURO": "EUR",
    "USD": "USD", "USDD": "USD",
    "GBP": "GBP", "GBR": "GBP",
    "INR": "INR", "INRR": "INR",
    "AED": "AED", "AEDX": "AED",
    "CAD": "CAD",
    "SGD": "SGD",
    "CHF": "CHF",
}

# Text that the CSV reader of the source system treats as a missing value
# (the pandas default NA tokens).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# Audit stages and statuses.
STAGE_BRONZE = "BRONZE"
STAGE_SILVER = "SILVER"
STAGE_QUARANTINE = "QUARANTINE"
STAGE_GOLDEN = "GOLDEN"
STATUS_SUCCESS = "SUCCESS"
STATUS_FAILURE = "FAILURE"
ERROR_TEXT_LIMIT = 2000

# ---------------------------------------------------------------------------
# Reasons this engine adds (departures D4 in the blueprint): a NULL or blank
# merge key can never match itself, so such rows are quarantined instead of
# reaching Golden. Disabled in compatibility mode.
# ---------------------------------------------------------------------------
INVALID_MONTH = "INVALID_MONTH"
INVALID_DATE = "INVALID_DATE"
# Only under on_conflict="newest" (departure D7): the row is older than the stored one.
OLDER_THAN_STORED = "OLDER_THAN_STORED"

# Column names used across the engine.
REASON = "quarantine_reason"
ROW_ORD = "row_ord"
ROW_ID = "_row_id"
LOADED_AT = "pipeline_loaded_at"
LOAD_UUID = "pipeline_load_uuid"
ZONE = "zone"
ZONE_SILVER = "silver"
ZONE_QUARANTINE = "quarantine"
YEAR = "fact_year"  # partition column of the fact's folders

# The column names of the Golden and audit tables are those of the source system.
DIM_COMPANY = T.StructType([
    T.StructField("company_id", T.StringType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("industry", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("created_at", T.TimestampType(), True),
    T.StructField("pipeline_loaded_at", T.TimestampType(), True),
    T.StructField("pipeline_load_uuid", T.StringType(), True),
])

FACT_FINANCIALS = T.StructType([
    T.StructField("company_id", T.StringType(), False),
    T.StructField("month", T.StringType(), False),
    T.StructField("revenue", T.DoubleType(), True),
    T.StructField("expenses", T.DoubleType(), True),
    T.StructField("currency", T.StringType(), True),
    T.StructField("gross_profit", T.DoubleType(), True),
    T.StructField("gross_margin_pct", T.DoubleType(), True),
    T.StructField("mom_revenue_growth_pct", T.DoubleType(), True),
    T.StructField("rolling_3m_revenue", T.DoubleType(), True),
    T.StructField("revenue_updated_at", T.DateType(), True),
    T.StructField("expenses_updated_at", T.DateType(), True),
    T.StructField("revenue_pipeline_loaded_at", T.TimestampType(), True),
    T.StructField("expense_pipeline_loaded_at", T.TimestampType(), True),
    T.StructField("revenue_pipeline_load_uuid", T.StringType(), True),
    T.StructField("expense_pipeline_load_uuid", T.StringType(), True),
    T.StructField("updated_at", T.TimestampType(), True),
])

FX_RATE = T.StructType([
    T.StructField("local_currency", T.StringType(), False),
    T.StructField("base_currency", T.StringType(), False),
    T.StructField("date", T.StringType(), False),
    T.StructField("fx_rate", T.DoubleType(), False),
    T.StructField("created_at", T.TimestampType(), True),
    T.StructField("updated_at", T.TimestampType(), True),
])

DATALOAD_AUDIT = T.StructType([
    T.StructField("entity", T.StringType(), True),
    T.StructField("file_name", T.StringType(), True),
    T.StructField("load_uuid", T.StringType(), True),
    T.StructField("stage", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("row_count", T.LongType(), True),
    T.StructField("error_msg", T.StringType(), True),
    T.StructField("run_at", T.TimestampType(), True),
])

METRIC_COLUMNS = ["gross_profit", "gross_margin_pct", "mom_revenue_growth_pct", "rolling_3m_revenue"]
