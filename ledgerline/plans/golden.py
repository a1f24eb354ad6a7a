"""Projection of clean rows onto the Golden tables and the keyed merges."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.operators.merge import merge
from ledgerline.operators.metrics import recompute_scope


def run_columns(loaded_at: datetime, load_uuid: str) -> dict[str, Column]:
    """The load stamp: one instant and one id per run, made on the driver once."""
    return {S.LOADED_AT: F.lit(loaded_at).cast("timestamp"), S.LOAD_UUID: F.lit(load_uuid)}


def stamp(df: DataFrame, loaded_at: datetime, load_uuid: str) -> DataFrame:
    return df.withColumns(run_columns(loaded_at, load_uuid))


def empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def stored_time(updated_at: Column) -> Column:
    """What Golden keeps of a feed's ``updated_at``: its date."""
    return updated_at.cast("date")


# --- source projections (only the columns each feed owns) -------------------

def company_source(clean: DataFrame) -> DataFrame:
    return clean.select("company_id", "name", "industry", "country", S.LOADED_AT, S.LOAD_UUID)


def revenue_source(clean: DataFrame) -> DataFrame:
    return clean.select("company_id", "month", "revenue", "currency",
                        stored_time(F.col("updated_at")).alias("revenue_updated_at"),
                        F.col(S.LOADED_AT).alias("revenue_pipeline_loaded_at"),
                        F.col(S.LOAD_UUID).alias("revenue_pipeline_load_uuid"))


def expense_source(clean: DataFrame) -> DataFrame:
    return clean.select("company_id", "month", "expenses",
                        stored_time(F.col("updated_at")).alias("expenses_updated_at"),
                        F.col(S.LOADED_AT).alias("expense_pipeline_loaded_at"),
                        F.col(S.LOAD_UUID).alias("expense_pipeline_load_uuid"))


def fx_source(clean: DataFrame) -> DataFrame:
    return clean.select("local_currency", "base_currency", "date", "fx_rate")


# --- merges ------------------------------------------------------------------

def merge_company(dim: DataFrame, clean: DataFrame, run_at: datetime, with_action=False) -> DataFrame:
    return merge(dim, company_source(clean), ["company_id"],
                 ["name", "industry", "country", S.LOADED_AT, S.LOAD_UUID],
                 insert_values={"created_at": F.lit(run_at).cast("timestamp")},
                 with_action=with_action)


REVENUE_COLS = ["revenue", "currency", "revenue_updated_at", "revenue_pipeline_loaded_at",
                "revenue_pipeline_load_uuid"]
EXPENSE_COLS = ["expenses", "expenses_updated_at", "expense_pipeline_loaded_at",
                "expense_pipeline_load_uuid"]


def merge_revenue(fact: DataFrame, clean: DataFrame, run_at: datetime, with_action=False,
                  scoped: bool = True, on_conflict: str = "last") -> DataFrame:
    """``scoped``: only the months present in the feed take part in the join
    (pass False when the fact is known to be empty). ``on_conflict``: "last"
    (the latest load wins) or "newest" (an older record never overwrites a
    newer stored one)."""
    newer = ("revenue_updated_at", "revenue_updated_at") if on_conflict == "newest" else None
    return merge(fact, revenue_source(clean), ["company_id", "month"], REVENUE_COLS,
                 set_values={"updated_at": F.lit(run_at).cast("timestamp")},
                 with_action=with_action, scope="month" if scoped else None, newer=newer)


def merge_expense(fact: DataFrame, clean: DataFrame, run_at: datetime, with_action=False,
                  scoped: bool = True, on_conflict: str = "last") -> DataFrame:
    newer = ("expenses_updated_at", "expenses_updated_at") if on_conflict == "newest" else None
    return merge(fact, expense_source(clean), ["company_id", "month"], EXPENSE_COLS,
                 set_values={"updated_at": F.lit(run_at).cast("timestamp")},
                 with_action=with_action, scope="month" if scoped else None, newer=newer)


def merge_fx(fx: DataFrame, clean: DataFrame, run_at: datetime, with_action=False) -> DataFrame:
    ts = F.lit(run_at).cast("timestamp")
    return merge(fx, fx_source(clean), ["local_currency", "base_currency", "date"], ["fx_rate"],
                 insert_values={"created_at": ts, "updated_at": ts}, with_action=with_action)


def merge_metrics(fact: DataFrame, company_id: str | None = None, spread: bool = False) -> DataFrame:
    """Metrics are a pure function of the fact: the new table is the recomputed one."""
    return recompute_scope(fact, company_id, spread)
