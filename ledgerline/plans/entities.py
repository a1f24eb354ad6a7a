"""One specification per feed: normalisers, rules, dedup order, Golden mapping.

A feed is cleansed by the same plan for every entity (see ``cleanse``):
normalise -> referential flag -> prioritised reason -> keep-latest among rows
without a reason. The spec only says which columns and rules apply.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import normalise as N
from ledgerline.operators.classify import KNOWN
from ledgerline.operators.dedup import OrderKey
from ledgerline.schemas import (INVALID_CURRENCY, INVALID_DATE, INVALID_FX_RATE, INVALID_MONTH,
                                MALFORMED_CURRENCY, NEGATIVE_EXPENSE, NEGATIVE_REVENUE,
                                NULL_COMPANY_ID, NULL_EXPENSE, NULL_REVENUE, ORPHAN_COMPANY_ID,
                                REASON, ROW_ORD, SUPERSEDED_BY_CORRECTION)


@dataclass(frozen=True)
class CleansePolicy:
    """Switches back to the source system's observed behaviour.

    compat: missing text becomes the string 'nan' (and 'NAN' for currencies)
        instead of NULL, and no INVALID_MONTH / INVALID_DATE reasons exist.
    null_updated_at: "loses" (a row with no timestamp never beats a dated
        one) or "wins" (the source system's sort puts it last, so it wins).
    on_conflict: "last" (a later load always overwrites, as the source
        system's code does) or "newest" (its documented rule: a record older
        than the stored one does not overwrite it).
    strict_months: also quarantine months that are not 'YYYY-MM' text
        (INVALID_MONTH). Then a company holds at most one fact row per
        calendar month, which bounds each metrics window partition.
    """

    compat: bool = False
    null_updated_at: str = "loses"
    on_conflict: str = "last"
    strict_months: bool = False


@dataclass(frozen=True)
class EntitySpec:
    name: str
    keys: tuple[str, ...]
    required: tuple[str, ...]
    optional: tuple[str, ...]
    report_cols: tuple[str, ...]
    reasons: tuple[str, ...]
    uses_dim: bool
    normalise: Callable[[DataFrame, CleansePolicy], DataFrame]
    rules: Callable[[CleansePolicy], list[tuple[Column, str]]]
    order: Callable[[CleansePolicy], list[OrderKey]]
    finish: Callable[[DataFrame], DataFrame] = field(default=lambda df: df)
    # Columns whose text is parsed into another type (raw text kept in Quarantine).
    parsed: tuple[str, ...] = ()


def _dtype(df: DataFrame, name: str):
    return df.schema[name].dataType


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(_dtype(df, name), T.StringType)


def _with_text(df: DataFrame, names, extra: dict | None = None) -> DataFrame:
    """Trimmed text (reader NA tokens -> NULL) of raw text columns, in its own
    projection: each parser reads it more than once, and Spark does not
    inline a non-trivial expression that is used several times, so the
    trimming runs once per value."""
    cols = {f"_t_{n}": N.strip_ws(N.na_to_null(F.col(n)))
            for n in names if n in df.columns and _is_text(df, n)}
    cols.update(extra or {})
    return df.withColumns(cols) if cols else df


def _project(t: DataFrame, df: DataFrame, values: dict) -> DataFrame:
    """One projection: the feed's columns (parsed ones replaced), new columns
    appended; the temporary text columns fall away."""
    cols = [values[c].alias(c) if c in values else F.col(c) for c in df.columns]
    return t.select(*cols, *[v.alias(k) for k, v in values.items() if k not in df.columns])


def _key(df: DataFrame, name: str) -> Column:
    if _is_text(df, name):
        return N.parse_int_key(F.col(f"_t_{name}"))
    return N.int_key(F.col(name), _dtype(df, name))


def _number(df: DataFrame, name: str) -> Column:
    if _is_text(df, name):
        return N.parse_double(F.col(f"_t_{name}"))
    return N.to_double(F.col(name), _dtype(df, name))


def _optional_ts(df: DataFrame, name: str) -> Column:
    if name in df.columns:
        return N.to_timestamp(F.col(name), _dtype(df, name))
    return F.lit(None).cast("timestamp_ntz")


def _orphan(known_col: str = KNOWN) -> Column:
    return F.col("company_id").isNull() | ~F.col(known_col)


def _blank(c: Column) -> Column:
    return c.isNull() | (c == "")


# --- company ---------------------------------------------------------------

def _company_normalise(df: DataFrame, p: CleansePolicy) -> DataFrame:
    t = _with_text(df, ["company_id"])
    return _project(t, df, {
        "company_id": _key(df, "company_id"),
        "name": N.clean_text(F.col("name"), p.compat),
        "industry": N.clean_text(F.col("industry"), p.compat),
        "country": N.clean_text(F.col("country"), p.compat),
        "created_at": _optional_ts(df, "created_at"),
    })


def _company_rules(p: CleansePolicy):
    return [(F.col("company_id").isNull(), NULL_COMPANY_ID)]


def _company_order(p: CleansePolicy):
    # Newest created_at first; ties keep the earliest row of the file.
    return [OrderKey("created_at", descending=True, nulls_last=True),
            OrderKey(ROW_ORD, descending=False)]


COMPANY = EntitySpec(
    name="company", keys=("company_id",),
    required=("company_id", "name", "industry", "country"), optional=("created_at",),
    report_cols=("company_id", "name", "industry", "country"),
    reasons=(NULL_COMPANY_ID, SUPERSEDED_BY_CORRECTION), uses_dim=False,
    normalise=_company_normalise, rules=_company_rules, order=_company_order,
    parsed=("company_id", "created_at"))


# --- revenue / expense -----------------------------------------------------

def _month(df: DataFrame, p: CleansePolicy) -> Column:
    return N.clean_text(F.col("month"), p.compat)


def _bad_month(p: CleansePolicy) -> Column:
    bad = _blank(F.col("month"))
    return bad | ~F.col("month").rlike(N.MONTH_PATTERN) if p.strict_months else bad


def _updated_order(p: CleansePolicy):
    # Newest updated_at first, ties: the later row of the file wins.
    return [OrderKey("updated_at", descending=True, nulls_last=(p.null_updated_at != "wins")),
            OrderKey(ROW_ORD, descending=True)]


def _revenue_normalise(df: DataFrame, p: CleansePolicy) -> DataFrame:
    t = _with_text(df, ["company_id", "revenue"], {"_t_currency": N.currency_text(F.col("currency"))})
    cur = F.col("_t_currency")
    return _project(t, df, {
        "company_id": _key(df, "company_id"),
        "month": _month(df, p),
        "revenue": _number(df, "revenue"),
        "currency": F.coalesce(cur, F.lit("NAN")) if p.compat else cur,
        "_currency_code": N.currency_lookup(cur),
        "updated_at": _optional_ts(df, "updated_at"),
    })


def _revenue_rules(p: CleansePolicy):
    rules = [(_orphan(), ORPHAN_COMPANY_ID),
             (F.col("_currency_code").isNull(), MALFORMED_CURRENCY),
             (F.col("revenue").isNull(), NULL_REVENUE),
             (F.col("revenue") < 0, NEGATIVE_REVENUE)]
    if not p.compat:
        rules.append((_bad_month(p), INVALID_MONTH))
    return rules


def _revenue_finish(df: DataFrame) -> DataFrame:
    # Canonical code on rows that passed the value rules (clean or superseded).
    keep_code = F.col(REASON).isNull() | (F.col(REASON) == SUPERSEDED_BY_CORRECTION)
    return (df.withColumn("currency", F.when(keep_code, F.col("_currency_code"))
                                       .otherwise(F.col("currency")))
              .drop("_currency_code"))


REVENUE = EntitySpec(
    name="revenue", keys=("company_id", "month"),
    required=("company_id", "month", "revenue", "currency"), optional=("updated_at",),
    report_cols=("company_id", "month", "revenue", "currency"),
    reasons=(ORPHAN_COMPANY_ID, MALFORMED_CURRENCY, NULL_REVENUE, NEGATIVE_REVENUE,
             INVALID_MONTH, SUPERSEDED_BY_CORRECTION),
    uses_dim=True, normalise=_revenue_normalise, rules=_revenue_rules,
    order=_updated_order, finish=_revenue_finish,
    parsed=("company_id", "revenue", "currency", "updated_at"))


def _expense_normalise(df: DataFrame, p: CleansePolicy) -> DataFrame:
    t = _with_text(df, ["company_id", "expenses"])
    return _project(t, df, {
        "company_id": _key(df, "company_id"),
        "month": _month(df, p),
        "expenses": _number(df, "expenses"),
        "updated_at": _optional_ts(df, "updated_at"),
    })


def _expense_rules(p: CleansePolicy):
    rules = [(_orphan(), ORPHAN_COMPANY_ID),
             (F.col("expenses").isNull(), NULL_EXPENSE),
             (F.col("expenses") < 0, NEGATIVE_EXPENSE)]
    if not p.compat:
        rules.append((_bad_month(p), INVALID_MONTH))
    return rules


EXPENSE = EntitySpec(
    name="expense", keys=("company_id", "month"),
    required=("company_id", "month", "expenses"), optional=("updated_at",),
    report_cols=("company_id", "month", "expenses"),
    reasons=(ORPHAN_COMPANY_ID, NULL_EXPENSE, NEGATIVE_EXPENSE, INVALID_MONTH,
             SUPERSEDED_BY_CORRECTION),
    uses_dim=True, normalise=_expense_normalise, rules=_expense_rules, order=_updated_order,
    parsed=("company_id", "expenses", "updated_at"))


# --- fx_rate ---------------------------------------------------------------

def _fx_normalise(df: DataFrame, p: CleansePolicy) -> DataFrame:
    def code(name):
        c = N.currency_text(F.col(name))
        return F.coalesce(c, F.lit("NAN")) if p.compat else c
    t = _with_text(df, ["fx_rate"])
    return _project(t, df, {
        "local_currency": code("local_currency"),
        "base_currency": code("base_currency"),
        "date": N.clean_text(F.col("date"), p.compat),
        "fx_rate": _number(df, "fx_rate"),
    })


def _fx_rules(p: CleansePolicy):
    rules = [(_blank(F.col("local_currency")) | _blank(F.col("base_currency")), INVALID_CURRENCY),
             (F.col("fx_rate").isNull() | (F.col("fx_rate") <= 0), INVALID_FX_RATE)]
    if not p.compat:
        rules.append((_blank(F.col("date")), INVALID_DATE))
    return rules


def _fx_order(p: CleansePolicy):
    # The date is part of the key, so every duplicate ties: the last row wins.
    return [OrderKey(ROW_ORD, descending=True)]


FX = EntitySpec(
    name="fx_rate", keys=("local_currency", "base_currency", "date"),
    required=("local_currency", "base_currency", "date", "fx_rate"), optional=(),
    report_cols=("local_currency", "base_currency", "date", "fx_rate"),
    reasons=(INVALID_CURRENCY, INVALID_FX_RATE, INVALID_DATE, SUPERSEDED_BY_CORRECTION),
    uses_dim=False, normalise=_fx_normalise, rules=_fx_rules, order=_fx_order,
    parsed=("local_currency", "base_currency", "fx_rate"))


SPECS = {s.name: s for s in (COMPANY, REVENUE, EXPENSE, FX)}
SPECS["fx"] = FX
