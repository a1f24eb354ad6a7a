"""Filtered reads of the Golden tables (lazy DataFrames; filters reach the scan).

Filter semantics of the source system: ``company_id`` filters apply when
not None; every other filter applies only when truthy, so an empty string
means "no filter". Currency arguments are upper-cased.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.normalise import finite_or_null, iso_text
from ledgerline.schemas import YEAR


def _eq(df: DataFrame, col: str, value, upper: bool = False, when_truthy: bool = True) -> DataFrame:
    if (value if when_truthy else value is not None):
        v = str(value).upper() if upper else str(value)
        return df.where(F.col(col) == v)
    return df


ODD_YEAR = "other"


def fact_year(month: Column) -> Column:
    """The partition of the fact that holds a month: its year, or "other" for
    text that is no month."""
    return F.when(month.rlike(r"^[0-9]{4}-[0-9]{1,2}$"), F.substring(month, 1, 4)).otherwise(F.lit(ODD_YEAR))


def _month(df: DataFrame, month) -> DataFrame:
    """Rows of a month; of a fact with its partition column only the folder
    that can hold them is read."""
    if month and YEAR in df.columns:
        df = df.where(F.col(YEAR) == fact_year(F.lit(str(month))))
    return _eq(df, "month", month)


def read_company(dim: DataFrame, company_id=None, name=None, industry=None, country=None) -> DataFrame:
    df = _eq(dim, "company_id", company_id, when_truthy=False)
    for col, v in (("name", name), ("industry", industry), ("country", country)):
        if v:
            # '%' and '_' inside the argument stay wildcards, as in the source system.
            df = df.where(F.col(col).ilike(f"%{v}%"))
    return df


def read_revenue(fact: DataFrame, company_id=None, month=None, currency=None) -> DataFrame:
    df = _eq(fact, "company_id", company_id, when_truthy=False)
    df = _month(df, month)
    return _eq(df, "currency", currency, upper=True)


def read_expense(fact: DataFrame, company_id=None, month=None) -> DataFrame:
    return _month(_eq(fact, "company_id", company_id, when_truthy=False), month)


def read_financials(fact: DataFrame, company_id=None, month=None, currency=None) -> DataFrame:
    return read_revenue(fact, company_id, month, currency)


def read_fx(fx: DataFrame, local_currency=None, base_currency=None, date=None) -> DataFrame:
    df = _eq(fx, "local_currency", local_currency, upper=True)
    df = _eq(df, "base_currency", base_currency, upper=True)
    return _eq(df, "date", date)


def sanitised(df: DataFrame) -> DataFrame:
    """NaN / Inf doubles shown as NULL (API output form)."""
    out = [finite_or_null(F.col(f.name)).alias(f.name) if f.dataType.typeName() in ("double", "float")
           else F.col(f.name) for f in df.schema.fields]
    return df.select(*out)


def as_json(df: DataFrame) -> DataFrame:
    """One JSON object per row with every key, NULL as ``null``; dates and
    timestamps in ISO-8601 text, with microseconds when there are any."""
    cols = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t == "date":
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        elif t in ("timestamp", "timestamp_ntz"):
            cols.append(iso_text(F.col(f.name)).alias(f.name))
        elif t in ("double", "float"):
            cols.append(finite_or_null(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("json"))
