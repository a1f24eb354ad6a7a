"""Registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

All of them read the shared tables (or tables Spark derives from them) in
full. Column names match the SQL twins in ``oracle_sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.functions import normalise as N
from ledgerline.operators.convert import missing_rates, to_base_currency
from ledgerline.operators.classify import KNOWN, flag_known, orphan_rows
from ledgerline.operators.merge import ACTION, merge_counts
from ledgerline.operators.metrics import metrics_summary as _metrics_summary
from ledgerline.operators.report import reason_breakdown, report_projection, zone_counts
from ledgerline.plans import derived as D
from ledgerline.plans import golden as G
from ledgerline.plans import read as R
from ledgerline.plans.cleanse import cleanse, with_zone
from ledgerline.plans.entities import COMPANY, EXPENSE, FX, REVENUE
from ledgerline.plans.oracle_sql import UUID2, UUID_FX2
from ledgerline.session import apply_required_conf, new_run_dir
from ledgerline.sources import fixtures as X
from ledgerline.sources.csv import read_feed, write_feed
from ledgerline.sources.handoff import hand_off, read_hand_off

ENTITIES = ("company", "revenue", "expense", "fx_rate")
ONE_COMPANY = "7"


def _fmt_date(c):
    return F.date_format(c, "yyyy-MM-dd")


# --- scalar functions ---------------------------------------------------------

def stamp_load(spark, sf):
    c = X.table(spark, sf, "customer").select("c_custkey", "c_name")
    s = G.stamp(c, D.RUN_AT, D.RUN_UUID["company"])
    return s.select("c_custkey", "c_name", S.LOAD_UUID,
                    F.date_format(S.LOADED_AT, "yyyy-MM-dd HH:mm:ss").alias(S.LOADED_AT))


def normalise_keys(spark, sf):
    k = F.col("c_custkey")
    ks = k.cast("string")
    text = (F.when(k % 6 == 0, F.concat(F.lit("00"), ks))
             .when(k % 6 == 1, F.concat(F.lit(" "), ks, F.lit(" ")))
             .when(k % 6 == 2, F.concat(ks, F.lit(".0")))
             .when(k % 6 == 3, F.concat(F.lit("C"), ks))
             .when(k % 6 == 4, F.concat(ks, F.lit("e0")))
             .otherwise(F.concat(ks, F.lit(".5"))))
    c = X.table(spark, sf, "customer").select("c_custkey").withColumn("key_text", text)
    return c.select("c_custkey", "key_text", N.int_key(F.col("key_text")).alias("company_id"))


def normalise_text(spark, sf):
    n = COMPANY.normalise(D.raw(spark, sf, "company"), D.CleansePolicy())
    return n.select(S.ROW_ORD, "name", "industry", "country")


def coerce_numeric(spark, sf):
    k = F.get_json_object("props", "$.k")
    i = F.col("event_id") % 6
    text = (F.when(i == 0, k).when(i == 1, F.concat(F.lit(" "), k, F.lit(" ")))
             .when(i == 2, F.concat(k, F.lit(".25"))).when(i == 3, F.concat(k, F.lit("d")))
             .when(i == 4, F.concat(k, F.lit("e1"))).otherwise(F.lit("NaN")))
    e = X.table(spark, sf, "events").select("event_id", text.alias("value_text"))
    return e.select("event_id", "value_text", N.to_double(F.col("value_text")).alias("value_num"))


def coerce_timestamp(spark, sf):
    i = F.col("event_id") % 7
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = (F.when(i == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
             .when(i == 1, iso)
             .when(i == 2, F.date_format("ts", "yyyy-MM-dd"))
             .when(i == 3, F.concat(iso, F.lit("+05:30")))
             .when(i == 4, F.concat(iso, F.lit("Z")))
             .when(i == 5, F.concat(iso, F.lit("-0800")))
             .otherwise(F.lit("not a time")))
    e = X.table(spark, sf, "events").select("event_id", text.alias("ts_text"))
    return e.select("event_id", "ts_text",
                    F.date_format(N.to_timestamp(F.col("ts_text")), "yyyy-MM-dd HH:mm:ss").alias("ts_parsed"))


def currency_normalise(spark, sf):
    r = D.raw(spark, sf, "revenue")
    return r.select(S.ROW_ORD, N.currency_text(F.col("currency")).alias("currency_text"),
                    N.currency_code(F.col("currency")).alias("currency_code"))


def month_parse(spark, sf):
    i = F.col("o_orderkey") % 4
    text = (F.when(i == 0, F.date_format("o_orderdate", "yyyy-MM"))
             .when(i == 1, F.date_format("o_orderdate", "yyyy-M"))
             .when(i == 2, F.date_format("o_orderdate", "yyyy/MM"))
             .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    o = X.table(spark, sf, "orders").select("o_orderkey", text.alias("month_text"))
    return o.select("o_orderkey", "month_text", _fmt_date(N.month_start(F.col("month_text"))).alias("month_start"))


def sanitise_floats(spark, sf):
    li = X.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    ratio = (F.when((F.col("l_tax") == 0) & (F.col("l_discount") == 0), F.lit(float("nan")))
              .when(F.col("l_tax") == 0, F.lit(float("inf")))
              .otherwise(F.col("l_discount") / F.col("l_tax")))
    return li.select("l_orderkey", "l_linenumber", N.finite_or_null(ratio).alias("ratio"))


# --- referential check ----------------------------------------------------------

def _revenue_normalised(spark, sf):
    return REVENUE.normalise(D.raw(spark, sf, "revenue"), D.CleansePolicy())


def orphan_check(spark, sf):
    n = flag_known(_revenue_normalised(spark, sf), D.dim_keys(spark, sf), "company_id")
    return n.select(S.ROW_ORD, "company_id", F.col(KNOWN).alias("known"))


def orphan_rows_q(spark, sf):
    return orphan_rows(_revenue_normalised(spark, sf), D.dim_keys(spark, sf), "company_id") \
        .select(S.ROW_ORD, "company_id")


# --- classification and dedup --------------------------------------------------

def _classify(spec, cols):
    def q(spark, sf):
        return D.ruled(spark, sf, spec).select(*cols, S.REASON)
    return q


def _dedup(entity, cols):
    def q(spark, sf):
        return D.classified(spark, sf, entity).select(*cols, S.REASON)
    return q


def zone_split(spark, sf):
    return with_zone(D.classified(spark, sf, "revenue")).select(S.ROW_ORD, S.ZONE)


def _all_classified(spark, sf, cols):
    out = None
    for e in ENTITIES:
        c = D.classified(spark, sf, e).withColumn("entity", F.lit(e))
        c = c.select(*[F.col(x) if x in c.columns else F.lit(None).cast("string").alias(x) for x in cols])
        out = c if out is None else out.unionByName(c)
    return out


def quarantine_union(spark, sf):
    cols = ["entity", S.ROW_ORD, "company_id", "month", S.REASON]
    frames = []
    for e in ENTITIES:
        c = D.classified(spark, sf, e).where(F.col(S.REASON).isNotNull())
        frames.append(c.select(F.lit(e).alias("entity"), *[x for x in cols[1:] if x in c.columns]))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.select(*cols)


def quarantine_breakdown(spark, sf):
    return reason_breakdown(_all_classified(spark, sf, ["entity", S.REASON]), by=["entity"])


def quarantine_report(spark, sf):
    c = D.classified(spark, sf, "revenue").where(F.col(S.REASON).isNotNull())
    return report_projection(c, REVENUE)


def zone_counts_q(spark, sf):
    return zone_counts(_all_classified(spark, sf, ["entity", S.REASON]), by=["entity"])


def distinct_keys(spark, sf):
    return (_revenue_normalised(spark, sf).select("company_id")
            .where(F.col("company_id").isNotNull()).distinct())


# --- merges ---------------------------------------------------------------------

def _company_merged(spark, sf):
    b2 = G.stamp(D.with_row_id(X.company_batch2(spark, sf)), D.RUN_AT, UUID2)
    clean2 = cleanse(b2, COMPANY).where(F.col(S.REASON).isNull())
    return G.merge_company(D.company_dim(spark, sf), clean2, D.RUN_AT, with_action=True)


def company_upsert(spark, sf):
    return _company_merged(spark, sf).select("company_id", "name", "industry", "country", S.LOAD_UUID)


def company_upsert_counts(spark, sf):
    return merge_counts(_company_merged(spark, sf))


def fact_upsert(spark, sf):
    f = D.fact_table(spark, sf, with_metrics=False)
    return f.select("company_id", "month", "revenue", "expenses", "currency",
                    _fmt_date("revenue_updated_at").alias("revenue_updated_at"),
                    _fmt_date("expenses_updated_at").alias("expenses_updated_at"),
                    "revenue_pipeline_load_uuid", "expense_pipeline_load_uuid")


def fact_upsert_counts(spark, sf):
    empty = G.empty(spark, S.FACT_FINANCIALS)
    f1 = G.merge_revenue(empty, D.clean(spark, sf, "revenue"), D.RUN_AT, with_action=True, scoped=False)
    c1 = merge_counts(f1).select(F.lit("revenue").alias("step"), "*")
    f2 = G.merge_expense(f1.drop(ACTION), D.clean(spark, sf, "expense"), D.RUN_AT, with_action=True, scoped=False)
    c2 = merge_counts(f2).select(F.lit("expense").alias("step"), "*")
    return c1.unionByName(c2)


def fx_upsert(spark, sf):
    b2 = G.stamp(D.with_row_id(X.fx_batch2(spark, sf)), D.RUN_AT, UUID_FX2)
    clean2 = cleanse(b2, FX).where(F.col(S.REASON).isNull())
    return G.merge_fx(D.fx_table(spark, sf), clean2, D.RUN_AT) \
        .select("local_currency", "base_currency", "date", "fx_rate")


def fk_violations(spark, sf):
    f = D.fact_table(spark, sf, with_metrics=False).select("company_id")
    bad = f.join(D.dim_keys(spark, sf), "company_id", "left_anti")
    return bad.agg(F.count(F.lit(1)).alias("violations"))


# --- metrics --------------------------------------------------------------------

METRIC_OUT = ["company_id", "month", "revenue", "expenses", "gross_profit", "gross_margin_pct",
              "mom_revenue_growth_pct", "rolling_3m_revenue"]


def _metric_cols():
    return [F.round("rolling_3m_revenue", 2).alias("rolling_3m_revenue") if c == "rolling_3m_revenue"
            else F.col(c) for c in METRIC_OUT]


def fin_metrics(spark, sf):
    return D.fact_table(spark, sf).select(*_metric_cols())


def fin_metrics_spread(spark, sf):
    """The metrics by ranges of (company, month) with halo rows."""
    return G.merge_metrics(D.fact_table(spark, sf, with_metrics=False), spread=True).select(*_metric_cols())


def fin_metrics_one(spark, sf):
    f = D.fact_table(spark, sf, with_metrics=False)
    return G.merge_metrics(f, ONE_COMPANY).select(*_metric_cols())


def metrics_summary(spark, sf):
    return _metrics_summary(D.fact_table(spark, sf))


# --- filtered reads -------------------------------------------------------------

def read_company(spark, sf):
    return R.read_company(D.company_dim(spark, sf), industry="build", country="tion_1") \
        .select("company_id", "name", "industry", "country")


def read_revenue(spark, sf):
    return R.read_revenue(D.fact_table(spark, sf, with_metrics=False), currency="usd") \
        .select("company_id", "month", "revenue", "currency")


def read_expense(spark, sf):
    return R.read_expense(D.fact_table(spark, sf, with_metrics=False), month="1997-06") \
        .select("company_id", "month", "expenses")


def read_financials(spark, sf):
    f = R.read_financials(D.fact_table(spark, sf), currency="eur")
    return f.select("company_id", "month", "revenue", "expenses", "currency", "gross_profit",
                    "gross_margin_pct", "mom_revenue_growth_pct",
                    F.round("rolling_3m_revenue", 2).alias("rolling_3m_revenue"))


def read_fx(spark, sf):
    return R.read_fx(D.fx_table(spark, sf), local_currency="eur", base_currency="usd") \
        .select("local_currency", "base_currency", "date", "fx_rate")


# --- staged loads (CSV -> Bronze -> zones -> Golden) ------------------------------

def _run(spark, sf):
    from ledgerline.plans.staged import staged_run
    return staged_run(spark, sf)


def load_company(spark, sf):
    return _run(spark, sf)["dim_company"].select("company_id", "name", "industry", "country")


def load_revenue(spark, sf):
    return _run(spark, sf)["fact_after_revenue"].select("company_id", "month", "revenue", "currency")


def load_expense(spark, sf):
    return _run(spark, sf)["fact_after_expense"].select("company_id", "month", "revenue", "expenses", "currency")


def load_fx(spark, sf):
    return _run(spark, sf)["fx_rate"].select("local_currency", "base_currency", "date", "fx_rate")


def audit_log(spark, sf):
    return _run(spark, sf)["audit"].select("entity", "stage", "status", "row_count")


def audit_query(spark, sf):
    from ledgerline.plans.audit import read_audit
    run = _run(spark, sf)
    return read_audit(spark, run["audit_path"], entity="revenue", status="success") \
        .select("entity", "stage", "status", "row_count")


def load_metrics(spark, sf):
    """The fact after the metrics run over all companies."""
    return _run(spark, sf)["fact_after_metrics"].select(*_metric_cols())


def load_metrics_one(spark, sf):
    """The fact after the metrics run for one company, before the full run."""
    return _run(spark, sf)["fact_after_one"].select(*_metric_cols())


def metrics_run(spark, sf):
    """What the two metrics runs reported about their scope."""
    rows = [(scope, m["status"], m["message"], m["total_rows"], m["eligible_rows"], m["updated_rows"]) for scope, m in _run(spark, sf)["metrics"].items()]
    return spark.createDataFrame(rows, "scope string, status string, message string, total_rows long, eligible_rows long, updated_rows long")


def scan_quoted(spark, sf):
    """A feed with quotes, commas and newlines in its fields, written as CSV
    files and scanned back."""
    path = f"{new_run_dir(spark, 'quoted')}/company.csv"
    write_feed(X.company_quoted(spark, sf), path, order_by="row_ord")
    return read_feed(spark, path).select("company_id", "name", "industry", "country")


def late_records(spark, sf):
    """A second revenue feed under the newest-wins rule: what happens to each
    row of the fact."""
    b2 = G.stamp(D.with_row_id(X.revenue_batch2(spark, sf)), D.RUN_AT, UUID2)
    clean2 = cleanse(b2, REVENUE, D.dim_keys(spark, sf)).where(F.col(S.REASON).isNull())
    fact = G.merge_revenue(G.empty(spark, S.FACT_FINANCIALS), D.clean(spark, sf, "revenue"), D.RUN_AT, scoped=False)
    merged = G.merge_revenue(fact, clean2, D.RUN_AT, with_action=True, scoped=False, on_conflict="newest")
    return merged.select("company_id", "month", "revenue", _fmt_date("revenue_updated_at").alias("revenue_updated_at"), F.col(ACTION).alias("action"))


def fact_as_json(spark, sf):
    """The fact as JSON rows, read back: its keys in order and its values (the
    two engines write floats differently, so text is not compared)."""
    j = R.as_json(D.fact_table(spark, sf))
    kinds = {f.name: f.dataType.typeName() for f in S.FACT_FINANCIALS.fields}
    # json_tuple parses a row once for all of its keys.
    read = j.select(F.array_join(F.json_object_keys("json"), ",").alias("json_keys"), F.json_tuple("json", *kinds).alias(*kinds))
    value = {c: F.col(c).cast("double") if k == "double" else F.col(c) for c, k in kinds.items()}
    value["rolling_3m_revenue"] = F.round(value["rolling_3m_revenue"], 2)
    return read.select("json_keys", *[v.alias(c) for c, v in value.items()])


def fact_in_base(spark, sf):
    """The fact in US dollars, at the rate last known in each row's month."""
    return to_base_currency(D.fact_table(spark, sf), D.fx_table(spark, sf), "usd").select(
        "company_id", "month", "currency", "rate", "rate_date", "revenue_base", "expenses_base", "gross_profit_base")


def missing_rate_counts(spark, sf):
    """Rows of the fact, and those without a rate into US dollars, by currency."""
    return missing_rates(to_base_currency(D.fact_table(spark, sf), D.fx_table(spark, sf)))


def hand_off_round_trip(spark, sf):
    """All quarantined rows, handed off as ordered CSV files and read back."""
    folder = f"{new_run_dir(spark, 'handoff')}/quarantine"
    rows = quarantine_union(spark, sf).withColumnRenamed(S.ROW_ORD, "seq")  # a feed read back has its own row_ord
    hand_off(rows, folder, order_by=["entity", "seq"])
    back = read_hand_off(spark, folder)
    return back.select("entity", F.col("seq").cast("bigint").alias(S.ROW_ORD), "company_id", "month", S.REASON)


def _wrap(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_required_conf(spark)
        return fn(spark, sf_dir)
    q.__name__ = fn.__name__
    q.__doc__ = fn.__doc__
    return q


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _wrap(v) for k, v in {
    "stamp_load": stamp_load,
    "normalise_keys": normalise_keys,
    "normalise_text": normalise_text,
    "coerce_numeric": coerce_numeric,
    "coerce_timestamp": coerce_timestamp,
    "currency_normalise": currency_normalise,
    "month_parse": month_parse,
    "sanitise_floats": sanitise_floats,
    "orphan_check": orphan_check,
    "orphan_rows": orphan_rows_q,
    "classify_company": _classify(COMPANY, [S.ROW_ORD, "company_id"]),
    "classify_revenue": _classify(REVENUE, [S.ROW_ORD, "company_id", "month"]),
    "classify_expense": _classify(EXPENSE, [S.ROW_ORD, "company_id", "month"]),
    "classify_fx": _classify(FX, [S.ROW_ORD, "local_currency", "base_currency", "date"]),
    "dedup_company": _dedup("company", [S.ROW_ORD, "company_id", "name"]),
    "dedup_revenue": _dedup("revenue", [S.ROW_ORD, "company_id", "month", "currency"]),
    "dedup_expense": _dedup("expense", [S.ROW_ORD, "company_id", "month", "expenses"]),
    "dedup_fx": _dedup("fx_rate", [S.ROW_ORD, "local_currency", "base_currency", "date", "fx_rate"]),
    "zone_split": zone_split,
    "quarantine_union": quarantine_union,
    "quarantine_breakdown": quarantine_breakdown,
    "quarantine_report": quarantine_report,
    "zone_counts": zone_counts_q,
    "distinct_keys": distinct_keys,
    "company_upsert": company_upsert,
    "company_upsert_counts": company_upsert_counts,
    "fact_upsert": fact_upsert,
    "fact_upsert_counts": fact_upsert_counts,
    "fx_upsert": fx_upsert,
    "fk_violations": fk_violations,
    "fin_metrics": fin_metrics,
    "fin_metrics_one": fin_metrics_one,
    "fin_metrics_spread": fin_metrics_spread,
    "metrics_summary": metrics_summary,
    "read_company": read_company,
    "read_revenue": read_revenue,
    "read_expense": read_expense,
    "read_financials": read_financials,
    "read_fx": read_fx,
    "audit_log": audit_log,
    "audit_query": audit_query,
    "load_company": load_company,
    "load_revenue": load_revenue,
    "load_expense": load_expense,
    "load_fx": load_fx,
    "fact_as_json": fact_as_json,
    "hand_off_round_trip": hand_off_round_trip,
    "fact_in_base": fact_in_base,
    "missing_rate_counts": missing_rate_counts,
    "load_metrics": load_metrics,
    "load_metrics_one": load_metrics_one,
    "metrics_run": metrics_run,
    "scan_quoted": scan_quoted,
    "late_records": late_records,
}.items()}
