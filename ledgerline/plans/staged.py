"""A full staged run over the derived feeds: CSV hand-off files in, Golden out.

The four derived feeds are written as CSV text (in their row order, without
the order column, so the loader has to recover the order from the file
position) and loaded in dependency order: company, revenue, expense, fx.
Everything lives under a fresh folder of the shared workspace.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerline.plans.audit import read_audit
from ledgerline.plans.loader import calculate_metrics, load_entity, read_golden
from ledgerline.session import new_run_dir
from ledgerline.sources import fixtures as X
from ledgerline.sources import fs
from ledgerline.sources.csv import write_feed
from ledgerline.sources.store import Store

_RUNS: dict[tuple, dict] = {}
_INPUTS = ("customer", "nation", "orders", "lineitem", "events")
METRICS_COMPANY = "7"


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Times of change of the input tables: changed input is loaded anew."""
    return tuple(fs.modified(spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in _INPUTS)


def write_feeds(spark: SparkSession, sf_dir: str, folder: str) -> dict[str, str]:
    paths = {}
    for entity, build in X.RAW_FEEDS.items():
        path = f"{folder}/incoming/{entity}.csv"
        write_feed(build(spark, sf_dir), path, order_by="row_ord")
        paths[entity] = path
    return paths


def staged_run(spark: SparkSession, sf_dir: str) -> dict:
    """Run once per application, folder and state of its tables; the registered
    queries over one run (the four loads, the metrics, the audit) share it."""
    key = (spark.sparkContext.applicationId, sf_dir, _state(spark, sf_dir))
    if key in _RUNS:
        return _RUNS[key]
    folder = new_run_dir(spark, "staged")
    store = Store(spark, folder)
    paths = write_feeds(spark, sf_dir, folder)
    results = {}
    for entity in ("company", "revenue", "expense", "fx_rate"):
        results[entity] = load_entity(spark, store, entity, paths[entity])
    fact = "fact_company_monthly_financials"
    one = calculate_metrics(spark, store, METRICS_COMPANY)
    everyone = calculate_metrics(spark, store)
    out = {
        "metrics": {"one": one, "all": everyone},
        "fact_after_one": read_golden(store, fact, version=one["version"]) if "version" in one else read_golden(store, fact),
        "fact_after_metrics": read_golden(store, fact),
        "folder": folder,
        "results": results,
        "dim_company": read_golden(store, "dim_company"),
        "fact_after_revenue": read_golden(store, fact, version=results["revenue"].load_uuid),
        "fact_after_expense": read_golden(store, fact, version=results["expense"].load_uuid),
        "fx_rate": read_golden(store, "fx_rate"),
        "audit_path": store.audit_path(),
        "audit": read_audit(spark, store.audit_path()),
    }
    _RUNS[key] = out
    return out
