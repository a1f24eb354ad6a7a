"""Benchmark: the whole staged run over the derived feeds at one scale factor.

Times every feed load end to end (CSV scan -> Bronze -> classify/dedup ->
Silver + Quarantine -> merge -> new Golden snapshot), split into data work
(Bronze + zones) and publish (Golden), then the metrics run and two plans
over the published tables. Writing the CSV inputs is setup and not timed.
Prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs, best reported; default 3), BENCH_REPLAY_COPIES
(revenue/expense replay at N times the sf size; default 3, 0 = off).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline import get_spark  # noqa: E402
from ledgerline.plans.loader import calculate_metrics, load_entity, read_golden  # noqa: E402
from ledgerline.plans.read import read_financials  # noqa: E402
from ledgerline.plans.staged import write_feeds  # noqa: E402
from ledgerline.session import new_run_dir  # noqa: E402
from ledgerline.sources.store import Store  # noqa: E402
from ledgerline import schemas as S  # noqa: E402
from ledgerline.plans.cleanse import cleanse  # noqa: E402
from ledgerline.plans.entities import REVENUE  # noqa: E402
from ledgerline.sources import fixtures as X  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

FEEDS = ("company", "revenue", "expense", "fx_rate")


def run(spark, sf_dir: str, timed: bool = True) -> dict[str, float]:
    folder = new_run_dir(spark, "bench")
    store = Store(spark, folder)
    paths = write_feeds(spark, sf_dir, folder)
    out: dict[str, float] = {}
    for entity in FEEDS:
        t = time.perf_counter()
        res = load_entity(spark, store, entity, paths[entity])
        out[f"{entity}_load"] = time.perf_counter() - t
        out[f"{entity}_data_work"] = res.timings["bronze"] + res.timings["zones"]
        out[f"{entity}_publish"] = res.timings["golden"]
        out[f"{entity}_rows"] = res.raw_rows
    t = time.perf_counter()
    summary = calculate_metrics(spark, store)
    out["metrics"] = time.perf_counter() - t
    out["metrics_rows"] = summary.get("total_rows", 0)
    fact = read_golden(store, "fact_company_monthly_financials")
    t = time.perf_counter()
    read_financials(fact, currency="eur").write.format("noop").mode("overwrite").save()
    out["read_financials"] = time.perf_counter() - t
    # Skew: every third order moved onto one company and month, so one dedup
    # key holds a third of the feed; classified end to end from the shared
    # tables (orphan check, rules, keep-latest).
    hot = hot_key_revenue(spark, sf_dir)
    dim = read_golden(store, "dim_company").select("company_id")
    t = time.perf_counter()
    counts = (cleanse(hot, REVENUE, dim).groupBy(S.REASON).count().collect())
    out["hot_key_classify"] = time.perf_counter() - t
    out["hot_key_rows"] = sum(r["count"] for r in counts)
    return out


def hot_key_revenue(spark, sf_dir):
    raw = X.revenue_raw(spark, sf_dir)
    hot = F.col("row_ord") % 3 == 0
    return (raw.withColumn("company_id", F.when(hot, F.lit("1")).otherwise(F.col("company_id")))
               .withColumn("month", F.when(hot, F.lit("1998-01")).otherwise(F.col("month")))
               .withColumn(S.ROW_ID, F.col("row_ord")))


def replay_feeds(spark, sf_dir: str, folder: str, copies: int) -> dict[str, str]:
    """Revenue and expense feeds at ``copies`` times their size: whole copies
    of the derived feeds with the month moved by 100 years per copy (new
    keys) and a unique row position; companies and FX as derived."""
    from ledgerline.sources.csv import write_feed

    paths = {}
    for entity, build in X.RAW_FEEDS.items():
        df = build(spark, sf_dir)
        if entity in ("revenue", "expense"):
            parts = []
            for c in range(copies):
                year = F.substring("month", 1, 4).cast("int") + F.lit(100 * c)
                parts.append(df.withColumn("month", F.concat(year.cast("string"), F.substring("month", 5, 3)))
                               .withColumn("row_ord", F.col("row_ord") + F.lit(c * 1_000_000_000)))
            df = parts[0]
            for p in parts[1:]:
                df = df.unionByName(p)
        path = f"{folder}/incoming/{entity}.csv"
        write_feed(df, path, order_by="row_ord")
        paths[entity] = path
    return paths


def replay(spark, sf_dir: str, copies: int) -> dict[str, float]:
    folder = new_run_dir(spark, "bench-replay")
    store = Store(spark, folder)
    paths = replay_feeds(spark, sf_dir, folder, copies)
    out: dict[str, float] = {}
    for entity in ("company", "revenue", "expense"):
        res = load_entity(spark, store, entity, paths[entity])
        out[f"replay_{entity}_load"] = sum(res.timings.values())
        out[f"replay_{entity}_data_work"] = res.timings["bronze"] + res.timings["zones"]
        out[f"replay_{entity}_rows"] = res.raw_rows
    t = time.perf_counter()
    summary = calculate_metrics(spark, store)
    out["replay_metrics"] = time.perf_counter() - t
    out["replay_metrics_rows"] = summary.get("total_rows", 0)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", app="ledgerline-bench", shuffle_partitions=cpus,
                      extra={"spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    # JVM warm-up (JIT) on a smaller, different scale factor (not reported).
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.01")
    for _ in range(int(os.environ.get("BENCH_WARMUP_RUNS", "1"))):
        if os.path.isdir(warm):
            run(spark, warm)
    # Best of BENCH_RUNS timed runs (fresh folders each), reported whole: the
    # run with the lowest pipeline total, not a mix of runs.
    best, total = None, 0.0
    for _ in range(max(1, int(os.environ.get("BENCH_RUNS", "3")))):
        t = time.perf_counter()
        res = run(spark, sf_dir)
        wall = time.perf_counter() - t
        pipe = sum(res[f"{e}_load"] for e in FEEDS) + res["metrics"]
        if best is None or pipe < best[0]:
            best, total = (pipe, res), wall
    res = best[1]
    copies = int(os.environ.get("BENCH_REPLAY_COPIES", "3"))
    if copies > 0:
        res.update(replay(spark, sf_dir, copies))
    timed = {k: round(v, 3) for k, v in res.items() if not k.endswith("_rows")}
    rates = {f"{e}_rows_per_sec": round(res[f"{e}_rows"] / res[f"{e}_load"]) for e in FEEDS}
    rates.update({f"{e}_data_work_rows_per_sec": round(res[f"{e}_rows"] / res[f"{e}_data_work"])
                  for e in FEEDS})
    rates.update({f"replay_{e}_data_work_rows_per_sec":
                  round(res[f"replay_{e}_rows"] / res[f"replay_{e}_data_work"])
                  for e in ("revenue", "expense") if f"replay_{e}_rows" in res})
    pipeline = sum(res[f"{e}_load"] for e in FEEDS) + res["metrics"]
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "staged_pipeline_seconds",
        "value": round(pipeline, 3),
        "unit": "sec",
        "queries": timed,
        "rows": {k: v for k, v in res.items() if k.endswith("_rows")},
        "rates": rates,
        "wall_with_setup": round(total, 3),
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "runs": max(1, int(os.environ.get("BENCH_RUNS", "3"))),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
