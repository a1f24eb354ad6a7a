"""Derived frames that several jobs read are computed once."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.operators.metrics import spread_metrics
from ledgerline.plans import derived as D
from ledgerline.plans import loader
from ledgerline.plans.cleanse import cleanse
from ledgerline.plans.entities import COMPANY
from ledgerline.plans.registry import QUERIES
from ledgerline.sources import fs
from ledgerline.sources.store import Store


def _counted(df, seen):
    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(count, df.schema)


def test_spread_metrics_computes_the_fact_once(spark):
    seen = spark.sparkContext.accumulator(0)
    rows = [(str(c), f"2024-{m:02d}", float(m), 1.0) for c in range(20) for m in range(1, 13)]
    fact = spark.createDataFrame(rows, "company_id string, month string, revenue double, expenses double")
    assert spread_metrics(_counted(fact, seen)).count() == 240
    assert seen.value == 240


def test_cleanse_computes_the_feed_once(spark):
    seen = spark.sparkContext.accumulator(0)
    rows = [(str(i // 2), "n", "i", "c", dt.datetime(2024, 1, 1 + i % 2), i, i) for i in range(40)]
    feed = spark.createDataFrame(rows, "company_id string, name string, industry string, country string, created_at timestamp_ntz, row_ord bigint, _row_id bigint")
    out = cleanse(_counted(feed, seen), COMPANY)
    assert out.where(F.col(S.REASON).isNull()).count() == 20
    assert seen.value == 40


def test_load_rules_the_feed_once(spark, workdir, monkeypatch):
    seen = spark.sparkContext.accumulator(0)
    rules = loader.value_rules
    monkeypatch.setattr(loader, "value_rules", lambda *a: _counted(rules(*a), seen))
    feed = spark.createDataFrame([(str(i // 2), "n", "i", "c", None, i, i) for i in range(40)],
                                 "company_id string, name string, industry string, country string, _corrupt_record string, row_ord bigint, _row_id bigint")
    store = Store(spark, f"{workdir}/s")
    done = loader.load_frame(spark, store, "company", feed, 4, "feed")
    assert (done.clean_rows, done.quarantined_rows) == (20, 20)
    assert seen.value == 40
    assert not fs.exists(spark, store.zone_path("ruled", "company", done.load_uuid))


def test_json_rows_are_parsed_once(spark, monkeypatch):
    at = dt.datetime(2024, 3, 1, 0, 0, 0)
    fact = spark.createDataFrame([("1", 'a "b"', 1.5, None, "USD", None, None, None, 2.345, dt.date(2024, 1, 2), None, at, None, "u", None, at)],
                                 "company_id string, month string, revenue double, expenses double, currency string, gross_profit double, "
                                 "gross_margin_pct double, mom_revenue_growth_pct double, rolling_3m_revenue double, revenue_updated_at date, "
                                 "expenses_updated_at date, revenue_pipeline_loaded_at timestamp, expense_pipeline_loaded_at timestamp, "
                                 "revenue_pipeline_load_uuid string, expense_pipeline_load_uuid string, updated_at timestamp")
    assert fact.columns == S.FACT_FINANCIALS.names
    monkeypatch.setattr(D, "fact_table", lambda spark, sf: fact)
    out = QUERIES["fact_as_json"](spark, "")
    row = out.first()
    assert row.json_keys == ",".join(fact.columns)
    assert (row.company_id, row.month, row.revenue, row.expenses, row.revenue_updated_at, row.updated_at) == ("1", 'a "b"', 1.5, None, "2024-01-02", "2024-03-01T00:00:00")
    assert "get_json_object" not in out._jdf.queryExecution().optimizedPlan().toString()
