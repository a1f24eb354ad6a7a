"""Keyed merge semantics and the four metrics."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.operators.merge import ACTION, merge, merge_counts
from ledgerline.operators.metrics import PART, compute_metrics, recompute_scope, spread_metrics
from ledgerline.plans import golden as G

RUN = dt.datetime(2024, 5, 1)


def test_merge_null_overwrites_and_keeps_other_columns(spark):
    target = spark.createDataFrame([("1", "a", "x", 1), ("2", "b", "y", 2)], "k string, u string, o string, n int")
    source = spark.createDataFrame([("1", None), ("3", "c")], "k string, u string")
    out = merge(target, source, ["k"], ["u"], insert_values={"n": F.lit(0)}, with_action=True)
    got = {r["k"]: (r["u"], r["o"], r["n"], r[ACTION]) for r in out.collect()}
    assert got == {"1": (None, "x", 1, "update"), "2": ("b", "y", 2, "keep"), "3": ("c", None, 0, "insert")}
    c = merge_counts(out).first()
    assert (c.inserted, c.updated, c.unchanged) == (1, 1, 1)
    assert out.columns[:4] == ["k", "u", "o", "n"]


def test_merge_rejects_missing_update_column(spark):
    target = spark.createDataFrame([("1", "a")], "k string, u string")
    with pytest.raises(ValueError):
        merge(target, target.select("k"), ["k"], ["u"])


def _fact(spark, rows):
    clean = spark.createDataFrame(
        [(c, m, r, "USD", dt.datetime(2024, 1, 1)) for c, m, r, _ in rows],
        "company_id string, month string, revenue double, currency string, updated_at timestamp_ntz")
    exp = spark.createDataFrame([(c, m, e, dt.datetime(2024, 1, 1)) for c, m, _, e in rows],
                                "company_id string, month string, expenses double, updated_at timestamp_ntz")
    f = G.merge_revenue(G.empty(spark, S.FACT_FINANCIALS), G.stamp(clean, RUN, "r"), RUN)
    return G.merge_expense(f, G.stamp(exp, RUN, "e"), RUN)


def _metrics(df):
    return {(r.company_id, r.month): (r.gross_profit, r.gross_margin_pct, r.mom_revenue_growth_pct,
                                      r.rolling_3m_revenue) for r in df.collect()}


def test_rolling_three_rows_with_nulls(spark):
    revs = [1.0, None, 3.0, 4.0, None, None, None]
    rows = [("1", f"2024-0{i + 1}", r, 1.0) for i, r in enumerate(revs)]
    f = compute_metrics(_fact(spark, rows).withColumn("expenses", F.lit(1.0)))
    # Rolling sum is masked on rows without revenue (not eligible).
    got = {m: v[3] for (c, m), v in _metrics(f).items()}
    expected = [1.0, None, 4.0, 7.0, None, None, None]
    assert [got[f"2024-0{i + 1}"] for i in range(7)] == expected


def test_margin_with_zero_revenue(spark):
    f = compute_metrics(_fact(spark, [("1", "2024-01", 0.0, 5.0)]))
    gp, margin, growth, roll = _metrics(f)[("1", "2024-01")]
    assert (gp, margin, growth, roll) == (-5.0, None, None, 0.0)


def test_growth_previous_row_not_calendar_month(spark):
    rows = [("1", "2024-01", 100.0, 1.0), ("1", "2024-03", 150.0, 1.0), ("1", "2024-04", 0.0, 1.0),
            ("1", "2024-05", 10.0, 1.0), ("2", "2024-01", None, 1.0), ("2", "2024-02", 50.0, 1.0)]
    m = _metrics(compute_metrics(_fact(spark, rows)))
    assert m[("1", "2024-01")][2] is None
    assert m[("1", "2024-03")][2] == pytest.approx(50.0)      # vs the previous row (January)
    assert m[("1", "2024-04")][2] == pytest.approx(-100.0)
    assert m[("1", "2024-05")][2] is None                     # previous revenue is 0
    assert m[("2", "2024-02")][2] is None                     # previous revenue is NULL
    assert m[("1", "2024-05")][3] == pytest.approx(160.0)


def test_ineligible_row_feeds_neighbours(spark):
    rows = [("1", "2024-01", 10.0, 1.0), ("1", "2024-02", 20.0, None), ("1", "2024-03", 40.0, 1.0)]
    m = _metrics(compute_metrics(_fact(spark, rows)))
    assert m[("1", "2024-02")] == (None, None, None, None)
    assert m[("1", "2024-03")][2] == pytest.approx(100.0)     # (40 - 20) / 20
    assert m[("1", "2024-03")][3] == pytest.approx(70.0)


def test_unparsable_months_sort_last(spark):
    rows = [("1", "bad", 5.0, 1.0), ("1", "2024-02", 20.0, 1.0), ("1", "2024-1", 10.0, 1.0)]
    m = _metrics(compute_metrics(_fact(spark, rows)))
    assert m[("1", "bad")][3] == pytest.approx(35.0)
    assert m[("1", "2024-1")][2] is None


def test_scope_recomputes_one_company(spark):
    rows = [("1", "2024-01", 10.0, 1.0), ("2", "2024-01", 10.0, 1.0)]
    f = _fact(spark, rows)
    m = _metrics(recompute_scope(f, "1"))
    assert m[("1", "2024-01")][0] == 9.0
    assert m[("2", "2024-01")][0] is None
    plan = recompute_scope(f.where(F.lit(True)), "1")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan


def test_two_upserts_equal_full_outer_join(spark):
    rows = [("1", "2024-01", 1.0, None), ("1", "2024-02", None, 2.0), ("2", "2024-01", 3.0, 4.0)]
    rev = spark.createDataFrame([(c, m, r, "USD", dt.datetime(2024, 1, 1)) for c, m, r, _ in rows if r is not None],
                                "company_id string, month string, revenue double, currency string, updated_at timestamp_ntz")
    exp = spark.createDataFrame([(c, m, e, dt.datetime(2024, 1, 1)) for c, m, _, e in rows if e is not None],
                                "company_id string, month string, expenses double, updated_at timestamp_ntz")
    a = G.merge_expense(G.merge_revenue(G.empty(spark, S.FACT_FINANCIALS), G.stamp(rev, RUN, "r"), RUN),
                        G.stamp(exp, RUN, "e"), RUN)
    b = G.merge_revenue(G.merge_expense(G.empty(spark, S.FACT_FINANCIALS), G.stamp(exp, RUN, "e"), RUN),
                        G.stamp(rev, RUN, "r"), RUN)
    cols = ["company_id", "month", "revenue", "expenses", "currency"]
    assert sorted(map(tuple, a.select(cols).collect()), key=str) == sorted(map(tuple, b.select(cols).collect()), key=str)
    assert a.count() == 3


def test_scoped_merge_equals_full_merge(spark):
    target = spark.createDataFrame([("1", "m1", 1.0), ("1", "m2", 2.0), ("2", "m3", 3.0)],
                                   "k string, month string, v double")
    source = spark.createDataFrame([("1", "m2", None), ("3", "m2", 9.0), ("4", "m4", 4.0)],
                                   "k string, month string, v double")
    full = merge(target, source, ["k", "month"], ["v"], with_action=True)
    scoped = merge(target, source, ["k", "month"], ["v"], with_action=True, scope="month")
    assert sorted(map(tuple, full.collect()), key=str) == sorted(map(tuple, scoped.collect()), key=str)
    plan = scoped._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan


def _spread_rows(spark):
    import random

    r = random.Random(5)
    months = [f"{y}-{m:02d}" for y in range(2001, 2005) for m in range(1, 13)]
    rows = [(c, m, r.choice([None, 0.0, 1.5, 20.0, 7.25]), r.choice([None, 3.0])) for c in ("1", "2", "3", None) for m in months]
    rows += [("hot", f"odd {i:05d}", float(i % 11), 1.0) for i in range(2500)] + [("hot", m, 2.0, 1.0) for m in months]
    rows += [(f"one{i}", "2024-01", 4.0, 1.0) for i in range(60)]
    return spark.createDataFrame(rows, "company_id string, month string, revenue double, expenses double").repartition(3)


@pytest.mark.parametrize("ranges", [1, 7, 400])
def test_spread_metrics_equal_the_window(spark, ranges):
    df = _spread_rows(spark)
    assert _metrics(spread_metrics(df, ranges=ranges)) == _metrics(compute_metrics(df))
    assert spread_metrics(df, ranges=ranges).count() == df.count()


def test_spread_metrics_columns_and_empty(spark):
    df = compute_metrics(_spread_rows(spark))
    assert spread_metrics(df, ranges=3).columns == df.columns
    assert spread_metrics(df.limit(0)).count() == 0
    assert _metrics(recompute_scope(df, "hot", spread=True)) == _metrics(df)


def test_a_hot_company_spreads_over_ranges(spark):
    plan = spread_metrics(_spread_rows(spark), ranges=16)._jdf.queryExecution().optimizedPlan().toString()
    assert f"[{PART}#" in plan.replace("windowspecdefinition(", "[")
    from ledgerline.operators.metrics import longest_run
    assert longest_run(_spread_rows(spark)) == 2548
