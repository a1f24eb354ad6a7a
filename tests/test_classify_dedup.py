"""Rule priority, keep-latest after rules, departures and their switches."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.operators.dedup import OrderKey, keep_latest, mark_superseded
from ledgerline.plans.cleanse import cleanse
from ledgerline.plans.entities import COMPANY, EXPENSE, FX, REVENUE, CleansePolicy

REV = "company_id string, month string, revenue string, currency string, updated_at string, row_ord long"


def _rev(spark, rows):
    return spark.createDataFrame(rows, REV).withColumn(S.ROW_ID, F.col(S.ROW_ORD))


def _dim(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "company_id string")


def _reasons(df):
    return {r[S.ROW_ORD]: r[S.REASON] for r in df.select(S.ROW_ORD, S.REASON).collect()}


def test_priority_orphan_wins(spark):
    df = _rev(spark, [("99", "2024-01", None, "XXX", "2024-01-01", 1),
                      ("1", "2024-01", None, "XXX", "2024-01-01", 2),
                      ("1", "2024-02", None, "USD", "2024-01-01", 3),
                      ("1", "2024-03", "-5", "USD", "2024-01-01", 4),
                      (None, "2024-03", "5", "USD", "2024-01-01", 5),
                      ("1", "2024-04", "5", "usd", "2024-01-01", 6)])
    got = _reasons(cleanse(df, REVENUE, _dim(spark, ["1"])))
    assert got == {1: S.ORPHAN_COMPANY_ID, 2: S.MALFORMED_CURRENCY, 3: S.NULL_REVENUE,
                   4: S.NEGATIVE_REVENUE, 5: S.ORPHAN_COMPANY_ID, 6: None}


def test_dedup_runs_after_rules(spark):
    # The newer row is negative: the older valid row stays clean.
    df = _rev(spark, [("1", "2024-01", "10", "USD", "2024-01-01", 1),
                      ("1", "2024-01", "-1", "USD", "2024-02-01", 2)])
    assert _reasons(cleanse(df, REVENUE, _dim(spark, ["1"]))) == {1: None, 2: S.NEGATIVE_REVENUE}


def test_latest_wins_and_ties_go_to_later_row(spark):
    df = _rev(spark, [("1", "2024-01", "10", "USD", "2024-01-01", 1),
                      ("1", "2024-01", "11", "USD", "2024-03-01", 2),
                      ("1", "2024-01", "12", "USD", "2024-03-01", 3),
                      ("1", "2024-01", "13", "USD", "2024-02-01", 4)])
    got = _reasons(cleanse(df, REVENUE, _dim(spark, ["1"])))
    assert got == {1: S.SUPERSEDED_BY_CORRECTION, 2: S.SUPERSEDED_BY_CORRECTION, 3: None,
                   4: S.SUPERSEDED_BY_CORRECTION}


def test_null_updated_at_switch(spark):
    rows = [("1", "2024-01", "10", "USD", "2024-01-01", 1),
            ("1", "2024-01", "11", "USD", "not a date", 2)]
    dim = _dim(spark, ["1"])
    assert _reasons(cleanse(_rev(spark, rows), REVENUE, dim)) == {1: None, 2: S.SUPERSEDED_BY_CORRECTION}
    wins = CleansePolicy(null_updated_at="wins")
    assert _reasons(cleanse(_rev(spark, rows), REVENUE, dim, wins)) == {1: S.SUPERSEDED_BY_CORRECTION, 2: None}


def test_clean_rows_get_canonical_currency(spark):
    df = _rev(spark, [("1", "2024-01", "10", " euro ", "2024-01-01", 1),
                      ("1", "2024-02", None, " euro ", "2024-01-01", 2)])
    got = {r[S.ROW_ORD]: r["currency"] for r in cleanse(df, REVENUE, _dim(spark, ["1"])).collect()}
    assert got == {1: "EUR", 2: "EURO"}


def test_blank_month_quarantined_unless_compat(spark):
    rows = [("1", "  ", "10", "USD", "2024-01-01", 1), ("1", None, "10", "USD", "2024-01-01", 2)]
    dim = _dim(spark, ["1"])
    assert _reasons(cleanse(_rev(spark, rows), REVENUE, dim)) == {1: S.INVALID_MONTH, 2: S.INVALID_MONTH}
    compat = cleanse(_rev(spark, rows), REVENUE, dim, CleansePolicy(compat=True))
    months = {r[S.ROW_ORD]: (r["month"], r[S.REASON]) for r in compat.collect()}
    assert months[2] == ("nan", None)


def test_company_newest_created_first_then_file_order(spark):
    df = spark.createDataFrame([
        ("7", "A", "x", "y", "2024-01-01", 1), ("7", "B", "x", "y", "2024-02-01", 2),
        ("7", "C", "x", "y", "2024-02-01", 3), ("8", "D", "x", "y", None, 4),
        ("8", "E", "x", "y", "2023-01-01", 5), (None, "F", "x", "y", None, 6),
    ], "company_id string, name string, industry string, country string, created_at string, row_ord long"
    ).withColumn(S.ROW_ID, F.col(S.ROW_ORD))
    got = _reasons(cleanse(df, COMPANY))
    assert got == {1: S.SUPERSEDED_BY_CORRECTION, 2: None, 3: S.SUPERSEDED_BY_CORRECTION,
                   4: S.SUPERSEDED_BY_CORRECTION, 5: None, 6: S.NULL_COMPANY_ID}


def test_company_without_created_at_keeps_first_row(spark):
    df = spark.createDataFrame([("7", "A", "x", "y", 1), ("7", "B", "x", "y", 2)],
                               "company_id string, name string, industry string, country string, row_ord long"
                               ).withColumn(S.ROW_ID, F.col(S.ROW_ORD))
    assert _reasons(cleanse(df, COMPANY)) == {1: None, 2: S.SUPERSEDED_BY_CORRECTION}


def test_fx_rules_and_last_row_wins(spark):
    df = spark.createDataFrame([
        (" eur ", "usd", "2024-01-01", "1.1", 1), ("EUR", "USD", "2024-01-01", "1.2", 2),
        ("  ", "USD", "2024-01-01", "1.3", 3), (None, "USD", "2024-01-01", "0", 4),
        ("EUR", "USD", "2024-01-01", "0", 5), ("EUR", "USD", "2024-01-01", "x", 6),
        ("GBP", "USD", " ", "1.0", 7),
    ], "local_currency string, base_currency string, date string, fx_rate string, row_ord long"
    ).withColumn(S.ROW_ID, F.col(S.ROW_ORD))
    got = _reasons(cleanse(df, FX))
    assert got == {1: S.SUPERSEDED_BY_CORRECTION, 2: None, 3: S.INVALID_CURRENCY, 4: S.INVALID_CURRENCY,
                   5: S.INVALID_FX_RATE, 6: S.INVALID_FX_RATE, 7: S.INVALID_DATE}


def test_expense_rules(spark):
    df = spark.createDataFrame([
        ("1", "2024-01", "5", "2024-01-01", 1), ("1", "2024-02", "-5", "2024-01-01", 2),
        ("1", "2024-03", "", "2024-01-01", 3), ("2", "2024-03", "5", "2024-01-01", 4),
    ], "company_id string, month string, expenses string, updated_at string, row_ord long"
    ).withColumn(S.ROW_ID, F.col(S.ROW_ORD))
    got = _reasons(cleanse(df, EXPENSE, _dim(spark, ["1"])))
    assert got == {1: None, 2: S.NEGATIVE_EXPENSE, 3: S.NULL_EXPENSE, 4: S.ORPHAN_COMPANY_ID}


def test_hot_key_dedup_matches_brute_force(spark):
    """A third of all rows on one key: same winners as a plain sort per key."""
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rnd.randint(0, 400)}"
        ts = dt.datetime(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 5)) if rnd.random() > 0.1 else None
        rows.append((key, ts, i))
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, row_ord long").withColumn(
        S.ROW_ID, F.col(S.ROW_ORD)).withColumn(S.REASON, F.lit(None).cast("string"))
    order = [OrderKey("ts", descending=True, nulls_last=True), OrderKey(S.ROW_ORD, descending=True)]
    got = {r[S.ROW_ORD] for r in mark_superseded(df, ["k"], order).where(F.col(S.REASON).isNull()).collect()}
    best = {}
    for k, ts, i in rows:
        rank = (ts is not None, ts or dt.datetime.min, i)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, i)
    assert got == {v[1] for v in best.values()}
    assert keep_latest(df.drop(S.REASON), ["k"], order).count() == len(best)


def test_keep_latest_string_order_ascending(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "b", 2), ("c", "z", 3)], "k string, s string, row_ord long"
                               ).withColumn(S.ROW_ID, F.col(S.ROW_ORD))
    got = {r["k"]: r["s"] for r in keep_latest(df, ["k"], [OrderKey("s", descending=False)]).collect()}
    assert got == {"a": "b", "c": "z"}


def test_strict_months_switch(spark):
    rows = [("1", "2024-01", "10", "USD", "2024-01-01", 1), ("1", "Jan 2024", "10", "USD", "2024-01-01", 2),
            ("1", "2024-1", "10", "USD", "2024-01-01", 3)]
    dim = _dim(spark, ["1"])
    assert _reasons(cleanse(_rev(spark, rows), REVENUE, dim)) == {1: None, 2: None, 3: None}
    strict = cleanse(_rev(spark, rows), REVENUE, dim, CleansePolicy(strict_months=True))
    assert _reasons(strict) == {1: None, 2: S.INVALID_MONTH, 3: None}


def test_packed_and_struct_orders_agree(spark):
    import datetime as dt
    import random

    from pyspark.sql import functions as F

    from ledgerline import schemas as S
    from ledgerline.operators.dedup import OrderKey, mark_superseded, packed_order

    r = random.Random(6)
    rows = [(f"k{r.randrange(40)}", None if r.random() < 0.2 else dt.datetime(1900, 1, 1) + dt.timedelta(days=r.randrange(5) * 40000, microseconds=r.randrange(3)),
             i * (1 << 40) + r.randrange(9), i, "BAD" if r.random() < 0.1 else None) for i in range(600)]
    df = spark.createDataFrame(rows, f"k string, t timestamp_ntz, row_ord long, _row_id long, {S.REASON} string")
    for desc in (True, False):
        for nulls_last in (True, False):
            for order in ([OrderKey("t", True, nulls_last), OrderKey("row_ord", desc)], [OrderKey("row_ord", desc)]):
                assert packed_order(df, order) is not None
                got = {x._row_id for x in mark_superseded(df, ["k"], order).where(F.col(S.REASON).isNull()).collect()}
                slow = df.withColumn("row_ord", F.col("row_ord").cast("decimal(38,0)"))
                assert packed_order(slow, order) is None
                assert got == {x._row_id for x in mark_superseded(slow, ["k"], order).where(F.col(S.REASON).isNull()).collect()}
