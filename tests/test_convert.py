"""Base-currency conversion: rates as of each row's month."""

import datetime as dt

from ledgerline.operators.convert import missing_rates, to_base_currency

FACT = "company_id string, month string, currency string, revenue double, expenses double, rate_note string"
FX = "local_currency string, base_currency string, date string, fx_rate double"
RATES = [("EUR", "USD", "2024-01-10", 1.1), ("EUR", "USD", "2024-01-31", 1.2), ("EUR", "USD", "2024-03-01", 1.5), ("EUR", "GBP", "2024-01-01", 0.8),
         ("GBP", "USD", "2024-02-29", 1.3), ("GBP", "USD", "odd", 9.0), ("GBP", "USD", None, 8.0), ("USD", "USD", "2024-01-01", 7.0)]


def brute(rows, rates, base):
    out = {}
    for c, m, cur, rev, exp, _ in rows:
        try:
            y, n = map(int, m.split("-"))
            end = dt.date(y + n // 12, n % 12 + 1, 1)
        except (ValueError, AttributeError):
            end = None
        if cur is None or end is None:
            out[c] = (None, None, None)
            continue
        known = []
        for local, to, day, rate in rates:
            try:
                day = dt.date.fromisoformat(day or "")
            except ValueError:
                continue
            if local == cur and to == base and day < end:
                known.append((day, rate))
        rate = 1.0 if cur == base else max(known)[1] if known else None
        out[c] = (rate, rate and rev and rev * rate, rate and exp and exp * rate)
    return out


def test_rates_as_of_the_month(spark):
    months = ["2023-12", "2024-01", "2024-2", "2024-03", "2025-01", "odd", None]
    rows = [(f"{i}-{cur}", m, cur, 10.0 + i, None if i == 2 else 4.0, "n") for i, m in enumerate(months) for cur in ("EUR", "GBP", "USD", "JPY", None)]
    fact, fx = spark.createDataFrame(rows, FACT).repartition(3), spark.createDataFrame(RATES, FX)
    for base in ("usd", "GBP"):
        got = to_base_currency(fact, fx, base)
        assert got.columns == [*fact.columns, "rate", "rate_date", "revenue_base", "expenses_base"]
        assert {r.company_id: (r.rate, r.revenue_base, r.expenses_base) for r in got.collect()} == brute(rows, RATES, base.upper())
    counts = {r.currency: (r.row_count, r.missing_rate) for r in missing_rates(to_base_currency(fact, fx)).collect()}
    assert counts == {"EUR": (7, 3), "GBP": (7, 4), "USD": (7, 2), "JPY": (7, 7), None: (7, 7)}


def test_empty_tables(spark):
    fact, fx = spark.createDataFrame([], FACT), spark.createDataFrame([], FX)
    assert to_base_currency(fact, fx).collect() == []
    one = spark.createDataFrame([("1", "2024-01", "EUR", 1.0, 1.0, "n"), ("2", "2024-01", "USD", 2.0, 1.0, "n")], FACT)
    assert {r.company_id: r.revenue_base for r in to_base_currency(one, fx).collect()} == {"1": None, "2": 2.0}


def test_a_hot_currency_is_not_one_window(spark, workdir):
    """Windows hold months of a currency, never rows of the fact."""
    rows = [(str(i), f"2024-{1 + i % 12:02d}", "EUR", 1.0, 1.0, "n") for i in range(3000)]
    fact, fx = spark.createDataFrame(rows, FACT), spark.createDataFrame(RATES, FX)
    fact.write.parquet(f"{workdir}/f")
    out = to_base_currency(spark.read.parquet(f"{workdir}/f"), fx)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window"):]
    assert "Aggregate [currency" in below and "revenue" not in below.split("Aggregate [currency")[0]
    assert out.where("rate IS NULL").count() == 0
