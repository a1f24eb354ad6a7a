"""Random small revenue feeds: Spark classification vs a plain-Python model."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.plans.cleanse import cleanse
from ledgerline.plans.entities import REVENUE

IDS = ["1", "2", "7", None, " 2 ", "4x", "007", "1.0", "9"]
MONTHS = ["2024-01", "2024-02", " 2024-01 ", None, " "]
AMOUNTS = ["10", "-5", "abc", None, "0", "1e2", " 3.5 ", "NaN"]
CURRENCIES = ["usd", " EURO ", "XXX", None, "gbr", "Chf"]
TIMES = ["2024-01-01", "2024-01-02", None, "bad", "2024-01-02 10:00:00"]
DIM = {"1", "2", "7"}

row = st.tuples(st.sampled_from(IDS), st.sampled_from(MONTHS), st.sampled_from(AMOUNTS),
                st.sampled_from(CURRENCIES), st.sampled_from(TIMES))


def model(rows):
    def key(t):
        if t is None:
            return None
        t = t.strip()
        if re.fullmatch(r"[+-]?[0-9]+", t):
            return str(int(t))
        try:
            d = float(t)
        except ValueError:
            return None
        return str(int(d)) if d == d and d not in (float("inf"), float("-inf")) and d == int(d) else None

    def amount(t):
        if t is None or t.strip().lower() in ("nan",):
            return None
        try:
            return float(t.strip())
        except ValueError:
            return None

    def ts(t):
        for fmt in ("%Y-%m-%d %H:%M:%S", "%Y-%m-%d"):
            try:
                return dt.datetime.strptime(t, fmt)
            except (TypeError, ValueError):
                pass
        return None

    out, survivors = {}, {}
    for i, (cid, month, rev, cur, upd) in enumerate(rows):
        k, m, v = key(cid), (month.strip() if month is not None else None), amount(rev)
        code = S.CURRENCY_MAP.get(cur.strip().upper()) if cur is not None else None
        if k is None or k not in DIM:
            reason = S.ORPHAN_COMPANY_ID
        elif code is None:
            reason = S.MALFORMED_CURRENCY
        elif v is None:
            reason = S.NULL_REVENUE
        elif v < 0:
            reason = S.NEGATIVE_REVENUE
        elif not m:
            reason = S.INVALID_MONTH
        else:
            reason = None
            survivors.setdefault((k, m), []).append((ts(upd) is not None, ts(upd) or dt.datetime.min, i))
        out[i] = reason
    for group in survivors.values():
        best = max(group)
        for g in group:
            if g != best:
                out[g[2]] = S.SUPERSEDED_BY_CORRECTION
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=25))
def test_revenue_classification_matches_model(spark, rows):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)],
                               "company_id string, month string, revenue string, currency string, "
                               "updated_at string, row_ord long").withColumn(S.ROW_ID, F.col(S.ROW_ORD))
    dim = spark.createDataFrame([(d,) for d in sorted(DIM)], "company_id string")
    got = {r[S.ROW_ORD]: r[S.REASON] for r in cleanse(df, REVENUE, dim).select(S.ROW_ORD, S.REASON).collect()}
    assert got == model(rows)
