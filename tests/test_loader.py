"""CSV feeds through Bronze -> zones -> Golden: guards, invariants, gates."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.plans.audit import read_audit
from ledgerline.plans.loader import calculate_metrics, load_entity, quarantine_with_raw, read_golden
from ledgerline.sources.csv import FeedError, read_feed, write_feed
from ledgerline.sources.store import Store

from conftest import SF_SMALL

# Rates at one date: many currencies, small and large rates, an inverse pair.
FX_SAMPLE = """local_currency,base_currency,date,fx_rate
NOK,USD,2025-07-01,0.0991
SEK,USD,2025-07-01,0.1052
DKK,USD,2025-07-01,0.158
KRW,USD,2025-07-01,0.00074
IDR,USD,2025-07-01,0.000062
KWD,USD,2025-07-01,3.27
OMR,USD,2025-07-01,2.6
PLN,USD,2025-07-01,0.277
USD,PLN,2025-07-01,3.61
NZD,AUD,2025-07-01,0.927
"""


def _local(path):
    return path.replace("file:", "")


def _write(path, text):
    os.makedirs(os.path.dirname(_local(path)), exist_ok=True)
    with open(_local(path), "w") as f:
        f.write(text)
    return path


def test_fx_sample_all_clean(spark, workdir):
    store = Store(spark, workdir)
    res = load_entity(spark, store, "fx_rate", _write(f"{workdir}/in/fx_rate.csv", FX_SAMPLE))
    assert (res.raw_rows, res.clean_rows, res.quarantined_rows) == (10, 10, 0)
    assert read_golden(store, "fx_rate").count() == 10


def test_csv_quoting_short_and_long_rows(spark, workdir):
    p = _write(f"{workdir}/in/q.csv", 'a,b,c\n"x""y",2,3\n"multi\nline",5,6\nshort,1\n')
    rows = read_feed(spark, p, multiline=True).orderBy(S.ROW_ORD).select("a", "b", "c").collect()
    assert [tuple(r) for r in rows] == [('x"y', "2", "3"), ("multi\nline", "5", "6"), ("short", "1", None)]
    store = Store(spark, workdir)
    bad = _write(f"{workdir}/in/company_long.csv", "company_id,name,industry,country\n1,a,b,c,EXTRA\n2,a,b,c\n")
    with pytest.raises(FeedError):
        load_entity(spark, store, "company", bad)
    audit = read_audit(spark, store.audit_path()).collect()
    assert [(r.stage, r.status) for r in audit] == [(S.STAGE_BRONZE, S.STATUS_FAILURE)]
    assert store.current_version("dim_company") is None


def test_source_guards(spark, workdir):
    store = Store(spark, workdir)
    with pytest.raises(FileNotFoundError):
        load_entity(spark, store, "company", f"{workdir}/missing.csv")
    with pytest.raises(FeedError):
        load_entity(spark, store, "company", _write(f"{workdir}/in/empty.csv", ""))
    with pytest.raises(FeedError):
        load_entity(spark, store, "company", _write(f"{workdir}/in/hdr.csv", "company_id,name,industry,country\n"))
    with pytest.raises(FeedError, match="missing required columns"):
        load_entity(spark, store, "revenue", _write(f"{workdir}/in/rev.csv", "company_id,month\n1,2024-01\n"))


def _feeds(spark, workdir):
    from ledgerline.plans.staged import write_feeds
    return write_feeds(spark, SF_SMALL, workdir)


def _golden_rows(df, cols):
    return sorted(tuple(r) for r in df.select(cols).collect())


def test_staged_run_invariants(spark, workdir):
    store = Store(spark, workdir)
    paths = _feeds(spark, workdir)
    res = {e: load_entity(spark, store, e, paths[e]) for e in ("company", "revenue", "expense", "fx_rate")}
    # Conservation: raw = clean + quarantined, and the breakdown adds up.
    for r in res.values():
        assert r.raw_rows == r.clean_rows + r.quarantined_rows
        assert sum(r.by_reason.values()) == r.quarantined_rows
    dim = read_golden(store, "dim_company")
    fact = read_golden(store, "fact_company_monthly_financials")
    # Unique Golden keys, no FK violations.
    assert dim.count() == dim.select("company_id").distinct().count()
    assert fact.count() == fact.select("company_id", "month").distinct().count()
    assert fact.join(dim, "company_id", "left_anti").count() == 0
    # |R u E| = |R| + |E| - |R n E|.
    both = fact.where(F.col("revenue").isNotNull() & F.col("expenses").isNotNull()).count()
    assert fact.count() == res["revenue"].clean_rows + res["expense"].clean_rows - both
    # Insert/update split of the expense merge.
    assert res["expense"].updated == both
    # Audit: four stages per feed with the counts of the load.
    audit = {(r.entity, r.stage): r.row_count for r in read_audit(spark, store.audit_path()).collect()}
    for e, r in res.items():
        assert audit[(e, S.STAGE_BRONZE)] == r.raw_rows
        assert audit[(e, S.STAGE_SILVER)] == r.clean_rows
        assert audit[(e, S.STAGE_QUARANTINE)] == r.quarantined_rows
        assert audit[(e, S.STAGE_GOLDEN)] == r.clean_rows
    # Quarantine report: key columns + reason only.
    assert res["revenue"].quarantine.columns == ["company_id", "month", "revenue", "currency", S.REASON]
    # Metrics run.
    summary = calculate_metrics(spark, store)
    assert summary["status"] == "success" and summary["eligible_rows"] == both
    m = read_golden(store, "fact_company_monthly_financials")
    assert m.where(F.col("gross_profit").isNotNull()).count() == both
    assert calculate_metrics(spark, store, company_id="no-such-company")["status"] == "no_data"


def test_idempotent_and_order_independent(spark, workdir):
    paths = _feeds(spark, workdir)
    cols = ["company_id", "month", "revenue", "expenses", "currency"]
    a = Store(spark, f"{workdir}/a")
    for e in ("company", "revenue", "expense"):
        load_entity(spark, a, e, paths[e])
    first = _golden_rows(read_golden(a, "fact_company_monthly_financials"), cols)
    for e in ("revenue", "expense"):
        load_entity(spark, a, e, paths[e])
    assert _golden_rows(read_golden(a, "fact_company_monthly_financials"), cols) == first
    b = Store(spark, f"{workdir}/b")
    for e in ("company", "expense", "revenue"):
        load_entity(spark, b, e, paths[e])
    assert _golden_rows(read_golden(b, "fact_company_monthly_financials"), cols) == first


def test_failed_golden_write_keeps_snapshot(spark, workdir):
    store = Store(spark, workdir)
    p = _write(f"{workdir}/in/company.csv", "company_id,name,industry,country\n1,a,b,c\n")
    first = load_entity(spark, store, "company", p)
    v1 = store.current_version("dim_company")
    with pytest.raises(Exception):
        load_entity(spark, store, "company", p, load_uuid=first.load_uuid)  # version folder exists
    assert store.current_version("dim_company") == v1
    fails = read_audit(spark, store.audit_path(), status="failure").collect()
    assert fails and all(r.status == S.STATUS_FAILURE for r in fails)


def test_write_feed_roundtrip(spark, workdir):
    df = spark.createDataFrame([(2, " b "), (1, "a,1")], "row_ord long, v string")
    write_feed(df, f"{workdir}/rt.csv", order_by="row_ord")
    back = read_feed(spark, f"{workdir}/rt.csv").orderBy(S.ROW_ORD).select("v").collect()
    assert [r.v for r in back] == ["a,1", " b "]


def test_quarantine_keeps_raw_text(spark, workdir):
    store = Store(spark, workdir)
    load_entity(spark, store, "company", _write(f"{workdir}/in/c.csv", "company_id,name,industry,country\n1,a,b,c\n"))
    rev = _write(f"{workdir}/in/r.csv",
                 "company_id,month,revenue,currency,updated_at\n1,2024-01,abc,USD,2024-01-01\n1,2024-02,5,USD,2024-01-01\n")
    res = load_entity(spark, store, "revenue", rev)
    q = quarantine_with_raw(spark, store, "revenue", res.load_uuid).collect()
    assert [(r.month, r.revenue, r.revenue_raw, r.quarantine_reason) for r in q] == [
        ("2024-01", None, "abc", S.NULL_REVENUE)]
    assert read_golden(store, "fact_company_monthly_financials").count() == 1


def test_audit_error_text_and_basename(spark, workdir):
    from ledgerline.plans.audit import audit_row, error_text

    try:
        raise ValueError("x" * 5000)
    except ValueError as e:
        text = error_text(e)
    assert text.startswith("ValueError: xxx") and len(text) == S.ERROR_TEXT_LIMIT
    row = audit_row("revenue", f"{workdir}/in/monthly_revenue.csv", "u", S.STAGE_BRONZE, S.STATUS_SUCCESS, 3)
    assert row[1] == "monthly_revenue.csv" and row[5] == 3 and row[6] is None


def test_null_keys_are_spread_not_joined(spark):
    from ledgerline.operators.classify import KNOWN, flag_known

    df = spark.createDataFrame([(None, i) for i in range(50)] + [("1", 50), ("2", 51)],
                               "company_id string, _row_id long")
    dim = spark.createDataFrame([("1",)], "company_id string")
    got = {r._row_id: r[KNOWN] for r in flag_known(df, dim, "company_id").collect()}
    assert got[50] is True and got[51] is False and not any(got[i] for i in range(50))


def test_on_conflict_newest(spark, workdir):
    from ledgerline.plans.entities import CleansePolicy

    comp = _write(f"{workdir}/in/c.csv", "company_id,name,industry,country\n1,a,b,c\n")
    hdr = "company_id,month,revenue,currency,updated_at\n"
    new = _write(f"{workdir}/in/r1.csv", hdr + "1,2024-01,10,USD,2024-02-01\n")
    old = _write(f"{workdir}/in/r2.csv", hdr + "1,2024-01,99,USD,2024-01-01\n1,2024-02,5,USD,2024-01-01\n")
    got = {}
    for mode in ("last", "newest"):
        store = Store(spark, f"{workdir}/{mode}")
        policy = CleansePolicy(on_conflict=mode)
        load_entity(spark, store, "company", comp)
        load_entity(spark, store, "revenue", new, policy)
        res = load_entity(spark, store, "revenue", old, policy)
        fact = read_golden(store, "fact_company_monthly_financials")
        got[mode] = ({r.month: r.revenue for r in fact.collect()}, res.stale, res.inserted, res.updated)
    assert got["last"] == ({"2024-01": 99.0, "2024-02": 5.0}, 0, 1, 1)
    assert got["newest"] == ({"2024-01": 10.0, "2024-02": 5.0}, 1, 1, 0)
    # The refused row is in Quarantine with its reason, and GOLDEN counts what was merged.
    assert res.by_reason == {S.OLDER_THAN_STORED: 1} and (res.clean_rows, res.quarantined_rows) == (1, 1)
    assert [(r.month, r.revenue, r[S.REASON]) for r in res.quarantine.collect()] == [("2024-01", 99.0, S.OLDER_THAN_STORED)]
    last = {r.stage: r.row_count for r in reversed(read_audit(spark, store.audit_path(), load_uuid=res.load_uuid).collect())}
    assert last[S.STAGE_GOLDEN] == 1 and last[S.STAGE_QUARANTINE] == 1


def test_time_travel(spark, workdir):
    import datetime as dt
    import time as _time

    store = Store(spark, workdir)
    hdr = "company_id,name,industry,country\n"
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    v1 = load_entity(spark, store, "company", _write(f"{workdir}/in/c1.csv", hdr + "1,a,b,c\n")).load_uuid
    _time.sleep(0.01)
    between = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    v2 = load_entity(spark, store, "company", _write(f"{workdir}/in/c2.csv", hdr + "2,a,b,c\n")).load_uuid
    assert store.version_at("dim_company", before) is None
    assert store.version_at("dim_company", between) == v1
    assert store.current_version("dim_company") == v2
    assert store.read_as_of("dim_company", between).count() == 1
    assert read_golden(store, "dim_company").count() == 2
    assert store.versions("dim_company").count() == 2


def test_preprocess_hook(spark, workdir):
    store = Store(spark, workdir)
    p = _write(f"{workdir}/in/c.csv", "company_id,name,industry,country\n1,a,b,c\n2,x,y,z\n")
    res = load_entity(spark, store, "company", p,
                      preprocess=lambda df: df.withColumn("name", F.upper("name")))
    assert sorted(r.name for r in read_golden(store, "dim_company").collect()) == ["A", "X"]
    v = store.current_version("dim_company")
    with pytest.raises(FeedError):
        load_entity(spark, store, "company", p, preprocess=lambda df: df.drop("country"))
    assert store.current_version("dim_company") == v
    last = [(r.stage, r.status) for r in read_audit(spark, store.audit_path()).collect()
            if r.load_uuid != res.load_uuid]
    assert last == [(S.STAGE_BRONZE, S.STATUS_FAILURE)]


def test_all_rows_quarantined(spark, workdir):
    store = Store(spark, workdir)
    res = load_entity(spark, store, "company",
                      _write(f"{workdir}/in/c.csv", "company_id,name,industry,country\n,a,b,c\nx,d,e,f\n"))
    assert (res.raw_rows, res.clean_rows, res.quarantined_rows) == (2, 0, 2)
    assert res.by_reason == {S.NULL_COMPANY_ID: 2}
    assert read_golden(store, "dim_company").count() == 0
    assert res.quarantine.count() == 2


HDR = "company_id,name,industry,country\n"
QUOTED = HDR + '1,"Acme\nInc",Tech,US\n2,"b, ""B""",c,"d\n3,x,y,z"\n4,e,f,g\n'
QUOTED_ROWS = [("1", "Acme\nInc", "Tech", "US"), ("2", 'b, "B"', "c", "d\n3,x,y,z"), ("4", "e", "f", "g")]


def _company(df):
    return sorted(tuple(r) for r in df.select("company_id", "name", "industry", "country").collect())


def test_quoted_newlines_are_kept_by_default(spark, workdir):
    p = _write(f"{workdir}/in/c.csv", QUOTED)
    assert _company(read_feed(spark, p)) == QUOTED_ROWS
    store = Store(spark, workdir)
    res = load_entity(spark, store, "company", p)
    assert (res.raw_rows, res.clean_rows) == (3, 3) and _company(read_golden(store, "dim_company")) == QUOTED_ROWS


def test_large_files_are_split_only_when_no_line_is_cut(spark, workdir):
    from ledgerline.sources.csv import spans_lines

    cut = _write(f"{workdir}/in/cut.csv", QUOTED)
    whole = _write(f"{workdir}/in/whole.csv", HDR + '1,"a, b",c,d\n' * 20)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64b")
    try:
        assert spans_lines(spark, cut) and not spans_lines(spark, whole)
        assert _company(read_feed(spark, cut)) == QUOTED_ROWS
        assert read_feed(spark, whole).count() == 20
        with pytest.raises(FeedError, match="quoted newline"):
            read_feed(spark, cut, multiline=False)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_differing_headers_fail_the_load(spark, workdir):
    _write(f"{workdir}/in/c/a.csv", HDR + "1,Acme,Tech,US\n")
    _write(f"{workdir}/in/c/b.csv", "company_id,country,name,industry\n2,DE,Beta,Food\n")
    store = Store(spark, workdir)
    with pytest.raises(FeedError, match="differing headers"):
        load_entity(spark, store, "company", f"{workdir}/in/c")
    assert store.current_version("dim_company") is None
    assert [(r.stage, r.status) for r in read_audit(spark, store.audit_path()).collect()] == [(S.STAGE_BRONZE, S.STATUS_FAILURE)]


def test_file_names_that_are_percent_encoded(spark, workdir):
    from ledgerline.sources.csv import few_files, with_position

    # Names in the order of their paths, each with an older and a newer row of company 1.
    for k, name in enumerate(["a b.csv", "a%20c.csv", "a%b.csv", "aé#.csv"]):
        _write(f"{workdir}/in/{name}", f"company_id,name,industry,country\n1,n{2 * k},x,y\n1,n{2 * k + 1},x,y\n")
    _write(f"{workdir}/in/empty file.csv", "")
    feed = read_feed(spark, f"{workdir}/in").cache()
    assert dict(feed.dtypes)[S.ROW_ORD] == "bigint" and feed.select(S.ROW_ORD).distinct().count() == 8
    assert [r.name for r in feed.orderBy(S.ROW_ORD).collect()] == [f"n{i}" for i in range(8)]
    res = load_entity(spark, Store(spark, workdir), "company", f"{workdir}/in")
    assert (res.raw_rows, res.clean_rows, res.quarantined_rows) == (8, 1, 7)
    # A file that is not in the list: no number, so the place holds the file itself.
    scan = spark.read.option("header", True).csv(f"{workdir}/in")
    files = few_files(spark, f"{workdir}/in")
    assert dict(with_position(scan, files[1:]).dtypes)[S.ROW_ORD].startswith("struct")
    assert with_position(scan, files[1:]).select(S.ROW_ORD).distinct().count() == 8


def test_compressed_feed(spark, workdir):
    import gzip

    os.makedirs(_local(f"{workdir}/in"), exist_ok=True)
    with gzip.open(_local(f"{workdir}/in/c.csv.gz"), "wt") as f:
        f.write(QUOTED)
    store = Store(spark, workdir)
    assert load_entity(spark, store, "company", f"{workdir}/in/c.csv.gz").clean_rows == 3
    assert _company(read_golden(store, "dim_company")) == QUOTED_ROWS


def test_header_only_file_is_refused_and_not_audited(spark, workdir):
    store = Store(spark, workdir)
    with pytest.raises(FeedError, match="no data rows"):
        load_entity(spark, store, "company", _write(f"{workdir}/in/c.csv", HDR))
    assert read_audit(spark, store.audit_path()).count() == 0


def test_many_quotes_in_a_long_row_are_counted_in_linear_time(spark, workdir):
    store = Store(spark, workdir)
    long = ('"x,""y"' + "," + "q" * 20 + '"') * 3000
    with pytest.raises(FeedError):
        load_entity(spark, store, "company", _write(f"{workdir}/in/c.csv", HDR + "1,a,b,c," + long + "\n"))


def test_two_stores_lose_no_update(spark, workdir):
    a, b = Store(spark, workdir), Store(spark, workdir)
    load_entity(spark, a, "company", _write(f"{workdir}/in/1.csv", HDR + "1,a,b,c\n"))
    assert b.current_version("dim_company") is not None
    load_entity(spark, a, "company", _write(f"{workdir}/in/2.csv", HDR + "2,a,b,c\n"))
    load_entity(spark, b, "company", _write(f"{workdir}/in/3.csv", HDR + "3,a,b,c\n"))
    assert sorted(r.company_id for r in read_golden(a, "dim_company").collect()) == ["1", "2", "3"]
    rev = "company_id,month,revenue,currency,updated_at\n2,2024-01,1,USD,2024-01-01\n"
    assert load_entity(spark, b, "revenue", _write(f"{workdir}/in/r.csv", rev)).clean_rows == 1


def test_stale_base_is_refused(spark, workdir):
    from ledgerline.sources.store import StaleBase

    store = Store(spark, workdir)
    load_entity(spark, store, "company", _write(f"{workdir}/in/1.csv", HDR + "1,a,b,c\n"))
    base = store.current("dim_company")
    rows = read_golden(store, "dim_company")
    store.publish("dim_company", rows, "x", base=base)
    with pytest.raises(StaleBase):
        store.publish("dim_company", rows, "y", base=base)
    assert store.current_version("dim_company") == "x" and store.committed("dim_company", "x") and not store.committed("dim_company", "y")


def _revenue(months, value=1):
    return "company_id,month,revenue,currency,updated_at\n" + "".join(f"1,{m},{value},USD,2024-01-01\n" for m in months)


def test_a_month_rewrites_its_year_only(spark, workdir):
    from ledgerline.plans.read import read_financials

    store, fact = Store(spark, workdir), "fact_company_monthly_financials"
    load_entity(spark, store, "company", _write(f"{workdir}/in/c.csv", HDR + "1,a,b,c\n2,a,b,c\n"))
    first = load_entity(spark, store, "revenue", _write(f"{workdir}/in/r1.csv", _revenue(["2022-05", "2023-01", "2023-02", "odd"]))).load_uuid
    second = load_entity(spark, store, "revenue", _write(f"{workdir}/in/r2.csv", _revenue(["2023-02", "2024-01"], 7))).load_uuid
    assert store.current(fact).parts == {"fact_year=2022": first, "fact_year=2023": second, "fact_year=2024": second, "fact_year=other": first}
    got = {r.month: r.revenue for r in read_golden(store, fact).collect()}
    assert got == {"2022-05": 1.0, "2023-01": 1.0, "2023-02": 7.0, "2024-01": 7.0, "odd": 1.0}
    one = read_financials(read_golden(store, fact, with_year=True), month="2023-02")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fact_year" in plan.replace("PartitionFilters: [IsNotNull", "PartitionFilters: [isnotnull") and one.count() == 1
    assert read_financials(read_golden(store, fact, with_year=True), month="odd").count() == 1
    # A metrics run for one company leaves the years of others alone and counts its scope.
    load_entity(spark, store, "revenue", _write(f"{workdir}/in/r3.csv", "company_id,month,revenue,currency,updated_at\n2,2030-01,1,USD,2024-01-01\n"))
    before = store.current(fact).parts
    summary = calculate_metrics(spark, store, "2")
    after = store.current(fact).parts
    assert {p for p in after if after[p] != before.get(p)} == {"fact_year=2030"}
    assert (summary["total_rows"], summary["eligible_rows"], summary["updated_rows"]) == (1, 0, 1) and summary["computed_at"] and summary["message"]
    # Old versions go on request; the current one stays whole.
    assert store.expire(fact, keep=1) and {r.month for r in read_golden(store, fact).collect()} == set(got) | {"2030-01"}
    assert store.entry_of(fact, first) is None and store.versions(fact).count() == 1


def test_failures_of_each_stage_are_audited(spark, workdir, monkeypatch):
    from ledgerline.plans import loader as L

    store = Store(spark, workdir)
    p = _write(f"{workdir}/in/c.csv", HDR + "1,a,b,c\n")

    def audit():
        return sorted((r.stage, r.status) for r in read_audit(spark, store.audit_path()).collect())

    with pytest.raises(FeedError, match="preprocess dropped"):
        load_entity(spark, store, "company", p, preprocess=lambda d: d.select("company_id", "name", "industry", "country"))
    assert audit() == [(S.STAGE_BRONZE, S.STATUS_FAILURE)]
    with pytest.raises(Exception):
        load_entity(spark, store, "company", p, preprocess=lambda d: d.withColumn("name", F.raise_error(F.lit("boom")).cast("string")))
    assert audit() == [(S.STAGE_BRONZE, S.STATUS_FAILURE)] * 2
    monkeypatch.setattr(L, "value_rules", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load_entity(spark, store, "company", p)
    assert audit()[2:] == [(S.STAGE_BRONZE, S.STATUS_SUCCESS), (S.STAGE_QUARANTINE, S.STATUS_FAILURE), (S.STAGE_SILVER, S.STATUS_FAILURE)]
    assert store.current_version("dim_company") is None


def test_json_rows_keep_every_key(spark):
    import datetime as dt
    import json

    from ledgerline.plans.read import as_json

    df = spark.createDataFrame([("1", None, float("nan"), dt.datetime(2024, 1, 1, 1, 2, 3, 456789), dt.date(2024, 1, 1)),
                                ("2", 1.5, 2.0, dt.datetime(2024, 1, 1), None)], "company_id string, revenue double, x double, updated_at timestamp, d date")
    assert [json.loads(r.json) for r in as_json(df).collect()] == [
        {"company_id": "1", "revenue": None, "x": None, "updated_at": "2024-01-01T01:02:03.456789", "d": "2024-01-01"},
        {"company_id": "2", "revenue": 1.5, "x": 2.0, "updated_at": "2024-01-01T00:00:00", "d": None}]


def test_offsets_order_by_instant(spark, workdir):
    store = Store(spark, workdir)
    load_entity(spark, store, "company", _write(f"{workdir}/in/c.csv", HDR + "1,a,b,c\n"))
    rev = ("company_id,month,revenue,currency,updated_at\n1,2024-01,1,USD,2024-01-01T06:00:00Z\n"
           "1,2024-01,2,USD,2024-01-01T10:00:00+05:00\n")
    load_entity(spark, store, "revenue", _write(f"{workdir}/in/r.csv", rev))
    assert read_golden(store, "fact_company_monthly_financials").first().revenue == 1.0


def test_metrics_run_spreads_odd_months(spark, workdir, monkeypatch):
    """Odd months beyond the bound of a window give the same metrics by ranges."""
    from ledgerline.operators import metrics
    from ledgerline.plans import loader

    store = Store(spark, workdir)
    load_entity(spark, store, "company", _write(f"{workdir}/in/c.csv", "company_id,name,industry,country\n1,A,x,y\n2,B,x,y\n"))
    months = [f"2024-{m:02d}" for m in range(1, 13)] + [f"odd {i:03d}" for i in range(60)]
    for entity, col in (("revenue", "revenue,currency"), ("expense", "expenses,currency")):
        rows = "".join(f"{c},{m},{i % 9 + 1},USD,2024-01-01\n" for c in (1, 2) for i, m in enumerate(months))
        load_entity(spark, store, entity, _write(f"{workdir}/in/{entity}.csv", f"company_id,month,{col},updated_at\n{rows}"))
    fact = "fact_company_monthly_financials"
    cols = ["company_id", "month", *S.METRIC_COLUMNS]
    plain = calculate_metrics(spark, store)
    want = sorted(map(tuple, read_golden(store, fact).select(*cols).collect()), key=str)
    used = []
    monkeypatch.setattr(loader, "WINDOW_ROWS", 59)
    monkeypatch.setattr(metrics, "spread_metrics", lambda df, real=metrics.spread_metrics: used.append(1) or real(df, ranges=5))
    got = calculate_metrics(spark, store)
    assert used and (got["total_rows"], got["eligible_rows"]) == (plain["total_rows"], plain["eligible_rows"]) == (144, 144)
    assert sorted(map(tuple, read_golden(store, fact).select(*cols).collect()), key=str) == want and any(r[3] is not None for r in want)
