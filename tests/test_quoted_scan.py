"""Feeds with quoted newlines are cut into splits at any place and lose nothing."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from conftest import _write_text as _write
from ledgerline import schemas as S
from ledgerline.plans.loader import load_entity, read_golden
from ledgerline.sources import csv as C
from ledgerline.sources.csv import FeedError, read_feed
from ledgerline.sources.store import Store

HDR = ["company_id", "name", "industry", "country"]


def feed(n, seed=1, longest=40):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        name = r.choice(["plain", 'say ""hi""'.replace('""', '"'), "two\nlines", 'a\n\n"b"\nc', "é,\n😀", "\n", "x" * r.randint(0, longest), 'end"'])
        rows.append([str(i), name, r.choice(["ind", "a,b", "q\nq"]), "c"])
    out = io.StringIO()
    w = csv.writer(out, lineterminator="\n")
    w.writerow(HDR)
    w.writerows(rows)
    return rows, out.getvalue()


@pytest.fixture()
def small_splits(spark, monkeypatch):
    """Every split as small as a test wants, files of any size cut."""
    monkeypatch.setattr(C, "SMALL_FEED", 0)
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}

    def set_(size):
        spark.conf.set(keys[0], f"{size}b")
        spark.conf.set(keys[1], "1")

    yield set_
    for k, v in old.items():
        spark.conf.set(k, v)


def read(spark, path):
    df = read_feed(spark, path)
    got = df.orderBy(S.ROW_ORD).collect()
    assert len({r[S.ROW_ORD] for r in got}) == len(got) == len({r[S.ROW_ID] for r in got})
    return [[r[c] for c in HDR] for r in got]


@pytest.mark.parametrize("size", [17, 64, 301, 1000, 5000])
def test_files_cut_at_every_offset_class(spark, workdir, small_splits, size):
    rows, text = feed(160, seed=size)
    path = _write(f"{workdir}/in/a.csv", text)
    small_splits(size)
    assert read(spark, path) == [[x if x != "" else None for x in r] for r in rows]


def test_same_as_whole_files(spark, workdir, small_splits):
    rows, text = feed(300, seed=9)
    for k in range(3):
        _write(f"{workdir}/in/{k} f.csv", text if k else text.replace("\n", "\r\n"))
    small_splits(500)
    whole = read_feed(spark, f"{workdir}/in", multiline=True)
    split = read_feed(spark, f"{workdir}/in")
    assert split.drop(S.ROW_ID, S.ROW_ORD).columns == whole.drop(S.ROW_ID, S.ROW_ORD).columns

    def values(df):
        return [[(r[c] or "").replace("\r\n", "\n") for c in HDR] for r in df.orderBy(S.ROW_ORD).collect()]

    assert values(split) == values(whole)


def test_many_tasks_parse_one_file(spark, workdir, small_splits):
    rows, text = feed(2000, seed=3)
    path = _write(f"{workdir}/in/a.csv", text)
    small_splits(4000)
    df = read_feed(spark, path)
    assert df.select(F.spark_partition_id().alias("p")).distinct().count() > 4
    assert df.count() == 2000


def test_too_many_splits_inside_quotes_are_parsed_whole(spark, workdir, small_splits, monkeypatch):
    rows, text = feed(100, seed=12)
    path = _write(f"{workdir}/in/a.csv", text)
    small_splits(200)
    monkeypatch.setattr(C, "MOST_INSIDE", 2)
    assert C.quoted_records(spark, path) is None
    assert read(spark, path) == [[x if x != "" else None for x in r] for r in rows]


def test_one_record_over_many_splits_and_an_open_quote(spark, workdir, small_splits):
    long = "\n".join("line %d" % i for i in range(400))
    small_splits(100)
    path = _write(f"{workdir}/in/a.csv", ",".join(HDR) + f'\n1,"{long}",i,c\n2,b,i,c\n')
    assert read(spark, path) == [["1", long, "i", "c"], ["2", "b", "i", "c"]]
    path = _write(f"{workdir}/in2/a.csv", ",".join(HDR) + '\n1,a,i,c\n2,"never closed,i,c\n3,x,i,c\n')
    got = read(spark, path)
    assert got[0] == ["1", "a", "i", "c"] and len(got) == 2 and got[1][0] == "2"


def test_load_of_a_cut_feed(spark, workdir, small_splits):
    rows, text = feed(120, seed=4)
    small_splits(700)
    store = Store(spark, workdir)
    res = load_entity(spark, store, "company", _write(f"{workdir}/in/a.csv", text + text.split("\n", 1)[1]))
    assert (res.raw_rows, res.clean_rows, res.quarantined_rows) == (240, 120, 120)
    names = {r.company_id: r.name for r in read_golden(store, "dim_company").collect()}
    strip = " \t\n\x0b\x0c\r"
    assert names == {i: n.strip(strip) or names[i] for i, n, *_ in rows}


def test_other_headers_and_long_rows_are_refused(spark, workdir, small_splits):
    small_splits(50)
    _write(f"{workdir}/in/a.csv", ",".join(HDR) + '\n1,"a\nb",i,c\n')
    _write(f"{workdir}/in/b.csv", "company_id,name,country,industry\n1,a,i,c\n")
    with pytest.raises(FeedError, match="differing headers"):
        load_entity(spark, Store(spark, workdir), "company", f"{workdir}/in")
    path = _write(f"{workdir}/in3/a.csv", ",".join(HDR) + '\n1,"a\nb",i,c,more\n2,x,i,c\n3,y\n')
    with pytest.raises(FeedError, match="more fields"):
        load_entity(spark, Store(spark, workdir), "company", path)
