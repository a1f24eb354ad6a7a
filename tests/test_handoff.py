"""CSV hand-off: whole or not at all, in order, read back as a feed."""

import datetime as dt
import json
import os

import pytest

from ledgerline import schemas as S
from ledgerline.plans.loader import load_entity, read_golden
from ledgerline.sources import fs
from ledgerline.sources.csv import FeedError
from ledgerline.sources.handoff import MANIFEST, Exists, hand_off, read_hand_off
from ledgerline.sources.store import Store

ROWS = [(i, ["plain", 'a "quote"', "two\nlines", "comma, here", " spaces ", None][i % 6], dt.datetime(2024, 1, 1, 0, 0, i % 60)) for i in range(500)]
DDL = "id long, name string, at timestamp_ntz"


def test_round_trip_in_order(spark, workdir):
    df = spark.createDataFrame(ROWS[::-1], DDL).repartition(7)
    manifest = hand_off(df, f"{workdir}/out/x", order_by=["id"])
    assert manifest["rows"] == 500 and manifest["columns"] == ["id", "name", "at"]
    back = read_hand_off(spark, f"{workdir}/out/x").orderBy(S.ROW_ORD).collect()
    assert [(int(r.id), r.name, dt.datetime.fromisoformat(r.at)) for r in back] == ROWS
    assert [n for n in os.listdir(f"{workdir}/out".replace("file:", ""))] == ["x"]  # nothing hidden is left


def test_a_taken_name_is_refused(spark, workdir, monkeypatch):
    df = spark.createDataFrame(ROWS[:3], DDL)
    hand_off(df, f"{workdir}/x")
    with pytest.raises(Exists):
        hand_off(df, f"{workdir}/x")
    monkeypatch.setattr(fs, "exists", lambda s, p, real=fs.exists: False if p == f"{workdir}/x" else real(s, p))
    with pytest.raises(Exists):  # another writer was faster
        hand_off(df, f"{workdir}/x")
    monkeypatch.undo()
    assert read_hand_off(spark, f"{workdir}/x").count() == 3


def test_changed_files_are_refused(spark, workdir):
    hand_off(spark.createDataFrame(ROWS[:3], DDL).coalesce(1), f"{workdir}/x")
    folder = f"{workdir}/x".replace("file:", "")
    with open(f"{folder}/{MANIFEST}") as f:
        (name, size), = json.load(f)["files"]
    assert os.path.getsize(f"{folder}/{name}") == size
    with open(f"{folder}/{name}", "a") as f:
        f.write("9,x,y\n")
    with pytest.raises(FeedError, match="manifest"):
        read_hand_off(spark, f"{workdir}/x")
    with pytest.raises(FileNotFoundError):
        read_hand_off(spark, f"{workdir}/nothing")


def test_loads_take_a_hand_off(spark, workdir):
    df = spark.createDataFrame([(str(i), f"n\n{i}", "i", "c") for i in range(20)], "company_id string, name string, industry string, country string")
    hand_off(df, f"{workdir}/company", order_by=["company_id"])
    store = Store(spark, workdir)
    assert load_entity(spark, store, "company", f"{workdir}/company").clean_rows == 20
    assert {r.name for r in read_golden(store, "dim_company").collect()} == {f"n\n{i}" for i in range(20)}


def test_empty_frame(spark, workdir):
    manifest = hand_off(spark.createDataFrame([], DDL), f"{workdir}/x")
    assert manifest["rows"] == 0
    assert read_hand_off(spark, f"{workdir}/x").collect() == []
