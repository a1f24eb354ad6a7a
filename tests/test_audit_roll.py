"""Rolling the audit trail into segments."""

import json

import pytest

from ledgerline import schemas as S
from ledgerline.plans import audit as A
from ledgerline.sources import fs


def _append(spark, path, first, n):
    for i in range(first, first + n):
        A.record(spark, path, "revenue", f"/in/f{i}.csv", f"load-{i:04d}", S.STAGE_BRONZE, S.STATUS_SUCCESS, i)


def _counts(spark, path):
    return sorted(r.row_count for r in A.read_audit(spark, path).collect())


def _segments(spark, path):
    return [n for n in fs.names(spark, f"{path}_rolled") if n.startswith("segment-")]


@pytest.fixture()
def trail(spark, workdir):
    return f"{workdir}/dataload_audit"


def test_rolled_trail_reads_the_same(spark, trail):
    assert not A.roll(spark, trail)
    _append(spark, trail, 0, 5)
    before = A.read_audit(spark, trail).collect()
    early = A.read_audit(spark, trail)  # planned before the roll, run after it
    assert A.roll(spark, trail)
    assert A.read_audit(spark, trail).collect() == before == early.collect()
    _append(spark, trail, 5, 3)
    assert A.roll(spark, trail)
    assert fs.count(spark, trail) == 3 and _counts(spark, trail) == list(range(8))
    assert [r.row_count for r in A.read_audit(spark, trail, load_uuid="load-0002").collect()] == [2]


def test_files_stay_bounded(spark, trail, monkeypatch):
    monkeypatch.setattr(A, "ROLL_AT", 6)
    most = 0
    for i in range(0, 60, 2):
        _append(spark, trail, i, 2)
        A.roll_if_many(spark, trail)
        most = max(most, fs.count(spark, trail))
    assert most <= 3 * 6 and _counts(spark, trail) == list(range(60))
    state, _ = A._newest(spark, trail)
    assert len(state.segments) <= 3 and sum(n for _, n in state.segments) >= 48
    assert fs.count(spark, f"{trail}_rolled/log") <= 2 and len(_segments(spark, trail)) <= len(state.segments) + len(state.retired)


@pytest.mark.parametrize("text", ["", '{"number": 1, "segm'])
def test_torn_entry_changes_nothing(spark, trail, text):
    _append(spark, trail, 0, 3)
    assert A.roll(spark, trail)
    fs.write_over(spark, f"{trail}_rolled/log/000000000001.json", text)
    _append(spark, trail, 3, 2)
    assert _counts(spark, trail) == list(range(5))
    assert A.roll(spark, trail) and A._newest(spark, trail)[0].number == 2
    assert _counts(spark, trail) == list(range(5))


def test_killed_before_publish_and_lost_race(spark, trail, monkeypatch):
    _append(spark, trail, 0, 3)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(A.fs, "write_new", killed)
        with pytest.raises(KeyboardInterrupt):
            A.roll(spark, trail)
    assert _counts(spark, trail) == [0, 1, 2] and A._newest(spark, trail)[0].number == -1
    left = _segments(spark, trail)
    with monkeypatch.context() as m:
        m.setattr(A.fs, "write_new", lambda *_: False)
        assert not A.roll(spark, trail)
    assert _segments(spark, trail) == left and _counts(spark, trail) == [0, 1, 2]
    assert A.roll(spark, trail) and _counts(spark, trail) == [0, 1, 2]


def test_errors_do_not_break_a_load(spark, trail, monkeypatch):
    _append(spark, trail, 0, 2)
    monkeypatch.setattr(A, "ROLL_AT", 1)
    monkeypatch.setattr(A, "_newest", lambda *_: json.loads("torn"))
    A.roll_if_many(spark, trail)
