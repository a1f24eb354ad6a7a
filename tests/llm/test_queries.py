"""The registered queries on the smallest tables: contract columns, whole
results, and the SQL twins where there are any."""

import hashlib
import math
import zlib
from collections import Counter

import pytest

from conftest import SF_SMALL
from ledgerline.llm import registry as R
from oracle_check import _norm, duck

COLUMNS = {
    "op1_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op2_quality": "doc_id held_out score predicted",
    "op3_merkle": "archive volume root_a root_b same nodes_compared n_damaged damaged",
    "op4_html_crf": "page_id url text n_chars",
    "op5_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op6_imatch": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op7_toxicity": "doc_id held_out score predicted",
    "op8_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op9_simhash": "doc_id fingerprint component_id",
    "op10_katz": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op11_collocations": "lang rank phrase a l r n score",
    "op12_conversation_repair": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    "op13_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
}
KINDS = {"n_words": "bigint", "n_hit": "bigint", "contaminated": "boolean", "held_out": "boolean", "predicted": "int",
         "text": "string", "n_chars": "bigint", "n_email": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
         "offset": "bigint", "near_edited": "double", "near_next": "double", "n_tokens": "bigint", "base_score": "double", "fingerprint": "string",
         "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean",
         "gaps": "bigint", "blank": "bigint", "duplicate": "bigint", "truncated": "bigint", "illegal": "bigint", "cost": "bigint", "audit": "string",
         "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint"}


def test_one_query_for_each_operator():
    assert sorted(R.QUERIES) == sorted(COLUMNS)


@pytest.fixture(scope="module")
def result(spark):
    kept = {}

    def get(name):
        if name not in kept:
            df = R.QUERIES[name](spark, SF_SMALL)
            kept[name] = (df.dtypes, df.collect())
        return kept[name]

    return get


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract(spark, result, name):
    dtypes, rows = result(name)
    want = COLUMNS[name].split()
    assert [c for c, _ in dtypes][:len(want)] == want
    kinds = KINDS | {"score": "bigint" if name == "op11_collocations" else "double"}
    assert all(kinds.get(c, t) == t for c, t in dtypes[:len(want)])
    if name == "op11_collocations":
        return
    source, key = {"op3_merkle": ("pages", "page_id"), "op4_html_crf": ("pages", "page_id"), "op12_conversation_repair": ("conversations", "conv_id")}.get(
        name, ("documents", "doc_id"))
    ids = [r[0] for r in spark.read.parquet(f"{SF_SMALL}/{source}.parquet").select(key).collect()]
    ids = set(ids) if source == "conversations" else ids
    if name != "op3_merkle":
        assert Counter(r[0] for r in rows if name != "op8_packing" or r.piece == 0) == Counter(ids)


@pytest.mark.parametrize("name", sorted(R.oracle_sql()))
def test_twin(result, name):
    dtypes, rows = result(name)
    res = duck(SF_SMALL).execute(R.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(c for c, _ in dtypes)
    assert Counter(tuple(_norm(r[c]) for c in sorted(cols)) for r in rows) == Counter(
        tuple(_norm(r[cols.index(c)]) for c in sorted(cols)) for r in res.fetchall())


def test_held_out_rows_and_thresholds(result):
    for name, mod, rest, at in (("op2_quality", 5, 0, 0.3), ("op7_toxicity", 3, 1, 0.7), ("op10_katz", 7, 2, None)):
        for r in result(name)[1]:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == rest)
            assert at is None or r.predicted == int(r.score >= at) and 0 <= r.score <= 1


def test_language_model_beats_the_base_on_held_out_texts(result):
    held = [r for r in result("op10_katz")[1] if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) and all(math.isfinite(r.score) for r in held)


def test_personal_data_matches_brute_force(spark, result):
    from test_pii import brute

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in result("op5_pii")[1]:
        assert ([r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) == brute(texts[r.doc_id])


def test_groups_match_brute_force(spark, result):
    from test_simhash import brute_groups

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert sorted(map(tuple, result("op9_simhash")[1]), key=repr) == brute_groups(rows)


def test_edited_texts(spark, result):
    rows = sorted(((r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()), reverse=True)
    got = {r.doc_id: r.edited_sha256 for r in result("op6_imatch")[1]}
    for (d, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        assert got[d] == hashlib.sha256((t[:len(t) - half] + nxt[:half]).encode()).hexdigest()
