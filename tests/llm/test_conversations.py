"""Conversation repair against exhaustive edits and against all CYK splits."""

import hashlib
import itertools
import re
import zlib

import pytest

from ledgerline.llm import conversations as C

GOOD = re.compile(r"(s?(ua)+)?")
WORD = re.compile(r"[^\x20\x09-\x0D]")


def exhaustive(rows, most=2):
    """Least (cost, audit, lines) over all edits with at most ``most``
    insertions in a place; rows: (role, text, fault)."""
    best = None
    per_row = []
    for role, text, fault in rows:
        options = [(2, "D", None)]
        if fault not in ("blank", "duplicate"):
            more = 5 if fault == "truncated" else 0
            options += [(more, "K", (role, text)), (1 + more, "R", ("user", text)), (1 + more, "R", ("assistant", text))]
        per_row.append(options)
    gaps = [(5 * k, "I" * k, [(r, "") for r in rs]) for k in range(most + 1) for rs in itertools.product(("user", "assistant"), repeat=k)]
    for picks in itertools.product(*per_row):
        for fills in itertools.product(gaps, repeat=len(rows) + 1):
            cost = sum(x[0] for x in picks) + sum(x[0] for x in fills)
            audit = fills[0][1] + "".join(x[1] + g[1] for x, g in zip(picks, fills[1:]))
            if best is not None and (cost, audit) >= best[:2]:
                continue
            lines = list(fills[0][2])
            for x, g in zip(picks, fills[1:]):
                lines += ([x[2]] if x[2] else []) + g[2]
            if all(r for r, _ in lines) and GOOD.fullmatch("".join(r[0] for r, _ in lines)):
                best = (cost, audit, lines)
    return best


def forward(rows):
    """Least (cost, audit) by a walk over (place): another way for long rows."""
    def closed(s):
        for _ in range(4):
            for (p, c), q in C._NEXT.items():
                if c in "ua" and p in s:
                    new = (s[p][0] + 5, s[p][1] + "I")
                    s[q] = min(s.get(q, new), new)
        return s

    state = closed({0: (0, "")})
    for role, _, fault in rows:
        new = {p: (c + 2, a + "D") for p, (c, a) in state.items()}
        if fault not in ("blank", "duplicate"):
            for (p, ch), q in C._NEXT.items():
                if p in state:
                    for letter, price in (("K", 0), ("R", 1)):
                        if ch == role[:1] if letter == "K" else ch in "ua":
                            cell = (state[p][0] + price + (5 if fault == "truncated" else 0), state[p][1] + letter)
                            new[q] = min(new.get(q, cell), cell)
        state = closed(new)
    return min(state[q] for q in (0, 3) if q in state)


def brute_report(rows, walk):
    """The contract, in plain Python: rows of (conv_id, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        hurt = []
        for _, turn, role, text in [r for r in rows if r[0] == conv]:
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            kind, role, text = zlib.crc32(key.encode()) % 20, " " if role is None else role, " " if text is None else text
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            hurt += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
        hurt.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, marked = set(), []
        for _, role, text in hurt:
            body = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            fault = "blank" if not WORD.search(text) else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            marked.append((role, text, fault))
        known = [t for t, _, _ in hurt if t is not None]
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(marked, marked[1:])]
        cost, audit, lines = walk(marked)
        out[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, *[sum(f == x for *_, f in marked) for x in ("blank", "duplicate", "truncated")],
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest())
    return out


def walk(marked):
    cost, audit = forward(marked)
    return cost, audit, [(role or marked[k][0], "" if k is None else marked[k][1]) for k, role in C.turns_of(audit)]


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def got(spark, rows, damage=True):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = C.report(C.damage(df) if damage else df, df).collect()
    assert len(out) == len({r[0] for r in rows})
    return {r.conv_id: tuple(r[f] for f in FIELDS) for r in out}


@pytest.mark.parametrize("n", range(4))
def test_parse_matches_all_edits(n):
    kinds = [("user", "a.", None), ("assistant", "b.", None), ("system", "c.", None), ("user", "", "blank"), ("assistant", "d", "truncated"), ("tool", "e.", None),
             ("", "f.", None)]
    for rows in itertools.product(kinds if n < 3 else kinds[:5], repeat=n):
        cost, audit, lines = exhaustive(rows, 2 if n < 3 else 1)
        cell = C.parse([C.leaf(r[:1], f in ("blank", "duplicate"), f == "truncated") for r, _, f in rows])
        if n == 3:  # with one insertion a place the search may miss the best
            assert C.cheapest(cell) <= (cost, audit) and C.cheapest(cell) == forward(rows)
            continue
        assert C.cheapest(cell) == (cost, audit) == forward(rows), rows
        assert [(role or rows[k][0], "" if k is None else rows[k][1]) for k, role in C.turns_of(audit)] == lines


def test_every_split_gives_the_same_cell():
    import random

    rng = random.Random(5)
    for _ in range(60):
        leaves = [C.leaf(rng.choice("suax "), rng.random() < .2, rng.random() < .2) for _ in range(rng.randint(1, 7))]
        table = {(i, i + 1): x for i, x in enumerate(leaves)}
        for size in range(2, len(leaves) + 1):
            for i in range(len(leaves) - size + 1):
                cells = {C.combine(table[i, k], table[k, i + size]) for k in range(i + 1, i + size)}
                assert len(cells) == 1
                table[i, i + size] = cells.pop()
        assert C.parse(leaves) == table[0, len(leaves)]


def test_report_of_odd_conversations(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(40)]
    rows += [(2, None, None, None), (2, None, "user", "hi."), (2, None, "user", "hi."), (3, 5, "system", "x"), (3, 5, "system", "x"), (3, 9, "", "y."),
             (None, 1, "user", "né."), (None, None, "assistant", " \t"), (4, 1, "user", "a"), (5, 7, "assistant", "only!"),
             (6, -3, "user", "neg."), (6, 3, "assistant", "pos. \n"), (7, 2**40, "user", "far."), (7, 0, "user", "near.")]
    rows += [(8, t, "user", "same.") for t in range(30)] + [(9, 0, "user", f"text {i}.") for i in range(25)]
    rows += [(100 + c, t, ["system", "user", "assistant"][(c * t) % 3], f"{c} {t}" + ".?! x"[(c + t) % 5]) for c in range(60) for t in range(c % 7)]
    assert got(spark, rows) == brute_report(rows, walk)


def test_one_conversation_over_many_partitions(spark):
    """A hot conversation crosses partition borders; so do its repeated turns."""
    rows = [(0, t // 2, ["user", "assistant", "system"][t % 3], f"text {t % 190}" + ("." if t % 4 else "")) for t in range(700)]
    rows += [(1, t, "user", "one text for all.") for t in range(300)] + [(2, 0, "user", "a."), (3, 1, "assistant", "b.")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        assert C._sorted(df).where("conv = '=0'").select("part").distinct().count() > 1
        assert got(spark, rows) == brute_report(rows, walk)
        turns = sorted((r.conv, r.seq, r.role, r.text) for r in C.repaired_turns(C.damage(df)).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for conv in (0, 1, 2):
        body = "\n".join(f"{r}:{t}" for c, _, r, t in turns if c == f"={conv}")
        assert hashlib.sha256(body.encode()).hexdigest() == brute_report([r for r in rows if r[0] == conv], walk)[conv][-1]


def test_repaired_turns_follow_the_pattern(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    turns = {}
    for r in sorted(C.repaired_turns(C.damage(df)).collect(), key=lambda r: (r.conv, r.seq)):
        turns[r.conv] = turns.get(r.conv, "") + r.role[0]
    assert turns and all(GOOD.fullmatch(x) for x in turns.values())


def test_empty_table_and_extra_columns(spark):
    ddl = "conv_id long, turn long, role string, text string, audit int, part string"
    empty = spark.createDataFrame([], ddl)
    assert C.report(C.damage(empty), empty).collect() == []
    assert C.repaired_turns(C.damage(empty)).collect() == []
    df = spark.createDataFrame([(1, 3, "user", "x.", 5, "p"), (1, 4, "assistant", "y.", 6, "q")], ddl)
    assert {r.conv_id: r.audit for r in C.report(df, df).collect()} == {1: "KK"}


def test_all_rows_dropped(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    assert got(spark, [(1, turn, "user", "x.")]) == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_long_conversation_parses_in_near_linear_time():
    import time

    def seconds(n):
        leaves = [C.leaf("ua"[k % 2] if k % 7 else "s", k % 11 == 0, k % 5 == 0) for k in range(n)]
        t = time.time()
        C.parse(leaves)
        return time.time() - t

    seconds(2000)
    assert seconds(16000) < 20 * max(seconds(2000), 0.02)
