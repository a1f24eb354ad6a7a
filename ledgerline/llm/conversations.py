"""Conversation structure repair: weighted CYK parsing of edits over spans.

A repaired conversation has the role initials ``(s?(ua)+)?``. The grammar is in
Chomsky normal form: its symbols are pairs of places in that pattern (before
anything, after ``s``, after ``u``, after ``a``), a pair yields two pairs that
meet (binary rules) or one edited row (lexical rules), and empty-text turns may
be inserted anywhere (closure). A cell holds for one span of rows and each
symbol the least (cost, audit): the audit has a letter for each edit, K(eep),
R(erole), D(elete) and I(nsert). Cells are combined bottom-up by span length.

Pairs of places meet at any row, so every split of a span gives the same cell
and one split, in the middle, is enough: the work is linear in cells and
``n log n`` in letters. The least audit may be built from least parts since of
two audits of one span with equal cost neither is the beginning of the other
(what follows would be insertions, which cost).

Rows are range-dealt and sorted by conversation and turn. A conversation that
lies inside one partition is parsed there. Those that cross a border (two at
most for each partition, however large they are) come out as rows; their
repeated turns are found by a grouping, their segments are parsed where they
lie, and only cells meet: as many for a conversation as partitions it spans.
SHA-256 runs over a conversation's repaired turns in order, so that alone is a
stream in one task; it keeps one Arrow batch in memory.

Defined cases: nulls of the conversation, turn, role and text count as one
space in the damage key, role and text; a null conversation is a conversation
of its own. Rows of one turn follow by role, then by text (its first 100
characters, then its SHA-256); copies are adjacent and interchangeable. An
empty role has no initial and can't be kept. Rows must come from a source that
gives the same rows in the same splits when it is read again (a table). An
audit is one string, so one conversation can hold 2 GB of them. Other columns
of the input are ignored. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_SPACE = " \t\n\x0b\x0c\r"
#: Places in the pattern: start, after s, after u, after a.
_PLACES, _ENDS = 4, (0, 3)
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_ROLES = {"u": "user", "a": "assistant"}
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
_LEGAL = ("su", "ua", "au")


# --- cells ---------------------------------------------------------------------
def combine(left: tuple, right: tuple) -> tuple:
    """Binary rules: the cell of two adjacent spans."""
    out = [None] * (_PLACES * _PLACES)
    for p in range(_PLACES):
        for q in range(_PLACES):
            a = left[p * _PLACES + q]
            if a is None:
                continue
            for r in range(_PLACES):
                b = right[q * _PLACES + r]
                if b is None:
                    continue
                best, cost = out[p * _PLACES + r], a[0] + b[0]
                if best is None or cost < best[0] or (cost == best[0] and a[1] + b[1] < best[1]):
                    out[p * _PLACES + r] = (cost, a[1] + b[1])
    return tuple(out)


def _insertions() -> tuple:
    """The closure of insertions: the cell of an empty span."""
    out = [(0, "") if p == q else None for p in range(_PLACES) for q in range(_PLACES)]
    for _ in range(_PLACES):
        for p in range(_PLACES):
            for (q, c), r in _NEXT.items():
                a = out[p * _PLACES + q]
                if c in _ROLES and a is not None:
                    new = (a[0] + INSERT, a[1] + "I")
                    if out[p * _PLACES + r] is None or new < out[p * _PLACES + r]:
                        out[p * _PLACES + r] = new
    return tuple(out)


EMPTY = _insertions()


@lru_cache(maxsize=4096)
def leaf(initial: str, bad: bool, truncated: bool) -> tuple:
    """Lexical rules: one row; a bad one (blank, duplicate) can only go."""
    out = [None] * (_PLACES * _PLACES)

    def offer(p, q, cost, letter):
        old = out[p * _PLACES + q]
        if old is None or (cost, letter) < old:
            out[p * _PLACES + q] = (cost, letter)

    for p in range(_PLACES):
        offer(p, p, DELETE, "D")
        if not bad:
            more = TRUNCATED if truncated else 0
            for c in _ROLES:
                if (p, c) in _NEXT:
                    offer(p, _NEXT[p, c], REROLE + more, "R")
            if (p, initial) in _NEXT:
                offer(p, _NEXT[p, initial], more, "K")
    return combine(combine(EMPTY, tuple(out)), EMPTY)


def parse(cells: list[tuple]) -> tuple:
    """The cell of a whole span, bottom-up by span length."""
    if not cells:
        return EMPTY
    while len(cells) > 1:
        cells = [combine(cells[i], cells[i + 1]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0]


def cheapest(cell: tuple) -> tuple[int, str]:
    """(cost, audit) of a span that is a whole conversation."""
    return min(cell[q] for q in _ENDS if cell[q] is not None)


def turns_of(audit: str):
    """(index of the row or None, role or None for the row's own) of each
    repaired turn. The number of turns fixes their roles: odd means ``s`` first."""
    odd = (len(audit) - audit.count("D")) % 2
    row = place = 0
    for letter in audit:
        if letter == "D":
            row += 1
            continue
        role = None if letter == "K" else _ROLES["ua"[(place - odd) % 2]]
        place += 1
        yield (None if letter == "I" else row), role
        row += letter != "I"


# --- rows ----------------------------------------------------------------------
def _spaced(c) -> Column:
    return F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) with faults by the checksum of
    ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties the text, 2 removes
    its sentence marks, 3 repeats the row, 4 sets the role ``user``."""
    kind = F.pmod(F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn")).cast("binary")), F.lit(20))
    df = rows.select("conv_id", "turn", _spaced("role").alias("role"), _spaced("text").alias("text"), kind.alias("__kind"))
    text = F.when(F.col("__kind") == 1, "").when(F.col("__kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    df = df.where("__kind <> 0").select(
        "conv_id", "turn", F.when(F.col("__kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("__kind") == 3, 2).otherwise(1))).alias("__copy"))
    return df.drop("__copy")


_KINDS = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "longs": T.ArrayType(T.LongType()),
          "ints": T.ArrayType(T.IntegerType()), "strings": T.ArrayType(T.StringType())}


def _schema(fields: str) -> T.StructType:
    """A schema from 'name kind' pairs; workers have no session to parse DDL."""
    return T.StructType([T.StructField(n, _KINDS[k]) for n, k in (f.split() for f in fields.split(", "))])


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_FIRST = _schema("kind string, conv string, part int, i long, turn long, role string, text string, " + _REPORT)


def _sorted(rows: DataFrame) -> DataFrame:
    """Rows in order of conversation and turn, dealt out by ranges. The last
    key parts rows that are alike in all else."""
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    df = rows.select(conv.alias("conv"), F.col("turn").cast("bigint").alias("turn"), _spaced("role").alias("role"), _spaced("text").alias("text"))
    df = df.select("*", F.left("text", F.lit(100)).alias("__head"), F.sha2("text", 256).alias("__digest"), F.monotonically_increasing_id().alias("__row"))
    keys = ["conv", F.asc_nulls_first("turn"), "role", "__head", "__digest", "__row"]
    return (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
            .select("conv", "turn", "role", "text", F.spark_partition_id().alias("part")))


def fault_of(text: str) -> str | None:
    body = text.strip(_SPACE)
    return "blank" if not body else None if body[-1] in ".!?" else "truncated"


def _hashed(lines) -> str:
    digest, first = hashlib.sha256(), True
    for role, text in lines:
        digest.update((("" if first else "\n") + f"{role}:{text}").encode("utf-8", "replace"))
        first = False
    return digest.hexdigest()


def _repair(rows: list[tuple], turns: bool) -> list[dict]:
    """One conversation: (turn, role, text) in order."""
    seen, faults, cells = set(), [], []
    for _, role, text in rows:
        fault = fault_of(text)
        if fault != "blank":
            fault = "duplicate" if (role, text) in seen else fault
            seen.add((role, text))
        faults.append(fault)
        cells.append(leaf(role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    cost, audit = cheapest(parse(cells))
    lines = [(role or rows[k][1], "" if k is None else rows[k][2]) for k, role in turns_of(audit)]
    if turns:
        return [{"kind": "turn", "i": n, "role": role, "text": text} for n, (role, text) in enumerate(lines)]
    known = [t for t, _, _ in rows if t is not None]
    return [{
        "kind": "conv", "gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0,
        **{x: faults.count(x) for x in ("blank", "duplicate", "truncated")},
        "illegal": sum(a[1][:1] + b[1][:1] not in _LEGAL for a, b in zip(rows, rows[1:])),
        "cost": cost, "audit": audit, "repaired_sha256": _hashed(lines)}]


def _local(turns: bool):
    """Conversations inside a partition are repaired; the rows of its first
    and last one, which may go on in the next partitions, come out as rows."""
    schema = to_arrow_schema(_FIRST)

    def run(batches):
        conv, part, held, first, at = None, 0, [], True, 0
        out, size = [], 0

        def edges():
            nonlocal at
            for turn, role, text in held:
                yield {"kind": "row", "conv": conv, "part": part, "i": at, "turn": turn, "role": role, "text": text}
                at += 1

        def found():
            nonlocal conv, part, held, first, at
            for b in batches:
                for c, turn, role, text, p in zip(*[x.to_pylist() for x in b.columns]):
                    if conv is None:
                        conv = c
                    if c != conv:
                        if first:
                            yield from edges()
                        else:
                            for r in _repair(held, turns):
                                yield r | {"conv": conv, "part": part}
                        conv, held, first, at = c, [], False, 0
                    part = p
                    held.append((turn, role, text))
                if first:  # not needed here: it goes on as rows in any case
                    yield from edges()
                    held = []
            yield from edges()

        for row in found():
            out.append(row)
            size += len(row.get("text") or "") + len(row.get("audit") or "") + 100
            if size > 1 << 23:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


_CELL = _schema("conv string, part int, n long, blank long, duplicate long, truncated long, illegal long, head string, tail string, "
                             "costs longs, audits strings")


def _cells(batches):
    """One cell and the counts for each (conversation, partition)."""
    schema = to_arrow_schema(_CELL)
    key, held, out = None, [], []

    def close():
        faults = [f for _, f in held]
        cell = parse([leaf(r, f in ("blank", "duplicate"), f == "truncated") for r, f in held])
        out.append({"conv": key[0], "part": key[1], "n": len(held), **{x: faults.count(x) for x in ("blank", "duplicate", "truncated")},
                    "illegal": sum(a[0] + b[0] not in _LEGAL for a, b in zip(held, held[1:])), "head": held[0][0], "tail": held[-1][0],
                    "costs": [c and c[0] for c in cell], "audits": [c and c[1] for c in cell]})

    for b in batches:
        for conv, part, initial, fault in zip(*[x.to_pylist() for x in b.columns]):
            if key != (conv, part):
                if held:
                    close()
                key, held = (conv, part), []
            held.append((initial, fault))
    if held:
        close()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


_PLAN = _schema("conv string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
                             "starts longs, parts ints")


def _plans(batches):
    """The cells of a conversation's segments meet, in order."""
    schema = to_arrow_schema(_PLAN)
    for b in batches:
        out = []
        for conv, segments in zip(*[x.to_pylist() for x in b.columns]):
            cost, audit = cheapest(parse([tuple(None if c is None else (c, a) for c, a in zip(s["costs"], s["audits"])) for s in segments]))
            starts = [0]
            for s in segments:
                starts.append(starts[-1] + s["n"])
            out.append({"conv": conv, **{x: sum(s[x] for s in segments) for x in ("blank", "duplicate", "truncated")},
                        "illegal": sum(s["illegal"] for s in segments)
                        + sum(x["tail"] + y["head"] not in _LEGAL for x, y in zip(segments, segments[1:])),
                        "cost": cost, "audit": audit, "starts": starts[:-1], "parts": [s["part"] for s in segments]})
        yield pa.RecordBatch.from_pylist(out, schema=schema)


_TURN = _schema("conv string, seq long, part int, i long, role string")


def _turns(batches):
    """The repaired turns of a plan: the row each one comes from (by segment
    and index in it) and its new role."""
    schema = to_arrow_schema(_TURN)
    for b in batches:
        for conv, audit, starts, parts in zip(*[x.to_pylist() for x in b.columns]):
            out, k = [], 0
            for seq, (row, role) in enumerate(turns_of(audit)):
                while row is not None and k + 1 < len(starts) and starts[k + 1] <= row:
                    k += 1
                out.append((conv, seq, parts[k], None if row is None else row - starts[k], role))
                if len(out) == 65536:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _digests(batches):
    """SHA-256 over the lines of each conversation; they come in order."""
    conv, digest = None, None
    for b in batches:
        out = []
        for c, role, text in zip(*[x.to_pylist() for x in b.columns]):
            line = f"{role}:{text}".encode("utf-8", "replace")
            if c != conv:
                if digest is not None:
                    out.append((conv, digest.hexdigest()))
                conv, digest = c, hashlib.sha256(line)
            else:
                digest.update(b"\n" + line)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*out)], names=["conv", "repaired_sha256"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.string()), pa.array([digest.hexdigest()], pa.string())], names=["conv", "repaired_sha256"])


def _crossing(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(plans, repaired turns) of conversations whose rows are given."""
    body = F.translate("text", _SPACE, "")
    df = edges.select("conv", "part", "i", "role", F.left("role", F.lit(1)).alias("initial"), F.sha2("text", 256).alias("digest"),
                      F.when(body == "", "blank").when(~F.right(body, F.lit(1)).isin(".", "!", "?"), "truncated").alias("fault"))
    again = (df.where("fault IS DISTINCT FROM 'blank'").groupBy("conv", "role", "digest")
             .agg(F.count("*").alias("n"), F.min(F.struct("part", "i")).alias("first")).where("n > 1").drop("n"))
    df = (df.join(again, ["conv", "role", "digest"], "left")
          .withColumn("fault", F.when((F.col("fault").isNull() | (F.col("fault") != "blank")) & (F.struct("part", "i") > F.col("first")), "duplicate")
                      .otherwise(F.col("fault"))))
    cells = (df.select("conv", "part", "i", "initial", "fault").repartition("conv", "part").sortWithinPartitions("conv", "part", "i")
             .select("conv", "part", "initial", "fault").mapInArrow(_cells, _CELL))
    segments = F.sort_array(F.collect_list(F.struct("part", *[f for f in _CELL.names if f not in ("conv", "part")])))
    plans = cells.groupBy("conv").agg(segments.alias("segments")).mapInArrow(_plans, _PLAN).checkpoint()
    turns = plans.select("conv", "audit", "starts", "parts").mapInArrow(_turns, _TURN).alias("t")
    rows = edges.select("conv", "part", "i", F.col("role").alias("own"), "text")
    turns = turns.join(rows, ["conv", "part", "i"], "left").select(
        "conv", "seq", F.coalesce("role", "own").alias("role"), F.when(F.col("i").isNull(), "").otherwise(F.col("text")).alias("text"))
    return plans, turns


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The turns (conv, seq, role, text) of all conversations after repair.
    ``conv`` is the id as text after ``=``, empty for a null id."""
    found = _sorted(rows).mapInArrow(_local(True), _FIRST).checkpoint()
    _, turns = _crossing(found.where("kind = 'row'"))
    return found.where("kind = 'turn'").select("conv", F.col("i").alias("seq"), "role", "text").unionByName(turns)


def report(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """For each id of ``ids`` (conv_id): gaps and faults of its ``rows``
    (conv_id, turn, role, text), the cheapest repair and its turns' digest."""
    names = _schema(_REPORT).names
    found = _sorted(rows).mapInArrow(_local(False), _FIRST).checkpoint()
    edges = found.where("kind = 'row'")
    plans, turns = _crossing(edges)
    spans = edges.groupBy("conv").agg(F.min("turn").alias("lo"), F.max("turn").alias("hi"))
    known = edges.where("turn IS NOT NULL").groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg(F.count("*").alias("known"))
    digests = turns.repartition("conv").sortWithinPartitions("conv", "seq").select("conv", "role", "text").mapInArrow(
        _digests, "conv string, repaired_sha256 string")
    nothing = hashlib.sha256(b"").hexdigest()
    crossing = (plans.join(spans, "conv").join(known, "conv", "left").join(digests, "conv", "left")
                .select("conv", F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("known"), F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated",
                        "illegal", "cost", "audit", F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256")))
    all_of = found.where("kind = 'conv'").select("conv", *names).unionByName(crossing)
    ids = ids.select("conv_id").distinct().select("conv_id", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"))
    missing = {"audit": F.lit(""), "repaired_sha256": F.lit(nothing)}
    return ids.join(all_of, "conv", "left").select("conv_id", *[F.coalesce(n, missing.get(n, F.lit(0).cast("bigint"))).alias(n) for n in names])
