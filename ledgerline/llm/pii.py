"""Personal data by patterns, checksums and context, in DataFrame functions.

Regular expressions propose spans, checks confirm them (Luhn for cards, mod-97
for IBANs, number ranges for IP addresses and social security numbers, digit
counts for phones), and context words within ``CONTEXT`` characters raise a
span's score. The four base kinds keep every confirmed span. The other kinds
need a score of ``MIN_SCORE``.

Positions come from splitting a text at a pattern: the lengths of the pieces
and matches before a match give its start. Patterns use possessive repeats and
forbid a start inside a run that failed already, so they take linear time and
no recursion on any text while they match what the plain forms match. All is a
few projections over whole texts, kept apart by one-row generators: no shuffle,
no Python, and time linear in the matches of a text.

Defined cases: a null text counts as empty (``redact`` leaves it null); an
empty text has no spans. Spans of one kind do not overlap; those of different
kinds may and all are reported; ``redact`` masks their union once. Equal
starts are ordered by kind as listed in ``KINDS``. Repeated rows give repeated
results. Columns of the input that are named like a result column give way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shared import kept_columns

CONTEXT = 40
MIN_SCORE = 0.6

_IP_PART = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]++"


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(v: Column) -> Column:
    """Does the Luhn sum of the digits end in 0? From the right, every second
    digit counts double, less 9 when that is over 9."""
    def add(acc, i):
        d = F.ascii(F.substr(F.reverse(_digits(v)), i, F.lit(1))) - 48
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return acc + F.when(F.pmod(i, F.lit(2)) == 0, twice).otherwise(d)

    return F.pmod(F.aggregate(F.sequence(F.lit(1), F.length(_digits(v))), F.lit(0), add), F.lit(10)) == 0


def mod97(v: Column) -> Column:
    """ISO 7064: the first four characters moved to the end, letters as 10 to
    35, the number leaves 1 when divided by 97."""
    plain = F.regexp_replace(v, " ", "")
    moved = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))

    def add(acc, c):
        n = F.ascii(c)
        return F.when(n >= 65, F.pmod(acc * 100 + n - 55, F.lit(97))).otherwise(F.pmod(acc * 10 + n - 48, F.lit(97)))

    return F.aggregate(F.split(moved, "(?!^)(?!$)"), F.lit(0), add) == 1


def _always(t: Column) -> Column:
    return F.lit(True)


#: kind: pattern, cheap test of a text for it, test of a match, score, context words. The first four are the base kinds.
KINDS = {
    "email": (rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}(?:\.{_LABEL})++", lambda t: F.contains(t, F.lit("@")), _always, 0.9,
              "mail|contact|write|reply"),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _always,
           lambda v: v.rlike(rf"^(?:{_IP_PART}\.){{3}}{_IP_PART}$"), 0.6, r"\bip\b|server|host|address|login"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", _always, lambda v: F.length(_digits(v)).between(14, 19) & luhn(v), 0.8,
             "card|visa|credit|debit|pay"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: F.contains(t, F.lit("+")),
              lambda v: F.length(_digits(v)).between(10, 15), 0.7, "phone|tel|call|mobile|fax"),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])", _always,
             lambda v: F.length(F.regexp_replace(v, " ", "")).between(15, 34) & mod97(v), 0.9, "iban|bank|account|konto"),
    "ssn": (r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", lambda t: F.contains(t, F.lit("-")),
            _always, 0.45, r"ssn|social|security"),
    "secret": (r"(?i)(?<![a-z0-9])(?:password|passwd|api_?key|secret|token)[\x20]?[=:][\x20]?[^\s,;]{6,}+", _always, _always, 0.6,
               "login|user|account"),
}
BASE = ("email", "ip", "card", "phone")
RESULT_NAMES = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "found"]
_NONE = "array<struct<start:int,kind_no:int,end:int,kind:string,value:string,score:double>>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _staged(df: DataFrame, carried: list[Column], *computed: Column) -> DataFrame:
    """``carried`` and the ``computed`` columns, the latter as the one row that
    a generator gives. Later filters and projections stay above a generator, so
    no expression is repeated for each of its uses."""
    return df.select(*carried, F.inline(F.array(F.struct(*computed))))


#: Numbers in a block of a running total.
_RUN = 256


def running(values: Column, step) -> Column:
    """The running totals of whole numbers, ``step`` being associative with 0
    as its start. An aggregate copies what it has gathered at each number, so
    it runs over blocks of ``_RUN`` and once over the blocks' totals, which are
    then put before their blocks: about ``_RUN`` / 2 numbers are copied for
    each, a million numbers make 4,000 blocks."""
    def within(block):
        start = F.struct(F.lit(0).alias("t"), F.array().cast("array<int>").alias("all"))

        def add(acc, v):
            return _let(step(acc["t"], v), lambda t: F.struct(t.alias("t"), F.concat(acc["all"], F.array(t)).alias("all")))

        return F.aggregate(block, start, add, lambda acc: acc["all"])

    def joined(blocks):
        def put(before):
            return F.flatten(F.transform(blocks, lambda x, b: F.transform(x, lambda v: step(F.coalesce(F.get(before, b - 1), F.lit(0)), v))))

        return _let(within(F.transform(blocks, lambda x: F.element_at(x, -1))), put)

    places = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / F.lit(_RUN)).cast("int"))
    return _let(F.transform(places, lambda b: within(F.slice(values, b * _RUN + 1, F.lit(_RUN)))), joined)


def _spans(ends: Column, hits: Column, parts: Column, kind: str) -> Column:
    """The confirmed spans of one kind from its matches in a text, the pieces
    between them and where they end."""
    _, _, confirm, base, context = KINDS[kind]

    def span(h, i):
        near = F.concat_ws(" ", F.right(parts[i], F.lit(CONTEXT)), F.left(parts[i + 1], F.lit(CONTEXT)))
        score = F.lit(base) + F.when(F.lower(near).rlike(context), 0.2).otherwise(0.0)
        return F.struct((ends[i] - F.length(h)).alias("start"), F.lit(list(KINDS).index(kind)).alias("kind_no"),
                        ends[i].alias("end"), F.lit(kind).alias("kind"), h.alias("value"),
                        F.least(score, F.lit(1.0)).alias("score"))

    spans = F.filter(F.transform(hits, span), lambda s: confirm(s["value"]) & (F.lit(kind in BASE) | (s["score"] >= MIN_SCORE)))
    return F.when(F.size(hits) > 0, spans).otherwise(F.array().cast(_NONE))


def _digest(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find(docs: DataFrame, *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``RESULT_NAMES``; ``found`` has every span with its kind,
    text and score by start and kind."""
    carried = kept_columns(docs, RESULT_NAMES, keep)
    c = [F.col(f"`{x}`") for x in carried]
    none = F.array().cast("array<string>")
    t = F.col("__t")
    step = _staged(docs, c, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__t"))
    hits = [F.when(test(t), F.regexp_extract_all("__t", F.lit(p), F.lit(0))).otherwise(none).alias(f"__{k}") for k, (p, test, *_) in KINDS.items()]
    step = _staged(step, [*c, t], *hits)
    # The pieces between matches, and where each match ends.
    own = [F.col(f"__{k}") for k in KINDS]
    step = _staged(step, [*c, *own], *[F.when(F.size(f"__{k}") > 0, F.split(t, p, -1)).otherwise(none).alias(f"__p_{k}") for k, (p, *_) in KINDS.items()])
    lengths = F.array(*[F.zip_with(F.col(f"__{k}"), F.slice(f"__p_{k}", F.lit(1), F.size(f"__{k}")), lambda h, part: F.length(h) + F.length(part)) for k in KINDS])
    ends = F.transform(lengths, lambda x: F.when(F.size(x) > 0, running(x, lambda a, n: a + n)).otherwise(F.array().cast("array<int>")))
    step = _staged(step, [*c, *own, *[F.col(f"__p_{k}") for k in KINDS]], ends.alias("__e"))

    def spans(n, kind):
        bound = F.struct(F.col("__e")[n].alias("e"), F.col(f"__{kind}").alias("h"), F.col(f"__p_{kind}").alias("p"))
        return _let(bound, lambda x: _spans(x["e"], x["h"], x["p"], kind)).alias(f"__{kind}")

    step = _staged(step, c, *[spans(n, k) for n, k in enumerate(KINDS)])
    base = F.array_sort(F.concat(*own[:len(BASE)]))
    step = _staged(step, c, *[F.size(f"__{k}").cast("long").alias(f"n_{k}") for k in BASE], F.sha2(_digest(base), 256).alias("base_sha256"),
                   F.array_sort(F.concat(*own)).alias("found"))
    return step.withColumn("spans", _digest(F.col("found"))).select(*c, *RESULT_NAMES)


#: Characters of a block of text: masks are put in block by block.
_BLOCK = 4096


def redact(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` (same columns) with each run of overlapping spans replaced by
    the kind of its first span in angle brackets."""
    plain = [f"c{i}" for i in range(len(docs.columns))]  # names that cannot clash with results
    found = find(docs.toDF(*plain).withColumn("__text", F.col(plain[docs.columns.index(text_col)])), text_col="__text",
                 keep=[*plain, "__text"])

    def rebuilt(ends):
        """The text with masks, from the furthest end of the spans up to each."""
        spans = F.col("found")
        first = F.filter(F.sequence(F.lit(0), F.size(spans) - 1), lambda i: (i == 0) | (spans[i]["start"] >= F.get(ends, i - 1)))

        def masked(starts):
            def piece(i):
                begin = F.coalesce(F.get(ends, i - 1), F.lit(0))
                return F.concat(_cut(begin, spans[i]["start"]), F.lit("<"), F.upper(spans[i]["kind"]), F.lit(">"))

            return F.concat(F.array_join(F.transform(starts, piece), ""), _cut(F.element_at(ends, -1), F.length("__text")))

        return _let(first, masked)

    def _cut(begin, end):
        """Characters ``begin`` to ``end`` - 1, out of the blocks they lie in."""
        block = F.floor(begin / F.lit(_BLOCK)).cast("int")
        last = F.floor(F.greatest(begin, end - 1) / F.lit(_BLOCK)).cast("int")
        return F.substr(F.array_join(F.slice("__blocks", block + 1, last - block + 1), ""), begin - block * _BLOCK + 1, end - begin)

    carried = [F.col(p) for p in (*plain, "__text", "found")]
    found = _staged(found, carried, F.when(F.size("found") > 0, F.regexp_extract_all("__text", F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0)))
                    .otherwise(F.array().cast("array<string>")).alias("__blocks"))
    furthest = _let(F.transform("found", lambda s: s["end"]), lambda x: running(x, lambda a, n: F.greatest(a, n)))
    new = F.when(F.size("found") > 0, _let(furthest, rebuilt)).otherwise(F.col("__text"))
    out = _staged(found, [F.col(p) for p in plain], new.alias("__new"))
    return out.select(*[F.col("__new" if c == text_col else p).alias(c) for p, c in zip(plain, docs.columns)])
