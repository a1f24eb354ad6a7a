"""I-Match document fingerprints, in DataFrame functions.

Terms are the distinct lower-cased runs of letters and digits of a whole text.
The lexicon keeps terms whose document frequency lies in a band of inverse
document frequencies, neither rare (typos, ids) nor common. A fingerprint
sorts a document's distinct lexicon terms and hashes them under several
randomised lexicon subsets: a subset takes a random share 2**-level of the
lexicon, and the first ``SUBSETS`` of such disjoint subsets are hashed. The
level follows the number of the document's terms, so that a subset holds about
one of them; it and the next level are kept, so that a document and an edited
one share a level. Likeness is the share of equal hashes among the subsets
that either document has terms in, over the shared levels.

Scale: document frequencies are counted once over all documents, as sums of
64-bit term hashes with partial sums in each task. A term of the band stands
in at least ``LOW`` of the documents, so the lexicon has at most (mean distinct
terms) / ``LOW`` entries whatever the corpus; that bounds the one-row lookup
table that goes to every task, and its size is checked. Fingerprints take one
projection, no shuffle, no Python.

Defined cases: a null text counts as empty. A text with fewer than
``MIN_TERMS`` lexicon terms is fingerprinted over all its terms; a text without
any has the fingerprint "-", which is like itself only. Equal texts have equal
fingerprints. Extra columns are carried by ``fingerprints``, but for such that
are named like the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.shared import kept_columns, prepare

LOW, HIGH = 0.0005, 0.2
MIN_DOCS = 2
MIN_TERMS = 4
SUBSETS = 32
LOOKUP_SLOTS = 65_536
MAX_LEXICON = 5_000_000
SEED = 7
BUCKET_ROWS = 5_000
MAX_BUCKETS = 10_000


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def term_hashes(text: Column) -> Column:
    """Distinct 64-bit hashes of a text's terms."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, *, text_col: str = "text", low: float = LOW, high: float = HIGH) -> DataFrame:
    """One row: ``slots``, an array of ``LOOKUP_SLOTS`` arrays of the term hashes
    in the band, each in the slot of its hash."""
    counts = (docs.select(F.explode(term_hashes(F.col(f"`{text_col}`"))).alias("term"))
              .groupBy("term").agg(F.count("*").alias("n")))
    total = docs.count()
    terms = counts.where((F.col("n") >= max(MIN_DOCS, low * total)) & (F.col("n") <= max(MIN_DOCS, high * total))).select("term").checkpoint()
    size = terms.count()
    if size > MAX_LEXICON:
        raise ValueError(f"{size} lexicon terms; narrow the band (low, high)")
    slot = F.pmod("term", F.lit(LOOKUP_SLOTS)).cast("int").alias("slot")
    per_slot = terms.groupBy(slot).agg(F.sort_array(F.collect_list("term")).alias("terms"))
    full = (docs.sparkSession.range(LOOKUP_SLOTS).select(F.col("id").cast("int").alias("slot")).join(per_slot, "slot", "left")
            .select("slot", F.coalesce("terms", F.array().cast("array<bigint>")).alias("terms")))
    ordered = F.array_sort(F.collect_list(F.struct("slot", "terms")))  # at most MAX_LEXICON terms in LOOKUP_SLOTS slots
    return full.groupBy().agg(F.transform(ordered, lambda s: s["terms"]).alias("slots")).checkpoint()


def _subset_hashes(terms: Column, level: Column) -> Column:
    """``SUBSETS`` hashes, comma-joined; nothing for a subset without terms."""
    def cell(t):
        return F.pmod(F.xxhash64(t, F.lit(SEED)), F.pow(F.lit(2.0), level).cast("long"))

    def one(placed):
        return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda k: _let(
            F.transform(F.filter(placed, lambda p: p["cell"] == k), lambda p: p["t"]),
            lambda own: F.when(F.size(own) > 0, F.substring(F.sha2(F.array_join(own, ","), 256), 1, 8)).otherwise(""))), ",")

    return _let(F.filter(F.transform(terms, lambda t: F.struct(t.alias("t"), cell(t).alias("cell"))), lambda p: p["cell"] < SUBSETS), one)


def fingerprint(text: Column, slots: Column) -> Column:
    """The fingerprint of a text under the lexicon: "level:hashes" twice."""
    def marked(terms):
        # The level so that 2**level is about the number of terms.
        level = F.least(F.floor(F.log2(F.size(terms).cast("double"))).cast("int"), F.lit(40))
        return F.when(F.size(terms) == 0, "-").otherwise(_let(level, lambda v: F.concat(
            v.cast("string"), F.lit(":"), _subset_hashes(terms, v), F.lit("|"),
            (v + 1).cast("string"), F.lit(":"), _subset_hashes(terms, v + 1))))

    def chosen(all_terms):
        inside = F.filter(all_terms, lambda t: F.array_contains(
            F.element_at(slots, F.pmod(t, F.lit(LOOKUP_SLOTS)).cast("int") + 1), t))
        return _let(F.array_sort(_let(inside, lambda x: F.when(F.size(x) >= MIN_TERMS, x).otherwise(all_terms))), marked)

    return _let(term_hashes(text), chosen)


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints, 0 to 1."""
    def levels(f):
        return F.transform(F.split(f, r"\|"), lambda p: F.struct(
            F.element_at(F.split(p, ":"), 1).alias("level"), F.split(F.element_at(F.split(p, ":"), -1), ",").alias("h")))

    def of(x, y):
        shared = F.flatten(F.transform(x, lambda p: F.flatten(F.transform(
            F.filter(y, lambda q: q["level"] == p["level"]), lambda q: F.arrays_zip(p["h"].alias("p"), q["h"].alias("q"))))))
        return _let(F.filter(shared, lambda z: (z["p"] != "") | (z["q"] != "")), lambda s: F.when(F.size(s) > 0, F.size(
            F.filter(s, lambda z: z["p"] == z["q"])) / F.size(s)).otherwise(0.0))

    return (F.when(a == b, 1.0).when((a == "-") | (b == "-"), 0.0)
            .otherwise(_let(levels(a), lambda x: _let(levels(b), lambda y: of(x, y)))))


def fingerprints(docs: DataFrame, lex: DataFrame, *, text_col: str = "text", name: str = "fingerprint",
                 keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the fingerprint of each whole text."""
    carried = [F.col(f"`{c}`") for c in kept_columns(docs, [name], keep)]
    # A subquery may not be written inside a lambda, but the optimiser merges this column, which is used once, into it.
    looked_up = docs.select(*carried, F.col(f"`{text_col}`").alias("__text"), lex.scalar().alias("__slots"))
    return looked_up.select(*carried, fingerprint(F.col("__text"), F.col("__slots")).alias(name))


def _rank(edges: list[int], key: Column, before) -> Column:
    """How many of the ascending edges come before a key: first among every
    n-th edge, then in the one block found, n about the root of their number."""
    n = max(1, int(len(edges) ** 0.5))
    blocks = F.array(*[F.array(*[F.lit(x).cast("long") for x in edges[i:i + n]]) for i in range(0, len(edges), n)])
    heads = F.array(*[F.lit(x).cast("long") for x in edges[::n]])
    return _let(F.size(F.filter(heads, lambda x: before(x, key))), lambda j: F.when(j == 0, 0).otherwise(
        (j - 1) * n + F.size(F.filter(F.get(blocks, j - 1), lambda x: before(x, key)))))


def with_next(docs: DataFrame, order_col: str, payload: list[str], derive=lambda df: df) -> DataFrame:
    """``derive(docs)`` with ``next``, the ``payload`` of the row that follows
    in descending order (nulls last; equal keys by ``__tie``); the first row
    follows the last. ``derive`` adds columns and runs once per row.

    Rows are dealt into ranges of the key of about ``BUCKET_ROWS`` rows, a key
    that fills several ranges being dealt by its tie value. Each range also
    gets a copy of the first row of the range after it, so that no window
    spans two ranges and no row moves more than once."""
    key = F.coalesce(F.col(order_col).cast("long"), F.lit(-(1 << 63)))
    rows = docs.withColumn("__key", key)
    total = rows.count()
    parts = min(MAX_BUCKETS, total // BUCKET_ROWS + 1)
    if parts > 1:
        at = rows.agg(F.percentile_approx("__key", [i / parts for i in range(1, parts)], 10 * parts)).first()[0]
        up_to, below = _rank(at, F.col("__key"), lambda x, k: x <= k), _rank(at, F.col("__key"), lambda x, k: x < k)
        higher, same = F.lit(len(at)) - up_to, up_to - below  # ranges wholly above the key, ranges that begin with it
        share = F.floor((F.col("__tie") / float(1 << 64) + 0.5) * (same + 1)).cast("int")
        rows = rows.withColumn("__range", higher + F.least(share, same))
    else:
        rows = rows.withColumn("__range", F.lit(0))
    order = F.struct((-(F.col("__key") + 1)).alias("k"), F.col("__tie").alias("t"))  # ascending; -(x + 1) cannot overflow
    rows = rows.withColumn("__order", order)
    firsts = rows.groupBy("__range").agg(F.min("__order").alias("__order")).collect()  # one small row per range
    firsts = sorted((r["__range"], r["__order"]) for r in firsts)
    ghosts = [(firsts[i - 1][0], o["k"], o["t"], r) for i, (r, o) in enumerate(firsts)]
    edge = docs.sparkSession.createDataFrame(ghosts, "__to int, k long, t long, __from int")
    copies = (rows.join(F.broadcast(edge), (F.col("__range") == F.col("__from")) & (F.col("__order.k") == F.col("k"))
                        & (F.col("__order.t") == F.col("t")))
              .dropDuplicates(["__from"]).withColumn("__range", F.col("__to")).select(*rows.columns).withColumn("__ghost", F.lit(1)))
    both = derive(rows.withColumn("__ghost", F.lit(0)).unionByName(copies))
    follows = F.lead(F.struct(*payload)).over(Window.partitionBy("__range").orderBy("__ghost", "__order"))
    return both.withColumn("next", follows).where("__ghost = 0").drop("__key", "__range", "__order", "__ghost")


def compare_with_edits(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", low: float = LOW, high: float = HIGH) -> DataFrame:
    """Each text's fingerprint, that of its edited text (its second half gives
    way to the start of the next document) and their likeness."""
    prepare(docs.sparkSession)
    plain = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    lex = lexicon(plain, low=low, high=high)
    linked = with_next(plain.withColumn("__tie", F.xxhash64("text")), "id", ["text", "fingerprint"], lambda df: fingerprints(df, lex))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = linked.select("id", F.length("text").cast("long").alias("n_chars"), "fingerprint",
                           F.col("next.fingerprint").alias("next_fingerprint"),
                           F.concat(F.substr("text", F.lit(1), F.length("text") - half),
                                    F.substr("next.text", F.lit(1), half)).alias("edited"))
    both = fingerprints(edited, lex, text_col="edited", name="edited_fingerprint",
                        keep=["id", "n_chars", "fingerprint", "next_fingerprint", "edited"])
    return both.select(F.col("id").alias(id_col), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                       "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
