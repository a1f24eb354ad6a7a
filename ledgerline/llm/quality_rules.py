"""Quality rules: a threshold table compiled into one Spark projection.

``MEASURES`` names a number for each text (counts, lengths and ratios of
symbols, stop words and lines); ``RULES`` holds the lowest and highest value
that a kept text may have. Both compile into columns: no user functions, no
shuffle. The words of a text are bound once, as the variable of a higher-order
function, so no measure splits the text again for each word.

Repeated words: a text whose 5-word windows have as many distinct hashes as
there are windows repeats none (equal windows have equal hashes). Only the
others compare the windows themselves, sorted, so the count is exact.

Defined cases: a null text counts as empty; a text without words has all
counts 0, ratios 0 and fails ``n_words``. Repeated rows give repeated results.
Columns of the input that are named like a result column give way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shared import kept_columns

WINDOW = 5
_SPACES = "\t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_MARKS = ".!?"

#: Frequent short words of four languages.
STOP_WORDS = ("the of and to a in is that for it was on as with be by are this at from "
              "der die und den von das zu mit sich des auf für ist nicht im dem eine ein "
              "de la le et les un du une que pour est par dans qui pas sur au avec "
              "el y los del se las por su con no para es al lo como").split()


@dataclass(frozen=True)
class Rule:
    """A measure and the range a kept text has it in (None: unbounded)."""

    measure: str
    low: float | None = None
    high: float | None = None

    def broken(self) -> Column:
        value, out = F.col(self.measure), F.lit(False)
        if self.low is not None:
            out = out | (value < F.lit(self.low))
        return out | (value > F.lit(self.high)) if self.high is not None else out


#: Every ratio is 0 where it has nothing to divide by. ``n_words`` and
#: ``repeat_share`` alone are the base rules.
BASE_RULES = (Rule("n_words", low=10), Rule("repeat_share", high=0.2))
RULES = (
    *BASE_RULES,
    Rule("mean_word_length", low=2.5, high=10.0),
    Rule("symbol_share", high=0.01),        # symbols among the characters of words
    Rule("letter_word_share", low=0.8),     # words with a letter
    Rule("upper_share", high=0.3),          # upper-case letters among the characters of words
    Rule("mark_share", high=1.0),           # sentence marks a word
    Rule("dup_line_share", high=0.34),      # lines that repeat an earlier one
    Rule("ellipsis_line_share", high=0.5),  # lines that end in dots
    Rule("unstopped_words", high=30),       # words of a text without any stop word
)


def _bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Runs of characters other than space and the five ASCII blanks."""
    return F.array_remove(F.split(F.translate(text, _SPACES, " " * len(_SPACES)), " "), F.lit(""))


def _without(text: Column, characters: str) -> Column:
    """How many of these characters a text has."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("bigint")


def repeat_words(words: Column, k: int = WINDOW) -> Column:
    """Words inside windows of ``k`` words that occur twice or more in a text."""
    def starts():
        return F.sequence(F.lit(1), F.size(words) - (k - 1))

    def covered(places):
        step = F.aggregate(
            places, F.struct(F.lit(-k).alias("last"), F.lit(0).cast("bigint").alias("n")),
            lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(k), p - a["last"])).alias("n")))
        return step["n"]

    def compared(windows):
        def same(x, other):
            return F.coalesce(F.get(windows, other)["g"] == x["g"], F.lit(False))

        twice = F.filter(windows, lambda x, i: same(x, i - 1) | same(x, i + 1))
        return _bind(F.sort_array(F.transform(twice, lambda x: x["p"])), covered)

    def exact():
        windows = F.transform(starts(), lambda i: F.struct(F.array_join(F.slice(words, i, k), " ").alias("g"), i.alias("p")))
        return _bind(F.sort_array(windows), compared)

    hashes = F.transform(starts(), lambda i: F.xxhash64(F.slice(words, i, k)))
    some = _bind(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(exact()))
    return F.when(F.size(words) <= k, F.lit(0).cast("bigint")).otherwise(some)


def _counts(text: Column) -> Column:
    """All counts of a text, as a struct."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " " + _SPACES, "")) > 0)
    stop = F.array(*[F.lit(w) for w in sorted(set(STOP_WORDS))])

    def fields(words, found):
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.translate(text, " " + _SPACES, "")).cast("bigint").alias("word_chars"),
            _without(text, _SYMBOLS).alias("n_symbols"),
            (F.size(found) - F.size(F.array_distinct(found))).cast("bigint").alias("n_dup_lines"),
            repeat_words(words).alias("n_repeat_words"),
            F.size(found).cast("bigint").alias("n_lines"),
            F.size(F.filter(found, lambda x: x.rlike(r"(?:\.\.\.|…)[\x20\x09-\x0D]*$"))).cast("bigint").alias("n_ellipsis_lines"),
            # From its first letter on, the rest of a word belongs to the match.
            F.regexp_count(text, F.lit(r"\p{L}[^\x20\x09-\x0D]*+")).cast("bigint").alias("n_letter_words"),
            F.regexp_count(text, F.lit(r"\p{Lu}")).cast("bigint").alias("n_upper"),
            _without(text, _MARKS).alias("n_marks"),
            F.size(F.array_intersect(words, stop)).cast("bigint").alias("n_stop_words"))

    return _bind(words_of(text), lambda w: _bind(lines, lambda x: fields(w, x)))


#: Ratios by name: counts to divide.
RATIOS = {
    "mean_word_length": ("word_chars", "n_words"),
    "symbol_share": ("n_symbols", "word_chars"),
    "letter_word_share": ("n_letter_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "mark_share": ("n_marks", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "ellipsis_line_share": ("n_ellipsis_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ellipsis_lines",
          "n_letter_words", "n_upper", "n_marks", "n_stop_words"]
RESULT = [*COUNTS, *RATIOS, "unstopped_words", "base_failed", "broken_rules", "kept"]


def apply_rules(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` (or the columns ``keep``) with all measures of a text, the
    names of the rules it breaks, and ``kept``: it breaks none. ``base_failed``
    is exact in whole numbers whatever ``rules`` are, and rules it out too."""
    carried = kept_columns(docs, RESULT, keep)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    counted = docs.select(*[F.col(f"`{c}`") for c in carried], _counts(text).alias("__c"))
    df = counted.select(*[F.col(f"`{c}`") for c in carried], *[F.col("__c")[c].alias(c) for c in COUNTS])
    ratios = [F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0)).alias(n) for n, (a, b) in RATIOS.items()]
    unstopped = F.when(F.col("n_stop_words") == 0, F.col("n_words")).otherwise(0).alias("unstopped_words")
    df = df.select("*", *ratios, unstopped, ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"))
    broken = F.concat_ws(",", *[F.when(r.broken(), F.lit(r.measure)) for r in rules])
    return df.select("*", broken.alias("broken_rules")).select("*", (~F.col("base_failed") & (F.col("broken_rules") == "")).alias("kept"))
