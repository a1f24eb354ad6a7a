"""Text -> typed column functions (pure Column -> Column, all JVM-side).

Every function works on raw text as well as on columns that are already
typed, so the same rules apply to CSV feeds and to typed tables.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import CURRENCY_MAP, NA_TOKENS

# An integer literal, and a decimal / scientific literal (what a lenient
# numeric parser accepts). Spark's own cast also accepts "1d", "2f" and
# "NaN"; the guard keeps those out.
INT_PATTERN = r"^[+-]?[0-9]+$"
NUMBER_PATTERN = r"(?i)^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity)$"
# Every character Python's str.strip() removes (str.isspace), so trimming
# here gives the same text as the source system's strip.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, _NUMERIC)


def strip_ws(c: Column) -> Column:
    """Trim all leading/trailing white space (Spark ``trim`` only strips spaces)."""
    return F.btrim(c.cast("string"), F.lit(WHITESPACE))


def _sql_text(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def na_to_null(c: Column) -> Column:
    """Treat the reader's NA tokens as missing (exact, untrimmed match)."""
    s = c.cast("string")
    # A hash lookup (Spark's InSet), not a walk over the tokens for each value.
    return F.when(~s.isin(NA_TOKENS), s)


def clean_text(c: Column, compat_nan: bool = False) -> Column:
    """Trimmed text; missing stays NULL, or becomes 'nan' in compatibility mode."""
    t = strip_ws(na_to_null(c))
    return F.coalesce(t, F.lit("nan")) if compat_nan else t


def parse_int_key(t: Column) -> Column:
    """Integer key from trimmed text (NA tokens already NULL), as text.

    Whole numbers in decimal or scientific form are accepted ('1e3' ->
    '1000'); fractional, infinite or non-numeric text gives NULL.
    """
    d = t.try_cast("double")
    return F.coalesce(F.when(t.rlike(INT_PATTERN), t.try_cast("bigint")),
                      F.when(t.rlike(NUMBER_PATTERN) & (d % F.lit(1.0) == 0.0), d.try_cast("bigint"))
                      ).cast("string")


def int_key(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Integer-looking key rendered as text: '007'->'7', '1e3'->'1000', 'C1'->NULL."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("string")
    return parse_int_key(strip_ws(na_to_null(c)))


def parse_double(t: Column) -> Column:
    """Number from trimmed text (NA tokens already NULL); the guard keeps out
    what Spark's cast accepts but a lenient numeric parser does not ('1d',
    '2f', hex, 'NaN'), so no NaN can come out."""
    return F.when(t.rlike(NUMBER_PATTERN), t.try_cast("double"))


def to_double(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Lenient numeric parse: unparsable text and NaN become NULL."""
    if is_numeric(dtype):
        d = c.cast("double")
        return F.when(~F.isnan(d), d)
    return parse_double(strip_ws(na_to_null(c)))


# A time of day followed by an offset or zone: an instant, not a wall clock.
OFFSET_PATTERN = r"[0-9]:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?\s*(Z|z|UTC|GMT|[+-][0-9]{1,2}(:?[0-9]{2})?)$"


def parse_timestamp(t: Column) -> Column:
    """Wall-clock text as it is; text with an offset as its instant in UTC, so
    that times written in different zones compare rightly."""
    # Colons make '+0530' an offset that the cast knows.
    fixed = F.regexp_replace(t, r"([+-][0-9]{2})([0-9]{2})$", "$1:$2")
    instant = F.when(t.rlike(OFFSET_PATTERN), F.to_utc_timestamp(fixed.try_cast("timestamp"), F.current_timezone()).cast("timestamp_ntz"))
    return F.when(t.rlike(OFFSET_PATTERN), instant).otherwise(t.try_cast("timestamp_ntz"))


def to_timestamp(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Lenient timestamp parse (no time zone); unparsable text becomes NULL."""
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return c.cast("timestamp_ntz")
    return parse_timestamp(strip_ws(na_to_null(c)))


# 'YYYY-MM' with a four-digit year and a one- or two-digit month 1..12: the
# grammar of the source system's month format ('%Y-%m').
MONTH_PATTERN = r"^[0-9]{4}-(1[0-2]|0[1-9]|[1-9])$"


def month_start(c: Column) -> Column:
    """'YYYY-MM' (one-digit month accepted) -> first day of month; else NULL."""
    c = c.cast("string")
    return F.when(c.rlike(MONTH_PATTERN),
                  F.make_date(F.substring(c, 1, 4).cast("int"),
                              F.substring(c, 6, 2).cast("int"), F.lit(1)))


def _map_literal(mapping: dict) -> Column:
    return F.expr("map(" + ", ".join(_sql_text(x) for x in chain.from_iterable(mapping.items())) + ")")


def currency_text(c: Column) -> Column:
    """Trimmed, upper-cased currency text as received."""
    return F.upper(strip_ws(na_to_null(c)))


def currency_lookup(text: Column, mapping: dict | None = None) -> Column:
    """Canonical code for already trimmed, upper-cased currency text."""
    return F.try_element_at(_map_literal(CURRENCY_MAP if mapping is None else mapping), text)


def currency_code(c: Column, mapping: dict | None = None) -> Column:
    """Canonical 3-letter code for a currency spelling, NULL when unknown."""
    return currency_lookup(currency_text(c), mapping)


def finite_or_null(c: Column) -> Column:
    """NaN and +/-Inf -> NULL (for API-style output)."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def iso_text(c: Column) -> Column:
    """ISO-8601 text of a timestamp column; microseconds only when not zero."""
    return F.when(F.date_format(c, "SSSSSS") == "000000", F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
