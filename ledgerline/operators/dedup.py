"""Keep-latest deduplication that marks the losers instead of dropping them.

The winner of each key group is found with a grouped ``min``/``max`` over its
order keys, not with ``row_number()`` over a window: an aggregate combines
map-side, so a key that holds a large share of all rows is reduced inside every
input task before the shuffle, while a window would sort that whole group in
one task. The aggregate reads the key and order columns only.

Most keys occur once. Only the keys that occur more than once, with the order
of their winner, go back to the rows, where every other row of such a key loses.
That side is written and counted first: up to ``BROADCAST_KEYS`` keys it is
broadcast, so the wide rows are not shuffled at all; beyond, adaptive execution
joins by shuffle and splits hot keys.

When the order is at most one time followed by a unique whole number (the row's
place in its feed), both are packed into one DECIMAL. Its ``max`` is a hash
aggregate, so map tasks do not sort their rows. Other orders take a struct,
which Spark aggregates by sorting.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.normalise import is_numeric
from ledgerline.schemas import REASON, ROW_ID, SUPERSEDED_BY_CORRECTION
from ledgerline.session import workspace_root


@dataclass(frozen=True)
class OrderKey:
    """One sort key of the "latest first" order: the first row in order wins."""

    column: str
    descending: bool = True
    nulls_last: bool = True


def _sortable(col: Column, dtype: T.DataType) -> tuple[Column, bool]:
    """(expression, negatable) for one order column."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp")), True
    if isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("bigint"), True
    if is_numeric(dtype):
        return col, True
    return col, False


def winner_expr(df: DataFrame, order: Sequence[OrderKey]) -> tuple[Column, str]:
    """Build the struct whose min (or max) over a group is the first row in order.

    Numeric components are negated where needed; other types (strings,
    structs) are used as they are, so they must all share one direction.
    """
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    plain_dirs = {k.descending for k in order if not _sortable(F.col(k.column), dtypes[k.column])[1]}
    if len(plain_dirs) > 1:
        raise ValueError("non-numeric order keys must all sort in the same direction")
    use_max = plain_dirs.pop() if plain_dirs else True
    parts = []
    for i, k in enumerate(order):
        expr, negatable = _sortable(F.col(k.column), dtypes[k.column])
        # Null placement flag first: under max "true" wins, under min "false" wins.
        first_nonnull = k.nulls_last
        flag = F.col(k.column).isNotNull() if first_nonnull == use_max else F.col(k.column).isNull()
        if k.descending != use_max:
            expr = -expr  # negatable by construction
        parts += [flag.alias(f"n{i}"), expr.alias(f"v{i}")]
    return F.struct(*parts), ("max" if use_max else "min")


#: Times and places lie within +-2**62; a packed order is time * 10**19 + place.
_HALF, _FULL, _SHIFT = 1 << 62, (1 << 63) - 1, Decimal(10) ** 19


#: Keys with more than one row that may be broadcast (about 100 bytes each).
BROADCAST_KEYS = 500_000


def packed_order(df: DataFrame, order: Sequence[OrderKey]) -> Column | None:
    """The order as one number to maximise, or None if it is of another form."""
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    if not 1 <= len(order) <= 2 or not isinstance(dtypes[order[-1].column], T.LongType):
        return None
    place = order[-1]
    at = F.col(place.column)
    number = (at if place.descending else -at) + F.lit(_HALF)
    if len(order) == 2:
        time = order[0]
        value, _ = _sortable(F.col(time.column), dtypes[time.column])
        if not isinstance(dtypes[time.column], (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return None
        value = F.coalesce((value if time.descending else -value) + F.lit(_HALF), F.lit(0 if time.nulls_last else _FULL))
        number = value.cast("decimal(19,0)") * F.lit(_SHIFT).cast("decimal(20,0)") + number.cast("decimal(19,0)")
    return number


def contested_keys(df: DataFrame, keys: Sequence[str], order: Sequence[OrderKey],
                   row_id: str = ROW_ID, reason_col: str = REASON) -> tuple[DataFrame, Column]:
    """(keys of more than one row without a reason, with the winner's order as
    ``_win``; the order of a row of ``df``)."""
    rank, pick = packed_order(df, order), F.max
    if rank is None:
        ordering, how = winner_expr(df, order)
        rank, pick = F.struct(ordering.alias("o"), F.col(row_id).alias("id")), F.max if how == "max" else F.min
    survivors = df.where(F.col(reason_col).isNull())
    return (survivors.groupBy(*keys).agg(pick(rank).alias("_win"), F.count(F.lit(1)).alias("_n"))
            .where("_n > 1").drop("_n")), rank


def mark_superseded(df: DataFrame, keys: Sequence[str], order: Sequence[OrderKey],
                    row_id: str = ROW_ID, reason_col: str = REASON,
                    reason: str = SUPERSEDED_BY_CORRECTION, drop: Sequence[str] = (),
                    broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """Among rows with no reason yet, all but the first per key get ``reason``.

    ``drop``: columns that only the order needs; they are not returned. The
    last order column, if it is a BIGINT, has to be unique.

    Rows that already carry a reason take no part, so a bad newer row never
    supersedes a good older one. The contested keys are computed at once.
    """
    contested, rank = contested_keys(df, keys, order, row_id, reason_col)
    workspace_root(df.sparkSession)  # names the folder for checkpoints
    contested = contested.checkpoint()
    few = contested.limit(broadcast_keys + 1).count() <= broadcast_keys
    side = contested.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_win")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    lost = F.col("_win").isNotNull() & (rank != F.col("_win"))
    marked = (F.when(F.col(reason_col).isNotNull(), F.col(reason_col))
               .when(lost, F.lit(reason)).alias(reason_col))
    return (df.join(F.broadcast(side) if few else side, reduce(and_, same), "left")
              .select(*[marked if c == reason_col else F.col(c) for c in df.columns if c not in drop]))


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[OrderKey],
                row_id: str = ROW_ID) -> DataFrame:
    """Only the first row per key (the deduplicated set)."""
    marked = mark_superseded(df.withColumn("_r", F.lit(None).cast("string")), keys, order,
                             row_id=row_id, reason_col="_r")
    return marked.where(F.col("_r").isNull()).drop("_r")
