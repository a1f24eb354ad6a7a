"""Keyed merge (upsert) of a source DataFrame into a target snapshot.

Matched keys take the source value for every update column, even a NULL;
all other columns keep the target value. Unmatched source keys are inserted
with NULL in the columns the source does not own. Target-only keys stay.

Both sides hold each key at most once (the target by construction, the
source after keep-latest dedup), so the full outer join cannot meet a hot
key; it shuffles both sides on the key (a full outer join has no broadcast
form). What it costs is bounded by what the caller passes as the target: the
loads pass only the year folders that the feed touches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTION = "_merge_action"
INSERT, UPDATE, KEEP, STALE = "insert", "update", "keep", "stale"


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
          insert_values: Mapping[str, Column] | None = None,
          set_values: Mapping[str, Column] | None = None,
          with_action: bool = False, scope: str | None = None,
          newer: tuple[str, str] | None = None) -> DataFrame:
    """Return the merged table with the target's columns (in target order).

    ``update_cols``: copied from the source on match and on insert.
    ``insert_values``: expressions for columns set only on insert.
    ``set_values``: expressions written on every matched or inserted row.
    ``scope``: a key column with few distinct values per load (the month of
        a monthly feed). Target rows whose scope value the source does not
        contain cannot match; they bypass the join (an anti-join against the
        source's distinct scope values, small enough for AQE to broadcast),
        so only the touched part of the target is shuffled.
    ``newer``: (source column, target column); a matched key is updated only
        when the source value is not older than the target's (NULL target
        always loses). Rejected updates get the action "stale".
    """
    if scope is not None:
        touched = source.select(scope).distinct()
        kept = target.join(touched, scope, "left_anti").select(*target.columns)
        if with_action:
            kept = kept.withColumn(ACTION, F.lit(KEEP))
        hit = target.join(touched, scope, "left_semi").select(*target.columns)
        merged = merge(hit, source, keys, update_cols, insert_values, set_values, with_action,
                       newer=newer)
        return merged.unionByName(kept.select(*merged.columns))
    insert_values = dict(insert_values or {})
    set_values = dict(set_values or {})
    missing = [c for c in update_cols if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks update columns {missing}")
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s_cols = list(dict.fromkeys([*keys, *update_cols, *([newer[0]] if newer else [])]))
    s = source.select(*s_cols).withColumn("_in_s", F.lit(True)).alias("s")
    joined = t.join(s, list(keys), "full_outer")
    in_t = F.col("t._in_t").isNotNull()
    in_s = F.col("s._in_s").isNotNull()
    stale = F.lit(False)
    if newer is not None:
        src_v, tgt_v = F.col(f"s.{newer[0]}"), F.col(f"t.{newer[1]}")
        stale = in_s & in_t & tgt_v.isNotNull() & (src_v.isNull() | (src_v < tgt_v))
        in_s = in_s & ~stale
    out = []
    for name in target.columns:
        if name in keys:
            out.append(F.col(name))
        elif name in set_values:
            out.append(F.when(in_s, set_values[name]).otherwise(F.col(f"t.{name}")).alias(name))
        elif name in update_cols:
            out.append(F.when(in_s, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}")).alias(name))
        elif name in insert_values:
            out.append(F.when(in_t, F.col(f"t.{name}")).otherwise(insert_values[name]).alias(name))
        else:
            out.append(F.col(f"t.{name}"))
    if with_action:
        out.append(F.when(stale, F.lit(STALE)).when(in_s & in_t, F.lit(UPDATE)).when(in_s, F.lit(INSERT))
                   .otherwise(F.lit(KEEP)).alias(ACTION))
    return joined.select(*out)


def merge_counts(merged_with_action: DataFrame) -> DataFrame:
    """One row: inserted, updated, unchanged."""
    a = F.col(ACTION)
    return merged_with_action.agg(
        F.count_if(a == INSERT).alias("inserted"),
        F.count_if(a == UPDATE).alias("updated"),
        F.count_if((a == KEEP) | (a == STALE)).alias("unchanged"))


def empty_like(spark, schema) -> DataFrame:
    return spark.createDataFrame([], schema)
