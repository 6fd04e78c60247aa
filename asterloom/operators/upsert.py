"""Conflict rules of keyed loads, within a batch and against a target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import earliest_by_key, latest_by_key


def reduce_upserts(
    updates: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    update: Sequence[str],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """A batch as one row per key, as if its rows were upserted in order.

    `update` columns take the last row's values, `keep` columns the first
    row's (by default all others but the order). One pass over the batch.
    """
    if keep is None:
        keep = [c for c in updates.columns if c not in {*key, *order_by, *update}]
    order = F.struct(*order_by)
    aggs = [F.max_by(F.struct(*update), order).alias("_last")]
    if keep:
        aggs.append(F.min_by(F.struct(*keep), order).alias("_first"))
    source = {**dict.fromkeys(keep, "_first"), **dict.fromkeys(update, "_last")}
    picked = [F.col(c) if c in key else F.col(source[c]).getField(c).alias(c) for c in [*key, *keep, *update]]
    return updates.groupBy(*key).agg(*aggs).select(picked)


def insert_ignore(
    target: DataFrame, updates: DataFrame, key: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Rows to append: the first of each key the target does not hold yet."""
    columns = [c for c in target.columns if c not in key]
    fresh = earliest_by_key(updates, key, order_by, columns)
    return fresh.join(target.select(*key), list(key), "left_anti").select(target.columns)


def upsert(
    target: DataFrame,
    updates: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    update: Sequence[str],
) -> DataFrame:
    """The target after the upsert: new keys inserted, `update` columns replaced.

    An update to NULL is an update. Both sides hold one row per key when they
    meet, so the join cannot fan out and no key is hot.
    """
    keep = [c for c in target.columns if c not in {*key, *update}]
    new = reduce_upserts(updates, key, order_by, update, keep)
    t = target.select(*key, F.struct(*[c for c in target.columns if c not in key]).alias("_t"))
    u = new.select(*key, F.struct(*[c for c in new.columns if c not in key]).alias("_u"))
    both = t.join(u, list(key), "full_outer")

    def merged(c: str):
        old, fresh = F.col("_t").getField(c), F.col("_u").getField(c)
        if c in update:
            return F.when(F.col("_u").isNull(), old).otherwise(fresh)
        return F.when(F.col("_t").isNull(), fresh).otherwise(old)

    return both.select([F.col(c) if c in key else merged(c).alias(c) for c in target.columns])


def replace_rows(
    target: DataFrame, updates: DataFrame, key: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Upsert of every column: the last write of a key wins as a whole."""
    columns = [c for c in target.columns if c not in key]
    return upsert(target, updates, key, order_by, columns)


__all__ = [
    "earliest_by_key",
    "insert_ignore",
    "latest_by_key",
    "reduce_upserts",
    "replace_rows",
    "upsert",
]
