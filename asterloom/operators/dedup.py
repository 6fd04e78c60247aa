"""Dedup and one-row-per-key reductions.

The reductions are aggregates, not ranked windows: every task keeps one row
per key before the shuffle, so a key that holds a third of the table costs no
more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_full_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of `columns`; only they are read and shuffled."""
    return df.select(*columns).distinct()


def _others(df: DataFrame, key: Sequence[str], columns: Sequence[str] | None) -> list[str]:
    return list(columns) if columns is not None else [c for c in df.columns if c not in key]


def earliest_by_key(
    df: DataFrame, key: Sequence[str], order_by: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """First row per key. `order_by` must tell any two rows of a key apart.

    Spark has no file or row order, so the order is always a column. A NULL
    in it counts as earliest.
    """
    return _pick(F.min_by, df, key, order_by, columns)


def latest_by_key(
    df: DataFrame, key: Sequence[str], order_by: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Last row per key: writes by primary key where the last one wins."""
    return _pick(F.max_by, df, key, order_by, columns)


def _pick(by, df, key, order_by, columns):
    kept = _others(df, key, columns)
    row = by(F.struct(*kept), F.struct(*order_by)).alias("_row")
    return df.groupBy(*key).agg(row).select(*key, *[F.col("_row").getField(c).alias(c) for c in kept])
