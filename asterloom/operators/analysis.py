"""Grouped counts, top-k reports, pivots and keyed look-ups.

Joins that only add a label come after the counting: a hot key is then one
counted row when it reaches the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top(df: DataFrame, n: int, by: str, tie: Sequence[str]) -> DataFrame:
    """The `n` largest by one column, ties in key order."""
    return df.orderBy(F.desc(by), *tie).limit(n)


def count_by(df: DataFrame, columns: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))


def count_values(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Count of each value; the NULL group counts 0, as a count of it does."""
    return df.groupBy(column).agg(F.count(column).alias(name))


def by_popularity(df: DataFrame, column: str) -> DataFrame:
    """Values by how often they occur, most first; the count is not returned."""
    return count_by(df, [column], "_n").orderBy(F.desc("_n"), column).select(column)


def count_labels(
    df: DataFrame,
    code: str,
    codes: DataFrame,
    codes_key: str,
    label: str,
    by: Sequence[str] = (),
    name: str = "n",
    how: str = "left",
) -> DataFrame:
    """Rows per label of a code list (and per `by`).

    Counted per code first, then labelled, then summed per label, since a
    code list may give two codes one label. With a left join the rows without
    a label form the NULL group, whose count of labels is 0.
    """
    per_code = df.groupBy(code, *by).agg(F.count(F.lit(1)).alias("_n"))
    named = codes.select(F.col(codes_key).alias("_code"), F.col(label).alias("_label"))
    joined = per_code.join(named, F.col(code) == F.col("_code"), how)
    counted = F.sum(F.when(F.col("_label").isNotNull(), F.col("_n")).otherwise(F.lit(0)))
    return joined.groupBy(F.col("_label").alias(label), *by).agg(counted.alias(name))


def count_per_member(
    fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str, show: Sequence[str] = (), name: str = "n"
) -> DataFrame:
    """Fact rows per dimension member that has any, with `show` columns.

    The dimension holds one row per key, so counting before the join gives
    what counting after it would.
    """
    per_key = fact.filter(F.col(fact_key).isNotNull()).groupBy(fact_key).agg(F.count(F.lit(1)).alias(name))
    members = dim.select(dim_key, *show)
    return per_key.join(members, F.col(fact_key) == F.col(dim_key)).select(dim_key, *show, name)


def distinct_count(df: DataFrame, column: str, exact: bool = True) -> DataFrame:
    """Distinct and plain count of one column; the estimate needs no shuffle."""
    distinct = F.count_distinct(column) if exact else F.approx_count_distinct(column)
    return df.agg(distinct.alias("n_distinct"), F.count(column).alias("n"))


def pivot_counts(df: DataFrame, key: Sequence[str], column: str, values: dict[object, str]) -> DataFrame:
    """One column per listed value; listing them saves a pass to find them."""
    wide = df.groupBy(*key).pivot(column, list(values)).agg(F.count(F.lit(1)))
    return wide.select(*key, *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias(n) for v, n in values.items()])


def pivot_values(df: DataFrame, key: Sequence[str], column: str, value: str, values: dict[object, str]) -> DataFrame:
    """One column per listed value, holding the sum of `value`; absent is NULL."""
    wide = df.groupBy(*key).pivot(column, list(values)).agg(F.sum(value))
    return wide.select(*key, *[F.col(f"`{v}`").alias(n) for v, n in values.items()])


def look_up(table: DataFrame, columns: Sequence[str], order_by: Sequence[str] = (), **key: object) -> DataFrame:
    """Rows of one key from a query-shaped table, in clustering order."""
    for name, value in key.items():
        table = table.filter(F.col(name) == value)
    if order_by:
        table = table.orderBy(*order_by)
    return table.select(*columns)
