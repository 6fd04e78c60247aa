"""Fact resolution and look-up joins.

No side is broadcast by hint: Spark broadcasts a side whose measured size is
under its threshold, and beyond that sorts and merges, splitting hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import whole_rounded


def decimal_equal(left: Column, right: Column, scale: int = 5) -> Column:
    """Equality of measured values: both as decimals of one stated scale."""
    dtype = f"decimal(18,{scale})"
    return left.try_cast(dtype) == right.try_cast(dtype)


def whole_equal(left: Column, right: Column) -> Column:
    """Equality on whole seconds, rounded as a scale-0 column stores them."""
    return whole_rounded(left) == whole_rounded(right)


def attach(
    rows: DataFrame, members: DataFrame, on: Mapping[str, str], columns: Sequence[str], how: str = "left"
) -> DataFrame:
    """Rows with `columns` of the member they refer to; `members` has unique keys.

    `on` maps a row column to a member column. The join carries one key more,
    a hash of the others, for two reasons. Rows with a NULL key match nothing,
    yet would all meet in one task: they get a hash of the whole row instead.
    And members that come out of an aggregate would be joined in its
    partitioning, where Spark cannot split a hot key at run time; with the
    extra key both sides get a shuffle of their own, where it can.
    """
    left_types, right_types = ({f.name: f.dataType for f in df.schema.fields} for df in (rows, members))
    left_parts, right_parts = [], []
    for left, right in on.items():
        mine, theirs = F.col(left), F.col(right)
        if left_types[left] != right_types[right]:
            if not all(isinstance(t, T.NumericType) for t in (left_types[left], right_types[right])):
                raise TypeError(f"cannot match {left} with {right}: their types differ")
            # Equal numbers of two types hash alike as doubles.
            mine, theirs = mine.cast("double"), theirs.cast("double")
        left_parts.append(mine)
        right_parts.append(theirs)
    no_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    whole_row = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    spread = rows.withColumn("_spread", F.when(no_key, whole_row).otherwise(F.xxhash64(*left_parts)))
    known = members.select(
        *[F.col(theirs).alias(f"_on_{mine}") for mine, theirs in on.items()],
        F.xxhash64(*right_parts).alias("_on__spread"),
        *[F.col(c).alias(f"_got_{c}") for c in columns],
    )
    cond = [F.col(c) == F.col(f"_on_{c}") for c in [*on, "_spread"]]
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in columns]
    return spread.join(known, cond, how).select(*kept, *[F.col(f"_got_{c}").alias(c) for c in columns])


def songs_with_artists(songs: DataFrame, artists: DataFrame, columns: Sequence[str] = ("artist_name",)) -> DataFrame:
    """Catalogue rows with their artist's name, over the shared id."""
    named = artists.withColumnRenamed("name", "artist_name")
    return attach(songs, named, {"artist_id": "artist_id"}, columns, "inner")


def one_per_name(catalogue: DataFrame, key: Sequence[str], pick: Sequence[str]) -> DataFrame:
    """Catalogue cut to one row per look-up key: the smallest `pick` row."""
    best = F.min(F.struct(*pick)).alias("_best")
    return catalogue.groupBy(*key).agg(best).select(*key, *[F.col("_best").getField(c).alias(c) for c in pick])


def look_up_first(
    rows: DataFrame,
    catalogue: DataFrame,
    on: Mapping[str, str],
    pick: Sequence[str],
) -> DataFrame:
    """Each row with the ids of its first match, or NULLs; never fans out.

    `on` maps a row column to a catalogue column. A NULL key matches nothing.
    """
    best = one_per_name(catalogue, list(on.values()), pick)
    return attach(rows, best, on, pick)


def join_on(
    rows: DataFrame,
    catalogue: DataFrame,
    conditions: Sequence[Column],
    how: str = "left",
) -> DataFrame:
    """Rows against the catalogue on all `conditions`; several matches fan out."""
    return rows.join(catalogue, reduce(lambda a, b: a & b, conditions), how)


def orphan_keys(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Distinct fact keys the dimension lacks; a NULL key is one of them."""
    keys = fact.select(fact_key).distinct()
    known = dim.select(F.col(dim_key).alias("_known"))
    return keys.join(known, F.col(fact_key) == F.col("_known"), "left_anti")


def label_or_self(rows: DataFrame, column: str, names: DataFrame, name: str, code: str, into: str) -> DataFrame:
    """`into`: the code of the row's name where there is one, else the name."""
    coded = names.withColumn(into, F.col(code).cast("string"))
    found = attach(rows.withColumn("_self", F.col(column).cast("string")), coded, {column: name}, [into])
    return found.withColumn(into, F.coalesce(into, "_self")).drop("_self")
