"""Checks of loaded tables. Each comes as a report and as a guard that raises."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TableSpec
from .joins import orphan_keys


class QualityError(ValueError):
    """A table failed a check."""


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(tbl, n, ok) per table; ok means it has rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "n", (F.col("n") > 0).alias("ok"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, all columns in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def duplicate_keys(df: DataFrame, key: Sequence[str], name: str = "n") -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def completeness(source: DataFrame, target: DataFrame) -> DataFrame:
    """Row counts of both sides in one row, in one pass and without a join."""
    both = source.select(F.lit(1).alias("s"), F.lit(0).alias("t")).unionAll(
        target.select(F.lit(0).alias("s"), F.lit(1).alias("t"))
    )
    return both.agg(
        F.coalesce(F.sum("s"), F.lit(0)).cast("bigint").alias("n_source"),
        F.coalesce(F.sum("t"), F.lit(0)).cast("bigint").alias("n_target"),
    )


def orphan_counts(checks: Mapping[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """(check, n) for several fact-to-dimension relations."""
    counts = [
        orphan_keys(fact, fk, dim, dk).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n")
        for name, (fact, fk, dim, dk) in checks.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def schema_differences(df: DataFrame, expected: T.StructType) -> list[str]:
    """What differs in names and types; nullability is no difference."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    return (
        [f"missing {n} {t}" for n, t in want.items() if n not in have]
        + [f"unexpected {n} {t}" for n, t in have.items() if n not in want]
        + [f"{n} is {have[n]}, not {t}" for n, t in want.items() if n in have and have[n] != t]
    )


def schema_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(tbl, pos, column, type) of every table, without reading rows."""
    rows = [
        (name, i, f.name, f.dataType.simpleString())
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "tbl string, pos int, column string, type string")


def require_rows(df: DataFrame, name: str) -> None:
    """Raise on an empty table; looks for one row, counts none."""
    if df.isEmpty():
        raise QualityError(f"{name} holds no rows")


def require_no_nulls(df: DataFrame, name: str, columns: Sequence[str]) -> None:
    found = null_counts(df, columns).first().asDict()
    bad = {c: n for c, n in found.items() if n}
    if bad:
        raise QualityError(f"{name} holds NULLs: {bad}")


def require_unique(df: DataFrame, name: str, key: Sequence[str]) -> None:
    if not duplicate_keys(df, key).isEmpty():
        raise QualityError(f"{name} holds rows with the same {tuple(key)}")


def require_complete(source: DataFrame, target: DataFrame, name: str) -> None:
    n = completeness(source, target).first()
    if n.n_source != n.n_target:
        raise QualityError(f"{name}: {n.n_source} rows in the source, {n.n_target} in the target")


def require_schema(df: DataFrame, name: str, expected: T.StructType) -> None:
    found = schema_differences(df, expected)
    if found:
        raise QualityError(f"{name}: {', '.join(found)}")


def require_spec(df: DataFrame, spec: TableSpec) -> None:
    """All checks a table's declaration asks for."""
    require_schema(df, spec.name, spec.schema)
    require_rows(df, spec.name)
    if spec.not_null:
        require_no_nulls(df, spec.name, spec.not_null)
    if spec.key:
        require_unique(df, spec.name, spec.key)
