"""Row filters and column reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def only_page(log: DataFrame, page: str | None, column: str = "page") -> DataFrame:
    """Rows of one page; `None` keeps all."""
    return log if page is None else log.filter(F.col(column) == page)


def not_blank(df: DataFrame, column: str) -> DataFrame:
    """Rows whose `column` is neither NULL nor the empty text."""
    return df.filter(F.col(column).isNotNull() & (F.col(column) != ""))


def has_key(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where every key column is present."""
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
    return df


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """New names by position; columns beyond the list keep theirs."""
    return df.withColumnsRenamed(dict(zip(df.columns, names)))


def matching(df: DataFrame, **equal: object) -> DataFrame:
    """Rows where each named column equals its value or is in its list."""
    for name, value in equal.items():
        c = F.col(name)
        df = df.filter(c.isin(list(value)) if isinstance(value, (list, tuple, set)) else c == value)
    return df


def first_rows(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """The first `n` rows in a stated order: a look at the data, repeatable."""
    return df.orderBy(*order_by).limit(n)
