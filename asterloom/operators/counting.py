"""Counts taken by the job that reads or writes the rows anyway."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ROWS = "rows"


class Counted:
    """A DataFrame whose rows are counted, and by the way aggregated, as they pass.

    Use `df` in one write; `get` waits for it. A write of rows that Spark knows to
    be none doesn't run the count: it is 0 then, other figures NULL. A table
    that several jobs read gives the figures of the first one.
    """

    def __init__(self, df: DataFrame, **figures: Column):
        self._observation = Observation()
        self._names = [ROWS, *figures]
        self.df = df.observe(self._observation, F.count(F.lit(1)).alias(ROWS), *[c.alias(n) for n, c in figures.items()])

    def get(self) -> dict[str, object]:
        try:
            return self._observation.get
        except Py4JJavaError:
            return {n: 0 if n == ROWS else None for n in self._names}

    @property
    def rows(self) -> int:
        return self.get()[ROWS]


def null_figures(columns: list[str]) -> dict[str, Column]:
    """NULLs per column, to be counted with the rows."""
    return {f"null_{c}": F.count_if(F.col(c).isNull()) for c in columns}
