"""The given tables and the register of queries over them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import estimated_bytes, size_shuffles, tune

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """The given tables as attributes; shuffles are sized by what is read."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")
        self._bytes = 0

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        df = self.spark.read.parquet(self.path(name))
        self._bytes += estimated_bytes(df)
        size_shuffles(self.spark, self._bytes)
        setattr(self, name, df)
        return df


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function of `Tables` under its own name or `name`."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        key = name or fn.__name__
        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql:
            SQL[key] = " ".join(sql.split())
        return fn

    return register
