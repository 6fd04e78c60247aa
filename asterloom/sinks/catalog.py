"""Tables in the session catalog: create, drop, reset, bucketed layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TableSpec
from .files import table_path


def create_sql(spec: TableSpec, root: str, name: str | None = None) -> str:
    """`CREATE TABLE IF NOT EXISTS` for one declared table under `root`."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" + (" NOT NULL" if f.name in spec.not_null else "")
        for f in spec.schema.fields
    )
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in spec.partition_by)})" if spec.partition_by else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {name or spec.name} ({columns}) USING parquet{parts} "
        f"LOCATION '{table_path(spec, root)}'"
    )


def create_tables(spark: SparkSession, specs: Sequence[TableSpec], root: str, prefix: str = "") -> None:
    for spec in specs:
        spark.sql(create_sql(spec, root, prefix + spec.name))


def drop_tables(spark: SparkSession, specs: Sequence[TableSpec], prefix: str = "") -> None:
    for spec in specs:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{spec.name}")


def reset_tables(spark: SparkSession, specs: Sequence[TableSpec], root: str, prefix: str = "") -> None:
    """Drop all, create all, and leave every table empty.

    Dropping a table at a stated location leaves its files, so the new table
    is emptied as well.
    """
    drop_tables(spark, specs, prefix)
    create_tables(spark, specs, root, prefix)
    for spec in specs:
        spark.createDataFrame([], spec.schema).write.mode("overwrite").parquet(table_path(spec, root))
        spark.catalog.refreshTable(prefix + spec.name)


def write_bucketed(
    df: DataFrame,
    name: str,
    path: str,
    key: Sequence[str],
    buckets: int,
    sort_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> DataFrame:
    """Store rows by hash of their key and sorted inside each bucket.

    Later joins and groupings on the key need no shuffle, and a look-up of one
    key reads one bucket. `rebalance` hashes rows as the buckets do but writes
    a huge bucket by several tasks. A bucket is read by one task, so `buckets`
    is the caller's choice for the table's size, and a hot key is an unsplit
    bucket on read. Returns the table.
    """
    placed = df.hint("rebalance", buckets, *[F.col(c) for c in key])
    writer = placed.write.mode(mode).format("parquet").option("path", path).bucketBy(buckets, *key)
    writer = writer.sortBy(*(list(sort_by) or list(key)))
    writer.saveAsTable(name)
    return df.sparkSession.table(name)
