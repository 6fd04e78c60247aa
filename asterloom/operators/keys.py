"""Generated keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import md5_key
from ..scratch import materialise

_ROW_IN_PARTITION = (1 << 33) - 1


def monotonic_key(df: DataFrame, name: str) -> DataFrame:
    """Unique but neither dense nor the same on the next run."""
    return df.withColumn(name, F.monotonically_increasing_id())


def hash_key(df: DataFrame, name: str, parts: Sequence[str], sep: str = "|", null_safe: bool = True) -> DataFrame:
    """The same key for the same row on every run; needs no order, no shuffle."""
    return df.withColumn(name, md5_key(parts, sep, null_safe))


def identity_key(df: DataFrame, name: str, order_by: Sequence[str], start: int = 0) -> DataFrame:
    """Dense numbers from `start` in the order of `order_by`.

    A ranking window over the whole table would run in one task. Here rows are
    range-partitioned and sorted in parallel, written once (so a second
    evaluation cannot cut the ranges differently), and each partition's count
    gives the next one's offset: one small row per partition.

    `order_by` should end in a unique column: equal rows share a range.
    """
    placed = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_IN_PARTITION)))
    )
    stored = materialise(placed, "identity")
    # One row per partition, so this window stays small at any table size.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    numbered = stored.join(F.broadcast(offsets), "_part")
    key = (F.col("_offset") + F.col("_pos") + F.lit(start)).cast("bigint").alias(name)
    return numbered.select(key, *[F.col(f"`{c}`") for c in df.columns])
