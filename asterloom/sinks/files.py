"""Parquet and CSV writers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import conform
from ..operators.quality import require_unique
from ..operators.upsert import insert_ignore, upsert
from ..schemas import TableSpec
from ..scratch import discard, exists, is_complete
from ..sources.files import read_table

MODES = ("overwrite", "append")


def lay_out(
    df: DataFrame,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
) -> DataFrame:
    """Rows of a partition or of a key range together, sorted for pruning.

    `rebalance` gives one file per small partition and splits a huge one by
    size; a plain repartition would send a hot partition to a single task. A
    table without partitions is cut into ranges of its clustering columns, so
    that a look-up of one key skips all files but one or two.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    elif cluster_by:
        df = df.repartitionByRange(*cluster_by)
    order = [*partition_by, *cluster_by]
    return df.sortWithinPartitions(*order) if order else df


def bloom_options(columns: Sequence[str]) -> dict[str, str]:
    """Writer options for Bloom filters on these columns, sized by what a row group holds.

    Beside a row group's least and greatest value, which tell little of a column
    that rows aren't sorted by, they let a look-up of one value skip the group.
    """
    found = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return {**found, "parquet.bloom.filter.adaptive.enabled": "true"} if found else {}


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    look_up_by: Sequence[str] = (),
) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    writer = lay_out(df, partition_by, cluster_by).write.mode(mode).options(**bloom_options(look_up_by))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def table_path(spec: TableSpec, root: str) -> str:
    return f"{root.rstrip('/')}/{spec.name}"


def required(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows; a NULL in a column that must not be NULL fails the job that reads them."""
    checked = {c: F.coalesce(F.col(c), F.raise_error(F.lit(f"{spec.name}.{c} must not be NULL"))) for c in spec.not_null}
    return df.withColumns(checked) if checked else df


def write_table(df: DataFrame, spec: TableSpec, root: str, mode: str = "overwrite", unique: bool = False) -> None:
    """Write one declared table: columns by name, cast, in declared layout.

    `overwrite` empties the table first (truncate and insert), `append` adds. A
    NULL in a required column fails the write and leaves the table as it was.
    `unique` checks the key of the new rows beforehand; it computes them once
    more, so give it stored ones.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if unique and spec.key:
        require_unique(df, spec.name, spec.key)
    if mode == "overwrite" and exists(df.sparkSession, table_path(spec, root)):
        replace_table(df, spec, root)
        return
    finish_replacing(df.sparkSession, spec, root)
    _store(required(conform(df, spec.schema), spec), spec, root, mode)


def _store(rows: DataFrame, spec: TableSpec, root: str, mode: str = "overwrite") -> None:
    write_parquet(rows, table_path(spec, root), mode, spec.partition_by, spec.cluster_by, spec.look_up_by)


def insert_positional(df: DataFrame, columns: Sequence[str], spec: TableSpec, root: str, mode: str = "append") -> None:
    """Insert by position into the listed columns; the others become NULL."""
    if len(df.columns) != len(columns):
        raise ValueError(f"{len(df.columns)} values for {len(columns)} columns")
    named = df.toDF(*columns)
    absent = [F.lit(None).alias(f.name) for f in spec.schema.fields if f.name not in columns]
    write_table(named.select("*", *absent), spec, root, mode)


def load_table(
    spark: SparkSession,
    spec: TableSpec,
    root: str,
    rows: DataFrame | str | Callable[[SparkSession], DataFrame],
    truncate: bool = False,
) -> None:
    """Load a fact or dimension from a DataFrame, SQL text or function."""
    if isinstance(rows, str):
        rows = spark.sql(rows)
    elif callable(rows):
        rows = rows(spark)
    write_table(rows, spec, root, "overwrite" if truncate else "append")


def _pending(spec: TableSpec, root: str, touched_only: bool) -> str:
    return f"{root.rstrip('/')}/_pending-{'parts' if touched_only else 'whole'}-{spec.name}"


def _replace_by(spark: SparkSession, staged: str, spec: TableSpec, root: str, touched_only: bool) -> None:
    stored = spark.read.schema(spec.schema).parquet(staged)
    if not touched_only:
        _store(stored, spec, root)
        return
    writer = lay_out(stored, spec.partition_by, spec.cluster_by).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*spec.partition_by).parquet(table_path(spec, root))


def finish_replacing(spark: SparkSession, spec: TableSpec, root: str) -> None:
    """Bring a replacement to its end that a lost run left half way.

    Its rows are whole beside the table; every load calls this first.
    """
    for touched_only in (False, True):
        staged = _pending(spec, root, touched_only)
        if is_complete(spark, staged):
            _replace_by(spark, staged, spec, root, touched_only)
            discard(spark, staged)


def replace_table(rows: DataFrame, spec: TableSpec, root: str, staged: str | None = None, touched_only: bool = False) -> None:
    """Overwrite a table, also by rows computed from that same table.

    The rows are stored beside the table first: until that write is complete
    the table is untouched, and after it a lost run is finished by the next
    load (`finish_replacing`). A caller that repeats lost work itself names
    the `staged` path; rows found whole there are used and not computed again.
    `touched_only` replaces the partitions that `rows` have and leaves the
    others.
    """
    spark = rows.sparkSession
    own = staged is None
    if own:
        finish_replacing(spark, spec, root)
        staged = _pending(spec, root, touched_only)
    if not is_complete(spark, staged):
        required(conform(rows, spec.schema), spec).write.mode("overwrite").parquet(staged)
    _replace_by(spark, staged, spec, root, touched_only)
    if own:
        discard(spark, staged)


def keyed_by_partition(spec: TableSpec) -> bool:
    """Whether rows of one key always lie in one partition."""
    return bool(spec.partition_by) and (spec.partition_follows_key or set(spec.partition_by) <= set(spec.key))


def touched_rows(updates: DataFrame, spec: TableSpec, root: str) -> DataFrame:
    """The stored rows that share a partition with some update.

    All rows, unless the table is partitioned by columns of its key. The join
    is a plain equality, by which Spark leaves other partitions unread; only
    updates with a NULL partition value take a null-safe one.
    """
    finish_replacing(updates.sparkSession, spec, root)
    target = read_table(updates.sparkSession, spec, root)
    if not keyed_by_partition(spec):
        return target
    touched = updates.select([F.col(c).alias(f"_{c}") for c in spec.partition_by]).distinct()
    same = lambda eq: reduce(lambda a, b: a & b, [eq(F.col(c), F.col(f"_{c}")) for c in spec.partition_by])
    whole = touched.dropna()
    found = target.join(whole, same(lambda a, b: a == b), "left_semi")
    some_null = touched.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in touched.columns]))
    if some_null.isEmpty():
        return found
    return found.union(target.join(some_null, same(lambda a, b: a.eqNullSafe(b)), "left_semi"))


def upsert_table(
    updates: DataFrame,
    spec: TableSpec,
    root: str,
    order_by: Sequence[str],
    update: Sequence[str],
    staged: str | None = None,
) -> None:
    """Upsert a batch into a stored table, `update` columns only.

    Plain Parquet has no merge, so files are rewritten: all of them, or, where
    the table is partitioned by columns of its key, those of the partitions
    the batch touches. `staged` is explained at `replace_table`.
    """
    target = touched_rows(updates, spec, root)
    replace_table(upsert(target, updates, spec.key, order_by, update), spec, root, staged, keyed_by_partition(spec))


def insert_new(updates: DataFrame, spec: TableSpec, root: str, order_by: Sequence[str]) -> None:
    """Append the rows whose key the stored table lacks; never rewrites it.

    Where the table is partitioned by columns of its key, only the partitions
    that the batch touches are compared with. The files to compare with are
    listed before the write, so appending to the table that is read is safe.
    """
    target = touched_rows(updates, spec, root)
    write_table(insert_ignore(target, updates, spec.key, order_by), spec, root, "append")


def copy_tables(spark: SparkSession, specs: Sequence[TableSpec], source_root: str, target_root: str) -> None:
    """Copy every declared table to another root, each in its own layout."""
    for spec in specs:
        write_table(read_table(spark, spec, source_root), spec, target_root)


def write_csv(df: DataFrame, path: str, quote_all: bool = True, header: bool = True, mode: str = "overwrite") -> None:
    """CSV with every field quoted; an embedded quote is doubled."""
    df.write.mode(mode).option("quoteAll", quote_all).option("header", header).option("escape", '"').csv(path)
