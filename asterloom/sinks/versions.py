"""Write, audit, publish: changes of stored tables that readers see whole or not at all."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import conform
from ..operators.counting import Counted
from ..operators.keys import identity_key
from ..operators.quality import QualityError, duplicate_keys
from ..operators.upsert import insert_ignore, upsert
from ..schemas import TableSpec
from ..scratch import discard, exists
from ..sources.files import read_parquet
from ..versions import (
    LOAD, TableState, Version, VersionConflict, current, load_path, new_load, partition_key, publish, read_state, read_version,
    version_numbers,
)
from .files import bloom_options, keyed_by_partition, lay_out, required, table_path

RETRIES = 5


@dataclass
class _Pending:
    """What this change has staged for one table."""

    spec: TableSpec
    loads: list[str] = field(default_factory=list)
    whole: bool = False  # takes the place of all earlier loads
    since: dict[str, int] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)


def partitions_of(rows: DataFrame, spec: TableSpec) -> list[str]:
    """The partitions the rows lie in, by name; as many as a partitioned write makes folders."""
    typed = rows.select([F.col(c).cast(spec.schema[c].dataType).alias(c) for c in spec.partition_by])
    return [r["k"] for r in typed.select(partition_key(spec.partition_by).alias("k")).distinct().collect()]


def near(target: DataFrame, updates: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows of `target` in the partitions of `updates`; all, unless a key has one partition.

    The partitions are looked up first and named in the filter, so that no other
    one's files are read.
    """
    if not keyed_by_partition(spec):
        return target
    return target.filter(partition_key(spec.partition_by).isin(partitions_of(updates, spec)))


class Change:
    """One change of any tables under a root, as a `with` block.

    Rows are written as new loads beside what is there (`append`, `replace`,
    `replace_partitions`, `insert_new`, `upsert`), may be read and audited
    (`staged`, `table`, `audit`), and appear to readers all at once when the
    block ends. If it ends by an error the loads are removed and nothing has
    changed; a killed run leaves loads that no version names (`clean_up`).

    Another run that publishes first is no obstacle unless it changed one of the
    same tables: then VersionConflict is raised and nothing has changed. A table
    stored without versions is taken over by its first change, as a copy.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.base = current(spark, self.root)
        self.marks: dict[str, str] = {}
        self._pending: dict[str, _Pending] = {}

    def __enter__(self) -> Change:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.publish()
        else:
            self.discard()

    def stored(self, spec: TableSpec) -> bool:
        """Whether the table is there, in versions or without."""
        return spec.name in self.base.tables or exists(self.spark, table_path(spec, self.root))

    def _of(self, spec: TableSpec, take_over: bool = True) -> _Pending:
        if spec.name not in self._pending:
            self._pending[spec.name] = _Pending(spec)
            if take_over and spec.name not in self.base.tables and self._has_plain_files(spec):
                self._write(read_parquet(self.spark, table_path(spec, self.root), spec.schema), spec)
        return self._pending[spec.name]

    def _has_plain_files(self, spec: TableSpec) -> bool:
        path = table_path(spec, self.root)
        if not exists(self.spark, path):
            return False
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        listed = target.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(target)
        return any(not s.getPath().getName().startswith(("_", ".")) for s in listed)

    def _write(self, rows: DataFrame, spec: TableSpec) -> str:
        load, counted = new_load(self.base.number + 1), Counted(required(conform(rows, spec.schema), spec))
        writer = lay_out(counted.df, spec.partition_by, spec.cluster_by).write.options(**bloom_options(spec.look_up_by))
        if spec.partition_by:
            writer = writer.partitionBy(*spec.partition_by)
        pending = self._pending[spec.name]
        pending.loads.append(load)
        writer.parquet(load_path(self.root, spec.name, load))
        pending.rows[load] = counted.rows
        return load

    def append(self, rows: DataFrame, spec: TableSpec) -> int:
        """Add rows; returns how many, counted by the write itself."""
        return self._of(spec).rows[self._write(rows, spec)]

    def append_numbered(self, rows: DataFrame, spec: TableSpec, column: str, order_by: Sequence[str], start: int = 0) -> int:
        """Add rows whose `column` goes on with the numbers after the last one given out.

        The next number is noted in the version, so appends give dense numbers
        without a look at the table, numbers once given never change, and a
        lost run, which has published no row, has taken none.
        """
        mark = f"next {spec.name}.{column}"
        first = int(self.marks.get(mark, self.base.marks.get(mark, start)))
        written = self.append(identity_key(rows, column, order_by, first), spec)
        self.marks[mark] = str(first + written)
        return written

    def replace(self, rows: DataFrame, spec: TableSpec) -> int:
        """These rows instead of all the table has; they may be computed from it."""
        pending = self._of(spec, take_over=False)
        load = self._write(rows, spec)
        before = [x for x in pending.loads if x != load]
        pending.loads, pending.whole, pending.since = [load], True, {}
        for x in before:
            discard(self.spark, load_path(self.root, spec.name, x))
        return pending.rows[load]

    def replace_partitions(self, rows: DataFrame, spec: TableSpec) -> int:
        """These rows instead of the partitions they lie in."""
        pending = self._of(spec)
        if len(pending.loads) or pending.whole:
            raise ValueError(f"{spec.name}: partitions can only be replaced by the first step of a change")
        load = self._write(rows, spec)
        pending.since = dict.fromkeys(partitions_of(self.staged(spec), spec), self.base.number + 1)
        return pending.rows[load]

    def insert_new(self, updates: DataFrame, spec: TableSpec, order_by: Sequence[str]) -> int:
        """Add the first row of each key that the table lacks."""
        self._of(spec)
        return self.append(insert_ignore(near(self.table(spec), updates, spec), updates, spec.key, order_by), spec)

    def upsert(self, updates: DataFrame, spec: TableSpec, order_by: Sequence[str], update: Sequence[str]) -> int:
        """Upsert a batch, `update` columns only; touched partitions are rewritten where the key tells them."""
        by_partition = keyed_by_partition(spec) and not self._of(spec).loads
        target = self.table(spec)
        rows = upsert(near(target, updates, spec) if by_partition else target, updates, spec.key, order_by, update)
        return (self.replace_partitions if by_partition else self.replace)(rows, spec)

    def _state(self, name: str, base: Version) -> TableState:
        before, new = base.tables.get(name, TableState()), self._pending.get(name)
        if new is None:
            return before
        if new.whole:
            return TableState(tuple(new.loads), {}, new.rows)
        return TableState((*before.loads, *new.loads), {**before.since, **new.since}, {**before.rows, **new.rows})

    def table(self, spec: TableSpec) -> DataFrame:
        """The table as it will be."""
        return read_state(self.spark, spec, self.root, self._state(spec.name, self.base))

    def staged(self, spec: TableSpec) -> DataFrame:
        """The rows this change has written for the table."""
        pending = self._pending.get(spec.name)
        return read_state(self.spark, spec, self.root, TableState(tuple(pending.loads)) if pending else TableState())

    def audit(self, spec: TableSpec, may_be_empty: bool = False, new_keys: bool = False) -> None:
        """Refuse staged rows that break the table's declaration.

        Reads the key columns of the staged rows once. Appended rows are
        compared with what is stored in the partitions they touch, unless
        `new_keys` says that they were chosen for keys the table lacks.
        """
        pending = self._pending.get(spec.name)
        if pending is None:
            return
        if not may_be_empty and not sum(self._state(spec.name, self.base).rows.values()):
            raise QualityError(f"{spec.name} holds no rows")
        if not spec.key:
            return
        keys = self.staged(spec)
        before = self.base.tables.get(spec.name, TableState())
        if before.loads and not (new_keys or pending.whole or pending.since):
            stored = read_state(self.spark, spec, self.root, before)
            clash = near(stored, keys, spec).select(*spec.key).join(keys.select(*spec.key).distinct(), list(spec.key), "left_semi")
            if not clash.isEmpty():
                raise QualityError(f"{spec.name} already holds rows with the same {tuple(spec.key)}")
        if not duplicate_keys(keys, spec.key, "_many").isEmpty():
            raise QualityError(f"{spec.name} holds rows with the same {tuple(spec.key)}")

    def publish(self) -> Version:
        """Make all staged loads visible; the version readers see from now on."""
        if not self._pending and not self.marks:
            return self.base
        base = self.base
        for _ in range(RETRIES):
            tables = {**base.tables, **{name: self._state(name, base) for name in self._pending}}
            version = Version(base.number + 1, tables, {**base.marks, **self.marks})
            try:
                publish(self.spark, self.root, version)
                return version
            except VersionConflict:
                newest = current(self.spark, self.root)
                if any(newest.tables.get(n) != self.base.tables.get(n) for n in self._pending):
                    self.discard()
                    raise
                base = newest
        self.discard()
        raise VersionConflict(f"{self.root} changes too often")

    def discard(self) -> None:
        for name, pending in self._pending.items():
            for load in pending.loads:
                discard(self.spark, load_path(self.root, name, load))
        self._pending = {}


def change_table(spark: SparkSession, root: str, spec: TableSpec, step: Callable[[Change], object]) -> None:
    """One step on one table, audited and published."""
    with Change(spark, root) as change:
        step(change)
        change.audit(spec, may_be_empty=True)


def clean_up(spark: SparkSession, root: str, keep_versions: int = 1) -> list[str]:
    """Remove loads that none of the newest versions names, and older versions; returns the loads.

    Not while a change is being written, nor while a reader of an older version
    still runs.
    """
    root = root.rstrip("/")
    numbers = version_numbers(spark, root)
    if not numbers:
        return []
    kept = [read_version(spark, root, n) for n in numbers[-keep_versions:]]
    named = {(name, load) for v in kept for name, state in v.tables.items() for load in state.loads}
    removed = []
    names = {name for n in numbers for name in read_version(spark, root, n).tables}
    for name in sorted(names):
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        files = target.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(target):
            continue
        for status in files.listStatus(target):
            folder = status.getPath().getName()
            if folder.startswith(f"{LOAD}=") and (name, folder.removeprefix(f"{LOAD}=")) not in named:
                files.delete(status.getPath(), True)
                removed.append(f"{name}/{folder}")
    for n in numbers[:-keep_versions]:
        discard(spark, f"{root}/_versions/{n:010d}.json")
    return removed


__all__ = ["Change", "VersionConflict", "change_table", "clean_up"]
