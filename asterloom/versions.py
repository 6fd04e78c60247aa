"""Versions of the tables under a root: which loads a reader sees.

A load is a folder of Parquet files below its table, `<table>/_load=<id>`, and is
never changed once it is written. A version names, for every table, its loads;
it is one small file in `<root>/_versions`, put there by a rename that fails
if another run was first. A reader takes the newest version when it begins and
reads the loads it names, whatever is published, half written or given up
meanwhile. All tables under a root change together.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import TableSpec
from .scratch import _file_system

FOLDER = "_versions"
LOAD = "_load"
DIGITS = 10


class VersionConflict(RuntimeError):
    """Another run published a change of the same table first."""


@dataclass(frozen=True)
class TableState:
    """A table's loads, oldest first; rows of a partition count from load number `since` on."""

    loads: tuple[str, ...] = ()
    since: Mapping[str, int] = field(default_factory=dict)
    rows: Mapping[str, int] = field(default_factory=dict)  # as each load counted them


@dataclass(frozen=True)
class Version:
    number: int = 0
    tables: Mapping[str, TableState] = field(default_factory=dict)
    marks: Mapping[str, str] = field(default_factory=dict)  # what a run wants to know of itself later


def new_load(number: int) -> str:
    return f"{number:0{DIGITS}d}-{uuid.uuid4().hex[:12]}"


def load_path(root: str, name: str, load: str) -> str:
    return f"{root.rstrip('/')}/{name}/{LOAD}={load}"


def _path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/{FOLDER}/{number:0{DIGITS}d}.json"


def version_numbers(spark: SparkSession, root: str) -> list[int]:
    files, folder = _file_system(spark, f"{root.rstrip('/')}/{FOLDER}")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:1].isdigit())


def read_version(spark: SparkSession, root: str, number: int) -> Version:
    files, path = _file_system(spark, _path(root, number))
    stream = files.open(path)
    try:
        found = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    tables = {name: TableState(tuple(t["loads"]), t["since"], t["rows"]) for name, t in found["tables"].items()}
    return Version(number, tables, found["marks"])


def current(spark: SparkSession, root: str) -> Version:
    """The newest version, or version 0 without tables."""
    numbers = version_numbers(spark, root)
    return read_version(spark, root, numbers[-1]) if numbers else Version()


def publish(spark: SparkSession, root: str, version: Version) -> None:
    """Make the version the newest; VersionConflict if its number is taken."""
    text = json.dumps({
        "tables": {n: {"loads": t.loads, "since": dict(t.since), "rows": dict(t.rows)} for n, t in version.tables.items()},
        "marks": dict(version.marks),
    })
    files, target = _file_system(spark, _path(root, version.number))
    _, written = _file_system(spark, f"{root.rstrip('/')}/{FOLDER}/_{uuid.uuid4().hex}")
    out = files.create(written, False)
    try:
        out.write(text.encode())
    finally:
        out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    plainly = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        # Fails if the target is there.
        context.rename(files.makeQualified(written), files.makeQualified(target), plainly)
    except Exception as error:
        files.delete(written, False)
        if files.exists(target):
            raise VersionConflict(f"version {version.number} of {root} is taken") from error
        raise


def partition_key(columns: Sequence[str]) -> Column:
    """A row's partition as text; an empty text is stored as NULL."""
    parts = [F.coalesce(F.concat(F.lit("="), F.nullif(F.col(c).cast("string"), F.lit(""))), F.lit("~")) for c in columns]
    return F.concat(*[x for p in parts for x in (p, F.lit("/"))])


def read_state(spark: SparkSession, spec: TableSpec, root: str, state: TableState) -> DataFrame:
    """The table's rows in a version; loads it doesn't name are not even listed."""
    if not state.loads:
        return spark.createDataFrame([], spec.schema)
    base = f"{root.rstrip('/')}/{spec.name}"
    schema = T.StructType([*spec.schema.fields, T.StructField(LOAD, T.StringType())])
    rows = spark.read.schema(schema).option("basePath", base).parquet(*[load_path(root, spec.name, x) for x in state.loads])
    if state.since:
        # On partition columns alone, so that replaced files are not read.
        known = F.create_map(*[F.lit(x) for pair in state.since.items() for x in pair])
        first = F.coalesce(F.try_element_at(known, partition_key(spec.partition_by)), F.lit(0))
        rows = rows.filter(F.substring(LOAD, 1, DIGITS).cast("bigint") >= first)
    return rows.select(spec.schema.fieldNames())


__all__ = [
    "TableState", "Version", "VersionConflict", "current", "load_path", "new_load", "partition_key", "publish", "read_state",
    "read_version", "version_numbers",
]
