"""Which files have been loaded, by which run: a table that changes with the load itself."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TableSpec, schema_of
from ..sinks.versions import Change

LEDGER = TableSpec(
    "load_ledger", schema_of("path string, modified timestamp, length bigint, run string"), key=("path", "modified", "length"))
_SAME = ["path", "modified", "length"]


def found_files(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """path, modified, length of the files there; none is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(paths).select("path", F.col("modificationTime").alias("modified"), "length")


def unseen_files(change: Change, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """The files that the ledger doesn't have as they are now; a changed file is one of them."""
    files = found_files(change.spark, paths, glob)
    return files.join(change.table(LEDGER).select(_SAME), _SAME, "left_anti")


def load_unseen(
    spark: SparkSession, root: str, paths: str | Sequence[str], run: str, load: Callable[[Change, list[str]], object],
    glob: str | None = None,
) -> list[str]:
    """Load the files that no earlier run has loaded, and note them; returns their paths.

    `load` gets the change and the paths and puts rows in; these and the notes
    are published together, so a lost run has loaded nothing and a repeated one
    loads nothing twice. Without new files there is no new version. The
    paths of one run go through the driver, as Spark's own file lists do.
    """
    with Change(spark, root) as change:
        rows = unseen_files(change, paths, glob).collect()
        if rows:
            load(change, [r["path"] for r in rows])
            noted = spark.createDataFrame([(*r, run) for r in rows], LEDGER.schema)
            change.append(noted, LEDGER)
    return [r["path"] for r in rows]
