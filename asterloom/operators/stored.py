"""What stored files say about themselves, against what was declared."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from .quality import QualityError, schema_differences


def stored_files(spark: SparkSession, path: str) -> list[str]:
    """The Parquet files under a folder, by name; reads none of them."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return sorted(r[0] for r in found.select("path").distinct().collect())


def _differences(spark: SparkSession, files: list[str], expected: T.StructType) -> list[str]:
    """What the footers of some files, merged by a Spark job, differ in."""
    try:
        merged = spark.read.option("mergeSchema", "true").parquet(*files)
    except (Py4JJavaError, PySparkException) as error:  # not every Java error comes as one of Python's
        if len(files) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
        return ["files of several types"]
    return schema_differences(merged, expected)


def stored_schema_differences(spark: SparkSession, path: str, expected: T.StructType) -> list[tuple[str, str]]:
    """(file, difference) for each file under `path` whose footer is at odds with `expected`.

    `expected` leaves out columns that folder names hold. All footers are read
    by one Spark job if the files agree; groups that don't are halved until the
    files are found, so a few bad files among many cost a few jobs more. A
    column that some files lack reads as NULL and is a difference only where
    the files looked at together all lack it. An empty folder has none.
    """
    found, todo = [], [stored_files(spark, path)]
    while todo:
        files = todo.pop()
        differences = _differences(spark, files, expected) if files else []
        if differences and len(files) > 1:
            todo += [files[len(files) // 2 :], files[: len(files) // 2]]
        else:
            found += [(file, d) for file in files for d in differences]
    return found


def require_stored_schema(spark: SparkSession, path: str, name: str, expected: T.StructType) -> None:
    """Raise if a stored file is at odds with the declaration, naming the first."""
    found = stored_schema_differences(spark, path, expected)
    if found:
        file, difference = found[0]
        files = len({f for f, _ in found})
        raise QualityError(f"{name}: {difference} in {file}" + f" and {files - 1} other files" * (files > 1))


__all__ = ["require_stored_schema", "stored_files", "stored_schema_differences"]
