"""Intermediate tables, kept where every executor can reach them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`.

    Only a local session without the setting gets a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError(f"{SETTING} must name a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="asterloom-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, never used twice."""
    return f"{shared_dir(spark)}/asterloom/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "step") -> DataFrame:
    """Write once as Parquet and read it back.

    Cuts lineage, fixes values that would differ on a second evaluation, and
    survives the loss of executors. Use it for a slow source that several
    loads read, too: each load then scans only its columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._scratch_path = path
    return table


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to `path` went through to its end."""
    files, marker = _file_system(spark, f"{path}/_SUCCESS")
    return files.exists(marker)


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def discard(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table nobody reads any more."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


def release(*tables: DataFrame) -> None:
    """Discard tables that `materialise` returned, once nothing will read them again.

    What was computed from them must have been written, too: a DataFrame that
    still reads a released table fails.
    """
    for table in tables:
        discard(table.sparkSession, table._scratch_path)
