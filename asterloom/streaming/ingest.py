"""Load what arrived since the last run, then stop.

A scheduled run starts these queries with the same checkpoint folder; Spark
remembers which files it has read, and a run that was lost is repeated.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.casts import conform
from ..schemas import TableSpec
from ..scratch import discard, exists
from ..session import shuffle_partitions
from ..sinks.files import insert_new, table_path, upsert_table, write_table
from ..sources.files import as_text

def stream_session(spark: SparkSession, input_bytes: int) -> SparkSession:
    """A session whose state is spread for the input.

    The number of state partitions is fixed by the first run of a checkpoint,
    so it is chosen here and not left to the caller's shuffle setting.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions(spark, input_bytes)))
    # State lives on local disk beside memory and is backed up in the checkpoint.
    session.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return session


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "json",
    glob: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New files under `path` as a stream.

    JSON values are taken as text and then cast, as `read_json` does.
    """
    read_as = as_text(schema) if file_format == "json" else schema
    reader = spark.readStream.schema(read_as).format(file_format)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return conform(reader.load(path), schema)


def run_available(writer, checkpoint: str) -> StreamingQuery:
    """Run a stream writer over all that is there and wait for its end."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def append_stream(stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append the stream to a Parquet folder, each row exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return run_available(writer, checkpoint)


def insert_stream(
    stream: DataFrame, spec: TableSpec, root: str, checkpoint: str, order_by: Sequence[str]
) -> StreamingQuery:
    """Append the rows whose key the stored table lacks, however late they come.

    Needs no watermark and no state beside the table itself, so no row is ever
    too late; a repeated batch adds nothing. A table partitioned by columns of
    its key is compared in the partitions that a batch touches only.
    """
    _create(stream, spec, root)
    return run_available(
        stream.writeStream.foreachBatch(lambda batch, _: insert_new(batch, spec, root, order_by)), checkpoint
    )


def _create(stream: DataFrame, spec: TableSpec, root: str) -> None:
    """Make sure the table is there to be read; adds no rows."""
    if not exists(stream.sparkSession, table_path(spec, root)):
        write_table(stream.sparkSession.createDataFrame([], spec.schema), spec, root)


def upsert_stream(
    stream: DataFrame,
    spec: TableSpec,
    root: str,
    checkpoint: str,
    order_by: Sequence[str],
    update: Sequence[str],
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StreamingQuery:
    """Upsert every batch into a stored table.

    A repeated batch gives the same table: `update` columns take the same last
    values again, and the others are already there. Each batch's rows are
    stored beside the checkpoint before the table is touched, so that a run
    lost in between is made good by the next one.
    """
    _create(stream, spec, root)

    def load(batch: DataFrame, batch_id: int) -> None:
        upsert_table(prepare(batch), spec, root, order_by, update, f"{checkpoint}/merged/{batch_id}")
        discard(batch.sparkSession, f"{checkpoint}/merged/{batch_id - 1}")

    query = run_available(stream.writeStream.foreachBatch(load), checkpoint)
    discard(stream.sparkSession, f"{checkpoint}/merged")
    return query


def stored_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What a stream has appended so far."""
    return spark.read.schema(schema).parquet(path)


__all__ = [
    "append_stream",
    "insert_stream",
    "run_available",
    "stored_stream",
    "stream_files",
    "stream_session",
    "upsert_stream",
]
