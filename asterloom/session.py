"""Session settings the package relies on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# A hot join key is split at run time even where the split costs one more
# shuffle: a third of all rows may sit under one key. Rows go to Python in
# batches of bounded size, since a worker keeps several copies of one. Shuffle
# files go when the query that wrote them has ended: what later steps read is
# written as a table, and a DataFrame that runs again shuffles again.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
BYTES_PER_SHUFFLE_PARTITION = 128 * 1024 * 1024


def build_session(app_name: str = "asterloom", master: str | None = None, **settings: str) -> SparkSession:
    """A session in UTC with the adaptive settings above; `settings` win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        **RUNTIME_SETTINGS,
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the adaptive settings to a session somebody else built.

    Settings the cluster names itself are left alone.
    """
    named = spark.sparkContext.getConf()
    for key, value in RUNTIME_SETTINGS.items():
        if not named.contains(key):
            spark.conf.set(key, value)
    return spark


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate (file sizes for a scan); runs no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def shuffle_partitions(spark: SparkSession, input_bytes: int) -> int:
    """Partitions so that a shuffle of `input_bytes` fits executor memory."""
    by_size = -(-input_bytes // BYTES_PER_SHUFFLE_PARTITION)
    return int(max(spark.sparkContext.defaultParallelism, by_size))


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Start shuffles wide enough for the input; AQE merges what is too small."""
    if not spark.sparkContext.getConf().contains(INITIAL_PARTITIONS):
        spark.conf.set(INITIAL_PARTITIONS, str(shuffle_partitions(spark, input_bytes)))
