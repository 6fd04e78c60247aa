"""A third of all rows under one key, or under no key, must be split."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from asterloom.operators import joins, upsert
from asterloom.sinks.files import lay_out

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "60000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40000",
}


@pytest.fixture
def small_thresholds(spark):
    before = {k: spark.conf.get(k) if k != "spark.sql.adaptive.autoBroadcastJoinThreshold" else None for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot_plays(spark, hot):
    key = F.when(F.col("id") % 3 == 0, hot).otherwise(F.concat(F.lit("song"), F.col("id") % 500))
    return spark.range(0, 60000, 1, 16).select("id", key.alias("song"))


def catalogue(spark):
    return spark.range(1000).select(
        F.concat(F.lit("song"), F.col("id") % 500).alias("title"), F.col("id").alias("song_id")
    ).repartition(8)


def test_hot_key_is_split_though_members_are_aggregated(spark, small_thresholds):
    found = joins.look_up_first(hot_plays(spark, F.lit("song7")), catalogue(spark), {"song": "title"}, ["song_id"])
    assert "skew=true" in executed(found)
    assert found.count() == 60000 and found.filter("song_id is null").count() == 0
    assert found.filter("song = 'song7'").agg(F.max("song_id"), F.min("song_id")).first()[:] == (7, 7)


def test_rows_without_a_key_are_spread(spark, small_thresholds):
    found = joins.look_up_first(hot_plays(spark, F.lit(None)), catalogue(spark), {"song": "title"}, ["song_id"])
    assert found.filter("song is null and song_id is null").count() == 20000
    per_task = found.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task < 20000


def test_attach_matches_equal_numbers_of_different_types(spark):
    rows = spark.createDataFrame([(1, -0.0), (2, 5.0), (3, None)], "id int, k double")
    members = spark.createDataFrame([(0, "zero"), (5, "five")], "code int, label string")
    found = joins.attach(rows, members, {"k": "code"}, ["label"])
    assert sorted(map(tuple, found.select("id", "label").collect())) == [(1, "zero"), (2, "five"), (3, None)]
    same = joins.attach(rows, members.withColumn("code", F.col("code").cast("double")), {"k": "code"}, ["label"], "inner")
    assert same.count() == 2
    with pytest.raises(TypeError):
        joins.attach(rows, members, {"k": "label"}, ["code"])


def test_hot_key_reaches_the_shuffle_once_per_task(spark):
    """Upserts combine before the shuffle: 8 input tasks, at most 8 rows of the hot key."""
    batch = spark.range(0, 40000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"), F.col("id").alias("ts")
    )
    reduced = upsert.reduce_upserts(batch, ["k"], ["ts"], ["v"])
    plan = reduced._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max_by") > plan.index("Exchange")
    assert reduced.filter("k = 0").first().v == 39999 and reduced.count() == 40000 - 13334 + 1


def test_hot_partition_is_written_by_several_tasks(spark, small_thresholds, folder, local):
    rows = spark.range(0, 60000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 5)).alias("p"), "id", F.rand(1).alias("r")
    )
    lay_out(rows, ["p"]).write.partitionBy("p").parquet(f"{folder}/t")
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (local / "t").glob("p=*")}
    assert files["p=hot"] > 1
    assert spark.read.parquet(f"{folder}/t").count() == 60000
