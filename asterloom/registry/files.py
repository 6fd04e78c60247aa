"""Sources: rows are written as raw files first, then read the declared way."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timeparts import from_epoch_millis, to_epoch_millis
from ..operators.analysis import count_by
from ..operators.dedup import drop_full_duplicates
from ..operators.rows import not_blank
from ..schemas import schema_of
from ..scratch import materialise, scratch_path
from ..sinks.files import write_csv, write_parquet
from ..sources.files import process_files, read_csv, read_csv_skipping, read_json, read_parquet, render_path
from ..sources.staging import stage_files
from .base import query

_PART = "p_partkey bigint, p_name string, p_brand string, p_size int, p_retailprice double"


@query("SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def catalogue_json_glob(t):
    """JSON files in a sharded tree, found by a glob, repeats dropped."""
    root = scratch_path(t.spark, "catalogue")
    schema = schema_of(_PART)
    shards = t.part.select(*schema.fieldNames(), F.col("p_type").alias("a"), F.floor(F.col("p_size") / 10).alias("b"))
    shards.hint("rebalance", F.col("a"), F.col("b")).write.partitionBy("a", "b").json(root)
    return process_files(
        lambda paths: read_json(t.spark, paths, schema), [f"{root}/*/*/*json"], drop_full_duplicates
    )


@query("""
    SELECT event_id, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts, CAST(user_id AS INTEGER) AS user_id, event_type
    FROM events WHERE year(ts) = 2024 AND month(ts) = 1
""")
def log_json_month(t):
    """JSON lines by year and month; one run reads the folder of its month."""
    root = scratch_path(t.spark, "log")
    log = t.events.select(
        "event_id", to_epoch_millis("ts").alias("ts"), F.col("user_id").cast("string").alias("user_id"), "event_type",
        F.year("ts").alias("year"), F.month("ts").alias("month"),
    )
    log.hint("rebalance", F.col("year"), F.col("month")).write.partitionBy("year", "month").json(root)
    path = render_path("{root}/year={year}/month={month}", {"root": root, "year": 2024, "month": 1})
    raw = read_json(t.spark, path, schema_of("event_id bigint, ts bigint, user_id int, event_type string"), recursive=True)
    return raw.withColumn("ts", from_epoch_millis("ts"))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def stage_json_auto(t):
    """Staged JSON matched by field name; fields not declared are left out."""
    root = scratch_path(t.spark, "customers")
    t.customer.write.json(root)
    return stage_files(t.spark, root, "json", schema_of("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double"))


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus AS status FROM orders")
def stage_json_mapped(t):
    """Staged JSON through a path mapping, nested fields included."""
    root = scratch_path(t.spark, "orders")
    t.orders.select(
        F.struct(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("customer")).alias("ids"),
        F.col("o_totalprice").alias("total price"), F.col("o_orderstatus").alias("status"),
    ).write.json(root)
    mapping = {
        "o_orderkey": ("$.ids.key", "bigint"),
        "o_custkey": ("$['ids']['customer']", "bigint"),
        "o_totalprice": ("$['total price']", "double"),
        "status": ("$.status", "string"),
    }
    schema = schema_of("o_orderkey bigint, o_custkey bigint, o_totalprice double, status string")
    return stage_files(t.spark, root, "json", schema, mapping)


@query("SELECT p_partkey, p_name, p_brand FROM part WHERE p_name <> ''")
def csv_quote_all_roundtrip(t):
    """Every field quoted on the way out; rows without a name left out on the way in."""
    root = scratch_path(t.spark, "quoted")
    write_csv(t.part.select("p_partkey", "p_name", "p_brand"), root)
    schema = schema_of("p_partkey bigint, p_name string, p_brand string")
    return not_blank(read_csv(t.spark, root, schema), "p_name")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def csv_semicolon(t):
    root = scratch_path(t.spark, "semicolon")
    t.customer.write.option("header", True).option("sep", ";").csv(root)
    return read_csv(t.spark, root, schema_of("c_custkey bigint, c_name string, c_acctbal double"), sep=";")


@query("SELECT s_suppkey, s_acctbal FROM supplier")
def csv_header(t):
    root = scratch_path(t.spark, "header")
    t.supplier.write.option("header", True).csv(root)
    return read_csv(t.spark, root, schema_of("s_suppkey bigint, s_acctbal double"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def csv_skip_lines(t):
    """First lines dropped per file, whatever they hold; columns by position."""
    root = scratch_path(t.spark, "skip")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    t.orders.select(columns).write.option("header", True).csv(root)
    schema = schema_of("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double")
    return read_csv_skipping(t.spark, root, schema, skip_lines=1)


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders")
def partitioned_roundtrip(t):
    root = scratch_path(t.spark, "partitioned")
    dated = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    write_parquet(dated, root, partition_by=["year", "month"], cluster_by=["o_orderkey"])
    return read_parquet(t.spark, root, schema_of("o_orderkey bigint, year int, month int"))


@query("""
    SELECT l_returnflag AS flag, count(*) AS n FROM lineitem GROUP BY 1
    UNION ALL SELECT l_linestatus, count(*) FROM lineitem GROUP BY 1
""")
def materialised_source(t):
    """A source parsed once from JSON, then read by two reports."""
    root = scratch_path(t.spark, "slow-source")
    t.lineitem.select("l_returnflag", "l_linestatus").write.json(root)
    staged = materialise(read_json(t.spark, root, schema_of("l_returnflag string, l_linestatus string")))
    flags = count_by(staged, ["l_returnflag"]).withColumnRenamed("l_returnflag", "flag")
    return flags.unionAll(count_by(staged, ["l_linestatus"]))
