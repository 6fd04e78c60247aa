"""Checks as reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.quality import completeness, duplicate_keys, null_counts, orphan_counts, row_counts
from ..operators.stored import stored_schema_differences
from ..schemas import schema_of
from ..scratch import scratch_path
from .base import query


@query("""
    SELECT 'orders' AS tbl, count(*) AS n, count(*) > 0 AS ok FROM orders
    UNION ALL SELECT 'customer', count(*), count(*) > 0 FROM customer
""")
def dq_non_empty(t):
    return row_counts({"orders": t.orders, "customer": t.customer})


@query("SELECT count(*) AS n_null FROM orders WHERE o_orderkey IS NULL")
def dq_null_count(t):
    return null_counts(t.orders, ["o_orderkey"]).withColumnRenamed("o_orderkey", "n_null")


@query("""
    SELECT count(*) - count(p_partkey) AS p_partkey, count(*) - count(p_size) AS p_size
    FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_type = 'ECONOMY') p ON l_partkey = p_partkey
""")
def dq_null_counts_joined(t):
    """NULLs an outer join leaves, both columns in one pass."""
    known = t.part.filter(F.col("p_type") == "ECONOMY").select("p_partkey", "p_size")
    joined = t.lineitem.select("l_partkey").join(known, F.col("l_partkey") == F.col("p_partkey"), "left")
    return null_counts(joined, ["p_partkey", "p_size"])


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def dq_duplicate_keys(t):
    return duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""
    SELECT (SELECT count(*) FROM lineitem) AS n_source,
           (SELECT count(*) FROM lineitem LEFT JOIN part ON l_partkey = p_partkey) AS n_target
""")
def dq_completeness(t):
    facts = t.lineitem.select("l_partkey")
    return completeness(facts, facts.join(t.part.select("p_partkey"), F.col("l_partkey") == F.col("p_partkey"), "left"))


_ORDERS = schema_of("o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz")


@query("""
    SELECT o_orderkey, 'o_totalprice is string, not double' AS difference FROM orders WHERE o_orderstatus = 'P'
""")
def stored_schema(t):
    """Orders stored by status, one status with a price as text: the rows of the files whose footers say so."""
    root = scratch_path(t.spark, "orders")
    for status, kind in (("F", "double"), ("O", "double"), ("P", "string")):
        rows = t.orders.filter(F.col("o_orderstatus") == status).select(*_ORDERS.fieldNames())
        rows.withColumn("o_totalprice", F.col("o_totalprice").cast(kind)).write.parquet(f"{root}/o_orderstatus={status}")
    found = stored_schema_differences(t.spark, root, _ORDERS)
    rows = t.spark.createDataFrame([], "o_orderkey bigint, difference string")
    for difference in sorted({d for _, d in found}):
        files = t.spark.read.parquet(*(file for file, d in found if d == difference))
        rows = rows.unionByName(files.select("o_orderkey", F.lit(difference).alias("difference")))
    return rows


@query("""
    SELECT 'customer' AS "check", count(*) AS n FROM (SELECT DISTINCT o_custkey FROM orders) o
    WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)
    UNION ALL
    SELECT 'part', count(*) FROM (SELECT DISTINCT l_partkey FROM lineitem) l
    WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 25)
""")
def dq_integrity(t):
    return orphan_counts({
        "customer": (t.orders, "o_custkey", t.customer.filter(F.col("c_acctbal") > 0), "c_custkey"),
        "part": (t.lineitem, "l_partkey", t.part.filter(F.col("p_size") > 25), "p_partkey"),
    })
