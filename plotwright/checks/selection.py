"""Choosing, numbering and counting rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import select
from ..session import work_path
from ..sources import sinks
from .registry import check, table


@check(
    "distinct_on",
    """SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
)
def distinct_on(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return select.first_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@check(
    "last_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def last_per_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return select.last_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


def _work(spark, sf_dir):
    done = F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("done")
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", done)


@check("pending_queue", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P'")
def pending_queue(spark, sf_dir):
    return select.pending(_work(spark, sf_dir), "done", ["o_orderkey"]).drop("done")


@check(
    "pending_queue_top",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P' ORDER BY o_custkey, o_orderkey LIMIT 100",
)
def pending_queue_top(spark, sf_dir):
    return select.pending(_work(spark, sf_dir), "done", ["o_custkey", "o_orderkey"], 100).drop("done")


@check(
    "unprocessed",
    """SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1)
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) ORDER BY o_custkey LIMIT 200""",
)
def unprocessed(spark, sf_dir):
    paths = F.when(F.col("o_orderstatus") == "F", F.array(F.lit("a.jpg"))).when(F.col("o_orderstatus") == "O", F.array().cast("array<string>"))
    links = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", paths.alias("local_path"))
    taken = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return select.unprocessed(links, "o_custkey", "local_path", taken, 200)


@check("row_numbers", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_no FROM orders")
def row_numbers(spark, sf_dir):
    return select.numbered(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


@check(
    "batches",
    """SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 100 AS batch_no FROM orders WHERE o_orderstatus <> 'F'""",
)
def batches(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'").select("o_orderkey")
    return select.batches(orders, "o_orderkey", 100)


@check(
    "batch_plan",
    """SELECT c_custkey AS internal_id, (row_number() OVER (ORDER BY c_custkey) - 1) // 500 AS batch_no, '20010802_090000' AS run FROM customer""",
)
def batch_plan(spark, sf_dir):
    """Two persisted plans, the newest read back."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("internal_id"))
    path = work_path(spark, "batches")
    sinks.write_batches(select.batches(customers, "internal_id", 1000), path, "20010801_090000")
    sinks.write_batches(select.batches(customers, "internal_id", 500), path, "20010802_090000")
    return sinks.read_batches(spark, path, "internal_id bigint").select("internal_id", "batch_no", "run")


@check(
    "random_sample",
    "SELECT c_custkey, c_name FROM customer ORDER BY md5('7:' || CAST(c_custkey AS VARCHAR)), c_custkey LIMIT 10",
)
def random_sample(spark, sf_dir):
    return select.sample(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey", 10, seed=7)


@check(
    "top_values",
    """SELECT nullif(p_brand, 'Brand#1') AS brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, brand NULLS FIRST LIMIT 20""",
)
def top_values(spark, sf_dir):
    brands = table(spark, sf_dir, "part").select(F.nullif(F.col("p_brand"), F.lit("Brand#1")).alias("brand"))
    return select.top_values(brands, "brand")


@check("key_union", "SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer")
def key_union(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    return select.key_union(orders, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")))


@check(
    "key_difference",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')",
)
def key_difference(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return select.key_difference(customers, done, ["c_custkey"])


@check("distinct_pairs", "SELECT count(*) AS n_pairs FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)")
def distinct_pairs(spark, sf_dir):
    return select.distinct_pairs(table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")


@check(
    "progress",
    """SELECT count(*) AS total, count(*) FILTER (WHERE o_orderstatus <> 'P') AS processed,
              count(*) FILTER (WHERE o_orderstatus = 'P') AS remaining FROM orders""",
)
def progress(spark, sf_dir):
    return select.progress(table(spark, sf_dir, "orders"), F.col("o_orderstatus") != "P")


@check(
    "progress_unknown",
    """SELECT count(*) AS total, count(*) FILTER (WHERE s = 'F') AS processed, count(*) FILTER (WHERE s IS DISTINCT FROM 'F') AS remaining
       FROM (SELECT nullif(o_orderstatus, 'P') AS s FROM orders)""",
)
def progress_unknown(spark, sf_dir):
    """Rows of which it is not known whether they are done remain."""
    return select.progress(table(spark, sf_dir, "orders"), F.nullif(F.col("o_orderstatus"), F.lit("P")) == "F")
