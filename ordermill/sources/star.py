"""Raw sales rows from order-line, order, customer and part tables.

The tables hold clean, unique data; this mapping gives them the faults a sales export has (padding,
blank names, unreadable dates, impossible numbers), by rules on the keys, so that every cleaning rule
has rows to act on at any scale.  No row is left out.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.plans.scratch import scratch_root, session_setting
from ordermill.sources.files import list_files

# Input order of the rows of one order; together they tell all of its copies apart.
STAR_ORDER = [
    "l_partkey",
    "l_suppkey",
    "l_shipdate",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
]

# What the order id decides and the lines are joined by: rows that are split by it need not move to meet their copies.
STAR_NEAR = ["l_orderkey"]

# Bytes of the lines' files to a bucket of ``joined_once``: at least, where shuffles have as many partitions, and at most.
SMALL_BUCKET, LARGE_BUCKET = 1 << 20, 1 << 25


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def raw_sales(spark: SparkSession, folder: str, blank_keys: bool = False) -> DataFrame:
    """The ten required columns, as text except the numbers, plus the ``STAR_ORDER`` and ``STAR_NEAR`` columns.

    ``blank_keys=True`` also blanks some regions, categories, products and payment methods, which
    cleaning keeps and the transactions table refuses.

    The small tables are joined first, to the orders; the lines meet the parts while they are narrow and the orders last, so
    the result is split by the order.  What a row's order alone decides (date, customer, payment) is made before the
    lines meet the orders, so it is computed once an order, and filters on it drop orders before they are joined.  Which
    side is broadcast is left to the optimizer's size check.
    """
    places = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, folder, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    payment = F.col("o_orderpriority")
    if blank_keys:
        payment = F.when(_every("o_custkey", 59), F.lit(None)).otherwise(payment)
    orders = (
        table(spark, folder, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "o_orderkey",
            "o_custkey",
            "r_name",
            F.when(_every("o_orderkey", 41), "not_a_date")
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
            .alias("order_date"),
            F.when(_every("o_orderkey", 37), "")
            .when(~_every("o_orderkey", 53), F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
            .alias("customer_name"),
            payment.alias("payment_method"),
        )
    )
    lines = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    region = (
        F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("  "), F.col("r_name")))
        .when(F.col("l_linenumber") % 3 == 1, F.concat(F.lower("r_name"), F.lit("\t\u00a0")))
        .otherwise(F.initcap("r_name"))
    )
    category, product = F.col("p_type"), F.concat(F.lit(" "), F.col("p_name"))
    if blank_keys:
        region = F.when(_every("o_custkey", 47), " \u3000").otherwise(region)
        category = F.when(_every("l_partkey", 43), "nan").otherwise(category)
        product = F.when(_every("l_suppkey", 27), "").otherwise(product)

    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"),
        "order_date",
        "customer_name",
        region.alias("region"),
        category.alias("product_category"),
        product.alias("product_name"),
        F.when(_every("l_partkey", 29), -F.col("l_quantity"))
        .when(_every("l_partkey", 31), 0.0)
        .otherwise(F.col("l_quantity"))
        .alias("quantity"),
        F.when(_every("l_suppkey", 19), -F.col("p_retailprice"))
        .when(~_every("l_suppkey", 23), F.col("p_retailprice"))
        .alias("unit_price"),
        F.when(_every("l_partkey", 13), 1.5)
        .when(_every("l_partkey", 17), -0.1)
        .when(~_every("l_partkey", 11), F.col("l_discount"))
        .alias("discount"),
        "payment_method",
        *STAR_ORDER,
        *STAR_NEAR,
    )


def _buckets(spark: SparkSession, folder: str) -> int:
    """As many as shuffles have partitions; fewer where these would be tiny, more where they would be large."""
    size = list_files(spark, f"{folder}/lineitem.parquet").agg(F.sum("length")).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(partitions, math.ceil(size / SMALL_BUCKET)), math.ceil(size / LARGE_BUCKET))


@contextmanager
def joined_once(spark: SparkSession, folder: str, **options) -> Iterator[DataFrame]:
    """All rows of ``raw_sales``, for deliveries that each take some: joined once and written to a table in the scratch folder.

    The table is bucketed by the ``STAR_NEAR`` columns, so rows read from it are split by the order and are
    not shuffled to meet their copies.  It is dropped at the end of the block.
    """
    database, buckets = f"star_{uuid.uuid4().hex}", _buckets(spark, folder)
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{scratch_root(spark)}/{database}'")
    try:
        with session_setting(spark, "spark.sql.shuffle.partitions", buckets):  # the last join splits rows as the buckets do
            rows = raw_sales(spark, folder, **options).write.format("parquet").option("compression", "zstd")
            rows.bucketBy(buckets, *STAR_NEAR).saveAsTable(f"`{database}`.raw_sales")
        yield spark.table(f"`{database}`.raw_sales")
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
