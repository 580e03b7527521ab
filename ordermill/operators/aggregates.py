"""Group totals of clean rows.

Every one is a hash aggregate with partial sums on the map side: what is shuffled is one row per
group and task, whatever the share of one group.  Rows without a group key are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions import period_of, round2


def average_order_value(revenue: Column, orders: Column) -> Column:
    """Revenue per order, two places; null without orders."""
    return round2(revenue.cast("double") / F.nullif(orders, F.lit(0)).cast("double")).cast("decimal(22,2)")


def _totals(df: DataFrame, keys: list[str], quantity_name: str | None, with_orders: bool = True) -> DataFrame:
    measures = []
    if with_orders:
        measures.append(F.count("order_id").alias("total_orders"))
    if quantity_name is not None:
        measures.append(F.sum("quantity").alias(quantity_name))
    measures.append(F.sum("total_amount").alias("total_revenue"))
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df.groupBy(*keys).agg(*measures)


def _largest_revenue_first(key: str) -> list[Column]:
    return [F.col("total_revenue").desc(), F.col(key).asc()]


def aggregate_by_region(df: DataFrame) -> DataFrame:
    """Orders, quantity, revenue and average order value per region, largest revenue first."""
    average = average_order_value(F.col("total_revenue"), F.col("total_orders"))
    return (
        _totals(df, ["region"], "total_quantity")
        .withColumn("avg_order_value", average)
        .orderBy(*_largest_revenue_first("region"))
    )


def aggregate_by_category(df: DataFrame) -> DataFrame:
    """Orders, units and revenue per product category, largest revenue first."""
    return _totals(df, ["product_category"], "units_sold").orderBy(*_largest_revenue_first("product_category"))


def top_products(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` products with the largest revenue."""
    if n < 0:
        raise ValueError(f"n must not be negative: {n}")
    totals = _totals(df, ["product_name"], "units_sold", with_orders=False)
    return totals.orderBy(*_largest_revenue_first("product_name")).limit(n)


def monthly_trend(df: DataFrame) -> DataFrame:
    """Orders and revenue per ``YYYY-MM``, oldest first."""
    months = _totals(df, ["order_year", "order_month"], None)
    period = period_of(F.col("order_year"), F.col("order_month")).alias("period")
    return months.select(period, "total_orders", "total_revenue").orderBy("period")


def monthly_totals(df: DataFrame) -> DataFrame:
    """Orders, quantity, revenue and average order value per month and region, in no order."""
    average = average_order_value(F.col("total_revenue"), F.col("total_orders"))
    return _totals(df, ["order_year", "order_month", "region"], "total_quantity").withColumn("avg_order_value", average)


def monthly_region_summary(df: DataFrame) -> DataFrame:
    """The monthly totals in key order."""
    return monthly_totals(df).orderBy("order_year", "order_month", "region")


# The keys of each report frame, and by which of its columns a frame of all totals tells it from the others.
FRAMES = {
    "region": ["region"],
    "category": ["product_category"],
    "product": ["product_name"],
    "month": ["order_year", "order_month"],
    "month_region": ["order_year", "order_month", "region"],
}
FRAME_KEYS = ["region", "product_category", "product_name", "order_year", "order_month"]


def all_totals(df: DataFrame) -> DataFrame:
    """The totals of all frames at once: ``frame``, its keys (the others are null), orders, quantity and revenue.

    Grouping sets read the rows once and shuffle partial sums once.  A row without a key of a frame is left out of
    that frame alone.
    """
    sets = [[F.col(key) for key in keys] for keys in FRAMES.values()]
    orders, quantity, revenue = F.count("order_id"), F.sum("quantity"), F.sum("total_amount")
    frame_of = F.lit(None).cast("string")
    for name, keys in FRAMES.items():
        grouped = sum(1 << (len(FRAME_KEYS) - 1 - i) for i, key in enumerate(FRAME_KEYS) if key not in keys)
        present = F.lit(True)
        for key in keys:
            present = present & F.col(key).isNotNull()
        frame_of = F.when((F.col("_grouping") == grouped) & present, name).otherwise(frame_of)
    totals = df.groupingSets(sets, *FRAME_KEYS).agg(
        F.grouping_id().alias("_grouping"),
        orders.alias("total_orders"),
        quantity.alias("total_quantity"),
        revenue.alias("total_revenue"),
    )
    return totals.select(frame_of.alias("frame"), *FRAME_KEYS, "total_orders", "total_quantity", "total_revenue").where("frame IS NOT NULL")


def split_frames(totals: DataFrame) -> dict[str, DataFrame]:
    """The frames of ``all_totals`` (staged by the caller, so that it is computed once), each with its own keys."""
    measures = ["total_orders", "total_quantity", "total_revenue"]
    return {name: totals.where(F.col("frame") == name).select(*keys, *measures) for name, keys in FRAMES.items()}
