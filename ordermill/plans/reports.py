"""Report datasets over the stored tables, and their export."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions import display_label, period_of
from ordermill.plans.warehouse import Warehouse
from ordermill.schemas import LENIENT_COLLATION, MONTH_KEYS, SUMMARY, TRANSACTIONS


def _totals_by(df: DataFrame, key: str, lenient: bool, *measures: Column) -> DataFrame:
    """Group totals, largest revenue first.  A lenient group is shown under its smallest spelling."""
    if lenient:
        grouped = df.groupBy(F.collate(F.col(key), LENIENT_COLLATION).alias("_key"))
        totals = grouped.agg(F.min(key).alias(key), *measures).drop("_key")
    else:
        totals = df.groupBy(key).agg(*measures)
    return totals


def _sum(source: str, alias: str) -> Column:
    return F.sum(source).alias(alias)


def revenue_by_region(summary: DataFrame, lenient: bool = False) -> DataFrame:
    """Orders, quantity and revenue per region, from the summary."""
    measures = [_sum(name, name) for name in ("total_orders", "total_quantity", "total_revenue")]
    totals = _totals_by(summary, "region", lenient, *measures)
    return totals.orderBy(F.desc("total_revenue"), "region")


def revenue_by_category(transactions: DataFrame, lenient: bool = False) -> DataFrame:
    """Rows, units and revenue per category, from the transactions."""
    measures = [
        F.count(F.lit(1)).alias("total_orders"),
        _sum("quantity", "units_sold"),
        _sum("total_amount", "total_revenue"),
    ]
    totals = _totals_by(transactions, "product_category", lenient, *measures)
    return totals.orderBy(F.desc("total_revenue"), "product_category")


def best_products(transactions: DataFrame, top_n: int = 10, lenient: bool = False) -> DataFrame:
    """The ``top_n`` products by revenue, from the transactions."""
    if top_n < 0:
        raise ValueError(f"top_n must not be negative: {top_n}")
    measures = [_sum("quantity", "units_sold"), _sum("total_amount", "total_revenue")]
    totals = _totals_by(transactions, "product_name", lenient, *measures)
    return totals.orderBy(F.desc("total_revenue"), "product_name").limit(top_n)


def revenue_by_month(summary: DataFrame) -> DataFrame:
    """Revenue per ``YYYY-MM``, oldest first, from the summary."""
    months = summary.groupBy(*MONTH_KEYS).agg(_sum("total_revenue", "total_revenue")).orderBy(*MONTH_KEYS)
    return months.select(period_of(F.col("order_year"), F.col("order_month")).alias("period"), "total_revenue")


def headline(summary: DataFrame) -> DataFrame:
    """Total revenue and orders; zeros when nothing is stored."""
    return summary.agg(
        F.coalesce(F.sum("total_revenue"), F.lit(0)).alias("total_revenue"),
        F.coalesce(F.sum("total_orders"), F.lit(0)).alias("total_orders"),
    )


def region_series(summary: DataFrame, lenient: bool = False) -> DataFrame:
    """Chart data: revenue per region, largest first."""
    return revenue_by_region(summary, lenient).select("region", "total_revenue")


def month_series(summary: DataFrame) -> DataFrame:
    """Chart data: revenue per month, oldest first."""
    return revenue_by_month(summary)


def region_revenue_from_rows(transactions: DataFrame) -> DataFrame:
    """Revenue per region straight from the transactions."""
    totals = transactions.groupBy("region").agg(_sum("total_amount", "revenue"))
    return totals.orderBy(F.desc("revenue"), "region")


def best_products_from_rows(transactions: DataFrame, top_n: int = 10) -> DataFrame:
    """The best products with revenue before units."""
    totals = transactions.groupBy("product_name").agg(
        _sum("total_amount", "revenue"), _sum("quantity", "units_sold")
    )
    return totals.orderBy(F.desc("revenue"), "product_name").limit(top_n)


def month_revenue_from_rows(transactions: DataFrame) -> DataFrame:
    """Revenue per year and month straight from the transactions."""
    return transactions.groupBy(*MONTH_KEYS).agg(_sum("total_amount", "revenue")).orderBy(*MONTH_KEYS)


def with_labels(df: DataFrame) -> DataFrame:
    """Columns renamed to their report headings."""
    return df.withColumnsRenamed({name: display_label(name) for name in df.columns})


def write_report_marts(
    warehouse: Warehouse,
    folder: str,
    top_n: int = 10,
    fmt: str = "csv",
    stamp: datetime | None = None,
    lenient: bool = False,
) -> dict[str, str]:
    """Write every report dataset under ``folder/run_ts=<stamp>``; returns the folder of each.

    The five report sheets are always written, the two chart series only when they have rows.  The
    transactions are scanned once: both sheets from them come from totals per category and product, and
    regions and months are totalled once for sheet and chart.  Without ``stamp`` each call has a folder of its own.
    """
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"fmt must be 'csv' or 'parquet', not {fmt!r}")
    if top_n < 0:
        raise ValueError(f"top_n must not be negative: {top_n}")
    name = stamp.strftime("%Y%m%d_%H%M%S") if stamp else f"{datetime.now(timezone.utc):%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"
    target = f"{folder.rstrip('/')}/run_ts={name}"
    summary = warehouse.table(SUMMARY)
    written = {}
    with warehouse.staging() as stage:
        pairs = stage(_category_product_totals(warehouse.table(TRANSACTIONS)), "pairs")
        regions = stage(revenue_by_region(summary, lenient), "regions")
        months = stage(revenue_by_month(summary), "months")
        sheets = {
            "summary": headline(summary),
            "by_region": regions.orderBy(F.desc("total_revenue"), "region"),
            "by_category": _regroup(pairs, "product_category", lenient, "total_orders").orderBy(
                F.desc("total_revenue"), "product_category"
            ),
            "top_products": _regroup(pairs, "product_name", lenient).orderBy(F.desc("total_revenue"), "product_name").limit(top_n),
            "monthly_trend": months.orderBy("period"),
        }
        if not months.isEmpty():
            sheets["chart_revenue_by_region"] = sheets["by_region"].select("region", "total_revenue")
            sheets["chart_monthly_revenue"] = sheets["monthly_trend"]
        for sheet, df in sheets.items():
            written[sheet] = f"{target}/{sheet}"
            with_labels(df).write.format(fmt).option("header", "true").save(written[sheet])
    return written


def _category_product_totals(transactions: DataFrame) -> DataFrame:
    """One row per category and product: all that the sheets over transactions need."""
    return transactions.groupBy("product_category", "product_name").agg(
        F.count(F.lit(1)).alias("total_orders"), _sum("quantity", "units_sold"), _sum("total_amount", "total_revenue")
    )


def _regroup(pairs: DataFrame, key: str, lenient: bool, *counts: str) -> DataFrame:
    """Totals per category or per product from those of their pairs, in the types of the direct totals."""
    measures = [_sum(name, name) for name in (*counts, "units_sold")]
    revenue = F.sum("total_revenue").cast(pairs.schema["total_revenue"].dataType).alias("total_revenue")
    return _totals_by(pairs, key, lenient, *measures, revenue)
