"""The monthly summary kept by differences.

All its measures are sums, so what a batch adds, cancels or corrects is a handful of signed sums per month and region.
They merge with the stored sums whatever the order of batches, and no stored order is read for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.operators.aggregates import average_order_value
from ordermill.schemas import MONTH_KEYS, SUMMARY_SCHEMA

KEYS = [*MONTH_KEYS, "region"]
SUMS = ["total_orders", "total_quantity", "total_revenue"]
SUMMED = [*KEYS, "order_id", "quantity", "total_amount"]  # what the sums are made of
_TYPES = {field.name: field.dataType for field in SUMMARY_SCHEMA.fields}


def monthly_deltas(added: DataFrame | None = None, removed: DataFrame | None = None) -> DataFrame:
    """Signed sums per month and region of stored rows added and removed; what cancels out is left out.

    One aggregate with partial results on the map side over both.
    """
    if added is None and removed is None:
        raise ValueError("neither added nor removed rows")
    signed = [df.select(*SUMMED, F.lit(sign).alias("sign")) for df, sign in ((added, 1), (removed, -1)) if df is not None]
    rows = signed[0] if len(signed) == 1 else signed[0].unionByName(signed[1])
    for key in KEYS:
        rows = rows.where(F.col(key).isNotNull())
    sums = [
        F.sum(F.when(F.col("order_id").isNotNull(), F.col("sign")).otherwise(0)),
        F.sum(F.col("sign") * F.round("quantity").cast("bigint")),
        F.sum(F.col("sign") * F.col("total_amount").cast("decimal(18,2)")),
    ]
    totals = rows.groupBy(*KEYS).agg(*[total.cast(_TYPES[name]).alias(name) for name, total in zip(SUMS, sums)])
    return totals.where(" OR ".join(f"{name} <> 0" for name in SUMS))


def merge_deltas(one: DataFrame, other: DataFrame) -> DataFrame:
    """Differences of two batches as those of one."""
    both = one.unionByName(other).groupBy(*KEYS)
    return both.agg(*[F.sum(name).cast(_TYPES[name]).alias(name) for name in SUMS]).where(" OR ".join(f"{name} <> 0" for name in SUMS))


def apply_deltas(current: DataFrame, deltas: DataFrame) -> DataFrame:
    """The summary rows after the differences; a month and region left without orders goes.

    ``refreshed_at`` moves only on rows that change.
    """
    old, new = current.alias("old"), deltas.alias("new")
    joined = old.join(new, KEYS, "full_outer")
    zero = F.lit(0)
    sums = {name: (F.coalesce(f"old.{name}", zero) + F.coalesce(f"new.{name}", zero)).cast(_TYPES[name]) for name in SUMS}
    changed = joined.select(
        *KEYS,
        *[value.alias(name) for name, value in sums.items()],
        F.when(F.col("new.total_orders").isNull(), F.col("old.refreshed_at")).otherwise(F.current_timestamp()).alias("refreshed_at"),
    ).where("total_orders > 0")
    average = average_order_value(F.col("total_revenue"), F.col("total_orders"))
    return changed.withColumn("avg_order_value", average.cast(_TYPES["avg_order_value"]))
