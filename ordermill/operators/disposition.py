"""Cleaning with exact row counts, for runs that must account for every input row.

``clean_sales`` drops rows without counting them.  Counting as a side effect of the job is not
exact when a lost executor makes Spark run a map task twice, so the counts are carried as data:
one row per distinct order, with the number of its copies and what becomes of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions import ISO_DATE, parse_number
from ordermill.operators.cleaning import conform, derive, is_missing, price_ok, quantity_ok, validate_schema
from ordermill.schemas import LOAD_COLUMNS, NUMBER_COLUMNS, REQUIRED_COLUMNS

KEPT = "kept"
MISSING = "missing"
BAD_QUANTITY = "quantity"
BAD_PRICE = "price"

STAT_COLUMNS = [
    "rows_read",
    "rows_dropped_missing_required",
    "rows_dropped_duplicates",
    "rows_dropped_bad_quantity",
    "rows_dropped_bad_price",
    "rows_cleaned",
    "rows_rejected",
]


def dispose_rows(
    df: DataFrame,
    order_by: Sequence[str],
    layouts: Sequence[str] = (ISO_DATE,),
    carry: Sequence[str] = tuple(REQUIRED_COLUMNS),
    near: Sequence[str] = (),
) -> DataFrame:
    """One row per distinct order: the ``carry`` columns of its first copy, ``copies``, ``disposition``
    and ``bad_numbers`` (texts that are no number, in any copy).

    Rows with a missing mandatory value collapse into one row.  The single shuffle is an aggregate
    with partial results on the map side, so frequent ids and missing rows do not gather in one task.
    ``near`` names columns that the order id decides: input that is split by them already is not shuffled, and missing
    rows then collapse into one for each of their values.
    """
    validate_schema(df)
    texts = [name for name in NUMBER_COLUMNS if isinstance(df.schema[name].dataType, T.StringType)]
    parsed = df.withColumns({f"_{name}": parse_number(F.col(name), "null") for name in texts})
    bad = F.lit(0)
    for name in texts:
        bad = bad + (F.col(name).isNotNull() & F.col(f"_{name}").isNull()).cast("int")
    numbered = parsed.withColumns({"_bad": bad, **{name: F.col(f"_{name}") for name in texts}})
    flagged = conform(numbered, layouts).withColumn("_missing", is_missing())
    first = F.min_by(
        F.when(~F.col("_missing"), F.struct(*[F.col(name) for name in carry if name != "order_id"])),
        F.struct(*[F.col(name) for name in order_by]),
    )
    per_order = (
        flagged.withColumn("order_id", F.when(~F.col("_missing"), F.col("order_id")))
        .groupBy(*near, "_missing", "order_id")
        .agg(first.alias("_first"), F.count(F.lit(1)).alias("copies"), F.sum("_bad").alias("bad_numbers"))
        .select("order_id", "_first.*", "copies", "bad_numbers", "_missing")
    )
    disposition = (
        F.when(F.col("_missing"), MISSING)
        .when(~quantity_ok(), BAD_QUANTITY)
        .when(~price_ok(), BAD_PRICE)
        .otherwise(KEPT)
    )
    return per_order.withColumn("disposition", disposition).drop("_missing")


def with_derived(disposed: DataFrame) -> DataFrame:
    """Disposed rows with the derived columns, which are empty on rows not kept."""
    kept = F.col("disposition") == KEPT
    return derive(disposed.withColumn("quantity", F.when(kept, F.col("quantity"))))


def kept_rows(disposed: DataFrame) -> DataFrame:
    """The clean rows among disposed rows with derived columns."""
    return disposed.where(F.col("disposition") == KEPT).select(*LOAD_COLUMNS)


def cleaning_stats(disposed: DataFrame) -> DataFrame:
    """One row with the seven stage counts."""
    return count_dispositions(disposed).select(*STAT_COLUMNS)


def count_dispositions(disposed: DataFrame) -> DataFrame:
    """The stage counts and the number of bad numbers, in one aggregate."""

    def rows(condition, value):
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("bigint")

    what = F.col("disposition")
    counted = disposed.agg(
        rows(F.lit(True), F.col("copies")).alias("rows_read"),
        rows(what == MISSING, F.col("copies")).alias("rows_dropped_missing_required"),
        rows(what != MISSING, F.col("copies") - 1).alias("rows_dropped_duplicates"),
        rows(what == BAD_QUANTITY, F.lit(1)).alias("rows_dropped_bad_quantity"),
        rows(what == BAD_PRICE, F.lit(1)).alias("rows_dropped_bad_price"),
        rows(what == KEPT, F.lit(1)).alias("rows_cleaned"),
        rows(F.lit(True), F.col("bad_numbers")).alias("bad_numbers"),
    )
    return counted.withColumn("rows_rejected", F.col("rows_read") - F.col("rows_cleaned"))
