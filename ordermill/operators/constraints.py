"""The table constraints Spark does not enforce on parquet, as one counting aggregate."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.schemas import LOAD_COLUMNS, LONGEST_SOURCE, MONTH_KEYS, NUMBER_LIMITS, RUN_STATUSES, TEXT_LIMITS


# Decimal places each number is stored with.
_SCALE = {"quantity": 0, "unit_price": 2, "discount": 4, "total_amount": 2}


class ConstraintError(ValueError):
    """Rows that the target table must not hold."""


def transaction_rules() -> dict[str, Column]:
    """Violation test per rule name for rows bound for the transactions table."""
    rules = {f"{name}_not_null": F.col(name).isNull() for name in LOAD_COLUMNS}
    for name, longest in TEXT_LIMITS.items():
        rules[f"{name}_length"] = F.length(name) > longest
    for name, bound in NUMBER_LIMITS.items():
        # A value within half a unit of the bound would be rounded up to it on storing.
        value = F.abs(F.col(name).cast("double"))
        rules[f"{name}_range"] = F.isnan(value) | (value >= bound - 0.5 * 10.0 ** -_SCALE[name])
    return rules


SUMMARY_KEY = [*MONTH_KEYS, "region"]
_SUMMARY_VALUES = [*SUMMARY_KEY, "total_orders", "total_quantity", "total_revenue"]


def summary_rules() -> dict[str, Column]:
    """Violation test per rule name for rows bound for the monthly summary, but for its unique key."""
    rules = {f"{name}_not_null": F.col(name).isNull() for name in _SUMMARY_VALUES}
    return {**rules, "region_length": F.length("region") > TEXT_LIMITS["region"]}


def _count(rules: dict[str, Column]) -> list[Column]:
    return [F.count_if(test).alias(rule) for rule, test in rules.items()]


def constraint_violations(df: DataFrame) -> DataFrame:
    """One row, one count of offending rows per rule of the transactions table."""
    return df.agg(*_count(transaction_rules()))


def summary_violations(df: DataFrame) -> DataFrame:
    """One row, one count of offending rows per rule of the summary, and of keys that occur more than once.

    Rows are counted by key first, with partial results on the map side.
    """
    rules = summary_rules()
    sums = [F.count_if(test).alias(rule) for rule, test in rules.items()]
    by_key = df.groupBy(*SUMMARY_KEY).agg(F.count(F.lit(1)).alias("_rows"), *[n.alias(f"_{rule}") for n, rule in zip(sums, rules)])
    totals = [F.coalesce(F.sum(f"_{rule}"), F.lit(0)).cast("bigint").alias(rule) for rule in rules]
    return by_key.agg(*totals, F.count_if(F.col("_rows") > 1).alias("key_unique"))


def check_summary(df: DataFrame) -> None:
    """Raise ``ConstraintError`` naming every broken rule of the summary."""
    _refuse(summary_violations(df).first().asDict())


def check_log_row(source_file: str | None, counts: dict[str, int | None], status: str) -> None:
    """The constraints of one row of the run log."""
    if source_file is None or len(source_file) > LONGEST_SOURCE:
        raise ConstraintError(f"source_file must be a text of at most {LONGEST_SOURCE} characters")
    absent = sorted(name for name, value in counts.items() if value is None)
    if absent:
        raise ConstraintError(f"run counts without a value: {absent}")
    check_status(status)


def _refuse(found: dict[str, int]) -> None:
    broken = {rule: n for rule, n in found.items() if n}
    if broken:
        raise ConstraintError(f"rows violate the table constraints: {broken}")


class BatchProfile(NamedTuple):
    """Row count and range of order ids of a batch; the ids are None for an empty one."""

    rows: int
    low_id: str | None
    high_id: str | None


def check_constraints(df: DataFrame) -> BatchProfile:
    """Raise ``ConstraintError`` naming every broken rule and its number of rows.

    The same job yields what a load needs to know of the batch.
    """
    size = [F.count(F.lit(1)), F.min("order_id"), F.max("order_id")]
    *counts, rows, low_id, high_id = df.agg(*_count(transaction_rules()), *size).first()
    _refuse(dict(zip(transaction_rules(), counts, strict=True)))
    return BatchProfile(rows, low_id, high_id)


def check_status(status: str) -> None:
    if status not in RUN_STATUSES:
        raise ConstraintError(f"status must be one of {RUN_STATUSES}, not {status!r}")
