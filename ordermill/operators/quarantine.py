"""Rows a table must not hold, told apart from the others in one pass and kept with their reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.operators.constraints import transaction_rules
from ordermill.schemas import LOAD_COLUMNS

BROKEN = "broken_rules"


def broken_rules() -> Column:
    """A bit per rule of the transactions table, in the order of ``transaction_rules``; 0 where a row breaks none."""
    mask = F.lit(0).cast("bigint")
    for bit, test in enumerate(transaction_rules().values()):
        mask = mask.bitwiseOR(F.when(F.coalesce(test, F.lit(False)), F.lit(1 << bit).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return mask


def reasons(mask: Column) -> Column:
    """The names of the rules whose bits are set."""
    names = [F.when(F.getbit(mask, F.lit(bit)) == 1, F.lit(name)) for bit, name in enumerate(transaction_rules())]
    return F.array_compact(F.array(*names))


def mark_broken(df: DataFrame) -> DataFrame:
    return df.withColumn(BROKEN, broken_rules())


def sound_rows(marked: DataFrame) -> DataFrame:
    return marked.where(F.col(BROKEN) == 0).drop(BROKEN)


def rejected_rows(marked: DataFrame, run_id: str) -> DataFrame:
    """The others as texts, as they may not fit the table's types, with their reasons."""
    return marked.where(F.col(BROKEN) != 0).select(
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("rejected_at"),
        reasons(F.col(BROKEN)).alias("reasons"),
        *[F.col(name).cast("string").alias(name) for name in LOAD_COLUMNS],
    )
