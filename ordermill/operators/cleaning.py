"""Cleaning of raw sales rows, one operator per rule, and their composition.

The order of the rules matters: a row failing several rules is dropped by the first, and a
duplicate is dropped before its numbers are looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions import ISO_DATE, blank_to_null, in_range, parse_date, parse_number, round2, title_case
from ordermill.schemas import LENIENT_COLLATION, MANDATORY_VALUES, NUMBER_COLUMNS, REQUIRED_COLUMNS, TEXT_COLUMNS


def validate_schema(df: DataFrame) -> None:
    """Raise ``ValueError`` naming, sorted, the required columns the input lacks."""
    missing = sorted(set(REQUIRED_COLUMNS) - set(df.columns))
    if missing:
        raise ValueError(f"columns absent from the input: {missing}")


def normalize_text(df: DataFrame) -> DataFrame:
    """Strip the text columns, null the blank ones and title-case the region."""
    stripped = df.withColumns({name: blank_to_null(F.col(name)) for name in TEXT_COLUMNS})
    # A projection of its own: the stripped region is used several times and computed once.
    return stripped.withColumn("region", title_case(F.col("region")))


def parse_dates(df: DataFrame, layouts: Sequence[str] = (ISO_DATE,)) -> DataFrame:
    """Make ``order_date`` a date; a text no layout reads becomes null."""
    kind = df.schema["order_date"].dataType
    if not isinstance(kind, T.StringType):
        return df.withColumn("order_date", F.col("order_date").cast("date"))
    return df.withColumn("order_date", parse_date(F.col("order_date"), layouts))


def parse_numbers(df: DataFrame, on_bad_number: str = "fail") -> DataFrame:
    """Make quantity, price and discount doubles; NaN counts as no value."""
    parsed = {}
    for name in NUMBER_COLUMNS:
        column = F.col(name)
        if isinstance(df.schema[name].dataType, T.StringType):
            parsed[name] = parse_number(column, on_bad_number)
        else:
            value = column.cast("double")
            parsed[name] = F.when(~F.isnan(value), value)
    return df.withColumns(parsed)


def conform(df: DataFrame, layouts: Sequence[str] = (ISO_DATE,), on_bad_number: str = "fail") -> DataFrame:
    """Typed, normalised columns; no row is dropped yet."""
    validate_schema(df)
    return parse_numbers(parse_dates(normalize_text(df), layouts), on_bad_number)


def _presence() -> list[Column]:
    """One test per mandatory value.  A date out of range counts as none, as an unreadable one does."""
    return [
        in_range(F.col(name)) if name == "order_date" else F.col(name).isNotNull() for name in MANDATORY_VALUES
    ]


def is_missing() -> Column:
    """True where a mandatory value is absent."""
    return ~reduce(and_, [F.coalesce(present, F.lit(False)) for present in _presence()])


def quantity_ok() -> Column:
    """True for a positive quantity; an absent one fails."""
    return F.coalesce(F.col("quantity") > 0, F.lit(False))


def price_ok() -> Column:
    """True for a price of zero or more."""
    return F.coalesce(F.col("unit_price") >= 0, F.lit(False))


def drop_missing(df: DataFrame) -> DataFrame:
    """One filter per value, so that each can move to the scan or join side that supplies it."""
    for present in _presence():
        df = df.where(present)
    return df


def order_key(lenient: bool = False) -> Column:
    """What makes two order ids the same: the text, or with ``lenient`` the text but for case, accents and trailing blanks."""
    return F.collate(F.col("order_id"), LENIENT_COLLATION) if lenient else F.col("order_id")


def keep_first(df: DataFrame, order_by: Sequence[str], lenient: bool = False, near: Sequence[str] = ()) -> DataFrame:
    """The first row of each ``order_id`` in the given order; rows without an id count as one order.

    With ``lenient`` ids that a store without regard to case would take for one are one, spelt as in the first row.

    Spark turns ``row_number() = 1`` into a group limit ahead of the shuffle, so each map task
    sends at most one row per order and a very frequent id does not gather in one task.  ``near`` names columns
    that the order id decides: input that is split by them already, as a join leaves it, is not shuffled again.
    """
    in_order = Window.partitionBy(*near, order_key(lenient)).orderBy(*order_by)
    return df.withColumn("_copy", F.row_number().over(in_order)).where("_copy = 1").drop("_copy")


def drop_bad_quantity(df: DataFrame) -> DataFrame:
    return df.where(quantity_ok())


def drop_bad_price(df: DataFrame) -> DataFrame:
    return df.where(price_ok())


def clip_discount(df: DataFrame) -> DataFrame:
    """An absent discount is 0; others are brought into 0..1."""
    filled = F.coalesce(F.col("discount"), F.lit(0.0))
    return df.withColumn("discount", F.greatest(F.least(filled, F.lit(1.0)), F.lit(0.0)))


def add_total_amount(df: DataFrame) -> DataFrame:
    """Line total in cents precision, held as a decimal so that later sums do not depend on order."""
    amount = F.col("quantity") * F.col("unit_price") * (F.lit(1.0) - F.col("discount"))
    return df.withColumn("total_amount", round2(amount).try_cast("decimal(18,2)"))


def add_date_parts(df: DataFrame) -> DataFrame:
    return df.withColumns({"order_year": F.year("order_date"), "order_month": F.month("order_date")})


def derive(df: DataFrame) -> DataFrame:
    """The columns computed on kept rows."""
    return add_date_parts(add_total_amount(clip_discount(df)))


def clean_sales(
    df: DataFrame,
    order_by: Sequence[str],
    layouts: Sequence[str] = (ISO_DATE,),
    on_bad_number: str = "fail",
    lenient: bool = False,
    near: Sequence[str] = (),
) -> DataFrame:
    """All rules in order.  Input columns beyond the required ones are kept."""
    return (
        conform(df, layouts, on_bad_number)
        .transform(drop_missing)
        .transform(keep_first, order_by, lenient, near)
        .transform(drop_bad_quantity)
        .transform(drop_bad_price)
        .transform(derive)
    )
