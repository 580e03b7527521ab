from __future__ import annotations

from datetime import date
from decimal import Decimal

import pandas as pd
import pytest
from conftest import row
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ordermill.operators.cleaning import clean_sales, keep_first, normalize_text, parse_numbers, validate_schema
from ordermill.operators.disposition import cleaning_stats, dispose_rows, kept_rows, with_derived
from ordermill.schemas import LOAD_COLUMNS


def clean(df, **options):
    return {r.order_id: r for r in clean_sales(df, ["pos"], **options).collect()}


def stats(df):
    return cleaning_stats(dispose_rows(df, ["pos"])).first().asDict()


def test_missing_columns_are_named_in_order(frame):
    df = frame(row())
    validate_schema(df)
    with pytest.raises(ValueError, match=r"\['quantity', 'region'\]"):
        validate_schema(df.drop("region", "quantity"))


def test_valid_row(frame):
    got = clean(frame(row(region="  north   SIDE ", customer_name="\tIda ")))["N-1"]
    assert (got.region, got.customer_name, got.order_date) == ("North   Side", "Ida", date(2023, 5, 4))
    assert (got.quantity, got.unit_price, got.discount) == (3.0, 12.5, 0.2)
    assert (got.total_amount, got.order_year, got.order_month) == (Decimal("30.00"), 2023, 5)


def test_text_sentinels(frame):
    got = normalize_text(frame(row(product_name=" nan ", payment_method="  ", product_category="None"))).first()
    assert (got.product_name, got.payment_method, got.product_category) == (None, None, "None")


def test_order_id_is_taken_as_it_is(frame):
    assert set(clean(frame(row(order_id="a"), row(order_id=" a"), row(order_id="A")))) == {"a", " a", "A"}


@pytest.mark.parametrize(
    "fault",
    [{"order_date": "soon"}, {"order_date": None}, {"customer_name": "  "}, {"customer_name": None}, {"unit_price": None}],
)
def test_rows_missing_a_mandatory_value_go(frame, fault):
    df = frame(row(**fault))
    assert clean(df) == {}
    assert stats(df)["rows_dropped_missing_required"] == 1


@pytest.mark.parametrize("value, kept", [("1", True), ("0", False), ("-2", False), (None, False), ("0.5", True)])
def test_quantity_must_be_positive(frame, value, kept):
    df = frame(row(quantity=value))
    assert bool(clean(df)) is kept
    assert stats(df)["rows_dropped_bad_quantity"] == (not kept)


@pytest.mark.parametrize("value, kept", [("0", True), ("-0.01", False), ("7", True)])
def test_price_must_not_be_negative(frame, value, kept):
    df = frame(row(unit_price=value))
    assert bool(clean(df)) is kept
    assert stats(df)["rows_dropped_bad_price"] == (not kept)


@pytest.mark.parametrize("value, used", [(None, 0.0), ("-0.1", 0.0), ("1.5", 1.0), ("0.25", 0.25)])
def test_discount_is_filled_and_clipped(frame, value, used):
    assert clean(frame(row(discount=value)))["N-1"].discount == used


def test_first_copy_wins(frame):
    got = clean(frame(row(product_name="first"), row(product_name="second")))
    assert got["N-1"].product_name == "first"


def test_missing_copy_does_not_count_as_first(frame):
    df = frame(row(customer_name=None), row(product_name="second"))
    assert clean(df)["N-1"].product_name == "second"
    assert stats(df)["rows_dropped_duplicates"] == 0


def test_bad_first_copy_takes_the_good_one_with_it(frame):
    df = frame(row(quantity="-1"), row())
    assert clean(df) == {}
    counts = stats(df)
    assert (counts["rows_dropped_duplicates"], counts["rows_dropped_bad_quantity"]) == (1, 1)


def test_a_row_is_counted_at_its_first_fault(frame):
    counts = stats(frame(row(customer_name=None, quantity="-1", unit_price="-1"), row(quantity="0", unit_price="-1")))
    assert counts == {
        "rows_read": 2,
        "rows_dropped_missing_required": 1,
        "rows_dropped_duplicates": 0,
        "rows_dropped_bad_quantity": 1,
        "rows_dropped_bad_price": 0,
        "rows_cleaned": 0,
        "rows_rejected": 2,
    }


def test_rows_without_an_id_are_copies_of_each_other(frame):
    df = frame(row(order_id=None, product_name="a"), row(order_id=None, product_name="b"), row(order_id="x"))
    assert {k: r.product_name for k, r in clean(df).items()} == {None: "a", "x": "Rake"}
    assert stats(df)["rows_dropped_duplicates"] == 1


def test_blank_keys_survive_cleaning(frame):
    assert clean(frame(row(region=" ", product_category="nan")))["N-1"].region is None


def test_bad_number_fails_or_becomes_null(frame):
    df = frame(row(quantity="three"))
    with pytest.raises(PySparkException, match="not a number: three"):
        clean(df)
    assert clean(df, on_bad_number="null") == {}


def test_nan_in_a_number_column_is_no_value(spark, frame):
    df = frame(row(), row(order_id="N-2")).withColumn("unit_price", F.lit(float("nan")))
    df = df.withColumn("quantity", F.lit(2)).withColumn("discount", F.lit(float("nan")))
    assert parse_numbers(df).select("unit_price", "discount").distinct().collect() == [(None, None)]
    assert clean(df) == {}


def test_typed_dates_are_kept(frame):
    df = frame(row()).withColumn("order_date", F.lit("2022-12-31 23:59:59").cast("timestamp"))
    assert clean(df)["N-1"].order_date == date(2022, 12, 31)


def test_dates_out_of_range_count_as_unreadable(frame):
    dates = ["9999-12-31", "1677-09-21", "1677-09-22", "2262-04-11", "2262-04-12", "0203-01-01"]
    df = frame(*[row(order_id=d, order_date=d) for d in dates])
    as_pandas = pd.to_datetime(pd.Series(dates), errors="coerce", format="%Y-%m-%d")
    kept = {d for d, parsed in zip(dates, as_pandas) if not pd.isna(parsed)}
    assert set(clean(df)) == kept == {"1677-09-22", "2262-04-11"}
    assert set(clean(df.withColumn("order_date", F.to_date("order_date")))) == kept
    assert stats(df)["rows_dropped_missing_required"] == 4


def test_extra_columns_stay(frame):
    df = frame(row()).withColumn("note", F.lit("x"))
    assert clean(df)["N-1"].note == "x"


def test_empty_input(frame):
    df = frame(row()).limit(0)
    assert clean(df) == {}
    assert set(stats(df).values()) == {0}


def test_order_columns_decide_not_the_layout_of_the_data(frame):
    df = frame(*[row(product_name=f"p{i}") for i in range(20)])
    for partitions in (1, 3, 7):
        shuffled = df.repartition(partitions).orderBy(F.rand(partitions))
        assert keep_first(shuffled, ["pos"]).first().product_name == "p0"
        first = kept_rows(with_derived(dispose_rows(shuffled, ["pos"]))).first()
        assert first.product_name == "p0"


def test_both_ways_of_cleaning_agree(frame):
    rows = [
        row(order_id=f"o{i % 17}" if i % 5 else None, quantity=str(i % 4 - 1), unit_price=str(i % 7 - 1))
        for i in range(200)
    ]
    df = frame(*rows)
    one = clean_sales(df, ["pos"]).select(*LOAD_COLUMNS)
    other = kept_rows(with_derived(dispose_rows(df, ["pos"])))
    assert one.schema == other.schema
    key = lambda r: str(r)
    assert sorted(one.collect(), key=key) == sorted(other.collect(), key=key)
