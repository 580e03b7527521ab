from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import row

from ordermill.operators import aggregates
from ordermill.operators.cleaning import clean_sales


@pytest.fixture
def clean(frame):
    df = frame(
        row(order_id="1", region="north", product_name="Rake", quantity="2", unit_price="10", discount="0"),
        row(order_id="2", region="North", product_name="Hoe", quantity="1", unit_price="5", discount="0"),
        row(order_id="3", region="south", product_name="Axe", quantity="4", unit_price="5", discount=None),
        row(order_id="4", region="", product_name="Axe", quantity="1", unit_price="5", order_date="2023-11-30"),
        row(order_id=None, region="south", product_category="nan", product_name="nan", quantity="1", unit_price="1"),
    )
    return clean_sales(df, ["pos"])


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_by_region(clean):
    got = aggregates.aggregate_by_region(clean)
    assert got.columns == ["region", "total_orders", "total_quantity", "total_revenue", "avg_order_value"]
    # A row without an id adds revenue but no order.
    assert rows(got) == [
        ("North", 2, 3.0, Decimal("25.00"), Decimal("12.50")),
        ("South", 1, 5.0, Decimal("20.80"), Decimal("20.80")),
    ]


def test_by_category(clean):
    got = aggregates.aggregate_by_category(clean)
    assert got.columns == ["product_category", "total_orders", "units_sold", "total_revenue"]
    assert rows(got) == [("Garden", 4, 8.0, Decimal("49.00"))]


def test_top_products_breaks_ties_by_name(clean):
    assert [r[0] for r in rows(aggregates.top_products(clean))] == ["Axe", "Rake", "Hoe"]
    tied = clean.withColumn("total_amount", clean.total_amount * 0)
    assert [r[0] for r in rows(aggregates.top_products(tied))] == ["Axe", "Hoe", "Rake"]


@pytest.mark.parametrize("n, size", [(0, 0), (1, 1), (50, 3)])
def test_top_products_size(clean, n, size):
    assert aggregates.top_products(clean, n).count() == size


def test_top_products_rejects_a_negative_size(clean):
    with pytest.raises(ValueError):
        aggregates.top_products(clean, -1)


def test_monthly_trend(clean):
    got = aggregates.monthly_trend(clean)
    assert got.columns == ["period", "total_orders", "total_revenue"]
    assert rows(got) == [("2023-05", 3, Decimal("45.80")), ("2023-11", 1, Decimal("4.00"))]


def test_monthly_region_summary(clean):
    got = aggregates.monthly_region_summary(clean)
    assert rows(got) == [
        (2023, 5, "North", 2, 3.0, Decimal("25.00"), Decimal("12.50")),
        (2023, 5, "South", 1, 5.0, Decimal("20.80"), Decimal("20.80")),
    ]


def test_empty_input(clean):
    nothing = clean.limit(0)
    for operator in (
        aggregates.aggregate_by_region,
        aggregates.aggregate_by_category,
        aggregates.top_products,
        aggregates.monthly_trend,
        aggregates.monthly_region_summary,
    ):
        assert rows(operator(nothing)) == []
