from __future__ import annotations

import uuid
from datetime import datetime
from decimal import Decimal

import pytest
from conftest import row

from ordermill.operators.aggregates import monthly_region_summary
from ordermill.operators.cleaning import clean_sales
from ordermill.plans import reports
from ordermill.plans.warehouse import Warehouse
from ordermill.schemas import SUMMARY, TRANSACTIONS


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    from ordermill.schemas import REQUIRED_COLUMNS

    rows = [
        row(order_id="1", region="north", product_name="Rake", product_category="Garden"),
        row(order_id="2", region="south", product_name="rake", product_category="garden", quantity="1"),
        row(order_id="3", region="south", product_name="Axe", product_category="Tools", quantity="9"),
        row(order_id="4", region="south", product_name="Axe", product_category="Tools", order_date="2022-12-01"),
    ]
    columns = ", ".join(f"{name} string" for name in REQUIRED_COLUMNS)
    df = spark.createDataFrame([tuple(r[n] for n in REQUIRED_COLUMNS) for r in rows], columns)
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("mart")), f"mart_{uuid.uuid4().hex}")
    clean = clean_sales(df, ["order_date"])
    warehouse.load_transactions(clean)
    warehouse.upsert_monthly_summary(monthly_region_summary(clean))
    return warehouse


@pytest.fixture(scope="module")
def summary(loaded):
    return loaded.table(SUMMARY)


@pytest.fixture(scope="module")
def transactions(loaded):
    return loaded.table(TRANSACTIONS)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_revenue_by_region(summary, transactions):
    got = reports.revenue_by_region(summary)
    assert got.columns == ["region", "total_orders", "total_quantity", "total_revenue"]
    assert rows(got) == [("South", 3, 13, Decimal("130.00")), ("North", 1, 3, Decimal("30.00"))]
    assert rows(reports.region_series(summary)) == [("South", Decimal("130.00")), ("North", Decimal("30.00"))]
    assert rows(reports.region_revenue_from_rows(transactions)) == rows(reports.region_series(summary))


def test_revenue_by_category(transactions):
    got = reports.revenue_by_category(transactions)
    assert got.columns == ["product_category", "total_orders", "units_sold", "total_revenue"]
    assert [r[0] for r in rows(got)] == ["Tools", "Garden", "garden"]
    lenient = rows(reports.revenue_by_category(transactions, lenient=True))
    assert lenient == [("Tools", 2, 12, Decimal("120.00")), ("Garden", 2, 4, Decimal("40.00"))]


def test_best_products(transactions):
    assert rows(reports.best_products(transactions, 2)) == [
        ("Axe", 12, Decimal("120.00")),
        ("Rake", 3, Decimal("30.00")),
    ]
    assert rows(reports.best_products(transactions, 2, lenient=True))[1][1:] == (4, Decimal("40.00"))
    assert rows(reports.best_products(transactions, 0)) == []
    with pytest.raises(ValueError):
        reports.best_products(transactions, -1)
    assert reports.best_products_from_rows(transactions).columns == ["product_name", "revenue", "units_sold"]


def test_revenue_by_month(summary, transactions):
    expected = [("2022-12", Decimal("30.00")), ("2023-05", Decimal("130.00"))]
    assert rows(reports.revenue_by_month(summary)) == expected
    assert rows(reports.month_series(summary)) == expected
    assert rows(reports.month_revenue_from_rows(transactions)) == [
        (2022, 12, Decimal("30.00")),
        (2023, 5, Decimal("130.00")),
    ]


def test_headline(summary):
    assert rows(reports.headline(summary)) == [(Decimal("160.00"), 4)]
    assert rows(reports.headline(summary.limit(0))) == [(Decimal("0.00"), 0)]


def test_export(spark, loaded, tmp_path):
    stamp = datetime(2024, 2, 3, 4, 5, 6)
    written = reports.write_report_marts(loaded, str(tmp_path), top_n=1, stamp=stamp)
    assert sorted(written) == [
        "by_category",
        "by_region",
        "chart_monthly_revenue",
        "chart_revenue_by_region",
        "monthly_trend",
        "summary",
        "top_products",
    ]
    assert written["summary"] == f"{tmp_path}/run_ts=20240203_040506/summary"
    top = spark.read.csv(written["top_products"], header=True)
    assert top.columns == ["Product Name", "Units Sold", "Total Revenue"]
    assert rows(top) == [("Axe", "12", "120.00")]
    again = reports.write_report_marts(loaded, str(tmp_path), fmt="parquet")
    assert spark.read.parquet(again["by_region"]).columns[1] == "Total Orders"
    with pytest.raises(ValueError):
        reports.write_report_marts(loaded, str(tmp_path), fmt="xlsx")


def test_export_of_empty_tables_has_no_charts(spark, tmp_path):
    empty = Warehouse(spark, str(tmp_path / "mart"), f"mart_{uuid.uuid4().hex}")
    written = reports.write_report_marts(empty, str(tmp_path / "out"))
    assert not [name for name in written if name.startswith("chart")]
    assert spark.read.csv(written["summary"], header=True).collect() == [("0.00", "0")]
