from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from conftest import row
from pyspark.sql import functions as F

from ordermill.operators.aggregates import monthly_region_summary
from ordermill.operators.cleaning import clean_sales
from ordermill.operators.constraints import ConstraintError, constraint_violations
from ordermill.plans.audit import log_run
from ordermill.plans.warehouse import DuplicateOrderError, Warehouse, load_projection
from ordermill.schemas import LOAD_COLUMNS, RUN_LOG, SUMMARY, TRANSACTIONS


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "mart"), f"mart_{uuid.uuid4().hex}")


@pytest.fixture
def clean(frame):
    return lambda *rows: clean_sales(frame(*rows), ["pos"]).drop("pos")


def ids(warehouse):
    return sorted(r.order_id for r in warehouse.table(TRANSACTIONS).collect())


def summary(warehouse):
    rows = warehouse.table(SUMMARY).collect()
    return {(r.order_year, r.order_month, r.region): (r.total_orders, r.total_revenue) for r in rows}


def staging_tables(warehouse):
    return warehouse.spark.catalog.listTables(f"{warehouse.database}_staging")


def test_tables_are_created_once_and_found_again(spark, warehouse, clean):
    assert warehouse.ready()
    warehouse.load_transactions(clean(row()))
    again = Warehouse(spark, warehouse.root, f"mart_{uuid.uuid4().hex}")
    assert again.ready() and ids(again) == ["N-1"]
    assert Warehouse(spark, warehouse.root, warehouse.database).table(TRANSACTIONS).count() == 1


def test_not_ready_without_a_table_or_with_other_columns(warehouse, tmp_path):
    warehouse.execute(f"DROP TABLE {RUN_LOG}")
    assert not warehouse.ready()
    warehouse.execute(f"CREATE TABLE {RUN_LOG} (run_id STRING) USING parquet LOCATION '{tmp_path}/log'")
    assert not warehouse.ready()


def test_load_stores_types_and_defaults(warehouse, clean):
    batch = clean(row(quantity="2.7", unit_price="10.005", discount="0.12345", customer_name=" Zoë "))
    assert warehouse.load_transactions(batch) == 1
    got = warehouse.table(TRANSACTIONS).first()
    assert (got.quantity, got.unit_price, got.discount) == (3, Decimal("10.01"), Decimal("0.1235"))
    assert (got.order_date, got.customer_name, got.order_year) == (date(2023, 5, 4), "Zoë", 2023)
    assert got.loaded_at is not None


def test_projection_drops_extras_and_fills_discount(clean):
    batch = clean(row()).withColumn("note", F.lit("x")).withColumn("discount", F.lit(None).cast("double"))
    got = load_projection(batch)
    assert got.columns == LOAD_COLUMNS and got.first().discount == Decimal("0.0000")


def test_stored_order_refuses_the_batch(warehouse, clean):
    warehouse.load_transactions(clean(row()))
    with pytest.raises(DuplicateOrderError, match="N-1"):
        warehouse.load_transactions(clean(row(), row(order_id="N-2")))
    assert ids(warehouse) == ["N-1"]
    assert staging_tables(warehouse) == []


def test_stored_orders_can_be_skipped(warehouse, clean):
    warehouse.load_transactions(clean(row(product_name="old")))
    batch = clean(row(product_name="new"), row(order_id="N-2"), row(order_id="N-0"))
    assert warehouse.load_transactions(batch, "ignore") == 2
    assert ids(warehouse) == ["N-0", "N-1", "N-2"]
    assert {r.product_name for r in warehouse.table(TRANSACTIONS).where("order_id = 'N-1'").collect()} == {"old"}
    assert warehouse.load_transactions(batch, "ignore") == 0
    with pytest.raises(ValueError):
        warehouse.load_transactions(batch, "replace")


def test_empty_batch(warehouse, clean):
    assert warehouse.load_transactions(clean(row()).limit(0)) == 0
    assert warehouse.refresh_summary(clean(row()).limit(0)) == 0
    assert ids(warehouse) == [] and summary(warehouse) == {}


@pytest.mark.parametrize(
    "fault, rule",
    [
        ({"region": " "}, "region_not_null"),
        ({"product_category": "nan"}, "product_category_not_null"),
        ({"order_id": None}, "order_id_not_null"),
        ({"order_id": "x" * 51}, "order_id_length"),
        ({"customer_name": "é" * 151}, "customer_name_length"),
        ({"quantity": "2147483647.5", "unit_price": "0"}, "quantity_range"),
        ({"unit_price": "99999999.995", "quantity": "1"}, "unit_price_range"),
        ({"unit_price": "90000000", "quantity": "1000"}, "total_amount_range"),
    ],
)
def test_constraints(warehouse, clean, fault, rule):
    batch = clean(row(order_id="fine"), row(**fault))
    broken = {k: n for k, n in constraint_violations(batch).first().asDict().items() if n}
    assert broken == {rule: 1}
    with pytest.raises(ConstraintError, match=rule):
        warehouse.load_transactions(batch)
    assert ids(warehouse) == []


def test_values_at_the_limits_load(warehouse, clean):
    batch = clean(
        row(order_id="x" * 50, customer_name="é" * 150, quantity="2147483647", unit_price="0"),
        row(order_id="b", quantity="1", unit_price="99999999.99", discount="0"),
    )
    assert warehouse.load_transactions(batch) == 2


def test_frames_can_be_loaded_into_any_table(spark, warehouse, clean):
    df = spark.range(3).withColumn("name", F.lit("x"))
    assert warehouse.load_dataframe(df, "notes") == 3
    assert warehouse.load_dataframe(df, "notes") == 3
    assert warehouse.table("notes").count() == 6
    assert warehouse.load_dataframe(df.select("name", "id"), "notes", "replace") == 3
    assert sorted(r.id for r in warehouse.table("notes").collect()) == [0, 1, 2]
    with pytest.raises(ValueError, match="already exists"):
        warehouse.load_dataframe(df, "notes", "fail")
    with pytest.raises(ValueError):
        warehouse.load_dataframe(df, "notes", "upsert")


def test_frames_for_the_transactions_keep_its_rules(warehouse, clean):
    assert warehouse.load_dataframe(clean(row(), row(order_id="N-2")), TRANSACTIONS) == 2
    with pytest.raises(DuplicateOrderError):
        warehouse.load_dataframe(clean(row()), TRANSACTIONS)
    twice = clean(row(order_id="N-3")).union(clean(row(order_id="N-3")))
    with pytest.raises(DuplicateOrderError, match="more than once"):
        warehouse.load_dataframe(twice, TRANSACTIONS)
    assert warehouse.load_dataframe(clean(row(order_id="N-9")), TRANSACTIONS, "replace") == 1
    assert ids(warehouse) == ["N-9"]
    assert warehouse.table(TRANSACTIONS).first().quantity == 3


def test_upsert_touches_only_its_keys(warehouse, clean):
    first = clean(
        row(order_id="1", region="a", order_date="2023-01-05"),
        row(order_id="2", region="b", order_date="2023-01-06"),
        row(order_id="3", region="a", order_date="2023-02-01"),
    )
    assert warehouse.upsert_monthly_summary(monthly_region_summary(first)) == 3
    stamps = {(r.order_month, r.region): r.refreshed_at for r in warehouse.table(SUMMARY).collect()}
    second = clean(
        row(order_id="4", region="b", order_date="2023-01-07", quantity="10"),
        row(order_id="5", region="c", order_date="2024-01-01"),
        row(order_id="6", region="a", order_date="2023-02-09"),
    )
    assert warehouse.upsert_monthly_summary(monthly_region_summary(second)) == 3
    assert summary(warehouse) == {
        (2023, 1, "A"): (1, Decimal("30.00")),
        (2023, 1, "B"): (1, Decimal("100.00")),
        (2023, 2, "A"): (1, Decimal("30.00")),
        (2024, 1, "C"): (1, Decimal("30.00")),
    }
    after = {(r.order_month, r.region): r.refreshed_at for r in warehouse.table(SUMMARY).collect()}
    # Only the changed row is marked as refreshed; the re-sent equal one is not.
    assert after[(1, "A")] == stamps[(1, "A")] and after[(2, "A")] == stamps[(2, "A")]
    assert after[(1, "B")] > stamps[(1, "B")]


def test_upsert_twice_is_upsert_once(warehouse, clean):
    batch = monthly_region_summary(clean(row(), row(order_id="N-2", region="east")))
    warehouse.upsert_monthly_summary(batch)
    once = sorted(warehouse.table(SUMMARY).collect())
    warehouse.upsert_monthly_summary(batch)
    assert sorted(warehouse.table(SUMMARY).collect()) == once


def test_upsert_over_several_months(warehouse, clean):
    rows = [row(order_id=str(i), order_date=f"2023-0{i + 1}-01") for i in range(4)]
    warehouse.upsert_monthly_summary(monthly_region_summary(clean(*rows)))
    warehouse.upsert_monthly_summary(monthly_region_summary(clean(*rows[1:3])))
    assert len(summary(warehouse)) == 4


def test_refresh_of_the_batch_or_from_the_rows(warehouse, clean):
    batches = [clean(row(order_id="1")), clean(row(order_id="2", order_date="2023-05-20", quantity="1"))]
    for batch in batches:
        warehouse.load_transactions(batch)
        warehouse.refresh_summary(batch, "batch")
    assert summary(warehouse) == {(2023, 5, "West"): (1, Decimal("10.00"))}
    warehouse.refresh_summary(batches[1], "recompute")
    assert summary(warehouse) == {(2023, 5, "West"): (2, Decimal("40.00"))}
    with pytest.raises(ValueError):
        warehouse.refresh_summary(batches[1], "never")


def test_the_overwrite_mode_of_the_session_is_left_alone(spark, warehouse, clean):
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    warehouse.refresh_summary(clean(row()))
    assert spark.conf.get(setting) == before


def test_queries_with_parameters(spark, warehouse, clean):
    warehouse.load_transactions(clean(row(), row(order_id="N-2", region="east"), row(order_id="N-3")))
    query = f"SELECT order_id FROM {TRANSACTIONS} WHERE region = :region ORDER BY order_id DESC LIMIT :n"
    before = spark.catalog.currentDatabase()
    assert [r[0] for r in warehouse.run_query(query, {"region": "West", "n": 1}).collect()] == ["N-3"]
    assert warehouse.run_query(f"SELECT COUNT(*) AS n FROM {TRANSACTIONS}").first().n == 3
    assert spark.catalog.currentDatabase() == before


def test_statements(warehouse):
    warehouse.execute("CREATE TABLE extra (id INT) USING parquet")
    warehouse.execute("INSERT INTO extra VALUES (:a), (:b)", {"a": 1, "b": 2})
    assert warehouse.run_query("SELECT SUM(id) AS s FROM extra").first().s == 3


def test_run_log(warehouse):
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    end = start + timedelta(seconds=2.106)
    run_id = log_run(warehouse, "f.csv", 6, 2, 4, 2, "SUCCESS", start, end)
    log_run(warehouse, "g.csv", 6, 0, 0, 0, "FAILED", start, end, "broken", run_id="other")
    got = {r.source_file: r for r in warehouse.table(RUN_LOG).collect()}
    assert got["f.csv"].duration_seconds == Decimal("2.11") and got["f.csv"].rows_rejected == 4
    assert (got["g.csv"].status, got["g.csv"].error_message) == ("FAILED", "broken")
    with pytest.raises(ConstraintError):
        log_run(warehouse, "f.csv", 0, 0, 0, 0, "DONE", start, end)


def test_month_holding_most_rows_is_written_by_several_tasks(spark, warehouse, clean):
    ids = spark.range(60000).select(F.sha2(F.col("id").cast("string"), 256).substr(1, 50).alias("order_id"))
    batch = ids.crossJoin(F.broadcast(clean(row()).drop("order_id")))
    first_third = F.col("order_id") < "5"
    late = batch.withColumn("order_month", F.when(first_third, F.ascii("order_id") % 7 + 6).otherwise(5))
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "500k")
    try:
        assert warehouse.load_transactions(late) == 60000
    finally:
        spark.conf.set(setting, before)
    stored = warehouse.table(TRANSACTIONS)
    files = stored.select("order_month", F.input_file_name().alias("f")).distinct().groupBy("order_month").count()
    count = {r.order_month: r["count"] for r in files.collect()}
    assert count[5] > 3 and stored.count() == 60000


def test_unknown_columns_are_refused(warehouse, clean):
    with pytest.raises(ValueError, match="extra"):
        warehouse.load_dataframe(clean(row()).withColumn("extra", F.lit(1)), TRANSACTIONS)
    warehouse.load_dataframe(warehouse.spark.range(2), "notes")
    with pytest.raises(ValueError, match="more"):
        warehouse.load_dataframe(warehouse.spark.range(2).withColumn("more", F.lit(1)), "notes")
    assert warehouse.table("notes").count() == 2 and ids(warehouse) == []


def test_replace_makes_a_table_of_the_frames_columns(warehouse):
    warehouse.load_dataframe(warehouse.spark.range(2), "notes")
    assert warehouse.load_dataframe(warehouse.spark.range(3).toDF("other"), "notes", "replace") == 3
    assert warehouse.table("notes").columns == ["other"] and warehouse.table("notes").count() == 3


def test_tables_of_another_root_are_refused(spark, warehouse, tmp_path):
    with pytest.raises(ValueError, match="lies in"):
        Warehouse(spark, str(tmp_path / "elsewhere"), warehouse.database)
    Warehouse(spark, warehouse.root + "/", warehouse.database)


def test_summary_rows_keep_their_rules(warehouse, clean):
    totals = monthly_region_summary(clean(row()))
    assert warehouse.load_dataframe(totals, SUMMARY) == 1
    with pytest.raises(ConstraintError, match="already stored"):
        warehouse.load_dataframe(totals, SUMMARY)
    with pytest.raises(ConstraintError, match="key_unique"):
        warehouse.load_dataframe(totals.union(totals), SUMMARY, "replace")
    with pytest.raises(ConstraintError, match="region_not_null"):
        warehouse.upsert_monthly_summary(totals.withColumn("region", F.lit(None).cast("string")))
    assert len(summary(warehouse)) == 1
    assert warehouse.load_dataframe(totals.withColumn("region", F.lit("North")), SUMMARY, "replace") == 1
    assert list(summary(warehouse)) == [(2023, 5, "North")]


def test_log_rows_keep_their_rules(warehouse):
    now = datetime(2024, 1, 1)
    for source, read in (("x" * 256, 0), (None, 0), ("f.csv", None)):
        with pytest.raises(ConstraintError):
            log_run(warehouse, source, read, 0, 0, 0, "SUCCESS", now, now)
    assert warehouse.table(RUN_LOG).count() == 0


def test_oversized_total_is_named(warehouse, clean):
    huge = clean(row(quantity="1e12", unit_price="1e12"))
    with pytest.raises(ConstraintError, match="total_amount"):
        warehouse.load_transactions(huge)
