"""The plans that scale: what is shuffled, pruned and pushed down."""

from __future__ import annotations

import re
import uuid

import pytest
from conftest import row
from pyspark.sql import functions as F

from ordermill.operators import aggregates
from ordermill.operators.cleaning import clean_sales, keep_first
from ordermill.operators.disposition import cleaning_stats, dispose_rows
from ordermill.plans import reports
from ordermill.plans.warehouse import Warehouse, known_orders
from ordermill.schemas import SUMMARY, TRANSACTIONS
from ordermill.sources import read_raw


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(df):
    """Columns the file scan hands on."""
    columns = re.search(r"FileScan parquet \S*\[([^\]]*)\]", plan(df)).group(1)
    return {column.split("#")[0] for column in columns.split(",")}


def shuffles(text):
    return text.count("Exchange hashpartitioning") + text.count("Exchange rangepartitioning")


@pytest.fixture
def raw(spark, frame, tmp_path):
    path = str(tmp_path / "raw")
    frame(*[row(order_id=str(i)) for i in range(10)]).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def warehouse(spark, tmp_path, raw):
    made = Warehouse(spark, str(tmp_path / "mart"), f"mart_{uuid.uuid4().hex}")
    made.load_transactions(clean_sales(raw, ["pos"]))
    return made


def test_first_copies_are_chosen_before_the_shuffle(raw):
    text = plan(keep_first(raw, ["pos"]))
    assert shuffles(text) == 1
    before = text[text.index("Exchange hashpartitioning") :]
    assert re.search(r"WindowGroupLimit .*Partial", before)


def test_counting_takes_one_shuffle_with_partial_results(raw):
    text = plan(dispose_rows(raw, ["pos"]))
    assert shuffles(text) == 1
    assert "partial_min_by" in text[text.index("Exchange hashpartitioning") :]


@pytest.mark.parametrize(
    "operator, limit",
    [
        (aggregates.aggregate_by_region, 3),
        (aggregates.aggregate_by_category, 3),
        (aggregates.monthly_trend, 3),
        (aggregates.monthly_region_summary, 3),
        (aggregates.top_products, 2),
    ],
)
def test_aggregates_shuffle_partial_sums(raw, operator, limit):
    text = plan(operator(clean_sales(raw, ["pos"])))
    # Duplicates, groups, and the final sort.
    assert shuffles(text) == limit
    assert "partial_sum" in text


def test_top_products_needs_no_full_sort(raw, warehouse):
    for df in (
        aggregates.top_products(clean_sales(raw, ["pos"])),
        reports.best_products(warehouse.table(TRANSACTIONS)),
        reports.best_products_from_rows(warehouse.table(TRANSACTIONS)),
    ):
        assert "TakeOrderedAndProject" in plan(df)
        assert "rangepartitioning" not in plan(df)


def test_only_needed_columns_are_read(raw):
    read = scanned(aggregates.top_products(clean_sales(raw, ["pos"])))
    assert read == set(raw.columns) - {"payment_method", "product_category", "region"}


def test_no_python_in_the_plans(spark, raw, tmp_path):
    csv = str(tmp_path / "csv")
    raw.drop("pos").write.option("header", "true").csv(csv)
    source = read_raw(spark, csv)
    for df in (clean_sales(source, ["_file", "_block", "_row"]), dispose_rows(raw, ["pos"])):
        assert "Python" not in plan(df) and "ArrowEval" not in plan(df)


def test_mandatory_filter_reaches_a_typed_scan(spark, raw, tmp_path):
    path = str(tmp_path / "typed")
    raw.withColumn("order_date", F.to_date("order_date")).write.parquet(path)
    text = plan(clean_sales(spark.read.parquet(path), ["pos"]))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(order_date", text)


def test_small_batch_is_sent_to_the_stored_rows(warehouse, raw):
    batch = clean_sales(raw, ["pos"])
    text = plan(known_orders(warehouse.table(TRANSACTIONS), raw.select("order_id"), "1", "3"))
    assert "BroadcastHashJoin" in text and "BuildRight" in text
    assert shuffles(text) == 0
    assert "GreaterThanOrEqual(order_id,1)" in text and "LessThanOrEqual(order_id,3)" in text
    assert batch.count() == 10


def test_large_batch_is_joined_by_shuffle(spark, warehouse, raw):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        text = plan(known_orders(warehouse.table(TRANSACTIONS), raw.select("order_id")))
        assert "SortMergeJoin" in text
    finally:
        spark.conf.set(setting, before)


def test_months_prune_partitions(warehouse, raw):
    batch = clean_sales(raw, ["pos"])
    text = plan(warehouse._in_months_of(warehouse.table(TRANSACTIONS), batch))
    assert re.search(r"PartitionFilters: \[[^\]]*order_month", text)


def test_reports_read_only_their_columns(warehouse):
    read = scanned(reports.revenue_by_month(warehouse.table(SUMMARY)))
    assert read == {"total_revenue", "order_year", "order_month"}


def test_copies_that_lie_together_are_not_shuffled(spark, tmp_path):
    from conftest import GOOD

    data = [{**GOOD, "order_id": f"{i % 20}-{i % 3}", "k": i % 20, "pos": i, "customer_name": GOOD["customer_name"] if i % 7 else ""} for i in range(300)]
    split = spark.createDataFrame(data).repartition(3, "k")
    for make in (
        lambda **near: clean_sales(split, ["pos"], **near).select("order_id", "pos"),
        lambda **near: dispose_rows(split, ["pos"], **near).where("disposition = 'kept'").select("order_id", "copies"),
    ):
        assert shuffles(plan(make())) == 2
        assert shuffles(plan(make(near=["k"]))) == 1
        assert sorted(make(near=["k"]).collect()) == sorted(make().collect())
    counts = [cleaning_stats(dispose_rows(split, ["pos"], **near)).first() for near in ({}, {"near": ["k"]})]
    assert counts[0] == counts[1] and counts[0]["rows_read"] == 300


def test_files_keep_copies_in_order_without_a_sort_of_all_rows(spark, tmp_path):
    from ordermill.catalog import write_csv
    from ordermill.schemas import REQUIRED_COLUMNS
    from ordermill.sources.star import STAR_NEAR, STAR_ORDER

    numbers = [f"cast((id * 7919) % 101 as int) as {name}" for name in STAR_ORDER]
    texts = [f"cast((id * 7919) % 101 as string) as {name}" for name in REQUIRED_COLUMNS if name != "order_id"]
    rows = spark.range(500).selectExpr("concat(id % 40, '-', id % 2) as order_id", f"id % 40 as {STAR_NEAR[0]}", *numbers, *texts)
    write_csv(rows.repartition(4, *STAR_NEAR), str(tmp_path / "csv"))
    found = {}
    for file in sorted((tmp_path / "csv").glob("*.csv")):
        for line in file.read_text().splitlines()[1:]:
            values = line.split(",")
            found.setdefault((file.name, values[REQUIRED_COLUMNS.index("order_id")]), []).append(int(values[REQUIRED_COLUMNS.index("quantity")]))
    assert len(found) == len({order for _, order in found}) == 40
    assert sum(map(len, found.values())) == 500 and all(values == sorted(values) for values in found.values())


def test_both_tables_of_a_replacement_read_rows_cleaned_once(spark, raw, monkeypatch):
    from ordermill import catalog

    read = []
    load = Warehouse.load_dataframe
    monkeypatch.setattr(catalog, "_clean", lambda *_: clean_sales(raw, ["pos"]))
    monkeypatch.setattr(Warehouse, "load_dataframe", lambda self, df, *a, **k: (read.append(df.inputFiles()), load(self, df, *a, **k)))
    assert [(r.order_year, r.orders) for r in catalog.load_replace(spark, "").collect()] == [(2023, 10)]
    assert len(read) == 2 and all("clean_" in file for files in read for file in files)


def star_tables(spark, folder):
    """Small order-line tables: 60 orders of three lines, one line in five given twice."""
    tables = {
        "region": "SELECT * FROM VALUES (0, 'EAST'), (1, 'WEST') AS t(r_regionkey, r_name)",
        "nation": "SELECT cast(id AS int) AS n_nationkey, cast(id % 2 AS int) AS n_regionkey FROM range(4)",
        "customer": "SELECT id AS c_custkey, concat('C', id) AS c_name, cast(id % 4 AS int) AS c_nationkey FROM range(10)",
        "part": "SELECT id AS p_partkey, concat('P', id) AS p_name, 'BRASS' AS p_type, 5.0D + id AS p_retailprice FROM range(20)",
        "orders": "SELECT id AS o_orderkey, id % 10 AS o_custkey, date_add(DATE'1998-05-01', cast(id AS int)) AS o_orderdate, '1-URGENT' AS o_orderpriority FROM range(60)",
        "lineitem": "SELECT id % 60 AS l_orderkey, cast(id DIV 60 AS int) % 3 AS l_linenumber, id % 20 AS l_partkey, id % 9 AS l_suppkey, "
        "DATE'1998-07-01' AS l_shipdate, 1.0D + id % 5 AS l_quantity, 10.0D AS l_extendedprice, 0.1D AS l_discount FROM range(216)",
    }
    for name, query in tables.items():
        spark.sql(query).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_rows_of_deliveries_are_joined_once_and_lie_by_order(spark, tmp_path):
    from ordermill.sources.star import STAR_NEAR, STAR_ORDER, joined_once, raw_sales

    folder = star_tables(spark, tmp_path / "star")
    with joined_once(spark, folder) as rows:
        for made in (
            dispose_rows(rows, STAR_ORDER, near=STAR_NEAR),
            clean_sales(rows.where("order_date <= '1998-06-15'"), STAR_ORDER, near=STAR_NEAR),
        ):
            assert shuffles(plan(made)) == 0
        assert all("lineitem" not in file for file in rows.inputFiles())
        assert sorted(map(str, rows.collect())) == sorted(map(str, raw_sales(spark, folder).select(*rows.columns).collect()))
    assert not [database.name for database in spark.catalog.listDatabases() if database.name.startswith("star_")]


def test_joined_rows_do_not_move_to_meet_their_copies_when_parts_are_many(spark, tmp_path):
    from ordermill.sources.star import STAR_NEAR, STAR_ORDER, raw_sales

    folder, setting = star_tables(spark, tmp_path / "star"), "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        raw = raw_sales(spark, folder)
        assert shuffles(plan(clean_sales(raw, STAR_ORDER, near=STAR_NEAR))) == shuffles(plan(raw.drop("x")))
    finally:
        spark.conf.set(setting, before)


def test_transactions_are_written_without_a_shuffle_by_month(spark, frame, tmp_path, monkeypatch):
    hints = []
    kind, setting = type(spark.range(1)), "spark.sql.maxConcurrentOutputFileWriters"
    hint, before = kind.hint, spark.conf.get(setting)
    monkeypatch.setattr(kind, "hint", lambda self, name, *a: (hints.append(name), hint(self, name, *a))[1])
    # More months than a task keeps files open for.
    dates = [f"{1990 + i // 12}-{i % 12 + 1:02d}-0{day}" for i in range(130) for day in (1, 2)]
    rows = frame(*[row(order_id=str(i), order_date=date) for i, date in enumerate(dates)])
    made = Warehouse(spark, str(tmp_path / "mart"), f"mart_{uuid.uuid4().hex}")
    assert made.load_transactions(clean_sales(rows, ["pos"])) == 260 and not hints
    stored = made.table(TRANSACTIONS)
    found = stored.where("year(order_date) = order_year AND month(order_date) = order_month").select("order_id", F.col("order_date").cast("string")).collect()
    assert sorted(map(tuple, found)) == sorted((str(i), date) for i, date in enumerate(dates))
    assert spark.conf.get(setting) == before


def test_what_an_order_decides_is_made_once_an_order(spark, tmp_path):
    from ordermill.sources.star import raw_sales

    folder = star_tables(spark, tmp_path / "star")
    text = raw_sales(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    last_join = re.search(r"Join Inner, \(l_orderkey#\d+L? = o_orderkey", text).start()
    assert "date_format" in text[last_join:] and "date_format" not in text[:last_join]


def test_a_filter_on_a_text_that_is_moved_into_a_join_strips_it_at_most_twice(spark, tmp_path):
    from ordermill.sources.star import STAR_ORDER, raw_sales

    folder = star_tables(spark, tmp_path / "star")
    text = clean_sales(raw_sales(spark, folder), STAR_ORDER)._jdf.queryExecution().optimizedPlan().toString()
    condition = next(line for line in text.splitlines() if "Join Inner" in line and "c_name" in line)
    assert 0 < text[text.index(condition) :].count("RLIKE(trim(") <= 2
