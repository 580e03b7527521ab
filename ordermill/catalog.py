"""The registered queries: every operator applied to the star-schema test tables.

Each callable takes a session and a folder of parquet tables and reads those tables whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.functions import ISO_DATE, strip_space, title_case
from ordermill.operators import aggregates, cleaning
from ordermill.operators.constraints import constraint_violations as count_violations
from ordermill.operators.constraints import summary_violations
from ordermill.operators.disposition import cleaning_stats as stage_counts
from ordermill.operators.disposition import dispose_rows
from ordermill.plans import reports
from ordermill.plans.pipeline import ingest, run_pipeline
from ordermill.plans.scratch import month_writers, new_folder, session_setting
from ordermill.plans.versions import Change, VersionedMart, ingest_atomic
from ordermill.plans.warehouse import (
    Warehouse,
    known_orders,
    load_projection as project_for_load,
    new_orders,
    summary_projection,
)
from ordermill.schemas import LOAD_COLUMNS, REJECTS, REQUIRED_COLUMNS, RUN_LOG, SUMMARY, TEXT_COLUMNS, TRANSACTIONS
from ordermill.sources import read_raw as read_files
from ordermill.sources.files import list_files
from ordermill.sources.star import STAR_NEAR, STAR_ORDER, joined_once, raw_sales
from ordermill.streaming import run_incremental

Query = Callable[[SparkSession, str], DataFrame]

# The tables are delivered in two batches that overlap in June 1998: the second repeats that month's
# orders from the 1st on, after the first had brought them up to the 15th.
FIRST_BATCH_END = "1998-06-15"
SECOND_BATCH_START = "1998-06-01"

# Texts made too long for the transactions table, each on rows whose quantity this divides.
STRETCHED = {"order_id": 3, "customer_name": 4, "region": 5, "product_category": 6, "product_name": 7, "payment_method": 8}

_queries: dict[str, Query] = {}


def _register(query: Query) -> Query:
    _queries[query.__name__] = query
    return query


def all_queries() -> dict[str, Query]:
    return dict(_queries)


# -- shared inputs ----------------------------------------------------------------------------


def _dirty(spark: SparkSession, folder: str) -> DataFrame:
    return raw_sales(spark, folder, blank_keys=True)


def _cleaned(raw: DataFrame) -> DataFrame:
    return cleaning.clean_sales(raw, STAR_ORDER, near=STAR_NEAR)


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return _cleaned(_dirty(spark, folder))


def _transactions(spark: SparkSession, folder: str) -> DataFrame:
    """What the transactions table holds after loading every clean row."""
    return project_for_load(_cleaned(raw_sales(spark, folder)))


def _summary(spark: SparkSession, folder: str) -> DataFrame:
    return summary_projection(aggregates.monthly_region_summary(_transactions(spark, folder)))


def _in_first_batch() -> Column:
    # An unreadable date sorts after every date, so such rows come with the second batch.
    return F.col("order_date") <= FIRST_BATCH_END


def _in_second_batch() -> Column:
    return F.col("order_date") >= SECOND_BATCH_START


def _new_warehouse(spark: SparkSession) -> Warehouse:
    root = new_folder(spark, "mart")
    return Warehouse(spark, root, "mart_" + root.rsplit("-", 1)[-1])


def _stored(warehouse: Warehouse, table: str) -> DataFrame:
    """A table's files, after the warehouse's names are gone from the catalog: a query leaves none behind."""
    rows = warehouse.spark.read.schema(warehouse.table(table).schema).parquet(f"{warehouse.root}/{table}")
    warehouse.drop()
    return rows


def _kept(warehouse: Warehouse, result: DataFrame) -> DataFrame:
    """A result over the tables, written out before their names go."""
    folder = new_folder(warehouse.spark, "result")
    result.write.parquet(folder)
    warehouse.drop()
    return warehouse.spark.read.parquet(folder)


def _load(warehouse: Warehouse, raw: DataFrame, name: str, **options) -> dict:
    return ingest(warehouse, lambda: (raw, [ISO_DATE]), name, order_by=STAR_ORDER, near=STAR_NEAR, **options)


def _loaded_in_two_batches(spark: SparkSession, folder: str, refresh: str) -> Warehouse:
    warehouse = _new_warehouse(spark)
    with joined_once(spark, folder) as raw:
        _load(warehouse, raw.where(_in_first_batch()), "first", on_conflict="ignore", refresh=refresh)
        _load(warehouse, raw.where(_in_second_batch()), "second", on_conflict="ignore", refresh=refresh)
    return warehouse


def write_csv(df: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    """Raw columns as CSV files; the copies of an order stand in one file, in input order.

    A window by the columns that the lines are joined by sorts the rows where they are; its filter, which keeps
    every row, only keeps the window in the plan.
    """
    copy = F.row_number().over(Window.partitionBy(*STAR_NEAR, "order_id").orderBy(*STAR_ORDER))
    in_order = df.withColumn("_copy", copy).where("_copy > 0").select(*REQUIRED_COLUMNS)
    keep_space = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    in_order.write.mode(mode).options(header="true", escape='"', **keep_space).csv(folder)


# -- sources and sinks ------------------------------------------------------------------------


@_register
def read_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The raw rows written to CSV files and read back, no-value texts nulled."""
    drop = new_folder(spark, "csv")
    write_csv(_dirty(spark, folder), drop)
    return cleaning.parse_numbers(read_files(spark, drop)).select(*REQUIRED_COLUMNS)


def _write_torn(spark: SparkSession, source: str, folder: str) -> None:
    """Each file of ``source``, in a folder of its own, with a line at its end that leaves a quote open, and one after it.

    A task reads a file from its start to its end and writes its lines as they come, so no file is ever held whole and
    no line is shuffled.
    """
    ends = ["x,1998-01-01,\"never closed,West,a,b,1,2,0,Cash", "y,1998-01-01,lost,West,a,b,1,2,0,Cash"]

    def with_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = lambda file, values: pa.RecordBatch.from_arrays([pa.array([file] * len(values), pa.string()), values], ["file", "value"])
        last = None
        for batch in batches:
            files = pc.run_end_encode(batch.column(0)) if batch.num_rows else None
            at = 0
            for file, end in zip(files.values.to_pylist(), files.run_ends.to_pylist()) if files else ():
                if last not in (None, file):
                    yield rows(last, pa.array(ends))
                yield batch.slice(at, end - at)
                last, at = file, end
        if last is not None:
            yield rows(last, pa.array(ends))

    largest = list_files(spark, source).agg(F.max("length")).first()[0] or 1
    with session_setting(spark, "spark.sql.files.maxPartitionBytes", largest), session_setting(spark, "spark.sql.files.minPartitionNum", 1), month_writers(spark):
        lines = spark.read.option("lineSep", "\n").text(source).select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), "value")
        lines.mapInArrow(with_ends, "file string, value string").write.partitionBy("file").text(folder)


@_register
def read_raw_split(spark: SparkSession, folder: str) -> DataFrame:
    """Files with line breaks inside quoted fields, and a copy with a quote left open near its end, read to that line."""
    drop, torn = new_folder(spark, "csv"), new_folder(spark, "torn")
    raw = _dirty(spark, folder).withColumn("product_name", F.concat(F.lit('a "new'), F.lit("\n"), F.lit('line", '), F.trim("product_name")))
    write_csv(raw, drop)
    _write_torn(spark, drop, torn)
    whole = cleaning.parse_numbers(read_files(spark, drop)).select(*REQUIRED_COLUMNS, F.lit("whole").alias("files"))
    cut = cleaning.parse_numbers(read_files(spark, f"{torn}/*", on_open_quote="stop")).select(*REQUIRED_COLUMNS, F.lit("torn").alias("files"))
    return whole.unionByName(cut)


@_register
def read_mixed_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Files whose columns stand in different orders, one with a column more, read together by name."""
    drop, raw = new_folder(spark, "csv"), _dirty(spark, folder)
    orders = [REQUIRED_COLUMNS, list(reversed(REQUIRED_COLUMNS)), [*REQUIRED_COLUMNS[5:], "note", *REQUIRED_COLUMNS[:5]]]
    turn = F.pmod(F.xxhash64("order_id"), F.lit(len(orders)))
    keep_space = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    for i, columns in enumerate(orders):
        some = raw.where(turn == i).withColumn("note", F.lit("late")).select(*columns)
        some.write.mode("append").options(header="true", escape='"', **keep_space).csv(drop)
    return cleaning.parse_numbers(read_files(spark, drop, mixed_headers=True)).select(*REQUIRED_COLUMNS)


@_register
def load_projection(spark: SparkSession, folder: str) -> DataFrame:
    return project_for_load(_clean(spark, folder))


@_register
def append_load(spark: SparkSession, folder: str) -> DataFrame:
    """The transactions table after two overlapping batches."""
    warehouse = _loaded_in_two_batches(spark, folder, "batch")
    return _stored(warehouse, TRANSACTIONS).select(*LOAD_COLUMNS)


@_register
def load_new_orders_only(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of the second batch that the first one did not bring."""
    warehouse = _new_warehouse(spark)
    with joined_once(spark, folder) as raw:
        _load(warehouse, raw.where(_in_first_batch()), "first")
        batch = _cleaned(raw.where(_in_second_batch()))
        fresh = new_orders(batch, known_orders(warehouse.table(TRANSACTIONS), batch))
        return _kept(warehouse, project_for_load(fresh))


@_register
def load_key_index(spark: SparkSession, folder: str) -> DataFrame:
    """The transactions after two overlapping batches, stored orders looked up in the index of ids."""
    root = new_folder(spark, "mart")
    warehouse = Warehouse(spark, root, "mart_" + root.rsplit("-", 1)[-1], key_index={"shards": 16, "expected": 4_000_000})
    with joined_once(spark, folder) as raw:
        _load(warehouse, raw.where(_in_first_batch()), "first")
        _load(warehouse, raw.where(_in_second_batch()), "second", on_conflict="ignore")
    return _stored(warehouse, TRANSACTIONS).select(*LOAD_COLUMNS)


def _committed_in_two_batches(spark: SparkSession, folder: str, between: Callable[[VersionedMart, DataFrame], None] | None = None) -> VersionedMart:
    mart = VersionedMart(spark, new_folder(spark, "mart"))
    with joined_once(spark, folder) as raw:
        first, second = raw.where(_in_first_batch()), raw.where(_in_second_batch())
        ingest_atomic(mart, lambda: (first, [ISO_DATE]), "first", order_by=STAR_ORDER, near=STAR_NEAR)
        if between is not None:
            between(mart, second)
        ingest_atomic(mart, lambda: (second, [ISO_DATE]), "second", order_by=STAR_ORDER, near=STAR_NEAR, on_conflict="ignore")
    return mart


class _DyingMart(VersionedMart):
    """One whose runs die after all their writes and before the commit."""

    def _commit(self, change: Change) -> None:
        raise InterruptedError("killed")


@_register
def load_atomic(spark: SparkSession, folder: str) -> DataFrame:
    """The transactions after two batches, the second one tried once before by a run that died between its writes."""

    def dies_between_the_writes(mart: VersionedMart, batch: DataFrame) -> None:
        dying = _DyingMart(spark, mart.root)
        try:
            ingest_atomic(dying, lambda: (batch, [ISO_DATE]), "killed", order_by=STAR_ORDER, near=STAR_NEAR, on_conflict="ignore")
        except InterruptedError:
            pass

    return _committed_in_two_batches(spark, folder, dies_between_the_writes).table(TRANSACTIONS).select(*LOAD_COLUMNS)


@_register
def summary_delta(spark: SparkSession, folder: str) -> DataFrame:
    """The summary after two batches, each adding its own sums to the stored ones."""
    return _committed_in_two_batches(spark, folder).table(SUMMARY).drop("refreshed_at")


@_register
def summary_cancelled(spark: SparkSession, folder: str) -> DataFrame:
    """The summary after two batches and the cancellation of every order of one payment method or a whole month."""
    mart = _committed_in_two_batches(spark, folder)
    cancelled = mart.table(TRANSACTIONS).where("payment_method = '1-URGENT' OR order_year = 1997 AND order_month = 3")
    with mart.staging() as stage, mart.change() as change:
        mart.cancel(change, cancelled, stage)
    return mart.table(SUMMARY).drop("refreshed_at")


def _quarantined(spark: SparkSession, folder: str) -> Warehouse:
    warehouse = _new_warehouse(spark)
    with warehouse.staging() as stage:
        sound, _ = warehouse.quarantine(_stretched(_clean(spark, folder)), "run", stage)
        warehouse.load_transactions(sound)
    return warehouse


@_register
def load_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """The transactions of input of which many rows break a constraint and are set apart."""
    return _stored(_quarantined(spark, folder), TRANSACTIONS).select(*LOAD_COLUMNS)


@_register
def reject_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows set apart, with their reasons."""
    rejected = _stored(_quarantined(spark, folder), REJECTS)
    return rejected.select("order_id", "region", "order_date", F.array_join("reasons", ",").alias("reasons"))


def _spelt(raw: DataFrame, letter: str, tail: str = "") -> DataFrame:
    return raw.withColumn("order_id", F.concat(F.lit(letter), "order_id", F.lit(tail)))


@_register
def dedup_lenient(spark: SparkSession, folder: str) -> DataFrame:
    """First copies where ids that differ in case or trailing blanks are one, spelt as in the first copy."""
    odd = F.col("l_suppkey") % 2 == 1
    present = _present(spark, folder)
    spelt = present.withColumn("order_id", F.when(odd, F.concat(F.lit("é-"), "order_id", F.lit(" "))).otherwise(F.concat(F.lit("E-"), "order_id")))
    return cleaning.keep_first(spelt, STAR_ORDER, lenient=True, near=STAR_NEAR).select("order_id", "quantity", "unit_price")


@_register
def load_lenient_conflict(spark: SparkSession, folder: str) -> DataFrame:
    """Two overlapping batches whose ids differ in case: a store that ignores it has the orders of the first already."""
    warehouse = _new_warehouse(spark)
    with joined_once(spark, folder) as raw, warehouse.staging() as stage:
        for some, letter, tail in ((_in_first_batch(), "a", ""), (_in_second_batch(), "A", " ")):
            batch = stage(_cleaned(_spelt(raw.where(some), letter, tail)).select(*LOAD_COLUMNS), "batch")
            warehouse.load_transactions(batch, on_conflict="ignore", lenient=True)
    return _stored(warehouse, TRANSACTIONS).select(*LOAD_COLUMNS)


@_register
def summary_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The summary after two batches, the second replacing the months and regions it has."""
    warehouse = _loaded_in_two_batches(spark, folder, "batch")
    return _stored(warehouse, SUMMARY).drop("refreshed_at")


@_register
def summary_recompute(spark: SparkSession, folder: str) -> DataFrame:
    """The summary after two batches, the months they touch totalled from the transactions."""
    warehouse = _loaded_in_two_batches(spark, folder, "recompute")
    return _stored(warehouse, SUMMARY).drop("refreshed_at")


@_register
def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """What the log says of the two runs; run ids and times differ from run to run."""
    warehouse = _loaded_in_two_batches(spark, folder, "batch")
    counts = ["rows_read", "rows_cleaned", "rows_rejected", "rows_loaded"]
    return _stored(warehouse, RUN_LOG).select("source_file", *counts, "status", "error_message")


@_register
def param_query(spark: SparkSession, folder: str) -> DataFrame:
    """A query text with named parameters over the loaded tables."""
    warehouse = _new_warehouse(spark)
    _load(warehouse, raw_sales(spark, folder), "all")
    paid = warehouse.run_query(
        f"""
        SELECT payment_method, COUNT(*) AS orders, CAST(AVG(CAST(quantity AS DOUBLE)) AS DECIMAL(12, 4)) AS mean_quantity,
               SUM(total_amount) AS paid
        FROM {TRANSACTIONS}
        WHERE order_date BETWEEN :since AND :until AND discount < :below
        GROUP BY payment_method
        """,
        {"since": date(1997, 3, 1), "until": date(1998, 8, 31), "below": 0.05},
    )
    return _kept(warehouse, paid)


def _stretched(clean: DataFrame) -> DataFrame:
    """Clean rows of which some outgrow what the tables admit, by rules on the quantity."""

    def some(n: int) -> Column:
        return F.col("quantity").cast("bigint") % n == 0

    longer = {name: F.when(some(n), F.repeat(name, 60)).otherwise(F.col(name)) for name, n in STRETCHED.items()}
    return clean.withColumns(
        {
            **longer,
            "unit_price": F.when(some(11), F.col("unit_price") * 1e6).otherwise(F.col("unit_price")),
            "total_amount": F.when(some(13), F.col("total_amount").cast("double") * 1e9).otherwise(
                F.col("total_amount").cast("double")
            ),
            "quantity": F.when(some(17), F.col("quantity") * 1e9).otherwise(F.col("quantity")),
        }
    )


@_register
def constraint_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per broken rule of the transactions table, over input that breaks most of them."""
    return count_violations(_stretched(_clean(spark, folder)))


@_register
def summary_constraints(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per broken rule of the summary: some keys twice, some regions missing or overlong."""
    totals = aggregates.monthly_totals(_clean(spark, folder))
    month = F.col("order_month")
    region = F.when(month == 4, F.lit(None)).when(month == 6, F.repeat("region", 60)).otherwise(F.col("region"))
    return summary_violations(totals.unionByName(totals.where(month % 5 == 0)).withColumn("region", region))


@_register
def load_replace(spark: SparkSession, folder: str) -> DataFrame:
    """A table of one layout replaced by one of another."""
    warehouse = _new_warehouse(spark)
    with warehouse.staging() as stage:
        clean = stage(_clean(spark, folder).select("order_id", "region", "payment_method", "order_year"), "clean")
        warehouse.load_dataframe(clean.select("order_id", "region"), "orders_by_method")
        by_method = clean.groupBy("payment_method", "order_year").agg(F.count("order_id").alias("orders"))
        warehouse.load_dataframe(by_method, "orders_by_method", if_exists="replace")
    return _stored(warehouse, "orders_by_method")


# -- cleaning ---------------------------------------------------------------------------------


@_register
def normalize_text(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.normalize_text(_dirty(spark, folder)).select("order_id", *TEXT_COLUMNS)


@_register
def title_case_region(spark: SparkSession, folder: str) -> DataFrame:
    raw = _dirty(spark, folder)
    return raw.select("order_id", "region", title_case(strip_space(F.col("region"))).alias("region_title"))


@_register
def parse_dates(spark: SparkSession, folder: str) -> DataFrame:
    raw = _dirty(spark, folder).withColumn("date_text", F.col("order_date"))
    return cleaning.parse_dates(raw).select("order_id", "date_text", "order_date")


def _present(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.drop_missing(cleaning.conform(_dirty(spark, folder)))


def _first_copies(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.keep_first(_present(spark, folder), STAR_ORDER, near=STAR_NEAR)


@_register
def drop_missing(spark: SparkSession, folder: str) -> DataFrame:
    return _present(spark, folder).select("order_id", "order_date", "customer_name", "unit_price")


@_register
def dedup_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    return _first_copies(spark, folder).select("order_id", "quantity", "unit_price", "discount", "product_name")


@_register
def filter_bad_quantity(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.drop_bad_quantity(_first_copies(spark, folder)).select("order_id", "quantity")


@_register
def filter_bad_price(spark: SparkSession, folder: str) -> DataFrame:
    good_quantity = cleaning.drop_bad_quantity(_first_copies(spark, folder))
    return cleaning.drop_bad_price(good_quantity).select("order_id", "quantity", "unit_price")


@_register
def discount_clip(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clip_discount(_dirty(spark, folder)).select("order_id", "discount")


@_register
def total_amount(spark: SparkSession, folder: str) -> DataFrame:
    return _clean(spark, folder).select("order_id", "quantity", "unit_price", "discount", "total_amount")


@_register
def date_parts(spark: SparkSession, folder: str) -> DataFrame:
    text = F.date_format("order_date", "yyyy-MM-dd").alias("date_text")
    return _clean(spark, folder).select("order_id", "order_date", text, "order_year", "order_month")


@_register
def cleaning_stats(spark: SparkSession, folder: str) -> DataFrame:
    needed = ["order_id", "quantity", "unit_price"]
    return stage_counts(dispose_rows(_dirty(spark, folder), STAR_ORDER, carry=needed, near=STAR_NEAR))


@_register
def clean_sales(spark: SparkSession, folder: str) -> DataFrame:
    return _clean(spark, folder).select(*LOAD_COLUMNS)


# -- aggregates -------------------------------------------------------------------------------


@_register
def agg_by_region(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.aggregate_by_region(_clean(spark, folder))


@_register
def agg_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.aggregate_by_category(_clean(spark, folder))


@_register
def top_products(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.top_products(_clean(spark, folder), 10)


@_register
def monthly_trend(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.monthly_trend(_clean(spark, folder))


@_register
def monthly_region_summary(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.monthly_region_summary(_clean(spark, folder))


@_register
def agg_all(spark: SparkSession, folder: str) -> DataFrame:
    """The totals of all report frames from one scan and one shuffle."""
    return aggregates.all_totals(_clean(spark, folder))


# -- reports ----------------------------------------------------------------------------------


@_register
def report_by_region(spark: SparkSession, folder: str) -> DataFrame:
    return reports.revenue_by_region(_summary(spark, folder))


@_register
def report_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return reports.revenue_by_category(_transactions(spark, folder))


@_register
def report_top_products(spark: SparkSession, folder: str) -> DataFrame:
    return reports.best_products(_transactions(spark, folder), 10)


@_register
def report_monthly_trend(spark: SparkSession, folder: str) -> DataFrame:
    return reports.revenue_by_month(_summary(spark, folder))


@_register
def report_headline(spark: SparkSession, folder: str) -> DataFrame:
    return reports.headline(_summary(spark, folder))


@_register
def series_region(spark: SparkSession, folder: str) -> DataFrame:
    return reports.region_series(_summary(spark, folder))


@_register
def series_trend(spark: SparkSession, folder: str) -> DataFrame:
    return reports.month_series(_summary(spark, folder))


@_register
def adhoc_region(spark: SparkSession, folder: str) -> DataFrame:
    return reports.region_revenue_from_rows(_transactions(spark, folder))


@_register
def adhoc_top_products(spark: SparkSession, folder: str) -> DataFrame:
    return reports.best_products_from_rows(_transactions(spark, folder), 10)


@_register
def adhoc_monthly_trend(spark: SparkSession, folder: str) -> DataFrame:
    return reports.month_revenue_from_rows(_transactions(spark, folder))


@_register
def report_labels(spark: SparkSession, folder: str) -> DataFrame:
    """The category sheet as exported: loaded, reported, written and read back."""
    warehouse = _new_warehouse(spark)
    _load(warehouse, raw_sales(spark, folder), "all")
    written = reports.write_report_marts(warehouse, new_folder(spark, "reports"), fmt="parquet")
    warehouse.drop()
    return spark.read.parquet(written["by_category"])


# -- pipelines --------------------------------------------------------------------------------


@_register
def pipeline_run(spark: SparkSession, folder: str) -> DataFrame:
    """CSV files through the whole pipeline; the stored transactions."""
    drop = new_folder(spark, "csv")
    write_csv(raw_sales(spark, folder), drop)
    warehouse = _new_warehouse(spark)
    run_pipeline(warehouse, drop)
    return _stored(warehouse, TRANSACTIONS).select(*LOAD_COLUMNS)


@_register
def incremental_run(spark: SparkSession, folder: str) -> DataFrame:
    """Two deliveries of CSV files through the file stream; the summary over the stored rows."""
    drop = new_folder(spark, "drop")
    warehouse = _new_warehouse(spark)
    with joined_once(spark, folder) as raw:
        for delivery in (_in_first_batch(), _in_second_batch()):
            write_csv(raw.where(delivery), drop, mode="append")
            run_incremental(warehouse, drop)
    return _stored(warehouse, SUMMARY).drop("refreshed_at")


@_register
def incremental_redelivery(spark: SparkSession, folder: str) -> DataFrame:
    """A delivery, then the folder written anew with all rows, then nothing new; the stored transactions."""
    drop = new_folder(spark, "drop")
    warehouse = _new_warehouse(spark)
    with joined_once(spark, folder) as raw:
        write_csv(raw.where(_in_first_batch()), drop)
        run_incremental(warehouse, drop)
        write_csv(raw, drop, mode="overwrite")
    for _ in range(2):
        run_incremental(warehouse, drop)
    return _stored(warehouse, TRANSACTIONS).select(*LOAD_COLUMNS)


def _by_function(spark: SparkSession, folder: str, query: str, params: dict) -> DataFrame:
    warehouse = _new_warehouse(spark)
    _load(warehouse, raw_sales(spark, folder), "all")
    warehouse.create_report_functions()
    return _kept(warehouse, warehouse.run_query(query, params))


@_register
def sql_top_products(spark: SparkSession, folder: str) -> DataFrame:
    """The best products by a SQL function that returns a table."""
    return _by_function(spark, folder, "SELECT * FROM sql_top_products(:n)", {"n": 12})


@_register
def sql_region_share(spark: SparkSession, folder: str) -> DataFrame:
    """Each region's share of the revenue of a period, by a SQL function that returns a table."""
    period = {"since": date(1997, 1, 1), "until": date(1998, 6, 30)}
    return _by_function(spark, folder, "SELECT * FROM sql_region_share(:since, :until)", period)


def _sheet(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        """A report sheet as exported: loaded, reported, written and read back."""
        warehouse = _new_warehouse(spark)
        _load(warehouse, raw_sales(spark, folder), "all")
        written = reports.write_report_marts(warehouse, new_folder(spark, "reports"), fmt="parquet")
        warehouse.drop()
        return spark.read.parquet(written[name])

    query.__name__ = f"report_sheet_{name}"
    return query


for _name in ("summary", "by_region", "top_products", "monthly_trend", "chart_revenue_by_region", "chart_monthly_revenue"):
    _register(_sheet(_name))
