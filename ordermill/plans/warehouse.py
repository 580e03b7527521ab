"""The stored tables: transactions, monthly region summary and run log.

They are catalog tables over parquet, the first two partitioned by year and month.  Parquet has no
unique keys and no transactions, so the jobs here check keys with semi joins, write every batch to a
staging table before touching a target, and change targets last.  One writer at a time.
"""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager, nullcontext
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordermill.operators.aggregates import monthly_totals
from ordermill.operators.cleaning import keep_first, order_key
from ordermill.operators.constraints import BatchProfile, ConstraintError, check_constraints, check_summary
from ordermill.operators.quarantine import BROKEN, mark_broken, rejected_rows, sound_rows
from ordermill.plans.key_index import STEPS, KeyIndex
from ordermill.plans.scratch import month_writers, scratch_root, session_setting
from ordermill.schemas import (
    LOAD_COLUMNS,
    MONTH_KEYS,
    REJECTS,
    REJECTS_SCHEMA,
    SUMMARY,
    SUMMARY_SCHEMA,
    TABLE_PARTITIONS,
    TABLE_SCHEMAS,
    TRANSACTIONS,
    TRANSACTIONS_SCHEMA,
)

SUMMARY_KEYS = [*MONTH_KEYS, "region"]
SUMMARY_MEASURES = ["total_orders", "total_quantity", "total_revenue", "avg_order_value"]


# Arguments, result columns and query of each report function.
REPORT_FUNCTIONS = {
    "sql_top_products": (
        "n INT",
        "product_name STRING, units_sold BIGINT, total_revenue DECIMAL(22, 2)",
        """SELECT product_name, units_sold, total_revenue FROM (
             SELECT product_name, SUM(quantity) AS units_sold, SUM(total_amount) AS total_revenue,
                    ROW_NUMBER() OVER (ORDER BY SUM(total_amount) DESC, product_name) AS place
             FROM {transactions} WHERE product_name IS NOT NULL GROUP BY product_name)
           WHERE place <= sql_top_products.n""",
    ),
    "sql_region_share": (
        "since DATE, until DATE",
        "region STRING, revenue DECIMAL(22, 2), share DECIMAL(7, 4)",
        """SELECT region, revenue,
                  CAST(CAST(revenue AS DOUBLE) / CAST(SUM(revenue) OVER () AS DOUBLE) AS DECIMAL(7, 4)) AS share
           FROM (SELECT region, SUM(total_amount) AS revenue FROM {transactions}
                 WHERE order_date BETWEEN sql_region_share.since AND sql_region_share.until GROUP BY region)""",
    ),
}


class DuplicateOrderError(ValueError):
    """A batch holds an order the transactions table already has."""


def load_projection(df: DataFrame) -> DataFrame:
    """The loaded columns in table order and stored types; other columns are dropped.

    Quantity is rounded, as a plain cast would cut it; an absent discount is stored as 0.
    """
    stored = {field.name: field.dataType for field in TRANSACTIONS_SCHEMA.fields}
    values = {name: F.col(name) for name in LOAD_COLUMNS}
    values["quantity"] = F.round(F.col("quantity"))
    values["discount"] = F.coalesce(F.col("discount"), F.lit(0))
    return df.select(*[values[name].cast(stored[name]).alias(name) for name in LOAD_COLUMNS])


def summary_projection(df: DataFrame) -> DataFrame:
    """Summary keys and measures in stored types."""
    stored = {field.name: field.dataType for field in SUMMARY_SCHEMA.fields}
    values = {name: F.col(name) for name in [*SUMMARY_KEYS, *SUMMARY_MEASURES]}
    values["total_quantity"] = F.round(F.col("total_quantity"))
    return df.select(*[value.cast(stored[name]).alias(name) for name, value in values.items()])


def known_orders(
    stored: DataFrame, batch: DataFrame, low_id: str | None = None, high_id: str | None = None, lenient: bool = False
) -> DataFrame:
    """Ids of the batch that the stored rows already have; with ``lenient`` as a store without regard to case has them.

    The batch is on the right, so a batch under the broadcast threshold is sent to the stored rows
    and these, the large side, are not shuffled.  The range of batch ids, where the caller knows it,
    goes to the parquet scan; it says nothing of ids that differ in case.
    """
    if lenient:
        ids = batch.select(order_key(True).alias("_key"))
        return stored.select("order_id").join(ids, order_key(True) == F.col("_key"), "left_semi")
    if low_id is not None and high_id is not None:
        stored = stored.where(F.col("order_id").between(low_id, high_id))
    return stored.select("order_id").join(batch.select("order_id"), "order_id", "left_semi")


def new_orders(batch: DataFrame, known: DataFrame, lenient: bool = False) -> DataFrame:
    """The batch without the orders already known."""
    if lenient:
        stored = known.select(order_key(True).alias("_key"))
        return batch.join(stored, order_key(True) == F.col("_key"), "left_anti")
    return batch.join(known, "order_id", "left_anti")


def merge_summary(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of both; where both have a key the batch's measures win.

    ``refreshed_at`` moves only on rows that are new or whose measures changed.
    """
    old, new = current.alias("old"), batch.withColumn("_new", F.lit(True)).alias("new")
    joined = old.join(new, SUMMARY_KEYS, "full_outer")
    is_new = F.col("new._new").isNotNull()
    same = reduce(
        lambda left, right: left & right,
        [F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}")) for name in SUMMARY_MEASURES],
    )
    unchanged = F.col("old.refreshed_at").isNotNull() & (~is_new | same)
    return joined.select(
        *SUMMARY_KEYS,
        *[F.when(is_new, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name) for name in SUMMARY_MEASURES],
        F.when(unchanged, F.col("old.refreshed_at")).otherwise(F.current_timestamp()).alias("refreshed_at"),
    )


class Warehouse:
    """The three tables under one folder, as a catalog database.

    A database of this name whose tables lie elsewhere is refused.  With ``key_index`` (options of ``KeyIndex``)
    loads look for stored orders in an index of ids and not in the transactions; a warehouse that has one must be
    opened so each time.
    """

    def __init__(self, spark: SparkSession, root: str, database: str = "order_mart", key_index: dict | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database
        self.create_tables()
        if key_index is None and spark.catalog.tableExists(self._name(STEPS)):
            raise ValueError(f"{database} has a key index; open it with key_index={{}}")
        self.keys = None if key_index is None else KeyIndex(self, **key_index)

    def _name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    @contextmanager
    def _in_database(self):
        before = self.spark.catalog.currentDatabase()
        self.spark.catalog.setCurrentDatabase(self.database)
        try:
            yield
        finally:
            self.spark.catalog.setCurrentDatabase(before)

    @contextmanager
    def _overwrite_mode(self, mode: str):
        """``dynamic``: an overwrite replaces the partitions it has rows for; ``static``: the table."""
        with session_setting(self.spark, "spark.sql.sources.partitionOverwriteMode", mode):
            yield

    # -- definition ---------------------------------------------------------------------------

    def create_tables(self) -> None:
        """Create what is absent; data already in the folder is kept and its partitions are found."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
        for table, schema in TABLE_SCHEMAS.items():
            self.create_table(table, schema, TABLE_PARTITIONS[table])

    def create_table(self, table: str, schema: StructType, keys: list[str]) -> None:
        """A table in the folder, if it is absent; one of this name elsewhere is an error."""
        if self.spark.catalog.tableExists(self._name(table)):
            found = self._location(table)
            if found != _plain_path(f"{self.root}/{table}"):
                raise ValueError(f"{self._name(table)} lies in {found}, not in {self.root}; give the database another name")
            return
        columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schema.fields)
        empty = self.spark.createDataFrame([], schema)
        empty.write.mode("ignore").partitionBy(*keys).parquet(f"{self.root}/{table}")
        partitioned = f"PARTITIONED BY ({', '.join(keys)})" if keys else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._name(table)} ({columns}) USING parquet "
            f"{partitioned} LOCATION '{self.root}/{table}'"
        )
        if keys:
            self.spark.catalog.recoverPartitions(self._name(table))

    def _location(self, table: str) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self._name(table)}").where("col_name = 'Location'")
        return _plain_path(rows.first()["data_type"])

    def drop(self) -> None:
        """Forget the tables and the database.  The tables have paths of their own, so their files stay."""
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}` CASCADE")
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}_staging` CASCADE")

    def ready(self) -> bool:
        """True when all three tables exist with the declared columns."""
        for table, schema in TABLE_SCHEMAS.items():
            if not self.spark.catalog.tableExists(self._name(table)):
                return False
            found = {field.name: field.dataType for field in self.table(table).schema.fields}
            if found != {field.name: field.dataType for field in schema.fields}:
                return False
        return True

    # -- reading and statements ---------------------------------------------------------------

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self._name(name))

    def run_query(self, query: str, params: dict[str, Any] | None = None) -> DataFrame:
        """A SELECT over the tables, with named parameters written ``:name``."""
        with self._in_database():
            return self.spark.sql(query, args=params or {})

    def execute(self, statement: str, params: dict[str, Any] | None = None) -> None:
        """A statement without a result."""
        with self._in_database():
            self.spark.sql(statement, args=params or {})

    def create_report_functions(self) -> None:
        """Reports as SQL functions of the database that return tables, for use in any query text.

        ``sql_top_products(n)`` and ``sql_region_share(since, until)``; arguments are parameters, not text.
        """
        for name, (arguments, columns, body) in REPORT_FUNCTIONS.items():
            query = body.format(transactions=self._name(TRANSACTIONS))
            self.spark.sql(f"CREATE OR REPLACE FUNCTION `{self.database}`.{name}({arguments}) RETURNS TABLE({columns}) RETURN {query}")

    # -- staging ------------------------------------------------------------------------------

    @contextmanager
    def staging(self):
        """Hands out a function that writes a frame to the shared scratch folder and reads it back.

        What follows, retries included, starts from the written table.  All are dropped at the end.
        """
        database = f"{self.database}_staging"
        folder = f"{scratch_root(self.spark)}/{database}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{folder}'")
        written = []

        def stage(df: DataFrame, purpose: str) -> DataFrame:
            written.append(name := f"`{database}`.`{purpose}_{uuid.uuid4().hex}`")
            df.write.format("parquet").saveAsTable(name)
            return self.spark.table(name)

        try:
            yield stage
        finally:
            for name in written:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    # -- loading ------------------------------------------------------------------------------

    def load_transactions(self, batch: DataFrame, on_conflict: str = "error", lenient: bool = False) -> int:
        """Append clean rows with distinct order ids; returns how many were added.

        ``on_conflict="error"`` refuses the whole batch when one order is already stored,
        ``"ignore"`` adds the others.  With ``lenient`` ids are one as they are to a store that ignores case, within the
        batch too (the first by spelling stays).  The batch is read more than once, so stage it.
        """
        if on_conflict not in ("error", "ignore"):
            raise ValueError(f"on_conflict must be 'error' or 'ignore', not {on_conflict!r}")
        if lenient and self.keys is not None:
            raise ValueError("the key index compares ids exactly")
        if lenient:
            return self._load_lenient(batch, on_conflict)
        profile = check_constraints(batch)
        if not profile.rows:
            return 0
        with self.staging() as stage:
            known = self._stored_ids(batch, profile, stage)
            conflicts = known.count()
            if conflicts and on_conflict == "error":
                some = [row.order_id for row in known.limit(5).collect()]
                raise DuplicateOrderError(f"{conflicts} orders are already stored, for example {some}")
            fresh = new_orders(batch, known) if conflicts else batch
            with self._followed(fresh):
                self.append(load_projection(fresh).withColumn("loaded_at", F.current_timestamp()), TRANSACTIONS)
        return profile.rows - conflicts

    def _load_lenient(self, batch: DataFrame, on_conflict: str) -> int:
        profile = check_constraints(batch)
        with self.staging() as stage:
            known = stage(known_orders(self.table(TRANSACTIONS), batch, lenient=True), "known")
            distinct = keep_first(batch.select(*LOAD_COLUMNS), ["order_id"], lenient=True)
            fresh = stage(distinct if known.isEmpty() else new_orders(distinct, known, lenient=True), "fresh")
            added = fresh.count()
            if added < profile.rows and on_conflict == "error":
                raise DuplicateOrderError(f"{profile.rows - added} orders differ from others only as the store does not see")
            if added:
                self.append(load_projection(fresh).withColumn("loaded_at", F.current_timestamp()), TRANSACTIONS)
        return added

    def quarantine(self, batch: DataFrame, run_id: str, stage) -> tuple[DataFrame, int]:
        """The rows that the transactions table may hold, and how many others went to the table of rejects.

        One pass marks every row with the rules it breaks; both sides are read from the marked rows.
        """
        marked = stage(mark_broken(batch.select(*LOAD_COLUMNS)), "marked")
        refused = marked.where(F.col(BROKEN) != 0).count()
        if refused:
            self.create_table(REJECTS, REJECTS_SCHEMA, [])
            self.append(rejected_rows(marked, run_id), REJECTS)
        return sound_rows(marked), refused

    def _stored_ids(self, batch: DataFrame, profile: BatchProfile, stage) -> DataFrame:
        """Ids of the batch that are stored, staged."""
        if self.keys is None:
            return stage(known_orders(self.table(TRANSACTIONS), batch, profile.low_id, profile.high_id), "known")
        self.keys.ready()
        suspects = stage(self.keys.suspects(batch.select("order_id")), "suspects")
        return stage(self.keys.known(suspects), "known")

    def _followed(self, fresh: DataFrame):
        return nullcontext() if self.keys is None else self.keys.following(fresh.select("order_id"))

    def load_dataframe(self, df: DataFrame, table: str, if_exists: str = "append") -> int:
        """Write any frame to a table: ``append``, ``replace``, or ``fail`` when the table exists.

        Rows for the transactions and the summary are held to the table's constraints and unique key.  ``append``
        refuses columns the table lacks; ``replace`` makes the table anew where the frame's columns are others.
        """
        if if_exists not in ("append", "replace", "fail"):
            raise ValueError(f"if_exists must be 'append', 'replace' or 'fail', not {if_exists!r}")
        exists = self.spark.catalog.tableExists(self._name(table))
        if exists and if_exists == "fail":
            raise ValueError(f"table {table} already exists")
        if exists and if_exists == "append":
            self._refuse_unknown(df, table)
        with self.staging() as stage:
            staged = stage(df, "load")
            rows = staged.count()
            if not exists or if_exists == "replace" and not self._fits(df, table):
                self._make_anew(staged, table)
            elif table == TRANSACTIONS:
                self._load_orders(staged, append=if_exists == "append")
            elif table == SUMMARY:
                self._load_summary(staged, append=if_exists == "append")
            else:
                self.append(staged, table, overwrite=if_exists == "replace")
        return rows

    def _refuse_unknown(self, df: DataFrame, table: str) -> None:
        unknown = sorted(set(df.columns) - set(self.table(table).columns))
        if unknown:
            raise ValueError(f"table {table} has no columns {unknown}")

    def _fits(self, df: DataFrame, table: str) -> bool:
        """Whether the frame has the table's columns, but for those the load fills in."""
        wanted = {name for name in self.table(table).columns if name not in ("loaded_at", "refreshed_at")}
        return wanted <= set(df.columns) <= set(self.table(table).columns)

    def _make_anew(self, staged: DataFrame, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name(table)}")
        path = f"{self.root}/{table}"
        staged.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(self._name(table))

    def _load_orders(self, staged: DataFrame, append: bool) -> None:
        repeated = staged.groupBy("order_id").count().where("count > 1").count()
        if repeated:
            raise DuplicateOrderError(f"{repeated} orders occur more than once in the batch")
        if append:
            self.load_transactions(staged)
            return
        check_constraints(staged)
        self.append(load_projection(staged).withColumn("loaded_at", F.current_timestamp()), TRANSACTIONS, overwrite=True)
        if self.keys is not None:
            self.keys.rebuild()

    def _load_summary(self, staged: DataFrame, append: bool) -> None:
        check_summary(staged)
        if append:
            stored = self.table(SUMMARY).join(staged.select(*SUMMARY_KEYS), SUMMARY_KEYS, "left_semi").count()
            if stored:
                raise ConstraintError(f"{stored} keys of the summary are already stored")
        rows = summary_projection(staged).withColumn("refreshed_at", F.current_timestamp())
        self.append(rows, SUMMARY, overwrite=not append)

    def append(self, df: DataFrame, table: str, overwrite: bool = False) -> None:
        """Insert by column name.

        Transactions are written from where they are (``month_writers``); rows of the small tables are brought together by
        partition first.
        """
        self._refuse_unknown(df, table)
        keys = TABLE_PARTITIONS.get(table, [])
        ordered = df.select(*self.table(table).columns)
        if keys and table != TRANSACTIONS:
            ordered = ordered.hint("rebalance", *keys)
        with self._overwrite_mode("static"), month_writers(self.spark):
            ordered.write.insertInto(self._name(table), overwrite=overwrite)

    # -- summary ------------------------------------------------------------------------------

    def _in_months_of(self, df: DataFrame, months: DataFrame) -> DataFrame:
        """Rows of ``df`` in the given months, as a filter on its partition columns.

        There are twelve months to a year and the dates that cleaning admits span 585 years, so the months'
        numbers are at most 7,020, whatever the batch holds.
        """
        by_year: dict[int, list[int]] = {}
        for year, month in months.select(*MONTH_KEYS).distinct().collect():
            by_year.setdefault(year, []).append(month)
        return df.where(_month_filter(by_year))

    def upsert_monthly_summary(self, summary: DataFrame) -> int:
        """Insert summary rows, or overwrite the measures of those whose month and region are stored.

        Only the partitions of the months in the batch are rewritten.  Returns the batch's row count.
        """
        with self.staging() as stage:
            batch = stage(summary_projection(summary), "summary")
            check_summary(batch)
            rows = batch.count()
            if rows:
                current = self._in_months_of(self.table(SUMMARY), batch)
                merged = merge_summary(current, batch)
                ordered = merged.select(*self.table(SUMMARY).columns).hint("rebalance", *MONTH_KEYS)
                with self._overwrite_mode("dynamic"):
                    ordered.write.insertInto(self._name(SUMMARY), overwrite=True)
        return rows

    def refresh_summary(self, batch: DataFrame, refresh: str = "batch") -> int:
        """Bring the summary up to date after a load.

        ``"batch"`` stores the totals of this batch alone, so a second file of a month replaces the
        first one's totals.  ``"recompute"`` totals the stored transactions of the months touched.
        """
        if refresh == "batch":
            return self.upsert_monthly_summary(monthly_totals(batch))
        if refresh == "recompute":
            rows = self._in_months_of(self.table(TRANSACTIONS), batch)
            return self.upsert_monthly_summary(monthly_totals(rows))
        raise ValueError(f"refresh must be 'batch' or 'recompute', not {refresh!r}")


def _plain_path(path: str) -> str:
    """A path in one spelling: local ones without their scheme, without a slash at the end."""
    return re.sub(r"^file:/+", "/", path).rstrip("/")


def _month_filter(by_year: dict[int, list[int]]) -> Column:
    if not by_year:
        return F.lit(False)
    return reduce(
        or_,
        [(F.col("order_year") == year) & F.col("order_month").isin(sorted(months)) for year, months in by_year.items()],
    )
