"""A mart whose runs become visible all at once or not at all.

Every write goes to a folder of its own (``load=...``) that nobody reads yet.  A run ends with one commit record: a single
small file that says which folders it adds to each table and which months it replaces.  Readers resolve the tables from
the records, so a run that dies anywhere before its record leaves the old state, and one that dies after it the
new one; there is no moment at which rows, summary and log disagree.  Older versions stay readable until ``vacuum``.

One writer at a time.  What comes to the driver is the commit records: a row per run and table.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.operators.cleaning import validate_schema
from ordermill.operators.constraints import check_constraints, check_log_row
from ordermill.operators.deltas import SUMMED, apply_deltas, monthly_deltas
from ordermill.operators.disposition import count_dispositions, dispose_rows, kept_rows, with_derived
from ordermill.plans.scratch import month_writers, new_folder, remove_folder
from ordermill.plans.warehouse import DuplicateOrderError, known_orders, load_projection, new_orders
from ordermill.schemas import MONTH_KEYS, RUN_LOG, RUN_LOG_SCHEMA, SUMMARY, TABLE_PARTITIONS, TABLE_SCHEMAS, TRANSACTIONS
from ordermill.sources import SOURCE_ORDER

logger = logging.getLogger(__name__)

COMMITS = "_commits"
ADD, REPLACE = "ADD", "REPLACE"

_MONTHS = T.ArrayType(T.StructType([T.StructField(key, T.IntegerType()) for key in MONTH_KEYS]))
COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("load", T.StringType()),
        T.StructField("months", _MONTHS),  # that are replaced
        T.StructField("filled", _MONTHS),  # that the load has rows of
    ]
)

Month = tuple[int, int]
WHOLE: Month = (0, 0)  # in place of a month for tables without partitions


class Change:
    """What a run will commit."""

    def __init__(self, mart: VersionedMart, run_id: str):
        self.mart, self.run_id = mart, run_id
        self.records: list[tuple] = []

    def add(self, table: str, rows: DataFrame) -> DataFrame:
        """More rows of a table; returns them as they were written."""
        return self._write(table, ADD, rows, [])

    def replace(self, table: str, rows: DataFrame, months: list[Month]) -> None:
        """All rows that a table will have in ``months``; those without any are emptied."""
        self._write(table, REPLACE, rows, sorted(months))

    def _write(self, table: str, kind: str, rows: DataFrame, months: list[Month]) -> DataFrame:
        load, keys = uuid.uuid4().hex, TABLE_PARTITIONS[table]
        ordered = rows.select(*TABLE_SCHEMAS[table].names)
        path = f"{self.mart.root}/{table}/load={load}"
        if keys:
            with month_writers(self.mart.spark):
                ordered.write.partitionBy(*keys).parquet(path)
            written = self.mart.spark.read.schema(TABLE_SCHEMAS[table]).parquet(path)
            filled = sorted(tuple(row) for row in written.select(*keys).distinct().collect())
            if not set(filled) <= set(months) and kind == REPLACE:
                raise ValueError(f"rows outside the months to be replaced: {sorted(set(filled) - set(months))}")
        else:
            ordered.write.parquet(path)
            written, filled = self.mart.spark.read.schema(TABLE_SCHEMAS[table]).parquet(path), [WHOLE]
        self.records.append((table, kind, load, months, filled))
        return written


class VersionedMart:
    """The three tables under one folder, resolved from commit records."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        empty = spark.createDataFrame([], COMMIT_SCHEMA)
        empty.write.mode("ignore").parquet(f"{self.root}/{COMMITS}")

    # -- reading ------------------------------------------------------------------------------

    def _records(self) -> list:
        commits = self.spark.read.schema(COMMIT_SCHEMA).parquet(f"{self.root}/{COMMITS}")
        return commits.orderBy("version").collect()

    def version(self) -> int:
        """The number of the last commit, 0 before the first."""
        return max((record.version for record in self._records()), default=0)

    def _loads(self, table: str, version: int | None) -> dict[Month, list[str]]:
        """The loads that hold a table's rows, by month."""
        state: dict[Month, list[str]] = {}
        for record in self._records():
            if record.table == table and (version is None or record.version <= version):
                for month in record.months:
                    state[tuple(month)] = []
                for month in record.filled:
                    state.setdefault(tuple(month), []).append(record.load)
        return state

    def table(self, name: str, version: int | None = None, months: list[Month] | None = None) -> DataFrame:
        """A table as the last commit left it, or that of ``version``; only ``months`` where given."""
        schema, keys, base = TABLE_SCHEMAS[name], TABLE_PARTITIONS[name], f"{self.root}/{name}"
        paths = []
        for month, loads in self._loads(name, version).items():
            if months is None or month in months:
                below = "".join(f"/{key}={value}" for key, value in zip(keys, month))
                paths += [f"{base}/load={load}{below}" for load in loads]
        if not paths:
            return self.spark.createDataFrame([], schema)
        whole = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
        return self.spark.read.schema(whole).option("basePath", base).parquet(*sorted(paths)).select(*schema.names)

    # -- writing ------------------------------------------------------------------------------

    @contextmanager
    def change(self, run_id: str | None = None) -> Iterator[Change]:
        """A block whose writes become visible at its end, all at once; none do if it raises."""
        change = Change(self, run_id or uuid.uuid4().hex)
        yield change
        if change.records:
            self._commit(change)

    def _commit(self, change: Change) -> None:
        number = self.version() + 1
        rows = [(number, change.run_id, *record) for record in change.records]
        one_file = self.spark.createDataFrame(rows, COMMIT_SCHEMA).coalesce(1)
        one_file.write.mode("append").parquet(f"{self.root}/{COMMITS}")

    def compact(self, table: str) -> int:
        """Rewrites the months that several loads hold, each as one; returns how many there were."""
        state = self._loads(table, None)
        several = [month for month, loads in state.items() if len(loads) > 1]
        if several:
            if not TABLE_PARTITIONS[table]:
                several = [WHOLE]
            with self.change() as change:
                change.replace(table, _by_month(table, self.table(table, months=several)), several)
        return len(several)

    def vacuum(self) -> list[str]:
        """Removes folders of runs that never committed, or that no table reads any more; returns their names.

        Older versions are not readable after it.  Not to be called while a run is writing.
        """
        gone = []
        for table in TABLE_SCHEMAS:
            used = {load for loads in self._loads(table, None).values() for load in loads}
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}")
            store = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for entry in store.listStatus(folder) if store.exists(folder) else []:
                name = entry.getPath().getName()
                if name.removeprefix("load=") not in used:
                    remove_folder(self.spark, f"{self.root}/{table}/{name}")
                    gone.append(f"{table}/{name}")
        return gone

    @contextmanager
    def staging(self) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
        """Hands out a function that writes a frame to the scratch folder and reads it back; all go at the end."""
        written = []

        def stage(df: DataFrame, purpose: str) -> DataFrame:
            written.append(path := new_folder(self.spark, purpose))
            df.write.parquet(path)
            return self.spark.read.schema(df.schema).parquet(path)

        try:
            yield stage
        finally:
            for path in written:
                remove_folder(self.spark, path)

    # -- loads --------------------------------------------------------------------------------

    def load(self, change: Change, batch: DataFrame, stage, on_conflict: str = "error") -> int:
        """Puts clean rows with distinct order ids and what they add to the summary into a change; returns how many."""
        if on_conflict not in ("error", "ignore"):
            raise ValueError(f"on_conflict must be 'error' or 'ignore', not {on_conflict!r}")
        profile = check_constraints(batch)
        if not profile.rows:
            return 0
        known = stage(known_orders(self.table(TRANSACTIONS), batch, profile.low_id, profile.high_id), "known")
        conflicts = known.count()
        if conflicts and on_conflict == "error":
            some = [row.order_id for row in known.limit(5).collect()]
            raise DuplicateOrderError(f"{conflicts} orders are already stored, for example {some}")
        if conflicts < profile.rows:
            fresh = load_projection(new_orders(batch, known) if conflicts else batch)
            added = change.add(TRANSACTIONS, fresh.withColumn("loaded_at", F.current_timestamp()))
            self._summarise(change, stage(monthly_deltas(added=added), "deltas"))
        return profile.rows - conflicts

    def cancel(self, change: Change, orders: DataFrame, stage) -> int:
        """Takes stored orders, named by ``order_id``, out of the tables; returns how many there were."""
        stored = self.table(TRANSACTIONS).select(*SUMMED)
        removed = stage(stored.join(orders.select("order_id"), "order_id", "left_semi"), "removed")
        months = [tuple(row) for row in removed.select(*MONTH_KEYS).distinct().collect()]
        if months:
            kept = self.table(TRANSACTIONS, months=months).join(removed.select("order_id"), "order_id", "left_anti")
            change.replace(TRANSACTIONS, kept, months)
            self._summarise(change, stage(monthly_deltas(removed=removed), "deltas"))
        return removed.count()

    def _summarise(self, change: Change, deltas: DataFrame) -> None:
        months = [tuple(row) for row in deltas.select(*MONTH_KEYS).distinct().collect()]
        change.replace(SUMMARY, _by_month(SUMMARY, apply_deltas(self.table(SUMMARY, months=months), deltas)), months)


def _by_month(table: str, rows: DataFrame) -> DataFrame:
    """Rows of a month brought together, for few files; adaptive execution splits a large month and merges small ones."""
    keys = TABLE_PARTITIONS[table]
    return rows.hint("rebalance", *keys) if keys else rows


def _log_row(mart: VersionedMart, run_id: str, source: str, rows: dict, status: str, began: datetime, error: str | None) -> DataFrame:
    check_log_row(source, rows, status)
    ended = datetime.now(timezone.utc)
    seconds = Decimal(str(round((ended - began).total_seconds(), 2)))
    counts = [rows[name] for name in ("rows_read", "rows_cleaned", "rows_rejected", "rows_loaded")]
    return mart.spark.createDataFrame([(run_id, source, *counts, status, error, began, ended, seconds)], RUN_LOG_SCHEMA).coalesce(1)


def ingest_atomic(
    mart: VersionedMart,
    extract: Callable[[], tuple[DataFrame, Sequence[str]]],
    source_name: str,
    order_by: Sequence[str] = tuple(SOURCE_ORDER),
    on_bad_number: str = "fail",
    on_conflict: str = "error",
    run_id: str | None = None,
    near: Sequence[str] = (),
) -> dict:
    """Clean, load, bring the summary up to date and log the run, in one commit; returns the counts.

    A failing run leaves the tables as they were but for its row in the log, and raises again.
    """
    if on_bad_number not in ("fail", "null"):
        raise ValueError(f"on_bad_number must be 'fail' or 'null', not {on_bad_number!r}")
    run_id, began = run_id or uuid.uuid4().hex, datetime.now(timezone.utc)
    rows = dict.fromkeys(("rows_read", "rows_cleaned", "rows_rejected", "rows_loaded"), 0)
    try:
        with mart.staging() as stage, mart.change(run_id) as change:
            raw, layouts = extract()
            validate_schema(raw)
            disposed = stage(with_derived(dispose_rows(raw, order_by, layouts, near=near)), "disposed")
            stats = count_dispositions(disposed).first().asDict()
            rows |= {name: stats[name] for name in ("rows_read", "rows_cleaned", "rows_rejected")}
            if stats["bad_numbers"] and on_bad_number == "fail":
                raise ValueError(f"{stats['bad_numbers']} values of number columns are not numbers")
            loaded = mart.load(change, kept_rows(disposed), stage, on_conflict)
            change.add(RUN_LOG, _log_row(mart, run_id, source_name, rows | {"rows_loaded": loaded}, "SUCCESS", began, None))
    except Exception as error:
        try:
            with mart.change(run_id) as change:
                change.add(RUN_LOG, _log_row(mart, run_id, source_name, rows, "FAILED", began, str(error)))
        except Exception as trouble:
            logger.warning("%s: no row in the run log, %s", source_name, trouble)
        raise
    return {**rows, "rows_loaded": loaded, "status": "SUCCESS"}
