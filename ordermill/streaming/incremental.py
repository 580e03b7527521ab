"""The pipeline over whatever a folder has received since the last call.

A scheduler outside (cron, an orchestrator) decides when to call.  A table in the warehouse holds the files taken
so far by path, length and modification time; a call lists the folder and takes every file that is not in it.  So a
file counts as new whenever it is new or was written again, however old its date is and whatever was called
before.  A file that arrives while a call runs is left to the next one.

A batch is loaded first and noted after.  If the noting is lost, the batch is taken again: orders it had already
stored are skipped and the months it touches are totalled anew, so taking it again changes nothing.

A delivery whose own content is to blame (a bad number, a broken constraint, a wrong header, a quote left open) is
logged as FAILED and noted as such, with the others of its batch loaded one by one; it is not tried again unless
asked for, or written anew, and holds nothing up.  Any other failure, such as a store out of reach, ends the call with
nothing noted, so the next call takes the same files again.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.plans.pipeline import run_pipeline
from ordermill.plans.reports import write_report_marts
from ordermill.plans.warehouse import Warehouse
from ordermill.schemas import TAKEN_FILES, TAKEN_FILES_SCHEMA
from ordermill.sources.files import list_files, literal_path

logger = logging.getLogger(__name__)

# What a noted file came to.  REPORTED notes a run whose reports were written.
LOADED, FAILED, REPORTED = "LOADED", "FAILED", "REPORTED"

FILE_KEY = ["path", "length", "modified"]
MAX_FILES = 1000


# What an error of Spark says where the rows of a file caused it.
FAULTS_OF_ROWS = ["USER_RAISED_EXCEPTION", "CSV header does not conform", "MALFORMED_CSV_RECORD", "is not a Parquet file"]


def fault_of_delivery(error: Exception) -> bool:
    """Whether the files themselves are to blame, so that trying again is no use."""
    if isinstance(error, ValueError):
        return True
    return isinstance(error, (PySparkException, Py4JJavaError)) and any(sign in str(error) for sign in FAULTS_OF_ROWS)


class Taken(NamedTuple):
    """Batches loaded by a call, and the files it could not load."""

    batches: int
    failed: list[str]


def new_files(warehouse: Warehouse, folder: str, retry_failed: bool = False) -> DataFrame:
    """Path, length and modification time of the files not taken yet."""
    noted = warehouse.table(TAKEN_FILES).where(F.col("path").isNotNull())
    if retry_failed:
        noted = noted.where(F.col("outcome") != FAILED)
    return list_files(warehouse.spark, folder).join(noted, FILE_KEY, "left_anti")


def run_incremental(
    warehouse: Warehouse,
    folder: str,
    fmt: str = "csv",
    multi_line: bool | None = None,
    mixed_headers: bool = False,
    layouts: Sequence[str] | None = None,
    on_bad_number: str = "fail",
    max_files: int = MAX_FILES,
    report_folder: str | None = None,
    top_n: int = 10,
    retry_failed: bool = False,
    lenient: bool = False,
) -> Taken:
    """Take the new files of ``folder``, at most ``max_files`` in one batch, oldest first.

    Without ``layouts`` each batch is read with the date layout of its first date, so deliver files of different
    layouts one to a batch.  With ``report_folder`` the reports follow, also those that a failure left out last time.
    """
    if max_files < 1:
        raise ValueError(f"max_files must be positive: {max_files}")
    warehouse.create_table(TAKEN_FILES, TAKEN_FILES_SCHEMA, [])
    options = {"fmt": fmt, "multi_line": multi_line, "mixed_headers": mixed_headers, "layouts": layouts}
    options |= {"on_bad_number": on_bad_number, "on_conflict": "ignore", "refresh": "recompute"}

    with warehouse.staging() as stage:
        waiting = stage(new_files(warehouse, folder, retry_failed), "waiting")
        batches, failed, batch = 0, [], []
        while batch := _next(waiting, max_files, batch[-1] if batch else None):
            loaded, bad = _take(warehouse, folder, batch, options)
            batches += loaded
            failed += bad
    if report_folder is not None:
        _report(warehouse, report_folder, top_n, lenient)
    return Taken(batches, failed)


def _next(waiting: DataFrame, max_files: int, last: tuple | None) -> list[tuple]:
    """The next files to take after the ``last`` one: names of one batch are all that comes to the driver."""
    if last is not None:
        path, _, modified = last
        waiting = waiting.where((F.col("modified") > F.lit(modified)) | (F.col("modified") == F.lit(modified)) & (F.col("path") > path))
    return [tuple(row) for row in waiting.orderBy("modified", "path").limit(max_files).collect()]


def _as_rows(warehouse: Warehouse, batch: list[tuple], outcome: str, run_id: str) -> DataFrame:
    return warehouse.spark.createDataFrame([(*file, outcome, run_id) for file in batch], TAKEN_FILES_SCHEMA).coalesce(1)


def _take(warehouse: Warehouse, folder: str, batch: list[tuple], options: dict) -> tuple[int, list[str]]:
    """Load a batch, or its files one by one where it cannot be loaded as a whole."""
    run_id = uuid.uuid4().hex
    paths = [literal_path(path) for path, *_ in batch]
    try:
        run_pipeline(warehouse, paths, source_name=folder[-255:], run_id=run_id, **options)
    except Exception as error:
        if not fault_of_delivery(error):
            raise
        if len(batch) > 1:
            parts = [_take(warehouse, folder, [file], options) for file in batch]
            return sum(n for n, _ in parts), [path for _, bad in parts for path in bad]
        logger.warning("%s could not be loaded: %s", paths[0], error)
        warehouse.append(_as_rows(warehouse, batch, FAILED, run_id), TAKEN_FILES)
        return 0, [batch[0][0]]
    warehouse.append(_as_rows(warehouse, batch, LOADED, run_id), TAKEN_FILES)
    return 1, []


def _report(warehouse: Warehouse, folder: str, top_n: int, lenient: bool) -> None:
    """The reports, when a run was loaded since they were last written."""
    noted = warehouse.table(TAKEN_FILES)
    done = noted.where(F.col("outcome") == REPORTED).select("run_id")
    open_runs = noted.where(F.col("outcome") == LOADED).join(done, "run_id", "left_anti").select("run_id").distinct()
    with warehouse.staging() as stage:
        runs = stage(open_runs, "open_runs")
        if runs.isEmpty():
            return
        write_report_marts(warehouse, folder, top_n, lenient=lenient)
        marks = [F.lit(None).cast(f.dataType).alias(f.name) for f in TAKEN_FILES_SCHEMA.fields[:3]]
        warehouse.append(runs.select(*marks, F.lit(REPORTED).alias("outcome"), "run_id"), TAKEN_FILES)
