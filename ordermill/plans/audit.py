"""One row per run in the run log."""

from __future__ import annotations

import logging
import uuid
from datetime import datetime, timezone
from decimal import Decimal

from ordermill.operators.constraints import check_log_row
from ordermill.plans.warehouse import Warehouse
from ordermill.schemas import RUN_LOG, RUN_LOG_SCHEMA

logger = logging.getLogger(__name__)


def log_run(
    warehouse: Warehouse,
    source_file: str,
    rows_read: int,
    rows_cleaned: int,
    rows_rejected: int,
    rows_loaded: int,
    status: str,
    started_at: datetime,
    finished_at: datetime,
    error_message: str | None = None,
    run_id: str | None = None,
) -> str:
    """Append a run to the log and return its id."""
    counts = {"rows_read": rows_read, "rows_cleaned": rows_cleaned, "rows_rejected": rows_rejected, "rows_loaded": rows_loaded}
    check_log_row(source_file, counts, status)
    run_id = run_id or uuid.uuid4().hex
    seconds = Decimal(str(round((finished_at - started_at).total_seconds(), 2)))
    row = (
        run_id,
        source_file,
        rows_read,
        rows_cleaned,
        rows_rejected,
        rows_loaded,
        status,
        error_message,
        started_at,
        finished_at,
        seconds,
    )
    one_row = warehouse.spark.createDataFrame([row], RUN_LOG_SCHEMA).coalesce(1)
    warehouse.append(one_row, RUN_LOG)
    return run_id


class AuditedRun:
    """A ``with`` block that leaves one row in the run log, whichever way it is left.

    The block fills in the counts it knows.  An error of the block goes on after it was logged; that the log cannot
    be written is only warned about, as it says nothing of the run.
    """

    def __init__(self, warehouse: Warehouse, source_name: str, run_id: str | None = None):
        self.warehouse, self.source_name = warehouse, source_name
        self.run_id = run_id or uuid.uuid4().hex
        self.rows = dict.fromkeys(("rows_read", "rows_cleaned", "rows_rejected", "rows_loaded"), 0)
        self.outcome = "SUCCESS"

    def __enter__(self) -> AuditedRun:
        self.began = datetime.now(timezone.utc)
        return self

    def __exit__(self, kind, failure, trace) -> bool:
        self.ended = datetime.now(timezone.utc)
        if failure is not None:
            self.outcome = "FAILED"
            logger.error("%s: run failed, %s", self.source_name, failure)
        if failure is None or isinstance(failure, Exception):
            self._leave_row(None if failure is None else str(failure))
        return False

    def _leave_row(self, message: str | None) -> None:
        when = {"started_at": self.began, "finished_at": self.ended}
        try:
            log_run(self.warehouse, self.source_name, **self.rows, status=self.outcome, error_message=message, run_id=self.run_id, **when)
        except Exception as trouble:
            logger.warning("%s: no row in the run log, %s", self.source_name, trouble)

    def result(self) -> dict:
        seconds = (self.ended - self.began).total_seconds()
        return {**self.rows, "status": self.outcome, "duration_seconds": seconds}
