"""From a raw source to the loaded tables, and on to the reports."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from ordermill.functions import ISO_DATE
from ordermill.operators.cleaning import validate_schema
from ordermill.operators.disposition import count_dispositions, dispose_rows, kept_rows, with_derived
from ordermill.plans.audit import AuditedRun
from ordermill.plans.reports import write_report_marts
from ordermill.plans.warehouse import Warehouse
from ordermill.schemas import LONGEST_SOURCE, REQUIRED_COLUMNS
from ordermill.sources import SOURCE_ORDER, infer_layouts, read_raw

logger = logging.getLogger(__name__)


def ingest(
    warehouse: Warehouse,
    extract: Callable[[], tuple[DataFrame, Sequence[str]]],
    source_name: str,
    order_by: Sequence[str] = tuple(SOURCE_ORDER),
    on_bad_number: str = "fail",
    on_conflict: str = "error",
    refresh: str = "batch",
    run_id: str | None = None,
    on_violation: str = "error",
    near: Sequence[str] = (),
) -> dict:
    """Clean, load, refresh the summary and log the run; a failure is logged and raised again.

    ``extract`` returns the raw rows and the date layouts.  The rows are scanned once: one job
    cleans, counts and stages them, and everything after reads the staged table.  ``near`` is that of ``dispose_rows``.

    Rows that break a constraint of the table fail the run, or with ``on_violation="quarantine"`` go to the table of
    rejects with their reasons; such a run is PARTIAL, and these rows count as rejected.
    """
    if on_violation not in ("error", "quarantine"):
        raise ValueError(f"on_violation must be 'error' or 'quarantine', not {on_violation!r}")
    if on_bad_number not in ("fail", "null"):
        raise ValueError(f"on_bad_number must be 'fail' or 'null', not {on_bad_number!r}")
    with AuditedRun(warehouse, source_name, run_id) as run, warehouse.staging() as stage:
        raw, layouts = extract()
        if set(REQUIRED_COLUMNS) - set(raw.columns):
            run.rows["rows_read"] = raw.count()
        validate_schema(raw)
        disposed = stage(with_derived(dispose_rows(raw, order_by, layouts, near=near)), "disposed")
        stats = count_dispositions(disposed).first().asDict()
        run.rows["rows_read"] = stats["rows_read"]
        if stats["bad_numbers"] and on_bad_number == "fail":
            raise ValueError(f"{stats['bad_numbers']} values of number columns are not numbers")
        run.rows |= {name: stats[name] for name in ("rows_cleaned", "rows_rejected")}
        logger.info("%s: %s", source_name, stats)
        clean = kept_rows(disposed)
        if on_violation == "quarantine":
            clean, refused = warehouse.quarantine(clean, run.run_id, stage)
            run.rows["rows_cleaned"] -= refused
            run.rows["rows_rejected"] += refused
            run.outcome = "PARTIAL" if refused else run.outcome
        run.rows["rows_loaded"] = warehouse.load_transactions(clean, on_conflict)
        warehouse.refresh_summary(clean, refresh)
    return run.result()


def _label(source: str | list[str]) -> str:
    """A source's name for the run log: one path, or the first of several and their number."""
    name = source if isinstance(source, str) else f"{source[0]} and {len(source) - 1} more" if len(source) > 1 else source[0]
    return name if len(name) <= LONGEST_SOURCE else f"{name[:100]}...{name[-100:]}"


def run_pipeline(
    warehouse: Warehouse,
    source: str | list[str],
    fmt: str = "csv",
    multi_line: bool | None = None,
    mixed_headers: bool = False,
    layouts: Sequence[str] | None = None,
    source_name: str | None = None,
    **options,
) -> dict:
    """One run over a file, a folder or several files.

    Without ``layouts`` the date layout is taken from the first date of a CSV source.  Further
    options are those of ``ingest``.
    """

    def extract():
        raw = read_raw(warehouse.spark, source, fmt, multi_line, mixed_headers)
        if layouts is not None:
            return raw, layouts
        return raw, infer_layouts(warehouse.spark, source) if fmt == "csv" else [ISO_DATE]

    return ingest(warehouse, extract, source_name or _label(source), **options)


def run_all(
    warehouse: Warehouse, source: str, report_folder: str, top_n: int = 10, lenient: bool = False, **options
) -> dict:
    """A run and, when it succeeded, the reports."""
    result = run_pipeline(warehouse, source, **options)
    return {**result, "reports": write_report_marts(warehouse, report_folder, top_n, lenient=lenient)}
