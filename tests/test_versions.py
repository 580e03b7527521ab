"""Commits of whole runs, the summary kept by differences, and rows set apart."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from datetime import date
from decimal import Decimal

import pytest
from conftest import row
from pyspark.sql import functions as F

from ordermill.functions import ISO_DATE
from ordermill.operators import aggregates
from ordermill.operators.cleaning import clean_sales, keep_first
from ordermill.operators.constraints import constraint_violations
from ordermill.operators.deltas import apply_deltas, merge_deltas, monthly_deltas
from ordermill.operators.quarantine import mark_broken, rejected_rows, sound_rows
from ordermill.plans.pipeline import ingest
from ordermill.plans.versions import COMMITS, VersionedMart, ingest_atomic
from ordermill.plans.warehouse import DuplicateOrderError, Warehouse, load_projection, summary_projection
from ordermill.schemas import REJECTS, RUN_LOG, SUMMARY, TRANSACTIONS


@pytest.fixture
def mart(spark, tmp_path):
    return VersionedMart(spark, str(tmp_path / "mart"))


@pytest.fixture
def clean(frame):
    return lambda *rows: clean_sales(frame(*rows), ["pos"]).drop("pos")


def run(mart, frame, *rows, **options):
    return ingest_atomic(mart, lambda: (frame(*rows), [ISO_DATE]), "source", order_by=["pos"], **options)


def ids(mart, version=None):
    return sorted(r.order_id for r in mart.table(TRANSACTIONS, version).collect())


def summary(df):
    return {(r.order_year, r.order_month, r.region): (r.total_orders, r.total_quantity, r.total_revenue, r.avg_order_value) for r in df.collect()}


def recomputed(mart):
    return summary(summary_projection(aggregates.monthly_totals(mart.table(TRANSACTIONS))))


def log(mart):
    return sorted((r.rows_read, r.rows_cleaned, r.rows_loaded, r.status) for r in mart.table(RUN_LOG).collect())


MAY = [row(order_id="1"), row(order_id="2", region="east"), row(order_id="2"), row(order_id="x", customer_name=None)]
JUNE = [row(order_id="1"), row(order_id="3", order_date="2023-06-01"), row(order_id="4", quantity="2", region="east")]


def test_a_run_is_one_commit(mart, frame):
    assert mart.version() == 0 and ids(mart) == [] and mart.table(SUMMARY).count() == 0
    assert run(mart, frame, *MAY)["rows_loaded"] == 2
    assert run(mart, frame, *JUNE, on_conflict="ignore") == {"rows_read": 3, "rows_cleaned": 3, "rows_rejected": 0, "rows_loaded": 2, "status": "SUCCESS"}
    assert mart.version() == 2 and ids(mart) == ["1", "2", "3", "4"] and ids(mart, 1) == ["1", "2"] and ids(mart, 0) == []
    assert summary(mart.table(SUMMARY)) == recomputed(mart) and len(recomputed(mart)) == 3
    assert set(summary(mart.table(SUMMARY, 1))) == {(2023, 5, "West"), (2023, 5, "East")}
    assert log(mart) == [(3, 3, 2, "SUCCESS"), (4, 2, 2, "SUCCESS")]
    with pytest.raises(DuplicateOrderError):
        run(mart, frame, *JUNE)
    assert ids(mart) == ["1", "2", "3", "4"] and log(mart)[0] == (3, 3, 0, "FAILED")


@pytest.mark.parametrize("moment", ["after the rows", "after the summary", "at the commit"])
def test_a_run_that_dies_leaves_the_old_state(mart, frame, monkeypatch, moment):
    run(mart, frame, *MAY)
    before = ids(mart), summary(mart.table(SUMMARY)), log(mart)

    class Killed(BaseException):
        """As a process that ends: nothing of the run's own handling takes place."""

    def die(*_, **__):
        raise Killed

    with monkeypatch.context() as patch:
        where = {"after the rows": "_summarise", "at the commit": "_commit"}
        if moment in where:
            patch.setattr(VersionedMart, where[moment], die)
        else:
            patch.setattr("ordermill.plans.versions._log_row", die)
        with pytest.raises(Killed):
            run(mart, frame, *JUNE, on_conflict="ignore")
    again = VersionedMart(mart.spark, mart.root)
    assert (ids(again), summary(again.table(SUMMARY)), log(again)) == before
    assert {name.split("/")[0] for name in again.vacuum()} >= {TRANSACTIONS}
    run(again, frame, *JUNE, on_conflict="ignore")
    assert ids(again) == ["1", "2", "3", "4"] and summary(again.table(SUMMARY)) == recomputed(again)


def test_a_torn_commit_is_not_seen(mart, frame, tmp_path):
    run(mart, frame, *MAY)
    folder = tmp_path / "mart" / COMMITS / "_temporary" / "0"
    folder.mkdir(parents=True)
    (folder / "part-0.parquet").write_bytes(b"half a file")
    assert mart.version() == 1 and ids(mart) == ["1", "2"]


def test_cancelled_orders_leave_by_differences(mart, frame):
    run(mart, frame, *MAY)
    run(mart, frame, *JUNE, on_conflict="ignore")
    with mart.staging() as stage, mart.change() as change:
        assert mart.cancel(change, mart.table(TRANSACTIONS).where("order_id IN ('1', '3')"), stage) == 2
    assert ids(mart) == ["2", "4"] and summary(mart.table(SUMMARY)) == recomputed(mart) and len(recomputed(mart)) == 1
    assert mart.table(TRANSACTIONS, months=[(2023, 6)]).count() == 0
    with mart.staging() as stage, mart.change() as change:
        assert mart.cancel(change, mart.table(TRANSACTIONS).where("order_id = 'none'"), stage) == 0
    assert run(mart, frame, row(order_id="1"))["rows_loaded"] == 1


def test_compaction_and_vacuum_change_no_rows(mart, frame):
    for i in range(3):
        run(mart, frame, row(order_id=f"o{i}"))
    before = ids(mart), summary(mart.table(SUMMARY)), log(mart)
    assert mart.compact(TRANSACTIONS) == 1 and mart.compact(RUN_LOG) == 1 and mart.compact(TRANSACTIONS) == 0
    assert len(mart.vacuum()) == 3 + 2 + 3
    assert (ids(mart), summary(mart.table(SUMMARY)), log(mart)) == before
    with mart.change() as change:
        with pytest.raises(ValueError, match="outside the months"):
            change.replace(TRANSACTIONS, mart.table(TRANSACTIONS), [(1999, 1)])


def test_differences_merge_in_any_order(clean):
    a, b, c = (load_projection(clean(*rows)) for rows in (MAY, JUNE, [row(order_id="1"), row(order_id="9", region="east")]))
    one = merge_deltas(merge_deltas(monthly_deltas(added=a), monthly_deltas(added=b)), monthly_deltas(removed=c))
    other = monthly_deltas(added=a.unionByName(b), removed=c)
    values = lambda df: sorted((r.order_year, r.order_month, r.region, r.total_orders, r.total_quantity, r.total_revenue) for r in df.collect())
    assert values(one) == values(other) and (2023, 5, "East") not in [v[:3] for v in values(one) if not any(v[3:])]
    assert monthly_deltas(added=a, removed=a).count() == 0
    nothing = one.sparkSession.createDataFrame([], "region string, total_orders long, total_quantity long, total_revenue decimal(22,2), avg_order_value decimal(12,2), refreshed_at timestamp, order_year int, order_month int")
    assert set(apply_deltas(nothing, one).columns) == set(nothing.columns)
    with pytest.raises(ValueError):
        monthly_deltas()


# -- rows set apart -------------------------------------------------------------------------------


def test_marked_rows_agree_with_the_counts(clean):
    rows = [row(order_id=str(i)) for i in range(4)] + [row(order_id="long" * 20, region=None), row(order_id="b", unit_price="1e9"), row(order_id=None)]
    batch = clean(*rows)
    marked = mark_broken(batch)
    assert sound_rows(marked).count() == 4 and sound_rows(marked).columns == batch.columns
    rejected = rejected_rows(marked, "run 1").collect()
    counts = {}
    for entry in rejected:
        for reason in entry.reasons:
            counts[reason] = counts.get(reason, 0) + 1
    assert counts == {rule: n for rule, n in constraint_violations(batch).first().asDict().items() if n}
    assert {(r.run_id, r.region) for r in rejected} == {("run 1", None), ("run 1", "West")}


def test_a_run_with_quarantine_is_partial(spark, frame, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "mart"), f"mart_{uuid.uuid4().hex}")
    load = lambda *rows, **options: ingest(warehouse, lambda: (frame(*rows), [ISO_DATE]), "s", order_by=["pos"], **options)
    result = load(row(order_id="1"), row(order_id="2", region=None), on_violation="quarantine")
    assert (result["rows_cleaned"], result["rows_rejected"], result["rows_loaded"], result["status"]) == (1, 1, 1, "PARTIAL")
    assert [(r.order_id, r.reasons) for r in warehouse.table(REJECTS).collect()] == [("2", ["region_not_null"])]
    assert load(row(order_id="3"), on_violation="quarantine")["status"] == "SUCCESS"
    with pytest.raises(ValueError, match="on_violation"):
        load(row(order_id="4"), on_violation="skip")


# -- lenient keys, all totals, report functions ---------------------------------------------------


def test_lenient_keys(spark, frame, tmp_path):
    raw = frame(row(order_id="a1"), row(order_id="A1 "), row(order_id="Á1"), row(order_id="b"), row(order_id="B", customer_name=None))
    assert sorted(r.order_id for r in keep_first(raw, ["pos"], lenient=True).collect()) == ["a1", "b"]
    assert keep_first(raw, ["pos"]).count() == 5
    warehouse = Warehouse(spark, str(tmp_path / "mart"), f"mart_{uuid.uuid4().hex}")
    batch = lambda *names: clean_sales(frame(*[row(order_id=n) for n in names]), ["pos"]).drop("pos")
    assert warehouse.load_transactions(batch("a1", "c"), lenient=True) == 2
    with pytest.raises(DuplicateOrderError):
        warehouse.load_transactions(batch("A1", "d"), lenient=True)
    with pytest.raises(DuplicateOrderError):
        warehouse.load_transactions(batch("e", "E"), lenient=True)
    assert warehouse.load_transactions(batch("A1", "d", "D "), on_conflict="ignore", lenient=True) == 1
    assert warehouse.load_transactions(batch("A1")) == 1
    assert sorted(r.order_id for r in warehouse.table(TRANSACTIONS).collect()) == ["A1", "D ", "a1", "c"]


def test_all_totals_are_those_of_each_frame(clean):
    rows = [row(order_id=str(i), region=r, product_name=p) for i, (r, p) in enumerate([("west", "Rake"), ("east", None), (None, "Rake"), ("west", "Hoe")])]
    batch = clean(*rows)
    totals = aggregates.all_totals(batch)
    frames = aggregates.split_frames(totals)
    plan = totals._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1
    for name, single in (("region", aggregates.aggregate_by_region(batch)), ("month_region", aggregates.monthly_totals(batch))):
        columns = [*aggregates.FRAMES[name], "total_orders", "total_quantity", "total_revenue"]
        assert sorted(map(tuple, frames[name].select(*columns).collect())) == sorted(map(tuple, single.select(*columns).collect()))
    assert {r.product_name for r in frames["product"].collect()} == {"Rake", "Hoe"}


def test_report_functions(spark, clean, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "mart"), f"mart_{uuid.uuid4().hex}")
    warehouse.load_transactions(clean(row(order_id="1"), row(order_id="2", product_name="Hoe", region="east", quantity="1")))
    warehouse.create_report_functions()
    warehouse.create_report_functions()
    top = warehouse.run_query("SELECT product_name FROM sql_top_products(:n)", {"n": 1}).collect()
    assert [r.product_name for r in top] == ["Rake"]
    share = warehouse.run_query("SELECT * FROM sql_region_share(:a, :b) ORDER BY region", {"a": date(2023, 1, 1), "b": date(2023, 12, 31)})
    assert [(r.region, r.share) for r in share.collect()] == [("East", Decimal("0.2500")), ("West", Decimal("0.7500"))]
    assert warehouse.run_query("SELECT * FROM sql_region_share(:a, :b)", {"a": date(1999, 1, 1), "b": date(1999, 2, 1)}).count() == 0
    warehouse.drop()


def test_a_load_writes_its_rows_once_and_a_cancellation_only_what_it_sums(mart, frame, monkeypatch):
    staged, staging = {}, VersionedMart.staging

    @contextmanager
    def noting(self):
        with staging(self) as stage:
            yield lambda df, purpose: (staged.setdefault(purpose, df.columns), stage(df, purpose))[1]

    monkeypatch.setattr(VersionedMart, "staging", noting)
    run(mart, frame, row(order_id="1"), row(order_id="2"))
    with mart.staging() as stage, mart.change() as change:
        mart.cancel(change, mart.table(TRANSACTIONS).where("order_id = '2'"), stage)
    assert "fresh" not in staged
    assert set(staged["removed"]) == {"order_year", "order_month", "region", "order_id", "quantity", "total_amount"}
    assert [r.order_id for r in mart.table(TRANSACTIONS).collect()] == ["1"]
    assert [r.total_orders for r in mart.table(SUMMARY).collect()] == [1]
