"""The index of stored order ids against the stored rows themselves."""

from __future__ import annotations

import re
import uuid

import pytest
from conftest import row
from pyspark.sql import functions as F

from ordermill.operators.cleaning import clean_sales
from ordermill.plans.key_index import FILTERS, KEYS, KeyIndex, bit_is_set
from ordermill.plans.warehouse import DuplicateOrderError, Warehouse
from ordermill.schemas import TRANSACTIONS


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "mart"), f"mart_{uuid.uuid4().hex}")


@pytest.fixture
def clean(frame):
    return lambda *rows: clean_sales(frame(*rows), ["pos"]).drop("pos")


def ids(warehouse):
    return sorted(r.order_id for r in warehouse.table(TRANSACTIONS).collect())


@pytest.fixture
def indexed(spark, tmp_path):
    options = {"shards": 8, "buckets": 2, "expected": 2000}
    return Warehouse(spark, str(tmp_path / "indexed"), f"mart_{uuid.uuid4().hex}", key_index=options)


def test_bitmaps_hold_the_bits_set(spark):
    given = [0, 7, 8, 4097, 32767]
    bitmap = spark.createDataFrame([(i,) for i in given], "p long").agg(F.bitmap_construct_agg("p").alias("bits"))
    asked = spark.createDataFrame([(i,) for i in [*given, 1, 9, 32766]], "p long").crossJoin(bitmap)
    found = asked.where(bit_is_set(F.col("bits"), F.col("p"))).select("p").collect()
    assert sorted(row.p for row in found) == given


def test_index_finds_what_the_table_has(indexed, clean):
    first = clean(*[row(order_id=f"o{i}") for i in range(200)])
    assert indexed.load_transactions(first) == 200
    batch = clean(*[row(order_id=f"o{i}") for i in range(150, 350)])
    suspects = indexed.keys.suspects(batch)
    found = {r.order_id for r in suspects.collect()}
    assert {f"o{i}" for i in range(150, 200)} <= found and len(found) < 70
    with pytest.raises(DuplicateOrderError, match="50 orders"):
        indexed.load_transactions(batch)
    assert indexed.load_transactions(batch, on_conflict="ignore") == 150
    assert ids(indexed) == sorted(f"o{i}" for i in range(350))
    assert sorted(r.order_id for r in indexed.table(KEYS).collect()) == ids(indexed)
    assert indexed.load_transactions(batch, on_conflict="ignore") == 0


def test_index_is_made_anew_after_a_load_that_did_not_end(spark, indexed, clean, monkeypatch, tmp_path):
    indexed.load_transactions(clean(row(order_id="a")))

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(KeyIndex, "add", broken)
        with pytest.raises(RuntimeError):
            indexed.load_transactions(clean(row(order_id="b")))
    assert ids(indexed) == ["a", "b"] and indexed.table(KEYS).count() == 1
    again = Warehouse(spark, indexed.root, indexed.database, key_index={})
    assert (again.keys.shards, again.keys.slots) == (indexed.keys.shards, indexed.keys.slots)
    assert again.load_transactions(clean(row(order_id="b"), row(order_id="c")), on_conflict="ignore") == 1
    assert sorted(r.order_id for r in again.table(KEYS).collect()) == ["a", "b", "c"]
    with pytest.raises(ValueError, match="key index"):
        Warehouse(spark, indexed.root, indexed.database)


def test_index_of_a_warehouse_that_has_rows(spark, warehouse, clean):
    warehouse.load_transactions(clean(row(order_id="a"), row(order_id="b")))
    opened = Warehouse(spark, warehouse.root, warehouse.database, key_index={"shards": 2})
    with pytest.raises(DuplicateOrderError):
        opened.load_transactions(clean(row(order_id="b")))
    opened.load_dataframe(clean(row(order_id="c")), TRANSACTIONS, if_exists="replace")
    assert opened.load_transactions(clean(row(order_id="b"))) == 1


def test_lookup_does_not_shuffle_stored_keys_and_reads_only_shards_of_the_batch(spark, indexed, clean):
    indexed.load_transactions(clean(*[row(order_id=f"o{i}") for i in range(300)]))
    few = clean(row(order_id="o1"), row(order_id="new"))
    read = lambda df: {re.search(r"shard=(\d+)", name).group(1) for name in df.inputFiles()}
    with indexed.staging() as stage:
        few = stage(few, "few")
        assert len(read(indexed.keys._of_shards(FILTERS, indexed.keys._placed(few)))) <= 2
        suspects = stage(indexed.keys.suspects(few), "suspects")
        assert len(read(indexed.keys._of_shards(KEYS, suspects))) == 1
        none = stage(indexed.keys.suspects(clean(row(order_id="never seen"))), "none")
        assert none.isEmpty() and read(indexed.keys._of_shards(KEYS, none)) == set()
        large = stage(indexed.keys.suspects(clean(*[row(order_id=f"o{i}") for i in range(300)])), "large")
        for suspects, threshold in ((suspects, "10m"), (large, "-1")):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            try:
                known = indexed.keys.known(suspects)
                plan = known._jdf.queryExecution().executedPlan().toString()
                assert known.count() == suspects.count()
            finally:
                spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            keys = plan[: plan.index(f"{KEYS}[")]  # from the join down to the scan of the stored keys
            assert "Exchange" not in keys[keys.rindex("Join") :], plan
