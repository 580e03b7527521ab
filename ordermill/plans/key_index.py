"""The order ids already stored, kept apart so that a load reads in proportion to its batch.

Two tables beside the transactions, both partitioned by *shard*, a hash of the order id:

* ``order_keys`` holds the ids, bucketed by id within a shard, so a join on the id shuffles only the other side;
* ``order_key_filters`` holds Bloom filters: a key sets HASHES bits in the bitmap of its shard and slot.

A batch is held against the filters of its own shards first.  Ids with a bit not set are new for certain; what is left,
the stored ids and few others, is joined with the keys of its own shards.  So a batch of new orders reads
bitmaps of its shards and next to no keys, and shards that a batch has no id of are not read at all.

The tables follow the transactions: a load notes that it begins, appends the rows, adds the ids and notes that it ended.
If one did not end, the next load makes the index anew from the transactions.
"""

from __future__ import annotations

import math
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.plans.scratch import remove_folder
from ordermill.schemas import TRANSACTIONS

KEYS, FILTERS, STEPS = "order_keys", "order_key_filters", "order_key_loads"

BITS = 32_768  # of one bitmap, as Spark's bitmap functions make them
BITS_PER_KEY = 12
HASHES = 4

STEPS_SCHEMA = T.StructType([T.StructField("load_id", T.StringType()), T.StructField("step", T.StringType())])
BEGUN, ENDED = "BEGUN", "ENDED"


def bit_is_set(bitmap: Column, position: Column) -> Column:
    """Whether the bit at ``position`` of a bitmap of ``bitmap_construct_agg`` is set."""
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


class KeyIndex:
    """The index of one warehouse.  ``expected`` is the number of keys its filters are made for; more make them
    let more ids through, which costs reading and not results; ``rebuild`` takes a new number."""

    def __init__(self, warehouse, shards: int = 64, buckets: int = 4, expected: int = 1_000_000):
        self.warehouse, self.spark = warehouse, warehouse.spark
        self.shards, self.buckets, self.expected = shards, buckets, expected
        fresh = not self.spark.catalog.tableExists(warehouse._name(STEPS))
        warehouse.create_table(STEPS, STEPS_SCHEMA, [])
        if fresh:
            self._create()
            if not warehouse.table(TRANSACTIONS).isEmpty():
                self.rebuild()
        else:
            self._read_layout()

    # -- layout -------------------------------------------------------------------------------

    def _create(self) -> None:
        root, name = self.warehouse.root, self.warehouse._name
        layout = f"'shards' = '{self.shards}', 'slots' = '{self.slots}'"
        self.spark.sql(
            f"CREATE TABLE {name(KEYS)} (order_id STRING, shard INT) USING parquet PARTITIONED BY (shard) "
            f"CLUSTERED BY (order_id) INTO {self.buckets} BUCKETS LOCATION '{root}/{KEYS}' TBLPROPERTIES ({layout})"
        )
        self.spark.sql(
            f"CREATE TABLE {name(FILTERS)} (slot INT, bits BINARY, shard INT) USING parquet PARTITIONED BY (shard) "
            f"LOCATION '{root}/{FILTERS}'"
        )

    def _read_layout(self) -> None:
        found = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.warehouse._name(KEYS)}").collect()}
        self.shards = int(found["shards"])
        self.expected = int(found["slots"]) * self.shards * BITS // BITS_PER_KEY

    @property
    def slots(self) -> int:
        """Bitmaps in one shard."""
        return max(1, math.ceil(self.expected * BITS_PER_KEY / (BITS * self.shards)))

    def _placed(self, ids: DataFrame) -> DataFrame:
        """order_id, shard, slot and the positions of its bits."""
        hash_ = F.xxhash64("order_id")
        positions = F.array(*[F.pmod(F.xxhash64("order_id", F.lit(i)), F.lit(BITS)) for i in range(HASHES)])
        return ids.select(
            "order_id",
            F.pmod(hash_, F.lit(self.shards)).cast("int").alias("shard"),
            F.pmod(F.shiftright(hash_, 24), F.lit(self.slots)).cast("int").alias("slot"),
            positions.alias("positions"),
        )

    def _of_shards(self, table: str, placed: DataFrame) -> DataFrame:
        """Rows of the shards that ``placed`` has, as a filter on the partition column; there are ``shards`` at most."""
        shards = [row.shard for row in placed.select("shard").distinct().collect()]
        return self.warehouse.table(table).where(F.col("shard").isin(shards) if shards else F.lit(False))

    # -- looking up ---------------------------------------------------------------------------

    def suspects(self, batch: DataFrame) -> DataFrame:
        """order_id and shard of the ids that the filters do not tell to be new."""
        placed = self._placed(batch)
        bitmaps = self._of_shards(FILTERS, placed)
        joined = placed.join(bitmaps, ["shard", "slot"])
        all_set = F.forall("positions", lambda position: bit_is_set(F.col("bits"), position))
        return joined.where(all_set).select("order_id", "shard")

    def known(self, suspects: DataFrame) -> DataFrame:
        """Those of the ``suspects`` (staged) that are stored.

        Stored keys are on the left and bucketed by id: few suspects are sent to them, many are shuffled to their buckets.
        """
        stored = self._of_shards(KEYS, suspects)
        return stored.select("order_id").join(suspects.select("order_id").hint("shuffle_hash"), "order_id", "left_semi")

    # -- following the transactions -----------------------------------------------------------

    def _note(self, load_id: str, step: str) -> None:
        self.warehouse.append(self.spark.createDataFrame([(load_id, step)], STEPS_SCHEMA).coalesce(1), STEPS)

    def _unfinished(self) -> bool:
        steps = self.warehouse.table(STEPS).groupBy("load_id").agg(F.count_if(F.col("step") == ENDED).alias("ended"))
        return not steps.where("ended = 0").isEmpty()

    def ready(self) -> None:
        """Makes the index anew where a load did not end."""
        if self._unfinished():
            self.rebuild()

    @contextmanager
    def following(self, ids: DataFrame):
        """Around the append of rows with these ``ids``."""
        load_id = uuid.uuid4().hex
        self._note(load_id, BEGUN)
        yield
        self.add(ids)
        self._note(load_id, ENDED)

    def _bitmaps(self, placed: DataFrame) -> DataFrame:
        bits = placed.select("shard", "slot", F.explode("positions").alias("position"))
        return bits.groupBy("shard", "slot").agg(F.bitmap_construct_agg("position").alias("bits"))

    def add(self, ids: DataFrame) -> None:
        """Appends the ids and sets their bits; only filters of their shards are written anew."""
        with self.warehouse.staging() as stage:
            placed = stage(self._placed(ids), "placed")
            self._insert(placed.select("order_id", "shard"), KEYS, overwrite=False)
            old = self._of_shards(FILTERS, placed).select("shard", "slot", "bits")
            both = old.unionByName(self._bitmaps(placed)).groupBy("shard", "slot").agg(F.bitmap_or_agg("bits").alias("bits"))
            self._insert(stage(both, "bitmaps"), FILTERS, overwrite=True)

    def _insert(self, rows: DataFrame, table: str, overwrite: bool) -> None:
        ordered = rows.select(*self.warehouse.table(table).columns)
        if table == KEYS:
            ordered = ordered.repartition("shard", "order_id") if overwrite else ordered.hint("rebalance", "shard")
        with self.warehouse._overwrite_mode("dynamic"):
            ordered.write.insertInto(self.warehouse._name(table), overwrite=overwrite)

    def rebuild(self, expected: int | None = None) -> None:
        """Both tables from the stored transactions, for ``expected`` keys where given."""
        self.expected = expected or self.expected
        for table in (KEYS, FILTERS):
            self._forget(table)
        self._create()
        self.add(self.warehouse.table(TRANSACTIONS).select("order_id"))
        self._forget(STEPS)
        self.warehouse.create_table(STEPS, STEPS_SCHEMA, [])

    def _forget(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.warehouse._name(table)}")
        remove_folder(self.spark, f"{self.warehouse.root}/{table}")
