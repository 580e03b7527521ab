"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers.

Every document gets a row number 0..N-1 that depends on nothing but the rows themselves.  A keyed
permutation of 0..N-1 maps it to a position; shard and slot are the position's remainder and quotient by
the number of shards, so both can be computed from the row number alone, and the document at any shard
and slot can be found by the inverse.  Shard sizes in rows differ by at most one (law ``rows``).

The permutation is an unbalanced Feistel network over a*b >= N with a = ceil(sqrt(N)): it alternates
``left += f(right) mod a`` and ``right += f(left) mod b``.  Fewer than a values lie outside 0..N-1; those
are walked on until they fall inside, which a walk from inside always does.

Row numbers come without a global sort: rows are dealt to buckets by a hash, ranked in their bucket, and
a bucket's first number is the count of all rows in lower buckets (a table of BUCKETS rows).  Equal rows
(same id, size and checksum) are counted before any shuffle and numbered as a run, so that no repeated
row is hot.  Only ids, sizes and checksums move, never texts.

Cases: a null text has no bytes (size 16, crc32 of the empty text); a null doc_id is an id like any
other; rows equal in all three get neighbouring row numbers, in no particular order; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ordermill.llm.shared import partitions, stage, text_of

SHARDS = 40
BUCKETS = 4096
ROUNDS = 4
SEED = 20240607
ROW_OVERHEAD = 16
RUN = 1 << 16  # repeated rows are unfolded in runs of this many
WALK = 16  # steps tried in one go where the exact bound is larger; see walk_length


def _mix(value: Column, key: int, below: int) -> Column:
    """The round function: a keyed hash of the other half."""
    return F.pmod(F.xxhash64(F.lit(key), value), F.lit(below).cast("long"))


def feistel(value: Column, a: int, b: int, seed: int = SEED) -> Column:
    """One pass of the network over 0..a*b-1, as SQL expressions over plain columns."""
    right = value % b
    left = F.floor((value - right) / b)  # exact: the quotient is whole and far below 2**53
    for number in range(ROUNDS):
        if number % 2 == 0:
            left = (left + _mix(right, seed + number, a)) % a
        else:
            right = (right + _mix(left, seed + number, b)) % b
    return left * F.lit(b) + right


def walk_length(n: int, a: int, b: int) -> int:
    """Steps after which a walk is inside for certain, or WALK where that bound is large.

    With a*b-n < a values outside of more than 2**12, more than WALK steps in a row outside have a
    probability below (1/a)**WALK < 2**-96 per row; permute() raises rather than return such a row.
    """
    exact = a * b - n + 1
    return exact if n <= 4096 else min(exact, WALK)


def permute(df: DataFrame, column: str, n: int, seed: int = SEED) -> DataFrame:
    """Adds ``position``: the place of row number ``column`` under the permutation of 0..n-1."""
    if n < 2:
        return df.withColumn("position", F.col(column))
    a = math.isqrt(n - 1) + 1
    b = -(-n // a)
    steps = F.sequence(F.lit(1), F.lit(walk_length(n, a, b)))
    first = df.withColumn("position", feistel(F.col(column), a, b, seed))
    walked = F.when(F.col("position") < n, F.col("position")).otherwise(
        F.aggregate(steps, F.col("position"), lambda at, _: F.when(at < n, at).otherwise(feistel(at, a, b, seed)))
    )
    inside = F.when(F.col("walked") < n, F.col("walked")).otherwise(
        F.raise_error(F.lit("a cycle walk did not end; use another seed")).cast("long")
    )
    return first.withColumn("walked", walked).withColumn("position", inside).drop("walked")


def number_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``row_number`` 0..N-1, a function of the multiset of their ``keys`` alone."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    counted = counted.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int"))
    counted = stage(counted, "row-counts")
    sizes = counted.groupBy("bucket").agg(F.sum("copies").alias("size"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    rank = Window.partitionBy("bucket").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("offset", F.coalesce(F.sum("copies").over(rank), F.lit(0)))
    placed = placed.join(F.broadcast(starts), "bucket")  # at most BUCKETS rows
    first = F.col("start") + F.col("offset")
    # Rows with more copies than a run are unfolded run by run; a given number of partitions, so that these few small
    # rows are not brought together again before they are unfolded.
    unfold = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(RUN).cast("long")))
    single = placed.where(F.col("copies") <= RUN).withColumn("run", F.lit(0).cast("long"))
    runs = single.unionByName(placed.where(F.col("copies") > RUN).withColumn("run", unfold).repartition(partitions(rows.sparkSession), *keys, "run"))
    last = F.least(F.col("run") + RUN, F.col("copies")) - 1
    each = runs.withColumn("at", F.explode(F.sequence(F.col("run"), last)))
    return each.withColumn("row_number", first + F.col("at")).select(*keys, "row_number")


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Shard and slot of every document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = text_of(docs)
    narrow = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    numbered = number_rows(narrow, ["doc_id", "size", "text_crc32"])
    numbered = stage(numbered, "row-numbers")
    placed = permute(numbered, "row_number", numbered.count(), seed)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("position") % shards).cast("int").alias("shard"),
        ((F.col("position") - F.col("position") % shards) / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
