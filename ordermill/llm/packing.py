"""Best-fit packing by minimum bin slack, planned on the histogram of lengths.

1. Texts are encoded once and cut into pieces of at most LIMIT tokens.  Each task numbers the pieces of a length it
   meets; the numbered pieces (a few numbers each, no ids unless asked for) are written once, so that the numbers stay.
2. The counts of lengths, at most LIMIT rows whatever the corpus, come to the driver, where bins are planned: the
   longest piece left opens a bin; a subset-sum table over the other lengths left, one bitset per length, tells the
   fullest feasible combination; of those the one with the longest pieces is read off and removed.  As long as the
   pieces for it last, the next bin would be the same, so all such bins are planned at once, and the number of
   tables depends on the number of lengths, not of documents.  Filling every bin to the last token can use up the
   short pieces too early, so further plans let a bin be a few tokens less full, and the best plan is taken.
3. The plan is a table of ranges: pieces number r to s of a length go, m to a bin, to bins b, b + 1, ... at a place.
   Counts per task and length, summed up over the tasks before, turn a task's numbers into numbers of the corpus,
   and each piece looks its bin up.  Nothing is sorted or gathered as a whole, and no length is a hot key: a length is
   joined by (task, length).

Cases: a null or empty text has no tokens of its own and is one piece (the end token); rows with equal ids or texts are
packed each; an empty table gives an empty result; other columns are ignored; texts of any length are encoded whole.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from ordermill.llm.shared import doc_texts, each, free_names, stage

LIMIT = 1_024  # tokens in a sequence
END = 2  # the id after each document
SLACKS = (0, 2, 8, 32)  # planned with each; the plan with the fewest bins is taken, the first of equal ones


# -- encoding ------------------------------------------------------------------------------------


def _byte_of() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: printable ones stand for themselves, the others
    for the letters from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def vocabulary_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a byte-level BPE file (JSON) whose ids are in the order of its merges.

    ValueError where they are not, as merging by id would then differ from merging by the file's list.
    """
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    special = {token["content"] for token in whole.get("added_tokens", [])}
    vocabulary, byte_of = whole["model"]["vocab"], _byte_of()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in whole["model"]["merges"]]
    merged = [vocabulary[left + right] for left, right in pairs]
    if any(a >= b for a, b in zip(merged, merged[1:])):
        raise ValueError(f"{path}: ids are not in the order of the merges")
    return {bytes(map(byte_of.__getitem__, token)): i for token, i in vocabulary.items() if token not in special}


def _encoder(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=vocabulary_ranks(path), special_tokens={})


def cut(size: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``size`` tokens: only the first may be shorter than the limit."""
    first = size % limit or min(size, limit)
    return [(0, first)] + [(start, limit) for start in range(first, size, limit)]


def cut_documents(docs: DataFrame, path: str, pattern: str, limit: int = LIMIT, end: int = END, with_ids: bool = False) -> DataFrame:
    """The pieces of each document: doc_id, piece, start, length, ids_crc32, and ids where asked for."""
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path, pattern).encode_to_numpy
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), each(batch.column(1))):
                ids = np.append(encode(text), end).astype("<u4")
                for piece, (start, length) in enumerate(cut(len(ids), limit)):
                    some = ids[start : start + length]
                    rows.append((doc_id, piece, start, length, zlib.crc32(some.tobytes()), *([some.astype(np.int32)] * with_ids)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return doc_texts(docs).mapInArrow(run, ddl)


# -- planning ------------------------------------------------------------------------------------


def _fullest(left: dict[int, int], room: int, slack: int = 0) -> dict[int, int]:
    """Of the lengths left, the combination within ``room`` that is fullest, or ``slack`` less; of such combinations
    the one with the longest pieces."""
    lengths = sorted(length for length, n in left.items() if n and length <= room)
    mask, reach = (1 << (room + 1)) - 1, [1]  # bit s: a sum of s can be made
    for length in lengths:
        sums, rest, step = reach[-1], min(left[length], room // length), 1
        while rest:
            step = min(step, rest)
            sums |= (sums << (step * length)) & mask
            rest, step = rest - step, step * 2
        reach.append(sums)
    most = reach[-1].bit_length() - 1
    fewest, taken = max(0, most - slack), {}
    for at in range(len(lengths) - 1, -1, -1):
        length = lengths[at]
        n = min(left[length], most // length)
        while True:  # shorter pieces must make up a sum between the bounds
            low, high = max(0, fewest - n * length), most - n * length
            if reach[at] >> low & ((1 << (high - low + 1)) - 1):
                break
            n -= 1
        fewest, most = low, high
        if n:
            taken[length] = n
    return taken


Range = tuple[int, int, int, int, int, int]


def _plan(histogram: dict[int, int], limit: int, slack: int) -> tuple[int, list[Range]]:
    """The number of bins and their ranges."""
    left, used = dict(histogram), dict.fromkeys(histogram, 0)
    plan, sequence = [], 0
    for longest in sorted(left, reverse=True):
        while left[longest]:
            left[longest] -= 1
            bin_ = _fullest(left, limit - longest, slack)
            left[longest] += 1
            bin_[longest] = bin_.get(longest, 0) + 1
            bins = min(left[length] // n for length, n in bin_.items())
            offset = 0
            for length, n in sorted(bin_.items(), reverse=True):
                plan.append((length, used[length], n, bins, sequence, offset))
                used[length] += n * bins
                left[length] -= n * bins
                offset += n * length
            sequence += bins
    return sequence, plan


def plan_bins(histogram: dict[int, int], limit: int) -> list[Range]:
    """Ranges (length, first, each, bins, sequence, offset): of the pieces of a length those from number ``first`` on
    go, ``each`` to a bin, to ``bins`` bins from ``sequence`` on, at ``offset``."""
    if any(not 0 < length <= limit for length in histogram):
        raise ValueError(f"lengths must lie between 1 and {limit}")
    return min((_plan(histogram, limit, slack) for slack in SLACKS), key=lambda found: found[0])[1]


class _Places:
    """Where the pieces of a plan go, by length and number."""

    def __init__(self, plan: list[tuple[int, ...]]):
        table = np.array(sorted(plan), np.int64).reshape(-1, 6)
        self.ranges, starts = {}, np.flatnonzero(np.append(True, table[1:, 0] != table[:-1, 0])) if len(table) else []
        for some in np.split(table, starts[1:]) if len(table) else []:
            self.ranges[int(some[0, 0])] = some.T[1:]

    def of(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each piece."""
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        order = np.argsort(lengths, kind="stable")
        new = np.flatnonzero(np.diff(lengths[order], prepend=-1))
        for some in np.split(order, new[1:]) if len(order) else []:
            length = int(lengths[some[0]])
            first, each_, _, base, place = self.ranges[length]
            at = np.searchsorted(first, numbers[some], side="right") - 1
            within = numbers[some] - first[at]
            sequence[some] = base[at] + within // each_[at]
            offset[some] = place[at] + within % each_[at] * length
        return sequence, offset


# -- placing -------------------------------------------------------------------------------------


def pack(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``pieces`` (any rows with a ``length`` from 1 to ``limit``) with sequence_id and offset.

    Columns of these names in ``pieces`` are replaced.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset").withColumn("length", F.col("length").cast("long"))
    task, number, before = free_names(pieces, "task", "number", "before")
    at = pieces.columns.index("length")
    schema = StructType([*pieces.schema.fields, StructField(task, LongType()), StructField(number, LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, here = np.zeros(limit + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            lengths = batch.column(at).fill_null(0).to_numpy(zero_copy_only=False)
            if len(lengths) and not 0 < lengths.min() <= lengths.max() <= limit:
                raise ValueError(f"lengths must lie between 1 and {limit}")
            order = np.argsort(lengths, kind="stable")
            run = lengths[order]
            first = np.flatnonzero(np.diff(run, prepend=-1))
            numbers = np.empty(len(run), np.int64)
            numbers[order] = met[run] + np.arange(len(run)) - np.repeat(first, np.diff(np.append(first, len(run))))
            met += np.bincount(lengths, minlength=limit + 1)
            columns = [*batch.columns, pa.array(np.full(len(run), here, np.int64)), pa.array(numbers)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, task, number])

    numbered = stage(pieces.mapInArrow(count, schema), "pieces")
    counts = numbered.groupBy(task, "length").agg(F.count(F.lit(1)).alias(before))
    histogram = counts.groupBy("length").agg(F.sum(before)).collect()  # at most ``limit`` rows
    places = spark.sparkContext.broadcast(_Places(plan_bins({length: n for length, n in histogram}, limit)))

    earlier = Window.partitionBy("length").orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    whole = numbered.join(counts, [task, "length"]).withColumn(number, F.col(number) + F.col(before))
    whole = whole.select(*[f"`{c}`" for c in pieces.columns], number)
    placed = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, numbers = batch.columns
            found = places.value.of(columns[at].to_numpy(), numbers.to_numpy())
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, found)], [*batch.schema.names[:-1], "sequence_id", "offset"])

    return whole.mapInArrow(place, placed)


def packed_sequences(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The sequences themselves: sequence_id, doc_ids and ids, from pieces with their ids.

    A sequence is a group of at most ``limit`` tokens.
    """
    inside = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return (
        pack(pieces, limit)
        .groupBy("sequence_id")
        .agg(inside.alias("inside"))
        .select("sequence_id", F.col("inside.doc_id").alias("doc_ids"), F.flatten("inside.ids").alias("ids"))
    )
