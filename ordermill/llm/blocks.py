"""Documents as blocks of word positions, so that only distinct words travel.

One pass splits each text and writes two kinds of rows to a table in the shared folder:

* a *document* row holds the words of one document in order, each as a number within its block;
* a *word* row holds the distinct words of a block that fall to one part by their hash, packed: their numbers
  in the block, their bytes, and how often counted documents hold them.

Whatever is to be known of a word (its code, its count in the corpus) is worked out part by part, where all
blocks' rows of a word meet, and sent back by block.  The table is bucketed by block, so that joining back
does not move the documents.  It is written once: a lost executor costs a repeated task, not another
numbering.  A word that every document holds is one entry per block, so no word is hot.

A block ends after WORDS words or with its input partition; a longer document is a block of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.shared import doc_texts, each, new_path, partitions

WORDS = 2_000_000

SCHEMA = "block long, doc_id long, payload binary, part int, words binary"
_ARROW = pa.schema(
    [
        ("block", pa.int64()),
        ("doc_id", pa.int64()),
        ("payload", pa.binary()),
        ("part", pa.int32()),
        ("words", pa.binary()),
    ]
)

Split = Callable[[str], list]


class _Numbers(dict):
    """Numbers keys in the order of their first use."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


_COMPRESSOR, _DECOMPRESSOR = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def pack(numbers: np.ndarray) -> bytes:
    """Word numbers as compressed bytes: all low bytes first, so that the high ones compress away."""
    planes = np.ascontiguousarray(numbers, np.int32).view(np.uint8).reshape(-1, 4).T
    return _COMPRESSOR.compress(planes.tobytes())


def unpack(payload: bytes) -> np.ndarray:
    data = _DECOMPRESSOR.decompress(payload)
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(np.int32).ravel()


def pack_words(numbers: np.ndarray, words: list[bytes], n: np.ndarray) -> bytes:
    """A word row: rising numbers, their words and counts."""
    columns = np.concatenate([[len(words)], np.diff(numbers, prepend=0), [len(w) for w in words], n]).astype(np.int64)
    planes = np.ascontiguousarray(columns).view(np.uint8).reshape(-1, 8).T.tobytes()
    return _COMPRESSOR.compress(len(planes).to_bytes(8, "little") + planes + b"".join(words))


def unpack_words(data: bytes) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """The numbers, words and counts of a word row."""
    data = _DECOMPRESSOR.decompress(data)
    end = 8 + int.from_bytes(data[:8], "little")
    planes = np.frombuffer(data, np.uint8, end - 8, 8).reshape(8, -1)
    columns = np.ascontiguousarray(planes.T).view(np.int64).ravel()
    size = int(columns[0])
    numbers, lengths, n = columns[1 : 1 + size], columns[1 + size : 1 + 2 * size], columns[1 + 2 * size :]
    ends = (end + np.cumsum(lengths)).tolist()
    return np.cumsum(numbers), [data[a:b] for a, b in zip([end, *ends], ends)], n


class _Block:
    """The block that is being filled: its words so far, and the documents not yet handed on."""

    def __init__(self, block: int, parts: int):
        self.block, self.parts, self.size = block, parts, 0
        self.numbers, self.counts = _Numbers(), np.zeros(0, np.int64)
        self.ids: list = []
        self.payloads: list[bytes] = []
        self.counted: list[np.ndarray] = []

    def add(self, doc_id: int | None, found: list, counts: bool) -> None:
        at = np.array(list(map(self.numbers.__getitem__, found)), np.int32)
        self.size += len(found)
        self.ids.append(doc_id)
        self.payloads.append(pack(at))
        if counts:
            self.counted.append(at)

    def _batch(self, rows: int, **columns) -> pa.RecordBatch:
        columns["block"] = pa.array(np.full(rows, self.block, np.int64))
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(rows, f.type)) for f in _ARROW], schema=_ARROW)

    def document_rows(self) -> Iterator[pa.RecordBatch]:
        if self.ids:
            ids, payloads = pa.array(self.ids, pa.int64()), pa.array(self.payloads, pa.binary())
            yield self._batch(len(ids), doc_id=ids, payload=payloads)
        if self.counted:
            counts = np.bincount(np.concatenate(self.counted), minlength=len(self.numbers))
            counts[: len(self.counts)] += self.counts
            self.counts = counts
        self.ids, self.payloads, self.counted = [], [], []

    def word_rows(self) -> Iterator[pa.RecordBatch]:
        if not self.numbers:
            return
        words = [w.encode() if isinstance(w, str) else w for w in self.numbers]
        n = np.zeros(len(words), np.int64)
        n[: len(self.counts)] = self.counts
        self.numbers = _Numbers()
        part = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % self.parts
        order = np.argsort(part, kind="stable")
        first = np.flatnonzero(np.diff(part[order], prepend=-1))
        packed = [pack_words(some, [words[i] for i in some], n[some]) for some in np.split(order, first[1:])]
        parts = pa.array(part[order[first]], pa.int32())
        yield self._batch(len(packed), part=parts, words=pa.array(packed, pa.binary()))


def store(rows: DataFrame, purpose: str, column: str) -> tuple[DataFrame, str]:
    """``rows`` written to the shared folder in buckets by ``column``, and the folder they lie in."""
    spark = rows.sparkSession
    path = new_path(spark, purpose)
    name = "blocks_" + path.rsplit("-", 1)[-1]
    writer = rows.write.bucketBy(partitions(spark), column).option("path", path).option("compression", "zstd")
    writer.format("parquet").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay; the frame knows them and their buckets
    return table, path


def store_by_block(rows: DataFrame, purpose: str, column: str = "block") -> DataFrame:
    """``rows`` written to the shared folder in buckets by ``block``, or another column: grouping or joining by it moves
    nothing then."""
    return store(rows, purpose, column)[0]


def write_blocks(
    docs: DataFrame,
    make_split: Callable[[], Split],
    counted: Callable[[int | None], bool] = lambda _: True,
    words: int = WORDS,
) -> tuple[DataFrame, DataFrame]:
    """The document rows (block, doc_id, payload) and word rows (block, part, words) of ``docs``.

    ``make_split()`` gives, once per task, the function from a text to its words (str or bytes).
    ``n`` counts only documents whose id satisfies ``counted``.
    """

    parts = partitions(docs.sparkSession)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = make_split()
        current = _Block(TaskContext.get().partitionId() << 32, parts)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), each(batch.column(1))):
                found = split(text)
                if current.size and current.size + len(found) > words:
                    yield from current.document_rows()
                    yield from current.word_rows()
                    current = _Block(current.block + 1, parts)
                current.add(doc_id, found, counted(doc_id))
            yield from current.document_rows()
        yield from current.word_rows()

    table = store_by_block(doc_texts(docs).mapInArrow(build, SCHEMA), "blocks")
    documents = table.where(F.col("payload").isNotNull()).select("block", "doc_id", "payload")
    return documents, table.where(F.col("words").isNotNull()).select("block", "part", "words")


def send_back(words: DataFrame, value_of: Callable) -> DataFrame:
    """Rows (block, payload) for the blocks: what ``value_of`` makes of each part of the word rows.

    ``value_of(rows)`` gets [(idx, words, n)] of all blocks that have words of one part, and gives one packed
    value for each of them.
    """

    def run(table: pa.Table) -> pa.Table:
        rows = [unpack_words(data) for data in table.column("words").to_pylist()]
        return pa.table({"block": table.column("block"), "payload": pa.array(value_of(rows), pa.binary())})

    return words.groupBy("part").applyInArrow(run, "block long, payload binary")
