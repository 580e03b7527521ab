"""Helpers the training-data operators share: the folder all executors see, and words as bytes."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The word separators of the contracts: blank, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a session without one (tests) gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="ordermill-llm-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


_new_paths: list[str] = []


def new_path(spark: SparkSession, purpose: str) -> str:
    path = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    _new_paths.append(path)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Removes a folder that ``new_path`` named, in whatever store it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession):
    """What operators stage inside the block is removed at its end, so write results before it ends."""
    before = len(_new_paths)
    try:
        yield
    finally:
        while len(_new_paths) > before:
            drop_path(spark, _new_paths.pop())


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, pins row ids, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def short_batches(spark: SparkSession, rows: int = 2000) -> None:
    """At most ``rows`` rows to an Arrow batch of this session: texts are long, and a batch is held several times over."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(setting))
    if not 0 < now <= rows:
        spark.conf.set(setting, str(rows))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(df: DataFrame) -> Column:
    """The text of a document, empty where it is null."""
    return F.coalesce(df["text"].cast("string"), F.lit(""))


def doc_texts(docs: DataFrame) -> DataFrame:
    """Only doc_id and text, whatever other columns the documents have."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))


SENT_ROWS = 1_000_000  # rows of a few numbers that may be sent to all tasks


def row_keys(docs: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row's doc_id and text: rows that agree in both are copies under one id, or under none."""
    doc_id, text = docs["doc_id"].cast("long"), text_of(docs)
    return F.xxhash64(doc_id, text), F.xxhash64(F.lit("second"), doc_id, text)


def same_row(docs: DataFrame, node: str, second: str) -> Column:
    """Whether a row of ``docs`` is the one that a node (its first hash, or its second) and the second hash name."""
    one, other = row_keys(docs)
    return (other == F.col(second)) & ((one == F.col(node)) | (other == F.col(node)))


def without_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``keys`` (a written table of two columns, see ``same_row``) name.

    Up to SENT_ROWS keys are sent to the documents, so that texts do not move; more are joined by shuffle.
    """
    names = free_names(docs, "left_out", "left_out_too")
    left_out = keys.toDF(*names)
    if left_out.count() <= SENT_ROWS:
        left_out = F.broadcast(left_out)
    return docs.join(left_out, same_row(docs, *names), "left_anti")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that ``df`` does not have yet, whatever the case of its own."""
    taken = {name.lower() for name in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def to_bytes(**columns) -> bytes:
    """Columns of one length as one compressed string."""
    batch = pa.record_batch([pa.array(values) if not isinstance(values, pa.Array) else values for values in columns.values()], list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_bytes(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


class WordHashes(dict):
    """64-bit hashes of words, kept for the words seen last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_COMPRESSOR, _DECOMPRESSOR = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def pack_columns(*columns: np.ndarray, data: bytes = b"") -> bytes:
    """Columns of 64-bit numbers of one length, and bytes, as one compressed string: all low bytes first, so that the
    high ones compress away."""
    size = len(columns[0])
    planes = np.concatenate([np.asarray(c).astype(np.int64) for c in columns]).view(np.uint8).reshape(-1, 8).T
    return _COMPRESSOR.compress(size.to_bytes(8, "little") + planes.tobytes() + data)


def unpack_columns(payload: bytes, columns: int) -> tuple[np.ndarray, bytes]:
    raw = _DECOMPRESSOR.decompress(payload)
    size = int.from_bytes(raw[:8], "little")
    end = 8 + 8 * size * columns
    planes = np.frombuffer(raw, np.uint8, 8 * size * columns, 8).reshape(8, -1).T
    return np.ascontiguousarray(planes).view(np.int64).reshape(columns, size), raw[end:]


def by_part(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each part's number and the places that have it, in rising order."""
    if len(part):
        order = np.argsort(part, kind="stable")
        first = np.flatnonzero(np.append(True, part[order][1:] != part[order][:-1]))
        for some in np.split(order, first[1:]):
            yield int(part[some[0]]), some


def each(column: pa.Array, rows: int = 128) -> Iterator:
    """The values of a column, few of them Python objects at a time."""
    for at in range(0, len(column), rows):
        yield from column.slice(at, rows).to_pylist()
