"""The first line of every file, from a bounded number of bytes of each.

Spark's readers prune no splits by their place in a file, so a filter on it reads every file whole.  Here each file is
one short read in a task; names and lines stay a distributed table.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.sources.places import place_columns

READ = 1 << 16  # bytes read at first, doubled while no line end is found
LONGEST = 1 << 24  # bytes a first line may have


def _store_of(path: str):
    """The store a file lies in, and its name there."""
    from pyarrow import fs

    if path.startswith("file:") or ":" not in path.split("/", 1)[0]:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(quote(path, safe=":/@"))


def first_line(stream) -> tuple[str, int]:
    """The text up to the first line end of an open stream, and how many bytes were read."""
    data = b""
    while len(data) < LONGEST:
        more = stream.read(max(READ, len(data)))
        data += more
        if not more or b"\n" in more or b"\r" in more:
            break
    else:
        raise ValueError(f"the first line has over {LONGEST} bytes")
    return data.replace(b"\r", b"\n").split(b"\n", 1)[0].decode("utf-8", errors="replace"), len(data)


def _read_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for path in batch.column(0).to_pylist():
            store, name = _store_of(path)
            with store.open_input_stream(name, compression="detect", buffer_size=READ) as stream:
                found.append(first_line(stream))
        lines, sizes = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.string()), pa.array(sizes, pa.int64())], ["path", "header", "bytes"])


def _within_reach(path: str | None) -> bool:
    """Whether files of this kind of store can be opened apart from Spark's readers."""
    try:
        return path is None or _store_of(path) is not None
    except Exception:  # no such store here, or no library for it
        return False


def read_heads(files: DataFrame) -> DataFrame:
    """path, header and bytes (read) of every ``path`` of ``files``."""
    return files.select("path").mapInArrow(_read_heads, "path string, header string, bytes long")


def first_lines(files: DataFrame) -> DataFrame:
    """path and header (the first line) of every ``path`` of ``files``.

    Where the store cannot be reached so, the lines come from a pass over the text.
    """
    some = files.select("path").first()
    if _within_reach(some and some.path):
        return read_heads(files).select("path", "header")
    spark = files.sparkSession
    names = [row.path for row in files.select("path").toLocalIterator()]
    lines = spark.read.text(names).select("value", *place_columns()).where("_block = 0")
    numbered = lines.withColumn("_row", F.monotonically_increasing_id())
    per_file = numbered.groupBy("_file").agg(F.min_by("value", "_row").alias("header"))
    as_name = F.udf(unquote, "string")
    return per_file.select(as_name("_file").alias("path"), "header")
