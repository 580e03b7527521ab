"""Hard negatives by exact integer products: Strassen multiplication over tiles, heaps that merge.

Vectors become whole numbers, floor(scale * x), so that every score is an exact integer and ties are real ties.

1. Rows are written once as *tiles*: up to TILE rows as one compressed matrix with their ids and labels.  A row is
   named by its tile and its place there, so rows that share an id stay apart.
2. Anchors are taken out of the tiles.  Groups of anchor tiles and groups of candidate tiles span a grid; a
   *cell* of the grid gets one group of each, so that no task holds more than ANCHORS + CANDIDATES rows, and
   the whole anchor set is never sent to a task.  Inside a cell the tiles are padded with zeros to one length and
   multiplied by Strassen's recursion in 64-bit integers.  Its additions may wrap around, which is harmless: the
   result is exact modulo 2**64, and scores fit (see below).
3. First run: each cell keeps, for every anchor, a heap of its best rows of the same label.  The heaps of all cells
   are merged by a row limit per anchor, which Spark applies before and after the shuffle.
4. Second run: the scores of an anchor's positives give its windows.  Each cell keeps a heap per anchor and
   positive of the best rows of another label inside the window; these heaps are merged likewise.

The products of all anchors with all rows are the task itself.  Each is computed once per run, and what travels is
tiles (candidates once per anchor group, anchors once per candidate group) and heaps of a few rows.

Cases: a row with a null label, a null vector, or any null or non-finite component takes no part; a shorter vector
is filled up with zeros; a vector without components scores 0; rows without an id can be found but come last among
equal scores; rows that share an id are separate rows and each counts; equal scores go by smaller id; an empty
table, or one without anchors, gives an empty result; other columns are ignored.  A vector whose integer form has a
squared length of 2**62 or more raises ValueError, as its scores do not fit 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ordermill.llm.shared import from_bytes, partitions, stage, to_bytes

TILE = 2_048  # rows
VALUES = 1 << 20  # numbers in a tile, where vectors are long
ANCHORS, CANDIDATES = 16_384, 65_536  # rows that one cell may hold of either, about
CHUNK = 1_024  # anchors multiplied at once
LEAF = 32  # below this the recursion ends
LOWEST = np.iinfo(np.int64).min
SCALE = 256

_TILES = "tile long, n int, anchors int, payload binary"
_ROW = [("tile", pa.int64()), ("pos", pa.int32()), ("anchor_id", pa.int64())]
_POSITIVE = pa.schema([*_ROW, ("score", pa.int64()), ("other_id", pa.int64())])
_POSITIVE_DDL = "tile long, pos int, anchor_id long, score long, other_id long"
_NEGATIVE = pa.schema([*_ROW, ("nth", pa.int32()), ("score", pa.int64()), ("other_id", pa.int64())])
_NEGATIVE_DDL = "tile long, pos int, anchor_id long, nth int, score long, other_id long"


# -- products ------------------------------------------------------------------------------------


def _quarters(x: np.ndarray, rows: int, columns: int) -> tuple[np.ndarray, ...]:
    if x.shape != (2 * rows, 2 * columns):
        padded = np.zeros((2 * rows, 2 * columns), np.int64)
        padded[: x.shape[0], : x.shape[1]] = x
        x = padded
    return x[:rows, :columns], x[:rows, columns:], x[rows:, :columns], x[rows:, columns:]


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices modulo 2**64, with seven products of quarters in place of eight."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    rows, inner, columns = (m + 1) // 2, (k + 1) // 2, (n + 1) // 2
    a11, a12, a21, a22 = _quarters(a, rows, inner)
    b11, b12, b21, b22 = _quarters(b, inner, columns)
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * rows, 2 * columns), np.int64)
    out[:rows, :columns] = p1 + p4 - p5 + p7
    out[:rows, columns:] = p3 + p5
    out[rows:, :columns] = p2 + p4
    out[rows:, columns:] = p1 - p2 + p3 + p6
    return out[:m, :n]


# -- tiles ---------------------------------------------------------------------------------------


def _whole_numbers(vectors: pa.Array, scale: float) -> np.ndarray:
    """floor(scale * x) of every component, rows filled up with zeros to the longest."""
    flat = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    rows, width = len(sizes), int(sizes.max(initial=0))
    out = np.zeros((rows, width))
    row = np.repeat(np.arange(rows), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    if rows and width and np.max(np.sum(out * out, axis=1)) >= 2.0**62:
        raise ValueError("a vector is too long for scores of 64 bits")
    return out.astype(np.int64)


def _narrow(matrix: np.ndarray) -> pa.Array:
    """A matrix as lists of the shortest integer type that holds it."""
    top = int(np.abs(matrix).max(initial=0))
    kind = next(t for t in (np.int16, np.int32, np.int64) if top <= np.iinfo(t).max)
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(matrix.ravel().astype(kind)))


class _Tile:
    """Rows with their ids, labels, places and vectors."""

    def __init__(self, tile: int, payload: bytes):
        batch = from_bytes(payload)
        ids = batch.column("vec_id")
        self.tile = tile
        self.missing = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        self.labels = batch.column("label").to_numpy()
        self.pos = batch.column("pos").to_numpy()
        vectors = batch.column("vector")
        self.matrix = vectors.flatten().to_numpy().astype(np.int64).reshape(len(self.ids), -1) if len(vectors) else np.zeros((0, 0), np.int64)
        self.extra = {name: batch.column(name) for name in batch.schema.names}


def _payload(ids: pa.Array, labels: np.ndarray, pos: np.ndarray, matrix: np.ndarray, **extra) -> bytes:
    return to_bytes(vec_id=ids, label=pa.array(labels), pos=pa.array(pos.astype(np.int32)), vector=_narrow(matrix), **extra)


def _write_tiles(vectors: DataFrame, scale: float, rows: int) -> DataFrame:
    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                longest = int(batch.column(3).slice(at, rows).value_lengths().to_numpy(zero_copy_only=False).max())
                part = batch.slice(at, max(1, min(rows, VALUES // max(1, longest))))
                anchors = part.column(2)
                payload = _payload(
                    part.column(0),
                    part.column(1).to_numpy(),
                    np.arange(part.num_rows),
                    _whole_numbers(part.column(3), scale),
                    anchor=anchors,
                )
                row = [[number], [part.num_rows], [int(anchors.to_numpy(zero_copy_only=False).sum())], [payload]]
                types = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], ["tile", "n", "anchors", "payload"])
                at, number = at + part.num_rows, number + 1

    return stage(vectors.mapInArrow(tiles, _TILES), "tiles")


def _anchor_tiles(tiles: DataFrame) -> DataFrame:
    """The anchors of each tile that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for tile, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                some = _Tile(tile, payload)
                at = np.flatnonzero(some.extra["anchor"].to_numpy(zero_copy_only=False))
                out.append(_payload(some.extra["vec_id"].take(pa.array(at)), some.labels[at], some.pos[at], some.matrix[at]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["tile", "payload"])

    return tiles.where("anchors > 0").select("tile", "payload").mapInArrow(run, "tile long, payload binary")


# -- heaps ---------------------------------------------------------------------------------------


class _Heaps:
    """The first ``size`` rows of each of ``groups`` groups: highest score, then smallest id, missing ids last."""

    def __init__(self, groups: int, size: int):
        self.size = size
        self.floor = np.full(groups, LOWEST)  # the last score of a full heap; lower ones need not be added
        self.group, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))
        self.missing = np.zeros(0, bool)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        if not len(group):
            return
        group, score = np.concatenate([self.group, group]), np.concatenate([self.score, score])
        ids, missing = np.concatenate([self.ids, ids]), np.concatenate([self.missing, missing])
        order = np.lexsort((ids, missing, -score, group))
        group = group[order]
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        place = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
        kept = place < self.size
        order = order[kept]
        self.group, self.score, self.ids, self.missing = group[kept], score[order], ids[order], missing[order]
        full = place[kept] == self.size - 1
        self.floor[self.group[full]] = self.score[full]

    def merged(self, schema: pa.Schema, **columns: np.ndarray) -> pa.Table:
        """The rows kept; ``columns`` hold a value per group."""
        columns = {name: pa.array(values).take(pa.array(self.group)) for name, values in columns.items()}
        columns["score"], columns["other_id"] = pa.array(self.score), pa.array(self.ids, mask=self.missing)
        return pa.table([columns[f.name].cast(f.type) for f in schema], schema=schema)


class _Anchors:
    """The anchors of a cell, one after another."""

    def __init__(self, tiles: list[_Tile], width: int):
        self.tile = np.concatenate([np.full(len(t.ids), t.tile) for t in tiles])
        self.pos = np.concatenate([t.pos for t in tiles])
        self.labels = np.concatenate([t.labels for t in tiles])
        self.ids = np.concatenate([t.ids for t in tiles])
        self.matrix = np.concatenate([_widened(t.matrix, width) for t in tiles])


def _widened(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


def _cell(anchors: pa.Table, candidates: pa.Table) -> tuple[list[_Tile], list[_Tile], int]:
    rows = [[_Tile(t, p) for t, p in zip(x.column("tile").to_pylist(), x.column("payload").to_pylist())] for x in (anchors, candidates)]
    return *rows, max((t.matrix.shape[1] for side in rows for t in side), default=0)


def _products(anchors: _Anchors, candidates: list[_Tile], width: int) -> Iterator[tuple[int, _Tile, np.ndarray]]:
    """For chunks of anchors and each candidate tile: the first anchor's number, the tile, and their scores."""
    for tile in candidates:
        turned = np.ascontiguousarray(_widened(tile.matrix, width).T)
        for at in range(0, len(anchors.ids), CHUNK):
            yield at, tile, strassen(anchors.matrix[at : at + CHUNK], turned)


def _positives_of_cell(size: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        anchor_tiles, candidates, width = _cell(left, right)
        if not anchor_tiles or not candidates:
            return _POSITIVE.empty_table()
        anchors = _Anchors(anchor_tiles, width)
        heaps = _Heaps(len(anchors.ids), size)
        for at, tile, scores in _products(anchors, candidates, width):
            some = slice(at, at + len(scores))
            wanted = (anchors.labels[some, None] == tile.labels) & (scores >= heaps.floor[some, None])
            own = np.flatnonzero(anchors.tile[some] == tile.tile)
            wanted[own, anchors.pos[some][own]] = False  # a tile's rows stand at their places
            row, column = np.nonzero(wanted)
            heaps.add(at + row, scores[row, column], tile.ids[column], tile.missing[column])
        return heaps.merged(_POSITIVE, tile=anchors.tile, pos=anchors.pos, anchor_id=anchors.ids)

    return run


def _window(score: int, low: tuple[int, int], high: tuple[int, int]) -> tuple[int, int]:
    """The whole numbers n with low * score <= n <= high * score, the factors being fractions."""
    return -((-low[0] * score) // low[1]), (high[0] * score) // high[1]


def _with_windows(low: tuple[int, int], high: tuple[int, int], size: int):
    """Anchor tiles with the windows of their positives, from the positives of each tile."""

    def run(anchors: pa.Table, positives: pa.Table) -> pa.Table:
        out = []
        for tile, payload in zip(anchors.column("tile").to_pylist(), anchors.column("payload").to_pylist()):
            some = _Tile(tile, payload)
            bounds = np.zeros((2, size, len(some.ids)), np.int64)
            bounds[0], bounds[1] = 1, 0  # an empty window where there are fewer positives
            place = {pos: at for at, pos in enumerate(some.pos.tolist())}
            for pos, nth, score in zip(*(positives.column(c).to_pylist() for c in ("pos", "nth", "score"))):
                least, most = _window(score, low, high)
                bounds[:, nth - 1, place[pos]] = max(least, LOWEST), min(most, np.iinfo(np.int64).max)
            columns = {f"{name}{nth}": bounds[side, nth] for side, name in enumerate(("least", "most")) for nth in range(size)}
            out.append(_payload(some.extra["vec_id"], some.labels, some.pos, some.matrix, **columns))
        return pa.table({"tile": anchors.column("tile"), "payload": pa.array(out, pa.binary())})

    return run


def _negatives_of_cell(positives: int, size: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        anchor_tiles, candidates, width = _cell(left, right)
        if not anchor_tiles or not candidates:
            return _NEGATIVE.empty_table()
        anchors = _Anchors(anchor_tiles, width)
        least, most = (
            np.array([np.concatenate([t.extra[f"{name}{nth}"].to_numpy() for t in anchor_tiles]) for nth in range(positives)])
            for name in ("least", "most")
        )
        n = len(anchors.ids)
        heaps = _Heaps(n * positives, size)  # group = positive * n + anchor
        for at, tile, scores in _products(anchors, candidates, width):
            some = slice(at, at + len(scores))
            floors = np.maximum(least[:, some], heaps.floor.reshape(positives, n)[:, some])
            open_ = floors <= most[:, some]
            lowest = np.where(open_, floors, np.iinfo(np.int64).max).min(axis=0)
            highest = np.where(open_, most[:, some], LOWEST).max(axis=0)
            other = anchors.labels[some, None] != tile.labels
            row, column = np.nonzero(other & (scores >= lowest[:, None]) & (scores <= highest[:, None]))
            found = scores[row, column]
            nth, which = np.nonzero((found >= floors[:, row]) & (found <= most[:, at + row]))
            row, column, found = row[which], column[which], found[which]
            heaps.add(nth * n + at + row, found, tile.ids[column], tile.missing[column])
        spread = {"tile": anchors.tile, "pos": anchors.pos, "anchor_id": anchors.ids}
        columns = {name: np.tile(values, positives) for name, values in spread.items()}
        return heaps.merged(_NEGATIVE, nth=np.repeat(np.arange(1, positives + 1), n), **columns)

    return run


# -- grid ----------------------------------------------------------------------------------------


def _grouped(tiles: DataFrame, rows: int, most: int, least_groups: int) -> tuple[Column, int]:
    """A group for each tile, so that a group has about ``most`` rows, and the number of groups."""
    groups = max(1, math.ceil(rows / most), least_groups)
    return F.pmod(F.xxhash64("tile"), F.lit(groups)), groups


def _cells(left: DataFrame, right: DataFrame, a_groups: tuple[Column, int], c_groups: tuple[Column, int], run, schema: str) -> DataFrame:
    """``run`` on every cell of the grid of anchor groups and candidate groups."""
    (a_group, a_count), (c_group, c_count) = a_groups, c_groups
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    left = left.select(a_group.alias("a"), every(c_count).alias("c"), "tile", "payload")
    right = right.select(every(a_count).alias("a"), c_group.alias("c"), "tile", "payload")
    return left.groupBy("a", "c").cogroup(right.groupBy("a", "c")).applyInArrow(lambda x, y: run(x, y), schema)


def _first(heaps: DataFrame, size: int, *keys: str) -> DataFrame:
    """The merged heaps: the first rows of each key, numbered."""
    order = [F.col("score").desc(), F.col("other_id").asc_nulls_last()]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return heaps.withColumn("place", place).where(F.col("place") <= size)


def hard_negatives(
    vectors: DataFrame,
    positives: int = 5,
    negatives: int = 5,
    low: tuple[int, int] = (80, 100),
    high: tuple[int, int] = (100, 100),
    scale: float = SCALE,
) -> DataFrame:
    """Hard negatives of the anchors among ``vectors`` (vec_id, label, anchor, vector).

    An anchor's positives are the first rows of its label, itself left out; a negative of an anchor and a positive
    has another label and a score between ``low`` and ``high`` (fractions) times the positive's.  Returns
    anchor_id, positive_id, rank (from 1, among the negatives of this pair), negative_id and both scores.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.coalesce(F.col("anchor").cast("boolean"), F.lit(False)).alias("anchor"),
        F.col("vector").cast("array<double>").alias("vector"),
    )
    unusable = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    tiles = _write_tiles(rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & ~unusable), scale, TILE)
    n, n_anchors, n_tiles = tiles.agg(F.sum("n"), F.sum("anchors"), F.count(F.lit(1))).first()[:]
    anchors = stage(_anchor_tiles(tiles), "anchors")
    candidates = tiles.select("tile", "payload")
    a_groups = _grouped(anchors, n_anchors or 0, ANCHORS, 1)
    c_groups = _grouped(candidates, n or 0, CANDIDATES, min(n_tiles, 4 * partitions(spark)))

    found = _cells(anchors, candidates, a_groups, c_groups, _positives_of_cell(positives), _POSITIVE_DDL)
    best = stage(_first(found, positives, "tile", "pos").withColumnRenamed("place", "nth"), "positives")

    windows = anchors.groupBy("tile").cogroup(best.groupBy("tile")).applyInArrow(_with_windows(low, high, positives), "tile long, payload binary")
    windows = stage(windows, "windows")
    found = _cells(windows, candidates, a_groups, c_groups, _negatives_of_cell(positives, negatives), _NEGATIVE_DDL)
    mined = _first(found, negatives, "tile", "pos", "nth").withColumnsRenamed({"score": "negative_score", "other_id": "negative_id", "place": "rank"})
    known = best.select("tile", "pos", "nth", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return mined.join(known, ["tile", "pos", "nth"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
