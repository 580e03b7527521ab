"""Exact substring dedup: every window of WINDOW words that also starts earlier is removed.

Super-k-mer partitioning: a window's minimiser is the smallest hash among its runs of GRAM words, so equal windows
have equal minimisers.  Consecutive windows that share one travel as one packed string to the part their
minimiser falls to, where sorting finds each window's first occurrence exactly, on the words themselves.

1. Texts are stored once in blocks, bucketed by block, with the starts, sizes and minimisers of each block's
   super-k-mers, so words are hashed once.  The block's distinct minimisers meet by part and are counted; one met
   once in the whole corpus cannot have a repeated window, and its windows go no further.
2. Each block sends its distinct super-k-mers of shared minimisers, each with its earliest place in the block: copies
   inside a block are one string.  The windows of a minimiser met more than HOT times (a passage that
   many documents hold, with their own words around it) go one by one to the part of their own hash instead,
   so that no part gets all of them.
3. A part takes the strings of each minimiser.  Equal ones have their first place in common; where several different
   ones meet, or one may hold a window twice, their windows are sorted.  One bit per window goes back: whether this
   place is the first of all.  The block marks all other places and drops the words they cover.

The number of parts follows from the counted super-k-mers.  Texts never leave their block; only packed strings and
bits do.  "Earlier" is by doc_id, then position.

Cases: a null text has no words; texts shorter than a window keep all; rows that share a doc_id come in the
order in which they were stored, rows without one after all others; an empty table gives an empty result; other
columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.blocks import store_by_block
from ordermill.llm.shared import WordHashes, by_part, doc_texts, each, pack_columns, partitions, unpack_columns

WINDOW = 20
GRAM = 5
HOT = 5_000
WORDS = 1_500_000  # per block
LONGEST = 256  # windows in one super-k-mer
PART = 2_000_000  # super-k-mers whose minimisers meet in one part, about
NO_ID = (1 << 63) - 1

TABLE = "block long, ord int, doc_id long, text string, n long, payload binary"
_TABLE = pa.schema(
    [
        ("block", pa.int64()),
        ("ord", pa.int32()),
        ("doc_id", pa.int64()),
        ("text", pa.string()),
        ("n", pa.int64()),
        ("payload", pa.binary()),
    ]
)
SENT = "block long, part int, payload binary"
OF_KMERS, OF_STRINGS = -1, -2  # in place of a part: rows a block keeps for itself
_FACTORS = (np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_PACK, _UNPACK = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def words_of(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def super_kmers(words: list[bytes], hashes: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, numbers of windows, minimisers and counts of a text's super-k-mers.

    A count is 2 where the minimiser occurs more than once in the text: its windows may repeat within one run.
    """
    n = len(words) - WINDOW + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    h = np.array(list(map(hashes.__getitem__, words)), np.uint64)
    grams = np.zeros(len(h) - GRAM + 1, np.uint64)
    for at in range(GRAM):
        grams += h[at : len(h) - GRAM + 1 + at] * _FACTORS[at]
    grams = (grams ^ (grams >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    grams ^= grams >> np.uint64(32)
    least, width, target = grams, 1, WINDOW - GRAM + 1
    while width < target:
        step = min(width, target - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    new = np.append(True, least[1:] != least[:-1])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, n))
    if sizes.max() > LONGEST:
        pieces = -(-sizes // LONGEST)
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts, ends = np.repeat(starts, pieces) + within * LONGEST, np.repeat(starts + sizes, pieces)
        sizes = np.minimum(ends - starts, LONGEST)
    minimisers = least[starts]
    ordered = np.sort(grams)
    repeated = ordered[1:][ordered[1:] == ordered[:-1]]
    again = np.zeros(len(starts), bool)
    if len(repeated):
        at = np.minimum(np.searchsorted(repeated, minimisers), len(repeated) - 1)
        again = repeated[at] == minimisers
    return starts, sizes, minimisers, 1 + again


def _bits(flags: np.ndarray) -> bytes:
    return _PACK.compress(np.packbits(flags).tobytes())


def _flags(payload: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(_UNPACK.decompress(payload), np.uint8)) > 0


def _sent(block: int, parts: list[int], payloads: list[bytes]) -> pa.Table:
    columns = [pa.array([block] * len(parts), pa.int64()), pa.array(parts, pa.int32()), pa.array(payloads, pa.binary())]
    return pa.table(columns, names=["block", "part", "payload"])


# -- 1. blocks and their minimisers --------------------------------------------------------------


def _write_blocks(docs: DataFrame, words: int) -> DataFrame:
    """A row per document (ord, doc_id, text) and one per block with its n super-k-mers, in order of ord and start."""

    def rows(block: int, size: int, **columns) -> pa.RecordBatch:
        columns["block"] = pa.array(np.full(size, block, np.int64))
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(size, f.type)) for f in _TABLE], schema=_TABLE)

    def kmer_row(block: int, found: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        if found:
            columns = [np.concatenate(column) for column in zip(*found)]
            payload = pack_columns(np.diff(columns[0], prepend=0), *columns[1:3], columns[3].view(np.int64), columns[4])
            yield rows(block, 1, n=pa.array([len(columns[0])], pa.int64()), payload=pa.array([payload], pa.binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, block = WordHashes(), TaskContext.get().partitionId() << 32
        size, number, found = 0, 0, []
        for batch in batches:
            at = 0
            numbers: list[int] = []
            for i, text in enumerate(each(batch.column(1))):
                words_here = words_of(text)
                if size and size + len(words_here) > words:
                    yield rows(block, i - at, ord=pa.array(numbers, pa.int32()), doc_id=batch.column(0)[at:i], text=batch.column(1)[at:i])
                    yield from kmer_row(block, found)
                    at, numbers, block, size, number, found = i, [], block + 1, 0, 0, []
                starts, sizes, minimisers, counts = super_kmers(words_here, hashes)
                if len(starts):
                    found.append((np.full(len(starts), number), starts, sizes, minimisers, counts))
                size += len(words_here)
                numbers.append(number)
                number += 1
            rest = batch.num_rows - at
            yield rows(block, rest, ord=pa.array(numbers, pa.int32()), doc_id=batch.column(0)[at:], text=batch.column(1)[at:])
        yield from kmer_row(block, found)

    return store_by_block(doc_texts(docs).mapInArrow(run, TABLE), "texts")


def _minimisers(parts: int):
    """The distinct minimisers of each block with their counts, dealt to parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                (_, _, _, minimisers, counts), _ = unpack_columns(payload.as_py(), 5)
                values, where = np.unique(minimisers.view(np.uint64), return_inverse=True)
                counts = np.bincount(where, counts).astype(np.int64)
                split = list(by_part((values % np.uint64(parts)).astype(np.int64)))
                packed = [pack_columns(np.diff(values[some].view(np.int64), prepend=0), counts[some]) for _, some in split]
                yield from _sent(block, [part for part, _ in split], packed).to_batches()

    return run


def _shared(table: pa.Table) -> pa.Table:
    """Of one part: for each block its minimisers that the corpus has more than once, and which are hot."""
    steps_of = [unpack_columns(payload, 2)[0] for payload in table.column("payload").to_pylist()]
    values = [np.cumsum(steps) for steps, _ in steps_of]
    every, where = np.unique(np.concatenate(values), return_inverse=True)
    total = np.bincount(where, np.concatenate([counts for _, counts in steps_of]))
    sent = []
    for own in values:
        count = total[np.searchsorted(every, own)]
        kept = count > 1
        sent.append(pack_columns(own[kept], count[kept] > HOT))
    return pa.table({"block": table.column("block"), "part": table.column("part"), "payload": pa.array(sent, pa.binary())})


# -- 2. packed strings ---------------------------------------------------------------------------


class _Block:
    """The documents of a block in order of doc_id, and its super-k-mers that other places may repeat, in that order.

    ``value`` is the minimiser, or 0 where the windows of a hot one go alone; ``bounds`` are a document's in these lists.
    """

    def __init__(self, table: pa.Table, shared: list[bytes]):
        documents = table.filter(table.column("ord").is_valid()).sort_by("ord")
        ids = documents.column("doc_id").fill_null(NO_ID).to_numpy()
        order = np.argsort(ids, kind="stable")
        self.doc_ids, self.ords = ids[order], order
        self.texts = documents.column("text").combine_chunks().take(pa.array(order))
        kmers = [payload for payload in table.column("payload").to_pylist() if payload is not None]
        columns = [unpack_columns(payload, 2)[0] for payload in shared]
        known = np.concatenate(columns, 1) if columns else np.zeros((2, 0), np.int64)
        self.start = self.size = self.value = self.again = np.zeros(0, np.int64)
        self.bounds = np.zeros(len(order) + 1, np.int64)
        if kmers and known.shape[1]:
            self._keep(unpack_columns(kmers[0], 5)[0], known, order)

    def _keep(self, kmers: np.ndarray, known: np.ndarray, order: np.ndarray) -> None:
        steps, start, size, minimiser, count = kmers
        by_value = np.argsort(known[0])
        values, hot = known[0][by_value], known[1][by_value] > 0
        at = np.minimum(np.searchsorted(values, minimiser), len(values) - 1)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        document = rank[np.cumsum(steps)]
        kept = np.flatnonzero(values[at] == minimiser)
        kept = kept[np.argsort(document[kept], kind="stable")]
        hot, document, start, size = hot[at[kept]], document[kept], start[kept], size[kept]
        value, again = np.where(hot, 0, minimiser[kept]), np.where(hot, 0, count[kept] > 1)
        times = np.where(hot, size, 1)
        within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        self.start = np.repeat(start, times) + within
        self.size = np.repeat(np.where(hot, 1, size), times)
        self.value, self.again = np.repeat(value, times), np.repeat(again, times)
        self.bounds = np.searchsorted(np.repeat(document, times), np.arange(len(order) + 1))


def _part_of(value: int, string: bytes, parts: int) -> int:
    return (value % (1 << 64) if value else xxhash.xxh64_intdigest(string)) % parts


def _send(parts: int):
    """The distinct packed strings of a block, one row per part; and for the block itself which of them each of its
    super-k-mers is, and the part each went to.

    Strings are numbered in the order of their first places, and stand in that order in each part's row.
    """

    def run(table: pa.Table, shared: pa.Table) -> pa.Table:
        number = table.column("block")[0].as_py()
        block = _Block(table, shared.column("payload").to_pylist())
        known: dict[tuple[int, bytes], int] = {}
        numbers, part, where = np.zeros(len(block.start), np.int64), [], []
        starts, sizes, values = block.start.tolist(), block.size.tolist(), block.value.tolist()
        for document in np.flatnonzero(np.diff(block.bounds)).tolist():
            words = words_of(block.texts[document].as_py())
            for at in range(block.bounds[document], block.bounds[document + 1]):
                start = starts[at]
                key = (values[at], b" ".join(words[start : start + sizes[at] + WINDOW - 1]))
                numbers[at] = known.setdefault(key, len(known))
                if len(known) > len(part):
                    part.append(_part_of(*key, parts))
                    where.append((at, document))
        if not known:
            return _sent(number, [], [])
        strings = [string for _, string in known]
        part, (first, document) = np.array(part), np.array(where).T
        lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        places = block.doc_ids[document], block.ords[document], block.start[first]
        columns = [block.value[first], lengths, block.size[first], block.again[first], *places]
        split = list(by_part(part))
        payloads = [pack_columns(*[c[some] for c in columns], data=b"".join(map(strings.__getitem__, some.tolist()))) for _, some in split]
        return _sent(number, [OF_KMERS, OF_STRINGS, *[p for p, _ in split]], [pack_columns(numbers), pack_columns(part), *payloads])

    return run


def _first_places(table: pa.Table) -> pa.Table:
    """Of one part: for each block one bit per window of its strings, whether it is the first of all."""
    groups: dict = {}  # by minimiser, or window where hot: distinct strings, each with its first place
    offsets, bits = [], []
    blocks = table.column("block").to_pylist()
    for row, payload in enumerate(table.column("payload").to_pylist()):
        columns, data = unpack_columns(payload, 7)
        ends = np.cumsum(columns[1])
        offsets.append(np.cumsum(np.append(0, columns[2])))
        bits.append(np.zeros(int(offsets[-1][-1]), bool))
        lists = [column.tolist() for column in (columns[0], ends - columns[1], ends, *columns[3:])]
        for at, (value, lo, hi, again, doc_id, ord_, start) in enumerate(zip(*lists)):
            string = data[lo:hi]
            place = (doc_id, blocks[row], ord_, start)
            group = groups.setdefault(value or string, {})
            before = group.get(string)
            if before is None or place < before[0]:
                group[string] = (place, row, at, again or before is not None and before[3])
    for group in groups.values():
        if len(group) == 1 and not (only := next(iter(group.values())))[3]:
            _, row, at, _ = only
            bits[row][offsets[row][at] : offsets[row][at + 1]] = True
        else:
            _mark_first(group, offsets, bits)
    sent = [_bits(row) for row in bits]
    return pa.table({"block": table.column("block"), "part": table.column("part"), "payload": pa.array(sent, pa.binary())})


def _mark_first(group: dict[bytes, tuple], offsets: list[np.ndarray], bits: list[np.ndarray]) -> None:
    """Sets the bits of the first places among different strings of one minimiser: windows sorted by words, then place."""
    windows = []
    for string, ((*document, start), row, at, _) in group.items():
        words, base = string.split(b" "), int(offsets[row][at])
        for k in range(len(words) - WINDOW + 1):
            windows.append((b" ".join(words[k : k + WINDOW]), *document, start + k, row, base + k))
    windows.sort()
    before = None
    for window, *_, row, at in windows:
        if window != before:
            bits[row][at] = True
            before = window


# -- 3. removal ----------------------------------------------------------------------------------


def _repeated(block: _Block, given: dict[int, bytes]) -> np.ndarray:
    """For every window of the block's super-k-mers, one after the other: whether it also starts earlier."""
    gone = np.ones(int(block.size.sum()), bool)
    if len(gone):
        (numbers,), _ = unpack_columns(given[OF_KMERS], 1)
        (part,), _ = unpack_columns(given[OF_STRINGS], 1)
        _, first = np.unique(numbers, return_index=True)
        sizes, starts = block.size[first], (np.cumsum(block.size) - block.size)[first]
        for number, some in by_part(part):
            size = sizes[some]
            windows = np.arange(size.sum()) + np.repeat(starts[some] - (np.cumsum(size) - size), size)
            gone[windows] = ~_flags(given[number])[: len(windows)]
    return gone


def _remove(table: pa.Table, answers: pa.Table) -> pa.Table:
    shared = answers.column("shared")
    given = answers.filter(pc.invert(shared))
    block = _Block(table, answers.filter(shared).column("payload").to_pylist())
    gone = _repeated(block, dict(zip(given.column("part").to_pylist(), given.column("payload").to_pylist())))
    ends = np.append(0, np.cumsum(block.size))
    start = np.arange(len(gone)) + np.repeat(block.start - ends[:-1], block.size)
    bounds = ends[block.bounds].tolist()
    n_words, n_removed, kept = [], [], []
    for text, lo, hi in zip(each(block.texts), bounds, bounds[1:]):
        words = words_of(text)
        n_words.append(len(words))
        at = start[lo:hi][gone[lo:hi]] if lo < hi else start[:0]
        if len(at):
            cover = np.zeros(len(words) + 1, np.int64)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + WINDOW, -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(cover)[:-1] == 0).tolist()]
        n_removed.append(n_words[-1] - len(words))
        kept.append(b" ".join(words).decode())
    return pa.table(
        {
            "doc_id": pa.array(block.doc_ids, mask=block.doc_ids == NO_ID),
            "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "kept": pa.array(kept, pa.string()),
        }
    )


def remove_repeats(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words left, joined by a blank) of every document row."""
    table = _write_blocks(docs, words)
    n = table.agg(F.sum("n")).first()[0] or 0
    parts = max(partitions(docs.sparkSession), math.ceil(n / PART))
    counted = table.where(F.col("n").isNotNull()).select("block", "payload").mapInArrow(_minimisers(parts), SENT)

    shared = store_by_block(counted.groupBy("part").applyInArrow(_shared, SENT), "shared")
    by_block = table.select("block", "ord", "doc_id", "text", "payload").groupBy("block")
    strings = store_by_block(by_block.cogroup(shared.groupBy("block")).applyInArrow(_send(parts), SENT), "strings")
    bits = strings.where("part >= 0").groupBy("part").applyInArrow(_first_places, SENT)
    given = strings.where("part < 0").unionByName(bits).withColumn("shared", F.lit(False))
    answers = shared.withColumn("shared", F.lit(True)).unionByName(given)
    schema = "doc_id long, n_words long, n_removed long, kept string"
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(_remove, schema)
