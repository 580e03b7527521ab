"""Benchmark decontamination over a distributed positional inverted index of the training documents.

The index is stored once in the shared folder.  Documents are dealt to blocks of about WORDS words, their
words numbered through the block; each term of a block has one row with its sorted positions.  Terms that
no test item holds cannot take part in a match and are left out when the test vocabulary is small enough
to be sent to the tasks (MAX_TERMS); beyond that all terms are indexed, with the same matches.

A phrase is found in a block by its rarest term: its positions, less the term's place in the phrase, are
the candidate starts, which are intersected with the offset-adjusted lists of the other terms from rare
to frequent.  Proximity matches start from the rarest term too.  The table is bucketed by block, so a
search moves no postings; test items are sent in slices of bounded size, each one pass over the index.

A frequent term or a passage that many documents hold is spread over all blocks, as every document is.

Cases: a null text has no words; a document without words is never hit; items without words match
nothing; an item repeated under its id counts once; a null item_id is an item with an empty name; rows
with the same doc_id are judged one by one; empty documents or items give rows without hits; a very long
document is a block of its own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.blocks import pack, store_by_block, unpack
from ordermill.llm.shared import each, row_keys, stage, text_of, without_rows

WINDOW = 13
WORDS = 1_000_000  # per block
GAP = 1 << 10  # unused positions between two documents, so that no match spans them
MAX_TERMS = 1_000_000
SLICE_WORDS = 2_000_000  # words of test items sent to the tasks at once
CONTAMINATED_FROM = 20  # one hit word in so many

# Everything but ASCII letters and digits and non-ASCII characters separates words; A-Z are lowered.
_WORD_BYTES = bytes(
    b if b >= 128 or chr(b).isalnum() and b < 128 and not 65 <= b <= 90 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256)
)

INDEX_SCHEMA = "block long, term binary, positions binary, ord int, doc_id long, mark long, start long, n_words long"
_INDEX = pa.schema(
    [
        ("block", pa.int64()),
        ("term", pa.binary()),
        ("positions", pa.binary()),
        ("ord", pa.int32()),
        ("doc_id", pa.int64()),
        ("mark", pa.int64()),
        ("start", pa.int64()),
        ("n_words", pa.int64()),
    ]
)
MATCH_SCHEMA = "block long, ord int, doc_id long, item string, start long, end long"


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_WORD_BYTES).split() if text else []


class _Postings:
    """The block being built: documents and, for each term number, positions."""

    def __init__(self, block: int):
        self.block, self.next = block, 0
        self.documents: list[tuple] = []
        self.terms: list[np.ndarray] = []
        self.places: list[np.ndarray] = []

    def add(self, doc_id: int | None, mark: int | None, numbers: np.ndarray) -> None:
        known = np.flatnonzero(numbers >= 0)
        self.terms.append(numbers[known])
        self.places.append(known + self.next)
        self.documents.append((len(self.documents), doc_id, mark, self.next, len(numbers)))
        self.next += len(numbers) + GAP

    def _batch(self, rows: int, **columns) -> pa.RecordBatch:
        columns["block"] = pa.array(np.full(rows, self.block, np.int64))
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(rows, f.type)) for f in _INDEX], schema=_INDEX)

    def batches(self, names: list[bytes]) -> Iterator[pa.RecordBatch]:
        if not self.documents:
            return
        of_doc = [pa.array(column, f.type) for column, f in zip(zip(*self.documents), list(_INDEX)[3:])]
        yield self._batch(len(self.documents), **dict(zip(("ord", "doc_id", "mark", "start", "n_words"), of_doc)))
        terms, places = np.concatenate(self.terms), np.concatenate(self.places)
        order = np.argsort(terms, kind="stable")
        terms, places = terms[order], places[order]
        first = np.flatnonzero(np.diff(terms, prepend=-1))
        lists = [pack(np.diff(part, prepend=0)) for part in np.split(places, first[1:])] if len(first) else []
        found = [names[number] for number in terms[first]]
        yield self._batch(len(found), term=pa.array(found, pa.binary()), positions=pa.array(lists, pa.binary()))


def build_index(docs: DataFrame, items: DataFrame | None = None, words: int = WORDS, mark: Column | None = None) -> DataFrame:
    """The stored index of ``docs``; with ``items``, of their terms only where these are few enough.

    ``mark`` is a number kept beside each document's id.
    """
    vocabulary = _vocabulary(items) if items is not None else None

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = sorted(vocabulary.value) if vocabulary else []
        known = {name: number for number, name in enumerate(names)}
        number_of = known.get

        def number(found: list[bytes]) -> np.ndarray:
            if vocabulary is None:
                for word in found:
                    if word not in known:
                        known[word] = len(names)
                        names.append(word)
            return np.array(list(map(number_of, found, repeat(-1))), np.int64)

        current = _Postings(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for doc_id, mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), each(batch.column(2))):
                found = words_of(text)
                if current.documents and current.next + len(found) > words:
                    yield from current.batches(names)
                    current = _Postings(current.block + 1)
                    if vocabulary is None:
                        known.clear()
                        names.clear()
                current.add(doc_id, mark, number(found))
        yield from current.batches(names)

    mark = F.lit(None) if mark is None else mark
    rows = docs.select(docs["doc_id"].cast("long"), mark.cast("long").alias("mark"), text_of(docs).alias("text"))
    return store_by_block(rows.mapInArrow(build, INDEX_SCHEMA), "index")


def _item_texts(items: DataFrame) -> DataFrame:
    name = F.coalesce(items["item_id"].cast("string"), F.lit(""))
    return items.select(name.alias("item"), text_of(items).alias("text"))


def _vocabulary(items: DataFrame):
    """The test terms as a broadcast set, or None where there are more than MAX_TERMS."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {word for text in batch.column(0).to_pylist() for word in words_of(text)}
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary())], ["term"])

    distinct = _item_texts(items).select("text").mapInArrow(terms, "term binary").distinct()
    found = distinct.limit(MAX_TERMS + 1).collect()  # one more than may be sent tells that there are too many
    if len(found) > MAX_TERMS:
        return None
    return items.sparkSession.sparkContext.broadcast({bytes(row["term"]) for row in found})


def _slices(items: DataFrame) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items' words, in slices of about SLICE_WORDS words."""
    texts = _item_texts(items)
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    n = 1 + size // (2 * SLICE_WORDS)  # a word and its separator take two characters at least
    numbered = texts.withColumn("slice", F.pmod(F.xxhash64("item", "text"), F.lit(n)))
    for number in range(n):
        some = numbered.where(F.col("slice") == number).select("item", "text").distinct()
        yield [(row["item"], words_of(row["text"])) for row in some.collect()]


class _Block:
    """The postings of one block while it is searched."""

    def __init__(self, table: pa.Table):
        rows = table.select(["term", "positions"]).filter(table.column("term").is_valid())
        self.packed = dict(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()))
        self.lists: dict[bytes, np.ndarray] = {}
        docs = table.filter(table.column("start").is_valid()).sort_by("start")
        self.block = docs.column("block")[0].as_py() if docs.num_rows else 0
        self.ords, self.doc_ids = docs.column("ord").to_pylist(), docs.column("doc_id").to_pylist()
        self.starts = docs.column("start").to_numpy()

    def postings(self, term: bytes) -> np.ndarray:
        if term not in self.lists:
            self.lists[term] = np.cumsum(unpack(self.packed[term]), dtype=np.int64)
        return self.lists[term]

    def holds(self, terms) -> bool:
        return all(map(self.packed.__contains__, terms))

    def phrase(self, terms: tuple[bytes, ...]) -> np.ndarray:
        """The positions at which ``terms`` stand one after the other."""
        if not self.holds(terms):
            return np.zeros(0, np.int64)
        by_size = sorted(range(len(terms)), key=lambda at: len(self.postings(terms[at])))
        starts = self.postings(terms[by_size[0]]) - by_size[0]
        for at in by_size[1:]:
            others = self.postings(terms[at])
            place = np.searchsorted(others, starts + at)
            starts = starts[others[np.minimum(place, len(others) - 1)] == starts + at]
            if not len(starts):
                break
        return starts

    def near(self, terms: frozenset[bytes], within: int) -> list[tuple[int, int]]:
        """The smallest stretches of at most ``within`` words that hold all ``terms``, in any order."""
        if not terms or not self.holds(terms):
            return []
        rarest = self.postings(min(terms, key=lambda term: len(self.postings(term))))
        events = []
        for term in terms:
            places = self.postings(term)
            after = np.searchsorted(rarest, places)
            gaps = [np.abs(places - rarest[np.clip(after + step, 0, len(rarest) - 1)]) for step in (-1, 0)]
            events += [(int(p), term) for p in places[np.minimum(*gaps) < within]]
        last: dict[bytes, int] = {}
        found: list[tuple[int, int]] = []
        for place, term in sorted(events):
            last[term] = place
            if len(last) == len(terms) and place - (start := min(last.values())) < within:
                if found and found[-1][0] == start:
                    continue
                found.append((start, place + 1))
        return found

    def rows(self, item: str, spans: list[tuple[int, int]]) -> list[tuple]:
        """Match rows of spans in block positions, in the documents' own word numbers."""
        at = np.searchsorted(self.starts, [start for start, _ in spans], side="right") - 1
        return [
            (self.block, self.ords[d], self.doc_ids[d], item, start - int(self.starts[d]), end - int(self.starts[d]))
            for d, (start, end) in zip(at.tolist(), spans)
        ]


def _merged(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Spans of ``length`` from each start, joined where they overlap or touch."""
    if not len(starts):
        return []
    starts = np.unique(starts)
    new = np.flatnonzero(np.diff(starts, prepend=starts[0] - length - 1) > length)
    ends = np.append(starts[new[1:] - 1], starts[-1]) + length
    return list(zip(starts[new].tolist(), ends.tolist()))


def _search(index: DataFrame, items: DataFrame, find: Callable) -> DataFrame:
    """Match rows of all items; ``find(block, queries)`` gives those of one block."""
    found = None
    for some in _slices(items):
        queries = index.sparkSession.sparkContext.broadcast([(item, terms) for item, terms in some if terms])
        part = index.groupBy("block").applyInArrow(_search_block(queries, find), MATCH_SCHEMA)
        found = part if found is None else found.unionByName(part)
    return found


def _search_block(queries, find: Callable) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        rows = find(_Block(table), queries.value)
        types = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        columns = [pa.array(column, kind) for column, kind in zip(zip(*rows) if rows else [[]] * 6, types)]
        return pa.table(columns, names=["block", "ord", "doc_id", "item", "start", "end"])

    return run


def phrase_matches(index: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Where windows of items occur: block, ord, doc_id, item, start, end (word numbers, end exclusive).

    An item's windows are its runs of ``window`` words, or all its words if fewer; occurrences of one
    item that overlap or touch are one row.
    """

    def find(block: _Block, queries: list[tuple[str, list[bytes]]]) -> list[tuple]:
        known: dict[tuple, np.ndarray] = {}
        rows = []
        for item, terms in queries:
            length = min(window, len(terms))
            starts = []
            for at in range(len(terms) - length + 1):
                phrase = tuple(terms[at : at + length])
                if phrase not in known:
                    known[phrase] = block.phrase(phrase)
                starts.append(known[phrase])
            rows += block.rows(item, _merged(np.concatenate(starts), length))
        return rows

    return _search(index, items, find)


def proximity_matches(index: DataFrame, items: DataFrame, within: int) -> DataFrame:
    """Stretches of at most ``within`` words that hold all words of an item; within < GAP."""

    def find(block: _Block, queries: list[tuple[str, list[bytes]]]) -> list[tuple]:
        return [row for item, terms in queries for row in block.rows(item, block.near(frozenset(terms), within))]

    return _search(index, items, find)


def _covered(spans: Column) -> Column:
    """Words covered by the (start, end) structs, each counted once."""
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def step(state: Column, span: Column) -> Column:
        fresh = F.greatest(span["end"] - F.greatest(span["start"], state["end"]), F.lit(0).cast("long"))
        return F.struct(F.greatest(span["end"], state["end"]).alias("end"), (state["n"] + fresh).alias("n"))

    return F.aggregate(F.sort_array(spans), zero, step, lambda state: state["n"])


def _judged(index: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """doc_id, mark, n_words, n_hit, items and contaminated of every document of an index."""
    matches = phrase_matches(index, items, window)
    hits = matches.groupBy("block", "ord").agg(
        F.sort_array(F.collect_set("item")).alias("items"),
        F.collect_list(F.struct("start", "end")).alias("spans"),
    )
    counted = hits.select("block", "ord", "items", _covered(F.col("spans")).alias("n_hit"))
    every = index.where(F.col("start").isNotNull()).select("block", "ord", "doc_id", "mark", "n_words")
    joined = every.join(counted, ["block", "ord"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id",
        "mark",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (CONTAMINATED_FROM * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, items (names, sorted as strings) and contaminated, for every document row."""
    return _judged(build_index(docs, items), items, window).drop("mark")


def without_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with all its columns, without contaminated rows: those that share an id, or have none, are judged one by one."""
    first, second = row_keys(docs)
    keyed = docs.select(first.alias("doc_id"), second.alias("mark"), docs["text"])
    judged = _judged(build_index(keyed, items, mark=F.col("mark")), items, window)
    bad = judged.where("contaminated").select("doc_id", "mark").distinct()
    return without_rows(docs, stage(bad, "contaminated"))
