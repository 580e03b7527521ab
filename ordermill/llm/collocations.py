"""Phrase collocations by set-oriented (SETM) relational mining over stored occurrence relations.

The occurrence relation of length m says, for each place of a text, which phrase of m words starts there.  It is kept in
blocks of BLOCK words, sorted by piece and place, and written for each length to the shared folder, bucketed by
block.  One round for a length:

1. Group-count: each block lists its distinct phrases with their counts; the lists meet in parts by a hash of the
   phrase and are summed.  Phrases met ``least`` times or more are frequent and get a number.  The number of
   parts follows from the counted size of the lists.
2. Semi-join: each block gets back the numbers of its frequent phrases.
3. Merge-join: occurrences left that stand at neighbouring places of one piece are one occurrence of length m + 1.
   Both sides lie in the block in that order, so the join is one pass along it and texts do not move.

So only distinct phrases of blocks travel, and a word or phrase that every document holds is one entry per block.
A phrase of m + 1 words is a pair (its first m words, its last m words), so it is two numbers at any length.
Scores come from the tables of frequent phrases alone: all parts of a frequent phrase are frequent.

Words are counted per language: a word of two languages is two words.

Cases: a null or empty text has no words; a null language is ``und``; an empty language stays one of its own; rows with
equal texts or ids count each; an empty table gives an empty result; other columns are ignored; texts are read whole,
split between blocks only where a piece ends, so a piece of any length stays together; equal scores go by count, then
phrase.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ordermill.llm.blocks import pack, store, store_by_block, unpack
from ordermill.llm.shared import SENT_ROWS, by_part, drop_path, each, pack_columns, partitions, stage, text_of, unpack_columns

LEAST = 10  # occurrences of a phrase
MAX_WORDS = 3
CONTAINED = (50, 100)  # share of a phrase's occurrences inside a longer one from which it is dropped
TOP = 2_000
MILLION = 1_000_000
BLOCK = 500_000  # words
PART = 1_000_000  # entries of phrase lists that meet in one part

# Letters A-Z become small; what ends a piece becomes a line feed.  What is left of blanks separates words.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes.maketrans(bytes(range(65, 91)) + _ENDS, bytes(range(97, 123)) + b"\n" * len(_ENDS))
_BETWEEN = b"\xff"  # between a language and a word: no byte of UTF-8

_BLOCKS = "block long, n long, relation binary, phrases binary"
_SPLIT = "block long, part long, phrases binary"
_COUNTED = "block long, part long, answer binary, id long, first long, second long, word string, lang string, n long, total long"
_COUNTED_ARROW = pa.schema(
    [
        ("block", pa.int64()),
        ("part", pa.int64()),
        ("answer", pa.binary()),
        ("id", pa.int64()),
        ("first", pa.int64()),
        ("second", pa.int64()),
        ("word", pa.string()),
        ("lang", pa.string()),
        ("n", pa.int64()),
        ("total", pa.int64()),
    ]
)


def _counted(size: int, **columns) -> pa.Table:
    return pa.table([columns.get(f.name, pa.nulls(size, f.type)) for f in _COUNTED_ARROW], schema=_COUNTED_ARROW)


# -- the relation of single words ----------------------------------------------------------------


def pieces_of(text: str) -> Iterator[list[bytes]]:
    """The words of each piece of a text that has any."""
    return filter(None, map(bytes.split, text.encode().translate(_TABLE).split(b"\n")))


class _Words(dict):
    """Numbers words in the order of their first use, from 1 on, in one language."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) + 1
        return number


class _Block:
    """The block being filled: words as numbers of their language, a 0 after each piece."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.words: dict[str, _Words] = {}
        self.runs: list[tuple[str, np.ndarray]] = []

    def add(self, lang: str, pieces: list[list[bytes]]) -> None:
        numbers, places = self.words.setdefault(lang, _Words()), []
        for piece in pieces:
            places += map(numbers.__getitem__, piece)
            places.append(0)
        self.size += len(places)
        self.runs.append((lang, np.array(places, np.int32)))

    def row(self) -> pa.RecordBatch:
        """Words of all languages in order, numbered so, with their counts."""
        starts, keys = {}, []
        for lang, words in self.words.items():
            starts[lang] = len(keys)
            head = lang.encode() + _BETWEEN
            keys += [head + word for word in words]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        number = np.zeros(len(keys) + 1, np.int32)
        number[np.array(order, np.int64) + 1] = np.arange(1, len(keys) + 1)
        places = number[np.concatenate([np.where(run > 0, run + starts[lang], 0) for lang, run in self.runs])]
        counts = np.bincount(places, minlength=len(keys) + 1)[1:]
        keys = [keys[i] for i in order]
        return _block_row(self.number, places, _listed_words(keys, counts), len(keys))


def _block_row(number: int, relation: np.ndarray | None, phrases: bytes, n: int) -> pa.RecordBatch:
    row = [[number], [n], [None if relation is None else pack(relation)], [phrases]]
    types = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], ["block", "n", "relation", "phrases"])


def _write_words(docs: DataFrame, words: int) -> tuple[DataFrame, str]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), each(batch.column(1))):
                some, size = [], 0
                for piece in pieces_of(text):
                    if block.size + size and block.size + size + len(piece) > words:
                        if some:
                            block.add(lang, some)
                        yield block.row()
                        block, some, size = _Block(block.number + 1), [], 0
                    some.append(piece)
                    size += len(piece) + 1
                if some:
                    block.add(lang, some)
        if block.size:
            yield block.row()

    texts = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"), text_of(docs).alias("text"))
    return store(texts.mapInArrow(run, _BLOCKS), "words", "block")


# -- group-count ---------------------------------------------------------------------------------

# A list of words holds their lengths, counts and bytes, in order; one of longer phrases their first and second ids and
# counts, in order.  Parts get and answer them in that order, so that no numbers need to travel with them.


def _listed_words(keys: list[bytes], counts: np.ndarray) -> bytes:
    return pack_columns(np.fromiter(map(len, keys), np.int64, len(keys)), counts, data=b"".join(keys))


def _listed_pairs(first: np.ndarray, second: np.ndarray, counts: np.ndarray) -> bytes:
    return pack_columns(np.diff(first, prepend=0), second, counts)


def _words_of(payload: bytes) -> tuple[pa.Array, np.ndarray]:
    (lengths, counts), data = unpack_columns(payload, 2)
    offsets = np.append(0, np.cumsum(lengths)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)]), counts


def _pairs_of(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    (steps, second, counts), _ = unpack_columns(payload, 3)
    return np.cumsum(steps), second, counts


def _mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    h = first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + second.astype(np.uint64)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _split(payload: bytes, words: bool, parts: int, lists: bool = True) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """For each part that a block's list has phrases of: its number, their places in the list, and their own list."""
    if words:
        keys, counts = _words_of(payload)
        keys = keys.to_pylist()
        part = np.fromiter(map(zlib.crc32, keys), np.int64, len(keys)) % parts
        listed = lambda some: _listed_words([keys[i] for i in some.tolist()], counts[some])
    else:
        first, second, counts = _pairs_of(payload)
        part = (_mixed(first, second) % np.uint64(parts)).astype(np.int64)
        listed = lambda some: _listed_pairs(first[some], second[some], counts[some])
    for number, some in by_part(part):
        yield number, some, listed(some) if lists else b""


def _split_lists(blocks: DataFrame, words: bool, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = [(number, own) for number, _, own in _split(data.as_py(), words, parts)]
                numbers, lists = zip(*found) if found else ((), ())
                columns = [pa.array([block] * len(found), pa.int64()), pa.array(numbers, pa.int64()), pa.array(lists, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["block", "part", "phrases"])

    return blocks.select("block", "phrases").mapInArrow(run, _SPLIT)


def _answers(table: pa.Table, sizes: list[int], ids: np.ndarray) -> pa.Table:
    """For each block of a part the ids of its phrases there, 0 for those not frequent."""
    ends = np.cumsum([0, *sizes])
    out = [pack_columns(ids[a:b]) for a, b in zip(ends, ends[1:])]
    part = pa.array([table.column("part")[0].as_py()] * len(out), pa.int64())
    return _counted(len(out), block=table.column("block").combine_chunks(), part=part, answer=pa.array(out, pa.binary()))


def _numbered(totals: np.ndarray, least: int, part: int, parts: int) -> np.ndarray:
    """Ids for the frequent ones, 0 for the others: no two parts give the same."""
    frequent = totals >= least
    return np.where(frequent, 1 + part + parts * (np.cumsum(frequent) - 1), 0)


def _count_words(least: int, parts: int):
    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        lists = [_words_of(data) for data in table.column("phrases").to_pylist()]
        keys = pa.concat_arrays([own for own, _ in lists]).dictionary_encode()
        where, counts = keys.indices.to_numpy(), np.concatenate([n for _, n in lists])
        totals = np.zeros(len(keys.dictionary), np.int64)
        np.add.at(totals, where, counts)
        ids = _numbered(totals, least, part, parts)
        langs, words = zip(*(map(bytes.decode, key.split(_BETWEEN, 1)) for key in keys.dictionary.to_pylist()))
        langs, kept = pa.array(langs, pa.string()).dictionary_encode(), np.flatnonzero(ids)
        sums = np.zeros(len(langs.dictionary), np.int64)
        np.add.at(sums, langs.indices.to_numpy(), totals)
        frequent = {
            "id": pa.array(ids[kept]),
            "word": pa.array([words[i] for i in kept.tolist()], pa.string()),
            "lang": langs.take(pa.array(kept)).dictionary_decode(),
            "n": pa.array(totals[kept]),
        }
        all_words = _counted(len(sums), lang=langs.dictionary, total=pa.array(sums))
        return pa.concat_tables([_answers(table, [len(own) for own, _ in lists], ids[where]), _counted(len(kept), **frequent), all_words])

    return run


def _count_pairs(least: int, parts: int, last: bool):
    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        lists = [_pairs_of(data) for data in table.column("phrases").to_pylist()]
        first, second, counts = map(np.concatenate, zip(*lists))
        order = np.lexsort((second, first))
        a, b = first[order], second[order]
        start = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        totals = np.add.reduceat(counts[order], start)
        ids = _numbered(totals, least, part, parts)
        kept = np.flatnonzero(ids)
        columns = {"id": ids[kept], "first": a[start][kept], "second": b[start][kept], "n": totals[kept]}
        found = _counted(len(kept), **{name: pa.array(values) for name, values in columns.items()})
        if last:
            return found
        own = np.empty(len(order), np.int64)
        own[order] = np.repeat(ids, np.diff(np.append(start, len(order))))
        return pa.concat_tables([_answers(table, [len(n) for _, _, n in lists], own), found])

    return run


def _group_count(blocks: DataFrame, words: int, least: int, part_size: int, last: bool) -> tuple[DataFrame, int]:
    """Answers and frequent phrases of a length, and the number of parts."""
    entries = blocks.agg(F.sum("n")).first()[0] or 0
    parts = max(partitions(blocks.sparkSession), math.ceil(entries / part_size))
    run = _count_words(least, parts) if words == 1 else _count_pairs(least, parts, last)
    counted = _split_lists(blocks, words == 1, parts).groupBy("part").applyInArrow(run, _COUNTED)
    return stage(counted, f"frequent{words}"), parts


# -- merge-join ----------------------------------------------------------------------------------


def join_neighbours(relation: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The next relation, and its distinct phrases as pairs of ids, in order, with their counts.

    ``relation`` has a phrase's number (from 1 on) where it starts, 0 elsewhere; ``ids`` the id of each number, 0
    where it is not frequent.  Two phrases join where one starts a place after the other.
    """
    kept = np.where(ids[relation] > 0, relation, 0)
    both = np.flatnonzero((kept[:-1] > 0) & (kept[1:] > 0))
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    pairs, number, counts = np.unique(rank[kept[both]] * len(ids) + rank[kept[both + 1]], return_inverse=True, return_counts=True)
    longer = np.zeros(len(relation), np.int32)
    longer[both] = number + 1
    return longer, ids[order[pairs // len(ids)]], ids[order[pairs % len(ids)]], counts


def _extend(blocks: DataFrame, counted: DataFrame, words: bool, parts: int, last: bool, purpose: str) -> tuple[DataFrame, str]:
    """Blocks of the next length; the relation of the ``last`` one is not kept."""

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        number, relation = block.column("block")[0].as_py(), unpack(block.column("relation")[0].as_py())
        ids = np.zeros(block.column("n")[0].as_py() + 1, np.int64)
        given = dict(zip(answers.column("part").to_pylist(), answers.column("answer").to_pylist()))
        for part, some, _ in _split(block.column("phrases")[0].as_py(), words, parts, lists=False):
            ids[some + 1] = unpack_columns(given[part], 1)[0][0]
        longer, first, second, counts = join_neighbours(relation, ids)
        return pa.Table.from_batches([_block_row(number, None if last else longer, _listed_pairs(first, second, counts), len(counts))])

    left = blocks.groupBy("block")
    right = counted.where(F.col("answer").isNotNull()).select("block", "part", "answer").groupBy("block")
    return store(left.cogroup(right).applyInArrow(run, _BLOCKS), purpose, "block")


# -- scores --------------------------------------------------------------------------------------


def lowest_cut(heads: list[int], tails: list[int], a: int) -> tuple[int, int, int]:
    """Score, l and r of the lowest-scoring cut, the first of equal ones; in whole numbers of any size.

    ``heads[k - 1]`` and ``tails[k - 1]`` count the first and the last k words.
    """
    words = len(heads)
    cuts = [(MILLION * a * a // (heads[k - 1] * tails[words - k - 1]), k) for k in range(1, words)]
    score, k = min(cuts)
    return score, heads[k - 1], tails[words - k - 1]


def _scored(phrases: DataFrame, langs: DataFrame) -> DataFrame:
    """lang, word_ids, a, l, r and score of phrases with their heads and tails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, tails = (batch.column(i).to_pylist() for i in (2, 3))
            a = [counts[-1] for counts in heads]
            found = zip(*map(lowest_cut, heads, tails, a)) if a else ([], [], [])
            score, left, right = (pa.array(values, pa.int64()) for values in found)
            columns = [*batch.columns[:2], pa.array(a, pa.int64()), left, right, score]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "word_ids", "a", "l", "r", "score"])

    rows = phrases.withColumn("id", F.get("word_ids", F.lit(0))).join(langs, "id").select("lang", "word_ids", "heads", "tails")
    return rows.mapInArrow(run, "lang string, word_ids array<long>, a long, l long, r long, score long")


def _joined(pairs: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases of a length with what is known of their first and last words: the words, and the counts of their heads
    and tails; the last of either is their own."""
    heads = shorter.select(F.col("id").alias("first"), "word_ids", "heads")
    tails = shorter.select(F.col("id").alias("second"), F.element_at("word_ids", -1).alias("last_word"), "tails")
    return pairs.join(heads, "first").join(tails, "second").select(
        "id",
        F.array_append("word_ids", F.col("last_word")).alias("word_ids"),
        F.array_append("heads", F.col("n")).alias("heads"),
        F.array_append("tails", F.col("n")).alias("tails"),
    )


def _not_contained(phrases: DataFrame, longer: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Phrases without those of which ``share`` or more occurrences lie in one longer frequent phrase.

    The longest such share is that of a phrase one word longer: what lies in a longer one lies in that too.
    """
    inside = longer.select(F.col("first").alias("id"), "n").unionByName(longer.select(F.col("second").alias("id"), "n"))
    inside = inside.groupBy("id").agg(F.max("n").alias("most"))
    own, wide = F.element_at("heads", -1), "decimal(38,0)"
    kept = F.col("most").isNull() | (F.lit(share[1]) * F.col("most").cast(wide) < F.lit(share[0]) * own.cast(wide))
    return phrases.join(inside, "id", "left").where(kept).drop("most")


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    max_words: int = MAX_WORDS,
    contained: tuple[int, int] = CONTAINED,
    top: int = TOP,
    block_words: int = BLOCK,
    part_size: int = PART,
) -> DataFrame:
    """The ``top`` phrases of 2 to ``max_words`` words of each language, best first.

    Returns lang, rank, phrase, a (its occurrences), l and r (those of the two sides of its lowest-scoring
    cut), n (all words of the language) and score, floor(1000000 a a / (l r)).
    """
    spark = docs.sparkSession
    blocks, folder = _write_words(docs, block_words)
    counted, parts = _group_count(blocks, 1, least, part_size, False)
    words = counted.where(F.col("word").isNotNull()).select("id", "lang", "word", "n")
    totals = counted.where(F.col("total").isNotNull()).groupBy("lang").agg(F.sum("total").alias("n"))

    # Tables of frequent phrases are kept by id, so that they are not shuffled for the joins; a word table of no more
    # than SENT_ROWS rows of a few numbers goes to all tasks.
    few = words.count() <= SENT_ROWS
    langs = words.select("id", "lang")
    known = words.select("id", F.array("id").alias("word_ids"), F.array("n").alias("heads"), F.array("n").alias("tails"))
    if few:
        known = F.broadcast(known)
    lengths, pairs = [], []
    for m in range(2, max_words + 1):
        blocks, longer = _extend(blocks, counted, m == 2, parts, m == max_words, f"phrases{m}")
        drop_path(spark, folder)  # written out, the longer relation stands alone
        folder = longer
        counted, parts = _group_count(blocks, m, least, part_size, m == max_words)
        pairs.append(counted.where(F.col("first").isNotNull()).select("id", "first", "second", "n"))
        known = store_by_block(_joined(pairs[-1], known), f"known{m}", "id")
        lengths.append(known)
    drop_path(spark, folder)
    kept = [_not_contained(phrases, longer, contained) for phrases, longer in zip(lengths, pairs[1:])] + lengths[-1:]
    scored = _scored(kept[0], langs)
    for more in kept[1:]:
        scored = scored.unionByName(_scored(more, langs))

    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    scored = scored.withColumn("place", F.rank().over(best)).where(F.col("place") <= top).drop("place")
    spelt = scored.select("*", F.posexplode("word_ids").alias("at", "id")).join(words.select("id", "word"), "id")
    spelt = spelt.groupBy("lang", "word_ids", "a", "l", "r", "score").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelt"))
    spelt = spelt.withColumn("phrase", F.array_join("spelt.word", " "))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = spelt.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    ranked = ranked.join(totals, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
