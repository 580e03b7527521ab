"""Packing: pieces against the tokenizer itself, bins against their rules and against trying every combination."""

from __future__ import annotations

import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ordermill.llm import packing as P
from ordermill.llm import queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain_ids():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def check_sequences(rows, limit):
    """Sequences are gapless from 0 and not too long; returns their number."""
    inside = defaultdict(list)
    for length, sequence, offset in rows:
        inside[sequence].append((offset, length))
    for some in inside.values():
        end = 0
        for offset, length in sorted(some):
            assert offset == end
            end += length
        assert end <= limit
    return len(inside)


def first_fit(lengths, limit):
    """The number of bins that the longest-first, first-fit rule takes."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        at = next((i for i, room in enumerate(rooms) if room >= length), None)
        if at is None:
            rooms.append(limit - length)
        else:
            rooms[at] -= length
    return len(rooms)


def plain_pieces(texts, plain_ids, limit):
    out = []
    for doc_id, text in texts:
        ids = plain_ids(text)
        starts = list(range(len(ids) % limit, len(ids), limit))
        bounds = [0, *[s for s in starts if s], len(ids)]
        for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
            data = np.array(ids[a:b], "<u4").tobytes()
            out.append((doc_id, piece, a, b - a, zlib.crc32(data)))
    return sorted(out, key=str)


ODD = [
    None,
    "",
    " ",
    "<|endoftext|> is text",
    "a　b\x85c​d\xa0e",
    "naïve Ünïcödé ﬁ ½ Ⅷ ²³ १२३",
    "x" * 5000,
    " \n\t " * 700,
    "don't I'LL we've\x00 \U0001f600👨‍👩‍👧",
    "word " * 40,
    "word " * 40,
]


@pytest.mark.parametrize("limit", [1024, 16, 1])
def test_pieces_and_places(docs, plain_ids, limit):
    dice = random.Random(limit)
    letters = "abcdefghijklmnopqrstuvwxyzéß \n.,'0123456789"
    texts = list(enumerate(ODD + ["".join(dice.choice(letters) for _ in range(dice.choice([3, 60, 900]))) for _ in range(60)]))
    texts += [(None, "no id"), (3, "again"), (3, "again")]
    frame = docs(*texts).withColumn("length", F.lit("clash")).withColumn("task", F.lit(1)).repartition(3)
    rows = P.pack(P.cut_documents(frame, PATH, public_tokenizers.PATTERN, limit), limit).collect()
    got = sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows], key=str)
    expected = plain_pieces(texts, plain_ids, limit)
    assert got == expected
    n = check_sequences([(r["length"], r["sequence_id"], r["offset"]) for r in rows], limit)
    assert n <= first_fit([r[3] for r in expected], limit)


def test_vocabulary_is_the_rank_file():
    from ordermill.llm.token_counts import read_ranks

    assert P.vocabulary_ranks(PATH) == read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_vocabulary_in_another_order(tmp_path):
    path = tmp_path / "odd.json"
    path.write_text('{"model": {"vocab": {"a": 0, "b": 1, "ab": 3, "ba": 2}, "merges": ["a b", "b a"]}}')
    with pytest.raises(ValueError, match="order of the merges"):
        P.vocabulary_ranks(str(path))


@pytest.mark.parametrize("seed", range(6))
def test_fullest_combination(seed):
    dice = random.Random(seed)
    left = {dice.randint(1, 40): dice.randint(0, 4) for _ in range(dice.randint(1, 6))}
    room = dice.randint(0, 60)
    pieces = [length for length, n in left.items() for _ in range(n)]
    best = max(sum(some) for k in range(len(pieces) + 1) for some in itertools.combinations(pieces, k) if sum(some) <= room)
    for slack in (0, 3):
        found = P._fullest(left, room, slack)
        assert best - slack <= sum(length * n for length, n in found.items()) <= best
        assert all(n <= left[length] for length, n in found.items())


@pytest.mark.parametrize("seed", range(8))
def test_plan_places_every_piece_once(seed):
    dice = random.Random(seed)
    limit = dice.choice([10, 100, 1024])
    histogram = Counter(min(limit, int(dice.expovariate(3 / limit)) + 1) for _ in range(dice.choice([1, 30, 4000])))
    plan = P.plan_bins(histogram, limit)
    lengths = np.array([length for length, n in histogram.items() for _ in range(n)], np.int64)
    numbers = np.array([i for n in histogram.values() for i in range(n)], np.int64)
    sequence, offset = P._Places(plan).of(lengths, numbers)
    bins = check_sequences(zip(lengths.tolist(), sequence.tolist(), offset.tolist()), limit)
    assert math.ceil(lengths.sum() / limit) <= bins <= first_fit(lengths.tolist(), limit)


def test_bins_of_one_kind_are_planned_at_once():
    assert P.plan_bins({6: 10**12, 4: 10**12}, 10) == [(6, 0, 1, 10**12, 0, 0), (4, 0, 1, 10**12, 0, 6)]
    assert P.plan_bins({}, 10) == []
    with pytest.raises(ValueError):
        P.plan_bins({11: 1}, 10)


def test_sequences_hold_the_ids(docs, plain_ids):
    texts = list(enumerate(["one two", "three " * 30, None, "four"]))
    pieces = P.cut_documents(docs(*texts), PATH, public_tokenizers.PATTERN, 16, with_ids=True)
    rows = P.packed_sequences(pieces, 16).collect()
    assert sorted(i for r in rows for i in r["ids"]) == sorted(i for _, t in texts for i in plain_ids(t))
    assert all(len(r["ids"]) <= 16 for r in rows) and {d for r in rows for d in r["doc_ids"]} == {0, 1, 2, 3}


def test_any_rows_with_a_length(spark):
    rows = spark.createDataFrame([(7, "x", 1, 2), (3, None, 1, 2)], "length int, Task string, number int, offset int")
    packed = P.pack(rows, 10)
    assert packed.columns == ["length", "Task", "number", "sequence_id", "offset"]
    assert sorted((r["length"], r["sequence_id"], r["offset"]) for r in packed.collect()) == [(3, 0, 7), (7, 0, 0)]
    with pytest.raises(Exception, match="lengths must lie"):
        P.pack(rows, 6).count()


def test_empty_table(docs):
    assert P.pack(P.cut_documents(docs(), PATH, public_tokenizers.PATTERN)).count() == 0


def test_registered_query(spark, plain_ids):
    folder = "/root/testdata/sf0.001"
    rows = queries.all_queries()["op11_best_fit_packing"](spark, folder).collect()
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows], key=str)
    assert got == plain_pieces(texts, plain_ids, 1024)
    n = check_sequences([(r["length"], r["sequence_id"], r["offset"]) for r in rows], 1024)
    assert n <= first_fit([r["length"] for r in rows], 1024)
