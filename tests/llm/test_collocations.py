"""Collocations against counting every phrase."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string"


def plain(rows, least=10, max_words=3, top=2000):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, max_words + 1):
                counts.update((lang, tuple(words[i : i + m])) for i in range(len(words) - m + 1))
    frequent = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    ranked = defaultdict(list)
    for (lang, words), a in frequent.items():
        longer = [b for (other, w), b in frequent.items() if other == lang and len(w) > len(words) and " ".join(words) in " ".join(w)]
        inside = [
            frequent[lang, w]
            for (other, w) in frequent
            if longer and other == lang and len(w) > len(words) and any(w[i : i + len(words)] == words for i in range(len(w)))
        ]
        if any(100 * b >= 50 * a for b in inside):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        ranked[lang].append((-score, -a, " ".join(words).encode(), a, left, right, totals[lang], score))
    out = []
    for lang, some in ranked.items():
        out += [(lang, rank, p.decode(), a, x, y, n, s) for rank, (_, _, p, a, x, y, n, s) in enumerate(sorted(some)[:top], 1)]
    return sorted(out)


def answer(df):
    return sorted(tuple(r) for r in df.collect())


def some_rows(seed, n=120):
    dice = random.Random(seed)
    words = ["red", "Red", "apple", "é", "É", "x\x00y", "a-b", "naïve", "tea\x1c", " ", "of", "the"]
    phrases = ["New York City", "big red dog", "of the", "ad hoc"]
    rows = []
    for i in range(n):
        bits = [dice.choice(phrases) if dice.random() < 0.4 else dice.choice(words) for _ in range(dice.choice([0, 3, 30]))]
        text = "".join(b + dice.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "\r\n", "\x0b", "!?"]) for b in bits)
        rows.append((i, text, dice.choice(["en", "en", "en", "de", None, ""])))
    return rows + [(None, None, "en"), (1, "", None), (2, " \t", "fr"), (2, "same again " * 30, "en"), (2, "same again " * 30, "en"), (3, "z " * 500, "nl")]


@pytest.mark.parametrize("block,part,words", [(C.BLOCK, C.PART, 3), (50, 40, 3), (1, 1, 2), (400, 100, 4)])
def test_against_counting_everything(spark, block, part, words):
    rows = some_rows(block)
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("block", F.lit("clash")).withColumn("part", F.lit(1)).repartition(3)
    got = answer(C.collocations(frame, max_words=words, block_words=block, part_size=part))
    assert got == plain(rows, max_words=words) and {r[0] for r in got} >= {"en", "de", "und", "nl", ""}


def test_top_with_ties(spark):
    rows = [(i, ". ".join(f"w{j} v{j}" for j in range(30)), "en") for i in range(10)]
    got = answer(C.collocations(spark.createDataFrame(rows, SCHEMA), top=7))
    assert got == plain(rows, top=7) and [r[1] for r in got] == list(range(1, 8))


def test_empty_table(spark):
    assert C.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert C.collocations(spark.createDataFrame([(1, "a b c", "en")], SCHEMA)).count() == 0


def test_cuts_in_numbers_of_any_size():
    big = 4 * 10**18
    assert C.lowest_cut([big, big - 7], [big, big - 7], big - 7) == (10**6 * (big - 7) ** 2 // big**2, big, big)
    assert C.lowest_cut([10, 10, 10], [20, 10, 10], 10)[1:] == (10, 20)
    assert C.lowest_cut([10, 10, 10], [10, 10, 10], 10) == (10**6, 10, 10)


def test_neighbours_join_within_pieces():
    relation = np.array([1, 2, 3, 0, 2, 3, 0, 1, 0], np.int32)
    longer, first, second, counts = C.join_neighbours(relation, np.array([0, 70, 80, 90]))
    assert sorted(zip(first.tolist(), second.tolist(), counts.tolist())) == [(70, 80, 1), (80, 90, 2)]
    assert (longer > 0).tolist() == [True, True, False, False, True, False, False, False, False]
    _, first, _, _ = C.join_neighbours(relation, np.array([0, 70, 0, 90]))
    assert len(first) == 0
