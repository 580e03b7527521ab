"""Substring dedup against looking every window up."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.llm import substring_dedup as S


def plain(rows, window=20):
    """Of (doc_id, text) rows in order: words and what stays of them."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = set(), []
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for at in range(len(words) - window + 1):
            gram = tuple(words[at : at + window])
            if gram in seen:
                gone |= set(range(at, at + window))
            seen.add(gram)
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((str(doc_id), len(words), len(gone), " ".join(kept)))
    return sorted(out)


def texts(seed, n=60):
    dice = random.Random(seed)
    word = lambda: "".join(dice.choice("abcdé") for _ in range(dice.choice([1, 2, 3])))
    prose = lambda k: " ".join(word() for _ in range(k))
    passages = [prose(k) for k in (19, 20, 21, 45, 70)]
    out = [None, "", " \n", "x " * 500, "x " * 19, "a b c " * 9, "a b c " * 9 + "d", "p q r s t u v " * 60]
    for _ in range(n):
        parts = [prose(dice.choice([0, 5, 40]))]
        for _ in range(dice.choice([0, 1, 2])):
            parts += [dice.choice(passages), prose(dice.choice([0, 3, 30]))]
        out.append(dice.choice([" ", "\n", "\t\r\n"]).join(parts))
    return out + out[-4:]


def answer(df):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept"]) for r in df.collect())


@pytest.mark.parametrize("words,hot,part", [(200, 5000, 50), (S.WORDS, 5, S.PART), (400, 0, 300)])
def test_removal(docs, monkeypatch, words, hot, part):
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "PART", part)
    given = texts(words + hot)
    frame = docs(*given).withColumn("part", F.lit("clash")).withColumn("block", F.lit(0)).repartition(3, "text")
    assert answer(S.remove_repeats(frame, words)) == plain(list(enumerate(given)))


def test_ids_that_repeat_or_are_missing(docs):
    long = " ".join(f"w{i}" for i in range(30))
    got = answer(S.remove_repeats(docs((None, long), (7, long), (3, long + " z"), (3, "y")).coalesce(1)))
    assert got == sorted([("3", 31, 0, long + " z"), ("3", 1, 0, "y"), ("7", 30, 30, ""), ("None", 30, 30, "")])
    twice = answer(S.remove_repeats(docs((3, long), (3, long))))
    assert [row[2] for row in twice] in ([0, 30], [30, 0])
    assert S.remove_repeats(docs()).count() == 0


def test_super_kmers_cover_all_windows_once():
    words = [w.encode() for w in (texts(3)[30] + " x" * 900).split()]
    starts, sizes, minimisers, counts = S.super_kmers(words, S.WordHashes())
    assert np.concatenate([np.arange(a, a + n) for a, n in zip(starts, sizes)]).tolist() == list(range(len(words) - 19))
    assert sizes.max() == S.LONGEST and counts.max() == 2 and len(minimisers) == len(starts)
