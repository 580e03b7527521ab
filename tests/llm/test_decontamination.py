"""The positional index against a plain search of every window."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from ordermill.llm import decontamination as D


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(texts, items, window=13):
    out = {}
    for i, text in enumerate(texts):
        words, hit, found = plain_words(text), set(), set()
        for item, other in items:
            terms = plain_words(other)
            size = min(window, len(terms))
            for at in range(len(terms) - size + 1) if terms else []:
                for start in range(len(words) - size + 1):
                    if words[start : start + size] == terms[at : at + size]:
                        hit |= set(range(start, start + size))
                        found.add("" if item is None else str(item))
        out[i] = (len(words), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(words))
    return out


@pytest.fixture
def case():
    dice = random.Random(8)
    prose = lambda n: " ".join(dice.choice("abcdÉé9") * dice.choice([1, 2]) for _ in range(n))
    items = [(i, prose(n)) for i, n in enumerate([30, 20, 13, 12, 5, 14])]
    items += [(10, ""), (11, None), (12, "Zeta-zeta"), (None, prose(15)), (3, prose(16)), (0, items[0][1])]
    texts = [None, "", "...", "zeta ZETA!", "a " * 4000]
    for _ in range(50):
        parts = [prose(dice.choice([0, 9, 60]))]
        for _, text in dice.sample(items, 2):
            words = (text or "").split()
            cut = dice.choice([0, 1, 5])
            parts += [", ".join(words[cut:]).upper() if dice.random() < 0.3 else " ".join(words[cut:]), prose(dice.choice([0, 30]))]
        texts.append(". ".join(parts))
    return texts + texts[-3:], items


@pytest.mark.parametrize("limit", [0, D.MAX_TERMS])
@pytest.mark.parametrize("slice_words", [20, D.SLICE_WORDS])
def test_contamination(spark, docs, as_dicts, case, monkeypatch, limit, slice_words):
    monkeypatch.setattr(D, "MAX_TERMS", limit)
    monkeypatch.setattr(D, "SLICE_WORDS", slice_words)
    texts, items = case
    frame = docs(*texts).withColumn("n_words", F.lit("clash")).withColumn("term", F.lit(1)).repartition(3)
    small = lambda d, i: build(d, i, words=3000)
    build = D.build_index
    monkeypatch.setattr(D, "build_index", small)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = as_dicts(D.contamination(frame, benchmark))
    assert {i: (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for i, r in got.items()} == plain(texts, items)


def test_repeated_ids_and_empty_tables(spark, docs):
    benchmark = spark.createDataFrame([(1, "x y z")], "item_id long, text string")
    got = D.contamination(docs((5, "x y z"), (5, "q"), (None, "x y z")), benchmark).collect()
    assert sorted((str(r["doc_id"]), r["n_hit"]) for r in got) == [("5", 0), ("5", 3), ("None", 3)]
    assert D.contamination(docs(), benchmark).count() == 0
    assert D.contamination(docs("x y z"), benchmark.limit(0)).first()["contaminated"] is False


def test_proximity(spark, docs):
    benchmark = spark.createDataFrame([(1, "alpha beta beta"), (2, "gamma")], "item_id long, text string")
    index = D.build_index(docs("alpha x x beta", "beta x x x x alpha beta", "alpha x x x beta", "gamma"), benchmark)
    got = {(r["doc_id"], r["item"], r["start"], r["end"]) for r in D.proximity_matches(index, benchmark, 4).collect()}
    assert got == {(0, "1", 0, 4), (1, "1", 5, 7), (3, "2", 0, 1)}
    whole = D.build_index(docs("any term is there"))
    assert whole.where("term is not null").count() == 4


def test_rows_of_one_id_or_none_go_one_by_one(docs):
    item = " ".join(f"w{i}" for i in range(40))
    items = docs(item).withColumnRenamed("doc_id", "item_id")
    bad, good = "x " + item, "y " * 30
    frame = docs((None, bad), (None, good), (None, None), (7, bad), (7, good), (7, bad), (8, "z " * 30), (9, bad)).repartition(3)
    left = D.without_contaminated(frame, items).collect()
    assert sorted(left, key=str) == sorted([(None, good), (None, None), (7, good), (8, "z " * 30)], key=str)
