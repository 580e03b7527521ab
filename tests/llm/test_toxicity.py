"""Toxicity on generated prose: held-out accuracy, misspellings, long texts."""

from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.llm import toxicity as T

BAD = ["blortface", "snargle", "wuggish"]


@pytest.fixture(scope="module")
def corpus(spark):
    dice = random.Random(21)
    syllables = ["ta", "ne", "ri", "so", "mu", "lek", "ban", "dor"]
    word = lambda: "".join(dice.choice(syllables) for _ in range(dice.choice([1, 2, 3])))
    rows, labels = [], []
    for i in range(500):
        toxic = int(i % 5 == 0)
        words = [word() for _ in range(dice.choice([10, 60, 400]))]
        if toxic:
            for _ in range(max(2, len(words) // 60)):
                words.insert(dice.randrange(len(words)), dice.choice(BAD) + dice.choice(["", "s", "ly"]))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    extra = [(1000, None), (1001, ""), (1002, "snarglle you bloortface"), (1003, "ta ne " * 3000), (1004, "ta ne " * 3000 + "snargle wuggish")]
    docs = spark.createDataFrame(rows + extra + [(None, "snargle wuggish")], "doc_id long, text string")
    docs = docs.withColumn("toxic", F.lit("clash")).withColumn("score", F.lit(0))
    return docs, spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, toxic int"), dict(labels)


def test_held_out_accuracy(corpus, as_dicts):
    docs, labels, truth = corpus
    got = as_dicts(T.toxicity(docs, labels))
    for i, label in truth.items():
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        if got[i]["held_out"]:
            assert got[i]["predicted"] == label
    assert got[1002]["score"] > 0.5 > got[1003]["score"]
    assert got[1004]["predicted"] == 1
    assert got[1000]["score"] == got[1001]["score"] < 0.5
    assert got[None]["predicted"] == 1 and got[None]["held_out"] is False
    assert all(0 <= row["score"] <= 1 for row in got.values())


def test_held_out_labels_change_nothing(corpus, as_dicts):
    docs, labels, _ = corpus
    turned = labels.withColumn("toxic", F.when(T.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    some = docs.where("doc_id < 60")
    a, b = (as_dicts(T.toxicity(some, x)) for x in (labels, turned))
    assert a == b


def test_no_labels_and_no_rows(corpus, docs):
    _, labels, _ = corpus
    assert T.toxicity(docs(), labels).count() == 0
    assert T.toxicity(docs("a b"), labels.limit(0)).first()["predicted"] == 0
    assert T.toxicity(docs("a b"), labels.where("toxic = 0")).first()["predicted"] == 0


def test_sample_is_bounded(corpus, monkeypatch):
    _, labels, _ = corpus
    monkeypatch.setattr(T, "TRAIN_TOXIC", 7)
    monkeypatch.setattr(T, "TRAIN_CLEAN", 9)
    assert T._sample(labels).groupBy("toxic").count().orderBy("toxic").collect() == [(0, 9), (1, 7)]


def test_a_phrase_counts_alike_wherever_it_stands():
    line = np.zeros(T.BUCKETS, np.float32)
    for bad in ("blort", "snargle", "wuggish"):
        line[T.subwords(bad)] = 30
    scores = T.WordScores(line)
    plain = [f"w{i}" for i in range(40)]
    found = {T.text_score(" ".join(plain[:at] + ["blort", "snargle", "wuggish"] + plain[at:]), scores, -8.0) for at in range(12)}
    assert max(found) - min(found) < 0.02 and min(found) > 0.9
    assert T.text_score("x blort y", scores, -8.0) < 0.5
    for n in range(1, 30):
        starts = T.passages(n)
        assert starts[0] == 0 and starts[-1] + T.PASSAGE >= n and (n <= T.PASSAGE or starts[-1] < n)
    assert T.subwords("né") == [zlib.crc32(p.encode()) % T.BUCKETS for p in ("<né", "né>", "<né>", "=<né>")]


def test_one_row_of_each_sampled_id_is_learnt_from(spark, monkeypatch):
    real = T.train

    def train(rows):
        kept = list(rows)
        assert len(kept) == 2
        return real(iter(kept))

    monkeypatch.setattr(T, "train", train)
    docs = spark.createDataFrame([(2, f"text {i}") for i in range(500)] + [(3, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(2, 0), (3, 1)], "doc_id long, toxic int")
    T.fit(docs, labels)


def test_repeated_rows_score_alike(docs):
    labels = docs((1, "x")).select("doc_id", F.lit(0).alias("toxic"))
    rows = T.toxicity(docs((5, "a b"), (5, "a b"), (None, "a b"), (5, None)), labels).collect()
    assert len(rows) == 4 and len({r["score"] for r in rows}) == 1


def test_training_holds_few_bytes_per_passage():
    """Numbers per passage and word are narrow: 1.5 million words are fitted within 32 bytes each beside their texts."""
    import tracemalloc

    words = [f"w{i}" for i in range(500)]
    dice = np.random.default_rng(3)
    text = " ".join(words[i] for i in dice.integers(0, 500, 15_000))
    steps, T.STEPS = T.STEPS, 2
    tracemalloc.start()
    try:
        T.train(iter([(text, i % 2) for i in range(100)]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        T.STEPS = steps
    fixed = 9 * T.BUCKETS * T.DIMENSIONS * 4  # the table, its slopes and Adam's states
    assert peak - fixed < 32 * 1_500_000


def test_training_holds_few_bytes_a_word():
    dice = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(2000)])
    rows = [(" ".join(words[dice.integers(0, 2000, 2500)]) + " snargle" * (i % 2), i % 2) for i in range(400)]

    def peak_beyond(some):
        tracemalloc.start()
        T.train(iter(some))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return peak

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(T, "STEPS", T.WARM_UP + 2)
        patch.setattr(T, "WARM_UP", 2)
        more = peak_beyond(rows) - peak_beyond(rows[:100])
    assert more < 12 * 300 * 2500  # what further words add: their numbers, and room to append
