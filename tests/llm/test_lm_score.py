"""Language-model scores: counts and base against plain Python, the model on held-out text."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.llm import blocks as B
from ordermill.llm import lm_score as L


def plain(rows):
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2

    def tokens(text):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]

    counts = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = {}
    for i, text in rows:
        found = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (n + 1 * (v + 1))) for t in found)
        out[i] = (held(i), len(found), sum(counts[t] > 0 for t in found), n, pytest.approx(base, rel=1e-9))
    return out


def prose(seed, n=250):
    dice = random.Random(seed)
    follows = {"the": ["cat", "dog", "sun"], "cat": ["sat", "ran"], "dog": ["ran", "barked"], "sun": ["shone"]}
    out = []
    for _ in range(n):
        words = ["the"]
        for _ in range(dice.choice([5, 40, 120])):
            words.append(dice.choice(follows.get(words[-1], ["the", "and", "the", f"w{dice.randrange(300)}"])))
        out.append(" ".join(words))
    return out


@pytest.fixture(params=[400, 10**6])
def block_words(request, monkeypatch):
    build = B.write_blocks
    monkeypatch.setattr(L, "write_blocks", lambda docs, split, counted: build(docs, split, counted, words=request.param))


def test_counts_base_and_model(docs, as_dicts, block_words):
    texts = [None, "", " ", "The THE the É é zzz", "only-once", "x " * 4000, *prose(1)]
    frame = docs(*texts).withColumn("words", F.lit("clash")).withColumn("payload", F.lit(0)).repartition(3)
    got = as_dicts(L.score_documents(frame))
    want = plain(list(enumerate(texts)))
    columns = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score")
    assert {i: tuple(r[c] for c in columns) for i, r in got.items()} == want
    held = [r for i, r in got.items() if r["held_out"] and i > 5]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) * 0.9  # a clearly better model
    assert all(r["score"] < 0 for r in got.values())


def test_more_rounds_fit_better(docs, as_dicts):
    frame = docs(*prose(2, 120)).coalesce(2)
    scores = [sum(r["score"] for r in as_dicts(L.score_documents(frame, rounds)).values()) for rounds in (0, 1, 3)]
    assert scores[0] < scores[1] < scores[2]


def test_probabilities_sum_to_one(docs):
    """Over all known words and one unknown per shared class, after any context."""
    documents, words = B.write_blocks(docs(*[(i, t) for i, t in enumerate(prose(3, 60))]).coalesce(1), lambda: L.tokens_of, L.in_training)
    counted = B.store_by_block(words.groupBy("part").applyInArrow(L._count_part, L.COUNTED), "counts")
    ends = sum(L.in_training(i) for i in range(60))
    totals = L.Totals(counted, ends)
    known = Counter(t for i, text in enumerate(prose(3, 60)) if L.in_training(i) for t in L.tokens_of(text))
    counts, hashes = np.array(list(known.values())), np.array([L._hash(w) for w in known])
    classes = totals.classes(counts, hashes)
    mass = np.bincount(classes, counts + 1, L.CLASSES)
    mass[L.FREQUENT + 1 :] += 1
    used = totals.mass > 1
    assert np.allclose(mass[used], totals.mass[used])
    assert totals.tokens == counts.sum() and totals.distinct == len(known)


def test_repeated_ids_and_empty_table(docs):
    got = L.score_documents(docs((3, "a b"), (3, "a b"), (None, "a"))).collect()
    assert sorted(r["n_tokens"] for r in got) == [2, 3, 3]
    assert L.score_documents(docs()).count() == 0
    only = next(i for i in range(100) if not L.in_training(i))
    row = L.score_documents(docs((only, "a b"))).first()
    assert (row["train_tokens"], row["n_known"], row["base_score"]) == (0, 0, 0.0)


def test_training_goes_on_until_rounds_change_little(docs, as_dicts):
    frame = docs(*prose(4, 120)).coalesce(2)
    score = lambda rounds: sum(r["score"] for r in as_dicts(L.score_documents(frame, *rounds)).values())
    few, default, more = score([2]), score([]), score([L.ROUNDS + 4])
    assert default > few and more - default < (default - few) / 2


def test_contexts_count_what_tokens_say():
    dice = np.random.default_rng(5)
    last, before = dice.integers(0, 9, 500).astype(np.uint64), dice.integers(0, 9, 500).astype(np.uint64)
    weights, bias = dice.normal(0, 1, (L.BUCKETS, L.CLASSES)).astype(np.float32), dice.normal(0, 1, L.CLASSES).astype(np.float32)
    want = np.zeros((L.BUCKETS, L.CLASSES))
    for _, features in L._features(last, before):
        p = np.exp(L._logits(weights, bias, features).astype(np.float64))
        for row in features:
            np.add.at(want, row, p / p.sum(1, keepdims=True))
    got = L._expected(*L._unpack_contexts(L._pack_contexts(last, before)), weights, bias)
    assert np.allclose(got, want, atol=1e-3)


def test_rounds_read_each_context_once(docs, spark, monkeypatch):
    """However many blocks hold a context, its softmax is worked out once a round."""
    stored = {}
    store = L.store_by_block
    monkeypatch.setattr(L, "store_by_block", lambda rows, purpose, *by: stored.setdefault(purpose, store(rows, purpose, *by)))
    build = B.write_blocks
    monkeypatch.setattr(L, "write_blocks", lambda rows, split, counted: build(rows, split, counted, words=50))
    texts = ["a b c a b", "b c a"] * 40
    L.score_documents(docs(*texts).repartition(4), 2).count()
    rows = [L._unpack_contexts(bytes(r.contexts)) for r in stored["contexts"].where("contexts IS NOT NULL").collect()]
    found = [(a, b) for last, before, _ in rows for a, b in zip(last.tolist(), before.tolist())]
    want = Counter()
    for i, text in enumerate(texts):
        hashes = [70000, 70000, *map(L._hash, L.tokens_of(text))]
        want.update(zip(hashes[1:-1], hashes[:-2]) if L.in_training(i) else ())
    assert sorted(found) == sorted(want)
    assert sum(int(n.sum()) for *_, n in rows) == sum(want.values())


def test_words_of_one_class_are_told_apart_by_what_goes_before(docs, as_dicts, block_words):
    """Every pair of words counts, not only the class of the next word."""
    alike = [w for w in (f"w{i}" for i in range(3000)) if L._hash(w.encode()) % L.HASHED == 3][:80]
    filler = " ".join(f"f{i}" for i in range(L.FREQUENT))  # these have the classes of their own
    pairs = list(zip(alike[:40], alike[40:]))
    seen = [f"{filler} {a} {b}" for a, b in pairs] * 8
    swapped = [f"{filler} {a} {b}" for (a, _), (_, b) in zip(pairs, [*pairs[1:], pairs[0]])]
    held = [i for i in range(2000) if not L.in_training(i)][: 2 * len(pairs)]
    rows = [*enumerate(seen, 10_000), *zip(held, [*seen[: len(pairs)], *swapped])]
    got = as_dicts(L.score_documents(docs(*rows).repartition(3)))
    right, wrong = held[: len(pairs)], held[len(pairs) :]
    assert min(got[i]["score"] for i in right) > max(got[i]["score"] for i in wrong) + 0.5


def test_triples_are_counted_over_all_blocks(docs, spark, monkeypatch):
    stored = {}
    store = L.store_by_block
    monkeypatch.setattr(L, "store_by_block", lambda rows, purpose, *by: stored.setdefault(purpose, store(rows, purpose, *by)))
    build = B.write_blocks
    monkeypatch.setattr(L, "write_blocks", lambda rows, split, counted: build(rows, split, counted, words=50))
    texts = [None, "a b c a b", "b c a", "a b"] * 30
    L.score_documents(docs(*texts).repartition(4), 0).count()
    pairs, triples = Counter(), Counter()
    for i, text in enumerate(texts):
        words = [0, 0, *(L.tokens_of(text or ""))]
        if L.in_training(i):
            pairs.update(zip(words[1:], words[2:]))
            triples.update(zip(words, words[1:], words[2:]))
    got = [L.unpack_columns(bytes(r.payload), 2)[0] for r in stored["triples"].collect()]
    assert len(got) > 1
    got = {tuple(each) for found in got for each in found.T.tolist()}
    assert got == {(pairs[key[1:]], n) for key, n in triples.items()}


def test_mixed_probabilities_sum_to_one():
    """Over all words after each of some contexts, whatever the softmax says of them."""
    dice = np.random.default_rng(11)
    texts = [dice.integers(0, 5, 12).tolist() + [5] for _ in range(40)]  # 5 is the end mark
    pairs, triples, words = Counter(), Counter(), Counter()
    for text in texts:
        words.update(text)
        pairs.update(zip([-1, *text], text))
        triples.update(zip([-1, -1, *text], [-1, *text], text))
    softmax = np.array([0.3, 0.2, 0.2, 0.15, 0.1, 0.05])
    for before, last in [(0, 1), (2, 2), (-1, 3), (-1, -1)]:
        total = 0.0
        for word in range(6):
            text = [w for w in (before, last, word) if w >= 0]
            tokens = L._Tokens.__new__(L._Tokens)
            tokens.starts, tokens.sizes = np.array([0]), np.array([len(text)])
            tokens.counts = np.array([words[w] for w in text])
            tokens.crcs = np.array([w + 1 for w in text])
            at = np.unique(tokens.triples(), return_index=True)[1]
            padded = [-1, -1, *text]
            answers = L.pack_columns(
                np.array([pairs[tuple(padded[i + 1 : i + 3])] for i in at]), np.array([triples[tuple(padded[i : i + 3])] for i in at])
            )
            totals = type("Totals", (), {"ends": len(texts)})
            total += math.exp(L._mixed(tokens, [answers], np.log(softmax[text]), totals)[-1])
        assert total == pytest.approx(1)
