"""Hard negatives against scoring every anchor with every row."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, anchor boolean, vector array<float>"


def plain(rows, positives=5, negatives=5):
    usable = []
    for vec_id, label, anchor, vector in rows:
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            usable.append((vec_id, label, anchor, [math.floor(256 * float(np.float32(x))) for x in vector]))
    key = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for at, (anchor_id, label, anchor, vector) in enumerate(usable):
        if not anchor:
            continue
        scored = [(sum(a * b for a, b in zip(vector, v)), i, x) for j, (i, x, _, v) in enumerate(usable) if j != at]
        for p, positive_id, _ in sorted((r for r in scored if r[2] == label), key=key)[:positives]:
            fits = sorted((r for r in scored if r[2] != label and 80 * p <= 100 * r[0] <= 100 * p), key=key)
            out += [(anchor_id, positive_id, rank, i, p, s) for rank, (s, i, _) in enumerate(fits[:negatives], 1)]
    return sorted(out, key=str)


def answer(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def some_rows(seed, n=300, width=10):
    dice = random.Random(seed)
    heads = [[dice.gauss(0, 0.3) for _ in range(width)] for _ in range(4)]
    rows = []
    for i in range(n):
        vector = [x + dice.gauss(0, 0.1) for x in dice.choice(heads)]
        rows.append((i, dice.choice([0, 0, 0, 1, 2]), i % 20 == 0, vector))
    same = rows[3][3]
    rows += [(n + i, i % 3, i % 5 == 0, same) for i in range(40)]  # ties
    rows += [(7, 0, True, same), (7, 0, True, same), (None, 1, False, same), (None, 0, None, same), (n + 90, 0, True, same[:4])]
    rows += [(900, None, True, same), (901, 0, True, None), (902, 0, True, [math.nan] * width), (903, 1, True, [math.inf] + same[1:])]
    rows += [(904, 0, True, [None] + same[1:]), (905, 1, True, []), (906, 9, True, same)]
    return rows


@pytest.mark.parametrize("tile,anchors,candidates", [(2048, 16384, 65536), (16, 8, 40), (50, 1, 1)])
def test_against_all_products(spark, monkeypatch, tile, anchors, candidates):
    for name, value in (("TILE", tile), ("ANCHORS", anchors), ("CANDIDATES", candidates), ("CHUNK", 7), ("LEAF", 2)):
        monkeypatch.setattr(H, name, value)
    rows = some_rows(tile)
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("tile", F.lit("clash")).withColumn("score", F.lit(1)).repartition(5)
    got = answer(H.hard_negatives(frame))
    assert got == plain(rows) and len(got) > 100


def test_empty(spark):
    assert H.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    no_anchor = spark.createDataFrame([(1, 1, False, [1.0]), (2, 2, None, [1.0])], SCHEMA)
    assert H.hard_negatives(no_anchor).count() == 0
    assert H.hard_negatives(spark.createDataFrame([(0, 1, True, [1.0])], SCHEMA)).count() == 0


def test_scores_beyond_64_bits(spark):
    with pytest.raises(Exception, match="too long for scores"):
        H.hard_negatives(spark.createDataFrame([(0, 1, True, [1e30])], SCHEMA)).count()


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 7), (33, 17, 40), (64, 64, 64), (5, 0, 4)])
def test_strassen_is_exact_modulo_2_64(shape):
    m, k, n = shape
    dice = np.random.default_rng(sum(shape))
    for top in (300, 2**62):
        a, b = dice.integers(-top, top, (m, k)), dice.integers(-top, top, (k, n))
        expected = [[sum(int(x) * int(y) for x, y in zip(row, column)) for column in b.T] for row in a]
        expected = [[(x + 2**63) % 2**64 - 2**63 for x in row] for row in expected]
        assert H.strassen(a, b, leaf=2).tolist() == (expected if n else [[]] * m)


def test_windows_are_exact():
    for score in (-11, 0, 1, 4, 5, 99, 10**18 + 3):
        least, most = H._window(score, (80, 100), (100, 100))
        assert most == score and 80 * score <= 100 * least < 80 * score + 100
