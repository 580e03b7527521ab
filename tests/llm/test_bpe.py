"""Byte-level BPE by distinct words against encoding whole texts."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ordermill.llm import bpe
from ordermill.llm.blocks import pack, unpack, write_blocks
from ordermill.llm.token_counts import encoder

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [None, "", " ", "\n\n\n", "a", "don't  stop\n\n now ", "x" * 9000, "é漢字🙂 ́ \x1c\x85z", "<|endoftext|>", "12345 6'll"]


@pytest.fixture(params=[50, 10**6])
def block_words(request, monkeypatch):
    plain = write_blocks
    monkeypatch.setattr(bpe, "write_blocks", lambda docs, split, words: plain(docs, split, words=request.param))


def test_round_trip(spark, docs, as_dicts, block_words):
    dice = random.Random(5)
    words = ["the", "tionhe", "é", "don't", "42", "\n", "  ", "🙂", "of,", "\t"]
    given = ODD + [" ".join(dice.choice(words) for _ in range(dice.choice([3, 30, 90]))) for _ in range(40)] + ["copy"] * 5
    frame = docs(*given).withColumn("ids", F.lit("x")).withColumn("block", F.lit(1)).repartition(3)
    encoded = bpe.encode_documents(frame, RANKS, public_tokenizers.PATTERN)
    got = as_dicts(encoded)
    encode = encoder(RANKS, public_tokenizers.PATTERN).encode_ordinary
    assert {i: row["ids"] for i, row in got.items()} == {i: encode(t or "") for i, t in enumerate(given)}
    decoded = as_dicts(bpe.decode_documents(encoded, RANKS))
    assert {i: bytes(row["bytes"]) for i, row in decoded.items()} == {i: (t or "").encode() for i, t in enumerate(given)}


def test_repeated_ids_and_empty_table(docs):
    frame = docs((1, "a b"), (1, "a b"), (None, "a b"), (2, None))
    got = bpe.encode_documents(frame, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((str(r["doc_id"]), len(r["ids"])) for r in got) == [("1", 2), ("1", 2), ("2", 0), ("None", 2)]
    assert bpe.encode_documents(docs(), RANKS, public_tokenizers.PATTERN).count() == 0
    null = docs((1, "a")).select("doc_id", F.lit(None).cast("array<int>").alias("ids"))
    assert bpe.decode_documents(null, RANKS).first()["bytes"] is None


def test_joining_back_moves_no_documents(docs):
    plan = bpe.encode_documents(docs("a b c"), RANKS, public_tokenizers.PATTERN)
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(block") == 1  # the words' side only


@pytest.mark.parametrize("numbers", [[], [0], [5, 70000, 2**31 - 1, 0]])
def test_packing(numbers):
    assert unpack(pack(np.array(numbers, np.int32))).tolist() == numbers
