"""Quality rules, sharding and token counts against plain Python versions."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ordermill.llm import quality
from ordermill.llm.quality import RULES, measure, score_quality, vote_counts
from ordermill.llm.sharding import feistel, number_rows, permute, shard_documents
from ordermill.llm.token_counts import context_report, encoded_lengths, encoder, length_histogram, quantile_lengths, totals_at

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [None, "", " \t\n", "a", "a b", "x " * 3000, "é ü # *", "one two three one two three", "l\nl\n \n\nl"]


def texts(seed, n):
    dice = random.Random(seed)
    words = ["the", "of", "ca", "no#", "ü", "x&y", "lorem", "ipsum"]
    out = []
    for _ in range(n):
        size = dice.choice([1, 5, 40, 120, 300])
        out.append("".join(dice.choice(words) + dice.choice([" ", " ", " ", "\n", "\t", "\r\n"]) for _ in range(size)))
    return out


def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(grams)
    covered = {i + k for i, gram in enumerate(grams) if count[gram] > 1 for k in range(3)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": dups,
        "n_repeat_words": len(covered),
    }


def test_measures(docs, as_dicts):
    given = ODD + texts(1, 60)
    got = as_dicts(measure(docs(*given)))
    for i, text in enumerate(given):
        want = plain_measures(text)
        assert {k: got[i][k] for k in want} == want


def prose(dice, words=120):
    word = lambda: "".join(dice.choice("abcdefgh") for _ in range(dice.choice([4, 6, 8])))
    return "".join(word() + (".\n" if i % 12 == 11 else " ") for i in range(words))


def test_posterior_rejects_what_several_rules_reject_and_keeps_the_rest(docs, as_dicts):
    dice = random.Random(3)
    good = [prose(dice) for _ in range(60)]
    one_flaw = [prose(dice).replace(".\n", "\n") for _ in range(3)] + [prose(dice) + " 12 34 56 78 90 11 22 33" * 2 for _ in range(2)]
    junk = [prose(dice).replace(" ", " ### ").replace(".\n", " |\n") for _ in range(6)]  # passes the base
    failing = ["#$% " * 20 + "\n" + "\n".join(["q#"] * 200) for _ in range(4)]
    scored = score_quality(docs(*good, *one_flaw, *junk, *failing))
    got = as_dicts(scored)
    assert [got[i]["kept"] for i in range(len(got))] == [True] * 65 + [False] * 10
    assert [got[i]["base_failed"] for i in range(len(got))] == [False] * 71 + [True] * 4
    for row in got.values():
        assert row["base_failed"] == (row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"])
        assert len(row["votes"]) == len(RULES)
    counts = {r["rule"]: (r["good"], r["bad"], r["abstained"]) for r in vote_counts(scored).collect()}
    assert all(sum(n) == len(got) for n in counts.values()) and counts["letters"][1] >= 6 and counts["ended_lines"][1] >= 9


def plain_estimate(patterns, rounds):
    """EM over (votes, n), on plain numbers."""
    prior, good, bad = quality.START
    for _ in range(rounds):
        weights = []
        for votes, _ in patterns:
            odds = prior / (1 - prior)
            for v, g, b in zip(votes, good, bad):
                odds *= g / (1 - b) if v > 0 else (1 - g) / b if v < 0 else 1
            weights.append(odds / (1 + odds))
        total = sum(n for _, n in patterns)
        prior = min(max(sum(w * n for w, (_, n) in zip(weights, patterns)) / total, 0.2), 0.995)
        good, bad = [], []
        for at in range(len(RULES)):
            cast = [(w, n, votes[at]) for w, (votes, n) in zip(weights, patterns) if votes[at]]
            right_good, cast_good = sum(w * n for w, n, v in cast if v > 0), sum(w * n for w, n, _ in cast)
            right_bad, cast_bad = sum((1 - w) * n for w, n, v in cast if v < 0), sum((1 - w) * n for w, n, _ in cast)
            good.append(min(max((right_good + 9) / (cast_good + 10), 0.55), 0.995))
            bad.append(min(max((right_bad + 0.5) / (cast_bad + 1), 1 - good[-1]), 0.98))
    return prior, good, bad


def test_estimate_is_plain_em(spark):
    dice = random.Random(5)
    patterns = [([dice.choice([1, 1, 1, 0]) for _ in RULES], dice.randint(1, 90)) for _ in range(12)]
    patterns += [([dice.choice([-1, -1, 0, 1]) for _ in RULES], dice.randint(1, 9)) for _ in range(8)]
    found = quality.estimate(spark.createDataFrame(patterns, "votes array<int>, n long"), 5)
    prior, good, bad = plain_estimate(patterns, 5)
    assert [found.prior, *found.on_good, *found.on_bad] == pytest.approx([prior, *good, *bad])


def test_quality_of_labelled_documents(spark):
    """Rejects beyond the base, held against labels that had no part in them."""
    folder = "/root/testdata/sf0.01"
    scored = score_quality(spark.read.parquet(f"{folder}/documents.parquet"))
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rejected = scored.where("NOT base_failed AND NOT kept").join(labels, "doc_id").groupBy("quality").count().collect()
    found = {r["quality"]: r["count"] for r in rejected}
    passed = scored.where("kept").join(labels, "doc_id").where("quality = 0").count()
    assert found[0] >= 20 and found.get(1, 0) <= 1 and passed <= 1


def test_quality_of_nothing_and_clashing_columns(docs):
    assert score_quality(docs()).count() == 0
    assert [r["kept"] for r in score_quality(docs((1, "a"), (1, "a"), (None, None))).collect()] == [False] * 3
    clash = docs("a b c").withColumn("n_words", F.lit("x")).withColumn("votes", F.lit(1)).withColumn("w", F.lit(1))
    assert score_quality(clash).first()["n_words"] == 3


@pytest.mark.parametrize("n", [1, 2, 3, 5, 40, 41, 1000, 4099])
def test_permutation_is_one(spark, n):
    got = [r["position"] for r in permute(spark.range(n), "id", n).collect()]
    assert sorted(got) == list(range(n))


def test_feistel_covers_its_domain(spark):
    assert spark.range(35).select(feistel(F.col("id"), 5, 7).alias("p")).distinct().count() == 35


def test_row_numbers_count_repeated_rows(spark):
    rows = spark.createDataFrame([(1,)] * 70000 + [(i,) for i in range(500)] + [(None,)] * 3, "k long")
    got = number_rows(rows, ["k"])
    assert got.agg(F.min("row_number"), F.max("row_number"), F.countDistinct("row_number")).first()[:] == (0, 70502, 70503)
    spread = got.where("k = 1").agg(F.max("row_number") - F.min("row_number")).first()[0]
    assert spread == 70000  # 70,001 copies in a row


def test_a_million_equal_rows_are_numbered_by_several_tasks(spark):
    rows = spark.range(1_000_000).select(F.lit(1).alias("k")).union(spark.range(1000).select(F.col("id") + 10))
    got = number_rows(rows, ["k"]).withColumn("task", F.spark_partition_id())
    assert got.agg(F.countDistinct("row_number")).first()[0] == 1_001_000
    shares = [r["count"] for r in got.where("k = 1").groupBy("task").count().collect()]
    assert len(shares) > 2 and max(shares) < 700_000


def test_shards(docs, as_dicts):
    given = ODD + ["same"] * 100 + texts(2, 150)
    frame = docs(*given)
    got = as_dicts(shard_documents(frame, 7))
    for i, text in enumerate(given):
        data = (text or "").encode()
        assert (got[i]["size"], got[i]["text_crc32"]) == (len(data) + 16, zlib.crc32(data))
    slots = {}
    for row in got.values():
        slots.setdefault(row["shard"], []).append(row["slot"])
    sizes = [len(s) for s in slots.values()]
    assert len(slots) == 7 and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = as_dicts(shard_documents(frame.repartition(3, "text"), 7))
    assert again == got
    assert shard_documents(docs()).count() == 0


def test_context_report(docs, as_dicts):
    given = ODD + texts(4, 80)
    lengths = as_dicts(encoded_lengths(docs(*given), RANKS, public_tokenizers.PATTERN))
    encode = encoder(RANKS, public_tokenizers.PATTERN).encode_ordinary
    want = [len(encode(t or "")) for t in given]
    assert [lengths[i]["n_tokens"] for i in range(len(given))] == want
    histogram = length_histogram(encoded_lengths(docs(*given), RANKS, public_tokenizers.PATTERN))
    report = context_report(histogram)
    shares = [0.01, 0.5, 0.9, 1.0]
    assert quantile_lengths(report, shares) == {q: next(w for w in sorted(want) if sum(x <= w for x in want) >= q * len(want)) for q in shares}
    limits = [0, 1, 7, max(want) + 5, *want[:3]]
    for r in totals_at(histogram, limits).collect():
        over = [w for w in want if w > r["context_limit"]]
        cut = sum(min(w, r["context_limit"]) for w in want)
        assert (r["docs_over"], r["tokens_over"], r["truncated_total"], r["tokens_lost"]) == (len(over), sum(over), cut, sum(want) - cut)
    report = report.collect()
    assert sorted(r["context_limit"] for r in report) == sorted(set(want))
    for r in report:
        limit = r["context_limit"]
        assert r["n_docs"] == want.count(limit)
        assert r["docs_over"] == sum(w > limit for w in want)
        assert r["tokens_over"] == sum(w for w in want if w > limit)
        assert r["truncated_total"] == sum(min(w, limit) for w in want)
        assert r["tokens_lost"] == sum(want) - r["truncated_total"]
        assert r["quantile"] == pytest.approx(sum(w <= limit for w in want) / len(want))
    empty = encoded_lengths(docs(), RANKS, public_tokenizers.PATTERN)
    nothing = context_report(length_histogram(empty))
    assert nothing.count() == 0 and quantile_lengths(nothing, [0.5]) == {0.5: None}
    for wrong in (lambda: totals_at(nothing, [-1]), lambda: quantile_lengths(nothing, [0.0])):
        with pytest.raises(ValueError):
            wrong()


def test_repeated_and_missing_ids_count_each(docs):
    lengths = encoded_lengths(docs((1, "a b"), (1, "a b"), (None, "a b"), (2, None)), RANKS, public_tokenizers.PATTERN)
    assert sorted(tuple(r) for r in length_histogram(lengths).collect()) == [(0, 1), (2, 3)]
