"""Quality by weak supervision: rules vote or abstain, and EM weighs the votes.  Built-in functions only.

Each rule looks at one measured quantity and votes good (1), bad (-1) or abstains (0).  Where it does so follows from the
corpus: its quartiles among the documents that pass the base tell what is usual, votes for bad begin FAR spreads
beyond them, on the side or sides where a rule looks for flaws, and votes for good end NEAR spreads beyond.

Expectation maximisation estimates for every rule two accuracies, how often it is right on good and on bad documents when it
votes, and the share of good documents, from the votes alone: documents are first counted by vote pattern (at most
3**len(RULES) patterns, whatever the corpus), and each round is one aggregate over that table.  A rule whose votes do
not go with the others' gets accuracies that cancel out, and so no say.  A document's posterior probability of being good
decides, instead of "all rules must pass".  Labels play no part.

Accuracies stay within bounds that keep a rule's direction (EM could else swap good and bad) and keep one vote from
deciding alone.

Cases: a null text has no words; no words fails the base; equal texts get equal rows; an empty table
gives an empty result; other columns are ignored.  Very long texts are measured whole.  Where no document passes the
base there are no quartiles, and all rules abstain.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.shared import SPACES, doc_texts, stage

SYMBOLS = "#*$%&|<>"
ENDED = r"""[.!?\u2026]["'\u201d\u2019\u00bb)\]]*$"""
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
ROUNDS = 12
START_PRIOR, START_ON_GOOD, START_ON_BAD = 0.9, 0.9, 0.6
MOST_ON_GOOD, MOST_ON_BAD = 0.995, 0.98
LEAST_ON_GOOD = 0.55
PRIOR_RANGE = (0.2, 0.995)
KEEP_FROM = 0.5
NEAR, FAR = 1.5, 3.0
RANKS = 10_000  # accuracy of the quartiles: one in so many ranks


class Rule(NamedTuple):
    """A quantity, the sides on which it is a flaw (-1 low, 1 high, 0 both), and the least spread of its quartiles:
    so much, or with ``relative`` so much of the median."""

    value: Callable[[], Column]
    side: int
    spread: float
    relative: bool = False


def _share(part: str, whole: str) -> Callable[[], Column]:
    return lambda: F.col(part) / F.greatest(F.col(whole), F.lit(1))


RULES = {
    "letters": Rule(_share("n_letters", "word_chars"), -1, 0.02, relative=True),
    "symbols": Rule(_share("n_symbols", "n_words"), 1, 0.02),
    "ended_lines": Rule(_share("n_ended_lines", "n_lines"), -1, 0.05),
    "word_length": Rule(_share("word_chars", "n_words"), 0, 0.05, relative=True),
    "repeats": Rule(_share("n_repeat_words", "n_words"), 1, 0.05),
    "copied_lines": Rule(_share("n_dup_lines", "n_lines"), 1, 0.05),
}


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more; ``words`` is an array.

    Where all windows differ by hash, none occurs twice; only other texts have theirs sorted.
    """
    starts = F.sequence(F.lit(1), F.size(words) - 2)

    def covered(grams: Column) -> Column:
        last = F.size(grams) - 1

        def repeated(gram: Column, at: Column) -> Column:
            before = (at > 0) & (F.get(grams, at - 1)["g"] == gram["g"])
            return before | ((at < last) & (F.get(grams, at + 1)["g"] == gram["g"]))

        spans = F.transform(F.filter(grams, repeated), lambda gram: F.array(gram["i"], gram["i"] + 1, gram["i"] + 2))
        return F.size(F.array_distinct(F.flatten(spans)))

    def gram(i: Column) -> Column:
        text = F.concat_ws(" ", F.get(words, i - 1), F.get(words, i), F.get(words, i + 1))
        return F.struct(text.alias("g"), i.alias("i"))

    hashes = F.transform(starts, lambda i: F.xxhash64(F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)))
    return (
        F.when(F.size(words) < 3, F.lit(0))
        .when(F.size(F.array_distinct(hashes)) == F.size(words) - 2, F.lit(0))
        .otherwise(_bind(F.sort_array(F.transform(starts, gram)), covered))
    )


def measure(docs: DataFrame) -> DataFrame:
    """The quantities the rules look at, one row per document."""
    texts = doc_texts(docs)
    text = F.col("text")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.trim(line, F.lit(SPACES))) > 0)

    def of_words(w: Column) -> Column:
        chars = F.length(F.concat_ws("", w))
        return F.struct(F.size(w).alias("n_words"), chars.alias("chars"), _repeated_words(w).alias("n_repeat_words"))

    def of_lines(x: Column) -> Column:
        ended = F.size(F.filter(x, lambda line: F.right(F.rtrim(line), F.lit(3)).rlike(ENDED)))
        copies = F.size(x) - F.size(F.array_distinct(x))
        return F.struct(F.size(x).alias("n_lines"), copies.alias("n_dup_lines"), ended.alias("n_ended_lines"))

    measured = texts.select(
        "doc_id",
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, r"\P{L}+", "")).cast("long").alias("n_letters"),
        _bind(words, of_words).alias("w"),
        _bind(lines, of_lines).alias("l"),
    )
    return measured.select(
        "doc_id",
        F.col("w.n_words").cast("long").alias("n_words"),
        F.col("w.chars").cast("long").alias("word_chars"),
        "n_symbols",
        F.col("l.n_dup_lines").cast("long").alias("n_dup_lines"),
        F.col("w.n_repeat_words").cast("long").alias("n_repeat_words"),
        F.col("l.n_lines").cast("long").alias("n_lines"),
        F.col("l.n_ended_lines").cast("long").alias("n_ended_lines"),
        "n_letters",
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def cut_points(passing: DataFrame) -> dict[str, tuple[float, float, float, float] | None]:
    """For each rule the bounds (bad below, good from, good to, bad above), from one aggregate over the rows."""
    quartiles = [F.percentile_approx(rule.value(), [0.25, 0.5, 0.75], RANKS).alias(name) for name, rule in RULES.items()]
    row, found = passing.agg(*quartiles).first(), {}
    for name, rule in RULES.items():
        if row[name] is None:
            found[name] = None
            continue
        low, middle, high = row[name]
        spread = max(high - low, rule.spread * (abs(middle) if rule.relative else 1))
        found[name] = (low - FAR * spread, low - NEAR * spread, high + NEAR * spread, high + FAR * spread)
    return found


def _vote(rule: Rule, bounds: tuple[float, float, float, float] | None) -> Column:
    if bounds is None:
        return F.lit(0)
    bad_below, good_from, good_to, bad_above = map(F.lit, bounds)
    value, never = rule.value(), F.lit(False)
    bad = (value < bad_below if rule.side <= 0 else never) | (value > bad_above if rule.side >= 0 else never)
    good = (value >= good_from if rule.side <= 0 else ~never) & (value <= good_to if rule.side >= 0 else ~never)
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("int")


class Model(NamedTuple):
    """The share of good documents, and each rule's accuracy on good and on bad ones."""

    prior: float
    on_good: list[float]
    on_bad: list[float]


START = Model(START_PRIOR, [START_ON_GOOD] * len(RULES), [START_ON_BAD] * len(RULES))


def _posterior(votes: Column, model: Model) -> Column:
    """The probability of good: the prior's log odds and, for each vote cast, the rule's."""
    total = F.lit(math.log(model.prior / (1 - model.prior)))
    for at, (good, bad) in enumerate(zip(model.on_good, model.on_bad)):
        vote = F.get(votes, F.lit(at))
        total = total + F.when(vote > 0, math.log(good / (1 - bad))).when(vote < 0, math.log((1 - good) / bad)).otherwise(0.0)
    return F.lit(1.0) / (1.0 + F.exp(-total))


def _held(value: float, least: float, most: float) -> float:
    return min(max(value, least), most)


def estimate(patterns: DataFrame, rounds: int = ROUNDS) -> Model:
    """The model by EM over (votes, n): each round sends one row of sums to the driver."""
    model = START
    for _ in range(rounds):
        good = _posterior(F.col("votes"), model)
        sums = [F.sum(F.col("n")).alias("n"), F.sum(F.col("n") * good).alias("good")]
        for at in range(len(RULES)):
            vote = F.get("votes", F.lit(at))
            for name, weight, right in (("good", good, vote > 0), ("bad", 1 - good, vote < 0)):
                sums.append(F.sum(F.when(right, F.col("n") * weight).otherwise(0.0)).alias(f"right_{name}{at}"))
                sums.append(F.sum(F.when(vote != 0, F.col("n") * weight).otherwise(0.0)).alias(f"cast_{name}{at}"))
        row = patterns.agg(*sums).first()
        if not row["n"]:
            return START
        on_good, on_bad = [], []
        for at in range(len(RULES)):  # a few votes more of the usual kind, for rules that hardly ever vote
            on_good.append(_held((row[f"right_good{at}"] + 9) / (row[f"cast_good{at}"] + 10), LEAST_ON_GOOD, MOST_ON_GOOD))
            on_bad.append(_held((row[f"right_bad{at}"] + 0.5) / (row[f"cast_bad{at}"] + 1), 1 - on_good[-1], MOST_ON_BAD))
        model = Model(_held(row["good"] / row["n"], *PRIOR_RANGE), on_good, on_bad)
    return model


def vote_counts(scored: DataFrame) -> DataFrame:
    """rule, good, bad and abstained: how often each rule voted what; one that always votes the same says nothing."""
    names = F.array(*map(F.lit, RULES))
    votes = scored.select(F.explode(F.arrays_zip(names.alias("rule"), F.col("votes").alias("vote"))).alias("v")).select("v.rule", "v.vote")
    counts = [F.count_if(F.col("vote") == value).alias(name) for name, value in (("good", 1), ("bad", -1), ("abstained", 0))]
    return votes.groupBy("rule").agg(*counts)


def score_quality(docs: DataFrame) -> DataFrame:
    """The measures, votes and posterior of every document, base_failed, and the verdict ``kept``.

    Cut points and the model are learnt from the documents that pass the base: of the others it decides.
    """
    measured = stage(measure(docs).withColumn("base_failed", base_failed()), "quality-measures")
    bounds = cut_points(measured.where("NOT base_failed"))
    voted = measured.withColumn("votes", F.array(*[_vote(rule, bounds[name]) for name, rule in RULES.items()]))
    patterns = stage(voted.where("NOT base_failed").groupBy("votes").agg(F.count(F.lit(1)).alias("n")), "vote-patterns")
    judged = voted.withColumn("posterior", _posterior(F.col("votes"), estimate(patterns)))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= KEEP_FROM))
