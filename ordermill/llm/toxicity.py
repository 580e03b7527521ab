"""Toxicity by subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word's vector is the mean of the embeddings of its character n-grams and of the word itself, hashed to
BUCKETS rows; misspelt or unseen words share most n-grams with their kin.  The vectors of a passage of
PASSAGE words are averaged and go into a softmax over two classes; passages begin every STRIDE words and overlap, so
that a phrase of so many words lies whole in one of them wherever it stands.  A document is as toxic as its most toxic
passage, so that a few words count in a long text as in a short one.  Training alternates: score all
passages of the sample, take each document's highest, and step embeddings and softmax together (Adam).

Only labels of rows outside the held-out fold are used, and of those at most TRAIN_TOXIC toxic and
TRAIN_CLEAN clean rows, those first by a hash of their id, one row of each id (the first by a hash of its text).  The
sample is fitted in one task; the model has a fixed size
and is sent to all tasks.  Scoring needs one pass over the texts and no shuffle.

Cases: a null or empty text has no passage and scores what the bias says; rows without an id are held in
neither fold's labels but are scored; an id labelled twice counts as toxic if any label says so; a null
label is no label; equal texts score equally; without any labels every score is 0; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.shared import doc_texts, each

BUCKETS = 1 << 17
DIMENSIONS = 8
NGRAMS = (3, 4, 5)
PASSAGE = 6
STRIDE = 3
CHUNK = 50_000  # words or passages worked on at once while training
SHORTEST = 6  # a passage's mean is over this many words at least
TRAIN_TOXIC = 3_000
TRAIN_CLEAN = 8_000
STEPS = 70
WARM_UP = 5  # first steps, over whole documents instead of highest passages
RATE = 0.1
DECAY = 0.002
REJECT_FROM = 0.7

_WORDS = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


def subwords(word: str) -> list[int]:
    """The buckets of a word: its n-grams, with marks at its ends, and the word as a whole."""
    marked = f"<{word}>"
    crc32, below = zlib.crc32, BUCKETS - 1
    if word.isascii():
        data = marked.encode()
        found = [crc32(data[i : i + n]) & below for n in NGRAMS for i in range(len(data) - n + 1)]
    else:
        found = [crc32(marked[i : i + n].encode()) & below for n in NGRAMS for i in range(len(marked) - n + 1)]
    found.append(crc32(f"={marked}".encode()) & below)
    return found


def passages(n: int) -> np.ndarray:
    """Where the passages of a text of ``n`` words start: every STRIDE words, the last one reaching the end."""
    return np.arange(0, max(n - PASSAGE + STRIDE, 1), STRIDE)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


# -- training ------------------------------------------------------------------------------------


def _adam(value: np.ndarray, slope: np.ndarray, state: list, step: int) -> None:
    mean, square = state
    mean += 0.1 * (slope - mean)
    square += 0.01 * (slope * slope - square)
    value -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _groups(lengths: np.ndarray) -> list[tuple[int, int]]:
    """Documents that follow each other, as first and one after the last, of CHUNK words or a single longer document."""
    groups, lo, words = [], 0, 0
    for i, n in enumerate(lengths.tolist()):
        if words and words + n > CHUNK:
            groups.append((lo, i))
            lo, words = i, 0
        words += n
    return [*groups, (lo, len(lengths))]


def _passages(place, doc, doc_first, starts_of_docs, ends_of_docs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, one after the last, and divisor of passages, given by their places among all and their documents."""
    starts = (place - doc_first[doc]) * STRIDE + starts_of_docs[doc]
    ends = np.minimum(starts + PASSAGE, ends_of_docs[doc])
    return starts, ends, np.maximum(ends - starts, SHORTEST)


def train(rows: Iterator[tuple[str | None, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings, softmax weights and bias from texts and their 0/1 labels."""
    dice = np.random.default_rng(11)
    table = dice.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = dice.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.array([2.0, -2.0], np.float32)  # one passage is rarely toxic

    numbers: dict[str, int] = {}
    held, word_counts, given = array("i"), array("i"), []  # one array of all words' numbers, not one a document
    for text, label in rows:
        doc = array("i", (numbers.setdefault(w, len(numbers)) for w in words_of(text)))
        if doc:
            held.extend(doc)
            word_counts.append(len(doc))
            given.append(label)
    labels = np.array(given, np.int64)
    if not given or labels.min() == labels.max():
        share = labels.mean() if len(labels) else 0.0
        return table * 0, weights * 0, np.array([0, np.log((share + 1e-3) / (1 - share + 1e-3))], np.float32)

    packed, counts = array("i"), array("i")  # a list of numbers per word would take gigabytes
    for word in numbers:
        found = subwords(word)
        packed.extend(found)
        counts.append(len(found))
    del numbers
    buckets, sizes = np.frombuffer(packed, np.int32), np.frombuffer(counts, np.int32).astype(np.int64)
    first = np.cumsum(sizes) - sizes
    chunks = []  # of words, with the places of their buckets
    for lo in range(0, len(sizes), CHUNK):
        part = slice(lo, min(lo + CHUNK, len(sizes)))
        chunks.append((part, slice(int(first[lo]), int(first[part][-1] + sizes[part][-1]))))

    flat, lengths = np.frombuffer(held, np.int32), np.frombuffer(word_counts, np.int32).astype(np.int64)
    given_docs = len(lengths)
    ends_of_docs = np.cumsum(lengths)
    starts_of_docs = ends_of_docs - lengths
    per_doc = 1 + -(-np.maximum(lengths - PASSAGE, 0) // STRIDE)
    doc_first = np.cumsum(per_doc) - per_doc
    # Passages are worked out anew where they are needed: other tasks' memory stands beside this one's.
    groups = _groups(lengths)

    states = [[np.zeros_like(x), np.zeros_like(x)] for x in (table, weights, bias)]
    target = np.stack([1 - labels, labels], 1)
    weight_of = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())) ** 0.5
    for step in range(1, STEPS + 1):
        toward = weights[:, 1] - weights[:, 0]
        line = table @ toward
        score = np.concatenate([np.add.reduceat(line[buckets[at]], first[part] - at.start) for part, at in chunks]) / sizes
        before = 0.0  # the sum of the scores of all words before the group's
        chosen = np.zeros(given_docs, np.int64)  # each document's highest passage
        logit = np.zeros(given_docs)
        for lo, hi in groups:
            words = slice(starts_of_docs[lo], ends_of_docs[hi - 1])
            sums = np.empty(words.stop - words.start + 1)
            sums[0] = before
            sums[1:] = score[flat[words]]
            np.cumsum(sums, out=sums)
            before = sums[-1]
            place = _ranges(doc_first[lo:hi], per_doc[lo:hi])
            doc = np.repeat(np.arange(lo, hi), per_doc[lo:hi])
            starts, ends, spans = _passages(place, doc, doc_first, starts_of_docs, ends_of_docs)
            score_of = (sums[ends - words.start] - sums[starts - words.start]) / spans
            if step <= WARM_UP:
                logit[lo:hi] = np.bincount(doc - lo, (1 / per_doc)[doc] * score_of, hi - lo)
            else:
                highest = np.maximum.reduceat(score_of, doc_first[lo:hi] - place[0])
                at = np.flatnonzero(score_of == highest[doc - lo])
                chosen[lo:hi] = place[at[np.unique(doc[at], return_index=True)[1]]]
                logit[lo:hi] = highest
        logit = logit + bias[1] - bias[0]
        good = 1 / (1 + np.exp(-np.clip(logit, -50, 50)))
        error = (np.stack([1 - good, good], 1) - target) * weight_of[:, None] / given_docs
        pull = error[:, 1]
        by_word = np.zeros(len(sizes))
        used = int(per_doc.sum()) if step <= WARM_UP else given_docs
        for lo in range(0, used, CHUNK):
            if step <= WARM_UP:
                some = np.arange(lo, min(lo + CHUNK, used))
                doc = np.searchsorted(doc_first, some, side="right") - 1
                share = (1 / per_doc)[doc]
            else:
                some, doc, share = chosen[lo : lo + CHUNK], np.arange(lo, min(lo + CHUNK, used)), 1.0
            starts, ends, spans = _passages(some, doc, doc_first, starts_of_docs, ends_of_docs)
            weight = np.repeat(share / spans * pull[doc], ends - starts)
            by_word += np.bincount(flat[_ranges(starts, ends - starts)], weight, len(sizes))
        by_bucket = np.zeros(BUCKETS)
        for part, at in chunks:
            by_bucket += np.bincount(buckets[at], np.repeat(by_word[part] / sizes[part], sizes[part]), BUCKETS)
        down = (table.T @ by_bucket).astype(np.float32)
        slope = np.outer(by_bucket, toward).astype(np.float32)
        slope += DECAY / given_docs * table
        _adam(weights, np.stack([-down, down], 1), states[1], step)
        _adam(table, slope, states[0], step)
        _adam(bias, error.sum(0).astype(np.float32), states[2], step)
    return table, weights, bias


def _sample(labels: DataFrame) -> DataFrame:
    """The ids and labels to train on: TRAIN_TOXIC + TRAIN_CLEAN rows at most."""
    given = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    known = given.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id")))
    one = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("turn", F.xxhash64("doc_id"))
    toxic = one.where("toxic = 1").orderBy("turn", "doc_id").limit(TRAIN_TOXIC)
    clean = one.where("toxic = 0").orderBy("turn", "doc_id").limit(TRAIN_CLEAN)
    return toxic.unionByName(clean).select("doc_id", "toxic")


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """The fitted model as one number per bucket and the bias: all that scoring two classes needs."""
    sample = F.broadcast(_sample(labels))  # TRAIN_TOXIC + TRAIN_CLEAN rows of two numbers at most
    found = doc_texts(docs).join(sample, "doc_id").groupBy("doc_id", "toxic")
    rows = found.agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    rows = rows.select("text", "toxic", "doc_id").repartition(1).sortWithinPartitions("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()  # what earlier tasks of this worker left there
        labelled = (row for batch in batches for row in zip(each(batch.column("text")), batch.column("toxic").to_pylist()))
        table, weights, bias = train(labelled)
        line = (table @ (weights[:, 1] - weights[:, 0])).astype(np.float32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([line.tobytes()], pa.binary()), pa.array([float(bias[1] - bias[0])])], ["line", "bias"]
        )

    fitted = rows.mapInArrow(run, "line binary, bias double").collect()
    if not fitted:
        return np.zeros(BUCKETS, np.float32), -50.0
    return np.frombuffer(bytes(fitted[0]["line"]), np.float32), fitted[0]["bias"]


# -- scoring -------------------------------------------------------------------------------------


class WordScores(dict):
    """What each word adds to a passage, kept for the words seen last."""

    def __init__(self, line: np.ndarray):
        super().__init__()
        self.line = line.tolist()

    def __missing__(self, word: str) -> float:
        if len(self) > 200_000:
            self.clear()
        found = subwords(word)
        self[word] = value = sum(map(self.line.__getitem__, found)) / len(found)
        return value


def text_score(text: str | None, scores: WordScores, bias: float) -> float:
    """The probability of toxicity of the most toxic passage."""
    words = words_of(text)
    logit = bias
    if words:
        sums = np.zeros(len(words) + 1)
        np.cumsum(np.fromiter(map(scores.__getitem__, words), np.float64, len(words)), out=sums[1:])
        starts = passages(len(words))
        ends = np.minimum(starts + PASSAGE, len(words))
        logit += float(((sums[ends] - sums[starts]) / np.maximum(ends - starts, SHORTEST)).max())
    return float(1 / (1 + np.exp(-min(max(logit, -50.0), 50.0))))


def score_texts(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """doc_id and score of every document row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line, bias = sent.value
        scores = WordScores(line)
        for batch in batches:
            found = [text_score(text, scores, bias) for text in each(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    return doc_texts(docs).mapInArrow(run, "doc_id long, score double")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with all its columns, without the rows that score REJECT_FROM or more."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    where = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line, bias = sent.value
        scores = WordScores(line)
        for batch in batches:
            kept = [text_score(text, scores, bias) < REJECT_FROM for text in each(batch.column(where))]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document row."""
    scored = score_texts(docs, fit(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= REJECT_FROM).cast("int").alias("predicted"),
    )
