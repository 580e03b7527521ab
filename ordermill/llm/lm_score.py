"""Language-model scores: an add-one unigram base, and a hashed maximum-entropy model under n-gram counts of all training text.

Words are kept as positions in blocks (see blocks.py); the distinct words of each block meet by part, where
they are counted over the whole training set, and their counts go back to the blocks.

The model predicts a token in two factors.  Its class comes from a softmax over CLASSES classes: the end
mark and the FREQUENT most frequent words have classes of their own, other words share one by hash.  The
softmax sees hashed features of what goes before: the last word (n-gram), the last two (n-gram), and the
last but one alone (skip).  The word within its class has its share of the class's training count, one
added to each, which is the closed form of a softmax with a bias per word.

These weights are a table of one size.  What grows with the corpus are the n-gram counts: how often the training
documents hold each token after the last word, and after the last two.  A token's probability is mixed from the counts of
the three tokens, those of the two, and the softmax (PAIR_WEIGHT and TRIPLE_WEIGHT tokens' worth of what is below), so
it sums to one in every context.  Each block sends its distinct token triples with their counts, as hashes by part;
there those of all blocks are added up, and the totals go back to the block, as the words' counts do.

Training is by full gradients over all training documents: each block sums observed less expected class counts
per feature, the sums are added up in two levels, and each round steps the weights by the gradient over
the expected counts.  Only BUCKETS x CLASSES numbers come to the driver.  At zero weights the expectation is the
class prior, so the first round needs no softmax.  What a softmax sees are the distinct contexts and how often each
occurs: those of all blocks meet by part of their last word, are added up and written once, and the ROUNDS read only them.
Scoring runs in sparse numpy batches per block.

Cases: a null or empty text is one end mark; rows without an id count as training rows; rows that share an id
stay separate; without training rows all counts are 0; an empty table gives an empty result; other columns
are ignored; texts are scored whole.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.blocks import WORDS, pack, store_by_block, unpack, unpack_words, write_blocks
from ordermill.llm.shared import pack_columns, unpack_columns

FOLDS = 7
HELD_OUT = 2
END = b"\n"  # no word has a line feed
FREQUENT = 15
HASHED = 16  # classes of the other words
CLASSES = 1 + FREQUENT + HASHED
BUCKETS = 1 << 14
FEATURES = 3
ROUNDS = 8
STEP = 0.6
SMOOTHING = 20.0  # expected counts this small move a weight half as far
BATCH = 1 << 16
CHUNK = 1 << 10  # buckets per row while gradients are summed
PART_TOKENS = 2 * WORDS  # tokens whose contexts are added up at once, and give one row of sums a round
PAIR_WEIGHT, TRIPLE_WEIGHT = 500.0, 3.0  # near the best of a few tried on sf0.1's held-out text, over the base
START = 1 << 32  # stands before a text; words go by 32 bits
BEFORE_BITS = 22  # of the word before the last two tokens, which have 40

COUNTED = (
    "block long, payload binary, distinct long, tokens long, class_words array<long>, class_tokens array<long>, "
    "top array<struct<n:long,hash:int>>"
)


def fold(doc_id: int | None) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS


def in_training(doc_id: int | None) -> bool:
    return fold(doc_id) != HELD_OUT


def tokens_of(text: str) -> list[bytes]:
    return [*text.encode().lower().split(), END]


# -- counts --------------------------------------------------------------------------------------


def _crc(word: bytes) -> int:
    """32 bits of a word; the end mark has the first value to itself."""
    return 0 if word == END else zlib.crc32(word) or 65535


def _cut(crc):
    """16 bits of the 32; the first value stays the end mark's."""
    return (crc > 0) * (1 + crc % 65535)


def _hash(word: bytes) -> int:
    """16 bits of a word; the end mark has the first value to itself."""
    return _cut(_crc(word))


def _count_part(table: pa.Table) -> pa.Table:
    """Counts of one part's words for every block that has them; on its first row, the part's totals."""
    rows = [unpack_words(data) for data in table.column("words").to_pylist()]
    total: dict[bytes, int] = {}
    for _, words, n in rows:
        for word, k in zip(words, n.tolist()):
            total[word] = total.get(word, 0) + k
    crc_of = {word: _crc(word) for word in total}
    sent = []
    for numbers, words, _ in rows:
        counts = np.fromiter(map(total.__getitem__, words), np.int64, len(words))
        crcs = np.fromiter(map(crc_of.__getitem__, words), np.int64, len(words))
        low, high = counts & 0x3FFFFFFF, counts >> 30
        sent.append(pack(np.concatenate([np.diff(numbers, prepend=0), low, high, crcs]).astype(np.uint32).view(np.int32)))
    known = [(n, _cut(crc_of[word])) for word, n in total.items() if n and word != END]
    words_by, tokens_by = np.zeros(HASHED, np.int64), np.zeros(HASHED, np.int64)
    if known:
        n, hashes = np.array(known, np.int64).T
        words_by, tokens_by = np.bincount(hashes % HASHED, minlength=HASHED), np.bincount(hashes % HASHED, n, HASHED).astype(np.int64)
    top = heapq.nlargest(FREQUENT, known)
    ends = total.get(END, 0)
    first = lambda value: [value] + [None] * (len(rows) - 1)
    return pa.table(
        {
            "block": table.column("block"),
            "payload": pa.array(sent, pa.binary()),
            "distinct": pa.array(first(len(known) + (ends > 0)), pa.int64()),
            "tokens": pa.array(first(sum(n for n, _ in known) + ends), pa.int64()),
            "class_words": pa.array(first(words_by.tolist()), pa.list_(pa.int64())),
            "class_tokens": pa.array(first(tokens_by.tolist()), pa.list_(pa.int64())),
            "top": pa.array(first([{"n": n, "hash": h} for n, h in top]), pa.list_(pa.struct([("n", pa.int64()), ("hash", pa.int32())]))),
        }
    )


class Totals:
    """What the whole training set says: tokens, distinct tokens, the classes and their sizes."""

    def __init__(self, counted: DataFrame, ends: int):
        parts = counted.where(F.col("tokens").isNotNull())
        row = parts.agg(F.sum("tokens"), F.sum("distinct")).first()
        self.tokens, self.distinct, self.ends = row[0] or 0, row[1] or 0, ends
        top = parts.select(F.explode("top").alias("t")).select("t.n", "t.hash").orderBy(F.desc("n"), "hash").limit(FREQUENT)
        self.top = [tuple(r) for r in top.collect()]
        words, tokens = np.zeros(CLASSES), np.zeros(CLASSES)
        words[0], tokens[0] = 1, ends
        by_class = parts.select(F.posexplode(F.arrays_zip("class_words", "class_tokens")).alias("c", "s"))
        for r in by_class.groupBy("c").agg(F.sum("s.class_words"), F.sum("s.class_tokens")).collect():
            words[1 + FREQUENT + r[0]], tokens[1 + FREQUENT + r[0]] = r[1], r[2]
        for at, (n, hashed) in enumerate(self.top):
            words[1 + at], tokens[1 + at] = 1, n
            words[1 + FREQUENT + hashed % HASHED] -= 1
            tokens[1 + FREQUENT + hashed % HASHED] -= n
        shared = np.arange(CLASSES) > FREQUENT  # these also hold the words never seen
        self.mass = np.maximum(tokens + words + shared, 1)
        self.prior = (tokens + 1) / (tokens + 1).sum()

    def classes(self, counts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        found = np.where(hashes == 0, 0, 1 + FREQUENT + hashes % HASHED)
        for at, (n, hashed) in enumerate(self.top):
            found[(counts == n) & (hashes == hashed)] = 1 + at
        return found


# -- one block -----------------------------------------------------------------------------------


class _Tokens:
    """The tokens of a block's documents one after the other: counts, classes, 32 bits and features of each."""

    def __init__(self, documents: pa.Table, counted: list[bytes], totals: Totals, only_training: bool):
        parts = [unpack(payload).astype(np.int64).reshape(4, -1) for payload in counted]
        steps, low, high, sent = np.concatenate(parts, 1) if parts else np.zeros((4, 0), np.int64)
        numbers = np.concatenate([np.cumsum(part[0]) for part in parts]) if parts else np.zeros(0, np.int64)
        counts, crcs = np.zeros(len(steps), np.int64), np.zeros(len(steps), np.int64)
        counts[numbers], crcs[numbers] = low + (high << 30), sent & 0xFFFFFFFF
        hashes = _cut(crcs)
        classes = totals.classes(counts, hashes)
        rows = zip(documents.column("doc_id").to_pylist(), documents.column("payload").to_pylist())
        docs = [(doc_id, unpack(payload)) for doc_id, payload in rows if not only_training or in_training(doc_id)]
        self.ids = [doc_id for doc_id, _ in docs]
        self.sizes = np.array([len(at) for _, at in docs], np.int64)
        at = np.concatenate([at for _, at in docs]) if docs else np.zeros(0, np.int32)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.counts, self.classes, self.hashes, self.crcs = counts[at], classes[at], hashes[at].astype(np.uint64), crcs[at]

    def earlier(self, values: np.ndarray, first: int) -> np.ndarray:
        """Of each token the value of the one before it; ``first`` stands before a text."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.starts] = first
        return out

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of the last word and the one before it, for each token; 70000 stands before a text."""
        last = self.earlier(self.hashes, 70000)
        return last, self.earlier(last, 70000)

    def batches(self, size: int | None = None) -> Iterator[tuple[slice, np.ndarray]]:
        """Token ranges and their features, FEATURES rows of bucket numbers."""
        return _features(*self.contexts(), size or BATCH)

    def triples(self) -> np.ndarray:
        """62 bits for each token and the two before it: the first 40 are the same wherever it and the last one are."""
        last = self.earlier(self.crcs, START)
        pairs = _spread(_spread(self.crcs.astype(np.uint64)) ^ last.astype(np.uint64))
        before = _spread(self.earlier(last, START).astype(np.uint64))
        return ((pairs >> np.uint64(24) << np.uint64(BEFORE_BITS)) | (before >> np.uint64(64 - BEFORE_BITS))).astype(np.int64)


def _spread(x: np.ndarray) -> np.ndarray:
    """64-bit numbers mixed, so that any of their bits tell them apart."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def _features(last: np.ndarray, before: np.ndarray, size: int = BATCH) -> Iterator[tuple[slice, np.ndarray]]:
    for lo in range(0, len(last), size):
        part = slice(lo, lo + size)
        a, b = last[part] + np.uint64(1), before[part] + np.uint64(1)
        mixed = [a * np.uint64(0x9E3779B97F4A7C15), b * np.uint64(0xC2B2AE3D27D4EB4F), (a << np.uint64(20)) * np.uint64(0x9E3779B97F4A7C15) ^ b * np.uint64(0x165667B19E3779F9)]
        yield part, np.stack([(x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(50) for x in mixed]).astype(np.int64)


def _distinct_contexts(last: np.ndarray, before: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each context once, in order, and how often it occurs where those given occur ``n`` times."""
    both = last.astype(np.int64) << 20 | before.astype(np.int64)
    order = np.argsort(both)
    both = both[order]
    first = np.flatnonzero(np.diff(both, prepend=-1))
    n = np.add.reduceat(n[order], first) if len(first) else n[:0]
    return both[first] >> 20, both[first] & 0xFFFFF, n


def _counted_contexts(last: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each context of some tokens once, in order, and how often it occurs."""
    both = np.sort(last.astype(np.int64) << 20 | before.astype(np.int64))
    first = np.flatnonzero(np.diff(both, prepend=-1))
    return both[first] >> 20, both[first] & 0xFFFFF, np.diff(np.append(first, len(both)))


def _pack_distinct(last: np.ndarray, before: np.ndarray, n: np.ndarray) -> bytes:
    return pack(np.concatenate([np.diff(last, prepend=0), before, n & 0x3FFFFFFF, n >> 30]))


def _pack_contexts(last: np.ndarray, before: np.ndarray) -> bytes:
    """The distinct contexts of some tokens and how often each occurs."""
    return _pack_distinct(*_counted_contexts(last, before))


def _unpack_contexts(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps, before, low, high = unpack(payload).astype(np.int64).reshape(4, -1)
    return np.cumsum(steps).astype(np.uint64), before.astype(np.uint64), low + (high << 30)


def _logits(weights: np.ndarray, bias: np.ndarray, features: np.ndarray) -> np.ndarray:
    total = weights[features[0]]
    for row in features[1:]:
        total += weights[row]
    total += bias
    return total


class _Softmax:
    """The model's odds of the classes, a row of buckets for each: a product over the features, not an exponential each."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray):
        # Doubles, as products of the three outgrow single precision after more rounds.
        self.odds = np.ascontiguousarray(np.exp(weights.astype(np.float64)).T)
        self.prior = np.exp(bias.astype(np.float64))

    def __call__(self, features: np.ndarray) -> np.ndarray:
        """Odds of each class, a row for each, in a column for each context."""
        out = np.empty((CLASSES, features.shape[1]))
        factor = np.empty(features.shape[1])
        for row, odds, prior in zip(out, self.odds, self.prior):
            np.take(odds, features[0], out=row, mode="clip")  # this mode writes to ``out`` directly
            for feature in features[1:]:
                row *= np.take(odds, feature, out=factor, mode="clip")
            row *= prior
        return out


def _expected(last: np.ndarray, before: np.ndarray, n: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Expected class counts per bucket under the weights, of contexts that occur ``n`` times."""
    softmax, out = _Softmax(weights, bias), np.zeros((CLASSES, BUCKETS))
    for part, features in _features(last, before):
        p = softmax(features)
        p *= n[part] / p.sum(0)
        # Contexts come in the order of their last word: the first feature is the same over long runs.
        first = np.flatnonzero(np.diff(features[0], prepend=-1))
        for sums, row in zip(out, p):
            sums += np.bincount(features[0][first], np.add.reduceat(row, first), BUCKETS)
            for feature in features[1:]:
                sums += np.bincount(feature, row, BUCKETS)
    return out.T


def _observed(tokens: _Tokens) -> np.ndarray:
    out = np.zeros(BUCKETS * CLASSES, np.int64)
    for part, features in tokens.batches(BUCKETS * CLASSES):  # each adds up a table of this size
        for row in features:
            out += np.bincount(row * CLASSES + tokens.classes[part], minlength=len(out))
    return out.reshape(BUCKETS, CLASSES).astype(np.float64)


# -- training ------------------------------------------------------------------------------------

SUMS = "chunk int, salt int, sums binary"


def _sums(block: int, counts: np.ndarray) -> pa.Table:
    data = [_squeeze(part) for part in counts.reshape(-1, CHUNK * CLASSES)]
    n = len(data)
    salts = pa.array(np.full(n, block * 2654435761 >> 8 & 31, np.int32))
    return pa.table({"chunk": pa.array(np.arange(n, dtype=np.int32)), "salt": salts, "sums": pa.array(data, pa.binary())})


def _squeeze(sums: np.ndarray) -> bytes:
    """Sums of a chunk as compressed single-precision numbers."""
    return pack(np.ascontiguousarray(sums, np.float32).view(np.int32).ravel())


def _add_up(table: pa.Table) -> pa.Table:
    total = np.zeros(CHUNK * CLASSES, np.float64)
    for data in table.column("sums").to_pylist():
        total += unpack(data).view(np.float32)
    return pa.table({"chunk": table.column("chunk")[:1], "salt": table.column("salt")[:1], "sums": pa.array([_squeeze(total)], pa.binary())})


def _total(parts: DataFrame) -> np.ndarray:
    """The sums of all blocks: first of each chunk's blocks by salt, then of the salts."""
    some = parts.groupBy("chunk", "salt").applyInArrow(_add_up, SUMS)
    out = np.zeros((BUCKETS // CHUNK, CHUNK * CLASSES), np.float64)
    for row in some.groupBy("chunk").applyInArrow(_add_up, SUMS).collect():
        out[row["chunk"]] = unpack(bytes(row["sums"])).view(np.float32)
    return out.reshape(BUCKETS, CLASSES)


SUMMED = f"part int, {SUMS}, contexts binary"


def _summed(part: int | np.ndarray, sums: pa.Table, contexts: list[bytes]) -> pa.Table:
    """Rows of sums and, after them, rows of contexts, each of its part or all of one."""
    n, m = sums.num_rows, len(contexts)
    parts = pa.array(np.broadcast_to(part, n + m).astype(np.int32))
    columns = [pa.concat_arrays([*sums.column(name).chunks, pa.nulls(m, sums.column(name).type)]) for name in ("chunk", "salt", "sums")]
    return pa.Table.from_arrays([parts, *columns, pa.array([None] * n + contexts, pa.binary())], ["part", "chunk", "salt", "sums", "contexts"])


def _observed_sums(totals: Totals, parts: int):
    """A cogroup function: observed counts and, on rows of their own, the contexts by part; training documents only."""

    def run(documents: pa.Table, counted: pa.Table) -> pa.Table:
        tokens = _Tokens(documents, counted.column("payload").to_pylist(), totals, only_training=True)
        block = (documents if documents.num_rows else counted).column("block")[0].as_py()
        sums = _sums(block, _observed(tokens))
        last, before, n = _counted_contexts(*tokens.contexts())
        part = (last % parts).astype(np.uint16 if parts < 1 << 16 else np.int64)
        order = np.argsort(part, kind="stable")
        first = np.flatnonzero(np.diff(part[order], prepend=-1))
        packed = [_pack_distinct(last[some], before[some], n[some]) for some in np.split(order, first[1:])] if len(first) else []
        return _summed(np.concatenate([np.full(sums.num_rows, block % parts), part[order[first]].astype(np.int64)]), sums, packed)

    return run


def _merge_contexts(table: pa.Table) -> pa.Table:
    """The contexts of one part of all blocks, each once; sums stay as they are."""
    sums = table.filter(table.column("sums").is_valid())
    found = [_unpack_contexts(payload) for payload in table.column("contexts").drop_null().to_pylist()]
    packed = [_pack_distinct(*_distinct_contexts(*map(np.concatenate, zip(*found))))] if found else []
    return _summed(table.column("part")[0].as_py(), sums, packed)


def _expected_sums(model):
    """A function of a part's contexts: the counts that the model expects."""

    def run(rows: pa.Table) -> pa.Table:
        found = [_unpack_contexts(payload) for payload in rows.column("contexts").to_pylist()]
        return _sums(rows.column("part")[0].as_py(), sum(_expected(*contexts, *model.value) for contexts in found))

    return run


def train(together, totals: Totals, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Weights per bucket and class, and the classes' biases.  ``together(fn, schema)`` runs ``fn`` on each block."""
    context = together.spark.sparkContext
    bias = np.log(totals.prior).astype(np.float32)
    weights = np.zeros((BUCKETS, CLASSES), np.float64)
    parts = totals.tokens // PART_TOKENS + 1
    by_part = together(_observed_sums(totals, parts), SUMMED).groupBy("part").applyInArrow(_merge_contexts, SUMMED)
    summed = store_by_block(by_part, "contexts", "part")
    observed = _total(summed.where("sums IS NOT NULL").select("chunk", "salt", "sums"))
    contexts = summed.where("contexts IS NOT NULL").select("part", "contexts").groupBy("part")
    expected = observed.sum(1, keepdims=True) * totals.prior
    for number in range(rounds):
        if number:
            model = context.broadcast((weights.astype(np.float32), bias))
            expected = _total(contexts.applyInArrow(_expected_sums(model), SUMS))
        weights += np.clip(STEP * (observed - expected) / (expected + SMOOTHING), -1.5, 1.5)
    return weights.astype(np.float32), bias


class _Together:
    """Runs a function on the documents and what is known of the words of each block; neither side moves."""

    def __init__(self, documents: DataFrame, known: DataFrame):
        self.documents, self.known, self.spark = documents.groupBy("block"), known.groupBy("block"), documents.sparkSession

    def __call__(self, function, schema: str) -> DataFrame:
        return self.documents.cogroup(self.known).applyInArrow(function, schema)


# -- n-gram counts -------------------------------------------------------------------------------

TRIPLES = "block long, part int, payload binary"


def _triple_table(blocks: pa.Array, parts: pa.Array, payloads: list[bytes]) -> pa.Table:
    return pa.table({"block": blocks, "part": parts, "payload": pa.array(payloads, pa.binary())})


def _send_triples(totals: Totals, parts: int):
    """A cogroup function: the block's distinct triples by part, and how often training documents hold each."""

    def run(documents: pa.Table, counted: pa.Table) -> pa.Table:
        tokens = _Tokens(documents, counted.column("payload").to_pylist(), totals, only_training=False)
        marked = tokens.triples() << 1 | np.repeat(np.array(list(map(in_training, tokens.ids)), np.int64), tokens.sizes)
        marked.sort()
        first = np.flatnonzero(np.diff(marked >> 1, prepend=-1))
        n = np.add.reduceat(marked & 1, first) if len(first) else first
        triples = marked[first] >> 1
        part = (triples >> 31) * parts >> 31  # in the order of the triples
        begins = np.flatnonzero(np.diff(part, prepend=-1))
        packed = [
            pack_columns(np.diff(some >> BEFORE_BITS, prepend=0), some & (1 << BEFORE_BITS) - 1, times)
            for some, times in zip(np.split(triples, begins[1:]), np.split(n, begins[1:]))
        ]
        block = (documents if documents.num_rows else counted).column("block")[0].as_py()
        return _triple_table(pa.array(np.full(len(begins), block, np.int64)), pa.array(part[begins].astype(np.int32)), packed[: len(begins)])

    return run


def _count_triples(table: pa.Table) -> pa.Table:
    """For the triples of one part of each block: how often all training documents hold the last two tokens, and all three."""
    found = [unpack_columns(payload, 3)[0] for payload in table.column("payload").to_pylist()]
    triples = [np.cumsum(steps) << BEFORE_BITS | before for steps, before, _ in found]
    every = np.sort(np.concatenate(triples))
    every = every[np.flatnonzero(np.diff(every, prepend=-1))]
    places, total = [np.searchsorted(every, some) for some in triples], np.zeros(len(every), np.int64)
    for at, (_, _, n) in zip(places, found):
        total[at] += n  # a block has a triple once
    first = np.flatnonzero(np.diff(every >> BEFORE_BITS, prepend=-1))
    pairs = np.repeat(np.add.reduceat(total, first), np.diff(np.append(first, len(every))))
    return _triple_table(table.column("block"), table.column("part"), [pack_columns(pairs[at], total[at]) for at in places])


def _with_triples(together: _Together, counted: DataFrame, totals: Totals) -> DataFrame:
    """One row per block: ``payload`` of its counted words, and ``triples``, the answers of all parts, as lists."""
    sent = together(_send_triples(totals, totals.tokens // WORDS + 1), TRIPLES)
    answers = store_by_block(sent.groupBy("part").applyInArrow(_count_triples, TRIPLES), "triples")
    listed = answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("part", "payload"))).alias("triples"))
    words = counted.groupBy("block").agg(F.collect_list("payload").alias("payload"))
    return words.join(listed, "block").select("block", "payload", F.col("triples.payload").alias("triples"))


def _mixed(tokens: _Tokens, answers: list[bytes], own: np.ndarray, totals: Totals) -> np.ndarray:
    """The tokens' log probabilities under the n-gram counts, where the softmax says ``own``."""
    pairs, triples = np.concatenate([unpack_columns(payload, 2)[0] for payload in answers], 1)
    at = np.unique(tokens.triples(), return_inverse=True)[1]
    pairs, triples = pairs[at], triples[at]
    # What goes before a token is counted as often as the tokens that it ends with: all but the end mark go on.
    after_one, after_two = tokens.earlier(tokens.counts, totals.ends), tokens.earlier(pairs, totals.ends)
    p = (pairs + PAIR_WEIGHT * np.exp(own)) / (after_one + PAIR_WEIGHT)
    return np.log((triples + TRIPLE_WEIGHT * p) / (after_two + TRIPLE_WEIGHT))


# -- scoring -------------------------------------------------------------------------------------

SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(totals: Totals, model):
    def run(documents: pa.Table, known: pa.Table) -> pa.Table:
        tokens = _Tokens(documents, known.column("payload")[0].as_py(), totals, only_training=False)
        softmax = _Softmax(*model.value)
        base = np.log10((tokens.counts + 1) / (totals.tokens + totals.distinct + 1))
        own = np.log((tokens.counts + 1) / totals.mass[tokens.classes])
        for part, features in tokens.batches():
            odds = softmax(features)
            own[part] += np.log(odds[tokens.classes[part], np.arange(odds.shape[1])] / odds.sum(0))
        own = _mixed(tokens, known.column("triples")[0].as_py(), own, totals)
        n = len(tokens.ids)
        by_doc = lambda x: np.add.reduceat(x, tokens.starts) if n else x[:0]
        return pa.table(
            {
                "doc_id": pa.array(tokens.ids, pa.int64()),
                "held_out": pa.array([not in_training(doc_id) for doc_id in tokens.ids], pa.bool_()),
                "n_tokens": pa.array(tokens.sizes, pa.int64()),
                "n_known": pa.array(by_doc((tokens.counts > 0).astype(np.int64)), pa.int64()),
                "train_tokens": pa.array(np.full(n, totals.tokens), pa.int64()),
                "base_score": pa.array(by_doc(base), pa.float64()),
                "score": pa.array(by_doc(own) / math.log(10), pa.float64()),
            }
        )

    return run


def score_documents(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Token counts, base score and model score (log10 probability) of every document row."""
    documents, words = write_blocks(docs, lambda: tokens_of, in_training)
    counted = store_by_block(words.groupBy("part").applyInArrow(_count_part, COUNTED), "counts")
    together = _Together(documents, counted.select("block", "payload"))
    ends = documents.where(F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS != HELD_OUT, F.lit(True))).count()
    totals = Totals(counted, ends)
    known = _with_triples(together, counted.select("block", "payload"), totals)
    model = docs.sparkSession.sparkContext.broadcast(train(together, totals, rounds))
    return _Together(documents, known)(_score(totals, model), SCORES)
