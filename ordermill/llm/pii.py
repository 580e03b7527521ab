"""Personal data by patterns and a skip-chain conditional random field.

The patterns find email and IP addresses, card and phone numbers.  The field then decides about what they
miss: its nodes are the pattern matches, whose labels are fixed, and the other tokens with a digit or an
at sign.  A node has a unary potential from its shape; neighbouring nodes share a chain potential;
nodes of one document that are equal but for case and separators, or alike in form and beginning, share a
skip potential however far apart they are.  Loopy message passing spreads labels along both, so that a
second, odd spelling of a number found elsewhere in the document is found too.

All potentials are estimated together by pseudo-likelihood: each node's label given its shape and the labels it has
edges to.  The corpus is counted by such situations (at most 2,880 shapes times labels of six neighbours; a few thousand
in practice), and the weights are fitted to the table.  Labels are the pattern matches.  As a pattern's own matches say
nothing of what it misses, every match is also held out as if it had been missed: it is planted in odd and partial
spellings, repeating itself from afar, which keep its label, and alone with other digits, which is no
personal data (but where the spelling has an at sign or the usual shape).  Planted
nodes count at the rate at which the corpus itself repeats its matches in spellings the patterns miss; such nodes, of
unknown label, are left out.  So an odd shape alone says little, and what it repeats decides.

Each node has at most six edges, so a document of any length costs time in proportion to its nodes.

A token gets a label when its probability is at least ADD_FROM, in documents without any pattern match too;
matches of the patterns always stay.

Cases: a null or empty text has no spans; equal texts get equal spans; rows that share an id stay separate; an
empty table gives an empty result; other columns are ignored; texts of any length are read whole, in
linear time.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.shared import doc_texts, each

# Fixed values of the contract: kinds in the order of listing, and the patterns.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

OTHER = len(KINDS)  # the label of a node that is no personal data
LABELS = OTHER + 1
ADD_FROM = 0.9
NEAR = 60  # characters between neighbours that share a chain potential
ROUNDS = 12
MOST_WEIGHT = 12.0
SKIPS = ("equal", "alike")

_PRIVATE = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_EDGES = ".,;:!?()[]{}<>\"'|#*$%&"


# -- patterns ------------------------------------------------------------------------------------


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, at sign and domain: each at sign belongs to the run of local characters before it."""
    end = 0
    at = text.find("@")
    while at >= 0:
        before = text[end:at]
        start = end + len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        else:
            end = max(end, at + 1)
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern matches, in the order of listing."""
    found = []
    if "@" in text:
        found += [(start, 0, end) for start, end in _emails(text)]
    for match in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match[0].split(".")):
            found.append((match.start(), 1, match.end()))
    for match in _CARD.finditer(text):
        digits = _digits(match[0])
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append((match.start(), 2, match.end()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= len(_digits(match[0])) <= 15:
                found.append((match.start(), 3, match.end()))
    return sorted(found)


# -- the graph of one document -------------------------------------------------------------------


def _shape(text: str) -> tuple[int, ...]:
    """What the unary potential sees: each entry below the number in SHAPE_SIZES."""
    digits = _digits(text)
    n = len(digits)
    size = sum(n >= least for least in (1, 3, 7, 9, 12, 16, 17, 20))
    letters = any(c.isalpha() for c in text)
    return size, min(text.count("@"), 1), min(text.count("."), 4), min(text.count("-"), 3), int(text[:1] == "+"), int(letters), int(12 <= n <= 19 and _luhn(digits))


SHAPE_SIZES = (9, 2, 5, 4, 2, 2, 2)


def nodes_of(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, label) of the nodes in order: pattern matches, and other tokens that may be private."""
    taken, nodes = [], []
    for start, kind, end in base:
        if not taken or start >= taken[-1][1]:
            nodes.append((start, end, kind))
        taken.append((start, max(end, taken[-1][1] if taken else 0)))
    at = 0
    for match in _TOKEN.finditer(text):
        token = match[0]
        if not _PRIVATE.search(token):
            continue
        start, end = match.span()
        start += len(token) - len(token.lstrip(_EDGES))
        end -= len(token) - len(token.rstrip(_EDGES))
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if start < end and not (at < len(taken) and taken[at][0] < end):
            nodes.append((start, end, OTHER))
    return sorted(nodes)


def _keys(text: str) -> tuple[str, str]:
    """What equal and what alike nodes have in common."""
    plain = "".join(c for c in text.lower() if c.isalnum() or c == "@")
    return plain, f"{plain[:6]}/{len(plain) // 4}/{'@' in plain}" if len(plain) >= 8 else f"={plain}"


def edges_of(text: str, nodes: list[tuple[int, int, int]]) -> dict[str, list[tuple[int, int]]]:
    """Chain edges and skip edges; a node's skip edges go to the last equal and the last alike node."""
    edges = {"chain": [(i, i + 1) for i in range(len(nodes) - 1) if nodes[i + 1][0] - nodes[i][1] <= NEAR]}
    edges |= {kind: [] for kind in SKIPS}
    last: dict[str, int] = {}
    for i, (start, end, _) in enumerate(nodes):
        for kind, key in zip(SKIPS, _keys(text[start:end])):
            before = last.get(key, i)
            if before < i and (kind == "equal" or (before, i) not in edges["equal"][-1:]):
                edges[kind].append((before, i))
            last[key] = i
    return edges


# -- fitting -------------------------------------------------------------------------------------

NOBODY = LABELS  # in place of a neighbour's label where there is none
LEAST_RATE = 0.01  # of planted nodes
STEPS, STEP, SHRINK = 1_500, 0.05, 1e-6
REAL, PLANTED, RATE = 0, 1, 2  # what a count is of


def respelt(text: str, kind: int) -> list[str]:
    """Odd and partial spellings of a match."""
    plain = text.replace(" ", "").replace("(", "").replace(")", "")
    if kind == 0:
        name, host = text.split("@", 1)
        return [f"{name}@{host.replace('.', '[.]')}", f"{name}[@]{host}", f"{name}@{host.rsplit('.', 1)[0].replace('.', '-')}"]
    if kind == 1:
        return [text.replace(".", mark) for mark in ("-", "[.]", ",", "_")]
    digits = _digits(text)
    groups = [digits[i : i + 4] for i in range(0, len(digits), 4)]
    head = "+" if kind == 3 and text[:1] == "+" else ""
    return [".".join(groups), "/".join(groups), "_".join(groups), f"{plain[: len(plain) - 3]}xxx", f"{head}{digits[:4]}/{digits[4:]}"]


def _other_digits(text: str) -> str:
    """The text with other digits and letters in the same places."""
    return "".join(chr(48 + (ord(c) - 41) % 10) if "0" <= c <= "9" else "x" if c.isalpha() else c for c in text)


def tells_little(odd: str, match: str, kind: int) -> bool:
    """Whether an odd spelling alone could be anything: not where it has an at sign or the shape of the match itself."""
    return kind != 0 and _shape(odd)[:-1] != _shape(match)[:-1]


def _situations(text: str) -> Iterator[tuple[int, ...]]:
    """The situations of a document's nodes: what is counted, the label, the shape and the neighbours' labels (before,
    after, two equal and two alike ones)."""
    nodes = nodes_of(text, base_spans(text))
    edges = edges_of(text, nodes)
    labels = [label for _, _, label in nodes]
    before, after = [NOBODY] * len(nodes), [NOBODY] * len(nodes)
    for a, b in edges["chain"]:
        after[a], before[b] = labels[b], labels[a]
    skips = {kind: [[] for _ in nodes] for kind in SKIPS}
    for kind in SKIPS:
        for a, b in edges[kind]:
            skips[kind][a].append(labels[b])
            skips[kind][b].append(labels[a])
    two = lambda found: tuple(sorted([*found, NOBODY, NOBODY][:2]))
    for i, (start, end, label) in enumerate(nodes):
        equal, alike = two(skips["equal"][i]), two(skips["alike"][i])
        repeats_match = any(other != OTHER for other in skips["equal"][i])
        if repeats_match:
            yield RATE, int(label == OTHER)  # a match repeated as such, or in a spelling that the patterns miss
        if label != OTHER or not repeats_match:
            yield REAL, label, *_shape(text[start:end]), before[i], after[i], *equal, *alike
        if label != OTHER:
            match = text[start:end]
            for odd in respelt(match, label):
                if any(e - s > len(odd) // 2 for s, _, e in base_spans(odd)):
                    continue
                same, like = (a == b for a, b in zip(_keys(odd), _keys(match)))
                if same or like:
                    beside = two([label] if same else []), two([label] if like and not same else [])
                    yield PLANTED, label, *_shape(odd), *two([]), *beside[0], *beside[1]
                    if tells_little(odd, match, label):
                        yield PLANTED, OTHER, *_shape(_other_digits(odd)), *two([]), *two([]), *two([])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of situations, as keys of numbers."""
    counts: Counter = Counter()
    for batch in batches:
        for text in each(batch.column(1)):
            if text and _PRIVATE.search(text):
                counts.update(_situations(text))
    keys = pa.array([list(key) for key in counts], pa.list_(pa.int32()))
    yield pa.RecordBatch.from_arrays([keys, pa.array(list(counts.values()), pa.int64())], ["key", "n"])


def _one_hot(shape: tuple[int, ...]) -> np.ndarray:
    row = np.zeros(sum(SHAPE_SIZES) + 1)
    row[np.cumsum((0, *SHAPE_SIZES[:-1])) + np.array(shape)] = 1
    row[-1] = 1
    return row


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _weighted(counts: dict[tuple[int, ...], int]) -> dict[tuple[int, ...], np.ndarray]:
    """The weight of each label in each situation (shape and neighbours): planted nodes at the corpus's own rate, and
    frequent situations by the logarithm of their count, so that they do not drown rare ones."""
    odd, usual = counts.get((RATE, 1), 0), counts.get((RATE, 0), 0)
    rate = max(LEAST_RATE, odd / max(odd + usual, 1))
    seen: dict[tuple[int, ...], np.ndarray] = {}
    for key, n in counts.items():
        if key[0] != RATE:
            seen.setdefault(key[2:], np.zeros(LABELS))[key[1]] += n * (rate if key[0] == PLANTED else 1)
    return {key: row * (np.log1p(row.sum()) / row.sum()) for key, row in seen.items()}


def fit_potentials(counts: dict[tuple[int, ...], int]) -> dict[str, np.ndarray]:
    """Unary, chain and skip weights that make the pseudo-likelihood of the counted situations largest."""
    weights = {"unary": np.zeros((sum(SHAPE_SIZES) + 1, LABELS))} | {kind: np.zeros((LABELS, LABELS)) for kind in ("chain", *SKIPS)}
    seen = _weighted(counts)
    if not seen:
        return weights
    keys, target = np.array(list(seen), np.int64), np.array(list(seen.values()))
    n = len(SHAPE_SIZES)
    x = np.stack([_one_hot(key) for key in keys[:, :n]])
    hot = np.eye(LABELS + 1)[:, :LABELS]  # no neighbour: all zeros
    before, after = hot[keys[:, n]], hot[keys[:, n + 1]]
    equal, alike = (hot[keys[:, n + k]] + hot[keys[:, n + k + 1]] for k in (2, 4))
    mass = target.sum(1, keepdims=True)
    moments = {name: (np.zeros_like(w), np.zeros_like(w)) for name, w in weights.items()}
    for step in range(1, STEPS + 1):
        logits = x @ weights["unary"] + before @ weights["chain"] + after @ weights["chain"].T + equal @ weights["equal"] + alike @ weights["alike"]
        error = (_softmax(logits) * mass - target) / mass.sum()
        slopes = {"unary": x.T @ error, "chain": before.T @ error + error.T @ after}
        for kind, found in (("equal", equal), ("alike", alike)):
            slope = found.T @ error
            slopes[kind] = slope + slope.T  # such edges have no direction
        for name, weight in weights.items():
            slope = slopes[name] + SHRINK * weight
            mean, square = moments[name]
            mean += 0.1 * (slope - mean)
            square += 0.001 * (slope * slope - square)
            weight -= STEP * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return {name: np.clip(w, -MOST_WEIGHT, MOST_WEIGHT) for name, w in weights.items()}


def fit(docs: DataFrame) -> dict[str, np.ndarray]:
    """The potentials, from counts over all documents."""
    counted = doc_texts(docs).mapInArrow(_count, "key array<int>, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return fit_potentials({tuple(row["key"]): row["n"] for row in counted.toLocalIterator()})


# -- inference -----------------------------------------------------------------------------------


def marginals(unary: np.ndarray, edges: np.ndarray, potentials: np.ndarray) -> np.ndarray:
    """Label probabilities of each node by loopy sum-product messages along ``edges`` (a, b).

    ``unary`` are log potentials; ``potentials[e]`` those of edge e, rows for a's label and columns for b's.
    """
    n = len(edges)
    if not n:
        return _softmax(unary)
    source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
    along = np.exp(np.concatenate([potentials, potentials.transpose(0, 2, 1)]))
    back = np.concatenate([np.arange(n, 2 * n), np.arange(n)])
    messages = np.zeros((2 * n, LABELS))
    for _ in range(ROUNDS):
        belief = unary.copy()
        np.add.at(belief, target, messages)
        out = belief[source] - messages[back]
        out = np.exp(out - out.max(1, keepdims=True))
        fresh = np.log(np.einsum("el,elk->ek", out, along) + 1e-300)
        messages = 0.5 * messages + 0.5 * (fresh - fresh.max(1, keepdims=True))
    belief = unary.copy()
    np.add.at(belief, target, messages)
    return _softmax(belief)


def spans_of(text: str | None, model: dict[str, np.ndarray]) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, whether a pattern matched) of all spans, in the order of listing."""
    if not text or not _PRIVATE.search(text):
        return []
    base = base_spans(text)
    found = [(start, kind, end, True) for start, kind, end in base]
    nodes = nodes_of(text, base)
    open_nodes = [i for i, node in enumerate(nodes) if node[2] == OTHER]
    if open_nodes:
        edges = edges_of(text, nodes)
        features = np.stack([_one_hot(_shape(text[start:end])) for start, end, _ in nodes])
        unary = features @ model["unary"]
        for i, (_, _, label) in enumerate(nodes):
            if label != OTHER:
                unary[i] = -50.0
                unary[i, label] = 0.0
        potentials = np.concatenate([np.repeat(model[kind][None], len(some), 0) for kind, some in edges.items()])
        pairs = [pair for some in edges.values() for pair in some]
        likely = marginals(unary, np.array(pairs, np.int64).reshape(-1, 2), potentials)
        for i in open_nodes:
            label = int(likely[i].argmax())
            if label != OTHER and likely[i, label] >= ADD_FROM:
                found.append((nodes[i][0], label, nodes[i][1], False))
    return [(KINDS[kind], start, end, matched) for start, kind, end, matched in sorted(found)]


SPANS = "array<struct<kind:string,start:int,end:int,matched:boolean>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("matched", pa.bool_())]))


def find_spans(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """doc_id and spans of every document row; positions are code points, ends exclusive."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("kind", "start", "end", "matched")
        for batch in batches:
            found = [[dict(zip(names, s)) for s in spans_of(t, sent.value)] for t in each(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _SPANS)], ["doc_id", "spans"])

    return doc_texts(docs).mapInArrow(run, f"doc_id long, spans {SPANS}")


def masked(text: str | None, spans: list[tuple[str, int, int, bool]]) -> str | None:
    """``text`` with each span replaced by its kind in brackets; of overlapping spans the first."""
    if not spans:
        return text
    parts, at = [], 0
    for kind, start, end, _ in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def mask_documents(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """``docs`` with all its columns, spans masked in ``text``; a null text stays null."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    where = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [masked(text, spans_of(text, sent.value)) for text in each(batch.column(where))]
            yield batch.set_column(where, batch.schema.field(where), pa.array(texts, batch.schema.field(where).type))

    return docs.mapInArrow(run, docs.schema)
