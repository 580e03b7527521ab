"""Byte-level BPE by distinct words: each distinct pre-token of the corpus is encoded once.

Texts are split into pre-tokens, whose positions are kept per block of documents (see blocks.py).  The
distinct pre-tokens of all blocks are shuffled by hash, so that equal ones meet and are encoded once;
their ids go back to the blocks that hold them and are put in place of the positions.  Decoding joins the
token-byte table, which is as large as the vocabulary file and goes to every task.

Cases: a null or empty text has no ids and decodes to no bytes; rows with equal ids or texts stay
separate rows; an empty table gives an empty result; other columns are ignored; texts are encoded whole,
with one pre-token of any length; null ids decode to null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ordermill.llm.blocks import WORDS, pack, send_back, unpack, write_blocks
from ordermill.llm.token_counts import encoder, read_ranks

# Matches any pre-token as a whole, so that the merges run within it and nowhere else.
WHOLE = r"(?s:.+)"
DECODED = 256  # documents decoded at once


def token_bytes(path: str) -> list[bytes]:
    """The token-byte table: the bytes of every id, none for an unused id."""
    ranks = read_ranks(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def _encode_part(path: str):
    """Ids for the words of one part, each distinct word encoded once, packed for every block that has it."""

    def run(rows: list[tuple[np.ndarray, list[bytes], np.ndarray]]) -> list[bytes]:
        encode = encoder(path, WHOLE).encode_ordinary
        ids_of = {word: encode(word.decode()) for word in {word for _, words, _ in rows for word in words}}
        return [_pack_ids(numbers, [ids_of[word] for word in words]) for numbers, words, _ in rows]

    return run


def _pack_ids(numbers: np.ndarray, ids: list[list[int]]) -> bytes:
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter(chain.from_iterable(ids), np.int64, lengths.sum())
    head = pack(np.concatenate([np.diff(numbers, prepend=0), lengths]))
    return len(head).to_bytes(4, "little") + head + pack(flat)


def _unpack_ids(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of a block, how many ids each has, and the ids."""
    end = 4 + int.from_bytes(payload[:4], "little")
    steps, lengths = unpack(payload[4:end]).reshape(2, -1)
    return np.cumsum(steps), lengths, unpack(payload[end:])


def _reassemble(documents: pa.Table, coded: pa.Table) -> pa.Table:
    """The ids of each document of a block, its word numbers replaced by the words' ids."""
    parts = [_unpack_ids(payload) for payload in coded.column("payload").to_pylist()]
    numbers, sizes, flat = (np.concatenate(x) if parts else np.zeros(0, np.int32) for x in (zip(*parts) if parts else [[]] * 3))
    starts, lengths = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
    lengths[numbers] = sizes
    starts[numbers] = np.cumsum(sizes, dtype=np.int64) - sizes
    payloads = documents.column("payload").to_pylist()
    out, totals = [], []
    for payload in payloads:
        at = unpack(payload)
        size = lengths[at]
        total = int(size.sum())
        shift = np.repeat(starts[at] - (np.cumsum(size) - size), size)
        out.append(flat[shift + np.arange(total)])
        totals.append(total)
    offsets = np.zeros(len(totals) + 1, np.int32)
    np.cumsum(totals, out=offsets[1:])
    values = np.concatenate(out).astype(np.int32) if out else np.zeros(0, np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
    return pa.table([documents.column("doc_id"), lists], names=["doc_id", "ids"])


def _code_blocks(docs: DataFrame, path: str, pattern: str, words: int, finish, schema: str) -> DataFrame:
    def splitter():
        import regex

        return regex.compile(pattern).findall

    documents, distinct = write_blocks(docs, splitter, words=words)
    coded = send_back(distinct, _encode_part(path))
    return documents.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(finish, schema)


def encode_documents(docs: DataFrame, path: str, pattern: str, words: int = WORDS) -> DataFrame:
    """doc_id and ids (array of int) of every whole text, as the rank file at ``path`` has it.

    ``words`` is the size of a block: smaller ones need less memory and send more.
    """
    return _code_blocks(docs, path, pattern, words, _reassemble, "doc_id long, ids array<int>")


def encode_and_decode(docs: DataFrame, path: str, pattern: str, finish, schema: str, words: int = WORDS) -> DataFrame:
    """Encodes every text and decodes its ids again where they are put together, so that ids travel once.

    ``finish(doc_ids, ids, bytes)`` makes the output rows of some documents, which have the given schema.
    """
    decode = decode_batches(path, finish)

    def run(documents: pa.Table, coded: pa.Table) -> pa.Table:
        batches = _reassemble(documents, coded).to_batches(max_chunksize=DECODED)
        return pa.Table.from_batches(decode(iter(batches))) if batches else decode_nothing(finish)

    return _code_blocks(docs, path, pattern, words, run, schema)


def decode_nothing(finish) -> pa.Table:
    return pa.Table.from_batches([finish(pa.array([], pa.int64()), [], [])])


def decode_batches(path: str, finish):
    """A mapInArrow function over (doc_id, ids): ``finish(doc_ids, ids, bytes)`` makes each output batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look_up = token_bytes(path).__getitem__
        for batch in batches:
            for at in range(0, batch.num_rows, DECODED):
                part = batch.slice(at, DECODED)
                ids = part.column(1).to_pylist()
                decoded = [None if each is None else b"".join(map(look_up, each)) for each in ids]
                yield finish(part.column(0), ids, decoded)

    return run


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the bytes of every document's ids."""

    def finish(doc_ids, _, decoded):
        return pa.RecordBatch.from_arrays([doc_ids, pa.array(decoded, pa.binary())], ["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(decode_batches(path, finish), "doc_id long, bytes binary")
