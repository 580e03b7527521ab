"""The registered queries on the smallest test tables, against their SQL or plain Python."""

from __future__ import annotations

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import public_tokenizers
import pyarrow.parquet as pq
import pytest

from ordermill.llm import pii, queries
from ordermill.llm.token_counts import encoder

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables absent")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts():
    rows = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return {row["doc_id"]: row["text"] or "" for row in rows}


@pytest.fixture
def answer(spark):
    return lambda name: {row["doc_id"]: row.asDict() for row in queries.all_queries()[name](spark, FOLDER).collect()}


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def lower(text):
    return text.encode().lower().decode()  # A-Z only


@pytest.mark.parametrize("name", list(queries.all_oracles()))
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    for table in ("documents", "benchmark", "embeddings"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got = queries.all_queries()[name](spark, FOLDER)
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR"}
    expected = duckdb.sql(queries.all_oracles()[name])
    assert {c: names.get(t, t.upper()) for c, t in got.dtypes} == dict(zip(expected.columns, map(str, expected.types)))
    columns = sorted(got.columns)
    rows = duckdb.sql(f"SELECT {', '.join(columns)} FROM ({queries.all_oracles()[name]})").fetchall()
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(rows, key=str) and rows


def test_quality(answer, texts):
    got = answer("op1_quality_rules")
    for doc_id, text in texts.items():
        words = WORDS.findall(text)
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        count = Counter(grams)
        covered = len({i + k for i, gram in enumerate(grams) if count[gram] > 1 for k in range(3)})
        row = got[doc_id]
        assert (row["n_words"], row["word_chars"], row["n_repeat_words"]) == (len(words), sum(map(len, words)), covered)
        assert row["base_failed"] == (len(words) < 50 or 100 * covered > 50 * len(words))
        assert not (row["kept"] and row["base_failed"])
    assert len(got) == len(texts) and any(not r["kept"] and not r["base_failed"] for r in got.values())


def test_byte_level_bpe(answer, texts):
    encode = encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).encode_ordinary
    got = answer("op2_byte_level_bpe")
    for doc_id, text in texts.items():
        ids = encode(text)
        assert got[doc_id] == {"doc_id": doc_id, "n_tokens": len(ids), "ids_sha256": sha(" ".join(map(str, ids))), "decoded_sha256": sha(text)}


def test_pii(answer, texts):
    got = answer("op4_pii")
    for doc_id, text in texts.items():
        base = pii.base_spans(text)
        listed = [f"{pii.KINDS[kind]}:{start}:{end}" for start, kind, end in base]
        row = got[doc_id]
        assert [row[f"n_{kind}"] for kind in pii.KINDS] == [sum(k == i for _, k, _ in base) for i in range(len(pii.KINDS))]
        assert row["base_sha256"] == sha(",".join(listed))
        spans = row["spans"].split(",") if row["spans"] else []
        assert set(listed) <= set(spans)


def test_lm_scoring(answer, texts):
    got = answer("op5_lm_scoring")
    tokens = {doc_id: [w for w in WORDS.findall(lower(text))] + ["\n"] for doc_id, text in texts.items()}
    held = {doc_id: zlib.crc32(str(doc_id).encode()) % 7 == 2 for doc_id in texts}
    counts = Counter(t for doc_id, some in tokens.items() if not held[doc_id] for t in some)
    mass, distinct = sum(counts.values()), len(counts)
    for doc_id, some in tokens.items():
        row = got[doc_id]
        assert (row["held_out"], row["n_tokens"], row["train_tokens"]) == (held[doc_id], len(some), mass)
        assert row["n_known"] == sum(counts[t] > 0 for t in some)
        assert row["base_score"] == pytest.approx(sum(math.log10((counts[t] + 1) / (mass + distinct + 1)) for t in some))
        assert row["score"] < 0


def test_toxicity(answer, texts):
    got = answer("op6_toxicity")
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{FOLDER}/labels.parquet").to_pylist()}
    for doc_id in texts:
        row = got[doc_id]
        assert row["held_out"] == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.7)
    clean = [i for i in texts if labels.get(i) == 0 and got[i]["held_out"]]
    assert sum(got[i]["predicted"] for i in clean) <= 0.02 * len(clean)


def test_sharding(answer, texts):
    got = answer("op7_sharding")
    slots: dict[int, list[int]] = {}
    for doc_id, text in texts.items():
        row, data = got[doc_id], text.encode()
        assert (row["size"], row["text_crc32"], row["law"], row["grown_shard"]) == (len(data) + 16, zlib.crc32(data), "rows", None)
        slots.setdefault(row["shard"], []).append(row["slot"])
    assert sorted(slots) == list(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_token_counts(spark, texts):
    rows = queries.all_queries()["op8_token_counts"](spark, FOLDER).collect()
    encode = encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).encode_ordinary
    lengths = [len(encode(text)) for text in texts.values()]
    assert sorted(r["context_limit"] for r in rows) == sorted(set(lengths))
    for r in rows:
        limit = r["context_limit"]
        assert r["n_docs"] == lengths.count(limit) and r["docs_over"] == sum(n > limit for n in lengths)
        assert r["truncated_total"] == sum(min(n, limit) for n in lengths)
