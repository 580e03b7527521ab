"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import oracles
from ordermill.llm.bpe import encode_and_decode
from ordermill.llm.collocations import collocations
from ordermill.llm.decontamination import contamination
from ordermill.llm.hard_negatives import hard_negatives
from ordermill.llm.jaccard_join import jaccard_classes
from ordermill.llm.lm_score import score_documents
from ordermill.llm.packing import cut_documents, pack
from ordermill.llm.pii import KINDS, find_spans
from ordermill.llm.pii import fit as fit_pii
from ordermill.llm.quality import score_quality
from ordermill.llm.shared import short_batches
from ordermill.llm.sharding import shard_documents
from ordermill.llm.substring_dedup import remove_repeats
from ordermill.llm.token_counts import context_report, encoded_lengths, length_histogram
from ordermill.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}

RANKS = "byte_bpe_50k.tiktoken"


def _register(query: Query) -> Query:
    _queries[query.__name__] = query
    return query


def all_queries() -> dict[str, Query]:
    return dict(_queries)


def all_oracles() -> dict[str, str]:
    """The queries that SQL can say as a whole; tests/llm holds the others against plain versions."""
    return oracles.all_oracles()


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    short_batches(spark)
    return spark.read.parquet(f"{folder}/documents.parquet")


@_register
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base measures, votes and verdict of every document."""
    return score_quality(_documents(spark, folder))


@_register
def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(_documents(spark, folder))


@_register
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Totals, quantiles and truncated totals for every context limit."""
    lengths = encoded_lengths(_documents(spark, folder), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return context_report(length_histogram(lengths))


@_register
def op2_byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of each document's ids and of the bytes they decode to."""
    path = public_tokenizers.path(RANKS)

    numerals = list(map(str, range(60_000)))

    def digests(doc_ids, ids, decoded):
        names = [" ".join(map(numerals.__getitem__, each)).encode() for each in ids]
        columns = [
            doc_ids,
            pa.array([len(each) for each in ids], pa.int64()),
            pa.array([hashlib.sha256(each).hexdigest() for each in names], pa.string()),
            pa.array([hashlib.sha256(each).hexdigest() for each in decoded], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return encode_and_decode(_documents(spark, folder), path, public_tokenizers.PATTERN, digests, schema)


@_register
def op10_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """The words of each document inside windows of benchmark items."""
    judged = contamination(_documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


@_register
def op9_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Set size and class of each document, 4-word shingles, similarity of 0.85."""
    return jaccard_classes(_documents(spark, folder))


@_register
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Score and verdict of every document, learnt from the labels outside the held-out fold."""
    return toxicity(_documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


@_register
def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document: counts and digest of the pattern matches, and all spans."""
    docs = _documents(spark, folder)
    found = find_spans(docs, fit_pii(docs))
    as_text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    matched = F.filter("spans", lambda s: s["matched"])
    counts = [F.size(F.array_remove(F.transform(matched, lambda s: s["kind"] == F.lit(kind)), False)) for kind in KINDS]
    return found.select(
        "doc_id",
        *[n.cast("long").alias(f"n_{kind}") for n, kind in zip(counts, KINDS)],
        F.sha2(F.concat_ws(",", F.transform(matched, as_text)), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("spans", as_text)).alias("spans"),
    )


@_register
def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each document in repeated 20-word windows, and a digest of the rest."""
    left = remove_repeats(_documents(spark, folder))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_register
def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Base and model log10 probability of every document, learnt from the training folds."""
    return score_documents(_documents(spark, folder))


@_register
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by 100, some labels moved on by one first."""
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    label = F.col("label").cast("long")
    moved = F.when(F.coalesce(F.col("vec_id") % 7 == 0, F.lit(False)), (label + 1) % 10).otherwise(label)
    vectors = rows.select("vec_id", moved.alias("label"), (F.col("vec_id") % 100 == 0).alias("anchor"), F.col("embedding").alias("vector"))
    return hard_negatives(vectors)


@_register
def op11_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most 1,024 tokens."""
    return pack(cut_documents(_documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN))


@_register
def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2,000 best phrases of two or three words of each language."""
    return collocations(_documents(spark, folder))
