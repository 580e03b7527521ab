"""Token counts for every context limit from one exact histogram of encoded lengths.

Documents are encoded once and aggregated by length; the histogram is written out, and all answers come from it.  Its
size is the number of distinct lengths and not the number of documents.  Suffix sums over it tell, for every
limit L, how many documents are longer, how many tokens remain when each document is cut at L, and which
quantile L is.  The sums run in two levels (blocks of lengths, then lengths in a block), so that no task
needs the whole histogram.

Cases: a null or empty text has length 0; repeated rows count each; an empty table gives an empty
histogram; other columns are ignored; very long texts are encoded whole.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ordermill.llm.shared import doc_texts, each, stage

BLOCK = 512  # lengths per block of the two-level sums


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encoder(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


def encoded_lengths(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and n_tokens of every whole text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, pattern).encode_ordinary
        for batch in batches:
            lengths = [len(encode(text)) for text in each(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64())], ["doc_id", "n_tokens"])

    return doc_texts(docs).mapInArrow(count, "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """n_docs of every n_tokens, written out: the answers read it several times, the texts are encoded once."""
    return stage(lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")), "lengths")


def totals_at(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """docs_over, tokens_over, truncated_total and tokens_lost at each of the given limits, whether a document has it or not.

    One aggregate with partial results over histogram rows times limits.
    """
    if any(limit < 0 for limit in limits):
        raise ValueError("limits must not be negative")
    n, docs = F.col("n_tokens"), F.col("n_docs")
    at = F.explode(F.array(*[F.lit(limit).cast("long") for limit in sorted(set(limits))]))
    over, zero = n > F.col("context_limit"), F.lit(0)
    sums = {
        "docs_over": F.when(over, docs).otherwise(zero),
        "tokens_over": F.when(over, n * docs).otherwise(zero),
        "truncated_total": F.least(n, F.col("context_limit")) * docs,
        "tokens_lost": F.greatest(n - F.col("context_limit"), zero) * docs,
    }
    rows = histogram.select("n_tokens", "n_docs", at.alias("context_limit"))
    return rows.groupBy("context_limit").agg(*[F.sum(value).cast("long").alias(name) for name, value in sums.items()])


def quantile_lengths(report: DataFrame, shares: list[float]) -> dict[float, int | None]:
    """For each share the shortest length that so many of the documents do not exceed; None without documents."""
    if any(not 0 < share <= 1 for share in shares):
        raise ValueError("shares lie above 0 and up to 1")
    found = [F.min(F.when(F.col("quantile") >= share, F.col("context_limit"))).alias(f"s{i}") for i, share in enumerate(shares)]
    row = report.agg(*found).first()
    return dict(zip(shares, row))


def context_report(histogram: DataFrame) -> DataFrame:
    """One row per distinct length, taken as a context limit.

    docs_over and tokens_over count the documents longer than the limit and their tokens; docs_total and
    tokens_total are the whole; truncated_total is the sum of min(length, limit); tokens_lost the rest;
    quantile the share of documents not longer.  Between two neighbouring limits truncated_total is
    linear in the limit with slope docs_over of the lower one, so the table answers every limit.
    """
    tokens = F.col("n_tokens") * F.col("n_docs")
    rows = histogram.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("tokens", tokens)
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    later = Window.orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    whole = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("block_docs").over(later), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("block_tokens").over(later), F.lit(0)).alias("tokens_after"),
        F.sum("block_docs").over(whole).alias("docs_total"),
        F.sum("block_tokens").over(whole).alias("tokens_total"),
    )
    longer = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(1, Window.unboundedFollowing)
    over = F.col("docs_after") + F.coalesce(F.sum("n_docs").over(longer), F.lit(0))
    tokens_over = F.col("tokens_after") + F.coalesce(F.sum("tokens").over(longer), F.lit(0))
    report = rows.join(blocks, "block").withColumn("docs_over", over).withColumn("tokens_over", tokens_over)
    lost = F.col("tokens_over") - F.col("docs_over") * F.col("n_tokens")
    return report.select(
        F.col("n_tokens").alias("context_limit"),
        "n_docs",
        "docs_over",
        "tokens_over",
        "docs_total",
        "tokens_total",
        (F.col("tokens_total") - lost).alias("truncated_total"),
        lost.alias("tokens_lost"),
        ((F.col("docs_total") - F.col("docs_over")) / F.col("docs_total")).alias("quantile"),
    )
