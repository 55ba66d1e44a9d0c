"""Exact token counts for every context limit, from one histogram of encoded lengths."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windflow.llm.common import Scratch, over_batches, text_bytes, texts_of
from windflow.llm.tokens import coder, default_tokenizer

# Lengths that one window sums up in order.
BLOCK = 4096


def encoded_lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        code = coder(tokenizer).encode
        lengths = [len(code(t)) // 4 for t in text_bytes(batch.column(0))]
        return pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64())], ["length"])
    return docs.select("text").mapInArrow(over_batches(count), "length long")


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Adds to (`length`, `n_docs`): documents and tokens in all and of those at least as long.

    Blocks of lengths are summed first, so that no window orders more than `BLOCK` rows but the one
    over the blocks, of which there are as many as the longest text has blocks.
    """
    blocks = histogram.withColumn("block", F.floor(F.col("length") / BLOCK)).withColumn(
        "tokens", F.col("length") * F.col("n_docs"))
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = blocks.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t")).select(
        "block", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d_later"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t_later"),
        F.sum("d").over(every).alias("total_docs"), F.sum("t").over(every).alias("total_tokens"))
    own = Window.partitionBy("block").orderBy(F.col("length").desc())
    return blocks.join(totals, "block").select(
        "length", "n_docs", "total_docs", "total_tokens",
        (F.sum("n_docs").over(own) + F.col("d_later")).alias("docs_from"),
        (F.sum("tokens").over(own) + F.col("t_later")).alias("tokens_from"))


def token_counts(docs: DataFrame, *, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """For each length that occurs, taken as context limit: what fits and what is cut.

    `context_limit`, `n_docs` (documents of just that length), `docs_within` and `docs_beyond`, `tokens_within`
    (of documents not longer), `tokens_truncated` (of all, each cut at the limit), `tokens_lost`, `quantile` (share
    of documents not longer), `total_docs`, `total_tokens`. Between two listed limits every figure but
    `tokens_truncated` stays as it is, and that grows by `docs_beyond` a token: so the rows answer
    every limit. Null and empty texts have length 0; repeated rows count as often as they occur. An
    empty table gives no row. Texts are encoded once: the histogram is a table that all sums read.
    """
    with Scratch(docs.sparkSession) as scratch:
        lengths = encoded_lengths(docs.select(F.col(text_col).cast("string").alias("text")), tokenizer or default_tokenizer())
        histogram = scratch.table(lengths.groupBy("length").agg(F.count("*").alias("n_docs")), "histogram")
        return scratch.result(_figures(suffix_sums(histogram)))


def _figures(sums: DataFrame) -> DataFrame:
    beyond = F.col("docs_from") - F.col("n_docs")
    tokens_beyond = F.col("tokens_from") - F.col("length") * F.col("n_docs")
    within = F.col("total_tokens") - tokens_beyond
    truncated = within + F.col("length") * beyond
    return sums.select(
        F.col("length").alias("context_limit"), "n_docs", (F.col("total_docs") - beyond).alias("docs_within"),
        beyond.alias("docs_beyond"), within.alias("tokens_within"), truncated.alias("tokens_truncated"),
        (F.col("total_tokens") - truncated).alias("tokens_lost"),
        ((F.col("total_docs") - beyond) / F.col("total_docs")).alias("quantile"), "total_docs", "total_tokens")


def quantile_length(counts: DataFrame, share: float) -> DataFrame:
    """The smallest length that at least `share` of the documents do not exceed, from `token_counts`."""
    return counts.filter(F.col("quantile") >= share).agg(F.min("context_limit").alias("length"))
