"""The operators as queries over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windflow.llm import (exact, filter_audit, language, licenses, near, overlap, packing, phrases, substrings,
                          suffixes, templates, token_counts, urls)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of the session and the folder of tables under its own name."""
    def register(build):
        QUERIES[build.__name__] = build
        if sql:
            ORACLE[build.__name__] = sql
        return build
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_copies(table(spark, folder, "documents"))


@query("""
WITH t AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_points,
           regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS bare
    FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY bare) AS group_size,
       doc_id = first_value(doc_id) OVER g AS kept, sha256(bare) AS text_sha256
FROM t WINDOW g AS (PARTITION BY bare ORDER BY n_points DESC, doc_id)""")
def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_copies(table(spark, folder, "documents")).drop("n_chunks")


# The rules that the query applies.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]


@query(urls.oracle(RULES))
def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    labels = urls.labels_by_title(pages, table(spark, folder, "documents"), table(spark, folder, "labels"))
    return urls.judged(pages, labels, RULES).drop("purity")


@query()
def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return templates.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"),
                                  all_slots=False)


@query()
def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.without_repeated_passages(table(spark, folder, "documents"))


@query()
def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


@query()
def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    learned = language.learn(docs)
    predicted = language.predict(docs, learned, least=language.margins(docs, learned))
    return predicted.select("doc_id", (~language.training_rows(predicted)).alias("held_out"),
                            "lang_pred", "score", "margin", "rejected")


@query()
def op8_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.without_repeated_bytes(table(spark, folder, "documents"))


@query()
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"))


@query()
def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"))


@query(phrases.ORACLE)
def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.phrase_collocations(table(spark, folder, "documents"))


@query(filter_audit.ORACLE)
def op12_filter_interaction_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.document_audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op13_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return overlap.ngram_links(table(spark, folder, "documents"))
