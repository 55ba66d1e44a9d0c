"""From raw documents to packed training sequences, a stage at a time.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last
return rows of `docs` with all their columns. Rows without a `doc_id` are never named by a decision and
stay; rows that repeat an id go together, and only if each of them is to go.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windflow.llm import exact, language, near, packing, templates
from windflow.llm.common import Scratch

# Near copies share this share of their runs of five words, in hundredths.
NEAR_PERCENT = 80


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def _to_drop(judged: DataFrame) -> DataFrame:
    """The ids of which no row is kept."""
    return judged.groupBy("doc_id").agg(F.max("kept").alias("any_kept")).filter("not any_kept").select("doc_id")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; what has no letters or is a near tie for its length goes."""
    learned = language.learn(docs)
    return language.accepted(docs, learned, least=language.margins(docs, learned))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal but for white space."""
    return _without(docs, _to_drop(exact.exact_copies(docs)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return _without(docs, _to_drop(near.near_copies(docs, percent=NEAR_PERCENT)))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark question."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, templates.contaminated(docs, benchmark, all_slots=False).select("doc_id").distinct())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes, in sequences of at most 2048 tokens."""
    return packing.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

# Compression, MinHash and a tokenizer have no SQL form; tests compare the stages with plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn on `documents`; each result is a table in the shared folder, read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark) as scratch:
        for name, stage in STAGES[:-1]:
            docs = scratch.table(stage(spark, docs, sf_dir), name)
        return scratch.result(STAGES[-1][1](spark, docs, sf_dir))
