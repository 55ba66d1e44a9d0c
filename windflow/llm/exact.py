"""Exact copies, found by comparing recipes of content-defined chunks.

A text, without white space, is cut where a rolling hash of its last bytes meets a condition, so that
equal passages are cut alike wherever they stand. A chunk gets a short identifier that is verified
against its SHA-256: where one short identifier covers several chunks, these are numbered apart. Texts
are equal when their lists of verified identifiers are. Only identifiers and digests are shuffled,
never texts; a group of copies is one row of a grouped aggregate, however large.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windflow.llm.common import Scratch, over_batches, text_bytes, texts_of

WHITE_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
ROLL = 32
# A cut every 4 KiB on average; a stretch without one is cut at 64 KiB.
CUT_BITS, LONGEST = 12, 1 << 16

_RECIPES = ("doc_id long, n_points long, text_sha256 string, n_bytes long, "
            "chunks array<long>, digests array<binary>")
_gear = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)


def cuts(text: bytes) -> list[int]:
    """Where the chunks of a text end. Depends on content only: on the bytes before a cut."""
    n = len(text)
    if n <= ROLL:
        return [n] if n else []
    values = _gear[np.frombuffer(text, dtype=np.uint8)]
    rolled, width = values, 1
    while width < ROLL:  # the hash of the last `width` bytes, doubled: a byte's share moves up a bit a step
        rolled = rolled[width:] + (rolled[:-width] << np.uint32(width))
        width *= 2
    marks = np.flatnonzero(rolled >> np.uint32(32 - CUT_BITS) == 0) + ROLL
    ends, last = [], 0
    for end in [*marks.tolist(), n]:
        while end - last > LONGEST:
            last += LONGEST
            ends.append(last)
        if end > last:
            ends.append(end)
            last = end
    return ends


def _recipes(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = []
    for doc_id, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
        bare = text.translate(None, WHITE_SPACE)
        ends = cuts(bare)
        digests = [hashlib.sha256(bare[a:b]).digest() for a, b in zip([0, *ends], ends)]
        rows.append((doc_id, len(text.decode()), hashlib.sha256(bare).hexdigest(), len(bare),
                     [int.from_bytes(d[:8], "big", signed=True) for d in digests], digests))
    names = ["doc_id", "n_points", "text_sha256", "n_bytes", "chunks", "digests"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary())]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)


def verified_recipes(recipes: DataFrame) -> DataFrame:
    """`recipe`: the texts' identifiers in order, numbered apart where a short one is ambiguous.

    A short identifier that covers one digest, all but never more, stands for itself. Of the others
    the digests are numbered in order and take part in the recipe.
    """
    used = recipes.select(F.explode(F.arrays_zip("chunks", "digests")).alias("c")).select(
        F.col("c.chunks").alias("chunk"), F.col("c.digests").alias("digest"))
    ambiguous = (used.groupBy("chunk").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
                 .filter("low <> high").select("chunk"))
    numbered = (used.join(ambiguous, "chunk", "left_semi").distinct()
                .groupBy("chunk").agg(F.array_sort(F.collect_set("digest")).alias("known")))
    steps = (recipes.select("text_sha256", F.posexplode(F.arrays_zip("chunks", "digests")).alias("at", "c"))
             .select("text_sha256", "at", F.col("c.chunks").alias("chunk"), F.col("c.digests").alias("digest"))
             .join(numbered, "chunk")
             .groupBy("text_sha256").agg(F.array_sort(F.collect_set(F.struct(
                 "at", F.array_position("known", F.col("digest")).alias("number")))).alias("numbers")))
    return (recipes.join(steps, "text_sha256", "left")
            .withColumn("recipe", F.struct("n_bytes", "chunks", "numbers")).drop("numbers"))


def exact_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Which texts are equal but for white space, and which row of each group stays.

    One row per input row: `doc_id`, `keep_id`, `group_size`, `kept`, `text_sha256`, `n_chunks`. The
    row with the most code points in its original text stays, then the smallest id. A null text is an
    empty one; empty texts equal one another. Rows without an id sort behind all others; where only
    such rows share a text, `keep_id` is null and all are kept. Rows that repeat an id are separate
    members of their group, and all that bear the kept id stay. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        recipes = scratch.table(
            texts_of(docs, id_col, text_col).mapInArrow(over_batches(_recipes), _RECIPES), "recipes")
        named = scratch.table(verified_recipes(recipes).select(
            "doc_id", "n_points", "text_sha256", F.size("chunks").cast("long").alias("n_chunks"),
            F.sha2(F.to_json("recipe", {"ignoreNullFields": "false"}), 256).alias("recipe")), "named")
        stays = named.groupBy("recipe").agg(
            F.max(F.struct("n_points", (-F.col("doc_id")).alias("minus"))).alias("best"),
            F.max(F.when(F.col("doc_id").isNotNull(),
                         F.struct("n_points", (-F.col("doc_id")).alias("minus")))).alias("named_best"),
            F.count("*").alias("group_size"))
        keep = -F.coalesce("named_best", "best")["minus"]
        return scratch.result(named.join(stays, "recipe").select(
            "doc_id", keep.alias("keep_id"), "group_size",
            F.when(keep.isNull(), True).otherwise(F.coalesce(F.col("doc_id") == keep, F.lit(False)))
            .alias("kept"), "text_sha256", "n_chunks"))
