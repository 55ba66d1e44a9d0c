"""Packing token sequences: as few as can be, each full up to a limit.

Only the lengths of the pieces matter, and there are at most `capacity` of them. So the driver plans
on the histogram of lengths: dominance fixes pairs that no better packing needs to part (Martello and
Toth's reduction), and best fit, largest first, packs what is left, many equal bins in one step. Spark
numbers the pieces of a length, and a piece finds its sequence by its number.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windflow.llm.common import Scratch, over_batches, text_bytes, texts_of
from windflow.llm.tokens import coder, default_tokenizer

CAPACITY, END_ID = 2048, 0
# Rows that number the pieces of one length together; a frequent length has many such blocks.
NUMBERING_BLOCKS = 4096

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
Plan = list[tuple[tuple[int, ...], int]]


def reduced(counts: np.ndarray, capacity: int) -> Plan:
    """Bins that dominate every other use of their largest piece; takes their pieces from `counts`.

    For the largest free length with k the largest that fits beside it, {largest, k} dominates if
    k fills the bin, if no two pieces fit beside the largest, or if no three do and no two that do are
    longer together than k. A length that nothing fits beside has a bin of its own.
    """
    plan: Plan = []
    changed = True
    while changed:
        changed = False
        for size in range(capacity, 0, -1):
            while counts[size]:
                room = capacity - size
                counts[size] -= 1
                present = np.flatnonzero(counts[:room + 1])
                counts[size] += 1
                if not len(present):
                    step, times = (size,), int(counts[size])
                    if room >= size:  # one piece is left, and no other
                        times = 1
                else:
                    partner = int(present[-1])
                    if not (partner == room or _single(counts, size, present, room)
                            or _covers_pairs(counts, size, present, room, partner)):
                        break
                    step = (size, partner)
                    times = int(counts[size]) // 2 if size == partner else int(min(counts[size], counts[partner]))
                for s in step:
                    counts[s] -= times
                plan.append((step, times))
                changed = True
    return plan


def _left(counts: np.ndarray, size: int, s: int) -> int:
    return int(counts[s]) - (s == size)


def _smallest(counts: np.ndarray, size: int, present: np.ndarray, n: int) -> int:
    """The sum of the n smallest free pieces, or more than any room if there are fewer."""
    total, need = 0, n
    for s in present.tolist():
        take = min(need, _left(counts, size, s))
        total, need = total + take * s, need - take
        if not need:
            return total
    return 1 << 40


def _single(counts, size, present, room) -> bool:
    return _smallest(counts, size, present, 2) > room


def _covers_pairs(counts, size, present, room, partner) -> bool:
    if _smallest(counts, size, present, 3) <= room:
        return False
    best, sizes = 0, present.tolist()
    low, high = 0, len(sizes) - 1
    while low <= high:
        total = sizes[low] + sizes[high]
        if total > room:
            high -= 1
        else:
            if low < high or _left(counts, size, sizes[low]) > 1:
                best = max(best, total)
            low += 1
    return best <= partner


def best_fit(counts: np.ndarray, capacity: int) -> Plan:
    """Best fit decreasing over the histogram; equal bins are filled in one step."""
    open_bins: list[Counter] = [Counter() for _ in range(capacity + 1)]
    for size in range(capacity, 0, -1):
        left, counts[size] = int(counts[size]), 0
        room = size
        while left and room <= capacity:
            for held in list(open_bins[room]):
                if not left:
                    break
                each = room // size
                bins = open_bins[room].pop(held)
                full = min(bins, left // each)
                if full:
                    open_bins[room - each * size][held + (size,) * each] += full
                    left, bins = left - full * each, bins - full
                if bins and left:  # fewer than a bin takes
                    open_bins[room - left * size][held + (size,) * left] += 1
                    left, bins = 0, bins - 1
                if bins:
                    open_bins[room][held] += bins
            room += 1
        each = capacity // size
        if left // each:
            open_bins[capacity - each * size][(size,) * each] += left // each
        if left % each:
            open_bins[capacity - left % each * size][(size,) * (left % each)] += 1
    return [(held, bins) for group in open_bins for held, bins in group.items()]


def plan_rows(plan: Plan) -> list[tuple[int, int, int, int]]:
    """(length, first number, first sequence, place) of each run of pieces, by length and number."""
    rows, used, sequence = [], Counter(), 0
    for held, bins in plan:
        place = 0
        for size in held:
            rows.append((size, used[size], sequence, place))
            used[size] += bins
            place += size
        sequence += bins
    return sorted(rows)


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """Every text's ids and `end_id`, cut into pieces of `capacity`."""
    end = int(end_id).to_bytes(4, "little")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        code = coder(tokenizer).encode
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
            ids = code(text) + end
            for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at:at + 4 * capacity]
                rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
            ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.mapInArrow(over_batches(cut), _PIECES)


def numbered(pieces: DataFrame) -> DataFrame:
    """`number`: 0, 1, … among the pieces of a length, in no particular order.

    A window numbers each (length, block) and the totals of the blocks before are added, so a length
    that most pieces have is spread over all blocks.
    """
    blocks = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(NUMBERING_BLOCKS)).cast("int"))
    totals = blocks.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    own = Window.partitionBy("length", "block").orderBy("doc_id", "piece")
    return (blocks.withColumn("own", F.row_number().over(own) - 1)
            .join(offsets, ["length", "block"])
            .withColumn("number", F.col("own") + F.col("earlier")).drop("own", "earlier", "block"))


def packed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """Where each piece of each text goes: `sequence_id` and `offset` in it.

    One row per piece: `doc_id`, `piece`, `start`, `length`, `ids_crc32`, `sequence_id`, `offset`. The
    pieces of a sequence follow one another without a gap from 0. A null or empty text is `end_id`
    alone. Rows that repeat an id, or have none, are texts of their own. An empty table gives no row.
    The histogram has at most `capacity` rows, and the plan, which every task holds, is made from it
    alone: its size does not grow with the number of texts.
    """
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        pieces = scratch.table(
            pieces_of(texts_of(docs, id_col, text_col), tokenizer or default_tokenizer(), capacity, end_id), "pieces")
        counts = np.zeros(capacity + 1, dtype=np.int64)
        for size, n in pieces.groupBy("length").count().collect():
            counts[size] = n
        plan = reduced(counts, capacity)
        plan += best_fit(counts, capacity)
        rows = np.array(plan_rows(plan), dtype=np.int64).reshape(-1, 4)
        shared = spark.sparkContext.broadcast(rows)

        def place(batches):
            plan_of = shared.value
            bounds = np.searchsorted(plan_of[:, 0], np.arange(capacity + 2))
            for batch in batches:
                size = batch.column("length").to_numpy()
                number = batch.column("number").to_numpy()
                at = np.empty(len(size), dtype=np.int64)
                for s in np.unique(size):
                    low, high = bounds[s], bounds[s + 1]
                    mine = size == s
                    at[mine] = low + np.searchsorted(plan_of[low:high, 1], number[mine], side="right") - 1
                sequence = plan_of[at, 2] + number - plan_of[at, 1]
                kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(sequence), pa.array(plan_of[at, 3])],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

        return scratch.result(numbered(pieces).mapInArrow(place, _PIECES + ", sequence_id long, offset long"))
