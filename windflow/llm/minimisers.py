"""Windows that occur more than once, found by sending runs of windows to the bucket of their minimiser.

A text is a sequence of symbols: words or bytes. The minimiser of a window is the smallest hash of the
short grams in it, leftmost first, so equal windows have equal ones. Windows in a row that share one
*position* travel as one packed string, a fragment. No two windows of a fragment are equal, and equal
windows lie in fragments of the same bucket.

Only buckets with two fragments or more matter. Equal fragments are settled by their digest alone, in
grouped aggregates; one of each kind goes to its bucket, where a `finder` compares windows exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windflow.llm.common import (
    CHUNK_BYTES, Scratch, Words, power_tables, grams, list_array, mixed, over_batches, text_bytes)

# Different fragments of one bucket that a task compares in memory; larger buckets go window by window.
LARGE_BUCKET = 8000
# Bytes of fragments compared together: whole buckets, many at a time.
COMPARED_BYTES = 1 << 19
# Stands for a missing id: behind all others.
NO_ID = (1 << 63) - 1

_POSITION_BITS = 24
_POSITION = np.uint64((1 << _POSITION_BITS) - 1)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class Kind:
    """What a symbol is: how to lay out texts, and the order in which an occurrence counts as earlier."""

    window: int
    gram: int
    words: bool
    order: tuple[str, ...]

    def plain(self, text: bytes) -> bytes:
        return b" ".join(text.split()) if self.words else text

    def laid_out(self, texts: list[bytes]) -> Iterator[tuple[list[int], list[int], "Layout"]]:
        """(row, first symbol) of each stretch and its layout; a very long text comes in stretches that
        overlap by a window less one symbol."""
        if len(texts) > 1 or len(texts[0]) <= 2 * CHUNK_BYTES:
            yield list(range(len(texts))), [0] * len(texts), Layout(texts, self.words)
            return
        text, at, base, most = texts[0], 0, 0, CHUNK_BYTES
        while True:
            end = at + most
            if self.words and end < len(text):
                cut = text.find(b" ", end)
                end = len(text) if cut < 0 else cut
            stretch = Layout([text[at:end]], self.words)
            if stretch.n < self.window and end < len(text):  # very long words
                most *= 2
                continue
            yield [0], [base], stretch
            if end >= len(text):
                return
            step = max(0, stretch.n - self.window + 1)
            at += int(stretch.starts[step]) if self.words else step
            base += step


class Layout:
    """Texts end to end, as symbols: where each begins in the buffer, its hash, the end of its text."""

    def __init__(self, texts: list[bytes], words: bool):
        if words:
            held = Words(texts)
            self.buffer, self.starts, self.ends = held.buffer, held.starts, held.ends
            self.first = held.first
            self._hashes = held.hashes
        else:
            self.buffer = b"".join(texts)
            self.first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            self._hashes = None
        self.n = int(self.first[-1])
        self.text_of = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def gram_hashes(self, gram: int) -> np.ndarray:
        if self._hashes is not None:
            return grams(self._hashes(), gram)
        if self.n < gram:
            return np.zeros(0, dtype=np.uint64)
        raw = self.buffer + b"\0" * 8
        eight = np.ndarray(shape=(len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
        count = self.n - gram + 1
        total = np.zeros(count, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for at in [*range(0, gram - 8, 8), gram - 8]:  # the last eight may overlap those before
                total = total * np.uint64(0x9FB21C651E98DF25) ^ mixed(eight[at:at + count])
        return mixed(total)

    def digests(self, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each run of symbols, read off prefix sums of hashed words or of hashed stretches of
        eight bytes."""
        out = []
        with np.errstate(over="ignore"):
            for turn, salt in enumerate((0, 0xC2B2AE3D27D4EB4F)):
                if self._hashes is not None:  # hashes of words that do not depend on one another
                    values, stops = self._hashes(turn), starts + sizes
                else:
                    raw = self.buffer + b"\0" * 8
                    values = mixed(np.ndarray(shape=(len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,)))
                    stops = starts + sizes - 7
                up, down = power_tables(len(values))
                sums = np.zeros(len(values) + 1, dtype=np.uint64)
                np.cumsum(mixed(values ^ np.uint64(salt)) * up[:len(values)], out=sums[1:])
                out.append(((sums[stops] - sums[starts]) * down[starts] + sizes.astype(np.uint64)).view(np.int64))
        return out[0], out[1]


def fragments(layout: Layout, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First symbol, number of symbols and minimiser of each fragment, in order."""
    n = layout.n - window + 1
    empty = np.zeros(0, dtype=np.int64)
    if n <= 0:
        return empty, empty, empty.astype(np.uint64)
    hashes = layout.gram_hashes(gram)
    least = (hashes & ~_POSITION) | np.arange(len(hashes), dtype=np.uint64)
    width, span = window - gram + 1, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[:-(width - span)], least[width - span:])
    at = (least & _POSITION).astype(np.int64)
    ends = layout.first[1:][layout.text_of[:n]]
    valid = ends - np.arange(n) >= window
    new = valid.copy()
    new[1:] &= (at[1:] != at[:-1]) | ~valid[:-1]
    starts = np.flatnonzero(new)
    stops = np.flatnonzero(new | ~valid)
    following = np.append(stops, n)[np.searchsorted(stops, starts, side="right")]
    return starts, following - starts + window - 1, hashes[at[starts]]


_ANCHORED = "d long, h long, n long, sha string, anchors array<long>"
_OCCURRENCES = "anchor long, digest1 long, digest2 long, d long, h long, at long, size long"
_PACKED = "anchor long, c long, d long, h long, at long, size long, packed binary"
_SPANS = "d long, h long, s long, e long"


def _anchored(kind: Kind):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [kind.plain(t) for t in text_bytes(batch.column(2))]
        found: list[list[np.ndarray]] = [[] for _ in texts]
        sizes = np.zeros(len(texts), dtype=np.int64)
        for rows, bases, layout in kind.laid_out(texts):
            starts, _, anchors = fragments(layout, kind.window, kind.gram)
            per_text = np.bincount(layout.text_of[starts], minlength=len(rows)) if len(starts) else np.zeros(len(rows), int)
            edges = np.concatenate([[0], np.cumsum(per_text)])
            for k, row in enumerate(rows):
                found[row].append(anchors[edges[k]:edges[k + 1]])
                sizes[row] = bases[k] + layout.first[k + 1] - layout.first[k]
        counts = np.array([sum(map(len, f)) for f in found], dtype=np.int64)
        flat = [a for f in found for a in f]
        values = np.concatenate(flat) if flat else np.zeros(0, dtype=np.uint64)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes),
             pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
             list_array(pa.array(values.view(np.int64)), counts)], ["d", "h", "n", "sha", "anchors"])
    return over_batches(run)


def _occurrences(kind: Kind):
    """Where the fragments whose ordinals in their text are wanted stand, with their digests."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [kind.plain(t) for t in text_bytes(batch.column(2))]
        lists = batch.column(3)
        wanted = np.split(lists.flatten().to_numpy().astype(np.int64), np.cumsum(lists.value_lengths().to_numpy())[:-1])
        passed = [0] * len(texts)
        found: list[tuple[np.ndarray, ...]] = []
        for rows, bases, layout in kind.laid_out(texts):
            starts, sizes, anchors = fragments(layout, kind.window, kind.gram)
            counts = np.bincount(layout.text_of[starts], minlength=len(rows)) if len(starts) else [0] * len(rows)
            first, picked, holders = 0, [], []
            for k, row in enumerate(rows):
                here = wanted[row] - passed[row]
                here = here[(here >= 0) & (here < counts[k])]
                picked.append(first + here)
                holders.append(np.full(len(here), k))
                first += int(counts[k])
                passed[row] += int(counts[k])
            take, holder = np.concatenate(picked), np.concatenate(holders)
            if len(take):
                row_of, base_of = np.array(rows)[holder], np.array(bases)[holder]
                found.append((anchors[take].view(np.int64), *layout.digests(starts[take], sizes[take]), row_of,
                              base_of + starts[take] - layout.first[holder], sizes[take]))
        columns = [np.concatenate([f[c] for f in found]) if found else np.zeros(0, np.int64) for c in range(6)]
        ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        anchors, one, two, row_of, at, size = columns
        return pa.RecordBatch.from_arrays(
            [pa.array(anchors), pa.array(one), pa.array(two), pa.array(ids[row_of]), pa.array(keys[row_of]),
             pa.array(at), pa.array(size)], ["anchor", "digest1", "digest2", "d", "h", "at", "size"])
    return over_batches(run)


def _packed(kind: Kind):
    """The fragments listed for each text, as packed strings."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for d, h, text, listed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                      text_bytes(batch.column(2)), batch.column(3).to_pylist()):
            body = text.split() if kind.words else text
            for f in listed:
                part = body[f["at"]:f["at"] + f["size"]]
                rows.append((f["anchor"], f["c"], d, h, f["at"], f["size"], b" ".join(part) if kind.words else part))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)],
            ["anchor", "c", "d", "h", "at", "size", "packed"])
    return over_batches(run)


Finder = Callable[[list[bytes], np.ndarray, np.ndarray, int], list[tuple[int, int, int]]]


def _by_bucket(kind: Kind, finder: Finder):
    """Run `finder` over whole buckets of rows that come in the order of their anchor."""
    def spans(held: list[tuple]) -> pa.RecordBatch:
        found = finder([r[6] for r in held], np.array([r[2] for r in held], dtype=np.int64),
                       np.array([r[4] for r in held], dtype=np.int64), kind.window)
        return pa.RecordBatch.from_arrays(
            [pa.array([held[i][2] for i, _, _ in found], pa.int64()),
             pa.array([held[i][3] for i, _, _ in found], pa.int64()),
             pa.array([held[i][4] + s for i, s, _ in found], pa.int64()),
             pa.array([held[i][4] + e for i, _, e in found], pa.int64())], ["d", "h", "s", "e"])

    def run(batches):
        held, size, last = [], 0, None
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if row[0] != last and size > COMPARED_BYTES:
                    yield spans(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[6])
                last = row[0]
        if held:
            yield spans(held)
    return run


def _windows(kind: Kind):
    """Each window of a fragment by its digest: for buckets too large to compare in memory."""
    def run(batches):
        for batch in batches:
            rows = []
            for _, _, d, h, at, size, packed in zip(*[c.to_pylist() for c in batch.columns]):
                parts = packed.split(b" ") if kind.words else None
                for k in range(size - kind.window + 1):
                    window = b" ".join(parts[k:k + kind.window]) if kind.words else packed[k:k + kind.window]
                    rows.append((hashlib.blake2b(window, digest_size=16).digest(), d, h, at + k))
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)],
                                             ["digest", "d", "h", "at"])
    return run


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`d` the id, `h` a hash of the text (they name a row together), and `text`."""
    text = F.col(text_col).cast("string")
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("d"),
                       F.coalesce(F.xxhash64(text), F.lit(0)).alias("h"), text.alias("text"))


def _once(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """One row for each (`d`, `h`), of which `repeated` lists those with several."""
    return rows.join(repeated, ["d", "h"], "left_anti").unionByName(
        rows.join(repeated, ["d", "h"], "left_semi").dropDuplicates(["d", "h"]))


def repeated_spans(scratch: Scratch, rows: DataFrame, kind: Kind, finder: Finder,
                   large: int = LARGE_BUCKET) -> tuple[DataFrame, DataFrame]:
    """(texts, spans): `d, h, n, sha, copied` of each text and the spans `d, h, s, e` in symbols that later
    occurrences of windows cover. Spans overlap; copies of a whole text have none, but `copied`."""
    texts = scratch.table(rows.mapInArrow(_anchored(kind), _ANCHORED), "anchored")
    first_id = texts.groupBy("sha").agg(F.min("d").alias("first_d"))
    texts_marked = texts.join(first_id, "sha").withColumn("copied", F.col("d") > F.col("first_d"))
    # Rows that repeat id and text count once from here on; few of them are moved.
    repeated = scratch.table(texts.groupBy("d", "h").agg(F.count("*").alias("c")).filter("c > 1").select("d", "h"),
                             "repeated")
    if repeated.limit(1).count():
        rows, distinct = _once(rows, repeated), _once(texts_marked, repeated)
    else:
        distinct = texts_marked
    own = distinct.filter("not copied and n >= {}".format(kind.window)).select(
        "d", "h", F.posexplode("anchors").alias("ordinal", "anchor"))
    shared = own.groupBy("anchor").agg(F.count("*").alias("c")).filter("c > 1").select("anchor")
    wanted = scratch.table(own.join(shared, "anchor", "left_semi").groupBy("d", "h").agg(
        F.sort_array(F.collect_list("ordinal")).alias("wanted")), "wanted")
    seen = scratch.table(rows.join(wanted, ["d", "h"]).select("d", "h", "text", "wanted")
                         .mapInArrow(_occurrences(kind), _OCCURRENCES), "occurrences")

    order, same = F.struct(*kind.order), ["anchor", "digest1", "digest2"]
    firsts = scratch.table(seen.groupBy(*same).agg(F.min(order).alias("first")), "firsts")
    mixed_buckets = firsts.groupBy("anchor").agg(F.count("*").alias("c")).filter("c > 1")
    later = scratch.table(seen.join(firsts, same).filter(order > F.col("first")).select(
        "d", "h", F.col("at").alias("s"), (F.col("at") + F.col("size")).alias("e")), "later")
    leaders = seen.join(firsts.join(mixed_buckets, "anchor"), same).filter(order == F.col("first"))
    listed = scratch.table(leaders.groupBy("d", "h").agg(
        F.collect_list(F.struct("anchor", "c", "at", "size")).alias("listed")), "listed")
    packed = rows.join(listed, ["d", "h"]).select("d", "h", "text", "listed").mapInArrow(_packed(kind), _PACKED)
    within = scratch.table(packed.filter(F.col("c") <= large)
                           .repartition("anchor").sortWithinPartitions("anchor")
                           .mapInArrow(_by_bucket(kind, finder), _SPANS), "within")
    single = packed.filter(F.col("c") > large).mapInArrow(
        _windows(kind), "digest binary, d long, h long, at long")
    if listed.filter(F.exists("listed", lambda x: x["c"] > large)).limit(1).count():
        single = scratch.table(single, "windows")
        earliest = single.groupBy("digest").agg(F.min(order).alias("first"))
        beyond = single.join(earliest, "digest").filter(order > F.col("first")).select(
            "d", "h", F.col("at").alias("s"), (F.col("at") + kind.window).alias("e"))
        within = within.unionByName(beyond)
    return texts_marked.drop("anchors"), later.unionByName(within)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _without(kind: Kind):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for d, h, text, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                     text_bytes(batch.column(2)), batch.column(3).to_pylist()):
            gone = merged([(x["s"], x["e"]) for x in spans])
            body = text.split() if kind.words else text
            kept, last = [], 0
            for s, e in [*gone, (len(body), len(body))]:
                kept.append(body[last:s])
                last = e
            left = b" ".join([w for part in kept for w in part]) if kind.words else b"".join(kept)
            out.append((d, h, sum(e - s for s, e in gone), len(gone), hashlib.sha256(left).hexdigest()))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(kinds)],
                                          ["d", "h", "n_removed", "n_spans", "kept_sha256"])
    return over_batches(run)


def without_repeats(docs: DataFrame, kind: Kind, finder: Finder, id_col: str, text_col: str,
                    large: int = LARGE_BUCKET) -> DataFrame:
    """`doc_id, n, n_removed, n_spans, kept_sha256` of every row of `docs`."""
    with Scratch(docs.sparkSession) as scratch:
        rows = keyed(docs, id_col, text_col)
        texts, spans = repeated_spans(scratch, rows, kind, finder, large)
        by_text = spans.groupBy("d", "h").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
        cut = (rows.join(by_text, ["d", "h"]).mapInArrow(
            _without(kind), "d long, h long, n_removed long, n_spans long, kept_sha256 string")
            .dropDuplicates(["d", "h"]))
        whole = F.col("copied") & (F.col("n") >= kind.window)
        return scratch.result(texts.join(cut, ["d", "h"], "left").select(
            F.when(F.col("d") != NO_ID, F.col("d")).alias("doc_id"), "n",
            F.when(whole, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(whole, EMPTY_SHA).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256")))
