"""Near copies: MinHash bands propose pairs, sequential Bayesian tests prune them, sets confirm them.

Texts with the same words are one node from the start. A node's signature is cut into bands, and nodes
that agree in a band share a bucket. First each node is paired with its bucket's smallest, which joins
most of a large group at the cost of one pair a node. Buckets that still hold several components are then
searched inside a task for all pairs across components, and only the links found leave it. A
pair's signatures are compared batch by batch, and it is dropped once the posterior probability that it is
similar enough is below the chosen miss probability. What survives is confirmed on the full shingle sets.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windflow.llm.common import Scratch, Words, grams, over_batches, text_bytes, texts_of

SHINGLE = 5
# 24 bands of 5: a pair of similarity 0.85 shares no band with probability 8e-7.
BANDS, ROWS = 24, 5
HASHES = BANDS * ROWS
# Hashes compared before each look at the posterior, and the probability of pruning a pair wrongly.
BATCH, MISS = 24, 1e-6
# Nodes compared at once in a task; a larger bucket is cut into blocks, and pairs of blocks are compared.
LARGE_BUCKET = 4000
# Components in large buckets must fall by this share for another leader to be tried in them.
FALL = 0.1

_rng = np.random.default_rng(7)
_MULTIPLIERS = _rng.integers(1, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SIGNATURES = "doc_id long, n_shingles long, same binary, signature binary"
_SETS = "doc_id long, shingles array<long>"


def shingle_sets(texts: list[bytes], n: int = SHINGLE) -> list[np.ndarray]:
    """The distinct shingles of each text as 64-bit hashes; a shorter text is one shingle, an empty one none."""
    held = Words([t.lower() for t in texts])  # of bytes: A-Z only
    hashes = held.hashes()
    runs = grams(hashes, n)
    out = []
    for a, b in zip(held.first[:-1].tolist(), held.first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(runs[a:b - n + 1]))
        elif b > a:
            out.append(grams(np.concatenate([hashes[a:b], np.full(1, b - a, np.uint64)]), b - a + 1))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of `HASHES` minima for each set that is not empty."""
    filled = [s for s in sets if len(s)]
    if not filled:
        return np.zeros((0, HASHES), dtype=np.uint32)
    folded = np.concatenate(filled)
    folded = (folded ^ (folded >> np.uint64(32))).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in filled])[:-1]])
    out = np.empty((len(filled), HASHES), dtype=np.uint32)
    for k in range(HASHES):
        value = folded * _MULTIPLIERS[k]
        value ^= value >> np.uint32(15)
        out[:, k] = np.minimum.reduceat(value, starts)
    return out


def _sign(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = text_bytes(batch.column(1))
    sets = shingle_sets(texts)
    rows = iter(signatures(sets))
    signed = [next(rows).astype("<u4").tobytes() if len(s) else b"" for s in sets]
    same = [hashlib.blake2b(b" ".join(t.lower().split()), digest_size=16).digest() for t in texts]
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(same, pa.binary()),
         pa.array(signed, pa.binary())], ["doc_id", "n_shingles", "same", "signature"])


def _set_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = [s.view(np.int64) for s in shingle_sets(text_bytes(batch.column(1)))]
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))],
                                      ["doc_id", "shingles"])


def least_matches(similarity: float, miss: float = MISS, batch: int = BATCH) -> dict[int, int]:
    """After n hashes compared, how many must agree for a pair to stay.

    With a uniform prior, m agreements of n leave Beta(m + 1, n - m + 1); the probability that the
    similarity is at least t is that of at most m successes in n + 1 trials of probability t.
    """
    out = {}
    for n in range(batch, HASHES + 1, batch):
        below = 0.0
        for m in range(n + 1):
            below += math.comb(n + 1, m) * similarity ** m * (1 - similarity) ** (n + 1 - m)
            if below >= miss:
                out[n] = m
                break
    return out


def surviving(left: np.ndarray, right: np.ndarray, needed: dict[int, int]) -> np.ndarray:
    """Which rows of two signature tables stay, batch by batch."""
    alive, agreed, done = np.arange(len(left)), np.zeros(len(left), dtype=np.int64), 0
    for n, least in needed.items():
        agreed = agreed + (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
        stay = agreed >= least
        alive, agreed, done = alive[stay], agreed[stay], n
    return alive


def _table(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u4").reshape(-1, HASHES)


def _prune(needed: dict[int, int]):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                alive = surviving(_table(batch.column(2)), _table(batch.column(3)), needed)
                yield batch.select(["a", "b"]).take(pa.array(alive))
    return run


def _across(held: "_Bucket", needed: dict[int, int]):
    """For each node of a bucket the later ones of other components that the signatures do not rule out.

    A pair that shares several buckets is taken in that of the first band it agrees in.
    """
    for i in range(len(held.node) - 1):
        others = i + 1 + np.flatnonzero((held.component[i + 1:] != held.component[i])
                                        & ((held.half[i] < 0) | (held.half[i + 1:] != held.half[i])))
        if len(others):
            mine = held.signed[i]
            others = others[surviving(np.broadcast_to(mine, (len(others), HASHES)), held.signed[others], needed)]
            agree = (held.signed[others].reshape(-1, BANDS, ROWS) == mine.reshape(BANDS, ROWS)).all(axis=2)
            others = others[agree.argmax(axis=1) == held.band]
            if len(others):
                yield i, others


class _Bucket:
    def __init__(self, rows: list[tuple]):
        self.bucket, self.band = rows[0][0], rows[0][1]
        self.node = np.array([r[2] for r in rows], dtype=np.int64)
        self.component = np.array([r[3] for r in rows], dtype=np.int64)
        self.half = np.array([r[4] for r in rows], dtype=np.int64)  # -1: in one block
        self.signed = np.frombuffer(b"".join([r[5] for r in rows]), dtype="<u4").reshape(-1, HASHES)
        self.sets = [r[6] for r in rows] if len(rows[0]) > 6 else []


def _by_bucket(work):
    """`work` on each bucket of rows that come in the order of their bucket."""
    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:6]]
            if batch.num_columns > 6:
                lists = batch.column(6)
                columns.append(np.split(lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())[:-1]))
            for row in zip(*columns):
                if held and row[0] != held[0][0]:
                    yield work(_Bucket(held))
                    held = []
                held.append(row)
        if held:
            yield work(_Bucket(held))
    return run


def _unsettled(needed: dict[int, int]):
    """The rows of a bucket that are in some pair to be confirmed."""
    def work(held: _Bucket) -> pa.RecordBatch:
        open_ = np.zeros(len(held.node), dtype=bool)
        for i, others in _across(held, needed):
            open_[i] = True
            open_[others] = True
        n = int(open_.sum())
        return pa.RecordBatch.from_arrays(
            [pa.array([held.bucket] * n, pa.int64()), pa.array([held.band] * n, pa.int32()),
             pa.array(held.node[open_]), pa.array(held.component[open_]), pa.array(held.half[open_].astype(np.int32))],
            ["bucket", "band", "doc_id", "component", "half"])
    return _by_bucket(work)


def _linked(needed: dict[int, int], percent: int):
    """Links between the components of a bucket, found on the full sets; none between joined ones."""
    def work(held: _Bucket) -> pa.RecordBatch:
        above: dict[int, int] = {}

        def root(c: int) -> int:
            while c in above:
                c = above[c]
            return c

        found = []
        for i, others in _across(held, needed):
            for j in others.tolist():
                a, b = root(int(held.component[i])), root(int(held.component[j]))
                if a == b:
                    continue
                x, y = held.sets[i], held.sets[j]
                least = percent * (len(x) + len(y))  # both >= percent * (x + y - both) / 100
                if (100 + percent) * min(len(x), len(y)) < least:
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                if (100 + percent) * both >= least:
                    above[max(a, b)] = min(a, b)
                    found.append((int(held.node[i]), int(held.node[j])))
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()),
                                           pa.array([b for _, b in found], pa.int64())], ["a", "b"])
    return _by_bucket(work)


def components(scratch: Scratch, links: DataFrame, name: str) -> DataFrame:
    """`node, component` for the nodes of `links` (`a, b`): the smallest node reachable.

    Each step gives a node the smallest label among its neighbours' and then that label's own label, so
    long chains halve; it ends when no label changes.
    """
    edges = scratch.table(links.union(links.select("b", "a")).toDF("node", "other").distinct(), f"{name}-edges")
    labels = scratch.table(edges.groupBy("node").agg(F.min("other").alias("m")).select(
        "node", F.least("node", "m").alias("component")), f"{name}-0")
    step = 0
    while True:
        step += 1
        near = edges.join(labels.toDF("other", "seen"), "other").groupBy("node").agg(F.min("seen").alias("seen"))
        lower = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "seen").alias("hop"))
        jumped = lower.join(labels.toDF("hop", "far"), "hop", "left").select(
            "node", F.least("hop", F.coalesce("far", "hop")).alias("component"),
            "old")
        new = scratch.table(jumped, f"{name}-{step}")
        changed = new.filter("component <> old").limit(1).count()
        scratch.drop(f"{name}-{step - 1}")
        labels = new.select("node", "component")
        if not changed:
            return labels


def _sets_of(scratch: Scratch, docs: DataFrame, asked: DataFrame, name: str) -> DataFrame:
    return scratch.table(docs.join(asked, "doc_id", "left_semi").mapInArrow(over_batches(_set_rows), _SETS)
                         .filter(F.size("shingles") > 0), name)


def _confirmed(scratch: Scratch, nodes: DataFrame, docs: DataFrame, percent: int, pairs: DataFrame) -> DataFrame:
    """The pairs (`a, b`) that pass the signatures' tests and are linked by their full sets."""
    signed = nodes.select("doc_id", "signature")
    pairs = scratch.table(
        pairs.join(signed.toDF("a", "sa"), "a").join(signed.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")
        .mapInArrow(_prune(least_matches(percent / 100)), "a long, b long").distinct(), "pairs")
    sets = _sets_of(scratch, docs, pairs.select("a").union(pairs.select("b")).distinct().toDF("doc_id"), "pair-sets")
    both = F.size(F.array_intersect("x", "y"))
    either = F.size("x") + F.size("y") - both
    return (pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
            .filter(100 * both >= percent * either).select("a", "b"))


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that hold several components, with their component."""
    known = members.join(labels.toDF("doc_id", "known"), "doc_id", "left").withColumn(
        "component", F.coalesce("known", "doc_id")).drop("known")
    return _divided(known)


def _search(scratch: Scratch, nodes: DataFrame, docs: DataFrame, members: DataFrame, percent: int,
            large: int) -> DataFrame:
    """`node, component` of all nodes that have a link."""
    stars = members.filter("leader <> doc_id").select(
        F.col("leader").alias("a"), F.col("doc_id").alias("b")).distinct()
    links = scratch.table(_confirmed(scratch, nodes, docs, percent, stars), "star-links")
    labels = components(scratch, links, "stars")
    signed = nodes.select("doc_id", "signature")
    open_ = scratch.table(_labelled(members, labels), "open")
    left, turn = _crowd(open_, large), 0
    while left:
        turn += 1
        more = _confirmed(scratch, nodes, docs, percent, _led(open_, large, turn))
        links = scratch.table(links.union(more), f"star-links-{turn}")
        labels = components(scratch, links, f"stars-{turn}")
        open_ = scratch.table(_labelled(members, labels), f"open-{turn}")
        before, left = left, _crowd(open_, large)
        if left > (1 - FALL) * before:
            break
    columns = ["bucket", "band", "doc_id", "component", "half"]
    needed = least_matches(percent / 100)

    def sorted_rows(rows: DataFrame, *extra: str) -> DataFrame:
        return rows.select(*columns, "signature", *extra).repartition("bucket").sortWithinPartitions("bucket", "doc_id")

    in_parts = open_.withColumn("half", F.lit(-1))
    if left:
        sized = _sized(open_)
        in_parts = in_parts.join(sized.filter(F.col("n") <= large), "bucket", "left_semi").select(*columns).union(
            blocks(open_, large).select(*columns))
    rows = sorted_rows(in_parts.join(signed, "doc_id"))
    unsettled = scratch.table(rows.mapInArrow(
        _unsettled(needed), "bucket long, band int, doc_id long, component long, half int"), "unsettled")
    sets = _sets_of(scratch, docs, unsettled.select("doc_id").distinct(), "sets")
    complete = sorted_rows(unsettled.join(signed, "doc_id").join(sets, "doc_id"), "shingles")
    more = complete.mapInArrow(_linked(needed, percent), "a long, b long")
    return components(scratch, links.union(more), "all")


def _sized(open_: DataFrame) -> DataFrame:
    """`bucket, n, main, most`: the nodes of each bucket, and its component with the most of them."""
    return open_.groupBy("bucket", "component").agg(F.count("*").alias("c")).groupBy("bucket").agg(
        F.sum("c").alias("n"), F.count("*").alias("parts"), F.max(F.struct("c", "component")).alias("top")).select(
        "bucket", "n", "parts", F.col("top.component").alias("main"), F.col("top.c").alias("most"))


def _crowd(open_: DataFrame, large: int) -> int:
    """The components in buckets that are larger than `large`."""
    return _sized(open_).filter(F.col("n") > large).agg(F.sum("parts")).first()[0] or 0


def _led(open_: DataFrame, large: int, turn: int) -> DataFrame:
    """In each large bucket, pairs (`a, b`) of one node outside the main component with those of other components."""
    big = open_.join(_sized(open_).filter(F.col("n") > large), "bucket")
    drawn = F.struct(F.xxhash64("doc_id", F.lit(turn)), "doc_id", "component")
    lead = big.filter("component <> main").groupBy("bucket").agg(F.min(drawn).alias("lead"))
    return big.join(lead, "bucket").filter(F.col("component") != F.col("lead.component")).select(
        F.least("doc_id", "lead.doc_id").alias("a"), F.greatest("doc_id", "lead.doc_id").alias("b")).distinct()


def blocks(open_: DataFrame, large: int) -> DataFrame:
    """The members of buckets larger than `large`, once for each pair of blocks they are compared in.

    The main component (side 1) is not compared with itself. The rows of a pair of blocks share `bucket`, about
    `large` in number at most; `half` tells the blocks apart, -1 stands for a block with itself. Each pair of
    nodes from two components comes together exactly once.
    """
    half = max(1, large // 2)
    side = F.when(F.col("component") == F.col("main"), 1).otherwise(0)

    def cut(n):
        return F.greatest(F.lit(1), F.ceil(n / F.lit(half))).cast("int")
    big = open_.join(_sized(open_).filter(F.col("n") > large), "bucket").withColumn("side", side).withColumn(
        "few", cut(F.col("n") - F.col("most"))).withColumn("many", cut(F.col("most")))
    own = F.pmod(F.xxhash64("doc_id", F.lit("block")), F.when(F.col("side") == 1, F.col("many")).otherwise(F.col("few")))
    big = big.withColumn("own", own.cast("int"))
    met = F.explode(F.sequence(F.lit(0), F.col("last") - 1)).alias("other")
    keep = ["bucket", "band", "doc_id", "component", "side", "own"]
    among = big.filter("side = 0").withColumn("last", F.col("few")).select(*keep, met).select(
        *keep, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.lit(0).alias("with"),
        F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("half"))
    to_main = big.withColumn("last", F.when(F.col("side") == 1, F.col("few")).otherwise(F.col("many"))).select(
        *keep, met).select(
        *keep, F.when(F.col("side") == 1, F.col("other")).otherwise(F.col("own")).alias("i"),
        F.when(F.col("side") == 1, F.col("own")).otherwise(F.col("other")).alias("j"), F.lit(1).alias("with"),
        F.col("side").alias("half"))
    return among.union(to_main).withColumn("bucket", F.xxhash64("bucket", "i", "j", "with")).select(
        "bucket", "band", "doc_id", "component", F.col("half").cast("int").alias("half"))


def _divided(rows: DataFrame) -> DataFrame:
    several = rows.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter(
        "low <> high").select("bucket")
    return rows.join(several, "bucket", "left_semi").select("bucket", "band", "doc_id", "component")


def _by_bands(rows: DataFrame, *within: str) -> DataFrame:
    """Each row once for each band of its signature; `bucket` says which values of the band it has."""
    band = F.expr(f"substring(signature, band * {4 * ROWS} + 1, {4 * ROWS})")
    return rows.withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1)))).withColumn(
        "bucket", F.xxhash64(*within, "band", band))


def near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = 85,
                large: int = LARGE_BUCKET) -> DataFrame:
    """Groups of near copies: `doc_id, n_shingles, component_id, kept`, a row for each row of `docs`.

    Words are runs of other than ASCII white space, with A-Z lower-cased; a text's set holds its distinct
    runs of five, or the whole text if it is shorter, or nothing. Two texts are linked if the
    intersection of their sets has at least `percent` hundredths of the union's size; `component_id` is
    the smallest id that links reach, and a row is kept if that is its own. Texts without words are
    linked with nothing. Rows that repeat an id are one node and each gets its component. Rows without an id
    are linked with nothing, have no component and are kept. An empty table gives no row.
    """
    with Scratch(docs.sparkSession) as scratch:
        texts = texts_of(docs, id_col, text_col)
        signed = scratch.table(texts.mapInArrow(over_batches(_sign), _SIGNATURES), "signed")
        worded = signed.filter("doc_id is not null and n_shingles > 0")
        same = worded.groupBy("same").agg(F.min("doc_id").alias("node"))
        nodes = scratch.table(worded.join(same, "same").filter("doc_id = node").select(
            "doc_id", "signature").dropDuplicates(["doc_id", "signature"]), "nodes")
        banded = _by_bands(nodes).select("bucket", "band", "doc_id")
        shared = banded.groupBy("bucket").agg(F.min("doc_id").alias("leader"), F.count("*").alias("n")).filter(
            "n > 1").select("bucket", "leader")
        members = scratch.table(banded.join(shared, "bucket"), "members")
        labels = _search(scratch, nodes, texts, members, percent, large)
        # A text's words may belong to an id with several texts: then that id ties its texts together.
        rows = signed.join(same, "same", "left").withColumn("node", F.when(
            F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("node")).otherwise(F.col("doc_id")))
        rows = rows.join(labels, "node", "left")
        component = F.coalesce("component", "node")
        return scratch.result(rows.select(
            "doc_id", "n_shingles", component.alias("component_id"),
            F.when(F.col("doc_id").isNull(), True).otherwise(F.col("doc_id") == component).alias("kept")))
