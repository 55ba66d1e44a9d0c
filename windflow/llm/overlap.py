"""Jaccard join of texts by their n-grams: T-occurrence search over inverted lists.

Texts with one set of grams are one node. A node with n grams shares at least T = ceil(n * percent / 100) of them with
any partner, so it meets each in the list of one of its first n - T + 1 grams, in whatever order all nodes put their
grams. The order is: grams whose hash falls into the first quarter, rare ones first, then the others by hash.
Only that quarter is counted and moved, and of it only grams that several nodes have.

Inside a task, the nodes that meet in a list are searched by DivideSkip: of the inverted lists of a node's grams the L longest
are set aside, the short ones are merged by a heap, nodes that occur there T - L times or more are probed for in the
long lists by binary search, and those that reach the overlap their sizes ask for are retained. First each node is
searched among the followers of its list's smallest node, which joins most of a large group with a row a node;
then only lists that still hold several components are searched, each pair in the first list it shares.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windflow.llm.common import Scratch, over_batches, text_bytes, texts_of
from windflow.llm.near import blocks, components, shingle_sets

GRAM = 3
# Grams with a smaller hash are counted and put in order by how many nodes have them.
COUNTED = 1 << 62
# Nodes searched together; a larger list is cut into blocks, and pairs of blocks are searched.
LARGE = 500
# The cost of merging against that of probing: L = T / (MU * log2(longest list) + 1) lists are probed.
MU = 0.0085


def first_grams(n: int, percent: int) -> int:
    """How many of its first grams a set of `n` needs to meet every partner."""
    return n + 1 - max(1, -(-percent * n // 100))


def _number(grams: np.ndarray) -> int | None:
    """The node of a set: 64 bits of a digest of all its grams."""
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True) if len(
        grams) else None


def _sign(percent: int):
    """Each row's set: its node, size, how many of its grams are counted, and the grams it is looked for by."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(text_bytes(batch.column(1)), GRAM)
        counted = [int(np.searchsorted(s, np.uint64(COUNTED))) for s in sets]
        first = [s[:max(c, first_grams(len(s), percent))].view(np.int64) for s, c in zip(sets, counted)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([_number(s) for s in sets], pa.int64()),
             pa.array([len(s) for s in sets], pa.int64()), pa.array(counted, pa.int64()),
             pa.array(first, pa.list_(pa.int64()))], ["doc_id", "node", "n", "counted", "grams"])
    return work


def _set_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = shingle_sets(text_bytes(batch.column(1)), GRAM)
    return pa.RecordBatch.from_arrays(
        [pa.array([_number(s) for s in sets], pa.int64()),
         pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "grams"])


def divide_skip(query: np.ndarray, wanted: np.ndarray, least: np.ndarray, grams: np.ndarray, starts: np.ndarray,
                owners: np.ndarray) -> np.ndarray:
    """The members j with wanted[j] that share at least least[j] grams with the query.

    `grams` are the distinct grams of all members in order; the list of the k-th is owners[starts[k]:starts[k + 1]],
    ascending.
    """
    known = np.searchsorted(grams, query)
    known = known[(known < len(grams)) & (grams[np.minimum(known, len(grams) - 1)] == query)]
    lists = [owners[a:b] for a, b in zip(starts[known].tolist(), starts[known + 1].tolist())]
    lists = [kept for kept in (one[wanted[one]] for one in lists) if len(kept)]
    lowest = int(least[wanted].min())
    if len(lists) < lowest:
        return np.zeros(0, dtype=np.int64)
    lists.sort(key=len)
    longest = len(lists[-1])
    aside = min(lowest - 1, int(lowest / (MU * math.log2(longest) + 1)))
    short, long_ = lists[:len(lists) - aside], lists[len(lists) - aside:]
    found, times = [], []
    for owner, run in groupby(heapq.merge(*[one.tolist() for one in short])):
        n = sum(1 for _ in run)
        if n >= lowest - aside:
            found.append(owner)
            times.append(n)
    left, n = np.array(found, dtype=np.int64), np.array(times, dtype=np.int64)
    for k, one in enumerate(long_):
        if not len(left):
            break
        at = np.searchsorted(one, left)
        n = n + (one[np.minimum(at, len(one) - 1)] == left)
        able = n + (len(long_) - k - 1) >= least[left]
        if not able.all():
            left, n = left[able], n[able]
    return left[n >= least[left]]


def _groups(rows_of):
    """`rows_of` (a list of rows with one first column) for rows that come in that column's order."""
    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(_cells(c) for c in batch.columns)):
                if held and row[0] != held[0][0]:
                    yield rows_of(held)
                    held = []
                held.append(row)
        if held:
            yield rows_of(held)
    return run


def _cells(column: pa.Array) -> list:
    if pa.types.is_list(column.type):
        return np.split(column.flatten().to_numpy(), np.cumsum(column.value_lengths().to_numpy())[:-1])
    return column.to_pylist()


def _searched(percent: int):
    """Links between the components of a group (`bucket, half, node, component, grams`)."""
    def work(rows: list[tuple]) -> pa.RecordBatch:
        half = np.array([r[1] for r in rows])
        node = np.array([r[2] for r in rows], dtype=np.int64)
        component = np.array([r[3] for r in rows], dtype=np.int64)
        size = np.array([len(r[4]) for r in rows], dtype=np.int64)
        everything = np.concatenate([r[4] for r in rows])
        owner = np.repeat(np.arange(len(rows)), size)
        order = np.argsort(everything, kind="stable")
        owners = owner[order]
        grams, starts = np.unique(everything[order], return_index=True)
        starts = np.append(starts, len(owners))
        found = []
        for i in range(len(rows) - 1):
            wanted = (component != component[i]) & ((half != half[i]) | (half[i] < 0)) & (
                100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i]))
            wanted[:i + 1] = False
            if not wanted.any():
                continue
            least = -(-percent * (size + size[i]) // (100 + percent))
            for j in divide_skip(rows[i][4], wanted, least, grams, starts, owners).tolist():
                if component[j] != component[i]:
                    found.append((int(node[i]), int(node[j])))
                    component[component == component[j]] = component[i]
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()),
                                           pa.array([b for _, b in found], pa.int64())], ["a", "b"])
    return _groups(work)


def _unsettled(percent: int):
    """The rows of a group (`bucket, half, node, component, gram, n, place, lists`) that some pair to be searched holds.

    A pair is searched where the first list is that both are in; then no more than what follows in either is shared.
    """
    def work(rows: list[tuple]) -> pa.RecordBatch:
        half = np.array([r[1] for r in rows])
        component = np.array([r[3] for r in rows], dtype=np.int64)
        size = np.array([r[5] for r in rows], dtype=np.int64)
        rest = size - np.array([r[6] for r in rows], dtype=np.int64)
        gram, sets = rows[0][4], [None] * len(rows)
        open_ = np.zeros(len(rows), dtype=bool)
        for i in range(len(rows) - 1):
            others = i + 1 + np.flatnonzero(
                (component[i + 1:] != component[i]) & ((half[i + 1:] != half[i]) | (half[i] < 0))
                & ((100 + percent) * np.minimum(rest[i + 1:], rest[i]) >= percent * (size[i + 1:] + size[i])))
            mine = rows[i][7].tolist()
            for j in others.tolist():
                if sets[j] is None:
                    sets[j] = frozenset(rows[j][7].tolist())
                if next(g for g in mine if g in sets[j]) == gram:
                    open_[i] = open_[j] = True
        kept = [r for r, o in zip(rows, open_) if o]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in kept], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
            ["bucket", "half", "node", "component"])
    return _groups(work)


def _in_groups(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select(*columns).repartition("bucket").sortWithinPartitions("bucket", "half", "node")


class _Search:
    """The steps over one table of nodes (`node, rep, n, counted, grams`) and the texts they stand for."""

    def __init__(self, scratch: Scratch, nodes: DataFrame, texts: DataFrame, percent: int, large: int):
        self.scratch, self.nodes, self.texts, self.percent, self.large = scratch, nodes, texts, percent, large

    def sets(self, asked: DataFrame) -> DataFrame:
        """`node, grams` with the whole sets of the asked nodes, read from the texts of their smallest ids."""
        ids = self.nodes.join(asked, "node", "left_semi").select(F.col("rep").alias("doc_id")).distinct()
        return self.texts.join(ids, "doc_id", "left_semi").mapInArrow(
            over_batches(_set_rows), "node long, grams array<long>").filter("node is not null").groupBy("node").agg(
            F.first("grams").alias("grams"))

    def members(self) -> DataFrame:
        """`gram, node, n, place`: who is in the list of each gram that several nodes have among their first."""
        postings = self.nodes.select(F.explode("grams").alias("gram"), "node")
        shared = postings.groupBy("gram").agg(F.count("*").alias("df")).filter("df > 1")
        early = F.col("gram").between(0, COUNTED - 1)
        rows = postings.join(shared, "gram").withColumn("early", early).join(
            self.nodes.select("node", "n", "counted"), "node")
        mine = Window.partitionBy("node")
        in_order = mine.orderBy(F.col("early").desc(), F.when(F.col("early"), F.col("df")).otherwise(0), "gram")
        # Grams of the first quarter that no other node has come before all others.
        rows = rows.withColumn("rank", F.row_number().over(in_order) - 1).withColumn(
            "place", F.col("rank") + F.col("counted") - F.sum(F.col("early").cast("int")).over(mine))
        first = F.col("n") + 1 - F.greatest(F.lit(1), F.ceil(F.lit(self.percent) * F.col("n") / 100))
        kept = self.scratch.table(rows.filter(F.col("place") < first).select("gram", "node", "n", "place"), "first")
        lists = kept.groupBy("gram").agg(F.count("*").alias("c"), F.min(F.struct("node", "n")).alias("lead")).filter("c > 1")
        return self.scratch.table(kept.join(lists, "gram").select(
            "gram", "node", "n", "place", F.col("lead.node").alias("lead"), F.col("lead.n").alias("lead_n")), "members")

    def links(self, groups: DataFrame, name: str) -> DataFrame:
        """Links that the search finds in `groups` (`bucket, half, node, component`)."""
        sets = self.sets(groups.select("node").distinct())
        rows = _in_groups(groups.join(sets, "node"), "bucket", "half", "node", "component", "grams")
        return self.scratch.table(rows.mapInArrow(_searched(self.percent), "a long, b long"), name)

    def followers(self, members: DataFrame) -> DataFrame:
        """Each node with the smallest of its lists, in groups of about `large`; the leader has half 0."""
        least, most = F.least("n", "lead_n"), F.greatest("n", "lead_n")
        pairs = members.filter((F.col("node") != F.col("lead")) & (100 * least >= self.percent * most)).select(
            "lead", "node").distinct()
        parts = pairs.groupBy("lead").agg(F.ceil(F.count("*") / self.large).alias("parts"))
        dealt = self.scratch.table(pairs.join(parts, "lead").select(
            F.xxhash64("lead", F.pmod(F.xxhash64("node"), F.col("parts"))).alias("bucket"), "lead", "node"), "dealt")
        return dealt.select("bucket", F.lit(1).alias("half"), "node", F.col("node").alias("component")).union(
            dealt.select("bucket", F.lit(0), F.col("lead"), F.col("lead")).distinct())

    def unsettled(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        known = members.join(labels, "node", "left").select(
            "gram", "node", "n", "place", F.coalesce("component", "node").alias("component"))
        several = known.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                            F.count("*").alias("c")).filter("low <> high").select("gram", "c")
        open_ = self.scratch.table(known.join(several, "gram"), "open")
        lists = open_.groupBy("node").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "gram"))),
                                                      lambda x: x["gram"]).alias("lists"))
        small = open_.filter(F.col("c") <= self.large).select(
            F.col("gram").alias("bucket"), F.lit(-1).alias("half"), "node", "component", "gram")
        cut = blocks(open_.filter(F.col("c") > self.large).select(
            F.col("gram").alias("bucket"), F.col("gram").alias("band"), F.col("node").alias("doc_id"), "component"),
            self.large).select("bucket", "half", F.col("doc_id").alias("node"), "component", F.col("band").alias("gram"))
        rows = small.union(cut).join(open_.select("gram", "node", "n", "place"), ["gram", "node"]).join(lists, "node")
        return self.scratch.table(
            _in_groups(rows, "bucket", "half", "node", "component", "gram", "n", "place", "lists")
            .mapInArrow(_unsettled(self.percent), "bucket long, half int, node long, component long"), "unsettled")


def ngram_links(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = 90,
                large: int = LARGE) -> DataFrame:
    """Components of texts that share most of their runs of three words: `doc_id, n_shingles, component_id`.

    Words are runs of other than ASCII white space, with A-Z lower-cased; a text's set holds its distinct runs of three,
    or the whole text if it is shorter, or nothing. Two texts are linked if the intersection of their sets has at
    least `percent` hundredths of the union's size; `component_id` is the smallest id that links reach. There is a
    row for each row of `docs`. Texts without words are linked with nothing, nor are rows without an id, which have no
    component. Rows that repeat an id get one component, and tie their texts together. An empty table gives no row.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be from 1 to 100")
    with Scratch(docs.sparkSession) as scratch:
        texts = texts_of(docs, id_col, text_col)
        signed = scratch.table(texts.mapInArrow(
            over_batches(_sign(percent)), "doc_id long, node long, n long, counted long, grams array<long>"), "signed")
        worded = signed.filter("doc_id is not null and node is not null")
        nodes = scratch.table(worded.groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"),
                                                         F.first("counted").alias("counted"),
                                                         F.first("grams").alias("grams")), "nodes")
        search = _Search(scratch, nodes, texts, percent, large)
        members = search.members()
        led = search.links(search.followers(members), "led")
        labels = components(scratch, led, "led-labels").toDF("node", "component")
        rest = search.links(search.unsettled(members, labels), "rest")
        tied = worded.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("high"),
                                            F.collect_set("node").alias("all")).filter("a <> high").select(
            "a", F.explode("all").alias("b")).filter("a <> b")
        labels = components(scratch, led.union(rest).union(tied), "labels").toDF("node", "root")
        rooted = scratch.table(nodes.join(labels, "node", "left").select(
            "node", "rep", F.coalesce("root", "node").alias("root")), "rooted")
        smallest = rooted.groupBy("root").agg(F.min("rep").alias("component"))
        named = rooted.join(smallest, "root").select("node", "component")
        told = worded.join(named, "node").select("doc_id", F.col("n").alias("n_shingles"),
                                                 F.col("component").alias("component_id"))
        plain = signed.filter("doc_id is null or node is null").select(
            "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
        return scratch.result(told.union(plain))
