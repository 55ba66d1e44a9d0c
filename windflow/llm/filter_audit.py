"""What each filter of a set removes in every order the filters can be applied in.

The sets of filters already applied form a lattice; applying one more is an edge, and an order is a path from the
empty set to the full one. What is left in a state and what an edge removes depend on the documents only through the
set of filters each fails, so one histogram of these sets per part answers every order. Paths are counted from both
ends: the orders through an edge are those that reach its start times those that leave its end. The removals of a
filter's edges, weighted so, add up to its removals over all orders (its Shapley value times the number of orders).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windflow.llm.common import Scratch

# More filters have too many orders to list.
MOST_FILTERS = 7


def text_filters(text: Column) -> dict[str, Column]:
    """The text conditions under which a document fails: A few words, B few distinct words, C many capitals, D symbols."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n_words = F.size(words)
    return {
        "A": n_words < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * n_words,
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") > 2 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def failures(scratch: Scratch, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             part_col: str = "source") -> DataFrame:
    """`doc_id`, `part` and for each of the filters A to E whether the row fails it.

    E is failed by rows whose text a smaller id has as well, anywhere in the table. A null text is empty, a null part
    is the empty string. A row without an id fails no E and makes no other row fail it.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    judged = scratch.table(rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("sha"),
                                       *[test.alias(name) for name, test in text_filters(F.col("text")).items()]),
                           "judged")
    # The first id of each text: groups of copies are combined on the map side, and no join is on the text alone.
    known = judged.filter("doc_id is not null")
    first = known.groupBy("sha").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    told = known.join(first, ["sha", "doc_id"], "left").withColumn("E", F.col("first").isNull())
    return told.drop("sha", "first").unionByName(
        judged.filter("doc_id is null").drop("sha").withColumn("E", F.lit(False)))


def _paths(n: int) -> tuple[list[int], list[int]]:
    """For each state of the lattice, the number of ways from the empty set to it and from it to the full set."""
    size = 1 << n
    reaching, leaving = [0] * size, [0] * size
    reaching[0] = leaving[size - 1] = 1
    for state in range(1, size):
        reaching[state] = sum(reaching[state ^ (1 << f)] for f in range(n) if state >> f & 1)
    for state in range(size - 2, -1, -1):
        leaving[state] = sum(leaving[state | 1 << f] for f in range(n) if not state >> f & 1)
    return reaching, leaving


def _edges(spark, n: int) -> DataFrame:
    """`state, filter, next, orders`: the edges of the lattice with the number of orders that pass them."""
    reaching, leaving = _paths(n)
    return spark.createDataFrame(
        [(state, f, state | 1 << f, reaching[state] * leaving[state | 1 << f])
         for state in range(1 << n) for f in range(n) if not state >> f & 1],
        "state int, filter int, next int, orders long")


def _steps(spark, names: Sequence[str]) -> DataFrame:
    """`filter_order, step, state, filter`: the edge that each order takes at each step."""
    rows = []
    for order in permutations(range(len(names))):
        state, label = 0, "".join(names[f] for f in order)
        for step, f in enumerate(order, 1):
            rows.append((label, step, state, f))
            state |= 1 << f
    return spark.createDataFrame(rows, "filter_order string, step int, state int, filter int")


def audit(rows: DataFrame, filters: Sequence[str], measures: Mapping[str, Column], *,
          part_col: str = "part") -> DataFrame:
    """Per part, order of the filters and step: what is kept and what the step removes.

    `rows` has a boolean column for each name in `filters` (true: the row fails it; null counts as false); `measures`
    maps names to conditions on rows whose removal is counted apart. Gives `part, filter_order` (the names in order,
    joined), `step` (from 1), `kept`, `removed`, `redundant` (fail the filter, removed before), `unique_fails` (fail
    this filter only), a column for each measure, and `shapley`, the filter's removals summed over all orders. A null
    part is the empty string; repeated rows count as often as they occur; no rows give no rows.
    """
    n, spark = len(filters), rows.sparkSession
    if not 0 < n <= MOST_FILTERS:
        raise ValueError(f"from 1 to {MOST_FILTERS} filters can be audited, not {n}")
    every = (1 << n) - 1
    counts = ["n", *[f"n_{m}" for m in measures]]
    failed = sum((F.when(F.col(f), 1 << k).otherwise(0) for k, f in enumerate(filters)), F.lit(0))
    histogram = rows.select(
        F.coalesce(F.col(part_col), F.lit("")).alias("part"), failed.alias("failed"),
        *[F.when(test, 1).otherwise(0).alias(f"n_{m}") for m, test in measures.items()]
    ).groupBy("part", "failed").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in counts[1:]])
    # What is left in each state: the sets of failed filters that do not meet it.
    free = F.col("failed").bitwiseAND(F.col("state")) == 0
    left = histogram.withColumn("state", F.explode(F.sequence(F.lit(0), F.lit(every)))).groupBy("part", "state").agg(
        *[F.sum(F.when(free, F.col(c)).otherwise(0)).alias(c) for c in counts])
    edges = F.broadcast(_edges(spark, n))  # at most 448 rows
    after = left.select("part", F.col("state").alias("next"), *[F.col(c).alias(f"after_{c}") for c in counts])
    removals = left.join(edges, "state").join(after, ["part", "next"]).select(
        "part", "state", "filter", "next", "orders", F.col("after_n").alias("kept"),
        *[(F.col(c) - F.col(f"after_{c}")).alias("removed" if c == "n" else c[2:]) for c in counts])
    totals = removals.groupBy("part", "filter").agg(
        F.sum(F.col("orders") * F.col("removed")).alias("shapley"),
        F.sum(F.when(F.col("state") == 0, F.col("removed")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("next") == every, F.col("removed")).otherwise(0)).alias("unique_fails"))
    steps = F.broadcast(_steps(spark, filters))  # n * n! rows
    return removals.join(totals, ["part", "filter"]).join(steps, ["state", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", (F.col("fails") - F.col("removed")).alias("redundant"),
        "unique_fails", *measures, "shapley")


def document_audit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   part_col: str = "source") -> DataFrame:
    """`audit` of the filters A to E over `docs`, with `good_lost` and `toxic_lost` after `labels`.

    `labels` has `doc_id, quality, toxic`; where it repeats an id, one row that says 1 is enough. Documents without
    a label, or with a null one, are neither good nor toxic. Null and empty texts fail A alone (and E after a smaller
    id). Columns of other names are not looked at. An empty table gives no row.
    """
    with Scratch(docs.sparkSession) as scratch:
        rows = failures(scratch, docs, id_col=id_col, text_col=text_col, part_col=part_col)
        told = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
            F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
            F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad"))
        no = F.lit(False)
        labelled = rows.filter("doc_id is not null").join(told, "doc_id", "left").unionByName(
            rows.filter("doc_id is null").withColumns({"good": no, "bad": no}))
        return scratch.result(audit(labelled, "ABCDE", {
            "good_lost": F.col("good"), "toxic_lost": F.col("bad")}))


ORACLE = """
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (
    SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
l AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad FROM labels GROUP BY doc_id),
f AS (
    SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad,
           CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END
           + CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END
           + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN w.doc_id > first_id THEN 16 ELSE 0 END AS failed
    FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
h AS (
    SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (bad) AS b
    FROM f GROUP BY part, failed),
orders(filter_order, used, bit) AS (
    SELECT '', 0, 0
    UNION ALL
    SELECT filter_order || substr('ABCDE', k + 1, 1), used | (1 << k), 1 << k
    FROM orders, (SELECT unnest([0, 1, 2, 3, 4]) AS k) WHERE used & (1 << k) = 0),
steps AS (
    SELECT a.filter_order, length(p.filter_order) AS step, p.used - p.bit AS before, p.bit AS bit
    FROM orders a, orders p
    WHERE length(a.filter_order) = 5 AND p.filter_order <> '' AND starts_with(a.filter_order, p.filter_order)),
counted AS (
    SELECT part, filter_order, step, bit,
           sum(CASE WHEN failed & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN failed & before = 0 AND failed & bit > 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN failed & before > 0 AND failed & bit > 0 THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN failed = bit THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN failed & before = 0 AND failed & bit > 0 THEN g ELSE 0 END) AS good_lost,
           sum(CASE WHEN failed & before = 0 AND failed & bit > 0 THEN b ELSE 0 END) AS toxic_lost
    FROM h, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted"""
