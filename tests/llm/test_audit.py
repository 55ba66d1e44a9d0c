from itertools import permutations

import brute
import pytest
from edges import ROWS, corpus, edge_docs
from pyspark.sql import functions as F

from windflow.llm import filter_audit
from windflow.llm.queries import ORACLE, QUERIES

COLUMNS = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def plain(docs, labels):
    """docs: (doc_id, text, part), labels: (doc_id, quality, toxic) -> {(part, order, step): figures}"""
    first, rows = {}, []
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    bad = {d for d, _, x in labels if x == 1 and d is not None}
    for d, t, part in docs:
        text, words = t or "", brute.words(t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
                 "D": any(c in "#$%&*|" for c in text), "E": d is not None and first[text] < d}
        rows.append((part or "", {f for f in fails if fails[f]}, d in good, d in bad))
    out = {}
    for part in {r[0] for r in rows}:
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                mine = [r for r in rows if r[0] == part and f in r[1]]
                total[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(mine) - len(gone), sum(r[1] == {f} for r in mine),
                    sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, step), figures in out.items():
            if p == part:
                figures.append(total[order[step - 1]])
    return out


def figures(df):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COLUMNS] for r in df.collect()}


def test_corpus_against_plain_version_and_sql(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = figures(QUERIES["op12_filter_interaction_audit"](spark, sf))
    assert got == plain([tuple(r) for r in docs.select("doc_id", "text", "source").collect()],
                        [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    theirs = con.sql(ORACLE["op12_filter_interaction_audit"]).df()
    assert {(r.part, r.filter_order, r.step): [getattr(r, c) for c in COLUMNS] for r in theirs.itertuples()} == got


def test_edges(spark):
    texts = ROWS + [(30, "A" * 50), (31, "# x"), (32, "# x"), (29, "# x")]
    docs = edge_docs(spark, texts).withColumn(
        "source", F.when(F.col("doc_id") % 3 == 0, None).when(F.col("doc_id") % 3 == 1, "s").otherwise("t"))
    labels = spark.createDataFrame([(1, 1, 0, "x"), (1, 0, None, "y"), (17, 1, 1, "z"), (None, 1, 1, "n"), (31, None, 1, "")],
                                   "doc_id long, quality int, toxic int, text string")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    assert figures(filter_audit.document_audit(docs, labels)) == plain(
        rows, [tuple(r)[:3] for r in labels.collect()])


def test_empty_tables(spark):
    empty, labels = edge_docs(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.document_audit(empty, labels).collect() == []
    assert len(figures(filter_audit.document_audit(edge_docs(spark), labels))) == 600


def test_other_filters(spark):
    rows = spark.createDataFrame([("p", True, False), ("p", True, None), ("p", False, True), (None, False, False)],
                                 "part string, long_ boolean, odd boolean")
    got = {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["shapley"])
           for r in filter_audit.audit(rows, ["long_", "odd"], {}).collect()}
    assert got[("p", "long_odd", 1)] == (1, 2, 4) and got[("p", "long_odd", 2)] == (0, 1, 2)
    assert got[("", "oddlong_", 2)] == (1, 0, 0) and len(got) == 8
    with pytest.raises(ValueError):
        filter_audit.audit(rows, list("abcdefgh"), {})
