import re
from collections import Counter

import pytest
from edges import ROWS, edge_docs
from pyspark.sql import functions as F

from windflow.llm import phrases
from windflow.llm.common import Scratch


def plain_counts(docs):
    """{lang: (n, {words: occurrences})} of (text, lang)"""
    found, n = {}, Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        mine = found.setdefault(lang, Counter())
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                mine.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return {lang: (n[lang], found[lang]) for lang in found}


def plain(docs, least=30, most=2000):
    out = []
    for lang, (n, f) in plain_counts(docs).items():
        many = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows, around = [], {}
        for q, b in many.items():
            for k in range(2, len(q)):
                for i in range(len(q) - k + 1):
                    around[q[i:i + k]] = max(b, around.get(q[i:i + k], 0))
        for p, a in many.items():
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            if 100 * around.get(p, 0) < 80 * a:
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:most], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in "lang rank phrase a l r n score".split()) for r in df.collect())


def rows_of(docs):
    return [tuple(r) for r in docs.select("text", "lang").collect()]


@pytest.mark.parametrize("shards,slots", [(1, 1 << 24), (4, 1 << 15)])
def test_corpus(spark, sf, shards, slots):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    least = 12
    got = found(phrases.phrase_collocations(docs, least=least, shards=shards, slots=slots))
    assert got == plain(rows_of(docs), least)
    assert any(len(r[2].split(" ")) > 2 for r in got)


def test_counts_are_exact_where_marks_collide(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    expected = {(lang, " ".join(p)): a for lang, (_, f) in plain_counts(rows_of(docs)).items()
                for p, a in f.items() if a >= 5}
    with Scratch(spark) as scratch:
        got = phrases.frequent(scratch, docs, least=5, shards=2, slots=1 << 15).filter("words > 0").collect()
    assert {(r["lang"], r["phrase"]): r["n"] for r in got} == expected and len(got) == len(expected)


def test_edges(spark):
    texts = [t for _, t in ROWS] + ["a b a b a b a", "A\tb,a b. a b\x0ba b c c c c c", "c c c c", " , . ;", "x\x1cy x\x1cy"]
    docs = edge_docs(spark, [(i, t) for i, t in enumerate(texts)]).withColumn(
        "lang", F.when(F.col("doc_id") % 4 == 0, None).when(F.col("doc_id") % 4 == 1, "").otherwise("zz"))
    for least, most in ((2, 5), (1, 100_000)):
        got = found(phrases.phrase_collocations(docs.drop("n"), least=least, most=most, shards=2))
        assert got == plain(rows_of(docs),
                            least, most)


def test_empty(spark):
    assert phrases.phrase_collocations(edge_docs(spark, [])).collect() == []
    assert phrases.phrase_collocations(edge_docs(spark, [(1, None), (2, "")])).collect() == []


def test_long_texts_are_cut_at_breaks():
    text = b"one two. three four, five six seven\neight"
    parts = list(phrases.chunks([text, b"NINE"], most=10))
    assert b"".join(parts).replace(b"\n", b"").replace(b" ", b"") == b"onetwothreefourfivesixseveneightnine"
    assert [p.split(b"\n")[0] for p in parts][0] == b"one two"


def test_large_counts_are_exact(spark):
    huge = 9_000_000_000_000_000_000
    counts = spark.createDataFrame(
        [("en", "", 0, huge), ("en", "a", 1, huge - 1), ("en", "b", 1, huge - 3), ("en", "a b", 2, huge - 5),
         ("en", "c", 1, huge), ("en", "a b c", 3, huge // 10 * 7), ("en", "b c", 2, huge // 10 * 7)],
        "lang string, phrase string, words int, n long")
    got = {r["phrase"]: r["score"] for r in phrases.collocations(counts).collect()}
    a = huge // 10 * 7
    assert got == {"a b": 2000000 * (huge - 5) // (2 * huge - 4),
                   "a b c": min(2000000 * a // (huge - 1 + a), 2000000 * a // (huge - 5 + huge))}
