import random
import sys
import unicodedata
import zlib

import pyarrow as pa
import pytest
from edges import ROWS, edge_docs
from pyspark.sql import functions as F

from windflow.llm import language, queries


@pytest.fixture(scope="module")
def learned(spark, sf):
    return language.learn(spark.read.parquet(f"{sf}/documents.parquet"))


def test_held_out_accuracy(spark, sf):
    got = queries.op7_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert held and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_edges(spark, learned):
    got = language.predict(edge_docs(spark), learned).collect()
    assert len(got) == len(ROWS)
    for r, (d, t) in zip(sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"])),
                         sorted(ROWS, key=lambda x: (x[0] is None, x[0]))):
        has_letter = any(c.isalpha() for c in t or "")
        if d is not None:
            assert (r["lang_pred"] == "und") == (not has_letter)
            assert r["lang_pred"] in {*learned, "und"}
    assert language.predict(edge_docs(spark, []), learned).collect() == []
    assert {r["lang_pred"] for r in language.predict(edge_docs(spark), {}).collect()} == {"und"}


def test_no_labels(spark):
    docs = edge_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    assert language.learn(docs) == {}


def test_rejected_rows_go(spark, learned):
    docs = edge_docs(spark)
    kept = language.accepted(docs, learned)
    assert kept.columns == docs.columns
    told = language.predict(docs, learned).filter("not rejected").count()
    assert kept.count() == told < len(ROWS)


def test_learning_leaves_test_rows_alone(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    changed = docs.withColumn("text", F.when(language.training_rows(docs), F.col("text")).otherwise("zzz"))
    assert language.learn(docs) == language.learn(changed)


def test_numerals_are_no_letters(spark, learned):
    docs = edge_docs(spark, [(1, "5²"), (2, "½ ¾"), (3, "Ⅷ"), (4, "٣"), (5, "½a"), (6, None), (7, "①②")])
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs, learned).collect()}
    assert {d for d, lang in got.items() if lang == "und"} == {1, 2, 3, 4, 6, 7}


def test_too_many_languages_are_an_error(spark, monkeypatch):
    docs = edge_docs(spark).withColumn("lang", F.col("doc_id").cast("string"))
    assert len(language.learn(docs)) > 2
    monkeypatch.setattr(language, "MOST_LANGUAGES", 2)
    with pytest.raises(ValueError, match="more than 2 languages"):
        language.learn(docs)


def test_margins_reject_noise_and_keep_documents(spark, sf, monkeypatch):
    monkeypatch.setattr(language, "ENOUGH", 10)
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    learned = language.learn(docs)
    least = language.margins(docs, learned)
    assert least and all(m >= language.LEAST_MARGIN for m in least.values())
    draw = random.Random(5)
    noise = [(-i, "".join(draw.choices("abcdefghijklmnopqrstuvwxyz    ", k=1500))) for i in range(1, 101)]
    told = language.predict(edge_docs(spark, noise), learned, least=least).filter("rejected").count()
    assert told >= 90
    held = docs.filter(~language.training_rows(docs)).filter("lang is not null")
    assert language.accepted(held, learned, least=least).count() >= 0.98 * held.count()
    assert language.margins(docs.limit(0), learned) == {}


def test_margins_leave_test_rows_and_learned_rows_alone(spark, sf, learned):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    changed = docs.withColumn("text", F.when(language.training_rows(docs), F.col("text")).otherwise("zzz"))
    assert language.margins(docs, learned) == language.margins(changed, learned)


def test_every_labelled_text_counts(spark, monkeypatch):
    """Words and margins come from all labelled rows, whole, however many there are."""
    rows = [(i, f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)} " + "again " * 400 + "z" * 5000 + " atlast")
            for i in range(2000)]
    docs = edge_docs(spark, rows).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "aa").otherwise("bb"))
    split = language._labelled(docs, "doc_id", "text", "lang")
    for lang, words in language.learn(docs).items():
        learned = split.filter(~F.col("is_left") & (F.col("lang") == lang)).collect()
        held = words.decode().split()
        assert {r["text"].split()[0] for r in learned} <= set(held)
        assert held[-2:] == ["z" * 2000, "again"] and set(held[-4:-2]) == {"z" * 1000, "atlast"}
        assert len(held) == len(set(held)) == len(learned) + 4
    seen = []
    monkeypatch.setattr(language, "_reached", lambda judged: seen.append(judged.count()) or {})
    monkeypatch.setattr(language, "LEFT", 0.9)
    language.margins(docs, {"aa": b"again "})
    assert seen[0] == language._labelled(docs, "doc_id", "text", "lang").filter("is_left and lang = 'aa'").count() > 600


def test_margin_reached_is_the_exact_percentile(spark):
    draw = random.Random(7)
    rows = [(b, draw.choice([0.0, 1.0, round(draw.random(), 2), draw.random() ** 3])) for b in (3, 4, 9) for _ in range(
        {3: 49, 4: 50, 9: 1234}[b])]
    frame = spark.createDataFrame(rows, "bits int, margin double").repartition(5)
    exact = {r["bits"]: r["low"] for r in frame.filter("bits <> 3").groupBy("bits").agg(
        F.percentile("margin", language.LOW).alias("low")).collect()}
    assert language._reached(frame) == pytest.approx(exact)
    assert language._reached(frame.limit(0)) == {}


def test_margins_judge_each_text_once(spark):
    docs = edge_docs(spark, [(i, f"some words {i}") for i in range(600)]).withColumn("lang", F.lit("aa"))
    left = language._labelled(docs, "doc_id", "text", "lang").filter("is_left").count()
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        read.add(1)
        return text

    assert language.margins(docs.withColumn("text", counted("text")), {"aa": b"some words "}) == {4: language.PART}
    assert read.value == left >= language.ENOUGH


def test_letters_of_every_character():
    """A character alone and between letters: letters stay, all else parts words."""
    for code in {*range(sys.maxunicode + 1)} - {*range(0xD800, 0xE000)}:
        for text in (chr(code), f"A{chr(code)}b"):
            plain = "".join([c if unicodedata.category(c)[0] == "L" else " " for c in text.lower()])
            assert language.letters(text) == " ".join(plain.split())


def test_words_are_counted_per_language():
    long = "x" * (2 * language.BLOCK + 1)
    rows = pa.RecordBatch.from_pydict({"lang": ["b", "a", "b", "b", "a"], "text": ["Und und, 5 und", "und", None, long, ""]})
    found = [r for made in language._count_words(iter([rows, rows])) for r in made.to_pylist()]
    assert sorted((r["lang"], r["word"], r["n"]) for r in found) == [
        ("a", "und", 2), ("b", "und", 6), ("b", "x", 2), ("b", "x" * language.BLOCK, 4)]
