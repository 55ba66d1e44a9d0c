"""Documents that try every corner, with columns whose names the operators use themselves."""

from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
PASSAGE = " ".join(f"pass{i}" for i in range(70))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away into the deep dark wood."),
    (2, "the quick brown fox jumps over the lazy dog and runs away into the deep dark wood."),
    (3, None), (4, ""), (5, "  \n\t "), (6, "one two"), (7, "one two"), (8, "One  two\n"),
    (9, LONG), (10, LONG), (11, "start " + PASSAGE + " end"), (12, "other " + PASSAGE + " tail " + PASSAGE),
    (13, "a" * 500), (14, "ab" * 300), (15, "été Été ÉTÉ 日本語 👍🏽 ﬁ İ"), (16, "\x00\x01 \x1c x"),
    (None, "text without an id"), (None, None), (None, "text without an id"),
    (17, "repeated row of words here"), (17, "repeated row of words here"), (18, "repeated row of words here"),
]
CLASHES = ("node component keep_id kept hash d h n at template rule bucket recipe same signature slots size id "
           "length number band runs k spans sha").split()


def edge_docs(spark, rows=ROWS):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("doc_id", "text", *[F.lit(None).cast("string").alias(c) for c in CLASHES],
                     F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))


def corpus(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
