import brute
import corpus_pipeline as pipeline
from edges import ROWS, edge_docs

from windflow.llm import exact, language, templates


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, rows = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}

    def step(k, before):
        after = pipeline.STAGES[k][1](spark, before, sf)
        assert after.columns == columns
        return after

    told = step(0, docs)
    rejected = language.predict(docs, language.learn(docs)).filter("rejected")
    assert ids(told) == sorted(set(rows) - set(ids(rejected)))
    single = step(1, told)
    best = {}
    for d in ids(told):
        bare = "".join(brute.words(rows[d]))
        key = (-len(rows[d]), d)
        best[bare] = min(best.get(bare, key), key)
    assert ids(single) == sorted(d for _, d in best.values())
    apart = step(2, single)
    groups = brute.near_groups([(d, rows[d]) for d in ids(single)], pipeline.NEAR_PERCENT)
    assert ids(apart) == sorted(d for d, g in groups.items() if g[2])
    clean = step(3, apart)
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    leaks = {r["doc_id"] for r in templates.contaminated(apart, benchmark).collect()}
    assert leaks and ids(clean) == sorted(set(ids(apart)) - leaks)
    placed = pipeline.run(spark, sf)
    assert sorted({r["doc_id"] for r in placed.collect()}) == ids(clean)
    assert ids(exact.exact_copies(clean).filter("not kept")) == []


def test_edges(spark, sf):
    docs = edge_docs(spark)
    for _, stage in pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf)
        assert after.columns == docs.columns and after.count() <= docs.count() <= len(ROWS)
        assert stage(spark, docs.limit(0), sf).count() == 0
    assert pipeline.STAGES[-1][1](spark, docs, sf).count() >= len(ROWS)
