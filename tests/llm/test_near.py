from collections import Counter

import brute
import numpy as np
from edges import ROWS, corpus, edge_docs

from windflow.llm import near


def found(docs, **options):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
            for r in near.near_copies(docs, **options).collect()}


def test_corpus(spark, sf):
    docs, rows = corpus(spark, sf)
    assert found(docs) == brute.near_groups(rows)


def test_large_buckets_are_divided(spark, sf):
    docs, rows = corpus(spark, sf)
    assert found(docs, percent=60, large=1) == brute.near_groups(rows, 60)


def test_blocks_bring_each_pair_together_once(spark):
    component = {d: 0 if d < 150 else d // 2 for d in range(300)}
    rows = [(7, 3, d, c) for d, c in component.items()] + [(8, 3, d, d) for d in range(30)]
    parts = {}
    for r in near.blocks(spark.createDataFrame(rows, "bucket long, band int, doc_id long, component long"), 40).collect():
        parts.setdefault(r["bucket"], []).append((r["doc_id"], r["half"]))
    assert max(map(len, parts.values())) <= 80  # blocks are drawn by a hash
    met = Counter((min(a, b), max(a, b)) for part in parts.values() for k, (a, p) in enumerate(part)
                  for b, q in part[:k] if (p < 0 or p != q) and component[a] != component[b])
    assert met == Counter((a, b) for b in component for a in range(b) if component[a] != component[b])


def test_large_buckets_lose_no_pair(spark):
    draw = np.random.default_rng(5)
    rows = []
    for family in range(80):  # two that are linked, and one with a smaller id that is nearly so
        base = [f"f{family}w{i}" for i in range(200)]
        for k, changed in enumerate((7, 4, 4)):
            words = list(base)
            for at in draw.choice(200, changed, replace=False).tolist():
                words[at] = f"x{family}y{k}z{at}"
            rows.append((3 * family + k, " ".join(words)))
    assert found(edge_docs(spark, rows), percent=60, large=1) == found(edge_docs(spark, rows), percent=60)


def test_edges(spark):
    named = {d: t for d, t in ROWS if d is not None}
    got = near.near_copies(edge_docs(spark))
    rows = got.collect()
    assert len(rows) == len(ROWS)
    expected = brute.near_groups(sorted(named.items()))
    for r in rows:
        if r["doc_id"] is None:
            assert (r["component_id"], r["kept"]) == (None, True)
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == expected[r["doc_id"]]
    assert near.near_copies(edge_docs(spark, [])).collect() == []


def test_hub_joins_what_is_not_linked_directly(spark):
    base = [f"w{i}" for i in range(200)]
    rows = [(100, " ".join(base))]
    for k in range(30):  # each differs from the hub by little, from one another by twice that
        words = list(base)
        for j in range(3):
            words[5 + (6 * k + 2 * j) % 190] = f"x{k}y{j}"
        rows.append((k, " ".join(words)))
    expected = brute.near_groups(rows, 88)
    assert len({v[1] for v in expected.values()}) < 31
    assert found(edge_docs(spark, rows), percent=88) == expected


def test_chain(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(50 - k, " ".join(words[8 * k:8 * k + 200])) for k in range(20)]
    expected = brute.near_groups(rows)
    assert len({v[1] for v in expected.values()}) == 1
    assert found(edge_docs(spark, rows)) == expected


def test_pruning_keeps_similar_pairs():
    needed = near.least_matches(0.85)
    draws = np.random.default_rng(1).random((20_000, near.HASHES)) < 0.85
    left, right = np.zeros(draws.shape, np.uint32), (~draws).astype(np.uint32)
    assert len(near.surviving(left, right, needed)) >= 19_990
    unlike = (np.random.default_rng(2).random((2000, near.HASHES)) >= 0.4).astype(np.uint32)
    assert len(near.surviving(left[:2000], unlike, needed)) == 0


def test_long_words_that_differ_are_not_one(spark):
    one, other = brute.thue_morse(11)
    rows = [(1, " ".join([*"abcde", one, *"fghi", *"abcde", other, *"fghi"]))]
    assert found(edge_docs(spark, rows)) == brute.near_groups(rows)
