import brute
import numpy as np
import pytest
from edges import ROWS, corpus, edge_docs

from windflow.llm import overlap
from windflow.llm.queries import QUERIES


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def plain(rows, percent=90):
    return {d: r[:2] for d, r in brute.near_groups(rows, percent, 3).items()}


def test_corpus(spark, sf):
    docs, rows = corpus(spark, sf)
    expected = plain(rows)
    assert found(QUERIES["op13_ngram_jaccard_join"](spark, sf)) == expected
    assert any(d != c for d, (_, c) in expected.items())


def families(draw, n, changed):
    """Texts of one family share a text of 300 words but for some changed words, drawn for each."""
    rows = []
    for family in range(3):
        base = [f"f{family}w{i}" for i in range(300)]
        for k in range(n):
            words = list(base)
            for at in draw.choice(300, changed[k % len(changed)], replace=False).tolist():
                words[at] = f"x{family}y{k}z{at}"
            rows.append((n * family + k, " ".join(words)))
    return rows


@pytest.mark.parametrize("percent,large", [(90, 500), (90, 2), (70, 3), (100, 1)])
def test_chains_and_large_lists(spark, percent, large):
    rows = families(np.random.default_rng(3), 25, (0, 2, 4, 6, 9))
    assert found(overlap.ngram_links(edge_docs(spark, rows), percent=percent, large=large)) == plain(rows, percent)


def test_common_grams_and_short_texts(spark):
    draw = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{k}" for k in draw.integers(0, 6, size=int(draw.integers(1, 14))))) for i in range(250)]
    for percent in (50, 90):
        assert found(overlap.ngram_links(edge_docs(spark, rows), percent=percent, large=20)) == plain(rows, percent)


def test_edges(spark):
    got = overlap.ngram_links(edge_docs(spark)).collect()
    assert len(got) == len(ROWS)
    expected = plain(sorted({d: t for d, t in ROWS if d is not None}.items()))
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]]


def test_an_id_with_two_texts_ties_them(spark):
    rows = [(5, "a b c d e f"), (5, "k l m n o p"), (2, "a b c d e f"), (9, "K l m n o p"), (7, "q r s")]
    assert {(r["doc_id"], r["component_id"]) for r in overlap.ngram_links(edge_docs(spark, rows)).collect()} == {
        (5, 2), (2, 2), (9, 2), (7, 7)}


def test_empty(spark):
    assert overlap.ngram_links(edge_docs(spark, [])).collect() == []
    assert found(overlap.ngram_links(edge_docs(spark, [(1, None), (2, " ")]))) == {1: (0, 1), 2: (0, 2)}


def test_divide_skip_counts_every_overlap():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 400, size=int(s))) for s in draw.integers(1, 300, size=60)]
    everything, owner = np.concatenate(sets), np.repeat(np.arange(60), [len(s) for s in sets])
    order = np.argsort(everything, kind="stable")
    grams, starts = np.unique(everything[order], return_index=True)
    starts = np.append(starts, len(everything))
    for i in range(60):
        for share in (0.05, 0.3, 0.8):
            least = np.maximum(1, (share * np.array([len(s) for s in sets])).astype(np.int64))
            wanted = np.arange(60) != i
            both = np.array([len(np.intersect1d(sets[i], s)) for s in sets])
            got = overlap.divide_skip(sets[i], wanted, least, grams, starts, owner[order])
            assert sorted(got.tolist()) == np.flatnonzero(wanted & (both >= least)).tolist()
