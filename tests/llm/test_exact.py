import hashlib
from collections import Counter, defaultdict

from edges import ROWS, corpus, edge_docs

from windflow.llm.exact import LONGEST, WHITE_SPACE, cuts, exact_copies, verified_recipes


def plain(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[(t or "").encode().translate(None, WHITE_SPACE)].append((d, len(t or "")))
    out = Counter()
    for d, t in rows:
        bare = (t or "").encode().translate(None, WHITE_SPACE)
        named = [(-n, e) for e, n in groups[bare] if e is not None]
        keep = min(named)[1] if named else None
        out[d, keep, len(groups[bare]), keep is None or d == keep, hashlib.sha256(bare).hexdigest()] += 1
    return out


def found(docs):
    return Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"])
                   for r in exact_copies(docs).collect())


def test_corpus(spark, sf):
    docs, rows = corpus(spark, sf)
    assert found(docs) == plain(rows)


def test_edges(spark):
    assert found(edge_docs(spark)) == plain(ROWS)
    assert exact_copies(edge_docs(spark, [])).collect() == []


def test_longest_original_stays_then_smallest_id(spark):
    rows = [(5, "a b"), (3, "ab"), (9, "a  b"), (4, "a  b")]
    assert {r["keep_id"] for r in exact_copies(edge_docs(spark, rows)).collect()} == {4}


def test_cuts_depend_on_content_only():
    body = bytes((i * i * 31 + i // 7) % 251 for i in range(60_000))
    ends = cuts(body)
    assert ends[-1] == len(body) and len(ends) > 3
    shifted = [e - 1000 for e in cuts(b"q" * 1000 + body)]
    assert set(ends[1:]) <= set(shifted)
    assert max(b - a for a, b in zip([0, *ends], ends)) <= LONGEST
    assert cuts(b"a" * 200_000)[0] == LONGEST and cuts(b"") == []


def test_ambiguous_identifiers_are_numbered_apart(spark):
    rows = [(1, 1, "x", 9, [7], [b"A"]), (2, 1, "y", 9, [7], [b"B"]), (3, 1, "x", 9, [7], [b"A"])]
    recipes = spark.createDataFrame(rows, "doc_id long, n_points long, text_sha256 string, n_bytes long, "
                                          "chunks array<long>, digests array<binary>")
    got = {r["doc_id"]: r["recipe"] for r in verified_recipes(recipes).collect()}
    assert got[1] == got[3] != got[2]
