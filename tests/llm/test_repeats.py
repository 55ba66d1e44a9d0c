from collections import Counter

import brute
import numpy as np
import pytest
from edges import ROWS, corpus, edge_docs

from windflow.llm import minimisers
from windflow.llm.common import Scratch
from windflow.llm.minimisers import Kind, fragments
from windflow.llm.substrings import same_windows, without_repeated_passages
from windflow.llm.suffixes import SuffixArray, intervals, repeat_groups, without_repeated_bytes

CASES = [(without_repeated_passages, brute.passages), (without_repeated_bytes, brute.byte_strings)]


def found(df):
    return Counter(tuple(r) for r in df.collect())


def expected(rows, plain):
    made = plain(rows)
    return Counter((d, *made[d, t]) for d, t in rows)


@pytest.mark.parametrize("operator, plain", CASES)
def test_corpus(spark, sf, operator, plain):
    docs, rows = corpus(spark, sf)
    assert found(operator(docs)) == expected(rows, plain)


@pytest.mark.parametrize("operator, plain", CASES)
def test_large_buckets_go_window_by_window(spark, sf, operator, plain):
    docs, rows = corpus(spark, sf)
    assert found(operator(docs, large=1)) == expected(rows, plain)


@pytest.mark.parametrize("operator, plain", CASES)
def test_edges(spark, operator, plain):
    assert found(operator(edge_docs(spark))) == expected(ROWS, plain)
    assert operator(edge_docs(spark, [])).collect() == []


@pytest.mark.parametrize("operator, plain", CASES)
def test_repeated_rows_count_once(spark, monkeypatch, operator, plain):
    passage = " ".join(f"pass{i}" for i in range(70))
    texts = [(None, f"one {passage} two")] * 40 + [(5, f"three {passage} four")] * 40 + [(6, f"five {passage} six")]
    sizes, table = {}, Scratch.table

    def counted(scratch, df, name):
        made = table(scratch, df, name)
        sizes[name] = made.count()
        return made
    monkeypatch.setattr(Scratch, "table", counted)
    assert found(operator(edge_docs(spark, texts))) == expected(texts, plain)
    once = sizes.copy()
    assert found(operator(edge_docs(spark, texts[39:41] + texts[-1:]))) == expected(texts[39:41] + texts[-1:], plain)
    assert {k: n for k, n in once.items() if k not in ("anchored", "repeated")} == {
        k: n for k, n in sizes.items() if k not in ("anchored", "repeated")}


@pytest.mark.parametrize("words", [True, False])
def test_stretches_hold_every_window_once(monkeypatch, words):
    kind = Kind(50, 5, True, ("d",)) if words else Kind(100, 16, False, ("d", "at"))
    text = kind.plain(" ".join(f"w{i * i % 1009}" for i in range(4000)).encode() + b" " + b"z" * 9000)

    def windows():
        out = []
        for _, (base,), layout in kind.laid_out([text]):
            for start, size, anchor in zip(*fragments(layout, kind.window, kind.gram)):
                out += [(base + start + i, anchor) for i in range(size - kind.window + 1)]
        return out
    whole = windows()
    monkeypatch.setattr(minimisers, "CHUNK_BYTES", 1000)
    assert windows() == whole
    assert [i for i, _ in whole] == list(range(len(whole)))


def test_equal_windows_have_equal_numbers():
    ids = np.random.default_rng(3).integers(0, 2, 400)
    numbers = same_windows(ids, 11)
    seen = {}
    for i, n in enumerate(numbers.tolist()):
        assert seen.setdefault(tuple(ids[i:i + 11]), n) == n
    assert len(set(seen.values())) == len(seen)


def test_suffix_array_and_its_groups():
    strings = [b"xabcabcabcz", b"yabcabcq", b"abcabcabc", b"\x00\x00abca"]
    array = SuffixArray(strings, 3)
    at = [(int(array.string[i]), int(array.place[i])) for i in array.order]
    suffixes = [strings[s][p:] for s, p in at]
    assert suffixes == sorted(suffixes) and len(at) == sum(len(s) - 2 for s in strings)
    for a, b, n in zip(suffixes, suffixes[1:], array.common[1:].tolist()):
        assert a[:n] == b[:n] and (len(a) == n or len(b) == n or a[n] != b[n])
    for length, positions in repeat_groups(array, 3):
        texts = {strings[array.string[i]][array.place[i]:array.place[i] + length] for i in positions}
        assert len(texts) == 1
        word = texts.pop()
        everywhere = sum(s.startswith(word, p) for s in strings for p in range(len(s)))
        assert len(positions) == everywhere
    assert list(intervals([0, 2, 5, 5, 2], 2)) == [(5, 1, 3), (2, 0, 4)]


def test_long_words_that_differ_are_not_one(spark):
    one, other = brute.thue_morse(11)
    same = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"{same} {one}"), (2, f"{same} {other}")]
    got = {r["doc_id"]: r["n_removed"] for r in without_repeated_passages(edge_docs(spark, rows)).collect()}
    assert got == {1: 0, 2: 60}
