"""Repeated byte strings, from the tree of common-prefix intervals of an enhanced suffix array."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from windflow.llm.minimisers import LARGE_BUCKET, Kind, without_repeats

# Shorter grams recur by chance in unrelated texts, and their buckets travel for nothing.
WINDOW, GRAM = 100, 28


class SuffixArray:
    """The suffixes of several strings that have `least` bytes or more, in order, with the common
    prefix of neighbours; a string's end sorts before any byte."""

    def __init__(self, strings: list[bytes], least: int):
        sizes = np.array([len(s) for s in strings], dtype=np.int64)
        raw = np.frombuffer(b"".join(strings), dtype=np.uint8).astype(np.int64) + 1
        n = len(raw)
        self.string = np.repeat(np.arange(len(strings)), sizes)
        ends = np.repeat(np.cumsum(sizes), sizes)
        self.place = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.left = np.concatenate([[0], raw[:-1]]) if n else raw
        self.left = np.where(self.place == 0, -1, self.left)  # not known at the start of a string
        index = np.arange(n)
        longest = int(sizes.max(initial=0))

        def beyond(ranks: np.ndarray, step: int) -> np.ndarray:
            out = np.zeros(n, dtype=np.int64)
            inside = index + step < ends
            out[inside] = ranks[index[inside] + step]
            return out

        key = raw
        for step in (1, 2, 3):
            key = key * 257 + beyond(raw, step)
        ranks = [np.unique(key, return_inverse=True)[1].astype(np.int64) + 1]
        length = 4
        while length < longest:
            key = ranks[-1] * (n + 2) + beyond(ranks[-1], length)
            ranks.append(np.unique(key, return_inverse=True)[1].astype(np.int64) + 1)
            length *= 2
        starts = np.flatnonzero(ends - index >= least)
        self.order = starts[np.argsort(ranks[-1][starts], kind="stable")]
        self.common = self._common(raw, ranks, ends)

    def _common(self, raw: np.ndarray, ranks: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
        """Bytes that each suffix shares with the one before it."""
        if len(self.order) < 2:
            return np.zeros(len(self.order), dtype=np.int64)
        a, b = self.order[:-1], self.order[1:]
        most = np.minimum(ends[a] - a, ends[b] - b)
        shared = np.zeros(len(a), dtype=np.int64)
        steps = [(4 << k, r) for k, r in enumerate(ranks)][::-1] + [(1, raw)] * 3
        for step, values in steps:
            i, j = a + shared, b + shared
            inside = shared < most
            equal = np.zeros(len(a), dtype=bool)
            equal[inside] = values[i[inside]] == values[j[inside]]
            shared = np.minimum(shared + step * equal, most)
        return np.concatenate([[0], shared])


def intervals(common: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of the intervals of suffixes with a common prefix of `least` or more, inner
    ones first: a scan with a stack of those still open."""
    open_: list[list[int]] = []
    for i in range(1, len(common) + 1):
        value = common[i] if i < len(common) else 0
        first = i - 1
        while open_ and open_[-1][0] > value:
            length, first = open_.pop()
            yield length, first, i - 1
        if value >= least and (not open_ or open_[-1][0] < value):
            open_.append([value, first])


def repeat_groups(array: SuffixArray, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """(length, positions) of the maximal repeats: what no byte to the right or left could lengthen for
    all occurrences. Every occurrence is listed.

    Suffixes fall into runs with common prefixes of `least` or more. A run in which one known byte stands
    before all suffixes is left out with all its intervals: the run of that byte has their occurrences.
    """
    together = array.common >= least
    run = np.cumsum(~together)
    sizes = np.bincount(run)
    firsts = np.flatnonzero(~together)
    left = array.left[array.order]
    for r in np.flatnonzero(sizes > 1)[_diverse_runs(left, firsts, sizes)].tolist():
        low, n = int(firsts[r - 1]), int(sizes[r])
        if n == 2:
            yield int(array.common[low + 1]), array.order[low:low + 2]
            continue
        inner = array.common[low:low + n].tolist()
        inner[0] = 0
        for length, a, b in intervals(inner, least):
            before = left[low + a:low + b + 1]
            if (before < 0).any() or (before != before[0]).any():
                yield length, array.order[low + a:low + b + 1]


def _diverse_runs(left: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    low, high = np.minimum.reduceat(left, firsts), np.maximum.reduceat(left, firsts)
    diverse = (low != high) | (low < 0)
    return diverse[np.flatnonzero(sizes > 1) - 1]


def later_occurrences(packed: list[bytes], owner: np.ndarray, at: np.ndarray,
                      window: int) -> list[tuple[int, int, int]]:
    """(fragment, first byte, end) of the occurrences of maximal repeats but the earliest of each."""
    array = SuffixArray(packed, window)
    if len(array.order) < 2:
        return []
    found: dict[tuple[int, int], int] = {}
    for length, positions in repeat_groups(array, window):
        fragment, place = array.string[positions], array.place[positions]
        order = np.lexsort((at[fragment] + place, owner[fragment]))
        first = order[0]
        for k in order[1:].tolist():
            f, p = int(fragment[k]), int(place[k])
            if (owner[f], at[f] + p) != (owner[fragment[first]], at[fragment[first]] + place[first]):
                found[f, p] = max(found.get((f, p), 0), p + length)
    return [(f, p, e) for (f, p), e in found.items()]


def without_repeated_bytes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                           window: int = WINDOW, gram: int = GRAM, large: int = LARGE_BUCKET) -> DataFrame:
    """What stays of each text when byte strings that also start earlier are taken out.

    A byte goes if a string of `window` bytes covers it that also starts earlier: in a text with a
    smaller id, or before it in the same text. Occurrences may overlap; strings are judged on the
    input and never cross texts. Per row: `doc_id`, `n_bytes`, `n_removed`, `n_spans` (removed runs),
    `kept_sha256` (of the bytes that stay). Texts count as UTF-8, null as empty; what is shorter than
    `window` stays whole. Rows that repeat an id count as one text whose starts are compared; equal starts
    of them are not earlier than one another. Rows without an id come after all others. An empty
    table gives no row.
    """
    kind = Kind(window, gram, False, ("d", "at"))
    found = without_repeats(docs, kind, later_occurrences, id_col, text_col, large)
    return found.select("doc_id", found["n"].alias("n_bytes"), "n_removed", "n_spans", "kept_sha256")
