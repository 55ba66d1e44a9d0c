"""Repeated passages of words, removed but where they occur first."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from windflow.llm.minimisers import LARGE_BUCKET, Kind, without_repeats

WINDOW, GRAM = 50, 5


def same_windows(ids: np.ndarray, window: int) -> np.ndarray:
    """A number for each window of `window` items: equal numbers, equal windows. Sorting only, no hash.

    Runs of one item are numbered by their ids; sorting pairs of neighbouring runs numbers the runs
    twice as long, and two overlapping runs make up a window.
    """
    ranks, length = ids.astype(np.int64), 1
    while 2 * length <= window:
        ranks = _paired(ranks[:-length], ranks[length:])
        length *= 2
    if window > length:
        ranks = _paired(ranks[:-(window - length)], ranks[window - length:])
    return ranks


def _paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.unique(left * (int(right.max(initial=0)) + 1) + right, return_inverse=True)[1].astype(np.int64)


def windows_of_earlier_texts(packed: list[bytes], owner: np.ndarray, at: np.ndarray,
                             window: int) -> list[tuple[int, int, int]]:
    """(fragment, first word, end) of runs of windows that also start in a text with a smaller id."""
    known: dict[bytes, int] = {}
    words = [p.split(b" ") for p in packed]
    ids = np.array([known.setdefault(w, len(known)) for part in words for w in part], dtype=np.int64)
    if len(ids) < window:
        return []
    sizes = np.array([len(part) for part in words])
    fragment = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    number = same_windows(ids, window)
    starts = np.flatnonzero((place + window <= sizes[fragment])[:len(number)])
    number, holder = number[starts], owner[fragment[starts]]
    order = np.argsort(number, kind="stable")
    edges = np.flatnonzero(np.diff(number[order], prepend=-1))
    first = np.repeat(np.minimum.reduceat(holder[order], edges), np.diff(np.append(edges, len(order))))
    taken = np.zeros(len(starts), dtype=bool)
    taken[order] = holder[order] > first
    return runs(fragment[starts][taken], place[starts][taken], window)


def runs(fragment: np.ndarray, place: np.ndarray, window: int) -> list[tuple[int, int, int]]:
    """Windows that start one after another, as one span."""
    if not len(fragment):
        return []
    new = np.ones(len(fragment), dtype=bool)
    new[1:] = (fragment[1:] != fragment[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(fragment)) - 1
    return list(zip(fragment[first].tolist(), place[first].tolist(), (place[last] + window).tolist()))


def without_repeated_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                              window: int = WINDOW, gram: int = GRAM, large: int = LARGE_BUCKET) -> DataFrame:
    """What stays of each text when passages that a text with a smaller id also has are taken out.

    A word goes if a window of `window` consecutive words covers it whose words also start, in this
    order, in a text with a smaller id; windows are judged on the input. Per row: `doc_id`, `n_words`,
    `n_removed`, `kept_sha256` (of the kept words, joined by one space). Words are runs of other than
    ASCII white space, unchanged. A text that is null, empty or shorter than a window keeps all its
    words. Rows that repeat an id never count as earlier than one another; rows without an id come
    after all others. An empty table gives no row.
    """
    kind = Kind(window, gram, True, ("d",))
    found = without_repeats(docs, kind, windows_of_earlier_texts, id_col, text_col, large)
    return found.select("doc_id", found["n"].alias("n_words"), "n_removed", "kept_sha256")
