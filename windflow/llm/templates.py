"""Benchmark questions in documents, also with other numbers, names and units in them.

A text becomes a template: numbers, units behind numbers, and names (capitalised words) turn into
typed placeholders. A capitalised word that begins a sentence may be a name or not: its windows are taken
both ways. Windows of template tokens are hashed and joined with those of the benchmark.
Along an alignment of document and question a value of the question must always become the same value: a
question that was only re-parameterised passes, a chance likeness of form does not.
"""

from __future__ import annotations

import itertools
import math
from bisect import bisect_left, bisect_right
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windflow.llm.common import Scratch, grams, mixed, over_batches, power_tables, run_hashes, text_bytes, texts_of

WINDOW = 8
# Words a window must keep as they are, and the shortest question that is looked for.
LITERALS, SHORTEST = 4, 5
# A question is found if this share of its windows is, or so many windows in one alignment.
SHARE, ENOUGH = 0.5, 25
# Benchmark windows that every task holds at once; a larger benchmark is searched in several passes.
HELD_WINDOWS = 1_000_000
# Tokens that a name or a value may be longer in the document, all told: so many, or a quarter of the question's.
LEAST_DRIFT = 3
# Choices of values that are tried for a contradictory alignment; beyond, each value takes its most frequent one.
CHOICES = 256

# Words that are units behind a number.
UNITS = ("m km cm mm mile miles foot feet inch inches yard yards g kg mg lb lbs ounce ounces ton tons l ml litre "
         "litres liter liters gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks "
         "month months year years dollar dollars cent cents euro euros pound pounds percent degrees mph kph kmh w kw "
         "mw kwh mwh hz khz mhz ghz b kb mb gb tb").split()

_NUMBER, _NAME, _UNIT = 1, 2, 3
_MARK = {_NUMBER: "<number>", _NAME: "<name>", _UNIT: "<unit>"}
_CODE = np.array([0, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], dtype=np.uint64)

_byte = np.arange(256)
_DIGIT = (_byte >= 0x30) & (_byte <= 0x39)
_UPPER = (_byte >= 0x41) & (_byte <= 0x5A)
_LETTER = _UPPER | ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0x80)
_STOP = np.isin(_byte, [ord(c) for c in ".!?\n"])
_JOINT = np.isin(_byte, [ord(c) for c in " -'"])
_SIGN = np.isin(_byte, [ord(c) for c in "+-*/=<>^%"])
_POINT = np.isin(_byte, [ord(c) for c in ".,"])

_WINDOWS = "id long, at long, size int, hash long, template string, slots array<string>, n_windows long"
_FOUND = "doc_id long, item_id long, n_found long, n_windows long, n_changed long"


class Template:
    """The template tokens of several texts end to end: codes, kinds, and where each text begins.

    A capitalised word that begins a sentence is a name only with `opening`. Names side by side are
    one token. `place` is a token's number before that, by which both readings can be compared.
    """

    def __init__(self, texts: list[bytes], opening: bool = False):
        self.buffer = b"\n".join(texts) + b"\n"
        raw = np.frombuffer(self.buffer, dtype=np.uint8)
        digit = _DIGIT[raw]
        inner = _POINT[raw]  # 1,234.5 is one number
        inner[1:-1] &= digit[:-2] & digit[2:]
        inner[0] = inner[-1] = False
        kind = np.where(_LETTER[raw], 1, np.where(digit | inner, 2, 0))
        edge = np.flatnonzero(np.diff(kind, prepend=0, append=0))
        edges = edge[:-1], edge[1:]
        real = kind[edges[0]] > 0
        self.starts, self.ends = edges[0][real], edges[1][real]
        sizes = np.cumsum([len(t) + 1 for t in texts])
        self.first = np.searchsorted(self.starts, np.concatenate([[0], sizes])).astype(np.int64)
        lower = raw.copy()
        lower[_UPPER[raw]] += 32
        accented = np.zeros(len(raw), dtype=bool)  # capital Latin letters of two bytes
        accented[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
        lower[accented] += 32
        self._lower = lower
        self.place = np.arange(len(self.starts)) - np.repeat(self.first[:-1], np.diff(self.first))
        self._mark(raw, kind, accented, opening)

    def _mark(self, raw: np.ndarray, kind: np.ndarray, accented: np.ndarray, opening: bool) -> None:
        starts, ends = self.starts, self.ends
        self.codes = run_hashes(self._lower, starts, ends)
        self.kinds = np.zeros(len(starts), dtype=np.int64)
        self.openers = np.zeros(len(starts), dtype=bool)
        if not len(starts):
            return
        number = kind[starts] == 2
        stops = np.concatenate([[0], np.cumsum(_STOP[raw])])
        opens = np.ones(len(starts), dtype=bool)
        opens[1:] = stops[starts[1:]] > stops[ends[:-1]]
        opens[self.first[:-1][self.first[:-1] < len(starts)]] = True
        capital = _UPPER[raw] | np.append(accented[1:], False)
        capitals = np.concatenate([[0], np.cumsum(capital)])
        name = ~number & capital[starts] & (capitals[ends] - capitals[starts] == 1)
        self.openers = name & opens
        if not opening:
            name &= ~opens
        unit = np.zeros(len(starts), dtype=bool)
        unit[1:] = number[:-1] & ~number[1:] & np.isin(self.codes[1:], _unit_codes())
        unit[self.first[:-1][self.first[:-1] < len(starts)]] = False
        for flag, value in ((name, _NAME), (unit, _UNIT), (number, _NUMBER)):
            self.kinds[flag] = value
        self.codes = np.where(self.kinds > 0, _CODE[self.kinds], self.codes)
        self._fold(raw, opens)

    def _fold(self, raw: np.ndarray, opens: np.ndarray) -> None:
        """Names with one space, hyphen or apostrophe between them become one token."""
        follows = np.zeros(len(self.starts), dtype=bool)
        follows[1:] = ((self.kinds[1:] == _NAME) & (self.kinds[:-1] == _NAME) & ~opens[1:]
                       & (self.starts[1:] - self.ends[:-1] == 1) & _JOINT[raw[self.ends[:-1]]])
        if not follows.any():
            return
        stay = ~follows
        last = np.append(np.flatnonzero(stay)[1:], len(stay)) - 1
        self.first = np.concatenate([[0], np.cumsum(stay)])[self.first]
        self.ends = self.ends[last]
        self.starts, self.codes, self.kinds, self.openers, self.place = [
            x[stay] for x in (self.starts, self.codes, self.kinds, self.openers, self.place)]

    def token(self, i: int) -> str:
        return self._lower[self.starts[i]:self.ends[i]].tobytes().decode(errors="replace")

    def window(self, i: int, size: int) -> tuple[str, list[str]]:
        """The template as text, and the values in its placeholders."""
        kinds = self.kinds[i:i + size].tolist()
        words = [self.token(k) for k in range(i, i + size)]
        return " ".join(_MARK.get(k, w) for k, w in zip(kinds, words)), [w for k, w in zip(kinds, words) if k]

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of `size` tokens, and which of them lie in one text with enough words."""
        hashes = grams(self.codes, size)
        if not len(hashes):
            return hashes, np.zeros(0, dtype=bool)
        text_of = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        literal = np.concatenate([[0], np.cumsum(self.kinds == 0)])
        n = len(hashes)
        fit = (text_of[:n] == text_of[size - 1:]) & (literal[size:] - literal[:n] >= LITERALS)
        return hashes, fit

    def opened(self, size: int) -> np.ndarray:
        """Which runs of `size` tokens hold a word that `opening` decides on, or names beside one."""
        near = self.openers.copy()
        near[1:] |= self.openers[:-1]
        held = np.concatenate([[0], np.cumsum(near)])
        return held[size:] > held[:len(held) - size]


class Verbatim:
    """The tokens of several texts as they are: runs of letters, runs of digits, signs of arithmetic, and each
    character of a script without spaces by itself."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join(texts) + b"\n" * 4, dtype=np.uint8)
        second, third = np.append(raw[1:], 0), np.append(raw[2:], [0, 0])
        kind = np.where(_LETTER[raw], 1, np.where(_DIGIT[raw], 2, np.where(_SIGN[raw], 3, 0)))
        mark = (raw == 0xE3) & (second == 0x80) | (raw == 0xEF) & (second == 0xBC) & (
            (third <= 0x8F) | (third >= 0x9A) & (third <= 0xA0))  # punctuation of full width
        three = ((raw >= 0xE3) & (raw <= 0xE9) | (raw == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
                 | (raw == 0xE1) & np.isin(second, [0x80, 0x81, 0x82, 0x9E, 0x9F]) | (raw == 0xE2) & (second >= 0xBA)
                 | (raw == 0xEF) & (second >= 0xA4) & (second <= 0xAB)) & ~mark
        four = (raw == 0xF0) & (second >= 0xA0) & (second <= 0xBF)
        self.single = three | four
        for lead, size, value in ((three, 3, 4), (four, 4, 4), (mark, 3, 0)):
            at = np.flatnonzero(lead)
            for k in range(size):
                kind[at + k] = value
        turns = (kind != np.append(0, kind[:-1])) | (kind == 3) | self.single
        self.starts = np.flatnonzero(turns & (kind > 0))
        edges = np.flatnonzero(turns)
        self.ends = edges[np.searchsorted(edges, self.starts) + 1]
        sizes = np.cumsum([len(t) + 1 for t in texts])
        self.first = np.searchsorted(self.starts, np.concatenate([[0], sizes])).astype(np.int64)
        lower = raw.copy()
        lower[_UPPER[raw]] += 32
        accented = np.append(False, (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97))
        lower[accented] += 32
        self.singles = np.concatenate([[0], np.cumsum(self.single[self.starts])])
        up, self.down = power_tables(len(self.starts) + 1)
        self.sums = np.zeros(len(self.starts) + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(run_hashes(lower, self.starts, self.ends) * up[:len(self.starts)], out=self.sums[1:])

    def hashes(self, at: np.ndarray, size: int) -> np.ndarray:
        """The hash of the run of `size` tokens from each of the places `at`."""
        with np.errstate(over="ignore"):
            return mixed((self.sums[at + size] - self.sums[at]) * self.down[at] + np.uint64(size))


def _probe(size: int) -> int:
    """How many of a run's first tokens are looked up: few different numbers, so few passes over a text."""
    return 1 << (size.bit_length() - 1)


def _verbatim_questions(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The whole token sequence of questions that templates do not cover, and of the first tokens of it."""
    texts, covered = text_bytes(batch.column(1)), {r.as_py() for r in _question_windows(batch.set_column(
        0, "doc_id", pa.array(range(batch.num_rows), pa.int64()))).column(0)}
    made, rows = Verbatim(texts), []
    for k, (a, b) in enumerate(zip(made.first[:-1].tolist(), made.first[1:].tolist())):
        if b > a and (k not in covered or made.singles[b] > made.singles[a]):
            size, at = b - a, np.array([a])
            rows.append((batch.column(0)[k].as_py(), size, *[
                int(made.hashes(at, n).view(np.int64)[0]) for n in (_probe(size), size)]))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)],
                                      ["item_id", "size", "probe", "hash"])


def _verbatim_found(known):
    """The whole sequences that documents hold: `known` is a broadcast {probe size: (probes, sizes, hashes)}."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, made, rows = batch.column(0).to_pylist(), Verbatim(text_bytes(batch.column(1))), set()
        text_of = np.repeat(np.arange(len(ids)), np.diff(made.first))
        for few, (probes, sizes, wholes) in known.value.items():
            places = np.arange(max(0, len(text_of) - few + 1))
            hashes = made.hashes(places, few)
            low, high = np.searchsorted(probes, hashes, "left"), np.searchsorted(probes, hashes, "right")
            for size in np.unique(sizes).tolist():
                if not (high > low).any():
                    break
                at = places[(high > low)[:len(places)]]
                at = at[(at + size <= len(text_of))]
                at = at[text_of[at] == text_of[at + size - 1]]
                mine = np.sort(wholes[sizes == size])
                found = made.hashes(at, size)
                hit = mine[np.minimum(np.searchsorted(mine, found), len(mine) - 1)] == found
                rows.update((ids[t], size, h) for t, h in zip(text_of[at[hit]].tolist(),
                                                              found[hit].view(np.int64).tolist()))
        found = sorted(rows)
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in found], pa.int64()) for c in range(3)],
                                          ["doc_id", "size", "hash"])
    return over_batches(run)


def _verbatim(texts: DataFrame, benchmark: DataFrame, held: int) -> DataFrame | None:
    """`_FOUND` rows of the documents that hold a question without usable windows as it is."""
    spark = texts.sparkSession
    asked = benchmark.mapInArrow(over_batches(_verbatim_questions), "item_id long, size long, probe long, hash long")
    distinct = asked.select("size", "probe", "hash").distinct()
    passes = -(-distinct.count() // held)
    seen = []
    for k in range(passes):
        groups: dict[int, list[tuple]] = {}
        for r in distinct.filter(F.pmod("hash", F.lit(passes)) == k).collect():
            groups.setdefault(_probe(r["size"]), []).append((r["probe"], r["size"], r["hash"]))
        known = {}
        for few, rows in groups.items():
            probes, sizes, wholes = np.array(rows, dtype=np.int64).T
            known[few] = np.sort(probes.view(np.uint64)), sizes, wholes.view(np.uint64)
        if known:
            seen.append(texts.mapInArrow(_verbatim_found(spark.sparkContext.broadcast(known)),
                                         "doc_id long, size long, hash long"))
    if not seen:
        return None
    return reduce(DataFrame.unionByName, seen).distinct().join(asked, ["size", "hash"]).select(
        "doc_id", "item_id", F.lit(1).cast("long").alias("n_found"), F.lit(1).cast("long").alias("n_windows"),
        F.lit(0).cast("long").alias("n_changed")).distinct()


_units: list[np.ndarray] = []


def _unit_codes() -> np.ndarray:
    if not _units:
        text = np.frombuffer(" ".join(UNITS).encode(), dtype=np.uint8)
        sizes = np.array([len(u) for u in UNITS])
        starts = np.cumsum(sizes + 1) - sizes - 1
        _units.append(np.sort(run_hashes(text, starts, starts + sizes)))
    return _units[0]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)],
                                      ["id", "at", "size", "hash", "template", "slots", "n_windows"])


def _question_windows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Every window of every question in both readings; a question shorter than a window is one window.

    `n_windows` is the number of places where a window of either reading begins.
    """
    ids, texts = batch.column(0).to_pylist(), text_bytes(batch.column(1))
    found: list[list[tuple]] = [[] for _ in ids]
    for opening in (False, True):
        made = Template(texts, opening)
        for k, (a, b) in enumerate(zip(made.first[:-1].tolist(), made.first[1:].tolist())):
            size = min(WINDOW, b - a)
            if size < SHORTEST:
                continue
            hashes, fit = made.windows(size)
            if opening:
                fit &= made.opened(size)
            for i in range(a, b - size + 1):
                if fit[i]:
                    found[k].append((int(made.place[i]), size, int(hashes[i].view(np.int64)), *made.window(i, size)))
    return _batch([(ids[k], *w, len({w[0] for w in mine})) for k, mine in enumerate(found) for w in mine])


def _document_windows(known: dict[int, object]):
    """The windows of documents whose hash is among `known`: by size, sorted and broadcast."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, texts, rows = batch.column(0).to_pylist(), text_bytes(batch.column(1)), []
        for opening in (False, True):
            made = Template(texts, opening)
            text_of = np.repeat(np.arange(len(ids)), np.diff(made.first))
            for size, held in known.items():
                sought, marks = held.value
                hashes, fit = made.windows(size)
                if opening and len(hashes):
                    fit &= made.opened(size)
                likely = np.flatnonzero(fit & marks[(hashes >> np.uint64(44)).astype(np.int64)])
                at = np.searchsorted(sought, hashes[likely])
                likely = likely[sought[np.minimum(at, len(sought) - 1)] == hashes[likely]]
                for i in likely.tolist():
                    template, slots = made.window(i, size)
                    rows.append((ids[text_of[i]], int(made.place[i]), size, int(hashes[i].view(np.int64)), template,
                                 slots, 0))
        return _batch(rows)
    return over_batches(run)


def _marked(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes in order and a table of their leading bits, which turns most lookups away."""
    marks = np.zeros(1 << 20, dtype=bool)
    marks[(hashes >> np.uint64(44)).astype(np.int64)] = True
    return np.sort(hashes), marks


def agreeing(windows: list[tuple[int, set]], all_slots: bool) -> tuple[int, int]:
    """How many places of the question count, and how many of its values differ in them.

    `windows` are (place in the question, {(value there, value in the document)}). Windows without a
    change count as they are; the others if each value of the question becomes one value in all of
    them. With `all_slots` one contradiction between any two windows leaves none.
    """
    if all_slots:
        values = set().union(*[v for _, v in windows])
        if len({a for a, _ in values}) < len(values):
            return 0, 0
        return len({at for at, _ in windows}), sum(a != b for a, b in values)
    same = {at for at, v in windows if all(a == b for a, b in v)}
    changed = [(at, v) for at, v in windows if at not in same]
    votes: dict[str, dict[str, set[int]]] = {}
    for at, v in changed:
        for a, b in v:
            votes.setdefault(a, {}).setdefault(b, set()).add(at)
    ranked = {a: sorted(c, key=lambda b: (-len(c[b]), b)) for a, c in votes.items()}
    if math.prod(len(c) for c in ranked.values()) > CHOICES:
        ranked = {a: c[:1] for a, c in ranked.items()}
    best = (0, 0)
    for chosen in itertools.product(*ranked.values()):
        becomes = dict(zip(ranked, chosen))
        counted = [(at, v) for at, v in changed if all(becomes[a] == b for a, b in v)]
        differ = {x for _, v in counted for x in v if x[0] != x[1]}
        best = max(best, (len({at for at, _ in counted}), -len(differ)))
    return len(same) + best[0], -best[1]


def _stretches(shifts: list[int], drift: int) -> list[tuple[int, int]]:
    """First and last shift of what is counted as one alignment: each alone, and all within `drift`."""
    out, last = [(s, s) for s in shifts], None
    for s in shifts:
        high = shifts[bisect_right(shifts, s + drift) - 1]
        if high > s and high != last:
            out.append((s, high))
        last = high
    return out


def _best_alignments(all_slots: bool):
    def best(n_windows: int, windows: list[dict]) -> tuple[int, int]:
        by_shift: dict[int, list[tuple[int, set]]] = {}
        for w in windows:
            values = set(zip(w["item_slots"], w["doc_slots"]))
            by_shift.setdefault(w["doc_at"] - w["at"], []).append((w["at"], values))
        shifts, top = sorted(by_shift), (0, 0)
        drift = max(LEAST_DRIFT, max(w["at"] for w in windows) // 4)
        for low, high in _stretches(shifts, drift):
            mine = [w for s in shifts[bisect_left(shifts, low):bisect_right(shifts, high)] for w in by_shift[s]]
            places = len({at for at, _ in mine})
            if places > top[0] or places == top[0] and top[1]:
                n, changed = agreeing(mine, all_slots)
                if n >= SHARE * n_windows or n >= ENOUGH:
                    top = max(top, (n, -changed))
        return top

    def run(batches):
        for batch in batches:
            rows = []
            for doc, item, n_windows, windows in zip(*[c.to_pylist() for c in batch.columns]):
                n, changed = best(n_windows, windows)
                if n:
                    rows.append((doc, item, n, n_windows, -changed))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(5)],
                                             ["doc_id", "item_id", "n_found", "n_windows", "n_changed"])
    return run


_KEY = ["size", "hash", "template"]


def _likely(seen: DataFrame, asked: DataFrame) -> DataFrame:
    """`doc_id, item_id`: the documents that may hold enough windows of a question.

    Where so many of a question's places must be found, one at least of all but so many less one must be: the
    places that are seldom seen. A window that many questions and many documents share brings none together
    by itself.
    """
    often = seen.groupBy(*_KEY).agg(F.count("*").alias("often"))
    item = Window.partitionBy("item_id")
    places = asked.join(often, _KEY, "left").groupBy("item_id", "at").agg(
        F.coalesce(F.sum("often"), F.lit(0)).alias("often"), F.min("n_windows").alias("n_windows"))
    needed = F.least(F.ceil(SHARE * F.min("n_windows").over(item)), F.lit(ENOUGH))
    seldom = (places.withColumns({"turn": F.row_number().over(item.orderBy("often", "at")), "needed": needed,
                                  "places": F.count("*").over(item)})
              .filter(F.col("turn") <= F.col("places") - F.col("needed") + 1).select("item_id", "at"))
    sought = asked.join(seldom, ["item_id", "at"]).select("item_id", *_KEY).distinct()
    return seen.select("doc_id", *_KEY).distinct().join(sought, _KEY).select("doc_id", "item_id").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", held: int = HELD_WINDOWS,
                 all_slots: bool = True) -> DataFrame:
    """Documents that hold a benchmark question, with the question's values or others.

    A row for each document and question found: `doc_id`, `item_id`, `n_found` and `n_windows` of the
    question, `share`, and `n_changed`, how many values differ. The best alignment counts: one with
    `SHARE` of the question's windows, or `ENOUGH` of them, in which a value of the question always
    becomes the same value; two values may become one. With `all_slots` a single contradiction spoils an
    alignment, without it the windows that agree with one another count, and unchanged ones always. Windows
    need `LITERALS` words outside placeholders, in a question of `SHORTEST` tokens or more. A question without
    such a window, or in a script without spaces, is looked for as it is: all its words, numbers and signs
    of arithmetic in turn, or its single characters, count as one window.
    Null and empty texts hold nothing, nor do rows without an id; rows that repeat an id are read as
    documents of that id, side by side. Either table may be empty: then there is no row.
    """
    spark = docs.sparkSession
    questions = texts_of(benchmark, item_col, item_text_col).filter("doc_id is not null")
    texts = texts_of(docs, id_col, text_col).filter("doc_id is not null and text is not null")
    with Scratch(spark) as scratch:
        asked = scratch.table(questions.mapInArrow(over_batches(_question_windows), _WINDOWS)
                              .withColumnsRenamed({"id": "item_id", "slots": "item_slots"}), "asked")
        distinct = asked.select("size", "hash").distinct()
        passes = max(1, -(-distinct.count() // held))
        found = []
        for k in range(passes):
            mine = distinct.filter(F.pmod("hash", F.lit(passes)) == k) if passes > 1 else distinct
            by_size: dict[int, list[int]] = {}
            for row in mine.collect():
                by_size.setdefault(row["size"], []).append(row["hash"])
            known = {size: spark.sparkContext.broadcast(_marked(np.array(h, dtype=np.int64).view(np.uint64)))
                     for size, h in by_size.items()}
            if known:
                found.append(texts.mapInArrow(_document_windows(known), _WINDOWS))
        if not found:  # an empty benchmark
            found = [texts.limit(0).mapInArrow(over_batches(_question_windows), _WINDOWS)]
        seen = scratch.table(reduce(DataFrame.unionByName, found).drop("n_windows").withColumnsRenamed(
            {"id": "doc_id", "at": "doc_at", "slots": "doc_slots"}), "seen")
        pairs = seen.join(_likely(seen, asked), "doc_id").join(asked, ["item_id", *_KEY])
        seen_at = F.struct("at", "doc_at", "item_slots", "doc_slots")
        best = (pairs.groupBy("doc_id", "item_id").agg(F.max("n_windows").alias("n_windows"),
                                                       F.collect_set(seen_at).alias("windows"))
                .mapInArrow(_best_alignments(all_slots), _FOUND))
        whole = _verbatim(texts, questions, held)
        if whole is not None:
            rank = F.struct(F.col("n_found") / F.col("n_windows"), "n_found", -F.col("n_changed"))
            best = best.unionByName(whole).groupBy("doc_id", "item_id").agg(*[
                F.max_by(c, rank).alias(c) for c in ("n_found", "n_windows", "n_changed")])
        return scratch.result(best.withColumn("share", F.col("n_found") / F.col("n_windows")).select(
            "doc_id", "item_id", "n_found", "n_windows", "share", "n_changed"))
