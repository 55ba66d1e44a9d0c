"""Language by compression: the language whose text helps most to compress a text.

For each language a raw-content dictionary of the compressor is filled with the words that are most frequent in
its labelled texts. A text is compressed block by block with each dictionary, and the language with the smallest total wins. Where
the runner-up comes close, the text is rejected: closer than labelled texts of its length come that were not
learned from. Every labelled text is used, whole: three in four for the words, the others for these margins.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windflow.llm.common import Scratch, over_batches, slices
from windflow.operators.blocks import BLOCK as BLOCK_OF
from windflow.operators.blocks import from_earlier_blocks, so_far

# A dictionary holds so many bytes: a language's most frequent words. More languages are an error.
DICTIONARY_BYTES, MOST_LANGUAGES = 1 << 16, 200
# Different words that a task counts before it hands the counts on.
WORDS_AT_ONCE = 200_000
# Characters compressed at once: in longer blocks a text helps itself more than the dictionary does.
BLOCK, LEVEL = 2000, 6
# A margin below this is measured again, with a more thorough level added to the totals; sizes are whole
# bytes, so what is still even is repeated up to a length that the compressor works on.
NEAR, THOROUGH, LEAST_BYTES = 0.03, 12, 96
# The least share by which the runner-up must be larger, at any length.
LEAST_MARGIN = 0.002
# Margins of the labelled documents that were not learned from set a higher one for each length (powers of
# two): so much of the margin that all but `LOW` of them reach, where there are `ENOUGH` of them.
LOW, PART, ENOUGH = 0.01, 1 / 3, 50
# The share of the labelled documents that is left for it.
LEFT = 0.25

class _Plain(dict):
    """For `str.translate`: letters as they are, all else a space; what a character is, is asked once."""

    def __missing__(self, code: int) -> str:
        self[code] = found = chr(code) if chr(code).isalpha() else " "
        return found


_plain = _Plain()


def _words(text: str) -> list[str]:
    """Lower-cased words of letters; numerals that are no digits, such as fractions, are no letters."""
    return text.lower().translate(_plain).split()


def letters(text: str) -> str:
    """The words of a text, a space between two."""
    return " ".join(_words(text))


def training_rows(docs: DataFrame) -> Column:
    """Rows that may be learned from: crc32 of the id as text is no multiple of 5."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0


def _labelled(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """`lang`, `text` and `is_left` of the labelled rows to learn from; a hash of the id leaves `LEFT` for `margins`."""
    labelled = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                           F.col(lang_col).alias("lang")).filter("lang is not null and doc_id is not null")
    left = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) >= F.lit(int((1 - LEFT) * (1 << 20)))
    return labelled.filter(training_rows(labelled)).select("lang", "text", left.alias("is_left"))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`lang`, `word`, `n`: counts for Spark to add up. A word longer than a block counts as the pieces of it."""
    counts: defaultdict[str, Counter[str]] = defaultdict(Counter)

    def counted() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays(
            [pa.array([lang for lang, words in counts.items() for _ in words], pa.string()),
             pa.array([word for words in counts.values() for word in words], pa.string()),
             pa.array([n for words in counts.values() for n in words.values()], pa.int64())], ["lang", "word", "n"])
        counts.clear()
        return made

    for batch in (part for whole in batches for part in slices(whole)):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            words = _words(text or "")
            if max(map(len, words), default=0) > BLOCK:
                words = [word[i:i + BLOCK] for word in words for i in range(0, len(word), BLOCK)]
            counts[lang].update(words)
        if sum(map(len, counts.values())) >= WORDS_AT_ONCE:
            yield counted()
    yield counted()


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """A dictionary for each language: the most frequent words of all its labelled rows but those left for `margins`.

    Words are counted over the whole texts; as many as fit are taken, the most frequent ones last, where
    the compressor finds them soonest, and those of one count in the order of a hash. More than
    `MOST_LANGUAGES` labels raise an error, as their dictionaries would not fit a task: none is left out.
    """
    labelled = _labelled(docs, id_col, text_col, lang_col)
    languages = [r["lang"] for r in labelled.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect()]
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts = labelled.filter("not is_left").select("lang", "text").mapInArrow(
        _count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    frequent = Window.partitionBy("lang").orderBy(F.desc("n"), F.xxhash64("word"), "word")
    # A word and its space are two bytes at least.
    ranked = counts.withColumn("rank", F.row_number().over(frequent)).filter(F.col("rank") <= DICTIONARY_BYTES // 2)
    filled = F.sum(F.octet_length("word") + 1).over(Window.partitionBy("lang").orderBy("rank").rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    chosen = ranked.withColumn("filled", filled).filter(F.col("filled") <= DICTIONARY_BYTES)
    words = F.sort_array(F.collect_list(F.struct((-F.col("rank")).alias("rank"), "word")))["word"]
    filling = chosen.groupBy("lang").agg(F.concat(F.array_join(words, " "), F.lit(" ")).alias("words")).collect()
    return dict.fromkeys(sorted(languages), b"") | {r["lang"]: r["words"].encode() for r in filling}


def margins(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text",
            lang_col: str = "lang") -> dict[int, float]:
    """The least margin for each length of a text (the bits of its number of letters and spaces).

    It is `PART` of the margin that all but `LOW` of the rightly judged labelled documents of that length
    reach: all those that `learn` leaves, whole. A length with fewer than `ENOUGH` of them is left out:
    `LEAST_MARGIN` holds there.
    """
    left = _labelled(docs, id_col, text_col, lang_col).filter("is_left")
    classifier = _judging(dictionaries)

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [classifier().judge(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[2] for f in found], pa.float64()),
             pa.array([f[3].bit_length() for f in found], pa.int32())], ["lang", "lang_pred", "margin", "bits"])

    judged = left.select("lang", "text").mapInArrow(
        over_batches(measure), "lang string, lang_pred string, margin double, bits int").filter("lang = lang_pred")
    return {bits: max(LEAST_MARGIN, PART * low) for bits, low in _reached(judged).items()}


def _reached(judged: DataFrame) -> dict[int, float]:
    """The margin that all but `LOW` of the rows reach, exactly, for each `bits` with `ENOUGH` rows.

    Equal margins are counted first and put in order per stretch of margins; only the rows beside
    the wanted place come to the driver, two a length. The counts are used twice: they are kept in the
    shared folder, so that each text is judged once.
    """
    with Scratch(judged.sparkSession) as scratch:
        return _at_place(scratch.table(judged.groupBy("bits", "margin").agg(F.count("*").alias("rows")), "margins"))


def _at_place(counts: DataFrame) -> dict[int, float]:
    """`_reached` from the number of `rows` of each `bits` and `margin`."""
    counts = counts.withColumn(BLOCK_OF, F.floor(F.col("margin") * 4096))
    others = from_earlier_blocks(counts, ["bits"], {"before": (F.sum("rows"), F.sum)}, {"n": (F.sum("rows"), F.sum)})
    upto = (F.sum("rows").over(so_far(["bits"], "margin")) + F.coalesce("before", F.lit(0))).alias("upto")
    place = (F.col("n") - 1) * LOW
    beside = (counts.join(others, ["bits", BLOCK_OF]).filter(F.col("n") >= ENOUGH)
              .select("bits", "margin", "rows", "n", upto)
              .filter((F.col("upto") > F.floor(place)) & (F.col("upto") - F.col("rows") <= F.ceil(place)))).collect()
    low: dict[int, float] = {}
    for bits in {r["bits"] for r in beside}:
        found = sorted((r["margin"], r["upto"], r["n"]) for r in beside if r["bits"] == bits)
        at = (found[0][2] - 1) * LOW
        first, last = found[0][0], next(m for m, upto, _ in found if upto > math.ceil(at))
        low[bits] = first + (last - first) * (at - math.floor(at))
    return low


class Classifier:
    """Sizes of texts under each dictionary."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.languages = sorted(dictionaries)
        self.quick = [_compressor(dictionaries[lang], LEVEL) for lang in self.languages]
        self.thorough = [_compressor(dictionaries[lang], THOROUGH) for lang in self.languages]

    def judge(self, text: str | None) -> tuple[str, float, float, int]:
        """(language, score, margin, length of the words); `und`, 0, 0, 0 without a letter or a dictionary."""
        words = letters(text or "")
        if not words or not self.languages:
            return "und", 0.0, 0.0, 0
        blocks = [words[i:i + BLOCK].encode() for i in range(0, len(words), BLOCK)]
        sizes = _sizes(self.quick, blocks)
        if _margin(sizes) < NEAR:
            sizes = [a + b for a, b in zip(sizes, _sizes(self.thorough, blocks))]
        if _margin(sizes) == 0:
            longer = [(words + " ").encode() * (1 + LEAST_BYTES // len(words))]
            sizes = [a + b for a, b in zip(sizes, _sizes(self.thorough, longer))]
        margin = _margin(sizes)
        return self.languages[sizes.index(min(sizes))], min(1.0, 0.5 + 2 * margin), margin, len(words)


def _compressor(content: bytes, level: int):
    import zstandard
    held = zstandard.ZstdCompressionDict(content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=held, write_content_size=False,
                                    write_checksum=False, write_dict_id=False)


def _sizes(compressors: list, blocks: list[bytes]) -> list[int]:
    return [sum([len(c.compress(b)) for b in blocks]) for c in compressors]


def _margin(sizes: list[int]) -> float:
    """How much smaller the smallest is than the next, as a share of the next."""
    if len(sizes) == 1:
        return 1.0
    best, second = sorted(sizes)[:2]
    return (second - best) / second


def _rejected(found: tuple[str, float, float, int], least: dict[int, float] | None) -> bool:
    lang, _, margin, length = found
    return lang == "und" or margin < (least or {}).get(length.bit_length(), LEAST_MARGIN)


def _judging(dictionaries: dict[str, bytes]):
    held: list[Classifier] = []

    def classifier() -> Classifier:
        if not held:
            held.append(Classifier(dictionaries))
        return held[0]
    return classifier


def predict(docs: DataFrame, dictionaries: dict[str, bytes], *, id_col: str = "doc_id", text_col: str = "text",
            least: dict[int, float] | None = None) -> DataFrame:
    """`doc_id`, `lang_pred`, `score` (0 to 1), `margin`, `rejected` of every row.

    `lang_pred` is always the best language, or `und` for a text that is null or has no letter; ties go
    to the first name. `rejected` is true for `und` and where the margin is below that for the text's length in
    `least` (see `margins`), or `LEAST_MARGIN` where it has none. Every block of a text counts. Repeated rows are judged alike; an id may be null. The dictionaries, at most
    `MOST_LANGUAGES` of `DICTIONARY_BYTES`, go to every task.
    """
    classifier = _judging(dictionaries)

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [classifier().judge(t) for t in batch.column(1).to_pylist()]
        columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                   pa.array([f[2] for f in found], pa.float64()),
                   pa.array([_rejected(f, least) for f in found], pa.bool_())]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns],
                                          ["doc_id", "lang_pred", "score", "margin", "rejected"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(over_batches(judge),
                             "doc_id long, lang_pred string, score double, margin double, rejected boolean")


def accepted(docs: DataFrame, dictionaries: dict[str, bytes], *, text_col: str = "text",
             least: dict[int, float] | None = None) -> DataFrame:
    """The rows of `docs`, with all their columns, whose text is not rejected. Texts that are null, empty or without
    a letter go; rows without an id and repeated rows are judged like others; an empty table stays empty."""
    classifier = _judging(dictionaries)

    def keep(batches):
        for batch in (part for whole in batches for part in slices(whole, text_col)):
            found = [classifier().judge(t) for t in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array([not _rejected(f, least) for f in found], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)

