"""Phrases of frequent words by dynamic itemset counting, and how strongly their parts hold together.

The documents are dealt to shards that are scanned in a cycle. Words are counted from the first shard on. After
each shard, phrases whose count has reached the threshold are marked, and from the next shard on every
phrase one word longer whose first and last part are both marked is counted as well, each for one full
cycle: the shards up to the last, then from the first to where it began. So lengths are counted side by side
and not in passes of their own, and each count is exact.

The marks are a table of fixed size that is handed to all tasks: for each slot the first shard scan from which
phrases with that hash count as marked. A phrase begins at the later step of its two parts, which never changes once
it is set, so all tasks agree on it. Two phrases with one slot cost work and no accuracy: what is marked
without having reached the threshold is counted in full and dropped at the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windflow.llm.common import Scratch, mixed, run_hashes, text_bytes

# Words of a phrase at most, and the occurrences it needs.
LONGEST, LEAST = 4, 30
# Shards in a cycle, and slots of the table of marks (a byte each).
SHARDS, SLOTS = 2, 1 << 24
# Text tokenised at once; a longer text is cut between its pieces.
CHUNK = 6 << 20
# A longer phrase with this share of the occurrences, in hundredths, replaces its parts.
COVERED = 80

UNMARKED = 255
_BREAK = b"\n"
_PLAIN = bytes.maketrans(b"\t.,;:!?\x0b\x0c\r", b" \n\n\n\n\n\n\n\n\n")
_COUNTS = "lang string, phrase string, start int, n long"
_BITS = 1 << 15  # of one bitmap row


def chunks(texts: list[bytes], most: int = CHUNK):
    """The texts, lower-cased, with every break as one mark, in runs of about `most` bytes."""
    held, size = [], 0
    for text in texts:
        at = 0
        text = text.lower().translate(_PLAIN)  # of bytes: A-Z only
        while at < len(text):
            end = len(text)
            if end - at > most:
                end = text.find(_BREAK, at + most) + 1 or len(text)
            held.append(text[at:end])
            size += end - at
            at = end
            if size >= most:
                yield _BREAK.join(held)
                held, size = [], 0
    if held:
        yield _BREAK.join(held)


def _slots(hashes: np.ndarray, words: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    spread = mixed(hashes ^ np.uint64(words))
    return (spread & np.uint64(slots - 1)).astype(np.int64), (
        (spread >> np.uint64(32)) & np.uint64(slots - 1)).astype(np.int64)


def _longer(hashes: np.ndarray, word_hashes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(hashes * np.uint64(0x9FB21C651E98DF25) + word_hashes)


def _word_hashes(lang: str, words: pa.Array) -> np.ndarray:
    """Hashes of words, other ones for each language."""
    _, offsets, data = words.buffers()
    edges = np.frombuffer(offsets, dtype=np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    return run_hashes(raw[:edges[-1]], edges[:-1], edges[1:], xxhash.xxh3_64_intdigest(lang.encode()) >> 1)


def counted(lang: str, chunk: bytes, marks: np.ndarray, step: int, shards: int, longest: int):
    """(phrases, starts, counts) of what this scan counts in the chunk.

    The empty phrase stands for all word occurrences. Phrases are told apart by the words themselves: a word has its
    number in the chunk, a longer phrase that of its first part and of its last word.
    """
    coded = pc.split_pattern(pa.array([chunk.replace(_BREAK, b" \n ").decode()]), " ").flatten().dictionary_encode()
    vocabulary, ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    ids = ids[ids != pc.index(vocabulary, "").as_py()]
    if not len(ids):
        return
    broken = pc.index(vocabulary, "\n").as_py()
    inside = ids != broken
    word_hash = _word_hashes(lang, vocabulary)
    one, other = _slots(word_hash, 1, len(marks))
    reached_word = np.maximum(marks[one], marks[other])
    if broken >= 0:
        reached_word[broken] = UNMARKED
    if step < shards:
        n = np.bincount(ids, minlength=len(vocabulary))
        if broken >= 0:
            n[broken] = 0
        some = np.flatnonzero(n)
        yield pa.array([""]), np.zeros(1, np.int64), np.array([inside.sum()])
        yield vocabulary.take(pa.array(some)), np.zeros(len(some), np.int64), n[some]
    # Of the phrases of one length that begin at each position: their number, hash and the step they are marked from.
    number, reached = ids, reached_word[ids]
    hashes = word_hash[ids]
    for words in range(2, longest + 1):
        if len(reached) < 2:
            return
        start = np.maximum(reached[:-1], reached[1:]).astype(np.int64)
        at = np.flatnonzero(start <= step)
        if not len(at):
            return
        last = ids[at + words - 1]
        _, first, own = np.unique(number[at] * len(vocabulary) + last, return_index=True, return_inverse=True)
        begun = at[first]
        new_hashes = _longer(hashes[begun], word_hash[ids[begun + words - 1]])
        starts = start[begun]
        due = np.flatnonzero(step < starts + shards)
        if len(due):
            n = np.bincount(own, minlength=len(first))[due]
            parts = [vocabulary.take(pa.array(ids[begun[due] + k])) for k in range(words)]
            yield pc.binary_join_element_wise(*parts, " "), starts[due], n
        if words == longest:
            return
        one, other = _slots(new_hashes, words, len(marks))
        # A slot may be marked before the phrase itself begins, by another one.
        marked = np.maximum(np.maximum(marks[one], marks[other]), starts.astype(np.uint8))
        number = np.full(len(start), -1, dtype=np.int64)
        reached = np.full(len(start), UNMARKED, dtype=np.uint8)
        hashes = np.zeros(len(start), dtype=np.uint64)
        number[at], reached[at], hashes[at] = own, marked[own], new_hashes[own]


def _scan(marks, step: int, shards: int, longest: int):
    def run(batches):
        table = np.frombuffer(marks.value, dtype=np.uint8)
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            texts = np.array(text_bytes(batch.column(1)) + [None], dtype=object)[:-1]
            for lang in sorted(set(langs.tolist())):
                for chunk in chunks(texts[langs == lang].tolist()):
                    for phrases, starts, n in counted(lang, chunk, table, step, shards, longest):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(n), pa.string()), phrases,
                             pa.array(starts.astype(np.int32)), pa.array(n.astype(np.int64))],
                            ["lang", "phrase", "start", "n"])
    return run


def _slots_of(slots: int):
    """Both slots of each phrase (`lang, phrase, words`)."""
    def run(batches):
        for batch in batches:
            groups: dict[tuple[str, int], list[str]] = {}
            for lang, phrase, words in zip(*(c.to_pylist() for c in batch.columns)):
                groups.setdefault((lang, words), []).extend(phrase.split(" "))
            found = [np.zeros(0, np.int64)]
            for (lang, words), parts in groups.items():
                hashes = _word_hashes(lang, pa.array(parts, pa.string())).reshape(-1, words)
                value = hashes[:, 0]
                for k in range(1, words):
                    value = _longer(value, hashes[:, k])
                found += _slots(value, words, slots)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], ["slot"])
    return run


def _n_words() -> Column:
    return F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))


def _mark(marks: np.ndarray, reached: DataFrame, step: int) -> bool:
    """Mark the slots of phrases that have reached the threshold from `step` on; whether any is new.

    What comes to the driver is a bitmap of the slots, however many phrases there are.
    """
    slots = reached.select("lang", "phrase", "words").mapInArrow(_slots_of(len(marks)), "slot long")
    maps = slots.groupBy(F.floor(F.col("slot") / _BITS).alias("row")).agg(
        F.bitmap_construct_agg((F.col("slot") % _BITS)).alias("bits"))
    new = False
    for row, bits in maps.collect():
        at = row * _BITS + np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))
        at = at[marks[at] == UNMARKED]
        marks[at] = step
        new = new or len(at) > 0
    return new


def frequent(scratch: Scratch, docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang",
             least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """`lang, phrase, words, n`: all phrases of up to `longest` words with `least` occurrences or more, counted exactly.

    The row with the empty phrase has all word occurrences of its language. Null languages are `und`.
    """
    if not 0 < shards < UNMARKED // (longest + 1) or slots < _BITS or slots & (slots - 1):
        raise ValueError(f"shards must be fewer than {UNMARKED // (longest + 1)}, slots a power of two from {_BITS} on")
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text_col).cast("string").alias("text")).filter("text <> ''")
    scratch.partitioned(rows.withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int")),
                        "shards", "shard")
    marks = np.full(slots, UNMARKED, dtype=np.uint8)
    counts, step, until = None, 0, shards
    while step < until:
        handed = spark.sparkContext.broadcast(marks.tobytes())
        shard = scratch.read("shards", "shard int, lang string, text string").filter(F.col("shard") == step % shards)
        scan = shard.select("lang", "text").mapInArrow(_scan(handed, step, shards, longest), _COUNTS)
        # Where a full cycle is over, what has not reached the threshold is forgotten.
        over = F.col("start") + shards <= step
        both = scan if counts is None else counts.filter(
            ~over | (F.col("n") >= least) | (F.col("phrase") == "")).unionByName(scan)
        # Nearly all phrases are rare: a dictionary of them saves nothing, nor does thorough compression.
        counts = scratch.table(both.groupBy("lang", "phrase").agg(
            F.min("start").cast("int").alias("start"), F.sum("n").alias("n")), f"counts-{step}",
            compression="snappy", **{"parquet.enable.dictionary#phrase": "false"})
        handed.destroy()
        reached = counts.filter(~over & (F.col("n") >= least)).withColumn("words", _n_words()).filter(
            F.col("words").between(1, longest - 1))
        step += 1
        if _mark(marks, reached, step):
            until = step + shards
        if step > 1:
            scratch.drop(f"counts-{step - 2}")
    return counts.filter((F.col("n") >= least) | (F.col("phrase") == "")).select(
        "lang", "phrase", _n_words().alias("words"), "n")


def _exact(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def _part(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(counts: DataFrame, *, most: int | None = 2000, covered: int = COVERED) -> DataFrame:
    """`lang, rank, phrase, a, l, r, n, score` from `frequent`, at most `most` a language, by score.

    A phrase of two words or more with `a` occurrences is cut after each of its words but the last; with `l` and `r`
    occurrences of the two parts a cut scores floor(2000000 a / (l + r)). The lowest cut counts, of equal ones the
    first. A phrase whose words lie side by side in a longer one with `covered` hundredths of its occurrences is
    dropped.
    """
    words = F.split("phrase", " ")
    phrases = counts.filter("words > 0").select("lang", "phrase", F.col("n").alias("f"))
    candidates = counts.filter("words > 1").select("lang", "phrase", F.col("n").alias("a"), words.alias("w"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1))).select(
        "lang", "phrase", "a", "k", _part(F.col("w"), 1, F.col("k")).alias("first"),
        _part(F.col("w"), F.col("k") + 1, F.size("w") - F.col("k")).alias("rest"))
    cuts = cuts.join(phrases.toDF("lang", "first", "l"), ["lang", "first"]).join(
        phrases.toDF("lang", "rest", "r"), ["lang", "rest"])
    scored = cuts.withColumn("score", F.expr(
        "(2000000bd * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("cut"))
    # Each longer phrase tells the phrases inside it how often it occurs.
    inner = candidates.filter(F.size("w") > 2).withColumn(
        "size", F.explode(F.sequence(F.lit(2), F.size("w") - 1))).withColumn(
        "at", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)))
    longer = inner.select("lang", _part(F.col("w"), F.col("at"), F.col("size")).alias("phrase"), "a").groupBy(
        "lang", "phrase").agg(F.max("a").alias("around"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").filter(
        F.col("around").isNull() | (100 * _exact(F.col("around")) < covered * _exact(F.col("cut.a"))))
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("cut.a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order))
    if most is not None:
        ranked = ranked.filter(F.col("rank") <= most)  # Spark keeps so many a task before it moves them
    totals = counts.filter("words = 0").select("lang", "n")
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase",
        *[F.col(f"cut.{c}").alias(c) for c in ("a", "l", "r")], "n", F.col("cut.score").alias("score"))


def phrase_collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                        most: int | None = 2000, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """`collocations` of the phrases of 2 to 4 words in `docs` with at least `least` occurrences, a language each.

    Texts are lower-cased (A-Z), cut into pieces at `.,;:!?` and line ends, and pieces into words at spaces and
    tabs; phrases lie within a piece, overlapping ones count each. A null language is `und`, a null text empty. Repeated
    rows count as often as they occur; ids are not looked at. No phrases give no rows.
    """
    with Scratch(docs.sparkSession) as scratch:
        counts = frequent(scratch, docs, text_col=text_col, lang_col=lang_col, least=least, shards=shards, slots=slots)
        return scratch.result(collocations(counts, most=most))


ORACLE = """
WITH t AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM t),
w AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
g AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
          FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase),
totals AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 30),
cuts AS (
    SELECT c.lang, c.phrase, c.a, j, l.f AS l, r.f AS r,
           (2000000 * CAST(c.a AS HUGEINT)) // (CAST(l.f AS HUGEINT) + r.f) AS score
    FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
    JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:j], ' ')
    JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[j + 1:], ' ')),
lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
    SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS around
    FROM (SELECT *, unnest(range(1, k - s + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS s FROM c WHERE k > 2))
    GROUP BY 1, 2),
ranked AS (
    SELECT lowest.*, row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, a DESC, lowest.phrase) AS rank
    FROM lowest LEFT JOIN inside ON inside.lang = lowest.lang AND inside.phrase = lowest.phrase
    WHERE around IS NULL OR 100 * CAST(around AS HUGEINT) < 80 * CAST(a AS HUGEINT))
SELECT ranked.lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000"""
