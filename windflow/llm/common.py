"""What the text operators share: tables in the shared folder, word hashing, batches.

The operators are jobs: they write intermediate tables to the folder all executors share, so a lost
executor costs a task and not the lineage, and they remove these tables once the result is written.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Text handed to numpy at once: arrays of eight bytes a byte then stay within tens of megabytes.
CHUNK_BYTES = 1 << 19


def shared_root(spark: SparkSession) -> str:
    """The folder named in `spark.checkpoint.dir`; a temporary one only where Spark is one process."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isDefined():
            return held.get()
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that every executor can reach")
        named = tempfile.mkdtemp(prefix="windflow-llm-")
        spark.sparkContext.setCheckpointDir(named)
        return spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return named.rstrip("/")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables of one run in the shared folder, removed when the run ends; `result` outlives it."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{shared_root(spark)}/llm-{uuid.uuid4().hex}"
        if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
            spark.sparkContext.setCheckpointDir(shared_root(spark))

    def __enter__(self) -> Scratch:
        return self

    def table(self, df: DataFrame, name: str, compression: str = "zstd", **options: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        # The table stands for its shuffles from now on: Spark may remove their files when it is written.
        before = self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.mode("overwrite").option("compression", compression).options(**options).parquet(path)
        finally:
            self.spark.conf.set(_CLEANUP, before) if before else self.spark.conf.unset(_CLEANUP)
        return self.spark.read.schema(df.schema).parquet(path)

    def partitioned(self, df: DataFrame, name: str, column: str) -> None:
        """A table in a folder for each value of `column`, for `read`."""
        df.write.partitionBy(column).option("compression", "zstd").parquet(f"{self.folder}/{name}")

    def read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def result(self, df: DataFrame) -> DataFrame:
        """`df`, computed now and kept as a checkpoint."""
        return df.checkpoint(eager=True)

    def drop(self, name: str = "") -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __exit__(self, *failure) -> None:
        self.drop()


def texts_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`doc_id` (long) and `text` (string); whatever else the table holds is left behind."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.col(text_col).cast("string").alias("text"))


def over_batches(work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch | None],
                 ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`work` for `mapInArrow`, a slice of a batch at a time so that memory follows `CHUNK_BYTES`."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                made = work(part)
                if made is None:
                    continue
                yield from ([made] if isinstance(made, pa.RecordBatch) else made)
    return run


def slices(batch: pa.RecordBatch, column: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold about `most` bytes; a longer text is a run alone."""
    if not batch.num_rows:
        return
    at = batch.schema.get_field_index(column)
    if at < 0:
        yield batch
        return
    sizes = np.array([0 if v is None else v for v in
                      pc.binary_length(batch.column(at)).to_pylist()], dtype=np.int64)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    yield batch.slice(start)


def text_bytes(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8; null counts as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if v is None else v for v in column.cast(kind).to_pylist()]


# Prefix sums of a polynomial over hashed items: stretches of any length are read off in one pass.

_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        _powers.clear()
        with np.errstate(over="ignore"):
            up = np.full(size, _BASE, dtype=np.uint64)
            up[0] = 1
            down = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
            down[0] = 1
            _powers[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[size]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, one to one."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def run_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each stretch of bytes: equal stretches have equal ones.

    Blocks of eight bytes are mixed with keys that depend on their place and on the seed, and added up.
    """
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sizes = (ends - starts).astype(np.int64)
    blocks = np.maximum(1, (sizes + 7) >> 3)
    first = np.cumsum(blocks) - blocks
    place = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    rest = np.repeat(sizes, blocks) - 8 * place
    eight = np.ndarray(shape=(len(raw) + 1,), dtype="<u8", buffer=raw.tobytes() + b"\0" * 8, strides=(1,))
    value = eight[np.minimum(np.repeat(starts, blocks) + 8 * place, len(raw))]
    value &= _LOW_BYTES[np.minimum(rest, 8)]
    key = mixed(np.arange(2 * int(blocks.max()), dtype=np.uint64) + mixed(np.array([seed + 1], dtype=np.uint64)))
    with np.errstate(over="ignore"):
        value = mixed((value ^ key[2 * place]) * (key[2 * place + 1] | np.uint64(1)))
        return mixed(np.add.reduceat(value, first) + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class Words:
    """The words of several texts laid end to end: where each begins and ends, its hash, its text.

    `text_of[i]` is the text of word i and `first[t]` the first word of text t (one more at the end).
    """

    def __init__(self, texts: list[bytes]):
        self.buffer = b"\n".join(texts) + b"\n"
        raw = np.frombuffer(self.buffer, dtype=np.uint8)
        space = SPACE[raw]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        inside = ~space[0]
        self.starts = edge[1::2] if inside else edge[0::2]
        self.ends = edge[0::2] if inside else edge[1::2]
        if inside:
            self.starts = np.concatenate([[0], self.starts])
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
        stops = np.cumsum(lengths)
        self.first = np.searchsorted(self.starts, np.concatenate([[0], stops])).astype(np.int64)
        self.text_of = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self._raw = raw

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64-bit hashes: equal words have equal ones."""
        return run_hashes(self._raw, self.starts, self.ends, seed)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of `n` items; the last n - 1 positions have none."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(len(hashes) - n + 1, dtype=np.uint64)
        for k in range(n):
            total = total * np.uint64(0x9FB21C651E98DF25) + hashes[k:len(hashes) - n + 1 + k]
        return mixed(total)


def list_array(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
