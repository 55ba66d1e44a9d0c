"""Key hashes and partition choice."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The public 32-bit MurmurHash2 constants and the client library's seed.
_SEED = 0x9747B28C
_M = 0x5BD1E995

HEAVY_PREFIX = "HeavyProducer_"
HEAVY_PARTITIONS = 4


def md5_hash(key: Column) -> Column:
    """The first 32 bits of the key's md5: never negative, the same in every SQL engine."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def _murmur2_udf():
    # Defined inside a function, so it travels to the workers by value.
    def murmur2_of(keys: pa.Array) -> pa.Array:
        """All keys of an Arrow batch at once: round i mixes in the i-th four bytes of each."""
        data = keys.fill_null("").cast(pa.large_binary())
        ends = np.frombuffer(data.buffers()[1], np.int64)[data.offset:data.offset + len(data) + 1]
        # Four bytes of padding let every gather read past the last key.
        text = np.frombuffer(data.buffers()[2] or b"", np.uint8)
        text = np.append(text, np.zeros(4, np.uint8)).astype(np.uint32)
        start, length = ends[:-1], np.diff(ends)
        m = np.uint32(_M)

        def gather(at: np.ndarray, count: np.ndarray) -> np.ndarray:
            """The `count` bytes from `at` on as a number, lowest byte first."""
            word = text[at]
            for k in (1, 2, 3):
                word |= np.where(count > k, text[at + k], 0).astype(np.uint32) << np.uint32(8 * k)
            return word

        h = np.uint32(_SEED) ^ length.astype(np.uint32)
        for i in range(int(length.max(initial=0)) // 4):
            rows = np.flatnonzero(length >= 4 * (i + 1))
            k = gather(start[rows] + 4 * i, np.int64(4)) * m
            h[rows] = (h[rows] * m) ^ ((k ^ (k >> np.uint32(24))) * m)
        rest = length % 4
        rows = np.flatnonzero(rest)
        h[rows] = (h[rows] ^ gather((start + length - rest)[rows], rest[rows])) * m
        h = (h ^ (h >> np.uint32(13))) * m
        h = h ^ (h >> np.uint32(15))
        return pa.array(h.view(np.int32), mask=keys.is_null().to_numpy(zero_copy_only=False))

    return F.arrow_udf(murmur2_of, "int")


def murmur2(key: Column) -> Column:
    """The signed 32-bit hash that the usual client library gives a key's UTF-8 bytes.

    Spark has no such function. As a column expression over single bytes it took five times as
    long as this Arrow function over whole batches.
    """
    return _murmur2_udf()(key)


HASHES = {"md5": md5_hash, "murmur2": murmur2}


def _absolute(key: Column, hash_name: str) -> Column:
    # Taken as a 64-bit number, the absolute value exists for the smallest integer too.
    return F.abs(HASHES[hash_name](key).cast("bigint"))


def default_partition(key: Column, partitions: int) -> Column:
    """The partition the client library picks by default: the hash without its sign bit."""
    return F.pmod(murmur2(key).cast("bigint").bitwiseAND(F.lit(0x7FFFFFFF)),
                  F.lit(partitions)).cast("int")


def heavy_partition(key: Column, partitions: int, heavy: int = HEAVY_PARTITIONS,
                    prefix: str = HEAVY_PREFIX, hash_name: str = "murmur2") -> Column:
    """Keys starting with `prefix` spread over the first `heavy` partitions, others over the rest.

    Null keys have no partition (null): send them to a reject output.
    """
    if not isinstance(partitions, int) or not isinstance(heavy, int):
        raise ValueError("partition counts must be whole numbers")
    if heavy < 1:
        raise ValueError("at least one partition must be reserved")
    if partitions <= heavy:
        raise ValueError(f"the topic needs more than {heavy} partitions, it has {partitions}")
    h = _absolute(key, hash_name)
    return (F.when(key.isNull(), F.lit(None))
            .when(key.startswith(prefix), F.pmod(h, F.lit(heavy)))
            .otherwise(F.lit(heavy) + F.pmod(h, F.lit(partitions - heavy)))).cast("int")
