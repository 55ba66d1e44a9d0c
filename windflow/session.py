"""Session settings every windflow job runs with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

# What jobs with state processors need; `status_job` sets it for itself, whatever the session has.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Only what the operators rely on. Shuffles start wide and adaptive execution merges what is small.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    **STATE_STORE,
    # Python state processors then talk through a socket file instead of a TCP port.
    "spark.python.unix.domain.socket.enabled": "true",
}

SMALL_PARTITION, LARGE_PARTITION = 128 << 20, 1 << 30
MOST_PARTITIONS = 100_000


def settings_for(shuffled_bytes: int, cores: int) -> dict[str, str]:
    """`SETTINGS` plus a first shuffle width for jobs whose largest shuffle moves so many bytes.

    Partitions hold 128 MiB, growing up to 1 GiB once there would be more than 100 000 of them
    (every map task writes a block per partition), and there are at least two per core. Adaptive
    execution merges what turns out too small and splits what is skewed.
    """
    size = min(max(SMALL_PARTITION, shuffled_bytes // MOST_PARTITIONS), LARGE_PARTITION)
    width = max(2 * cores, -(-shuffled_bytes // size))
    return SETTINGS | {
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(size),
    }


def build_session(app: str, master: str | None = None, shuffled_bytes: int = 1 << 40, cores: int = 64,
                  **overrides: str) -> SparkSession:
    """A session with `settings_for` a job of that size; further settings as `**{"spark.x": "y"}`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in (settings_for(shuffled_bytes, cores) | overrides).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, fallback: Callable[[], str] | None = None) -> str:
    """The folder all executors see, named by the cluster in `spark.checkpoint.dir`.

    Where the session names none and runs in one process (tests), `fallback` makes one, which is
    set on the session. On a cluster a missing name is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if fallback is None or spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that every executor can reach")
        named = fallback()
        spark.sparkContext.setCheckpointDir(named)
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")
