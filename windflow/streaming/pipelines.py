"""The streaming jobs of the wind farm and the bank, ready to run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from windflow.functions.codecs import Codec, decode_json, decoded, rejects
from windflow.operators.aggregates import average_by_key
from windflow.operators.joins import Joiner, WITH_MASTER_DATA, join_stream_table, join_within
from windflow.operators.ledger import transfer_ledger
from windflow.operators.outbox import maintenance_log, outbox_events, require_outbox_rows
from windflow.operators.routing import route_wind
from windflow.operators.windows import final_windows_native, with_energy
from windflow.schemas import READING, TRANSFER, struct_of
from windflow.session import STATE_STORE
from windflow.streaming.jobs import BatchFunction, checkpoint_of, run_job
from windflow.streaming.sinks import BatchLog, ChangelogTable
from windflow.streaming.slots import Slots
from windflow.streaming.table_join import join_table_streams


def _sides(out: BatchLog, batch: DataFrame, codec: Codec) -> dict[str, DataFrame]:
    """The unreadable records, for logs that have an output for them."""
    return {"rejects": rejects(batch, codec)} if "rejects" in out.sides else {}


def averages_job(readings: DataFrame, key: str, sink: str | BatchFunction, name: str = "averages",
                 **options) -> StreamingQuery:
    """Running averages: every micro-batch emits the updated row of each key it touched."""
    averages = average_by_key(readings, key, "current_power")
    return run_job(averages, name, sink, output_mode="update", **options)


def routing_job(log: DataFrame, out: BatchLog, name: str = "wind-analyzer", **options) -> StreamingQuery:
    """Readings routed to the topics of little and much wind, both written in one pass.

    Give `out` a side output `rejects` (`sinks.REJECTS`) to keep what is no reading.
    """
    codec = Codec(READING)

    def write(batch: DataFrame, batch_id: int) -> None:
        routed = route_wind(decoded(batch, codec).drop("topic"))
        out.write(routed.withColumn("value", codec.encode()), batch_id, source=batch, **_sides(out, batch, codec))

    return run_job(log, name, write, **options)


def energy_job(readings: DataFrame, sink: str | BatchFunction, size: str = "1 minute",
               grace: str = "0 seconds", name: str = "turbine-energy",
               **options) -> StreamingQuery:
    """Energy per turbine and window, emitted once, after the window has closed.

    Late records are judged by Spark's watermark. For the exact rule give `ExactFinalWindows` to
    `run_job` and take `with_energy` of its results.
    """
    averages = final_windows_native(readings, "wind_turbine_id", "timestamp", "current_power", size, grace)
    return run_job(with_energy(averages, size), name, sink, **options)


def weather_job(readings: DataFrame, weather: DataFrame, key: str, sink: str | BatchFunction,
                within: str = "20 seconds", delay: str = "0 seconds", name: str = "wind-weather-joiner",
                **options) -> StreamingQuery:
    """Readings with the weather within `within` of them; rows may come `delay` late."""
    pairs = join_within(readings.withWatermark("timestamp", delay), weather.withWatermark("timestamp", delay),
                        key, "timestamp", "timestamp", within)
    return run_job(pairs, name, sink, **options)


def status_job(status: DataFrame, masters: DataFrame, sink: str | BatchFunction, key: str = "key",
               status_tombstone: Column | None = None, master_tombstone: Column | None = None,
               name: str = "wind-status-joiner", **options) -> StreamingQuery:
    """The status table with master data: each key's row anew whenever either side changes."""
    joined = join_table_streams(status, masters, key, left_tombstone=status_tombstone,
                                right_tombstone=master_tombstone)
    return run_job(joined, name, sink, output_mode="update", settings=STATE_STORE, **options)


def transfers_job(log: DataFrame, out: BatchLog, name: str = "transfers-to-ledger",
                  **options) -> StreamingQuery:
    """Transfers to credit and debit lines, committed with the input position they came from, and with
    what is no transfer if `out` has a side output `rejects`."""
    codec = Codec(TRANSFER, java_defaults=True)

    def write(batch: DataFrame, batch_id: int) -> None:
        transfers = decoded(batch, codec).drop("topic", "key")
        out.write(transfer_ledger(transfers), batch_id, source=batch, **_sides(out, batch, codec))

    return run_job(log, name, write, **options)


def follow_job(spark: SparkSession, log: BatchLog, write: BatchFunction, name: str = "follower",
               **options) -> StreamingQuery:
    """Consume a `BatchLog` as a stream: each committed batch once, uncommitted ones never.

    Only the small commit files are streamed. A follower has one position, the last batch it has delivered, kept
    beside its checkpoint; a commit that it sees makes it deliver all batches from there to the last committed
    one, from segments or folders of their own, whichever they lie in by then.
    """
    place = checkpoint_of(spark.range(0), name, options.pop("checkpoint", None))
    slots, kept = Slots(f"{place}/position"), struct_of("batch_id BIGINT, upto BIGINT")

    def deliver(commits: DataFrame, batch_id: int) -> None:
        session = commits.sparkSession
        before = slots.left_by(session, "upto", batch_id - 1, kept).first()
        after = slots.again(session, "upto", batch_id, kept)
        if after is None:  # not a repeat of a delivery that failed
            after = slots.write(session.createDataFrame([(batch_id, log.last(session))], kept), "upto", batch_id).first()
        done = -1 if before is None else before["upto"]
        if after["upto"] > done:
            ours = (F.col("batch_id") > done) & (F.col("batch_id") <= after["upto"])
            write(log.read(session).filter(ours), batch_id)

    return run_job(log.stream_commits(spark), name, deliver, checkpoint=place, **options)


def table_job(log: DataFrame, codec: Codec, table: ChangelogTable, name: str,
              **options) -> StreamingQuery:
    """Keep a keyed table up to date from its changelog topic; a null payload deletes its key. What is no
    record goes to `table.changes`, side output `rejects`."""
    def write(batch: DataFrame, batch_id: int) -> None:
        good = decode_json(batch, codec).filter(F.col("state") != "rejected")
        table.upsert(good.select("key", "offset", "record.*", "state"), batch_id,
                     F.col("state") == "tombstone", **_sides(table.changes, batch, codec))

    return run_job(log, name, write, **options)


def enrich_job(records: DataFrame, read_table: Callable[[], DataFrame], key: str,
               write: BatchFunction, joiner: Joiner = WITH_MASTER_DATA,
               name: str = "readings-enricher", **options) -> StreamingQuery:
    """Records with the table row of their key as of their micro-batch.

    `read_table` is called once per micro-batch: a table read only when the job starts would never
    show rows added later.
    """
    def enrich(batch: DataFrame, batch_id: int) -> None:
        write(join_stream_table(batch, read_table(), key, joiner), batch_id)

    return run_job(records, name, enrich, **options)


def maintenance_job(work: DataFrame, identity: list[str], out: BatchLog, name: str = "maintenance",
                    **options) -> StreamingQuery:
    """Log rows and their outbox events, the latter in the side output `events`: one commit for both.

    `work` must carry its `date`: a clock read here would give a replayed batch other rows.
    """
    if "date" not in work.columns:
        raise ValueError("work reports need a date column")

    def write(batch: DataFrame, batch_id: int) -> None:
        log = maintenance_log(batch)
        out.write(log, batch_id, events=require_outbox_rows(outbox_events(log, identity)))

    return run_job(work, name, write, **options)
