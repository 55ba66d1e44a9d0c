"""Bank transfers: one transfer, two lines, both or neither.

The sender's line goes to the credits topic and the receiver's to the debits topic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windflow.functions.text import amount_label
from windflow.schemas import TOPICS

COMMITTED, ABORTED = "committed", "aborted"


def transfer_lines(transfers: DataFrame) -> DataFrame:
    """Two rows per transfer: `topic, key, value`, beside the transfer's other columns."""
    label = amount_label(F.col("amount"), F.col("is_suspicious"))
    kept = [c for c in transfers.columns
            if c not in ("sender_account", "receiver_account", "amount")]
    return transfers.select(*kept, F.stack(
        F.lit(2),
        F.lit(TOPICS["credits"]), F.col("sender_account"), label,
        F.lit(TOPICS["debits"]), F.col("receiver_account"), label,
    ).alias("topic", "key", "value"))


def transfer_ledger(transfers: DataFrame, offset: str = "offset") -> DataFrame:
    """The lines with the outcome of their transaction.

    Both lines of a transfer share `txn_state`: a flagged transfer is aborted, but it is consumed
    all the same. `next_offset` is the input position committed with it, the one to read next.
    """
    state = F.when(F.col("is_suspicious"), ABORTED).otherwise(COMMITTED)
    return (transfer_lines(transfers).withColumn("txn_state", state)
            .withColumn("next_offset", F.col(offset) + 1).drop("is_suspicious"))


def committed_only(lines: DataFrame) -> DataFrame:
    """What a reader sees that waits for commits."""
    return lines.filter(F.col("txn_state") == COMMITTED)
