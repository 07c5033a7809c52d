"""Scenario records as a stream: decode, fan out, keep state."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hourgrid.operators import scenarios
from hourgrid.sources.messages import stream_batches

__all__ = ["stream_batches", "once", "fan_out", "write_records", "stream_name", "log_updates", "read_state", "compact_state"]


def once(records: DataFrame, delay: str, message: str = "messageId", sent: str = "sentAt") -> DataFrame:
    """Every message a single time, however often and in whichever batches it is delivered.

    Message ids are kept in the state store until the watermark, the latest time sent less ``delay``, has passed them;
    ``delay`` is as long as a queue may deliver a message again, its retention.  Messages without a time sent are kept for
    that long after the first one of the stream.
    """
    timed = records.withColumn(sent, F.coalesce(F.col(sent), F.lit(0).cast("timestamp"))).withWatermark(sent, delay)
    return timed.dropDuplicatesWithinWatermark([message])


def fan_out(records: DataFrame, plans: DataFrame, plan_field: str = "investmentPath") -> DataFrame:
    """Stream-static join: one record per scenario and plan of its year."""
    return scenarios.fan_out(records, plans, plan_field)


def write_records(records: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append records to a parquet table, exactly once."""
    writer = records.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_name(checkpoint: str) -> str:
    """Name of a stream in the log: a stream that starts over with another checkpoint is another stream."""
    return "s" + hashlib.sha256(checkpoint.rstrip("/").encode("utf-8")).hexdigest()[:16]


def log_updates(
    updates: DataFrame, path: str, checkpoint: str, key: Sequence[str], order: Sequence[str], available_now: bool = True
) -> StreamingQuery:
    """Append the state updates of every batch to a log.

    A batch is written to a folder of its own, named by the stream and its number, and a
    repeated batch overwrites that folder, so redelivery changes nothing.  A stream that
    starts over with a new checkpoint has another name, so it leaves the old log alone.
    The cost of a batch is the batch, not the state table.
    """
    stream = stream_name(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        # the same update may be delivered twice inside one batch; updates that differ are all kept
        batch.dropDuplicates().write.mode("overwrite").parquet(f"{path}/stream={stream}/batch_id={batch_id}")

    writer = updates.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_state(
    base: DataFrame, path: str, key: Sequence[str], overwrite: Sequence[str], order: Sequence[str],
    after: Mapping[str, int] | None = None,
) -> DataFrame:
    """State table: the base with the logged updates applied in ``order``, the position of a record itself.

    The batch that a record comes in is no part of it, so a record that is delivered again later changes nothing; only
    records at the same position go by their batch.  ``after`` names for each stream the last batch that the base holds
    already: a base does not know the positions it was made of, so what is delivered again after it was made counts as new.
    ``state.apply`` keeps positions.
    """
    log = base.sparkSession.read.parquet(path)
    for stream, batch_id in (after or {}).items():
        log = log.where((F.col("stream") != stream) | (F.col("batch_id") > batch_id))
    return scenarios.upsert(base, log, key, overwrite, [*order, "batch_id"])


def compact_state(spark: SparkSession, state: DataFrame, path: str) -> DataFrame:
    """Write the state as a new base and read it back."""
    state.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
