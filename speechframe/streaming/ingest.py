"""Continuous ingest and running totals.

Progress lives in the checkpoint location, which belongs in shared storage: a restarted query goes on
after the last finished batch.
"""

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, functions as F

from speechframe.operators.ordinal import running_sum
from speechframe.sources.readers import path_exists


def ingest(stream: DataFrame, sink: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None, available_now: bool = True):
    """Normalise, parse and append to a Parquet table; rows already ingested are not read again."""
    out = transform(stream) if transform else stream
    writer = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start(sink)


LIMIT_REACHED = "batch limit reached"
TOTALS = "rows long, batch_sum double, batch_id long"


def batch_totals(stream: DataFrame, sink: str, checkpoint: str, value: str = "duration", max_batches: int | None = None) -> None:
    """Rows and sum of ``value`` of every micro-batch, written below ``sink`` under its batch id.

    A repeated batch overwrites its own folder. With ``max_batches`` this run handles that many and refuses the next
    one, which marks the last as finished and stays unread for a later run. The run ends with the refusal or the input.
    """
    first: list[int] = []

    def save(batch: DataFrame, batch_id: int) -> None:
        first[:] = first or [batch_id]
        if max_batches is not None and batch_id - first[0] >= max_batches:
            raise RuntimeError(LIMIT_REACHED)
        totals = batch.agg(F.count("*").alias("rows"), F.coalesce(F.sum(value), F.lit(0.0)).alias("batch_sum"))
        totals.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except StreamingQueryException as error:
        if LIMIT_REACHED not in str(error):
            raise


def running_batch_totals(spark, sink: str) -> DataFrame:
    """The written batch totals with their running total; no rows before the first batch."""
    if not path_exists(spark, sink):
        return spark.createDataFrame([], f"{TOTALS}, running_total double")
    totals = spark.read.schema(TOTALS).parquet(sink)
    return running_sum(totals, ["batch_id"], "batch_sum", "running_total")


def max_batches(stream: DataFrame, n: int, sink: str, checkpoint: str, value: str = "duration") -> None:
    """Handle ``n`` micro-batches, then stop."""
    batch_totals(stream, sink, checkpoint, value, max_batches=n)


def dedup(stream: DataFrame, keys, event_time: str | None = None, within: str = "1 day") -> DataFrame:
    """Each key once.

    With an event-time column, once within that time, after which a key's state is dropped; without one
    for the life of the query, which keeps a state entry for every key it has seen.
    """
    if event_time:
        return stream.withWatermark(event_time, within).dropDuplicatesWithinWatermark(list(keys))
    return stream.dropDuplicates(list(keys))


def streaming_counts(stream: DataFrame, column: str) -> DataFrame:
    """Running rows per value; write it in complete or update mode."""
    return stream.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("count"))


def save_counts(counts: DataFrame, sink: str, checkpoint: str) -> None:
    """Run a running count over what has arrived and keep its latest state as a table."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(sink)

    query = counts.writeStream.outputMode("complete").foreachBatch(save)
    query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
