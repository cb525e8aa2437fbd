"""Running totals kept in state, and rejected rows beside good ones.

State lives below the checkpoint location. It is versioned by batch, so a restarted query goes on with it and a repeated batch
finds the state as it was before.
"""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from speechframe.session import ship_package

# A key's total is kept in so many parts, so that a frequent key is not one task's work.
SLOTS = 8


def _add_to_total(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Adds a batch's rows and values to those of the key and slot so far."""
    n, added = 0, 0.0
    for part in parts:
        n, added = n + len(part), added + float(part["value"].sum())
    before = state.get if state.exists else (0, 0.0)
    now = (before[0] + n, before[1] + added)
    state.update(now)
    yield pd.DataFrame({"key": [key[0]], "slot": [key[1]], "rows": [n], "batch_sum": [added], "running_rows": [now[0]], "running_total": [now[1]]})


def running_totals(stream: DataFrame, by: str, value: str, spread: str, slots: int = SLOTS) -> DataFrame:
    """(key, slot, rows, batch_sum, running_rows, running_total) of every key and slot that a batch has rows of.

    ``spread`` tells the rows of a key apart. The total of a key is the sum of its slots' last totals (:func:`latest_totals`).
    """
    ship_package(stream.sparkSession)
    keyed = stream.select(F.col(by).cast("string").alias("key"), F.pmod(F.xxhash64(spread), F.lit(slots)).cast("int").alias("slot"), F.col(value).cast("double").alias("value"))
    out = "key string, slot int, rows long, batch_sum double, running_rows long, running_total double"
    return keyed.groupBy("key", "slot").applyInPandasWithState(_add_to_total, out, "rows long, total double", "update", GroupStateTimeout.NoTimeout)


def save_batches(rows: DataFrame, sink: str, checkpoint: str, mode: str = "update") -> None:
    """Write what every batch gives below ``sink`` under its batch id, until all that is there is read; a repeated batch replaces its own folder."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    query = rows.writeStream.outputMode(mode).foreachBatch(save).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()


def latest_totals(saved: DataFrame) -> DataFrame:
    """(key, rows, total) after the last batch, from the saved rows of :func:`running_totals`."""
    last = saved.groupBy("key", "slot").agg(F.max_by(F.struct("running_rows", "running_total"), "batch_id").alias("t"))
    return last.groupBy("key").agg(F.sum("t.running_rows").alias("rows"), F.sum("t.running_total").alias("total"))


def ingest_checked(stream: DataFrame, split: Callable[[DataFrame], tuple[DataFrame, DataFrame]], sink: str, checkpoint: str) -> None:
    """Write the good and the rejected rows of every batch below ``sink/good`` and ``sink/rejected`` under its batch id.

    ``split`` gives (good, rejected) of a batch. Both belong to the batch: one that is repeated replaces both.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # both come from one reading
        try:
            for name, rows in zip(("good", "rejected"), split(batch)):
                rows.write.mode("overwrite").parquet(f"{sink}/{name}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
