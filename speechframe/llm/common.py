"""What the operators of this folder share: size-checked broadcasts, batch loops and digests."""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from speechframe.session import materialize, ship_package

#: A side is broadcast when it has at most this many narrow rows (ids, words, digests); beyond it the join is shuffled.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint when a count shows at most ``rows`` rows, else unchanged, so that Spark shuffles it.

    For narrow rows of tables that are already written; both ways give the same join.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: Bytes of text that a Python function is given at a time.
PIECE_BYTES = 4 << 20
#: Rows without a doc_id are numbered from here on, above all ids.
NO_ID = 1 << 62


def with_ids(docs: DataFrame) -> DataFrame:
    """``docs`` with a number of its own for each row whose doc_id is null; written once if there is such a row."""
    if not docs.filter(F.col("doc_id").isNull()).limit(1).count():
        return docs
    return materialize(docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID) + F.monotonically_increasing_id())), "numbered")


def without_number(doc_id):
    """A doc_id as it came: null for the numbers of ``with_ids``."""
    return F.when(F.col(doc_id) < NO_ID, F.col(doc_id))


def map_batches(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow``, after the executors have been given this package, which ``fn`` imports there."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


class Recent:
    """A bounded table of what a task has computed. When it is full, the older half goes, but for what is still looked up."""

    def __init__(self, size: int):
        self.half, self.now, self.before = size // 2, {}, {}

    def missing(self, keys: set) -> set:
        """Those of ``keys`` that are to be computed and put in ``now``; the others are in ``now`` afterwards."""
        if len(self.now) > self.half:
            self.before, self.now = self.now, {}
        now, before = self.now, self.before
        new = keys.difference(now)
        if before:
            for k in before.keys() & new:
                now[k] = before[k]
                new.discard(k)
        return new

    def get(self, key, make):
        found = self.now.get(key)
        if found is None:
            if len(self.now) > self.half:
                self.before, self.now = self.now, {}
            found = self.before.get(key)
            if found is None:
                found = make(key)
            self.now[key] = found
        return found


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def pieces(batch: pa.RecordBatch, column: str):
    """The batch in successive pieces with at most ``PIECE_BYTES`` in ``column`` each, or one row."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(upto):
        stop = max(at + 1, int(np.searchsorted(upto, PIECE_BYTES + (upto[at - 1] if at else 0), side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def per_text(fn, schema, begin=None, id_col="doc_id", text_col="text"):
    """A ``mapInArrow`` function that calls ``fn(ids, texts)`` on lists and yields the dict of columns that it returns.

    With ``begin``, what it returns at the start of a task is handed over third, and goes with the task.
    A null text is handed over as an empty one. Columns of ``schema`` that ``fn`` does not return are passed on as they came. Batches
    are cut into pieces of at most ``PIECE_BYTES`` of text (a longer text comes alone), which bounds what ``fn`` holds at a time. What
    Arrow has no more use for goes back to the machine after each piece, as workers wait beside other stages with what they last held.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches):
        own = [begin()] if begin else []
        for batch in (piece for whole in batches for piece in pieces(whole, text_col)):
            ids, texts = batch.column(id_col), batch.column(text_col).to_pylist()
            out = fn(ids.to_pylist(), [t if t is not None else "" for t in texts], *own)
            yield pa.RecordBatch.from_pydict({f.name: out[f.name] if f.name in out else batch.column(f.name) for f in arrow}, schema=arrow)
            del batch, ids, texts, out
            pa.default_memory_pool().release_unused()

    return run
