"""Totals in state and rejected rows, after a restart and after a repeated batch."""

import shutil

from pyspark.sql import functions as F

from speechframe.sources.readers import stream_records
from speechframe.streaming import state


def write(spark, folder, rows):
    spark.createDataFrame(rows, "id long, kind string, value double").coalesce(1).write.mode("append").parquet(f"{folder}")


def totals(spark, source, place):
    schema = spark.createDataFrame([], "id long, kind string, value double").schema
    stream = stream_records(spark, source, schema, "parquet", 1)
    state.save_batches(state.running_totals(stream, "kind", "value", "id", slots=2), f"{place}/sink", f"{place}/ck")
    return {r.key: (r.rows, r.total) for r in state.latest_totals(spark.read.parquet(f"{place}/sink")).collect()}


def test_totals_go_on_after_a_restart(spark, tmp_path):
    source = f"{tmp_path}/in"
    write(spark, source, [(i, "ab"[i % 2], float(i)) for i in range(10)])
    assert totals(spark, source, tmp_path) == {"a": (5, 20.0), "b": (5, 25.0)}
    write(spark, source, [(10, "a", 1.0), (11, None, 2.0), (12, "a", None)])
    assert totals(spark, source, tmp_path) == {"a": (7, 21.0), "b": (5, 25.0), None: (1, 2.0)}
    # the last batch is run again, as after a lost driver: its commit is gone, its output may be there
    last = max((tmp_path / "ck" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (tmp_path / "ck" / "commits" / f".{last.name}.crc").unlink(missing_ok=True)
    assert totals(spark, source, tmp_path) == {"a": (7, 21.0), "b": (5, 25.0), None: (1, 2.0)}


def test_good_and_rejected_are_all_that_was_read(spark, tmp_path):
    source = f"{tmp_path}/in"
    write(spark, source, [(i, str(i) if i % 3 else "x", float(i)) for i in range(20)])
    schema = spark.createDataFrame([], "id long, kind string, value double").schema

    def split(batch):
        ok = F.col("kind").try_cast("int").isNotNull()
        return batch.where(ok), batch.where(~ok)

    def run():
        state.ingest_checked(stream_records(spark, source, schema, "parquet", 1), split, f"{tmp_path}/sink", f"{tmp_path}/ck")
        return [sorted(r.id for r in spark.read.parquet(f"{tmp_path}/sink/{name}").collect()) for name in ("good", "rejected")]

    want = [[i for i in range(20) if i % 3], [i for i in range(20) if not i % 3]]
    assert run() == want
    shutil.rmtree(f"{tmp_path}/ck/commits")  # the batch is repeated as a whole
    assert run() == want
