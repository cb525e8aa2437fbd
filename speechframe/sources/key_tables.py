"""Tables in buckets of a key, which later jobs join with on that key without moving them again.

A table is a folder of Parquet files and a note of its layout beside it, so it can be opened by any session that reads the
folder; nothing stays in the session's catalog.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def _bucketed(df: DataFrame, path: str, keys, buckets: int, mode: str = "overwrite", order=()) -> None:
    name = f"bucketed_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").mode(mode).option("path", path).bucketBy(buckets, *keys)
    (writer.sortBy(*order) if order else writer).saveAsTable(name)
    # the table is external: its files stay
    df.sparkSession.sql(f"DROP TABLE {name}")


def open_buckets(spark: SparkSession, path: str, schema, keys, buckets: int) -> DataFrame:
    """The bucketed files below ``path``; its rows are known to be dealt out by ``keys``."""
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
    table = spark.table(name)
    table.schema  # resolved here, so that the name is not needed any more
    spark.sql(f"DROP TABLE {name}")
    return table


def in_buckets(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """``df`` written once, dealt out to files by ``key`` where its rows are, and read again."""
    _bucketed(df, path, [key], buckets)
    return open_buckets(df.sparkSession, path, df.schema, [key], buckets)


def write_key_table(df: DataFrame, path: str, keys, buckets: int | None = None) -> None:
    """Write ``df`` once in ``buckets`` of ``keys``, as many as a shuffle has partitions by default."""
    spark, keys = df.sparkSession, list(keys)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # dealt out before writing, so that each bucket is one file
    _bucketed(df.repartition(buckets, *keys), f"{path}/rows", keys, buckets, order=keys)
    note = spark.range(1).select(F.array(*map(F.lit, keys)).alias("keys"), F.lit(buckets).alias("buckets"), F.lit(df.schema.json()).alias("schema"))
    note.write.mode("overwrite").parquet(f"{path}/layout")


def read_key_table(spark: SparkSession, path: str) -> DataFrame:
    """A table written by :func:`write_key_table`."""
    import json

    from pyspark.sql.types import StructType

    note = spark.read.parquet(f"{path}/layout").first()
    return open_buckets(spark, f"{path}/rows", StructType.fromJson(json.loads(note.schema)), note["keys"], note.buckets)
