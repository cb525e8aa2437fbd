"""Record files, corpus tables, WAV files and growing folders."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from speechframe.schemas import AUDIO, RECORD
from speechframe.session import ship_package
from speechframe.sources.json_arrays import RANGE_BYTES, read_arrays
from speechframe.sources.wav_codec import decode


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything matches ``path``, on whichever file system it names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = system.globStatus(target)
    return found is not None and len(found) > 0


def read_records(spark: SparkSession, path: str, schema: T.StructType = RECORD, lines: bool = False, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Record files holding a JSON array each, whatever their suffix; ``lines=True`` for JSON lines.

    An array file of more than ``range_bytes`` is read by several tasks. No file gives no rows.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path) if lines else read_arrays(spark, path, schema, range_bytes)


def read_corpus(spark: SparkSession, path: str, columns=None) -> DataFrame:
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def concat_batches(dfs) -> DataFrame:
    """One table of homogeneous parts, older ones may lack columns."""
    first, *rest = dfs
    for part in rest:
        first = first.unionByName(part, allowMissingColumns=True)
    return first


def validate_table(spark: SparkSession, path: str, required=()) -> DataFrame:
    """Rows ``(check, ok)``: the table is there, was finished, and has the required columns."""
    found = path_exists(spark, path)
    checks = [("exists", found), ("finished", path_exists(spark, f"{path}/_SUCCESS"))]
    names = set(spark.read.parquet(path).columns) if found else set()
    checks += [(f"column {c}", c in names) for c in required]
    return spark.createDataFrame(checks, "check string, ok boolean")


def scan_wav(spark: SparkSession, folder: str, names: str = "*.wav", nested: bool = False) -> DataFrame:
    """``(path, audio, error)`` of every WAV file in a folder, with ``nested`` also in folders below it; an unreadable file has null audio, says why and does not fail the scan."""

    def decode_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sounds, errors = [], []
            for content in batch["content"]:
                try:
                    samples, rate = decode(content)
                    sounds.append({"array": samples, "sampling_rate": rate})
                    errors.append(None)
                except Exception as problem:
                    sounds.append(None)
                    errors.append(f"Error: {problem}")
            yield pd.DataFrame({"path": batch["path"], "audio": pd.Series(sounds, index=batch.index, dtype=object), "error": errors})

    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", names).option("recursiveFileLookup", nested).load(folder).select("path", "content")
    return files.mapInPandas(decode_all, T.StructType([T.StructField("path", T.StringType()), T.StructField("audio", AUDIO), T.StructField("error", T.StringType())]))


def stream_records(spark: SparkSession, path: str, schema: T.StructType = RECORD, fmt: str = "json", files_per_batch: int | None = None) -> DataFrame:
    """Growing folder of record files as a stream."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "json":
        reader = reader.option("multiLine", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
