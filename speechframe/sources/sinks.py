"""Writers: records, tables, splits, WAV files, training exports and statistics."""

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, functions as F

from speechframe.functions.scalars import fmt_padded, strip
from speechframe.operators.filters import DESCRIPTION_CHARS
from speechframe.operators.ordinal import with_ordinal
from speechframe.operators.records import TRAINING_FORMATS
from speechframe.session import ship_package
from speechframe.sources.wav_codec import encode

# Rows of a table that carries audio are large: keep its files to this many.
AUDIO_ROWS_PER_FILE = 10_000


def write_records(df: DataFrame, path: str) -> None:
    """Records as JSON lines; null optional keys are left out."""
    df.write.mode("overwrite").json(path)


def write_record_arrays(df: DataFrame, path: str, files: int | None = None) -> None:
    """Records as files that hold one JSON array each, in as many files as there are partitions, or ``files``."""

    def bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = "["
        for batch in batches:
            lines = []
            for value in batch.column("value").to_pylist():
                lines.append(lead + value)
                lead = ","
            yield pa.RecordBatch.from_pydict({"value": pa.array(lines, pa.string())})
        yield pa.RecordBatch.from_pydict({"value": ["]" if lead == "," else "[]"]})

    rows = (df.repartition(files) if files else df).select(F.to_json(F.struct(*df.columns)).alias("value"))
    ship_package(df.sparkSession)
    rows.mapInArrow(bracketed, "value string").write.mode("overwrite").text(path)


def write_corpus(df: DataFrame, path: str, measured: bool = False) -> None:
    """Overwrite a table. ``measured`` adds the length of the stripped description, which a scan can filter on."""
    if measured:
        df = df.withColumn(DESCRIPTION_CHARS, F.length(strip("voice_description")))
    df.drop("audio_array").write.mode("overwrite").option("maxRecordsPerFile", AUDIO_ROWS_PER_FILE).parquet(path)


def write_splits(df: DataFrame, path: str) -> None:
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", AUDIO_ROWS_PER_FILE)
    writer.partitionBy("split").parquet(path)


def write_stats(df: DataFrame, path: str) -> None:
    """Statistics are a few long rows: one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def export_training(df: DataFrame, path: str, fmt: str = "instruction") -> int:
    """Write the training rows as JSON lines and return how many."""
    if fmt not in TRAINING_FORMATS:
        raise ValueError(f"Unknown format type: {fmt}. Available: {list(TRAINING_FORMATS)}")
    written = Observation("training rows")
    rows = TRAINING_FORMATS[fmt](df).observe(written, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").json(path)
    return written.get["rows"]


def wav_name() -> Column:
    """'{dataset}_{idx}_{speaker_id}.wav' without the characters that some file systems reject."""
    return F.concat(F.regexp_replace(F.concat_ws("_", "dataset", F.col("idx").cast("string"), "speaker_id"), r'[:/\\*?"<>|]', "_"), F.lit(".wav"))


def write_wav(df: DataFrame, folder: str, file_name: Column | None = None, key: str = "idx") -> DataFrame:
    """Write one WAV per row below ``folder`` and return the manifest ``(idx, path, error)``.

    ``folder`` is a URI every executor can reach. A file's name and bytes follow from its row and it is
    moved into place when complete, so a repeated task only writes the same file again.
    The files are written when the manifest is computed.
    """

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        for batch in batches:
            paths, errors = [], []
            for name, samples, rate in zip(batch["name"], batch["array"], batch["sampling_rate"]):
                target, error = f"{root}/{name}", None
                try:
                    part = f"{root}/.{uuid.uuid4().hex}.part"
                    with system.open_output_stream(part) as out:
                        out.write(encode(samples, rate))
                    try:
                        system.move(part, target)
                    except OSError:
                        # some file systems do not replace: an older file of this name gives way
                        if system.get_file_info(target).type == fs.FileType.NotFound:
                            raise
                        system.delete_file(target)
                        system.move(part, target)
                except Exception as problem:
                    error = f"Error: {problem}"
                paths.append(target if error is None else None)
                errors.append(error)
            yield pd.DataFrame({"idx": batch["idx"], "path": paths, "error": errors})

    name = wav_name() if file_name is None else file_name
    rows = df.select(F.col(key).alias("idx"), name.alias("name"), "audio.array", "audio.sampling_rate")
    ship_package(df.sparkSession)
    return rows.mapInPandas(save, "idx long, path string, error string")


# File name prefix and metadata columns of the two export forms.
EXPORTS = {
    "source": ("voice_", "audio_file", ["speaker_id", "transcript", "duration", "gender", "age", "accent", "voice_description"]),
    "filtered": ("audio_", "audio_path", ["transcript", "speaker_id", "voice_description"]),
}


def subset_manifest(df: DataFrame, predicate: Column, numbering: str = "source", key: str = "idx") -> DataFrame:
    """The rows that meet ``predicate`` with their file name and metadata.

    Files are numbered over all rows (``source``) or over the rows kept (``filtered``).
    """
    if numbering not in EXPORTS:
        raise ValueError(f"Unknown numbering: {numbering}. Available: {list(EXPORTS)}")
    prefix, file_column, columns = EXPORTS[numbering]
    # Only keys are numbered, so no other column passes through the range sort.
    kept = df.where(predicate)
    base = df if numbering == "source" else kept
    numbered = with_ordinal(base.select(key), [key])
    name = F.concat(F.lit(prefix), fmt_padded("ordinal", 6), F.lit(".wav"))
    return kept.join(numbered, key).select(key, name.alias(file_column), *columns)


def export_subset(df: DataFrame, predicate: Column, folder: str, numbering: str = "source", key: str = "idx") -> DataFrame:
    """Write the audio and the metadata of the rows that meet ``predicate``; returns the manifest of WAV files."""
    manifest = subset_manifest(df, predicate, numbering, key)
    file_column = EXPORTS[numbering][1]
    named = manifest.withColumn("_file", F.col(file_column))
    if numbering == "filtered":
        manifest = manifest.withColumn(file_column, F.concat(F.lit(f"{folder}/"), F.col(file_column)))
    manifest.drop(key).write.mode("overwrite").json(f"{folder}/metadata")
    sounds = df.select(key, "audio").join(named.select(key, "_file"), key)
    saved = write_wav(sounds, f"{folder}/audio" if numbering == "source" else folder, F.col("_file"), key)
    saved.write.mode("overwrite").parquet(f"{folder}/manifest")
    return df.sparkSession.read.parquet(f"{folder}/manifest")
