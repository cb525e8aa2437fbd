"""WAV files as a Spark data source whose files appear when a job is done, or not at all.

    rows.write.format("speech_wav").mode("append").option("path", folder).save()

``rows`` has file_name, array and sampling_rate. A task writes its files into a folder of its own attempt below
``folder/_staging``, which readers pass over. When all tasks have ended, the job moves one folder for each task into place;
a second attempt of a task, or a task that failed, leaves nothing there. A job that fails removes what it has staged.
"""

import uuid
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from speechframe.functions.scalars import basename
from speechframe.operators.joins import usable_audio
from speechframe.session import ship_package
from speechframe.sources.wav_codec import encode

SCHEMA = "file_name string, array array<float>, sampling_rate int"


@dataclass
class Staged(WriterCommitMessage):
    """What one task has written: its folder and the number of files."""

    folder: str
    files: int


class WavWriter(DataSourceWriter):
    def __init__(self, folder: str):
        self.folder, self.run = folder.rstrip("/"), uuid.uuid4().hex

    def _root(self):
        return fs.FileSystem.from_uri(self.folder if "://" in self.folder or self.folder.startswith("/") else self.folder.replace(":/", ":///", 1))

    def write(self, rows):
        system, root = self._root()
        context = TaskContext.get()
        own = f"part-{context.partitionId():05d}-{self.run}"
        staging = f"{root}/_staging/{self.run}/{context.taskAttemptId()}/{own}"
        n = 0
        for row in rows:
            if not n:
                system.create_dir(staging, recursive=True)
            with system.open_output_stream(f"{staging}/{row.file_name}") as out:
                out.write(encode(row.array, row.sampling_rate))
            n += 1
        return Staged(staging if n else "", n)

    def commit(self, messages):
        system, root = self._root()
        system.create_dir(root, recursive=True)  # there also when no row had samples
        for staged in messages:
            if staged is not None and staged.files:
                # one folder for each task, however many files it has
                system.move(staged.folder, f"{root}/{staged.folder.rsplit('/', 1)[1]}")
        self._clear(system, root)

    def abort(self, messages):
        self._clear(*self._root())

    def _clear(self, system, root):
        staging = f"{root}/_staging/{self.run}"
        if system.get_file_info(staging).type != fs.FileType.NotFound:
            system.delete_dir(staging)


class WavSink(DataSource):
    @classmethod
    def name(cls):
        return "speech_wav"

    def schema(self):
        return SCHEMA

    def writer(self, schema, overwrite):
        return WavWriter(self.options["path"])


def save_wav(df: DataFrame, folder: str, file_name="file_name") -> None:
    """The clips of ``df`` as files named by ``file_name`` in a folder below ``folder`` for each task; rows without samples have none."""
    spark = df.sparkSession
    ship_package(spark)
    spark.dataSource.register(WavSink)
    name = F.col(file_name) if isinstance(file_name, str) else file_name
    rows = df.where(usable_audio(F.col("audio"))).select(name.alias("file_name"), "audio.array", "audio.sampling_rate")
    rows.write.format("speech_wav").mode("append").option("path", folder).save()


def write_back(recovered: DataFrame, folder: str) -> None:
    """Recovered audio as the files that the records name, so that the next run finds them.

    ``recovered`` is the outcome of :func:`speechframe.plans.corpus.recover_source`. Records that name one and the same file
    have it once, from the first of them by ``idx``.
    """
    named = recovered.where(F.col("status") == "recovered").withColumn("file_name", basename("audio_path"))
    once = named.where(F.col("file_name").isNotNull()).groupBy("file_name").agg(F.min_by("audio", "idx").alias("audio"))
    save_wav(once, folder)
