"""WAV files that appear with the job that writes them, or not at all."""

import os

import pytest
from pyspark.sql import functions as F

from speechframe.plans import corpus
from speechframe.sources import readers, wav_sink

CLIPS = "idx long, file_name string, audio struct<array: array<float>, sampling_rate: int>"


def clips(spark, n, parts=4):
    rows = [(i, f"clip {i}.wav", ([i / 64, -0.5], 16)) for i in range(n)]
    return spark.createDataFrame([*rows, (n, "none.wav", None), (n + 1, "empty.wav", ([], 16))], CLIPS).repartition(parts)


def found(folder):
    return sorted(f for _, _, names in os.walk(folder) for f in names if f.endswith(".wav"))


def test_files_appear_with_the_job(spark, tmp_path):
    folder = f"{tmp_path}/out"
    wav_sink.save_wav(clips(spark, 20), f"file://{folder}")
    assert found(folder) == sorted(f"clip {i}.wav" for i in range(20)) and not os.listdir(f"{folder}/_staging")
    read = readers.scan_wav(spark, folder, nested=True)
    assert sorted(r.audio.array[0] for r in read.collect()) == [i / 64 for i in range(20)]
    wav_sink.save_wav(clips(spark, 3).withColumn("file_name", F.concat(F.lit("more "), "file_name")), folder)
    assert len(found(folder)) == 23 and readers.scan_wav(spark, folder, nested=True).count() == 23


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    folder = f"{tmp_path}/out"
    late = F.when(F.col("idx") == 17, F.raise_error(F.lit("lost"))).otherwise(F.col("file_name"))
    with pytest.raises(Exception, match="lost"):
        wav_sink.save_wav(clips(spark, 20, parts=1).sortWithinPartitions("idx"), folder, late)
    assert found(folder) == [] and not os.path.exists(f"{folder}/_staging") or not os.listdir(f"{folder}/_staging")
    assert found(folder) == []


def test_nothing_to_write(spark, tmp_path):
    wav_sink.save_wav(clips(spark, 0), f"{tmp_path}/out")
    assert found(tmp_path) == []


def test_recovered_clips_are_found_by_the_next_run(spark, tmp_path):
    schema = "idx long, dataset string, speaker_id string, transcript string, audio_path string"
    records = spark.createDataFrame([(1, "laions", "s", "one", "E:\\a\\1.wav"), (2, "laions", "s", "two", "/b/2.wav"), (3, "laions", "s", "two", "/c/2.wav"), (4, "laions", "s", "none", "4.wav"), (5, "laions", "s", "two", None)], schema)
    files = spark.createDataFrame([("1.wav", ([0.25], 16))], "file_name string, audio struct<array: array<float>, sampling_rate: int>")
    originals = spark.createDataFrame([(7, " two ", ([0.5, 0.75], 8))], "ordinal long, text string, audio struct<array: array<float>, sampling_rate: int>")
    first = corpus.recover_source(records, files, originals, "laions")
    assert {r.idx: r.status for r in first.collect()} == {1: "present", 2: "recovered", 3: "recovered", 4: "missing", 5: "recovered"}
    wav_sink.write_back(first, f"{tmp_path}/out")
    assert found(tmp_path) == ["2.wav"]
    added = readers.scan_wav(spark, f"{tmp_path}/out", nested=True).select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "audio")
    second = corpus.recover_source(records, files.unionByName(added), None, "laions")
    assert {r.idx: (r.status, r.audio and r.audio.array) for r in second.collect()} == {
        1: ("present", [0.25]), 2: ("present", [0.5, 0.75]), 3: ("present", [0.5, 0.75]), 4: ("missing", None), 5: ("missing", None),
    }
