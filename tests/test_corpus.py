"""Adapters, record shapes, joins, combination, sources and sinks."""

import json
import os
import wave as wav

import numpy as np
import pytest
from pyspark.sql import functions as F

from speechframe import schemas
from speechframe.operators import joins, prompts, records
from speechframe.operators.annotate import annotate
from speechframe.plans import corpus
from speechframe.session import workspace
from speechframe.sources import adapters, readers, sinks

AUDIO = "struct<array:array<float>,sampling_rate:int>"


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# --- schemas and adapters ------------------------------------------------------------------------


def test_record_schema():
    assert schemas.RECORD.simpleString() == (
        "struct<index:bigint,dataset:string,speaker_id:string,transcript:string,audio_path:string,duration:double,"
        "voice_description:string,processing_timestamp:string,gender:string,age:string,accent:string>"
    )
    assert "audio_path" not in schemas.COMBINED.fieldNames() and "index" not in schemas.SPLIT.fieldNames()


def test_globe_defaults_only_for_missing_columns(spark):
    full = spark.createDataFrame([(1, ([0.5] * 8, 4), "S_000658", None, 2.9, "female", None)], f"idx long, audio {AUDIO}, speaker_id string, transcript string, duration double, gender string, age string")
    got = adapters.normalize_source(full, "globe_v2").collect()[0]
    assert (got.speaker_id, got.transcript, got.duration, got.gender, got.age, got.accent) == ("S_000658", None, 2.9, "female", None, "unknown")
    bare = spark.createDataFrame([(7, [0.0] * 32000)], "idx long, audio array<float>")
    got = adapters.normalize_globe(bare).collect()[0]
    assert (got.speaker_id, got.transcript, got.duration, got.audio.sampling_rate) == ("globe_speaker_7", "", 2.0, 16000)


def test_laions_fields_missing_or_null(spark):
    texts = ['{"emotion": "joy", "sample_id": "alloy_1", "text": "hi", "duration": 15.85}', "{}", '{"emotion": null, "text": null}']
    df = spark.createDataFrame([(i, [0.0] * 24000, t) for i, t in enumerate(texts)], "idx long, wav array<float>, json string")
    got = rows(adapters.normalize_laions(df), "speaker_id", "transcript", "duration", "emotion")
    assert got == [("alloy_1", "hi", 15.85, "joy"), ("laions_1", "", 1.0, "unknown"), ("laions_2", None, 1.0, None)]
    nested = df.withColumn("json", F.from_json("json", "emotion string, text string"))
    assert rows(adapters.normalize_laions(nested), "speaker_id", "emotion")[0] == ("laions_0", "joy")


def test_anime_adapters(spark):
    df = spark.createDataFrame([(3, ([0.1] * 16, 16), "Frieren", "Journey", "hello")], f"idx long, audio {AUDIO}, character_name string, anime string, transcription string")
    got = adapters.normalize_animevox(df).collect()[0]
    assert (got.speaker_id, got.transcript, got.duration) == ("Journey_Frieren", "hello", 1.0)
    assert adapters.normalize_animevox(df.drop("anime", "character_name")).collect()[0].speaker_id == "unknown_anime_char_3"
    speech = df.select("idx", "audio", F.lit(0).alias("voice"), F.lit("cap").alias("caption"))
    assert rows(adapters.normalize_anispeech(speech), "speaker_id", "transcript") == [("anispeech_0_3", "cap")]


def test_unknown_source_is_named(spark):
    with pytest.raises(ValueError, match="globe_v2.*laions.*animevox.*anispeech"):
        adapters.normalize_source(spark.range(1), "other")


# --- record shapes -------------------------------------------------------------------------------


def test_to_combined_rejects_uncastable_rows(spark):
    df = spark.createDataFrame(
        [(1, "a", ([0.5], "16000"), "2.5"), (2, "a", ([0.5], "16000"), "long"), (3, "a", ([0.5], "fast"), "1"), (4, "a", ([0.5], "8"), None)],
        "idx long, dataset string, audio struct<array:array<double>,sampling_rate:string>, duration string",
    )
    df = df.withColumns({"speaker_id": F.lit("s"), "transcript": F.lit("t"), "voice_description": F.lit("v"), "gender": F.lit(None).cast("string")})
    good, rejected = records.to_combined(df)
    assert good.schema.simpleString() == schemas.COMBINED.simpleString()
    assert rows(good, "index", "duration", "gender", "age") == [(1, 2.5, None, "unknown")]
    assert sorted(r.idx for r in rejected.collect()) == [2, 3, 4]


def test_preview_cuts(spark):
    df = spark.createDataFrame([("s", "x" * 100, "y" * 10, "male", None, "RP"), ("s", "x" * 101, "y" * 300, "male", "teens", "RP")], "speaker_id string, transcript string, voice_description string, gender string, age string, accent string")
    got = rows(records.preview(df), "transcript", "metadata", "voice_description_preview")
    assert got == [("x" * 100, "male, None, RP", "y" * 10 + "..."), ("x" * 100 + "...", "male, teens, RP", "y" * 200 + "...")]


def test_timestamp_is_iso(spark):
    df = spark.createDataFrame([(1, "s", "t", 1.0, "v")], "idx long, speaker_id string, transcript string, duration double, voice_description string")
    got = records.to_record(df, "laions")
    assert "gender" not in got.columns and got.collect()[0].processing_timestamp[10] == "T"


def test_prompts(spark):
    df = spark.createDataFrame([("globe_v2", "male", None, "RP"), ("laions", "x", "y", "z"), ("elsewhere", "x", "y", "z")], "dataset string, gender string, age string, accent string")
    got = [r.prompt for r in prompts.build_prompt(df).collect()]
    assert got[0].startswith("Analyze this voice recording for character consistency. Speaker: male in None, RP accent.\n")
    assert "Emotional context: unknown." in got[1] and got[2] is None
    assert "GENDER: [male/female] \n" in prompts.SOURCE_PROMPTS["animevox"]
    with pytest.raises(ValueError, match="analysis.*character.*technical.*combined"):
        prompts.prompt_by_type(df, "poem")


def test_annotator_is_built_once_per_task_and_failures_become_text(spark):
    def make():
        calls = []

        def describe(samples, rate, prompt):
            calls.append(1)
            if prompt is None:
                raise RuntimeError("no prompt")
            return f" {prompt} {len(samples)} {len(calls)}\n"

        return describe

    df = spark.createDataFrame([(1, ([0.0, 1.0], 4), "p"), (2, ([0.0], 4), None), (3, None, "p"), (4, ([0.0], 4), "q")], f"idx long, audio {AUDIO}, prompt string").coalesce(1)
    got = dict(rows(annotate(df, make), "idx", "voice_description"))
    assert got[1] == "p 2 1" and got[2] == "Error: no prompt" and got[3].startswith("Error: ") and got[4] == "q 1 3"


# --- lookup, recovery, combination ---------------------------------------------------------------


@pytest.mark.parametrize("hot_rows", [1, 50, 10**6])
def test_lookup_with_frequent_and_null_keys(spark, hot_rows):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 40))
    left = spark.range(600).select("id", key.alias("k"))
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("other", 4)], "k string, v int")
    want = {"hot": 1, "k1": 2, "k2": 3}
    got = joins.lookup(left, right, "k", "id", hot_rows).collect()
    assert len(got) == 600 and {r.id for r in got} == set(range(600))
    assert all(r.v == want.get(r.k) for r in got)


def clip_rows(spark, items):
    return spark.createDataFrame([(i, (list(a), 16) if a is not None else None) for i, a in items], f"file_name string, audio {AUDIO}")


@pytest.fixture
def lost(spark):
    records_ = spark.createDataFrame(
        [
            (1, "laions", "s1", "one", "E:\\o\\1.wav"),
            (2, "laions", "s2", " two ", "/o/2.wav"),
            (3, "laions", "s3", None, "/o/3.wav"),
            (4, "laions", "s4", "four", "/o/4.wav"),
            (5, "laions", "s5", "two", "/o/5.wav"),
            (6, "laions", "s6", "six", "/o/6.wav"),
        ],
        "idx long, dataset string, speaker_id string, transcript string, audio_path string",
    )
    files = clip_rows(spark, [("1.wav", [1.0]), ("4.wav", []), ("6.wav", None)])
    originals = spark.createDataFrame(
        [(9, "two", "two", "x", [9.0]), (5, "two\n", "two\n", "s2", [5.0]), (7, None, None, "s3", [7.0]), (8, "six", "six", "s6", [8.0])],
        "ordinal long, text string, transcript string, speaker_id string, wav array<float>",
    )
    return records_, files, originals


def test_recovery_takes_the_first_match(lost):
    records_, files, originals = lost
    got = corpus.recover_source(records_, files, originals, "laions", audio="wav", default_rate=24000)
    seen = {r.idx: (r.status, None if r.audio is None else (list(r.audio.array), r.audio.sampling_rate)) for r in got.collect()}
    assert seen == {
        1: ("present", ([1.0], 16)),
        2: ("recovered", ([5.0], 24000)),
        3: ("missing", None),
        4: ("present", ([], 16)),
        5: ("recovered", ([5.0], 24000)),
        6: ("recovered", ([8.0], 24000)),
    }
    counters = {r.dataset: r.asDict() for r in joins.pipeline_counters(got).collect()}
    assert counters["total"] == counters["laions"] | {"dataset": "total"}
    total = counters["total"]
    assert (total["total_processed"], total["missing_audio"], total["recovered_audio"], total["audio_errors"], total["successful"]) == (6, 4, 3, 2, 4)


def test_recovery_by_speaker_for_globe(lost):
    records_, files, originals = lost
    got = joins.recover_audio(joins.without_file(records_, files), originals, "globe_v2", audio="wav")
    assert {r.idx: r.recovered_audio and list(r.recovered_audio.array) for r in got.collect()} == {2: [5.0], 3: None, 5: None}
    with pytest.raises(ValueError):
        joins.recover_audio(records_, originals, "nowhere")


def test_no_originals_leaves_rows_missing(lost):
    records_, files, _ = lost
    got = corpus.recover_source(records_, files, None, "laions")
    assert sorted(r.idx for r in got.where("status = 'missing'").collect()) == [2, 3, 5, 6]


def test_combine_numbers_across_sources_and_skips_absent_ones(spark):
    def source(name, ids):
        audio = F.when(F.col("id") != 2, F.struct(F.array(F.lit(0.5).cast("float")).alias("array"), F.lit(16).alias("sampling_rate")))
        base = spark.createDataFrame([(i,) for i in ids], "id long").select(F.col("id").alias("idx"), "id", audio.alias("audio"))
        return base.drop("id").withColumns({"dataset": F.lit(name), "speaker_id": F.lit("s"), "transcript": F.lit("t"), "duration": F.lit(1.0), "voice_description": F.lit("v" * 70)})

    combined = corpus.combine({"laions": source("laions", [4, 1]), "animevox": source("animevox", [3, 2, 5])})
    assert sorted(rows(combined, "index", "dataset")) == [(0, "animevox"), (1, "animevox"), (2, "laions"), (3, "laions")]
    assert combined.schema.simpleString() == schemas.COMBINED.simpleString()
    updated = corpus.update(combined)
    assert set(updated.columns) == {"split", *schemas.SPLIT.fieldNames()}
    assert sorted(rows(updated, "split", "speaker_id")) == [("test", 0), ("test", 1), ("train", 0), ("train", 1)]


def test_process_source_end_to_end(spark):
    raw = spark.range(1, 41).select(F.col("id").alias("idx"), F.array(F.lit(0.5).cast("float")).alias("audio"), F.concat(F.lit("line "), "id").alias("caption"), F.lit("v").alias("voice"))
    make = lambda: (lambda samples, rate, prompt: "GENDER: woman\nAGE: 20\nACCENT: none\nVOICE_PROFILE: calm")
    done = spark.createDataFrame([(1,), (2,)], "idx long")
    got = corpus.process_source(raw, "anispeech", make, max_n=40, processed=done, timestamp="2025-01-01T00:00:00").orderBy("index")
    first = got.first()
    assert first["index"] > 2 and (first.gender, first.age, first.accent, first.voice_description) == ("female", "twenties", "General American", "calm")
    assert got.count() <= 38 and set(got.columns) == set(schemas.RECORD.fieldNames())


# --- sources and sinks ---------------------------------------------------------------------------


def test_record_arrays_whatever_the_suffix(spark, tmp_path):
    row = {"index": 1, "dataset": "globe_v2", "speaker_id": "S_000658", "duration": 2.9, "gender": "female", "age": "thirties"}
    for name in ["a.json", "b.jsonl"]:
        (tmp_path / name).write_text(json.dumps([row, {**row, "index": 2, "accent": "New Zealand English"}], indent=2))
    got = readers.read_records(spark, f"{tmp_path}/*.json*")
    assert got.count() == 4 and sorted(rows(got, "index", "accent"))[-1] == (2, "New Zealand English")
    assert readers.read_records(spark, f"{tmp_path}/none.json").count() == 0


def test_records_leave_out_nulls(spark):
    path = workspace(spark, "records")
    sinks.write_records(spark.createDataFrame([(1, None, "x")], "index long, accent string, gender string"), path)
    assert [r.value for r in spark.read.text(path).collect()] == ['{"index":1,"gender":"x"}']


def test_validate_table(spark):
    path = workspace(spark, "table")
    sinks.write_corpus(spark.range(3).withColumn("audio_array", F.lit(1)), path)
    assert dict(rows(readers.validate_table(spark, path, ["id", "audio_array"]), "check", "ok")) == {"exists": True, "finished": True, "column id": True, "column audio_array": False}
    assert dict(rows(readers.validate_table(spark, path + "-none", ["id"]), "check", "ok")) == {"exists": False, "finished": False, "column id": False}


def test_older_records_lack_columns(spark):
    new = spark.createDataFrame([(1, "a", "/x.wav")], "index long, dataset string, audio_path string")
    old = spark.createDataFrame([(2,)], "index long")
    assert sorted(rows(readers.concat_batches([new, old]), "index", "dataset")) == [(1, "a"), (2, None)]


def _write_wav(path, width, channels, frames):
    with wav.open(str(path), "wb") as out:
        out.setnchannels(channels)
        out.setsampwidth(width)
        out.setframerate(8)
        out.writeframes(frames)


def test_scan_wav_widths_channels_and_broken_files(spark, tmp_path):
    _write_wav(tmp_path / "w1.wav", 1, 1, bytes([128, 255, 0]))
    _write_wav(tmp_path / "w2.wav", 2, 2, np.array([16384, 0, -32768, -32768], "<i2").tobytes())
    _write_wav(tmp_path / "w4.wav", 4, 1, np.array([1 << 30], "<i4").tobytes())
    (tmp_path / "bad.wav").write_bytes(b"not a wave")
    (tmp_path / "other.txt").write_text("x")
    got = {os.path.basename(r.path): r.audio and list(r.audio.array) for r in readers.scan_wav(spark, str(tmp_path)).collect()}
    assert got == {"w1.wav": [0.0, 127 / 128, -1.0], "w2.wav": [0.25, -1.0], "w4.wav": [0.5], "bad.wav": None}


def test_write_wav_names_and_repeats(spark):
    folder = workspace(spark, "wav")
    df = spark.createDataFrame([(1, "animevox", "Journey's: End/x", ([0.5, -1.0], 16)), (2, "animevox", "b", (None, 16))], f"idx long, dataset string, speaker_id string, audio {AUDIO}")
    for _ in range(2):  # a repeated task leaves the same files
        got = {r.idx: (r.path, r.error) for r in sinks.write_wav(df, folder).collect()}
    assert got[1] == (f"{folder.removeprefix('file:')}/animevox_1_Journey's_ End_x.wav", None)
    assert got[2][0] is None and got[2][1].startswith("Error: ")
    assert sorted(f for f in os.listdir(folder.removeprefix("file:")) if f.endswith(".wav")) == ["animevox_1_Journey's_ End_x.wav"]
    assert [list(r.audio.array) for r in readers.scan_wav(spark, folder).collect()] == [[0.5, -1.0]]


def test_exports_number_by_source_or_by_kept_rows(spark):
    df = spark.range(10).select(F.col("id").alias("idx"), *[F.lit("x").alias(c) for c in ["speaker_id", "transcript", "gender", "age", "accent", "voice_description"]], F.lit(1.0).alias("duration"))
    kept = F.col("idx") % 2 == 1
    assert [r.audio_file for r in sinks.subset_manifest(df, kept, "source").orderBy("idx").collect()][:2] == ["voice_000001.wav", "voice_000003.wav"]
    assert [r.audio_path for r in sinks.subset_manifest(df, kept, "filtered").orderBy("idx").collect()][:2] == ["audio_000000.wav", "audio_000001.wav"]
    with pytest.raises(ValueError):
        sinks.subset_manifest(df, kept, "other")


def test_export_training_formats(spark):
    df = spark.createDataFrame([("s", "hi", "deep", "RP", "teens", "male", 1.5)], "speaker_id string, transcript string, voice_description string, accent string, age string, gender string, duration double")
    for fmt in ["instruction", "conversation"]:
        path = workspace(spark, fmt)
        assert sinks.export_training(df, path, fmt) == 1
        line = json.loads(spark.read.text(path).collect()[0].value)
        if fmt == "instruction":
            assert line["input"] == "Speaker transcript: 'hi'" and line["metadata"]["duration"] == 1.5
        else:
            assert [c["from"] for c in line["conversations"]] == ["human", "assistant"] and "duration" not in line["metadata"]
    with pytest.raises(ValueError):
        sinks.export_training(df, workspace(spark, "x"), "poem")


# --- combination, recovery and packaging beyond the well-formed case ------------------------------


def source_rows(spark, items):
    """(key, label) rows of one source, all with audio."""
    base = spark.createDataFrame(items, "idx long, dataset string")
    audio = F.struct(F.array(F.lit(0.5).cast("float")).alias("array"), F.lit(16).alias("sampling_rate"))
    return base.withColumns({"audio": audio, "speaker_id": F.lit("s"), "transcript": F.lit("t"), "duration": F.lit("1.0"), "voice_description": F.lit("v" * 70)})


def test_combine_ranks_by_source_and_keeps_every_row(spark):
    laions = source_rows(spark, [(1, "LAIONS"), (1, None), (None, "laions"), (1, "LAIONS")])
    animevox = source_rows(spark, [(7, "laions"), (2, "x")])
    got = sorted(rows(corpus.combine({"laions": laions, "animevox": animevox}), "index", "dataset"))
    assert [i for i, _ in got] == list(range(6))
    assert [d for _, d in got[:2]] == ["x", "laions"]
    assert sorted(str(d) for _, d in got[2:]) == ["LAIONS", "LAIONS", "None", "laions"]


def test_combine_returns_what_it_rejects(spark):
    bad = source_rows(spark, [(3, "laions")]).withColumn("duration", F.lit("long"))
    good, rejected = corpus.combine_checked({"laions": source_rows(spark, [(1, "laions")]).unionByName(bad)})
    assert rows(good, "index") == [(0,)] and rows(rejected, "idx", "duration") == [(3, "long")]


def test_recovery_reads_the_sources_own_shape(spark, lost):
    records_, files, originals = lost
    nested = originals.select("ordinal", F.struct("text").alias("json"), "wav")
    as_text = originals.select("ordinal", F.to_json(F.struct("text")).alias("json"), "wav")
    for shape in (nested, as_text):
        got = joins.recover_audio(joins.without_file(records_, files), shape, "laions")
        assert {r.idx: r.recovered_audio and list(r.recovered_audio.array) for r in got.collect()} == {2: [5.0], 3: None, 5: [5.0]}


def test_status_without_audio_agrees_with_recovery(lost):
    records_, files, originals = lost
    narrow = {r.idx: (r.status, r.usable) for r in corpus.source_status(records_, files, originals, "laions").collect()}
    whole = corpus.recover_source(records_, files, originals, "laions", audio="wav")
    assert narrow == {r.idx: (r.status, bool(r.audio and r.audio.array)) for r in whole.collect()}
    none = {r.status for r in corpus.source_status(records_, files, None, "laions").collect()}
    assert none == {"present", "missing"}


def test_wav_of_24_bits_and_the_reason_of_a_failure(spark, tmp_path):
    _write_wav(tmp_path / "w3.wav", 3, 1, (1 << 22).to_bytes(3, "little") + (-(1 << 23)).to_bytes(3, "little", signed=True))
    (tmp_path / "bad.wav").write_bytes(b"nothing")
    got = {os.path.basename(r.path): r for r in readers.scan_wav(spark, str(tmp_path)).collect()}
    assert list(got["w3.wav"].audio.array) == [0.5, -1.0] and got["w3.wav"].error is None
    assert got["bad.wav"].audio is None and got["bad.wav"].error.startswith("Error: ")


def test_write_wav_replaces_an_older_file(spark):
    folder = workspace(spark, "replaced")
    for level in (0.5, -0.25):
        df = spark.createDataFrame([(1, "d", "s", ([level], 16))], f"idx long, dataset string, speaker_id string, audio {AUDIO}")
        assert [r.error for r in sinks.write_wav(df, folder).collect()] == [None]
    assert [list(r.audio.array) for r in readers.scan_wav(spark, folder).collect()] == [[-0.25]]


def test_positions_are_numbered_over_keys(spark):
    df = spark.createDataFrame([(i, "a" if i % 2 else "b", "t", 1.0, "v") for i in range(10)], "index long, split string, transcript string, duration double, voice_description string")
    got = sorted(rows(records.split_projection(df), "split", "speaker_id"))
    assert got == [("a", i) for i in range(5)] + [("b", i) for i in range(5)]


def test_package_is_shipped_once(spark):
    from speechframe.session import ship_package

    ship_package(spark)
    before = len(spark.sparkContext._python_includes)
    ship_package(spark)
    assert "speechframe.zip" in spark.sparkContext._python_includes and len(spark.sparkContext._python_includes) == before


def test_records_without_a_file_stay_where_they_are(spark):
    records = spark.range(50).select(F.col("id").alias("idx"), F.concat(F.lit("a/"), F.col("id").cast("string"), F.lit(".wav")).alias("audio_path"))
    records = records.withColumn("audio_path", F.when(F.col("idx") != 7, F.col("audio_path")))
    files = spark.range(20).select(F.concat(F.col("id").cast("string"), F.lit(".wav")).alias("file_name"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        lacking, having = joins.without_file(records, files), joins.with_file(records, files)
        assert all("SortMergeJoin" not in df._jdf.queryExecution().executedPlan().toString() for df in (lacking, having))
        assert sorted(r.idx for r in lacking.collect()) == [7, *range(20, 50)]
        assert sorted(r.idx for r in having.collect()) == [i for i in range(20) if i != 7]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sources_of_the_catalog_read_one_written_table(spark, sf):
    from speechframe.catalog.joins import awkward_sources, four_sources

    for sources in (four_sources(spark, sf), awkward_sources(spark, sf)):
        assert all("Join" not in df._jdf.queryExecution().optimizedPlan().toString() for df in sources.values())
