"""Adapters from the four sources to one row shape.

Every adapter returns ``idx, dataset, speaker_id, transcript, audio, duration`` and what the source knows.
A column the source lacks gets the default; a null it holds stays null.
"""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from speechframe.functions.waveform import duration_of, unify_audio
from speechframe.operators.records import column_or
from speechframe.schemas import UNKNOWN

LAIONS_RATE = 24000


def _audio(df: DataFrame, column: str, rate: int = 16000) -> DataFrame:
    return df.withColumn("_audio", unify_audio(df, column, rate))


def _length() -> Column:
    return duration_of(F.col("_audio.array"), F.col("_audio.sampling_rate"))


def normalize_globe(df: DataFrame, key: str = "idx") -> DataFrame:
    df = _audio(df, "audio")
    return df.select(
        F.col(key).alias("idx"),
        F.lit("globe_v2").alias("dataset"),
        column_or(df, "speaker_id", F.concat(F.lit("globe_speaker_"), F.col(key))).alias("speaker_id"),
        column_or(df, "transcript", "").alias("transcript"),
        F.col("_audio").alias("audio"),
        column_or(df, "duration", _length()).cast("double").alias("duration"),
        *[column_or(df, c, UNKNOWN).alias(c) for c in ["gender", "age", "accent"]],
    )


def _json_fields(df: DataFrame) -> dict[str, tuple[Column, Column]]:
    """(present, value) of the fields of the ``json`` column, which is a struct or JSON text."""
    names = ["emotion", "sample_id", "text", "duration"]
    if "json" not in df.columns:
        return {n: (F.lit(False), F.lit(None).cast("string")) for n in names}
    kind = df.schema["json"].dataType
    if isinstance(kind, T.StructType):
        held = set(kind.fieldNames())
        return {n: (F.lit(n in held), F.col("json")[n] if n in held else F.lit(None).cast("string")) for n in names}
    fields = F.from_json("json", "map<string,string>")
    return {n: (F.coalesce(F.map_contains_key(fields, n), F.lit(False)), fields[n]) for n in names}


def normalize_laions(df: DataFrame, key: str = "idx") -> DataFrame:
    df = _audio(df, "wav", LAIONS_RATE)
    fields = _json_fields(df)
    pick = lambda name, default: F.when(fields[name][0], fields[name][1].cast("string")).otherwise(default)
    seconds = F.when(fields["duration"][0], fields["duration"][1].cast("string").try_cast("double"))
    return df.select(
        F.col(key).alias("idx"),
        F.lit("laions").alias("dataset"),
        pick("sample_id", F.concat(F.lit("laions_"), F.col(key))).alias("speaker_id"),
        pick("text", F.lit("")).alias("transcript"),
        F.col("_audio").alias("audio"),
        seconds.otherwise(_length()).alias("duration"),
        pick("emotion", F.lit(UNKNOWN)).alias("emotion"),
    )


def normalize_animevox(df: DataFrame, key: str = "idx") -> DataFrame:
    df = _audio(df, "audio")
    character = column_or(df, "character_name", F.concat(F.lit("anime_char_"), F.col(key)))
    anime = column_or(df, "anime", UNKNOWN)
    shown = lambda c: F.coalesce(c, F.lit("None"))
    return df.select(
        F.col(key).alias("idx"),
        F.lit("animevox").alias("dataset"),
        F.concat(shown(anime), F.lit("_"), shown(character)).alias("speaker_id"),
        column_or(df, "transcription", "").alias("transcript"),
        F.col("_audio").alias("audio"),
        _length().alias("duration"),
        character.alias("character_name"),
        anime.alias("anime"),
    )


def normalize_anispeech(df: DataFrame, key: str = "idx") -> DataFrame:
    df = _audio(df, "audio")
    voice = column_or(df, "voice", UNKNOWN)
    return df.select(
        F.col(key).alias("idx"),
        F.lit("anispeech").alias("dataset"),
        F.concat(F.lit("anispeech_"), F.coalesce(voice.cast("string"), F.lit("None")), F.lit("_"), F.col(key)).alias("speaker_id"),
        column_or(df, "caption", "").alias("transcript"),
        F.col("_audio").alias("audio"),
        _length().alias("duration"),
        voice.alias("voice_class"),
    )


ADAPTERS = {
    "globe_v2": normalize_globe,
    "laions": normalize_laions,
    "animevox": normalize_animevox,
    "anispeech": normalize_anispeech,
}


def normalize_source(df: DataFrame, name: str, key: str = "idx") -> DataFrame:
    if name not in ADAPTERS:
        raise ValueError(f"Unknown dataset: {name}. Available: {list(ADAPTERS)}")
    return df.transform(ADAPTERS[name], key)
