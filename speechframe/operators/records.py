"""Record shapes: canonical, combined, split, training and preview rows."""

from pyspark.sql import Column, DataFrame, functions as F

from speechframe.operators.ordinal import with_ordinal
from speechframe.schemas import AUDIO, DEMOGRAPHICS, SPLIT, UNKNOWN


def column_or(df: DataFrame, name: str, default) -> Column:
    """A missing column gives the default; a null value stays null."""
    if name in df.columns:
        return F.col(name)
    return default if isinstance(default, Column) else F.lit(default)


def to_record(df: DataFrame, dataset: str | None = None, timestamp: str | None = None, key: str = "idx") -> DataFrame:
    """The canonical record. ``timestamp`` pins the ISO processing time, else it is now."""
    stamp = F.lit(timestamp) if timestamp else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    optional = [F.col(c) for c in DEMOGRAPHICS if c in df.columns]
    return df.select(
        F.col(key).cast("long").alias("index"),
        (F.lit(dataset) if dataset else F.col("dataset")).alias("dataset"),
        "speaker_id",
        "transcript",
        column_or(df, "audio_path", F.lit(None).cast("string")).alias("audio_path"),
        F.col("duration").cast("double").alias("duration"),
        "voice_description",
        stamp.alias("processing_timestamp"),
        *optional,
    )


def to_combined(df: DataFrame, extra=()) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): cast to the combined shape; a row with an uncastable value is rejected whole. ``extra`` columns stay."""
    spec = {"duration": "double", "audio": AUDIO.simpleString()}
    cast = df
    bad = F.lit(False)
    for name, kind in spec.items():
        value = F.col(name)
        converted = value.try_cast(kind)
        bad = bad | (value.isNotNull() & converted.isNull())
        if name == "audio":
            bad = bad | value["sampling_rate"].try_cast("int").isNull()
    checked = cast.withColumn("_bad", F.coalesce(bad, F.lit(True)) | F.col("duration").isNull())
    good = checked.where(~F.col("_bad")).select(
        column_or(df, "index", F.col("idx") if "idx" in df.columns else F.lit(None)).cast("long").alias("index"),
        "dataset",
        "speaker_id",
        "transcript",
        F.col("audio").try_cast(spec["audio"]).alias("audio"),
        F.col("duration").try_cast("double").alias("duration"),
        "voice_description",
        *[column_or(df, c, UNKNOWN).alias(c) for c in DEMOGRAPHICS],
        *extra,
    )
    return good, checked.where("_bad").drop("_bad")


# Fixed value: the instruction of the training rows.
INSTRUCTION = "Analyze this voice recording and provide a detailed description."


def format_instruction(df: DataFrame, description: str = "voice_description") -> DataFrame:
    return df.select(
        F.lit(INSTRUCTION).alias("instruction"),
        F.concat(F.lit("Speaker transcript: '"), F.coalesce("transcript", F.lit("None")), F.lit("'")).alias("input"),
        F.col(description).alias("output"),
        F.struct("speaker_id", "accent", "age", "gender", "duration").alias("metadata"),
    )


def format_conversation(df: DataFrame, description: str = "voice_description") -> DataFrame:
    said = F.concat(
        F.lit("Please analyze this voice recording. The speaker says: '"), F.coalesce("transcript", F.lit("None")), F.lit("'")
    )
    turn = lambda who, what: F.struct(F.lit(who).alias("from"), what.alias("value"))
    return df.select(
        F.array(turn("human", said), turn("assistant", F.col(description))).alias("conversations"),
        F.struct("speaker_id", "accent", "age", "gender").alias("metadata"),
    )


TRAINING_FORMATS = {"instruction": format_instruction, "conversation": format_conversation}


def training_rows(df: DataFrame, variant: str = "a") -> DataFrame:
    """(a) text with a nested speaker, (b) flat columns, (c) text with nested characteristics."""
    audio = [F.col("audio")] if "audio" in df.columns else []
    flat = [F.col("audio.array").alias("audio"), F.col("audio.sampling_rate").alias("sampling_rate")] if audio else []
    if variant == "a":
        speaker = F.struct("gender", "age", "accent", F.col("voice_description").alias("voice_profile"))
        return df.select(*audio, F.col("transcript").alias("text"), speaker.alias("speaker_embedding"))
    if variant == "b":
        return df.select(
            *flat,
            F.col("transcript").alias("text"),
            "speaker_id",
            "gender",
            "age",
            "accent",
            F.col("voice_description").alias("voice_profile"),
            "duration",
            F.col("dataset").alias("source_dataset"),
        )
    if variant == "c":
        traits = F.struct("gender", "age", "accent", F.col("voice_description").alias("description"))
        return df.select(*flat[:1], F.col("transcript").alias("text"), "speaker_id", traits.alias("voice_characteristics"))
    raise ValueError(f"unknown variant: {variant}. Available: ['a', 'b', 'c']")


def demographics() -> Column:
    """'gender, age, accent' with nulls spelled None."""
    shown = [F.coalesce(c, F.lit("None")) for c in DEMOGRAPHICS]
    return F.concat(shown[0], F.lit(", "), shown[1], F.lit(", "), shown[2])


def preview(df: DataFrame, descriptions=("voice_description",)) -> DataFrame:
    """Transcript cut to 100 characters with '...' only if longer, descriptions to 200 with '...' always."""
    cut = F.when(F.length("transcript") > 100, F.concat(F.substring("transcript", 1, 100), F.lit("...")))
    return df.select(
        "speaker_id",
        cut.otherwise(F.col("transcript")).alias("transcript"),
        demographics().alias("metadata"),
        *[F.concat(F.substring(c, 1, 200), F.lit("...")).alias(f"{c}_preview") for c in descriptions],
    )


def split_projection(df: DataFrame, order=("index",), by: str | None = "split") -> DataFrame:
    """Drop ``index``; ``speaker_id`` becomes the 0-based position in the split.

    Positions dealt by :func:`split3` (column ``position``) are taken over, else they are numbered in ``order``.
    """
    if "position" not in df.columns:
        # only keys are ordered; ``order`` must tell the rows apart
        keys = [*order, *([by] if by and by not in order else [])]
        numbered = with_ordinal(df.select(*keys), list(order), by=by, name="position").select(*order, "position")
        df = df.join(numbered, list(order))
    shaped = df.withColumn("speaker_id", F.col("position"))
    for c in DEMOGRAPHICS:
        shaped = shaped.withColumn(c, column_or(df, c, UNKNOWN))
    kept = [c for c in SPLIT.fieldNames() if c in shaped.columns]
    return shaped.select(*([by] if by in shaped.columns else []), *kept)
