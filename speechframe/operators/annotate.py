"""Annotation of rows: a user's annotator, the rule-based acoustic description, and metadata from tags."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from speechframe.functions.scalars import fmt_decimals, strip, word_count
from speechframe.functions.tags import accent_of, age_of, gender_of, parse_profile, tag_value
from speechframe.schemas import DEMOGRAPHICS, UNKNOWN
from speechframe.session import ship_package

# Band names and the thresholds between them (strict comparisons).
PITCH_BANDS = ("high-pitched", "medium-pitched", "low-pitched", 180.0, 120.0)
ENERGY_BANDS = ("energetic", "moderate", "calm", 0.1, 0.05)
RATE_BANDS = ("fast", "moderate", "slow", 180.0, 120.0)
# The three characters suggested by an exact combination of bands.
CHARACTERS = [
    ("high-pitched", "energetic", "fast", "young, enthusiastic character or excited narrator"),
    ("low-pitched", "calm", "slow", "wise elder, meditation guide, or authoritative figure"),
    ("medium-pitched", "moderate", "moderate", "professional presenter, teacher, or everyday character"),
]
ANY_CHARACTER = "versatile character suitable for various roles"


def annotate(df: DataFrame, make_annotator: Callable[[], Callable], audio: str = "audio", prompt: str = "prompt", out: str = "voice_description") -> DataFrame:
    """Describe every row with ``annotator(samples, sampling_rate, prompt)``, built once per task.

    Only the audio and the prompt go to Python, and only the text comes back. The text is stripped. A failure becomes the
    row's text 'Error: ...' and does not fail the job.
    """

    def run(batches: Iterator[tuple[pd.DataFrame, pd.Series]]) -> Iterator[pd.Series]:
        annotator = make_annotator()

        def describe(samples, rate, text):
            try:
                if samples is None:
                    raise ValueError("no audio")
                return annotator(samples, rate, text).strip()
            except Exception as error:
                return f"Error: {error}"

        for sounds, prompts in batches:
            rows = zip(sounds["array"], sounds["sampling_rate"], prompts)
            yield pd.Series([describe(s, None if pd.isna(r) else int(r), p) for s, r, p in rows], index=prompts.index, dtype=object)

    ship_package(df.sparkSession)
    described = F.pandas_udf(run, T.StringType())
    sound = F.struct(F.col(audio)["array"].alias("array"), F.col(audio)["sampling_rate"].alias("sampling_rate"))
    return df.withColumn(out, described(sound, F.col(prompt)))


def _band(value: Column, bands) -> Column:
    high, middle, low, above, below = bands
    return F.when(value > above, high).when(value < below, low).otherwise(middle)


def suggest_character(pitch: Column, energy: Column, rate: Column) -> Column:
    chain = F
    for p, e, r, text in CHARACTERS:
        chain = chain.when((pitch == p) & (energy == e) & (rate == r), text)
    return chain.otherwise(ANY_CHARACTER)


def describe_acoustics(df: DataFrame, f0="f0", energy="energy", duration="duration", transcript="transcript", out: str = "voice_description") -> DataFrame:
    """Text description from pitch, energy, duration and transcript."""
    wpm = F.when(F.col(duration) > 0, word_count(transcript) / F.col(duration) * 60.0).otherwise(0.0)
    banded = (
        df.withColumn("_wpm", wpm)
        .withColumn("_pitch", _band(F.col(f0), PITCH_BANDS))
        .withColumn("_energy", _band(F.col(energy), ENERGY_BANDS))
    ).withColumn("_rate", _band(F.col("_wpm"), RATE_BANDS))
    pieces = [
        "Voice Analysis:\nThe speaker has a ",
        F.col("_pitch"),
        " voice with ",
        F.col("_energy"),
        " delivery. \nSpeaking rate is ",
        F.col("_rate"),
        " at approximately ",
        fmt_decimals("_wpm", 0),
        " words per minute.\nDuration: ",
        fmt_decimals(duration, 1),
        " seconds.\n\nTranscript: ",
        F.col(transcript),
        "\n\nCharacter/Persona:\nBased on the vocal characteristics, this voice would suit a ",
        suggest_character(F.col("_pitch"), F.col("_energy"), F.col("_rate")),
        ".\n",
    ]
    text = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])
    return banded.withColumn(out, text).drop("_wpm", "_pitch", "_energy", "_rate")


def parse_response(df: DataFrame, response: str = "response") -> DataFrame:
    """``parsed_gender/age/accent/profile`` of every response; globe_v2 rows are only stripped."""
    plain = F.col("dataset").eqNullSafe("globe_v2")
    text = F.col(response)
    # The raw tag values are columns of their own, so every pattern runs once per row.
    raw = df
    for tag in DEMOGRAPHICS:
        raw = raw.withColumn(f"_{tag}", F.when(~plain, tag_value(text, tag.upper())))
    parsed = raw.withColumn("parsed_profile", F.when(plain, strip(text)).otherwise(parse_profile(text)))
    for tag, rule in zip(DEMOGRAPHICS, [gender_of, age_of, accent_of]):
        parsed = parsed.withColumn(f"parsed_{tag}", rule(f"_{tag}"))
    return parsed.drop(*[f"_{t}" for t in DEMOGRAPHICS])


def fill_metadata(df: DataFrame, response: str = "voice_description") -> DataFrame:
    """Take parsed demographics where the column is missing or says 'unknown', and the cleaned profile.

    A null demographic stays null; globe_v2 rows keep everything they have.
    """
    parsed = parse_response(df, response)
    plain = F.col("dataset").eqNullSafe("globe_v2")
    for c in DEMOGRAPHICS:
        found = F.col(f"parsed_{c}")
        if c in df.columns:
            parsed = parsed.withColumn(c, F.when(~plain & (F.col(c) == UNKNOWN), found).otherwise(F.col(c)))
        else:
            parsed = parsed.withColumn(c, F.when(~plain, found))
    parsed = parsed.withColumn(response, F.when(plain, F.col(response)).otherwise(F.col("parsed_profile")))
    return parsed.drop("parsed_profile", *[f"parsed_{c}" for c in DEMOGRAPHICS])
