"""Row predicates of the corpus. Plain comparisons reach the Parquet scan as pushed filters."""

from pyspark.sql import DataFrame, functions as F

from speechframe.functions.scalars import known, strip
from speechframe.schemas import UNKNOWN


def by_gender(df: DataFrame, gender: str) -> DataFrame:
    return df.where(F.col("gender") == gender)


def by_age(df: DataFrame, ages) -> DataFrame:
    return df.where(F.col("age").isin(*ages))


def accent_contains(df: DataFrame, piece: str) -> DataFrame:
    """Case-sensitive; a missing accent contains nothing."""
    return df.where(F.col("accent").contains(piece))


def high_quality(df: DataFrame, variant: str = "a") -> DataFrame:
    """(a) 1 <= duration <= 8, known gender, transcript over 10 characters; (b) 1 < duration < 10, known gender."""
    duration = F.col("duration")
    if variant == "a":
        return df.where((duration >= 1.0) & (duration <= 8.0) & known("gender") & (F.length("transcript") > 10))
    if variant == "b":
        return df.where((duration > 1.0) & (duration < 10.0) & known("gender"))
    raise ValueError(f"unknown variant: {variant}. Available: ['a', 'b']")


# Column of a table written with its description lengths.
DESCRIPTION_CHARS = "description_chars"


def min_description(df: DataFrame, n: int = 60, column: str = "voice_description") -> DataFrame:
    """Descriptions of at least ``n`` characters without surrounding whitespace.

    A table that carries the length is filtered in the scan and its texts are not read for it.
    """
    if column == "voice_description" and DESCRIPTION_CHARS in df.columns:
        return df.where(F.col(DESCRIPTION_CHARS) >= n)
    return df.where(F.length(strip(column)) >= n)


def training_eligible(df: DataFrame, variant: str = "a", max_duration=10.0, min_duration=1.0, speakers=None):
    """(a) short, gender and age known; (b) short, gender known, transcript of 5 or more; (c) long enough,
    gender known, optionally only the listed speakers (an empty list restricts nothing)."""
    duration = F.col("duration")
    if variant == "a":
        return df.where((duration <= max_duration) & known("gender") & known("age"))
    if variant == "b":
        return df.where((duration <= max_duration) & known("gender") & (F.length("transcript") >= 5))
    if variant == "c":
        kept = df.where((duration >= min_duration) & known("gender"))
        return kept.where(F.col("speaker_id").isin(*speakers)) if speakers else kept
    raise ValueError(f"unknown variant: {variant}. Available: ['a', 'b', 'c']")


def profile_candidates(df: DataFrame, gender=None, age=None, personality=None) -> DataFrame:
    if gender:
        df = df.where(F.col("gender") == gender)
    if age:
        df = df.where(F.col("age") == age)
    if personality:
        df = df.where(F.lower("voice_description").contains(personality.lower()))
    return df


def has_audio(df: DataFrame, column: str = "audio") -> DataFrame:
    return df.where(F.size(F.col(column)["array"]) > 0)


def by_speaker(df: DataFrame, speaker: str) -> DataFrame:
    return df.where(F.col("speaker_id") == speaker)


def failed_annotations(df: DataFrame, column: str = "voice_description") -> DataFrame:
    """Rows whose annotator failed: the failure is kept as text."""
    return df.where(F.col(column).startswith("Error: "))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def leading(df: DataFrame, n: int, *order) -> DataFrame:
    """The first ``n`` rows in an order that tells rows apart.

    Only the order's values pass through the limit's task; they give the last row's, and every row is compared with it where it
    is. Rows that tie with the last one stay too.
    """
    place = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)])
    last = df.select(place.alias("place")).orderBy("place").limit(n).agg(F.max("place")).scalar()
    return df.where(place <= last)


def first_n(df: DataFrame, n: int, key: str = "idx") -> DataFrame:
    """The ``n`` rows with the smallest keys, which must tell the rows apart."""
    return leading(df, n, key)


def unknown(column: str):
    return F.col(column) == UNKNOWN
