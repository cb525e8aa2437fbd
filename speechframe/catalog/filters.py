"""Filters and distinct values."""

from pyspark.sql import functions as F

from speechframe.catalog.base import Catalog, on_samples, rounded, samples, sql_strip, table, waves, with_views
from speechframe.operators import filters

CATALOG = Catalog()


def add(name, run, where):
    CATALOG.add(
        name,
        lambda s, d: rounded(run(samples(s, d)).select("idx", "speaker_id", "duration")),
        on_samples(f"SELECT idx, speaker_id, round(duration, 6) AS duration FROM samples WHERE {where}"),
    )


KNOWN = "{} IS DISTINCT FROM 'unknown'".format
add("by_gender", lambda df: filters.by_gender(df, "female"), "gender = 'female'")
add("by_age", lambda df: filters.by_age(df, ["teens", "twenties"]), "age IN ('teens', 'twenties')")
add("accent_contains", lambda df: filters.accent_contains(df, "American"), "contains(accent, 'American')")
add(
    "high_quality_a",
    lambda df: filters.high_quality(df, "a"),
    f"duration BETWEEN 1 AND 8 AND {KNOWN('gender')} AND length(transcript) > 10",
)
add("high_quality_b", lambda df: filters.high_quality(df, "b"), f"duration > 1 AND duration < 10 AND {KNOWN('gender')}")
add("min_description", lambda df: filters.min_description(df, 60), f"length({sql_strip('voice_description')}) >= 60")
add("training_eligible_a", lambda df: filters.training_eligible(df, "a"), f"duration <= 10 AND {KNOWN('gender')} AND {KNOWN('age')}")
add("training_eligible_b", lambda df: filters.training_eligible(df, "b"), f"duration <= 10 AND {KNOWN('gender')} AND length(transcript) >= 5")
add("training_eligible_c", lambda df: filters.training_eligible(df, "c"), f"duration >= 1 AND {KNOWN('gender')}")
add(
    "training_eligible_c_speakers",
    lambda df: filters.training_eligible(df, "c", speakers=["S_1", "S_2", "S_60"]),
    f"duration >= 1 AND {KNOWN('gender')} AND speaker_id IN ('S_1', 'S_2', 'S_60')",
)
add(
    "profile_candidates",
    lambda df: filters.profile_candidates(df, "male", "twenties", "Smooth"),
    "gender = 'male' AND age = 'twenties' AND contains(lower(voice_description), 'smooth')",
)
add("by_speaker", lambda df: filters.by_speaker(df, "S_7"), "speaker_id = 'S_7'")
add("failed_annotations", lambda df: filters.failed_annotations(df), "starts_with(voice_description, 'Error: ')")

CATALOG.add(
    "has_audio",
    lambda s, d: filters.has_audio(
        waves(s, d).withColumn("audio", F.when(F.col("speaker_id") != "S_1", F.col("audio")))
    ).select("idx", "speaker_id"),
    with_views("SELECT idx, speaker_id FROM wave WHERE speaker_id <> 'S_1'", "wave"),
)
CATALOG.add(
    "distinct_datasets",
    lambda s, d: filters.distinct_values(samples(s, d), "dataset"),
    on_samples("SELECT DISTINCT dataset FROM samples"),
)
CATALOG.add(
    "distinct_accents",
    lambda s, d: filters.distinct_values(samples(s, d), "accent"),
    on_samples("SELECT DISTINCT accent FROM samples"),
)
CATALOG.add(
    "distinct_customers",
    lambda s, d: filters.distinct_values(table(s, d, "orders"), "o_custkey"),
    "SELECT DISTINCT o_custkey FROM orders",
)
