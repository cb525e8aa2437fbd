"""Reproducible sampling and splitting.

Every random choice is a hash of the seed and the row's key, so it does not depend on partitioning and
a recomputed task draws the same rows.
"""

from pyspark.sql import DataFrame, functions as F

from speechframe.functions.scalars import shuffle_key, uniform
from speechframe.operators.filters import leading, min_description, profile_candidates
from speechframe.operators.ordinal import with_ordinal

# The split sizes of the published corpus, for callers that ask for them.
SPLIT_CAPS = {"train": 10000, "validation": 3000, "test": 2000}


def decaying_sample(df: DataFrame, max_n=None, seed: int = 0, already: int = 0, key: str = "idx", processed=None):
    """Walk rows i = 1, 2, ... and keep row i with probability min(1, max_n / (2 i)) until max_n rows are kept.

    Rows listed in ``processed`` are skipped after the draw and count through ``already``.
    """
    i = F.col(key)
    if max_n:
        chance = F.least(F.lit(1.0), F.lit(float(max_n)) / (i * F.lit(2.0)))
        df = df.where((i <= 1) | (uniform(seed, i) < chance))
    if processed is not None:
        df = df.join(processed.select(key), key, "left_anti")
    return leading(df, max(max_n - already, 0), key) if max_n else df


def split3(df: DataFrame, seed: int = 42, caps=None, key: str = "idx", min_chars: int = 60) -> DataFrame:
    """Shuffle the rows with a long enough description and deal them all into train, validation and test.

    Returns ``df`` with ``split`` and the 0-based ``position`` in it. ``caps`` may bound the splits' sizes; what is over
    a cap is then left out. ``key`` must tell the rows apart. Only keys are numbered, in ranges, at any size.
    """
    kept = min_description(df, min_chars)
    keys = kept.select(F.col(key), shuffle_key(seed, F.col(key)).alias("_order"))
    size = kept.agg(F.count("*").alias("n"))
    dealt = with_ordinal(keys, ["_order", key], name="_at")
    n = F.col("_n")
    whole = lambda x: F.floor(x).cast("long")
    train, val = whole(n * 2 / 3), whole(n / 6)
    if caps:
        train = F.least(F.lit(caps["train"]), train)
        val = F.least(F.lit(caps["validation"]), val)
    test = n - F.col("_train") - F.col("_val")
    if caps:
        test = F.least(F.lit(caps["test"]), test)
    sized = dealt.withColumn("_n", size.scalar()).withColumn("_train", train).withColumn("_val", val)
    sized = sized.withColumn("_test", test)
    at, first, second = F.col("_at"), F.col("_train"), F.col("_train") + F.col("_val")
    members = sized.where(at < second + F.col("_test")).select(
        key,
        F.when(at < first, "train").when(at < second, "validation").otherwise("test").alias("split"),
        F.when(at < first, at).when(at < second, at - first).otherwise(at - second).cast("long").alias("position"),
    )
    return kept.join(members, key)


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("rows"), F.max("position").alias("last_position"))


def sample_n(df: DataFrame, n: int, seed: int = 0, key: str = "idx") -> DataFrame:
    """At most ``n`` random rows without replacement: those with the smallest hashes. ``key`` must tell the rows apart."""
    return leading(df, n, shuffle_key(seed, F.col(key)), key)


def pick_one(df: DataFrame, seed: int = 0, gender=None, age=None, personality=None, key: str = "idx") -> DataFrame:
    """One random matching row as a nested profile; no match gives no row."""
    row = sample_n(profile_candidates(df, gender, age, personality), 1, seed, key)
    profile = F.struct(
        "gender", "age", "accent", F.lit(personality).cast("string").alias("personality"), "voice_description"
    )
    audio = ["audio"] if "audio" in df.columns else []
    return row.select(profile.alias("character_profile"), *audio, F.col("transcript").alias("sample_text"), "speaker_id")


def train_test(df: DataFrame, test_share: float = 0.2, seed: int = 42, key: str = "idx") -> DataFrame:
    """``df`` with ``is_test``; unlike randomSplit the same under any partitioning."""
    return df.withColumn("is_test", uniform(seed, F.col(key)) < F.lit(test_share))
