"""Missing values, completeness and the quality score."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from speechframe.functions.scalars import known
from speechframe.operators.stats import enrich, unpivot
from speechframe.schemas import DEMOGRAPHICS, UNKNOWN


def missing_by_column(df: DataFrame, columns=None) -> DataFrame:
    """Rows ``(column, missing)`` and their total; the derived text columns are counted too."""
    df = enrich(df) if {"transcript", "voice_description", "duration"} <= set(df.columns) else df
    columns = list(columns or df.columns)
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    total = reduce(lambda a, b: a + b, [F.col(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in columns]
    return row.select(F.inline(F.array(*pairs, F.struct(F.lit("total").alias("column"), total.alias("missing")))))


def unknown_counts(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c) == UNKNOWN).alias(f"unknown_{c}") for c in DEMOGRAPHICS])


def completeness(df: DataFrame) -> DataFrame:
    """Percentage of complete rows per column: demographics not 'unknown' (null is complete), texts not empty."""
    share = lambda condition: F.avg(F.when(condition, 100.0).otherwise(0.0))
    text = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    row = df.agg(
        *[share(known(c)).alias(c) for c in DEMOGRAPHICS],
        *[share(text(c)).alias(c) for c in ["transcript", "voice_description"]],
    )
    return unpivot(row, "completeness").select(F.col("key").alias("column"), F.col("value").alias("pct"))


def duration_buckets(df: DataFrame) -> DataFrame:
    """very_short < 1 <= short < 3 <= medium < 8 <= long; a null duration is in none."""
    d = F.col("duration")
    return df.agg(
        F.count_if(d < 1.0).alias("very_short"),
        F.count_if((d >= 1.0) & (d < 3.0)).alias("short"),
        F.count_if((d >= 3.0) & (d < 8.0)).alias("medium"),
        F.count_if(d >= 8.0).alias("long"),
    )


def quality_score(df: DataFrame) -> DataFrame:
    """All quality counters and the weighted score, one row."""
    complete = known("gender") & known("age") & known("accent")
    size = F.length("transcript")
    # One shuffle by speaker carries every counter: the per-speaker partial sums are summed again.
    per_speaker = df.groupBy("speaker_id").agg(
        F.count("*").alias("n"),
        F.count_if(complete).alias("complete"),
        *[F.count_if(F.col(c) == UNKNOWN).alias(f"m_{c}") for c in DEMOGRAPHICS],
        F.count_if(size == 0).alias("empty"),
        F.count_if(size < 10).alias("brief"),
        F.sum(size).alias("chars"),
        F.count(size).alias("texts"),
        F.count_if((F.col("duration") >= 3.0) & (F.col("duration") < 8.0)).alias("medium"),
    )
    named = F.col("speaker_id").isNotNull()
    row = per_speaker.agg(
        F.sum("n").alias("total_samples"),
        F.sum("complete").alias("complete_demographics"),
        *[F.sum(f"m_{c}").alias(f"missing_{c}") for c in DEMOGRAPHICS],
        F.sum("empty").alias("empty_transcripts"),
        F.sum("brief").alias("short_transcripts"),
        F.try_divide(F.sum("chars"), F.sum("texts")).alias("avg_transcript_length"),
        F.count_if(named).alias("total_speakers"),
        F.count_if(named & (F.col("n") > 1)).alias("speakers_with_multiple_samples"),
        F.sum("medium").alias("medium_duration"),
    )
    n = F.col("total_samples")
    part = lambda amount, of, weight: F.try_divide(amount, of) * F.lit(weight)
    score = (
        part(F.col("complete_demographics"), n, 0.3)
        + part(F.col("medium_duration"), n, 0.3)
        + part(n - F.col("empty_transcripts"), n, 0.2)
        + part(F.col("speakers_with_multiple_samples"), F.col("total_speakers"), 0.2)
    ) * 100.0
    return row.withColumn("overall_quality_score", score)
