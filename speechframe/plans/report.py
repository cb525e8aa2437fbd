"""The analysis report as ordered long rows."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from speechframe.functions.scalars import hours
from speechframe.operators.stats import enrich, unpivot
from speechframe.schemas import DEMOGRAPHICS, UNKNOWN

SECTIONS = {"dataset": ("datasets", 2), "gender": ("genders", 3), "age": ("ages", 4), "accent": ("top_accents", 5)}
TOP_ACCENTS = 10


def _distributions(df: DataFrame) -> DataFrame:
    """Value counts of all four columns in one scan; of the accents only the most frequent are kept."""
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("metric")) for c in SECTIONS])
    counted = df.select(F.inline(cells)).where(F.col("metric").isNotNull()).groupBy("field", "metric")
    counted = counted.agg(F.count("*").alias("n"))
    accents = counted.where("field = 'accent'").orderBy(F.desc("n"), "metric").limit(TOP_ACCENTS)
    listed = counted.where("field <> 'accent'").unionByName(accents)
    name = F.create_map(*[F.lit(x) for c, (s, _) in SECTIONS.items() for x in (c, s)])
    rank = F.create_map(*[F.lit(x) for c, (_, r) in SECTIONS.items() for x in (c, r)])
    return listed.select(
        F.element_at(rank, F.col("field")).alias("section_rank"),
        F.element_at(name, F.col("field")).alias("section"),
        "metric",
        F.col("n").cast("double").alias("value"),
    )


def _block(row: DataFrame, section: str, rank: int) -> DataFrame:
    return unpivot(row, section).select(F.lit(rank).alias("section_rank"), "section", F.col("key").alias("metric"), "value")


def summary_report(df: DataFrame) -> DataFrame:
    """Rows ``(section_rank, section, metric, value)``; how they are worded is up to the caller.

    Three scans: the distributions, the distinct counts, and everything that needs no shuffle.
    """
    rich = enrich(df)
    plain = rich.agg(
        F.count("*").alias("total_samples"),
        hours(F.sum("duration")).alias("total_duration_hours"),
        F.avg("duration").alias("avg_duration_seconds"),
        *[F.avg(c).alias(f"avg_{c}") for c in ["transcript_length", "word_count", "description_length", "speaking_rate"]],
        reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in rich.columns]).alias("missing_values"),
        *[F.count_if(F.col(c) == UNKNOWN).alias(f"unknown_{c}") for c in DEMOGRAPHICS],
    )
    cells = {
        "overview": (1, ["total_samples", "total_duration_hours", "avg_duration_seconds"]),
        "text": (6, [f"avg_{c}" for c in ["transcript_length", "word_count", "description_length", "speaking_rate"]]),
        "quality": (7, ["missing_values", *[f"unknown_{c}" for c in DEMOGRAPHICS]]),
    }
    pairs = [
        F.struct(F.lit(rank).alias("section_rank"), F.lit(s).alias("section"), F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
        for s, (rank, names) in cells.items()
        for c in names
    ]
    distinct = df.agg(
        F.count_distinct("speaker_id").alias("unique_speakers"), F.count_distinct("accent").alias("unique_accents")
    )
    return plain.select(F.inline(F.array(*pairs))).unionByName(_block(distinct, "overview", 1)).unionByName(_distributions(df))
