"""Counts, distributions, histograms and correlations.

Value counts come back as long rows ``(value, count)``: they stay distributed however many values there are.
"""

from pyspark.sql import Column, DataFrame, functions as F

from speechframe.functions.scalars import (
    accent_region,
    char_length,
    finite,
    hours,
    speaking_rate,
    word_count,
)
from speechframe.operators.ordinal import top_k_per_group
from speechframe.operators.quantiles import median
from speechframe.schemas import DEMOGRAPHICS, UNKNOWN


def enrich(df: DataFrame) -> DataFrame:
    """Text metrics of every row: one narrow projection that the statistics below share."""
    return (
        df.withColumn("transcript_length", char_length("transcript"))
        .withColumn("word_count", word_count("transcript"))
        .withColumn("description_length", char_length("voice_description"))
        .withColumn("speaking_rate", finite(speaking_rate("word_count", "duration")))
    )


# --- counts and shares -------------------------------------------------------------------------


def basic_stats(df: DataFrame, approx: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(
        F.count("*").alias("total_samples"),
        distinct("speaker_id").alias("unique_speakers"),
        hours(F.sum("duration")).alias("total_duration_hours"),
        F.avg("duration").alias("avg_duration_seconds"),
        distinct("accent").alias("unique_accents"),
    )


def counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value, unordered."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("count"))


def value_counts(df: DataFrame, column: str, normalize: bool = False) -> DataFrame:
    """Rows (or shares of the non-null rows) per value, most frequent first."""
    counted = counts(df, column)
    if normalize:
        # Summing the counts rather than scanning the rows again
        total = counted.agg(F.sum("count")).scalar()
        return counted.select("value", (F.col("count") / total).alias("share")).orderBy(F.desc("share"), "value")
    return counted.orderBy(F.desc("count"), "value")


def top_k(df: DataFrame, column: str, k: int) -> DataFrame:
    return counts(df, column).orderBy(F.desc("count"), "value").limit(k)


def count_by_source(df: DataFrame, column: str = "dataset") -> DataFrame:
    """Rows per source; a null source is a key of its own."""
    return df.groupBy(column).agg(F.count("*").alias("count"))


def share_pct(df: DataFrame, column: str) -> DataFrame:
    counted = counts(df, column)
    total = counted.agg(F.sum("count")).scalar()
    return counted.withColumn("pct", F.col("count") / total * 100.0)


def crosstab(df: DataFrame, a: str, b: str, values=None) -> DataFrame:
    """Contingency table in long form ``(a, b, count)`` of the combinations that occur.

    With a list of ``values`` of ``b``, every ``a`` has a row for each of them, 0 where they do not occur together.
    """
    both = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    counted = both.groupBy(a, b).agg(F.count("*").alias("count"))
    if values is None:
        return counted
    grid = counted.select(a).distinct().withColumn(b, F.explode(F.array(*[F.lit(v) for v in values])))
    return grid.join(counted, [a, b], "left").withColumn("count", F.coalesce("count", F.lit(0).cast("bigint")))


def crosstab_wide(df: DataFrame, a: str, b: str, values) -> DataFrame:
    """Contingency table with one column per listed value of ``b``."""
    return df.where(F.col(a).isNotNull()).groupBy(a).pivot(b, list(values)).count().na.fill(0)


def distinct_per_group(df: DataFrame, by: str, column: str) -> DataFrame:
    """Distinct non-null values per group; both distinct steps shuffle on (group, value)."""
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(F.count_distinct(column).alias("distinct_values"))


def mean_per_group(df: DataFrame, by: str = "dataset", column: str = "duration") -> DataFrame:
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(F.avg(column).alias("mean"))


def hours_per_group(df: DataFrame, by: str = "dataset", column: str = "duration") -> DataFrame:
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(hours(F.sum(column)).alias("hours"))


def region_counts(df: DataFrame) -> DataFrame:
    """Rows per accent region: accents are counted first, so the rules run once per accent."""
    regions = counts(df, "accent").groupBy(accent_region("value").alias("region"))
    return regions.agg(F.sum("count").cast("bigint").alias("count"))


# --- histograms --------------------------------------------------------------------------------


def histogram(df: DataFrame, column: str, bins: int = 50, weight: str | None = None) -> DataFrame:
    """Equal-width bins over the finite values, the last one closed: rows ``(bin, lo, hi, count)``.

    A column with a single value gets the range value -0.5 .. value +0.5.
    """
    value = finite(F.col(column).cast("double"))
    rows = df.select(value.alias("x"), (F.col(weight) if weight else F.lit(1)).alias("w")).where("x IS NOT NULL")
    pad = F.when(F.min("x") == F.max("x"), 0.5).otherwise(0.0)
    edges = rows.agg(F.struct((F.min("x") - pad).alias("lo"), (F.max("x") + pad).alias("hi")).alias("e")).scalar()
    placed = rows.withColumn("e", edges)
    at = F.floor((F.col("x") - F.col("e.lo")) * bins / (F.col("e.hi") - F.col("e.lo")))
    counted = placed.groupBy(F.least(F.lit(bins - 1), at).cast("int").alias("bin")).agg(F.sum("w").alias("n"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    # at most `bins` rows on either side
    filled = spine.join(F.broadcast(counted), "bin", "left").withColumn("e", edges)
    width = (F.col("e.hi") - F.col("e.lo")) / bins
    return filled.select(
        "bin",
        (F.col("e.lo") + F.col("bin") * width).alias("lo"),
        (F.col("e.lo") + (F.col("bin") + 1) * width).alias("hi"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("count"),
    )


def frequency_of_frequency(df: DataFrame, column: str = "accent", bins: int = 30) -> DataFrame:
    """Histogram of the rows per value."""
    per_value = counts(df, column).groupBy("count").agg(F.count("*").alias("values"))
    return histogram(per_value, "count", bins, weight="values")


# --- correlation -------------------------------------------------------------------------------

NUMERIC = ["duration", "transcript_length", "word_count", "description_length", "speaking_rate"]


def correlation(df: DataFrame, cols=NUMERIC) -> DataFrame:
    """Pearson matrix as rows ``(a, b, r)`` over the rows where both are present; null where one is constant.

    One pass of plain aggregates; a task sends one row.
    """
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    numbers = df.select(*[finite(F.col(c).cast("double")).alias(c) for c in cols])
    sums = []
    for i, (a, b) in enumerate(pairs):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
        sums.append(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)).alias(f"r{i}"))
    cells = [F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs) for x, y in dict.fromkeys([(a, b), (b, a)])]
    return numbers.agg(*sums).select(F.inline(F.array(*cells)))


# --- text metrics and descriptions -------------------------------------------------------------


def text_metrics(df: DataFrame) -> DataFrame:
    """Mean text sizes and speaking rate; rows without a finite rate are left out of it and counted."""
    return enrich(df).agg(
        F.avg("transcript_length").alias("avg_transcript_length"),
        F.avg("word_count").alias("avg_word_count"),
        F.avg("description_length").alias("avg_description_length"),
        F.avg("speaking_rate").alias("avg_speaking_rate"),
        F.count_if(F.col("speaking_rate").isNull()).alias("rows_without_rate"),
    )


def description_stats(df: DataFrame, cols=("voice_description",)) -> DataFrame:
    """Rows ``(section, key, value)``: mean and population deviation of each description's length (a missing
    column counts 0), demographic counts (a missing value counts as 'unknown') and processing dates."""
    lengths = {c: F.coalesce(F.length(c), F.lit(0)) if c in df.columns else F.lit(0) for c in cols}
    sizes = df.agg(
        F.count("*").cast("double").alias("total_samples"),
        *[F.avg(x).alias(f"avg_{c}_length") for c, x in lengths.items()],
        *[F.stddev_pop(x).alias(f"std_{c}_length") for c, x in lengths.items()],
    )
    out = unpivot(sizes, "lengths")
    for field in DEMOGRAPHICS:
        # a column that is missing is unknown in every row
        value = F.coalesce(field, F.lit(UNKNOWN)) if field in df.columns else F.lit(UNKNOWN)
        out = out.unionByName(_section(df, field, f"distribution_{field}", value))
    if "processing_timestamp" in df.columns:
        dated = df.where(F.col("processing_timestamp").isNotNull())
        out = out.unionByName(_section(dated, "processing_timestamp", "processing_dates"))
    return out


def unpivot(row: DataFrame, section: str) -> DataFrame:
    """One-row aggregate to long rows ``(section, key, value)``."""
    pairs = [F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in row.columns]
    return row.select(F.inline(F.array(*pairs))).select(F.lit(section).alias("section"), "key", "value")


def _section(df: DataFrame, column: str, section: str, key: Column | None = None, limit: int | None = None):
    key = F.col(column) if key is None else key
    counted = df.groupBy(key.alias("key")).agg(F.count("*").alias("n")).where(F.col("key").isNotNull())
    if limit:
        counted = counted.orderBy(F.desc("n"), "key").limit(limit)
    return counted.select(F.lit(section).alias("section"), "key", F.col("n").cast("double").alias("value"))


# --- reports -----------------------------------------------------------------------------------


def diversity_report(df: DataFrame) -> DataFrame:
    """Rows ``(section, key, value)``: accents, gender and age shares, durations, common words, sources."""
    from speechframe.operators.text_search import word_frequency

    sizes = df.agg(
        F.count("*").alias("dataset_size"),
        F.count_distinct("accent").alias("total_accents"),
        F.avg("duration").alias("mean_duration"),
        F.stddev_samp("duration").alias("std_duration"),
        hours(F.sum("duration")).alias("total_hours"),
    )
    middle = median(df, "duration")
    parts = [
        unpivot(sizes, "size"),
        unpivot(middle.withColumnRenamed("median", "median_duration"), "size"),
        _section(df, "accent", "accent_distribution"),
        _section(df, "accent", "dominant_accents", limit=5),
        _shares(df, "gender", "gender_balance"),
        _shares(df, "age", "age_distribution"),
        _section(df, "dataset", "source_datasets"),
        word_frequency(df, 20).select(
            F.lit("common_descriptors").alias("section"), F.col("word").alias("key"), F.col("count").cast("double").alias("value")
        ),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _shares(df: DataFrame, column: str, section: str) -> DataFrame:
    counted = counts(df, column)
    total = counted.agg(F.sum("count")).scalar()
    return counted.select(F.lit(section).alias("section"), F.col("value").alias("key"), (F.col("count") / total).alias("value"))


def compare_sources(df: DataFrame) -> DataFrame:
    """One row per source: rows, mean duration, distinct accents."""
    return df.where(F.col("dataset").isNotNull()).groupBy("dataset").agg(
        F.count("*").alias("sample_count"),
        F.avg("duration").alias("avg_duration"),
        F.count_distinct("accent").alias("unique_accents"),
    )


def compare_distributions(df: DataFrame, k: int = 3) -> DataFrame:
    """Rows ``(dataset, field, value, count)``: gender and age distributions and the top accents of every source."""
    known = df.where(F.col("dataset").isNotNull())
    long = known.select(
        "dataset",
        F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in DEMOGRAPHICS])),
    ).where(F.col("value").isNotNull())
    counted = long.groupBy("dataset", "field", "value").agg(F.count("*").alias("count"))
    accents = top_k_per_group(counted.where("field = 'accent'"), "dataset", [F.desc("count"), F.asc("value")], k)
    return counted.where("field <> 'accent'").unionByName(accents.drop("rank"))


def top_values_per_group(df: DataFrame, by: str, column: str, k: int) -> DataFrame:
    rows = df.where(F.col(by).isNotNull() & F.col(column).isNotNull())
    counted = rows.groupBy(by, column).agg(F.count("*").alias("count"))
    return top_k_per_group(counted, by, [F.desc("count"), F.asc(column)], k)


def speaker_pool(df: DataFrame, min_n: int = 3, max_dur: float = 8.0, key: str = "idx") -> DataFrame:
    """Speakers with at least ``min_n`` usable rows: count, total duration and the attributes of their first row."""
    usable = df.where((F.col("duration") <= max_dur) & (F.col("duration") >= 1.0) & ~F.col("gender").eqNullSafe(UNKNOWN))
    first = F.min_by(F.struct("gender", "age", "accent", "voice_description"), key)
    pool = usable.where(F.col("speaker_id").isNotNull()).groupBy("speaker_id").agg(
        F.count("*").alias("sample_count"), F.sum("duration").alias("total_duration"), first.alias("first")
    )
    return pool.where(F.col("sample_count") >= min_n).select(
        "speaker_id",
        "sample_count",
        "total_duration",
        "first.gender",
        "first.age",
        "first.accent",
        F.col("first.voice_description").alias("voice_profile"),
    )


def top_speakers(df: DataFrame, n: int = 10, **options) -> DataFrame:
    return speaker_pool(df, **options).orderBy(F.desc("sample_count"), "speaker_id").limit(n)


def corpus_card(df: DataFrame) -> DataFrame:
    """One row describing the corpus. The static fields are fixed values."""
    fields = {
        "version": "1.0",
        "sample_rate": "16kHz",
        "format": "WAV audio with text descriptions",
        "license": "CC0 1.0 Universal",
    }
    lists = {
        "languages": ["English", "Japanese", "Multiple"],
        "applications": [
            "Voice synthesis",
            "Character voice generation",
            "Voice cloning",
            "Speech analysis",
            "Audio-language modeling",
        ],
    }
    row = df.agg(
        F.count("*").alias("total_samples"),
        hours(F.sum("duration")).alias("total_duration_hours"),
    )
    # distinct first, so that the one task of the list gets each name once
    names = df.where(F.col("dataset").isNotNull()).select("dataset").distinct().agg(F.array_sort(F.collect_list("dataset")))
    row = row.withColumn("source_datasets", names.scalar())
    for name, value in fields.items():
        row = row.withColumn(name, F.lit(value))
    for name, values in lists.items():
        row = row.withColumn(name, F.array(*[F.lit(v) for v in values]))
    return row


def progress(processed: DataFrame, key: str = "idx", seconds: str = "seconds") -> DataFrame:
    """State of a run from its table of processed keys."""
    return processed.agg(
        F.count(key).alias("processed_count"),
        F.coalesce(F.max(key), F.lit(-1)).alias("last_index"),
        (F.count(key) > 0).alias("has_data"),
        F.coalesce(F.sum(seconds), F.lit(0.0)).alias("total_time"),
    )


def eta(state: DataFrame, total: int) -> DataFrame:
    """Remaining rows, seconds per row and hours left; nothing processed leaves the estimate null."""
    done = F.col("processed_count")
    pace = F.try_divide(F.col("total_time"), done)
    return state.select(
        (F.lit(total) - done).alias("remaining_samples"),
        hours((F.lit(total) - done) * pace).alias("estimated_hours"),
        pace.alias("avg_seconds_per_sample"),
    )
