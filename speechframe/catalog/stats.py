"""Aggregations."""

from pyspark.sql import functions as F

from speechframe.catalog.base import Catalog, on_samples, rounded, samples, sql_words, table
from speechframe.operators import quality, quantiles, stats
from speechframe.plans.report import summary_report

CATALOG = Catalog()
add = CATALOG.add

ENRICHED = f""", rich AS (
  SELECT *, length(transcript) AS transcript_length, {sql_words('transcript')} AS word_count,
         length(voice_description) AS description_length,
         {sql_words('transcript')} / nullif(duration, 0) * 60 AS speaking_rate
  FROM samples)
"""


def on_rich(sql: str) -> str:
    return on_samples("").rstrip() + ENRICHED + sql


add(
    "basic_stats",
    lambda s, d: rounded(stats.basic_stats(samples(s, d))),
    on_samples(
        """SELECT count(*) AS total_samples, count(DISTINCT speaker_id) AS unique_speakers,
        round(sum(duration) / 3600, 6) AS total_duration_hours, round(avg(duration), 6) AS avg_duration_seconds,
        count(DISTINCT accent) AS unique_accents FROM samples"""
    ),
)

for column in ["dataset", "gender", "age"]:
    add(
        f"value_counts_{column}",
        lambda s, d, c=column: stats.value_counts(samples(s, d), c),
        on_samples(f"SELECT {column} AS value, count(*) AS count FROM samples WHERE {column} IS NOT NULL GROUP BY 1"),
    )
for column in ["gender", "age"]:
    add(
        f"value_shares_{column}",
        lambda s, d, c=column: rounded(stats.value_counts(samples(s, d), c, normalize=True)),
        on_samples(
            f"""SELECT {column} AS value, round(count(*) / sum(count(*)) OVER (), 6) AS share
            FROM samples WHERE {column} IS NOT NULL GROUP BY 1"""
        ),
    )
for column, k in [("accent", 10), ("accent", 20), ("accent", 5), ("speaker_id", 10)]:
    add(
        f"top_{k}_{column}",
        lambda s, d, c=column, n=k: stats.top_k(samples(s, d), c, n),
        on_samples(
            f"""SELECT {column} AS value, count(*) AS count FROM samples WHERE {column} IS NOT NULL
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {k}"""
        ),
    )
add(
    "count_by_source",
    lambda s, d: stats.count_by_source(samples(s, d)),
    on_samples("SELECT dataset, count(*) AS count FROM samples GROUP BY 1"),
)
add(
    "count_by_accent_with_null",
    lambda s, d: stats.count_by_source(samples(s, d), "accent"),
    on_samples("SELECT accent, count(*) AS count FROM samples GROUP BY 1"),
)
for column in ["gender", "dataset"]:
    add(
        f"share_pct_{column}",
        lambda s, d, c=column: rounded(stats.share_pct(samples(s, d), c)),
        on_samples(
            f"""SELECT {column} AS value, count(*) AS count, round(count(*) / sum(count(*)) OVER () * 100, 6) AS pct
            FROM samples WHERE {column} IS NOT NULL GROUP BY 1"""
        ),
    )

HISTOGRAM = """, h AS (SELECT CAST({column} AS DOUBLE) AS x, {weight} AS w FROM {source} WHERE {column} IS NOT NULL),
 e AS (SELECT min(x) - CASE WHEN min(x) = max(x) THEN 0.5 ELSE 0 END AS lo,
              max(x) + CASE WHEN min(x) = max(x) THEN 0.5 ELSE 0 END AS hi FROM h),
 c AS (SELECT least({bins} - 1, CAST(floor((x - lo) * {bins} / (hi - lo)) AS INTEGER)) AS bin, sum(w) AS n FROM h, e GROUP BY 1)
SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * ((hi - lo) / {bins}), 6) AS lo,
       round(lo + (b.bin + 1) * ((hi - lo) / {bins}), 6) AS hi, CAST(coalesce(n, 0) AS BIGINT) AS count
FROM range({bins}) b(bin) CROSS JOIN e LEFT JOIN c ON c.bin = b.bin"""

for column in ["duration", "transcript_length", "word_count", "description_length", "speaking_rate"]:
    add(
        f"histogram_{column}",
        lambda s, d, c=column: rounded(stats.histogram(stats.enrich(samples(s, d)), c, 50)),
        on_rich(HISTOGRAM.format(column=column, source="rich", bins=50, weight="1")),
    )
add(
    "histogram_30_description_length",
    lambda s, d: rounded(stats.histogram(stats.enrich(samples(s, d)), "description_length", 30)),
    on_rich(HISTOGRAM.format(column="description_length", source="rich", bins=30, weight="1")),
)
add(
    "histogram_extended_price",
    lambda s, d: rounded(stats.histogram(table(s, d, "lineitem"), "l_extendedprice", 50)),
    "WITH z AS (SELECT 1)" + HISTOGRAM.format(column="l_extendedprice", source="lineitem", bins=50, weight="1"),
)
add(
    "frequency_of_frequency",
    lambda s, d: rounded(stats.frequency_of_frequency(samples(s, d))),
    on_samples("").rstrip()
    + ", f AS (SELECT count(*) AS n FROM samples WHERE accent IS NOT NULL GROUP BY accent)"
    + HISTOGRAM.format(column="n", source="f", bins=30, weight="1"),
)
add(
    "samples_per_speaker_histogram",
    lambda s, d: rounded(stats.frequency_of_frequency(table(s, d, "orders"), "o_custkey", 30)),
    "WITH f AS (SELECT count(*) AS n FROM orders GROUP BY o_custkey)"
    + HISTOGRAM.format(column="n", source="f", bins=30, weight="1"),
)

BOX = """, q AS (SELECT {by}, quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.5) AS median, quantile_cont({col}, 0.75) AS q3
   FROM {src} WHERE {by} IS NOT NULL AND {col} IS NOT NULL GROUP BY 1)
SELECT {by}, CAST(count(*) AS BIGINT) AS rows, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
  round(min({col}) FILTER (WHERE {col} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_low,
  round(max({col}) FILTER (WHERE {col} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
  count(*) FILTER (WHERE NOT {col} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS fliers
FROM {src} JOIN q USING ({by}) WHERE {col} IS NOT NULL GROUP BY 1"""

add(
    "box_stats_duration",
    lambda s, d: rounded(quantiles.box_stats(samples(s, d), "dataset", "duration")),
    on_samples("").rstrip() + BOX.format(by="dataset", col="duration", src="samples"),
)
add(
    "box_stats_price",
    lambda s, d: rounded(quantiles.box_stats(table(s, d, "lineitem"), "l_returnflag", "l_extendedprice")),
    "WITH z AS (SELECT 1)" + BOX.format(by="l_returnflag", col="l_extendedprice", src="lineitem"),
)

PERCENTILES = """SELECT CAST(p AS DOUBLE) AS percentile, round(q, 6) AS value FROM (
  SELECT unnest([10, 25, 50, 75, 90, 95, 99]) AS p,
         unnest(quantile_cont({col}, [0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99])) AS q FROM {src})"""
add(
    "percentiles_duration",
    lambda s, d: rounded(quantiles.percentiles(samples(s, d), "duration")),
    on_samples(PERCENTILES.format(col="duration", src="samples")),
)
add(
    "percentiles_price",
    lambda s, d: rounded(quantiles.percentiles(table(s, d, "lineitem"), "l_extendedprice")),
    PERCENTILES.format(col="l_extendedprice", src="lineitem"),
)
add(
    "percentiles_price_by_rank",
    lambda s, d: rounded(
        quantiles.percentiles_of(
            table(s, d, "lineitem"), "l_extendedprice", quantiles.QUARTILES, ["l_returnflag"]
        ).select("l_returnflag", "n", *[F.col("q")[i].alias(c) for i, c in enumerate(["q1", "median", "q3"])])
    ),
    """SELECT l_returnflag, count(*) AS n, round(quantile_cont(l_extendedprice, 0.25), 6) AS q1,
    round(quantile_cont(l_extendedprice, 0.5), 6) AS median, round(quantile_cont(l_extendedprice, 0.75), 6) AS q3
    FROM lineitem GROUP BY 1""",
)
add(
    "percentiles_approx",
    lambda s, d: rounded(quantiles.percentiles(samples(s, d), "duration", approx=True)),
    # with fewer rows than the sketch's accuracy it gives the value at the rank itself
    on_samples(
        """SELECT CAST(p AS DOUBLE) AS percentile, round((SELECT arg_min(duration, place) FROM
        (SELECT duration, row_number() OVER (ORDER BY duration) AS place, count(*) OVER () AS n FROM samples WHERE duration IS NOT NULL) WHERE place >= p * n / 100.0), 6) AS value
        FROM (SELECT unnest([10, 25, 50, 75, 90, 95, 99]) AS p)"""
    ),
)


def approximate(s, d):
    """The approximate statistics, with whether each distinct count is within a tenth of the exact one."""
    row = stats.basic_stats(samples(s, d), approx=True)
    for c in ("unique_speakers", "unique_accents"):
        exact = samples(s, d).agg(F.count_distinct(c.removeprefix("unique_").removesuffix("s") + ("_id" if "speaker" in c else ""))).scalar()
        row = row.withColumn(c, F.abs(F.col(c) - exact) <= 0.1 * exact)
    return rounded(row)


add(
    "basic_stats_approx",
    approximate,
    on_samples(
        """SELECT count(*) AS total_samples, true AS unique_speakers, round(sum(duration) / 3600, 6) AS total_duration_hours,
        round(avg(duration), 6) AS avg_duration_seconds, true AS unique_accents FROM samples"""
    ),
)

for a, b in [("dataset", "gender"), ("age", "gender")]:
    add(
        f"crosstab_{a}_{b}",
        lambda s, d, x=a, y=b: stats.crosstab(samples(s, d), x, y, ["female", "male", "other", "unknown"]),
        on_samples(
            f"""SELECT x.{a}, y.{b}, count(z.idx) AS count FROM
            (SELECT DISTINCT {a} FROM samples WHERE {a} IS NOT NULL AND {b} IS NOT NULL) x CROSS JOIN
            (SELECT DISTINCT {b} FROM samples WHERE {a} IS NOT NULL AND {b} IS NOT NULL) y
            LEFT JOIN samples z ON z.{a} = x.{a} AND z.{b} = y.{b} GROUP BY 1, 2"""
        ),
    )
add(
    "crosstab_wide_age_gender",
    lambda s, d: stats.crosstab_wide(samples(s, d), "age", "gender", ["female", "male", "other", "unknown"]),
    on_samples(
        """SELECT age, count(*) FILTER (WHERE gender = 'female') AS female, count(*) FILTER (WHERE gender = 'male') AS male,
        count(*) FILTER (WHERE gender = 'other') AS other, count(*) FILTER (WHERE gender = 'unknown') AS unknown
        FROM samples GROUP BY 1"""
    ),
)
for column in ["accent", "speaker_id"]:
    add(
        f"distinct_{column}_per_source",
        lambda s, d, c=column: stats.distinct_per_group(samples(s, d), "dataset", c),
        on_samples(f"SELECT dataset, count(DISTINCT {column}) AS distinct_values FROM samples GROUP BY 1"),
    )
add(
    "mean_duration_per_source",
    lambda s, d: rounded(stats.mean_per_group(samples(s, d))),
    on_samples("SELECT dataset, round(avg(duration), 6) AS mean FROM samples GROUP BY 1"),
)
add(
    "hours_per_source",
    lambda s, d: rounded(stats.hours_per_group(samples(s, d))),
    on_samples("SELECT dataset, round(sum(duration) / 3600, 6) AS hours FROM samples GROUP BY 1"),
)
add(
    "mean_value_per_event_type",
    lambda s, d: rounded(stats.mean_per_group(table(s, d, "events"), "event_type", "value")),
    "SELECT event_type, round(avg(value), 6) AS mean FROM events GROUP BY 1",
)

REGION = """CASE WHEN lower({c}) LIKE '%american%' OR lower({c}) LIKE '%us%' OR lower({c}) LIKE '%california%' OR lower({c}) LIKE '%texas%' OR lower({c}) LIKE '%new york%' THEN 'North American'
 WHEN lower({c}) LIKE '%british%' OR lower({c}) LIKE '%english%' OR lower({c}) LIKE '%scottish%' OR lower({c}) LIKE '%welsh%' OR lower({c}) LIKE '%irish%' THEN 'British Isles'
 WHEN lower({c}) LIKE '%australian%' OR lower({c}) LIKE '%new zealand%' THEN 'Oceanic'
 WHEN lower({c}) LIKE '%indian%' OR lower({c}) LIKE '%south asian%' THEN 'South Asian'
 WHEN lower({c}) LIKE '%african%' THEN 'African'
 WHEN lower({c}) LIKE '%japanese%' OR lower({c}) LIKE '%chinese%' OR lower({c}) LIKE '%korean%' OR lower({c}) LIKE '%asian%' THEN 'East Asian'
 WHEN lower({c}) LIKE '%european%' OR lower({c}) LIKE '%german%' OR lower({c}) LIKE '%french%' OR lower({c}) LIKE '%spanish%' OR lower({c}) LIKE '%italian%' THEN 'European'
 WHEN {c} IS NOT NULL THEN 'Other' END"""
add(
    "region_counts",
    lambda s, d: stats.region_counts(samples(s, d)),
    on_samples(f"SELECT {REGION.format(c='accent')} AS region, count(*) AS count FROM samples WHERE accent IS NOT NULL GROUP BY 1"),
)

PAIRS = [(a, b) for a in stats.NUMERIC for b in stats.NUMERIC]
CORR = "CASE WHEN var_pop({x}) FILTER (WHERE {y} IS NOT NULL) * var_pop({y}) FILTER (WHERE {x} IS NOT NULL) > 0 THEN round(corr({x}, {y}), 6) END"
add(
    "correlation_matrix",
    lambda s, d: rounded(stats.correlation(stats.enrich(samples(s, d)))),
    on_rich(
        " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {CORR.format(x=a, y=b)} AS r FROM rich" for a, b in PAIRS)
    ),
)
LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
add(
    "correlation_lineitem",
    lambda s, d: rounded(stats.correlation(table(s, d, "lineitem"), LINE)),
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {CORR.format(x=a, y=b)} AS r FROM lineitem" for a in LINE for b in LINE
    ),
)

RICH_COLUMNS = ["idx", "dataset", "speaker_id", "transcript", "duration", "gender", "age", "accent", "voice_description",
                "transcript_length", "word_count", "description_length", "speaking_rate"]
add(
    "missing_by_column",
    lambda s, d: quality.missing_by_column(samples(s, d)),
    on_rich(
        " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing FROM rich" for c in RICH_COLUMNS)
        + " UNION ALL SELECT 'total', "
        + " + ".join(f"count(*) - count({c})" for c in RICH_COLUMNS)
        + " FROM rich"
    ),
)
add(
    "unknown_counts",
    lambda s, d: quality.unknown_counts(samples(s, d)),
    on_samples(
        "SELECT "
        + ", ".join(f"count(*) FILTER (WHERE {c} = 'unknown') AS unknown_{c}" for c in ["gender", "age", "accent"])
        + " FROM samples"
    ),
)
add(
    "completeness",
    lambda s, d: rounded(quality.completeness(samples(s, d))),
    on_samples(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", round(100.0 * count(*) FILTER (WHERE {c} IS DISTINCT FROM 'unknown') / count(*), 6) AS pct FROM samples"
            for c in ["gender", "age", "accent"]
        )
        + "".join(
            f" UNION ALL SELECT '{c}', round(100.0 * count(*) FILTER (WHERE {c} <> '') / count(*), 6) FROM samples"
            for c in ["transcript", "voice_description"]
        )
    ),
)
OUTLIERS = """, b AS (SELECT quantile_cont(duration, 0.25) AS q1, quantile_cont(duration, 0.75) AS q3 FROM samples),
 c AS (SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM b)"""
add(
    "outlier_summary",
    lambda s, d: rounded(quantiles.outlier_summary(samples(s, d))),
    on_samples("").rstrip()
    + OUTLIERS
    + """ SELECT round(any_value(q1), 6) AS q1, round(any_value(q3), 6) AS q3, round(any_value(lower), 6) AS lower, round(any_value(upper), 6) AS upper,
    count(*) FILTER (WHERE duration < lower OR duration > upper) AS outliers FROM samples, c""",
)
add(
    "duration_outliers",
    lambda s, d: rounded(quantiles.duration_outliers(samples(s, d)).select("idx", "duration", "lower_bound", "upper_bound")),
    on_samples("").rstrip()
    + OUTLIERS
    + """ SELECT idx, round(duration, 6) AS duration, round(lower, 6) AS lower_bound, round(upper, 6) AS upper_bound
    FROM samples, c WHERE duration < lower OR duration > upper""",
)
add(
    "text_metrics",
    lambda s, d: rounded(stats.text_metrics(samples(s, d))),
    on_rich(
        """SELECT round(avg(transcript_length), 6) AS avg_transcript_length, round(avg(word_count), 6) AS avg_word_count,
        round(avg(description_length), 6) AS avg_description_length, round(avg(speaking_rate), 6) AS avg_speaking_rate,
        count(*) - count(speaking_rate) AS rows_without_rate FROM rich"""
    ),
)
add(
    "description_stats",
    lambda s, d: rounded(stats.description_stats(samples(s, d), ["voice_description", "character_description"])),
    on_samples(
        """SELECT 'lengths' AS section, 'total_samples' AS key, CAST(count(*) AS DOUBLE) AS value FROM samples
        UNION ALL SELECT 'lengths', 'avg_voice_description_length', round(avg(coalesce(length(voice_description), 0)), 6) FROM samples
        UNION ALL SELECT 'lengths', 'std_voice_description_length', round(stddev_pop(coalesce(length(voice_description), 0)), 6) FROM samples
        UNION ALL SELECT 'lengths', 'avg_character_description_length', 0.0
        UNION ALL SELECT 'lengths', 'std_character_description_length', 0.0 """
        + "".join(
            f"UNION ALL SELECT 'distribution_{c}', coalesce({c}, 'unknown'), CAST(count(*) AS DOUBLE) FROM samples GROUP BY 2 "
            for c in ["gender", "age", "accent"]
        )
    ),
)
add(
    "diversity_report",
    lambda s, d: rounded(stats.diversity_report(samples(s, d))),
    on_samples("").rstrip()
    + rf""", w AS (SELECT unnest(regexp_extract_all(lower(voice_description), '{sql_words("x").split("'")[1]}')) AS word FROM samples)
    SELECT 'size' AS section, 'dataset_size' AS key, CAST(count(*) AS DOUBLE) AS value FROM samples
    UNION ALL SELECT 'size', 'total_accents', CAST(count(DISTINCT accent) AS DOUBLE) FROM samples
    UNION ALL SELECT 'size', 'mean_duration', round(avg(duration), 6) FROM samples
    UNION ALL SELECT 'size', 'std_duration', round(stddev_samp(duration), 6) FROM samples
    UNION ALL SELECT 'size', 'total_hours', round(sum(duration) / 3600, 6) FROM samples
    UNION ALL SELECT 'size', 'median_duration', round(quantile_cont(duration, 0.5), 6) FROM samples
    UNION ALL SELECT 'accent_distribution', accent, CAST(count(*) AS DOUBLE) FROM samples WHERE accent IS NOT NULL GROUP BY 2
    UNION ALL (SELECT 'dominant_accents', accent, CAST(count(*) AS DOUBLE) AS n FROM samples WHERE accent IS NOT NULL GROUP BY 2 ORDER BY n DESC, accent LIMIT 5)
    UNION ALL SELECT 'gender_balance', gender, round(count(*) / sum(count(*)) OVER (), 6) FROM samples WHERE gender IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'age_distribution', age, round(count(*) / sum(count(*)) OVER (), 6) FROM samples WHERE age IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'source_datasets', dataset, CAST(count(*) AS DOUBLE) FROM samples GROUP BY 2
    UNION ALL (SELECT 'common_descriptors', word, CAST(count(*) AS DOUBLE) AS n FROM w GROUP BY 2 ORDER BY n DESC, word LIMIT 20)""",
)
add(
    "compare_sources",
    lambda s, d: rounded(stats.compare_sources(samples(s, d))),
    on_samples(
        """SELECT dataset, count(*) AS sample_count, round(avg(duration), 6) AS avg_duration,
        count(DISTINCT accent) AS unique_accents FROM samples GROUP BY 1"""
    ),
)
add(
    "compare_source_distributions",
    lambda s, d: stats.compare_distributions(samples(s, d)),
    on_samples(
        """SELECT dataset, 'gender' AS field, gender AS value, count(*) AS count FROM samples WHERE gender IS NOT NULL GROUP BY 1, 3
        UNION ALL SELECT dataset, 'age', age, count(*) FROM samples WHERE age IS NOT NULL GROUP BY 1, 3
        UNION ALL SELECT dataset, 'accent', accent, n FROM (
          SELECT dataset, accent, count(*) AS n, row_number() OVER (PARTITION BY dataset ORDER BY count(*) DESC, accent) AS rn
          FROM samples WHERE accent IS NOT NULL GROUP BY 1, 2) WHERE rn <= 3"""
    ),
)
POOL = """SELECT speaker_id, count(*) AS sample_count, round(sum(duration), 6) AS total_duration,
  (list(gender ORDER BY idx))[1] AS gender, (list(age ORDER BY idx))[1] AS age,
  (list(accent ORDER BY idx))[1] AS accent, (list(voice_description ORDER BY idx))[1] AS voice_profile
FROM samples WHERE duration BETWEEN 1 AND 8 AND gender IS DISTINCT FROM 'unknown' GROUP BY 1 HAVING count(*) >= {n}"""
add("speaker_pool", lambda s, d: rounded(stats.speaker_pool(samples(s, d))), on_samples(POOL.format(n=3)))
add(
    "top_speakers",
    lambda s, d: rounded(stats.top_speakers(samples(s, d), 10)),
    on_samples(POOL.format(n=3) + " ORDER BY sample_count DESC, speaker_id LIMIT 10"),
)
add(
    "duration_buckets",
    lambda s, d: quality.duration_buckets(samples(s, d)),
    on_samples(
        """SELECT count(*) FILTER (WHERE duration < 1) AS very_short, count(*) FILTER (WHERE duration >= 1 AND duration < 3) AS short,
        count(*) FILTER (WHERE duration >= 3 AND duration < 8) AS medium, count(*) FILTER (WHERE duration >= 8) AS long FROM samples"""
    ),
)
add(
    "quality_score",
    lambda s, d: rounded(quality.quality_score(samples(s, d))),
    on_samples("").rstrip()
    + """, a AS (SELECT count(*) AS total_samples,
      count(*) FILTER (WHERE gender IS DISTINCT FROM 'unknown' AND age IS DISTINCT FROM 'unknown' AND accent IS DISTINCT FROM 'unknown') AS complete_demographics,
      count(*) FILTER (WHERE gender = 'unknown') AS missing_gender, count(*) FILTER (WHERE age = 'unknown') AS missing_age,
      count(*) FILTER (WHERE accent = 'unknown') AS missing_accent, count(*) FILTER (WHERE length(transcript) = 0) AS empty_transcripts,
      count(*) FILTER (WHERE length(transcript) < 10) AS short_transcripts, round(avg(length(transcript)), 6) AS avg_transcript_length,
      count(DISTINCT speaker_id) AS total_speakers,
      (SELECT count(*) FROM (SELECT speaker_id FROM samples GROUP BY 1 HAVING count(*) > 1)) AS speakers_with_multiple_samples,
      count(*) FILTER (WHERE duration >= 3 AND duration < 8) AS medium_duration FROM samples)
    SELECT *, round(100 * (0.3 * complete_demographics / total_samples + 0.3 * medium_duration / total_samples
      + 0.2 * (total_samples - empty_transcripts) / total_samples + 0.2 * speakers_with_multiple_samples / total_speakers), 6) AS overall_quality_score FROM a""",
)
add(
    "corpus_card",
    lambda s, d: rounded(
        stats.corpus_card(samples(s, d)).select(
            "total_samples",
            "total_duration_hours",
            "version",
            "sample_rate",
            "license",
            F.array_join("source_datasets", ",").alias("source_datasets"),
        )
    ),
    on_samples(
        """SELECT count(*) AS total_samples, round(sum(duration) / 3600, 6) AS total_duration_hours, '1.0' AS version,
        '16kHz' AS sample_rate, 'CC0 1.0 Universal' AS license, string_agg(DISTINCT dataset, ',' ORDER BY dataset) AS source_datasets FROM samples"""
    ),
)
RUN = lambda s, d: table(s, d, "labels").join(table(s, d, "documents"), "doc_id").select(
    F.col("doc_id").alias("idx"), (F.col("n_chars") / 1000.0).alias("seconds")
)
RUN_SQL = "WITH run AS (SELECT doc_id AS idx, n_chars / 1000.0 AS seconds FROM labels JOIN documents USING (doc_id)) "
add(
    "run_progress",
    lambda s, d: rounded(stats.progress(RUN(s, d))),
    RUN_SQL
    + "SELECT count(*) AS processed_count, max(idx) AS last_index, count(*) > 0 AS has_data, CAST(round(sum(seconds), 6) AS DOUBLE) AS total_time FROM run",
)
add(
    "run_eta",
    lambda s, d: rounded(stats.eta(stats.progress(RUN(s, d)), 1_000_000)),
    RUN_SQL
    + """SELECT 1000000 - count(*) AS remaining_samples, round(CAST(sum(seconds) AS DOUBLE) / count(*) * (1000000 - count(*)) / 3600, 6) AS estimated_hours,
    round(CAST(sum(seconds) AS DOUBLE) / count(*), 6) AS avg_seconds_per_sample FROM run""",
)
add(
    "summary_report",
    lambda s, d: rounded(summary_report(samples(s, d))),
    on_rich(
        """SELECT 1 AS section_rank, 'overview' AS section, 'total_samples' AS metric, CAST(count(*) AS DOUBLE) AS value FROM rich
        UNION ALL SELECT 1, 'overview', 'total_duration_hours', round(sum(duration) / 3600, 6) FROM rich
        UNION ALL SELECT 1, 'overview', 'avg_duration_seconds', round(avg(duration), 6) FROM rich
        UNION ALL SELECT 1, 'overview', 'unique_speakers', CAST(count(DISTINCT speaker_id) AS DOUBLE) FROM rich
        UNION ALL SELECT 1, 'overview', 'unique_accents', CAST(count(DISTINCT accent) AS DOUBLE) FROM rich
        UNION ALL SELECT 2, 'datasets', dataset, CAST(count(*) AS DOUBLE) FROM rich GROUP BY 3
        UNION ALL SELECT 3, 'genders', gender, CAST(count(*) AS DOUBLE) FROM rich WHERE gender IS NOT NULL GROUP BY 3
        UNION ALL SELECT 4, 'ages', age, CAST(count(*) AS DOUBLE) FROM rich GROUP BY 3
        UNION ALL (SELECT 5, 'top_accents', accent, CAST(count(*) AS DOUBLE) AS n FROM rich WHERE accent IS NOT NULL GROUP BY 3 ORDER BY n DESC, accent LIMIT 10)
        """
        + "".join(
            f"UNION ALL SELECT 6, 'text', 'avg_{c}', round(avg({c}), 6) FROM rich "
            for c in ["transcript_length", "word_count", "description_length", "speaking_rate"]
        )
        + "UNION ALL SELECT 7, 'quality', 'missing_values', CAST("
        + " + ".join(f"count(*) - count({c})" for c in RICH_COLUMNS)
        + " AS DOUBLE) FROM rich "
        + "".join(
            f"UNION ALL SELECT 7, 'quality', 'unknown_{c}', CAST(count(*) FILTER (WHERE {c} = 'unknown') AS DOUBLE) FROM rich "
            for c in ["gender", "age", "accent"]
        )
    ),
)
