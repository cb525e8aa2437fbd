"""Scalar functions, row by row."""

from pyspark.sql import functions as F

from speechframe.catalog.base import Catalog, on_samples, rounded, samples, sql_strip, sql_words, table
from speechframe.catalog.stats import REGION
from speechframe.functions import scalars

CATALOG = Catalog()
add = CATALOG.add

add(
    "accent_region",
    lambda s, d: samples(s, d).select("idx", scalars.accent_region("accent").alias("region")),
    on_samples(f"SELECT idx, {REGION.format(c='accent')} AS region FROM samples"),
)
TYPE = """CASE WHEN regexp_matches(lower({c}), 'young|youthful|teen|child') THEN 'young_character'
 WHEN regexp_matches(lower({c}), 'mature|adult|professional') THEN 'adult_character'
 WHEN regexp_matches(lower({c}), 'warm|friendly|gentle') THEN 'friendly_character'
 WHEN regexp_matches(lower({c}), 'deep|powerful|strong') THEN 'authoritative_character' WHEN {c} IS NOT NULL THEN 'neutral_character' END"""
add(
    "character_type",
    lambda s, d: samples(s, d).select("idx", scalars.character_type("voice_description").alias("label")),
    on_samples(f"SELECT idx, {TYPE.format(c='voice_description')} AS label FROM samples"),
)


def measures(s, d):
    df = samples(s, d).withColumn("words", scalars.word_count("transcript"))
    rate = scalars.speaking_rate("words", "duration")
    return rounded(
        df.select(
            "idx",
            scalars.char_length("transcript").alias("chars"),
            "words",
            rate.alias("rate"),
            scalars.finite(F.when(F.col("duration") == 0, float("inf")).otherwise(F.col("duration"))).alias("finite_duration"),
            scalars.hours("duration").alias("hours"),
        )
    )


add(
    "text_measures",
    measures,
    on_samples(
        f"""SELECT idx, CAST(length(transcript) AS INTEGER) AS chars, {sql_words('transcript')} AS words,
        round({sql_words('transcript')} / nullif(duration, 0) * 60, 6) AS rate, round(nullif(duration, 0), 6) AS finite_duration,
        round(duration / 3600, 6) AS hours FROM samples"""
    ),
)
add(
    "strip_text",
    lambda s, d: table(s, d, "documents").select("doc_id", scalars.strip(F.concat(F.lit(" \t\u00a0"), "text", F.lit("\u3000\n "))).alias("text")),
    f"SELECT doc_id, {sql_strip('concat(chr(32), chr(9), chr(160), text, chr(12288), chr(10), chr(32))')} AS text FROM documents",
)
add(
    "title_case",
    lambda s, d: table(s, d, "events").select("event_id", scalars.title(F.concat("event_type", F.lit("_of_user"))).alias("title")),
    "SELECT event_id, concat(upper(event_type[1]), lower(substr(event_type, 2)), ' Of User') AS title FROM events",
)


def formatted(s, d):
    return table(s, d, "orders").select(
        "o_orderkey",
        scalars.fmt_thousands("o_custkey").alias("thousands"),
        scalars.fmt_decimals(F.col("o_totalprice") / 8, 1).alias("decimals"),
        scalars.fmt_padded("o_orderkey", 6).alias("padded"),
    )


add(
    "format_numbers",
    formatted,
    "SELECT o_orderkey, format('{:,}', o_custkey) AS thousands, format('{:.1f}', o_totalprice / 8) AS decimals, format('{:06d}', o_orderkey) AS padded FROM orders",
)
add(
    "parse_timestamps",
    lambda s, d: table(s, d, "events").select(
        "event_id",
        F.date_format(scalars.parse_ts(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")), "yyyy-MM-dd HH:mm:ss").alias("at"),
        scalars.parse_ts("event_type").isNull().alias("unreadable"),
    ),
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS \"at\", true AS unreadable FROM events",
)
