"""Views over the given tables that have the corpus shape, and the query register.

The view texts run unchanged in Spark and in the checking database. They keep every row and the whole text.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


SAMPLES = """
SELECT doc_id AS idx,
       source AS dataset,
       concat('S_', CAST(doc_id % 61 AS STRING)) AS speaker_id,
       CASE WHEN doc_id % 37 = 0 THEN '' WHEN doc_id % 41 = 0 THEN NULL ELSE text END AS transcript,
       CASE WHEN doc_id % 50 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(n_chars AS DOUBLE) / CAST(150 AS DOUBLE) END AS duration,
       CASE WHEN doc_id % 101 = 7 THEN NULL WHEN doc_id % 10 < 5 THEN 'female' WHEN doc_id % 10 < 8 THEN 'male'
            WHEN doc_id % 10 = 8 THEN 'unknown' ELSE 'other' END AS gender,
       CASE doc_id % 7 WHEN 4 THEN 'teens' WHEN 5 THEN 'fourties' WHEN 6 THEN 'unknown' ELSE 'twenties' END AS age,
       CASE doc_id % 15 WHEN 0 THEN 'General American' WHEN 1 THEN 'United States English' WHEN 2 THEN 'British RP'
            WHEN 3 THEN 'New Zealand English' WHEN 4 THEN 'Australian English' WHEN 5 THEN 'Indian' WHEN 6 THEN 'South African'
            WHEN 7 THEN 'Japanese' WHEN 8 THEN 'Caucasian' WHEN 9 THEN 'German' WHEN 10 THEN 'Russian' WHEN 11 THEN 'unknown'
            WHEN 12 THEN NULL WHEN 13 THEN 'New Zealand' ELSE 'Brazilian' END AS accent,
       CASE WHEN doc_id % 29 = 0 THEN 'Error: no audio' WHEN doc_id % 43 = 0 THEN NULL ELSE concat(
            CASE doc_id % 5 WHEN 0 THEN 'Warm, medium pitch and clear. ' WHEN 1 THEN 'Deep, powerful low voice. '
                 WHEN 2 THEN 'Bright high-pitched youthful tone. ' WHEN 3 THEN 'A professional, smooth and rich delivery. ' ELSE '' END,
            text) END AS voice_description
FROM documents
"""

RESPONSES = """
SELECT doc_id AS idx,
       CASE WHEN doc_id % 4 = 0 THEN 'globe_v2' ELSE 'tagged' END AS dataset,
       CASE doc_id % 9
         WHEN 0 THEN concat('GENDER: Female', chr(10), 'AGE: early twenties', chr(10), 'ACCENT: Neutral', chr(10), 'VOICE_PROFILE: ', text)
         WHEN 1 THEN concat('gender: a man', chr(10), 'age: 35', chr(10), 'accent:  British RP ', chr(10), 'voice_profile:', chr(10), text, chr(10))
         WHEN 2 THEN concat('GENDER: ', chr(10), 'AGE: 1950s', chr(10), text)
         WHEN 3 THEN concat('LANGUAGE: 20 ', chr(10), 'GENDER: non-binary', chr(10), text)
         WHEN 4 THEN concat('  ', text, '  ')
         WHEN 5 THEN concat('GENDER: German', chr(10), 'AGE: older', chr(10), 'ACCENT: none given', chr(10), 'VOICE_PROFILE:')
         WHEN 6 THEN concat('AGE: sixteen to 19', chr(10), 'ACCENT: ', chr(10), chr(10), 'VOICE_PROFILE:  ')
         WHEN 7 THEN concat('GENDER: Woman', chr(10), 'AGE: forties', chr(10), 'ACCENT: Irish')
         ELSE NULL END AS response
FROM documents
"""

WAVE = """
SELECT vec_id AS idx, embedding AS samples, 16 AS sampling_rate, concat('S_', CAST(label AS STRING)) AS speaker_id FROM embeddings
"""

VIEWS = {"samples": (SAMPLES, "documents"), "responses": (RESPONSES, "documents"), "wave": (WAVE, "embeddings")}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    text, source = VIEWS[name]
    return spark.sql(text.replace(f"FROM {source}", f"FROM {{{source}}}"), **{source: table(spark, sf, source)})


def samples(spark, sf):
    return view(spark, sf, "samples")


def responses(spark, sf):
    return view(spark, sf, "responses")


def waves(spark, sf):
    """Waveform rows with an ``audio`` struct."""
    wave = view(spark, sf, "wave")
    return wave.withColumn("audio", F.struct(F.col("samples").alias("array"), F.col("sampling_rate")))


def with_views(sql: str, *names: str) -> str:
    """SQL for the checking database with the named views in front."""
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][0]})" for n in names) + "\n" + sql


def on_samples(sql: str) -> str:
    return with_views(sql, "samples")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round the floating columns, as both engines sum in their own order."""
    shown = [F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name) for f in df.schema]
    return df.select(*shown)


# Whitespace and word classes in the checking database's regular expressions.
SQL_WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
SQL_WORD = r"[^\s\x0b\x1c-\x1f\x85\p{Z}]+"


def sql_words(column: str) -> str:
    return f"CAST(len(regexp_extract_all({column}, '{SQL_WORD}')) AS INTEGER)"


def sql_strip(column: str) -> str:
    return rf"regexp_replace({column}, '^{SQL_WS}+|{SQL_WS}+\z', '', 'g')"


class Catalog:
    def __init__(self):
        self.queries, self.oracle = {}, {}

    def add(self, name: str, run, sql: str | None = None):
        assert name not in self.queries, name
        self.queries[name] = run
        if sql:
            self.oracle[name] = sql
