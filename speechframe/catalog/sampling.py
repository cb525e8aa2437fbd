"""Sampling and splitting."""

from pyspark.sql import functions as F

from speechframe.catalog.base import Catalog, on_samples, samples, table
from speechframe.catalog.tables import SPLIT_SQL
from speechframe.operators import records, sampling

CATALOG = Catalog()
add = CATALOG.add


def uniform(seed, key):
    return f"CAST('0x' || substr(md5(concat('{seed}:', {key})), 1, 8) AS BIGINT) / 4294967296.0"


def numbered(s, d):
    return samples(s, d).withColumn("idx", F.col("idx") + 1)


WALK = f"SELECT i AS idx FROM (SELECT idx + 1 AS i FROM samples) WHERE (i <= 1 OR {uniform(7, 'i')} < least(1.0, 100 / (i * 2.0)))"
add(
    "decaying_sample",
    lambda s, d: sampling.decaying_sample(numbered(s, d), 100, seed=7).select("idx"),
    on_samples(WALK + " ORDER BY i LIMIT 100"),
)
add(
    "decaying_sample_resumed",
    lambda s, d: sampling.decaying_sample(
        numbered(s, d), 100, seed=7, already=20, processed=table(s, d, "labels").select(F.col("doc_id").alias("idx"))
    ).select("idx"),
    on_samples(WALK + " AND i NOT IN (SELECT doc_id FROM labels) ORDER BY i LIMIT 80"),
)
add(
    "split3",
    lambda s, d: sampling.split3(samples(s, d), caps=sampling.SPLIT_CAPS).select("idx", "split", "position"),
    on_samples("").rstrip() + SPLIT_SQL + "SELECT idx, split, position FROM m",
)
add(
    "split3_uncapped",
    lambda s, d: sampling.split3(samples(s, d)).select("idx", "split", "position"),
    on_samples("").rstrip()
    + SPLIT_SQL.replace("least(10000, n * 2 // 3)", "n * 2 // 3").replace("least(3000, n // 6)", "n // 6").replace("least(2000, n - tr - va)", "n - tr - va")
    + "SELECT idx, split, position FROM m",
)
add(
    "split_projection",
    lambda s, d: records.split_projection(sampling.split3(samples(s, d), caps=sampling.SPLIT_CAPS)).select("split", "speaker_id", "transcript", "gender", "dataset"),
    on_samples("").rstrip()
    + SPLIT_SQL
    + "SELECT split, position AS speaker_id, transcript, gender, dataset FROM m JOIN samples USING (idx)",
)
add(
    "sample_n",
    lambda s, d: sampling.sample_n(samples(s, d), 50, seed=3).select("idx", "speaker_id"),
    on_samples("SELECT idx, speaker_id FROM samples ORDER BY md5(concat('3:', idx)), idx LIMIT 50"),
)
add(
    "pick_one",
    lambda s, d: sampling.pick_one(samples(s, d), 5, "female", "twenties", "warm").select("character_profile.*", "sample_text", "speaker_id"),
    on_samples(
        """SELECT gender, age, accent, 'warm' AS personality, voice_description, transcript AS sample_text, speaker_id FROM samples
        WHERE gender = 'female' AND age = 'twenties' AND contains(lower(voice_description), 'warm') ORDER BY md5(concat('5:', idx)), idx LIMIT 1"""
    ),
)
add(
    "pick_one_without_match",
    lambda s, d: sampling.pick_one(samples(s, d), 5, "female", "fifties", "deep").agg(F.count("*").alias("rows")),
    on_samples("SELECT count(*) AS rows FROM samples WHERE gender = 'female' AND age = 'fifties'"),
)
add(
    "train_test",
    lambda s, d: sampling.train_test(samples(s, d)).select("idx", "is_test"),
    on_samples(f"SELECT idx, {uniform(42, 'idx')} < 0.2 AS is_test FROM samples"),
)
