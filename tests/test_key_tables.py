"""Rows and keys that stay where they were written: plans without an exchange on that side."""

import re

import pytest
from pyspark.sql import functions as F

from speechframe.catalog import joins as given
from speechframe.catalog.base import samples, table
from speechframe.operators import joins
from speechframe.plans import corpus
from speechframe.session import workspace
from speechframe.sources import key_tables


def nodes(df):
    """(depth, text) of each node of the physical plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[-1]
    return [(len(line) - len(line.lstrip(" :+-")), line.strip(" :+-")) for line in plan.split("\n") if line.strip()]


def above(df, scanned):
    """Nodes between the root and each scan that ``scanned`` names in its text."""
    stack, out = [], []
    for depth, text in nodes(df):
        stack = [s for s in stack if s[0] < depth]
        if "Scan" in text and re.search(scanned, text):
            out.append([t for _, t in stack])
        stack.append((depth, text))
    return out


def test_combination_moves_no_audio(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        combined = corpus.combine(given.four_sources(spark, sf))
        paths = above(combined, r"ReadSchema.*audio|audio#\d+.*Bucketed")
        assert paths and not any("Exchange" in t or t.startswith("Sort") for path in paths for t in path)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_combined_rows_keep_their_number_across_units(spark, monkeypatch):
    monkeypatch.setattr(corpus, "UNIT_BITS", 2)  # units of four rows
    row = lambda i: (i, f"S_{i}", f"text {i}", ([0.5, float(i)], 16), 1.0, "d", "female", "teens", "x", "laions")
    schema = "idx long, speaker_id string, transcript string, audio struct<array: array<float>, sampling_rate: int>, duration double, voice_description string, gender string, age string, accent string, dataset string"
    keys = [(37 * i) % 101 for i in range(101)]
    source = spark.createDataFrame([row(i) for i in keys], schema).repartition(5)
    got = {r["index"]: r.audio.array[1] for r in corpus.combine({"laions": source}).collect()}
    assert got == {i: float(i) for i in range(101)}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_a_second_recovery_reads_no_original_text(spark, sf):
    path = workspace(spark, "keys")
    key_tables.write_key_table(joins.original_keys(given.originals(spark, sf), "laions"), path, ["_key"], buckets=8)
    keys = key_tables.read_key_table(spark, path)
    missing = given.records(spark, sf)
    wanted = missing.select(joins.recovery_key("laions", "transcript").alias("_key")).where("_key IS NOT NULL").distinct()
    plans = above(wanted.hint("shuffle_merge").join(keys, "_key"), r"Bucketed: true")
    assert plans and not any("Exchange" in t for path in plans for t in path)
    # a table of originals whose text cannot be read serves as well: only ordinal and audio are asked for
    broken = given.originals(spark, sf).withColumn("text", F.raise_error(F.lit("text was read")).cast("string"))
    again = joins.recover_audio(missing, broken, "laions", keys=keys)
    first = joins.recover_audio(missing, given.originals(spark, sf), "laions")
    order = lambda df: sorted(map(repr, df.collect()))
    assert order(again) == order(first) and again.where("recovered_audio IS NOT NULL").count() > 0


def test_resume_from_buckets_moves_the_done_keys_no_more(spark, sf):
    path = workspace(spark, "done")
    key_tables.write_key_table(table(spark, sf, "labels").selectExpr("doc_id AS idx", "'x' AS dataset"), path, ["dataset", "idx"], buckets=8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done = key_tables.read_key_table(spark, path)
        paths = above(joins.resume(samples(spark, sf), done), r"Bucketed: true")
        assert paths and not any("Exchange" in t for path in paths for t in path)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("rows", [[], [(None, 1), (b"a", 2), (b"a", 3)]])
def test_key_tables_keep_all_rows(spark, rows):
    path = workspace(spark, "few")
    key_tables.write_key_table(spark.createDataFrame(rows, "k binary, n int"), path, ["k"], buckets=3)
    got = key_tables.read_key_table(spark, path)
    assert sorted((r.n, r.k) for r in got.collect()) == sorted((n, k and bytearray(k)) for k, n in rows)
    key_tables.write_key_table(spark.createDataFrame(rows, "k binary, n int"), path, ["k"], buckets=4)
    assert key_tables.read_key_table(spark, path).count() == len(rows)
