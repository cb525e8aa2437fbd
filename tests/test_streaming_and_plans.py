"""Restart behaviour of the streams, and the shape of the physical plans."""

import pytest
from pyspark.sql import functions as F

from speechframe.catalog.base import samples, table
from speechframe.operators import filters, joins, ordinal, quality, sampling, stats
from speechframe.session import workspace
from speechframe.sources.readers import stream_records
from speechframe.streaming import ingest as streams

SCHEMA = "id long, duration double"


@pytest.fixture
def folder(spark):
    path = workspace(spark, "stream")
    spark.range(10).select("id", F.col("id").cast("double").alias("duration")).repartition(5).write.parquet(path)
    return path


def feed(spark, folder, n=1):
    return stream_records(spark, folder, spark.read.parquet(folder).schema, "parquet", n)


def test_ingest_resumes_after_the_last_batch(spark, folder):
    place = workspace(spark, "ingest")
    for _ in range(2):
        streams.ingest(feed(spark, folder), f"{place}/sink", f"{place}/ck").awaitTermination()
    assert spark.read.parquet(f"{place}/sink").count() == 10
    spark.range(10, 13).select("id", F.lit(1.0).alias("duration")).write.mode("append").parquet(folder)
    streams.ingest(feed(spark, folder), f"{place}/sink", f"{place}/ck").awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{place}/sink").collect()) == list(range(13))


def test_batch_totals_and_bound(spark, folder):
    files = len(spark.read.parquet(folder).inputFiles())
    place = workspace(spark, "totals")
    streams.batch_totals(feed(spark, folder), f"{place}/all", f"{place}/ck1")
    got = streams.running_batch_totals(spark, f"{place}/all").orderBy("batch_id").collect()
    assert len(got) == files and sum(r.rows for r in got) == 10 and got[-1].running_total == 45.0
    streams.max_batches(feed(spark, folder), 2, f"{place}/two", f"{place}/ck2")
    assert sorted(r.batch_id for r in spark.read.parquet(f"{place}/two").collect()) == [0, 1]
    # a later run counts its own batches
    streams.max_batches(feed(spark, folder), 1, f"{place}/two", f"{place}/ck2")
    assert sorted(r.batch_id for r in spark.read.parquet(f"{place}/two").collect()) == [0, 1, 2]
    assert streams.running_batch_totals(spark, f"{place}/none").collect() == []
    # the rest was left unread: a run without the limit goes on with it
    streams.batch_totals(feed(spark, folder), f"{place}/two", f"{place}/ck2")
    assert spark.read.parquet(f"{place}/two").agg(F.sum("rows")).collect()[0][0] == 10


def test_a_failing_batch_is_not_hidden(spark, folder):
    place = workspace(spark, "failing")
    broken = feed(spark, folder).withColumn("duration", F.raise_error(F.lit("broken row")).cast("double"))
    with pytest.raises(Exception, match="broken row"):
        streams.batch_totals(broken, f"{place}/sink", f"{place}/ck")
    with pytest.raises(Exception, match="broken row"):
        streams.max_batches(broken, 2, f"{place}/sink", f"{place}/ck")


def test_dedup_across_batches(spark, folder):
    place = workspace(spark, "dedup")
    keys = streams.dedup(feed(spark, folder).select((F.col("id") % 3).alias("k")), ["k"])
    streams.ingest(keys, f"{place}/sink", f"{place}/ck").awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(f"{place}/sink").collect()) == [0, 1, 2]


def test_json_records_stream(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1, "duration": 2.0}, {"id": 2, "duration": 3.0}]')
    place = workspace(spark, "json")
    schema = spark.createDataFrame([], SCHEMA).schema
    streams.save_counts(streams.streaming_counts(stream_records(spark, str(tmp_path), schema), "id"), f"{place}/sink", f"{place}/ck")
    assert sorted((r.value, r["count"]) for r in spark.read.parquet(f"{place}/sink").collect()) == [(1, 1), (2, 1)]


# --- plans ---------------------------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_totalprice", "duration").withColumn("gender", F.col("o_orderstatus"))
    text = plan(filters.high_quality(orders, "b").select("o_orderkey"))
    assert "GreaterThan(o_totalprice,1.0)" in text and "LessThan(o_totalprice,10.0)" in text
    assert "o_orderpriority" not in text


def test_metadata_queries_read_no_text(spark, sf):
    text = plan(stats.basic_stats(samples(spark, sf)))
    assert "ReadSchema: struct<doc_id:bigint,n_chars:bigint>" in text


def test_top_k_needs_no_full_sort(spark, sf):
    assert "TakeOrderedAndProject" in plan(stats.top_k(samples(spark, sf), "accent", 10))
    assert "WindowGroupLimit" in plan(stats.top_values_per_group(samples(spark, sf), "dataset", "accent", 3))


def test_ordinals_do_not_pass_through_one_task(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    for df in [ordinal.with_ordinal(orders, ["o_totalprice", "o_orderkey"]), ordinal.running_sum(orders, ["o_totalprice", "o_orderkey"], "o_totalprice")]:
        lines = plan(df).split("\n")
        single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
        # only the per-range totals meet in one task: below it there is their aggregation
        assert single and all(any("HashAggregate" in line for line in lines[i : i + 3]) for i in single)


def test_outliers_use_no_join(spark, sf):
    from speechframe.operators.quantiles import duration_outliers

    text = plan(duration_outliers(samples(spark, sf)))
    assert "Join" not in text and "CartesianProduct" not in text


def test_no_registered_query_multiplies_tables(spark, sf):
    import __spark_entry__ as entry

    for name in ["correlation_matrix", "quality_score", "crosstab_age_gender", "box_stats_duration", "histogram_duration", "attach_audio", "find_similar_unigrams"]:
        text = plan(entry.queries()[name](spark, sf))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_frequent_keys_are_salted(spark):
    left = spark.range(100).select("id", F.lit("k").alias("k"))
    text = plan(joins.lookup(left, spark.createDataFrame([("k", 1)], "k string, v int"), "k", "id"))
    assert "_salt" in text


def test_counting_audio_shuffles_no_waveform(spark, sf):
    from speechframe.catalog import joins as catalog
    from speechframe.plans import corpus

    status = corpus.source_status(catalog.records(spark, sf), catalog.files(spark, sf), catalog.originals(spark, sf), "laions")
    exchanged = [line for line in plan(status).split("\n") if "Exchange" in line]
    assert exchanged and not any("embedding" in line or "audio" in line for line in exchanged)


def test_measured_corpus_is_filtered_in_the_scan(spark, sf):
    from speechframe.sources.sinks import write_corpus

    path = workspace(spark, "measured")
    write_corpus(samples(spark, sf), path, measured=True)
    kept = filters.min_description(spark.read.parquet(path), 60)
    text = plan(kept.select("idx"))
    assert "GreaterThanOrEqual(description_chars,60)" in text and "voice_description" not in text
    assert kept.count() == filters.min_description(samples(spark, sf), 60).count()


def test_approximate_counts_are_close(spark, sf):
    exact, approx = stats.basic_stats(samples(spark, sf)).collect()[0], stats.basic_stats(samples(spark, sf), approx=True).collect()[0]
    assert abs(exact.unique_speakers - approx.unique_speakers) <= 0.1 * exact.unique_speakers
    assert quality.unknown_counts(samples(spark, sf)).count() == 1


def test_dedup_with_an_event_time_drops_old_keys(spark, folder):
    place = workspace(spark, "dedup")
    timed = feed(spark, folder).select((F.col("id") % 3).alias("k"), F.timestamp_seconds("id").alias("at"))
    unique = streams.dedup(timed, ["k"], "at", "1 hour")
    streams.ingest(unique, f"{place}/sink", f"{place}/ck").awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(f"{place}/sink").collect()) == [0, 1, 2]


def test_search_reads_only_the_terms_asked_for(spark, sf):
    from speechframe.operators import text_search

    df = samples(spark, sf)
    path = text_search.search_index(df, workspace(spark, "index"))
    asked = text_search._asked(spark, path, "warm clear voice", (1, 1), text_search.ENGLISH_STOP_WORDS)
    text = plan(text_search.blocks_above(spark, path, asked, 3)[0])
    # the conditions on terms and on largest weights reach the scan
    assert "PushedFilters" in text and "EqualTo(term" in text and "GreaterThanOrEqual(top" in text
    assert not any("LeftOuter" in line and "term" in line for line in plan(text_search.search(df, path, "warm clear voice", 3)).split("\n"))


def test_missing_columns_count_as_unknown(spark):
    rows = spark.createDataFrame([("abc",), (None,)], "voice_description string")
    got = {(r.section, r.key): r.value for r in stats.description_stats(rows).collect()}
    assert got["distribution_gender", "unknown"] == 2 and got["distribution_accent", "unknown"] == 2


def test_crosstab_lists_what_occurs(spark):
    df = spark.createDataFrame([("x", "p"), ("x", "p"), ("y", "q"), (None, "q")], "a string, b string")
    assert sorted(map(tuple, stats.crosstab(df, "a", "b").collect())) == [("x", "p", 2), ("y", "q", 1)]
    assert sorted(map(tuple, stats.crosstab(df, "a", "b", ["p", "q"]).collect())) == [("x", "p", 2), ("x", "q", 0), ("y", "p", 0), ("y", "q", 1)]
