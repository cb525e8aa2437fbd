"""Ordinals, running sums, percentiles and sampling: dense, exact and independent of partitioning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from speechframe.operators import filters, quantiles, sampling
from speechframe.operators.ordinal import cumulative_hours, running_sum, running_total, with_ordinal


@pytest.fixture(scope="module")
def numbers(spark):
    """A third of the rows share one value."""
    x = F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000)) / 10)
    return spark.range(3000).select("id", x.alias("x"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"))


@pytest.mark.parametrize("partitions", [1, 17])
def test_ordinal_is_dense(numbers, partitions):
    got = with_ordinal(numbers.repartition(partitions), ["x", "id"], start=1).collect()
    want = sorted((r.x, r.id) for r in numbers.collect())
    assert sorted((r.ordinal, r.x, r.id) for r in got) == [(i + 1, x, k) for i, (x, k) in enumerate(want)]


def test_ordinal_per_group(numbers):
    got = with_ordinal(numbers, ["id"], by="g").toPandas()
    for _, group in got.groupby("g"):
        assert sorted(group["ordinal"]) == list(range(len(group)))
        assert list(group.sort_values("id")["ordinal"]) == list(range(len(group)))


def test_running_sum(numbers):
    got = running_sum(numbers, ["x", "id"], "x", with_index="at").toPandas().sort_values("at")
    assert list(got["at"]) == list(range(3000))
    assert np.allclose(got["running"], np.cumsum(np.sort(got["x"])))


def test_cumulative_hours_skips_null(spark):
    df = spark.createDataFrame([(1, 7200.0), (2, None), (3, 3600.0)], "idx long, duration double")
    assert sorted(map(tuple, cumulative_hours(df).collect())) == [(0, 3, 3600.0, 1.0), (1, 1, 7200.0, 3.0)]


def test_running_total(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 3.0), (2, 4.0)], "b int, v double")
    assert sorted(map(tuple, running_total(df, "b", "v").collect())) == [(1, 2, 5.0, 5.0), (2, 1, 4.0, 9.0)]


# a coarse sketch leaves ranks outside their brackets, which are then widened
@pytest.mark.parametrize("accuracy", [20, 20_000])
def test_percentiles_equal_numpy(numbers, accuracy):
    ps = [0.1, 0.25, 0.5, 0.9, 0.99]
    row = quantiles.percentiles_of(numbers, "x", ps, accuracy=accuracy).collect()[0]
    x = np.array([r.x for r in numbers.collect()])
    assert row.n == 3000 and np.allclose(row.q, np.quantile(x, ps))


@pytest.mark.parametrize("accuracy", [20, 20_000])
def test_percentiles_per_group(numbers, accuracy):
    got = {r.g: r.q for r in quantiles.percentiles_of(numbers, "x", [0.25, 0.6], ["g"], accuracy).collect()}
    for g, group in numbers.toPandas().groupby("g"):
        assert np.allclose(got[g], np.quantile(group["x"], [0.25, 0.6]))


# more rows than a sketch of usual accuracy keeps
def test_percentiles_at_the_rank(spark):
    df = spark.range(150_001).select(((F.col("id") * 7919) % 150_001 / 150.0).alias("x")).unionByName(spark.createDataFrame([(None,)], "x double"))
    ps, x = [0, 10, 25, 50, 75, 90, 95, 99, 100], np.arange(150_001) / 150.0
    got = {r.percentile: r.value for r in quantiles.percentiles(df, "x", ps, approx=True).collect()}
    assert got == dict(zip(ps, np.quantile(x, np.array(ps) / 100, method="inverted_cdf")))


def test_split3_sizes_and_disjoint(spark):
    df = spark.range(1000).select(F.col("id").alias("idx"), F.when(F.col("id") < 900, F.repeat(F.lit("x"), 60)).otherwise("short").alias("voice_description"))
    caps = {"train": 500, "validation": 100, "test": 50}
    dealt = sampling.split3(df, caps=caps).select("idx", "split", "position").toPandas()
    assert dealt.groupby("split").size().to_dict() == {"train": 500, "validation": 100, "test": 50}
    assert dealt["idx"].is_unique and dealt["idx"].max() < 900
    for _, part in dealt.groupby("split"):
        assert sorted(part["position"]) == list(range(len(part)))
    whole = sampling.split3(df, caps=None).groupBy("split").count().toPandas().set_index("split")["count"].to_dict()
    assert whole == {"train": 600, "validation": 150, "test": 150}


def test_split3_deals_out_every_row(spark):
    df = spark.range(20_000).select(F.col("id").alias("idx"), F.repeat(F.lit("x"), 60).alias("voice_description"))
    sizes = {r.split: r["count"] for r in sampling.split3(df).groupBy("split").count().collect()}
    assert sizes == {"train": 13_333, "validation": 3_333, "test": 3_334}


def test_samples_keep_their_partitions(spark):
    df = spark.range(0, 10_000, 1, 8).select(F.col("id").alias("idx"))
    for few in (sampling.sample_n(df, 500, 3), filters.first_n(df, 500), sampling.decaying_sample(df, 500)):
        assert few.count() <= 500 and few.rdd.getNumPartitions() == 8


def test_decaying_sample(spark):
    df = spark.range(1, 2001).select(F.col("id").alias("idx"))
    kept = [r.idx for r in sampling.decaying_sample(df, 50, seed=1).orderBy("idx").collect()]
    assert kept[0] == 1 and len(kept) == 50
    # every row up to max_n / 2 is certain
    assert kept[:25] == list(range(1, 26))
    assert sampling.decaying_sample(df, None).count() == 2000
    assert sampling.decaying_sample(df, 0).count() == 2000
    done = df.where("idx <= 10")
    resumed = [r.idx for r in sampling.decaying_sample(df, 50, seed=1, already=10, processed=done).collect()]
    assert len(resumed) == 40 and min(resumed) == 11


def test_pick_one_without_match(spark, sf):
    from speechframe.catalog.base import samples

    assert sampling.pick_one(samples(spark, sf), 1, "nobody").count() == 0


def test_train_test_is_stable(spark):
    df = spark.range(5000).withColumnRenamed("id", "idx")
    draw = lambda n: {r.idx for r in sampling.train_test(df.repartition(n)).where("is_test").collect()}
    assert draw(3) == draw(11) and 0.17 < len(draw(3)) / 5000 < 0.23
