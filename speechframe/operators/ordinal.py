"""Dense row numbers and running sums over a whole table.

A window without a partition would pull every row into one task. Here the rows are range-partitioned
and sorted, each partition numbers its own rows, and only one row per partition (its count and sum)
is combined. The partitioned rows are materialised in between: range bounds are drawn from a sample,
so a second evaluation could cut the table elsewhere.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from speechframe.session import materialize


def _cols(order) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _in_ranges(df: DataFrame, order) -> DataFrame:
    """``df`` sorted by ``order`` with ``_part`` (range number) and ``_pos`` (place inside the range)."""
    ranged = df.repartitionByRange(*_cols(order)).sortWithinPartitions(*_cols(order))
    part = F.spark_partition_id()
    # the lower 33 bits of the generated id count the rows of one partition
    pos = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return materialize(ranged.withColumn("_part", part).withColumn("_pos", pos))


def _before(ranged: DataFrame, amount: Column) -> DataFrame:
    """Sum of ``amount`` before and up to the end of every range: one row per partition, so one task suffices."""
    totals = ranged.groupBy("_part").agg(F.sum(amount).alias("_sum"))
    so_far = F.sum("_sum").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0))
    return totals.withColumn("_upto", so_far).select("_part", (F.col("_upto") - F.col("_sum")).alias("_before"), "_upto")


def with_ordinal(df: DataFrame, order, start: int = 0, by=None, name: str = "ordinal") -> DataFrame:
    """Number the rows densely in ``order``, whose last column should make the order total.

    With ``by`` the numbers restart for every value of that column.
    """
    order = list(order)
    ranged = _in_ranges(df, [by, *order] if by else order)
    # one row per range on the broadcast side
    counted = ranged.join(F.broadcast(_before(ranged, F.lit(1))), "_part")
    counted = counted.withColumn(name, F.col("_before") + F.col("_pos")).drop("_part", "_pos", "_before", "_upto")
    if by:
        first = counted.groupBy(F.col(by).alias("_by")).agg(F.min(name).alias("_first"))
        counted = counted.join(first, F.col(by).eqNullSafe(F.col("_by")), "left")
        counted = counted.withColumn(name, F.col(name) - F.col("_first")).drop("_by", "_first")
    return counted.withColumn(name, F.col(name) + F.lit(start))


def running_sum(df: DataFrame, order, value: str, name: str = "running", with_index: str | None = None, around: Column | None = None) -> DataFrame:
    """Running sum of ``value`` (the row itself included) in ``order``, optionally with the 0-based index.

    ``around`` is an array of sums of interest: ranges in which none of them is passed are left out.
    """
    ranged = _in_ranges(df, order)
    before = _before(ranged, F.col(value))
    if around is not None:
        passed = F.exists("_around", lambda x: (F.col("_before") <= x) & (x < F.col("_upto")))
        before = before.withColumn("_around", around).where(passed).drop("_around")
    # one row per range on the broadcast side
    located = ranged.join(F.broadcast(before), "_part")
    inside = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    out = located.withColumn(name, F.col("_before") + F.sum(value).over(inside))
    if with_index:
        rows = _before(ranged, F.lit(1)).select("_part", F.col("_before").alias("_rows"))
        out = out.join(F.broadcast(rows), "_part").withColumn(with_index, F.col("_rows") + F.col("_pos"))
    return out.drop("_part", "_pos", "_before", "_upto", "_rows")


def cumulative_hours(df: DataFrame, key: str = "idx", duration: str = "duration") -> DataFrame:
    """Durations in ascending order with their running total in hours."""
    narrow = df.select(key, duration).where(F.col(duration).isNotNull())
    summed = running_sum(narrow, [duration, key], duration, "_seconds", with_index="sample_index")
    return summed.select("sample_index", key, duration, (F.col("_seconds") / 3600.0).alias("cumulative_hours"))


def running_total(df: DataFrame, batch: str, value: str) -> DataFrame:
    """Rows and sum per batch, and the running total over the batches."""
    per_batch = df.groupBy(batch).agg(F.count("*").alias("rows"), F.sum(value).alias("batch_sum"))
    return running_sum(per_batch, [batch], "batch_sum", "running_total")


def first_per_group(df: DataFrame, by, order, columns) -> DataFrame:
    """``columns`` of the first row of every group; combined on the map side, so large groups are cheap."""
    by = [by] if isinstance(by, str) else list(by)
    order = F.struct(*_cols([order] if isinstance(order, str) else order))
    first = df.groupBy(*by).agg(F.min_by(F.struct(*columns), order).alias("_first"))
    return first.select(*by, *[F.col("_first")[c].alias(c) for c in columns])


def top_k_per_group(df: DataFrame, by: str, order, k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of every group; each map task keeps at most ``k`` rows of a group before the shuffle."""
    window = Window.partitionBy(by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def top_n(df: DataFrame, order, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def sort_desc(df: DataFrame, column: str, tie: str) -> DataFrame:
    return df.orderBy(F.desc(column), F.asc(tie))
