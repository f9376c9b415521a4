"""Histogram, exact quantiles and the describe row."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroll.functions.numbers import number_or_null, round_half_even, round_mean, text_mean
from tallyroll.session import written_once


def equal_width_histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Counts of ``bins`` equal-width bins between the smallest and largest value.

    Bins are closed on the left, the last one on both sides; empty bins are
    kept. A first pass finds the range and the mean, which is one row; values
    are then counted per bin on the map side. The overall mean is repeated on
    every row.
    """
    x = F.expr(number_or_null(column))
    low, high, mean = df.agg(F.min(x), F.max(x), round_mean(text_mean(F.col(column)), 6)).first()
    if low == high and low is not None:
        low, high = low - 0.5, high + 0.5
    lo, hi = F.lit(low).cast("double"), F.lit(high).cast("double")
    step = (hi - lo) / F.lit(float(bins))

    def left_edge(number: Column) -> Column:
        return number * step + lo

    guess = F.least(F.floor((F.col("x") - lo) / step), F.lit(bins - 1)).cast("int")
    # The division can land one bin off; the edges decide.
    exact = (
        F.when(F.col("x") < left_edge(F.col("guess")), F.col("guess") - 1)
        .when((F.col("x") >= left_edge(F.col("guess") + 1)) & (F.col("guess") < bins - 1), F.col("guess") + 1)
        .otherwise(F.col("guess"))
    )
    values = df.select(x.alias("x")).where("x is not null").withColumn("guess", guess)
    counts = values.groupBy(exact.alias("bin")).agg(F.count(F.lit(1)).alias("value_count"))

    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(counts, "bin", "left").select(
        "bin",
        left_edge(F.col("bin")).alias("lower_edge"),
        F.when(F.col("bin") == bins - 1, hi).otherwise(left_edge(F.col("bin") + 1)).alias("upper_edge"),
        F.coalesce("value_count", F.lit(0)).cast("long").alias("value_count"),
        F.lit(mean).cast("double").alias("overall_mean"),
    )


def running_total(ranged: DataFrame, order_by: str, amount: str, out: str) -> DataFrame:
    """Running sum of ``amount`` over the whole of ``ranged`` in ``order_by`` order.

    A window without keys would pull everything into one task. Here the rows
    come from ``in_ranges``, each range sums its own rows, and the few range
    totals (one per shuffle partition) give every range its starting value.
    """
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("_slice")
        .agg(F.sum(amount).alias("_total"))
        .select("_slice", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("_slice").orderBy(order_by).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumn("_inside", F.sum(amount).over(inside))
    return summed.join(starts, "_slice").withColumn(out, F.col("_start") + F.col("_inside")).drop("_slice", "_start", "_inside")


def in_ranges(df: DataFrame, order_by: str) -> DataFrame:
    """``df`` range-partitioned, with the number of its range; write it before using the number twice."""
    return df.repartitionByRange(order_by).withColumn("_slice", F.spark_partition_id())


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation: rows ``(probability, quantile)``.

    Equal values are counted first, so a value held by a third of the rows is
    one row; ranks come from ``running_total`` and no task sees all values. The
    answer is a handful of numbers, so it is computed at once and the counted
    values, which are written for it, are deleted again.
    """
    counted = (
        df.select(F.expr(number_or_null(column)).alias("x"))
        .where("x is not null")
        .groupBy("x")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    picks, rows = [], []
    with written_once(in_ranges(counted, "x")) as ranged:
        total = ranged.agg(F.sum("n")).first()[0] or 0
        ranked = running_total(ranged, "x", "n", "last_rank")
        for i, p in enumerate(probabilities):
            at = p * max(total - 1, 0)
            for side, rank in (("low", math.floor(at)), ("high", math.ceil(at))):
                picks.append(F.expr(f"max(case when last_rank - n <= {rank} and last_rank > {rank} then x end) as {side}_{i}"))
        found = ranked.agg(*picks).first()
    for i, p in enumerate(probabilities):
        at = p * max(total - 1, 0)
        low, high = found[f"low_{i}"], found[f"high_{i}"]
        rows.append((float(p), None if low is None else low + (high - low) * (at - math.floor(at))))
    return df.sparkSession.createDataFrame(rows, "probability double, quantile double")


def describe_numbers(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum as rows."""
    x = F.expr(number_or_null(column))
    base = df.agg(
        F.count(x).cast("double").alias("count"),
        text_mean(F.col(column)).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
    ).selectExpr("stack(5, 'count', count, 'mean', mean, 'std', std, 'min', min, 'max', max) as (statistic, value)")
    quartiles = exact_quantiles(df, column, (0.25, 0.5, 0.75)).select(
        F.concat(F.round(F.col("probability") * 100).cast("int").cast("string"), F.lit("%")).alias("statistic"),
        F.col("quantile").alias("value"),
    )
    return base.unionByName(quartiles).withColumn("value", round_half_even(F.col("value"), digits))
