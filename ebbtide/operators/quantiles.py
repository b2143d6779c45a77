"""Exact quantiles that do not gather a group in one task."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bins per doubling of the magnitude of a value.
BINS_PER_OCTAVE = 1024


# Parts of the located bin, between its least and its greatest value, in a second count.
PARTS = 4096


def _bin(value: Column) -> Column:
    """Monotone, data-independent bin of a double; infinities have bins of their own
    and NaN, as in Spark's order, the highest."""
    magnitude = F.floor(F.log2(F.abs(value) + 1) * BINS_PER_OCTAVE)
    top = F.lit(1 << 40)
    finite = F.when(value < 0, -magnitude).otherwise(magnitude)
    return (
        F.when(F.isnan(value), top + 1)
        .when(value == float("inf"), top)
        .when(value == float("-inf"), -top)
        .otherwise(finite)
    )


def _part(value: Column, low: Column, high: Column) -> Column:
    """Which of ``PARTS`` equal parts of the range a value of a bin lies in."""
    share = F.try_divide(value / 2 - low / 2, high / 2 - low / 2)
    part = F.floor(F.when(F.isnan(share) | share.isNull(), 0.0).otherwise(share) * PARTS)
    return F.least(F.greatest(part, F.lit(0)), F.lit(PARTS - 1))


def _candidates(df: DataFrame, by: list[str], columns: list[str], probs: list[str]) -> DataFrame:
    """Rows ``(*by, metric, prob, value)``; the quantile is the smallest value of each group.

    Values are first counted (equal values merge on the map side), then the counts of
    coarse bins locate the one bin that holds each quantile, the counts of equal parts of
    that bin's range locate the part, and only the values of that part are ordered.
    ``probs`` are decimal literals such as ``"0.95"``.
    """
    counts = (
        df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot(list(by), columns, "metric", "value")
        .filter(F.col("value").isNotNull())
        .groupBy(*by, "metric", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin", _bin(F.col("value")))
    )
    group = [*by, "metric"]
    below = Window.partitionBy(*group).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = (
        counts.groupBy(*group, "bin")
        .agg(F.sum("n").alias("in_bin"), F.min("value").alias("low"), F.max("value").alias("high"))
        .withColumn("before", F.coalesce(F.sum("in_bin").over(below), F.lit(0)))
        .withColumn("size", F.sum("in_bin").over(Window.partitionBy(*group)))
    )
    prob = F.array(*[F.lit(Decimal(p)).cast("decimal(6,5)") for p in probs])
    rank = F.greatest(F.ceil(F.col("prob") * F.col("size").cast("decimal(18,0)")), F.lit(1)).cast("long")
    targets = (
        bins.withColumn("prob", F.explode(prob))
        .withColumn("rank", rank - F.col("before"))
        .filter("rank between 1 and in_bin")
    )
    # Null-safe keys keep a null group and, unlike plain ones, add no filter to one of
    # the two uses of ``counts``, so both read the same shuffle of the input.
    keys = [*group, "bin"]
    found = [*keys, "prob"]
    wanted = targets.select(*[F.col(c).alias(f"wanted_{c}") for c in keys], "prob", "rank", "low", "high")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"wanted_{c}")) for c in keys])
    inside = counts.join(wanted, same).withColumn("part", _part(F.col("value"), F.col("low"), F.col("high")))

    # A group and probability has one located bin, so its parts are few rows; running
    # totals of the parts leave the part that holds the rank.
    running = Window.partitionBy(*found).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        inside.groupBy(*found, "rank", "part")
        .agg(F.sum("n").alias("in_part"))
        .withColumn("rank", F.col("rank") - F.coalesce(F.sum("in_part").over(running), F.lit(0)))
        .filter("rank between 1 and in_part")
    )
    part_keys = [*found, "part"]
    located = parts.select(*[F.col(c).alias(f"part_{c}") for c in part_keys], F.col("rank").alias("part_rank"))
    in_part = reduce(and_, [F.col(c).eqNullSafe(F.col(f"part_{c}")) for c in part_keys])
    upto = Window.partitionBy(*part_keys).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    return (
        inside.join(located, in_part)
        .withColumn("upto", F.sum("n").over(upto))
        .filter("upto >= part_rank")
        .select(*group, F.col("prob").cast("double").alias("prob"), "value")
    )


def exact_quantiles(df: DataFrame, by: list[str], columns: list[str], probs: list[str]) -> DataFrame:
    """Rows ``(*by, metric, p, value)``: smallest value with cume_dist >= p."""
    found = _candidates(df, by, columns, probs)
    return found.groupBy(*by, "metric", F.col("prob").alias("p")).agg(F.min("value").alias("value"))


def quantile_columns(df: DataFrame, by: list[str], wanted: dict[str, tuple[str, str]]) -> DataFrame:
    """Quantiles as columns: output name -> (column, probability)."""
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    probs = list(dict.fromkeys(p for _, p in wanted.values()))
    cells = [
        F.min(F.when((F.col("metric") == c) & (F.col("prob") == float(p)), F.col("value"))).alias(out)
        for out, (c, p) in wanted.items()
    ]
    return _candidates(df, by, columns, probs).groupBy(*by).agg(*cells)
