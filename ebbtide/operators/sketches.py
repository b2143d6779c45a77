"""Mergeable summaries: quantiles by KLL, distinct counts by HyperLogLog.

A summary is a binary column of bounded size that combines on the map side, so a group of any
number of rows costs one row in the shuffle. Summaries of parts of the data (days, periods,
runs) are kept and merged; no row is read again for a longer span. The exact forms are
``quantiles.exact_quantiles`` and ``profile.extent``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Size parameter of a quantile summary, and how far the rank of its answer may be off. The
# expected error of a rank is about 2.3 / K ** 0.9, that is 0.0013; the bound is three times that.
K = 4096
RANK_ERROR = 0.004
# Binary logarithm of the registers of a distinct count, and the bound of its relative error:
# four standard errors of 0.83 / sqrt(2 ** LOG_K).
LOG_K = 14
COUNT_ERROR = 0.026


def _name(column: str) -> str:
    return f"{column}_summary"


def value_summaries(df: DataFrame, by: Sequence[str], columns: Sequence[str], k: int = K) -> DataFrame:
    """One row per group with the summary of the values of each column; nulls don't count."""
    return df.groupBy(*by).agg(*[F.kll_sketch_agg_double(F.col(c).cast("double"), k).alias(_name(c)) for c in columns])


def merged_values(summaries: DataFrame, by: Sequence[str], columns: Sequence[str], k: int = K) -> DataFrame:
    """Summaries of coarser groups from those of finer ones."""
    return summaries.groupBy(*by).agg(*[F.kll_merge_agg_double(_name(c), k).alias(_name(c)) for c in columns])


def quantile(column: str, p: float) -> Column:
    """The quantile of a summarised column; null where it has no value."""
    summary = F.col(_name(column))
    return F.when(F.kll_sketch_get_n_double(summary) > 0, F.kll_sketch_get_quantile_double(summary, F.lit(p)))


def summarised_quantiles(summaries: DataFrame, by: Sequence[str], columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Rows ``(*by, metric, p, value)`` like those of the exact form."""
    cells = [F.struct(F.lit(c).alias("metric"), F.lit(p).alias("p"), quantile(c, p).alias("value")) for c in columns for p in probs]
    return summaries.select(*by, F.inline(F.array(*cells)))


def median_columns(summaries: DataFrame, medians: dict[str, str]) -> DataFrame:
    """Weekly medians as columns: output name -> summarised column."""
    return summaries.select("week_num", *[quantile(c, 0.5).alias(name) for name, c in medians.items()])


def rank_errors(df: DataFrame, found: DataFrame, by: Sequence[str], columns: Sequence[str], bound: float = RANK_ERROR) -> DataFrame:
    """Rows ``(*by, metric, p, n, within)``: whether the exact rank of each found quantile,
    which spans all rows of equal value, comes within ``bound`` of its probability.

    ``found`` has a few rows per group, so the values meet them and are counted at once.
    """
    values = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(list(by), list(columns), "metric", "x")
    keys = [*by, "metric"]
    asked = found.select(*[F.col(c).alias(f"found_{c}") for c in keys], "p", "value")
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"found_{c}")) for c in keys])
    ranks = (
        values.filter(F.col("x").isNotNull())
        .join(F.broadcast(asked), same)
        .groupBy(*keys, "p")
        .agg(F.count("x").alias("n"), F.count_if(F.col("x") < F.col("value")).alias("less"), F.count_if(F.col("x") <= F.col("value")).alias("most"))
    )
    wide = F.lit(bound) * F.col("n") + 1
    wanted = F.col("p") * F.col("n")
    within = (F.col("less") - wide <= wanted) & (wanted <= F.col("most") + wide)
    return ranks.select(*keys, "p", "n", F.coalesce(within, F.lit(False)).alias("within"))


def key_summaries(df: DataFrame, by: Sequence[str], keys: Sequence[str], log_k: int = LOG_K) -> DataFrame:
    """One row per group with a summary of the distinct values of each key."""
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), log_k).alias(_name(c)) for c in keys])


def distinct_counts(summaries: DataFrame, by: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Distinct values of each key, columns ``n_<key>``, over groups merged to ``by``."""
    unions = [F.hll_sketch_estimate(F.hll_union_agg(_name(c))).alias(f"n_{c}") for c in keys]
    return summaries.groupBy(*by).agg(*unions)


def count_errors(df: DataFrame, found: DataFrame, by: Sequence[str], keys: Sequence[str], bound: float = COUNT_ERROR) -> DataFrame:
    """Rows ``(*by, key, n_distinct, within)``: whether a found count of distinct values
    comes within ``bound`` of the exact one."""
    values = df.select(*by, *[F.col(c).cast("string").alias(c) for c in keys]).unpivot(list(by), list(keys), "key", "x")
    exact = values.distinct().groupBy(*by, "key").agg(F.count("x").alias("n_distinct"))
    counts = found.unpivot(list(by), [f"n_{c}" for c in keys], "counted", "found")
    counts = counts.select(*[F.col(c).alias(f"found_{c}") for c in by], F.substring("counted", 3, 1 << 20).alias("found_key"), "found")
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"found_{c}")) for c in [*by, "key"]])
    within = F.abs(F.col("found") - F.col("n_distinct")) <= F.lit(bound) * F.col("n_distinct") + 1
    return exact.join(counts, same, "left").select(*by, "key", "n_distinct", F.coalesce(within, F.lit(False)).alias("within"))
