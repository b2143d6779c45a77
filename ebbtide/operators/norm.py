"""Normalisation of weekly activity by the median over active users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions import exprs as X
from ebbtide.operators import sketches
from ebbtide.operators.quantiles import quantile_columns


MEDIANS = {
    "pop_median_session_count": "weekly_session_count",
    "pop_median_playtime_min": "total_playtime_min",
}


def population_medians(totals: DataFrame) -> DataFrame:
    """Lower median of session count and playtime per week; one row per week."""
    return quantile_columns(totals, ["week_num"], {name: (c, "0.5") for name, c in MEDIANS.items()})


def summarised_medians(totals: DataFrame) -> DataFrame:
    """The same from mergeable summaries: one aggregate, ranks off by a bounded share."""
    return sketches.median_columns(sketches.value_summaries(totals, ["week_num"], list(MEDIANS.values())), MEDIANS)


def population_norm(active: DataFrame, medians: DataFrame) -> DataFrame:
    # As many rows as the window has weeks: the broadcast cannot grow with the data.
    # Null-safe, so that no filter on one use of the totals keeps the other from sharing them.
    by_week = F.broadcast(medians.withColumnRenamed("week_num", "median_week"))
    joined = active.join(by_week, F.col("week_num").eqNullSafe(F.col("median_week")), "left").drop("median_week")
    return joined.withColumns(
        {
            "weekly_session_count_norm": X.safe_ratio("weekly_session_count", "pop_median_session_count"),
            "total_playtime_min_norm": X.safe_ratio("total_playtime_min", "pop_median_playtime_min"),
        }
    ).drop("pop_median_session_count", "pop_median_playtime_min")
