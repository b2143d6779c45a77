"""Weekly session, quality and volatility features from one aggregation chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.config import WindowConfig
from ebbtide.functions import exprs as X
from ebbtide.schema import KEYS, QUALITY_MEANS

def _weekly_sums(obs: DataFrame, cfg: WindowConfig) -> DataFrame:
    """Sums per user and week, with the playtime of each day of the week in its own column.

    Only sums and counts are kept, so they combine on the map side: a user with
    very many sessions leaves each map task as a few rows.
    """
    day = F.pmod(X.days_from(cfg.obs_start, "date"), F.lit(cfg.period_days))
    sums: list[Column] = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count("session_id").alias("n_sessions"),
        F.count("duration_s").alias("n_timed"),
        F.sum("duration_s").alias("seconds"),
        F.sum(X.square("duration_s")).alias("seconds_sq"),
        F.count_if(X.is_peak_hour("start_time")).alias("n_peak"),
        F.count_if(X.is_weekend("start_time")).alias("n_weekend"),
        F.count_if(X.is_abnormal_exit("exit_type")).alias("n_abnormal"),
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), "day")).alias("active_days"),
        *[F.expr(f"sum(duration_s) filter (where day = {d}) as seconds_{d}") for d in range(cfg.period_days)],
        *[F.expr(f"avg({source}) as {feature}") for feature, source in QUALITY_MEANS.items()],
    ]
    return obs.withColumn("day", day).groupBy(*KEYS).agg(*sums)


def session_profile(obs: DataFrame, cfg: WindowConfig) -> DataFrame:
    """All weekly features that follow from sums over a user's sessions and days.

    Output: session counts and ratios, quality means, day and session
    volatility, and ``active_days``, a bit per day of the week with a session.
    One scan and one shuffle.
    """
    # Days without a session count as 0, hence n = days of the period.
    days = [f"coalesce(seconds_{d}, 0)" for d in range(cfg.period_days)]
    total = F.expr(" + ".join(days))
    squares = F.expr(" + ".join(f"pow({day}, 2)" for day in days))
    daily_std = X.sample_std(F.lit(cfg.period_days), total, squares)
    return _weekly_sums(obs, cfg).select(
        *KEYS,
        F.col("n_sessions").alias("weekly_session_count"),
        (X.safe_ratio("seconds", "n_timed") / 60).alias("avg_session_duration_min"),
        (F.col("seconds") / F.lit(60.0)).alias("total_playtime_min"),
        X.share("n_peak", "n_rows").alias("peak_hour_ratio"),
        X.share("n_weekend", "n_rows").alias("weekend_ratio"),
        *QUALITY_MEANS,
        X.share("n_abnormal", "n_rows").alias("crash_exit_ratio"),
        (daily_std / 60).alias("daily_playtime_std"),
        X.safe_ratio(daily_std, total / F.lit(cfg.period_days)).alias("daily_playtime_cv"),
        (X.sample_std("n_timed", "seconds", "seconds_sq") / 60).alias("session_duration_std"),
        "active_days",
    )


def weekly_totals(obs: DataFrame) -> DataFrame:
    """Session count and playtime only: three columns of the fact table."""
    return obs.groupBy(*KEYS).agg(
        F.count("session_id").alias("weekly_session_count"),
        (F.sum("duration_s") / F.lit(60.0)).alias("total_playtime_min"),
    )


def daily_playtime(obs: DataFrame) -> DataFrame:
    return obs.groupBy(*KEYS, "date").agg((F.sum("duration_s") / F.lit(60.0)).alias("daily_playtime_min"))
