"""Flat dataset: one row per user from one aggregation of the weekly table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.config import WindowConfig
from ebbtide.schema import flat_names


def mean_columns() -> list[Column]:
    return [F.expr(f"avg({c}) as {c}") for c in flat_names("mean")]


def last_columns(cfg: WindowConfig) -> list[Column]:
    """Value in the last week; the engagement and trial columns come first."""
    also_mean = set(flat_names("mean"))
    ordered = sorted(flat_names("last"), key=lambda c: c in also_mean)
    latest = f"week_num = {cfg.obs_periods}"
    return [F.expr(f"max({c}) filter (where {latest}) as {c}_last") for c in ordered]


def static_columns() -> list[Column]:
    """Per-user values repeat on every week, so any aggregate of them will do."""
    return [F.expr(f"max({c}) as {c}") for c in flat_names("static")]


def slope_column() -> Column:
    return F.regr_slope("total_playtime_min", F.col("week_num").cast("double")).alias("playtime_slope")


def flat_features(weekly: DataFrame, cfg: WindowConfig) -> DataFrame:
    return weekly.groupBy("user_id").agg(
        *mean_columns(), *last_columns(cfg), *static_columns(), slope_column()
    )


def flat_dataset(weekly: DataFrame, labels: DataFrame, cfg: WindowConfig) -> DataFrame:
    """42 features and the label; nulls are kept."""
    return flat_features(weekly, cfg).join(labels, "user_id", "left")
