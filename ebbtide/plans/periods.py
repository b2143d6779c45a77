"""The weekly table by way of sums that are kept per period.

Small tables hold what the sessions of a period add: the profile of each user-week, the
counts of each user, week and game, the sums of the baseline, and one row with mergeable
summaries of all sessions. Each period is a part that is computed from the sessions of that
period alone. The weekly table and the overview follow from all parts without reading a
session, so a period whose sessions have changed costs the scans of that period, and the
parts of the others stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.config import WindowConfig
from ebbtide.functions import exprs as X
from ebbtide.operators import diversity, engagement, gaps, norm, scaffold, sketches
from ebbtide.operators import sessions as session_ops
from ebbtide.plans.weekly import completed
from ebbtide.schema import KEYS
from ebbtide.sources.tables import Tables
from ebbtide.sources.versions import Draft

ACTIVITY, PLAYED, BASELINE, SUMMARY = "activity", "played", "baseline", "summary"
PERIOD = "period"

SPREAD = ["duration_min"]
COUNTED = ["user_id", "game_id"]
PERCENTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def all_periods(cfg: WindowConfig) -> list[int]:
    return list(range(cfg.first_period, cfg.obs_periods + 1))


def _windows(cfg: WindowConfig, periods: list[int]) -> list[tuple]:
    """Windows of these periods, neighbouring ones in one."""
    windows: list[tuple] = []
    for start, end in map(cfg.period, sorted(set(periods))):
        if windows and windows[-1][1] == start:
            windows[-1] = windows[-1][0], end
        else:
            windows.append((start, end))
    return windows


def activity(obs: DataFrame, cfg: WindowConfig) -> DataFrame:
    """What follows from the sessions of a user-week alone."""
    return session_ops.session_profile(obs, cfg).join(gaps.session_regularity(obs), list(KEYS), "left")


def summary(sessions: DataFrame) -> DataFrame:
    """One row per period: extent, and summaries of lengths, users and games."""
    extent = sessions.groupBy(PERIOD).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("start_time").alias("first_time"), F.max("start_time").alias("last_time")
    )
    lengths = sketches.value_summaries(sessions, [PERIOD], SPREAD)
    keys = sketches.key_summaries(sessions, [PERIOD], COUNTED)
    return extent.join(lengths, PERIOD).join(keys, PERIOD)


def overview(summaries: DataFrame) -> DataFrame:
    """One row over all periods: sessions, their extent, about how many users and games, and
    percentiles of the session length."""
    one = F.lit(0).alias("all")
    parts = summaries.select("*", one)
    extent = parts.groupBy("all").agg(
        F.sum("n_rows").alias("n_rows"), F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time")
    )
    counts = sketches.distinct_counts(parts, ["all"], COUNTED)
    merged = sketches.merged_values(parts, ["all"], SPREAD)
    spread = merged.select("all", *[sketches.quantile(c, p).alias(name) for c in SPREAD for name, p in PERCENTILES.items()])
    return extent.join(counts, "all").join(spread, "all").drop("all")


def sums(tables: Tables, cfg: WindowConfig, periods: list[int]) -> dict[str, tuple[DataFrame, list[int]]]:
    """The rows of each table for its periods among the given ones, numbered by period."""

    def of_users(numbers: list[int], compute: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, list[int]]:
        parts = [tables.per_user(window, compute) for window in _windows(cfg, numbers)]
        return reduce(DataFrame.unionByName, parts), numbers

    def numbered(sessions: DataFrame) -> DataFrame:
        day = F.col("start_time").cast("date")
        return sessions.withColumn(PERIOD, X.period_index(cfg.obs_start, day, cfg.period_days))

    def observed(compute: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        return lambda sessions: compute(scaffold.observe(sessions, cfg)).withColumn(PERIOD, F.col("week_num"))

    weeks = [p for p in periods if p >= 1]
    past = [p for p in periods if p < 1]
    every = reduce(DataFrame.unionByName, map(tables.sessions_between, _windows(cfg, periods)))
    made = {SUMMARY: (summary(numbered(scaffold.with_duration(every))), periods)}
    if weeks:
        made[ACTIVITY] = of_users(weeks, observed(lambda obs: activity(obs, cfg)))
        made[PLAYED] = of_users(weeks, observed(diversity.game_counts))
    if past:
        made[BASELINE] = of_users(past, lambda sessions: engagement.baseline_sums(numbered(sessions), PERIOD))
    return made


def refresh(draft: Draft, tables: Tables, cfg: WindowConfig, periods: list[int]) -> None:
    """Write the parts of these periods."""
    for name, (df, numbers) in sums(tables, cfg, periods).items():
        draft.write_parts(df, name, PERIOD, numbers)


def schemas(tables: Tables, cfg: WindowConfig) -> dict[str, T.StructType]:
    """Schemas of the parts, from the plans alone."""
    made = sums(tables, cfg, [0, 1])
    return {name: df.drop(PERIOD).schema for name, (df, _) in made.items()}


def weekly_from_parts(draft: Draft, tables: Tables, cfg: WindowConfig, strict_inactivity: bool = False) -> DataFrame:
    """The weekly table from the kept sums; reads no session."""
    kept = {name: draft.read_parts(name, schema) for name, schema in schemas(tables, cfg).items()}
    games = diversity.game_profile(kept[PLAYED], tables.games, cfg, counted=True)
    active = kept[ACTIVITY].join(games, list(KEYS), "left")
    active = norm.population_norm(active, norm.population_medians(kept[ACTIVITY]))
    baseline = engagement.average_week(kept[BASELINE], cfg)
    return completed(diversity.new_game_trial_rate(active), baseline, tables, cfg, strict_inactivity)
