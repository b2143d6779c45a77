"""Session base of the observation window and the scaffolds around it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.config import WindowConfig
from ebbtide.functions import exprs as X


def with_duration(sessions: DataFrame) -> DataFrame:
    """Add the session length in whole seconds and in minutes."""
    return sessions.withColumn("duration_s", X.seconds_between("start_time", "end_time")).withColumn(
        "duration_min", F.col("duration_s") / F.lit(60.0)
    )


def observe(sessions: DataFrame, cfg: WindowConfig) -> DataFrame:
    """Sessions that start inside the observation window, with date and week."""
    day = F.col("start_time").cast("date")
    return (
        with_duration(sessions.filter(X.ts_within("start_time", cfg.observation)))
        .withColumn("date", day)
        .withColumn("week_num", X.period_index(cfg.obs_start, day, cfg.period_days))
    )


def observed_users(obs: DataFrame) -> DataFrame:
    return obs.select("user_id").distinct()


def user_weeks(ids: DataFrame, cfg: WindowConfig) -> DataFrame:
    """One row per user and week; generated per user, so no join is involved."""
    weeks = F.sequence(F.lit(1), F.lit(cfg.obs_periods))
    return ids.select("user_id", F.explode(weeks).alias("week_num"))


def user_dates(ids: DataFrame, cfg: WindowConfig) -> DataFrame:
    """One row per user and day of the observation window."""
    last = F.date_sub(F.lit(cfg.obs_end), 1)
    days = F.sequence(F.lit(cfg.obs_start), last, F.expr("interval 1 day"))
    return ids.select("user_id", F.explode(days).alias("date")).withColumn(
        "week_num", X.period_index(cfg.obs_start, "date", cfg.period_days)
    )


def fill_missing_weeks(active: DataFrame, cfg: WindowConfig) -> DataFrame:
    """Give every user of a sparse weekly table a row for each week.

    Each row also emits the empty weeks up to the user's next row (the first one
    the weeks before it as well). Compared with a left join from a user x week
    scaffold this needs neither the list of users nor a second pass over the
    input; a user holds at most ``obs_periods`` rows.
    """
    per_user = Window.partitionBy("user_id").orderBy("week_num")
    first = F.when(F.lag("week_num").over(per_user).isNull(), F.lit(1)).otherwise(F.col("week_num"))
    last = F.coalesce(F.lead("week_num").over(per_user) - 1, F.lit(cfg.obs_periods))
    values = [c for c in active.columns if c not in ("user_id", "week_num")]
    spread = active.withColumn("first", first).withColumn("last", last)
    spread = spread.withColumn("week", F.explode(F.sequence("first", "last")))
    return spread.selectExpr(
        "user_id", "week as week_num", *[f"case when week = week_num then {c} end as {c}" for c in values]
    )
