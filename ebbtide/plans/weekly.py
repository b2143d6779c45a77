"""The weekly feature table: one row per user and observation week."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide import schema
from ebbtide.config import WindowConfig
from ebbtide.operators import diversity, engagement, gaps, norm, payments, scaffold
from ebbtide.operators import sessions as session_ops
from ebbtide.schema import KEYS
from ebbtide.sources.tables import Tables


def active_weeks(tables: Tables, cfg: WindowConfig) -> DataFrame:
    """Session, quality, diversity and volatility features of weeks with sessions.

    Each part scans only its own columns of the sessions and ends in the same
    ``(user_id, week_num)`` partitioning, so the parts join without a shuffle.
    """

    def of_users(compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
        return tables.per_user(cfg.observation, lambda sessions: compute(scaffold.observe(sessions, cfg)))

    def features(obs: DataFrame) -> DataFrame:
        profile, games = session_ops.session_profile(obs, cfg), diversity.game_profile(obs, tables.games, cfg)
        return profile.join(gaps.session_regularity(obs), list(KEYS), "left").join(games, list(KEYS), "left")

    # The medians read their two columns from the sessions again.
    return norm.population_norm(of_users(features), norm.population_medians(of_users(session_ops.weekly_totals)))


def weekly_features(
    tables: Tables,
    cfg: WindowConfig = WindowConfig(),
    strict_inactivity: bool = False,
) -> DataFrame:
    """Two key columns and the features of ``schema.FEATURES`` in order.

    A user without any observed session gets 0 inactive days, or the length of the window
    so far with ``strict_inactivity``. ``periods`` has the same table from stored sums.
    """
    active = diversity.new_game_trial_rate(active_weeks(tables, cfg))
    baseline = tables.per_user(cfg.baseline, lambda sessions: engagement.user_baseline(sessions, cfg))
    return completed(active, baseline, tables, cfg, strict_inactivity)


def completed(
    active: DataFrame, baseline: DataFrame, tables: Tables, cfg: WindowConfig, strict_inactivity: bool = False
) -> DataFrame:
    """The weekly table from the features of active weeks and the users' baseline."""
    dense = scaffold.fill_missing_weeks(active, cfg)
    zero = [f.name for f in schema.FEATURES if f.section != "payments" and f.when_absent == 0]
    dense = dense.fillna(0, subset=[c for c in zero if c in dense.columns])

    # In this order the windows of both steps merge into one.
    dense = engagement.longest_inactive_days(dense, cfg)
    dense = engagement.wow_change(dense)
    dense = engagement.baseline_ratios(dense, baseline)

    per_user = payments.payment_features(tables.users, tables.sub_events, tables.payments, cfg)
    everyone = dense.join(per_user, "user_id", "full_outer")
    # A user without observed sessions arrives as one row without a week.
    all_weeks = F.sequence(F.lit(1), F.lit(cfg.obs_periods))
    weeks = F.when(F.col("week_num").isNull(), all_weeks).otherwise(F.array("week_num"))
    everyone = everyone.withColumn("week_num", F.explode(weeks))
    if strict_inactivity:
        everyone = everyone.fillna({"longest_inactive_days": -1}).withColumn(
            "longest_inactive_days",
            F.when(F.col("longest_inactive_days") < 0, F.col("week_num") * cfg.period_days).otherwise(
                F.col("longest_inactive_days")
            ),
        )
    return everyone.fillna(0, subset=zero).select(*KEYS, *schema.names())
