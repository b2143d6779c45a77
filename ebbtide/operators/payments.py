"""Subscription and payment features, one row per user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.config import WindowConfig
from ebbtide.functions import exprs as X
from ebbtide.schema import FEATURES


def user_static(users: DataFrame, cfg: WindowConfig) -> DataFrame:
    return users.select(
        "user_id",
        X.tier_rank("subscription_tier").alias("current_tier_numeric"),
        F.datediff(F.lit(cfg.obs_start), "signup_date").alias("days_since_signup"),
    )


def subscription_changes(sub_events: DataFrame, cfg: WindowConfig) -> DataFrame:
    """Number of subscription events (of any type) and whether one was a downgrade."""
    return (
        sub_events.filter(X.date_within("event_date", cfg.observation))
        .groupBy("user_id")
        .agg(
            F.count("event_id").alias("tier_changes_count"),
            F.coalesce(F.bool_or(F.col("event_type") == "downgrade"), F.lit(False)).cast("int").alias("has_downgraded"),
        )
    )


def payment_summary(payments: DataFrame, cfg: WindowConfig) -> DataFrame:
    """Spend, counts and recency in the observation window, with the baseline count.

    Both windows come from one pass. A user who paid only in the baseline has
    null sums and counts for the observation window.
    """
    now = X.date_within("payment_date", cfg.observation)
    success, failed, refunded = (F.col("status") == s for s in ("success", "failed", "refunded"))
    sums = (
        payments.filter(X.date_within("payment_date", (cfg.data_start, cfg.obs_end)))
        .groupBy("user_id")
        .agg(
            F.count_if(now).alias("n_now"),
            F.sum(F.when(now, F.when(success, F.col("amount_usd")).otherwise(0.0))).alias("total_spend_last_4w"),
            F.count(F.when(now, F.col("payment_id"))).alias("payment_count_last_4w"),
            F.count_if(now & failed).alias("failed_payment_count"),
            F.count_if(now & refunded).alias("refund_count"),
            F.datediff(F.lit(cfg.obs_end), F.max(F.when(now & success, F.col("payment_date")))).alias(
                "days_since_last_payment"
            ),
            F.count(F.when(~now, F.col("payment_id"))).alias("baseline_payment_count"),
        )
    )
    return sums.withColumn(
        "payment_frequency_change", X.relative_change("payment_count_last_4w", "baseline_payment_count")
    )


def payment_features(
    users: DataFrame, sub_events: DataFrame, payments: DataFrame, cfg: WindowConfig
) -> DataFrame:
    """The ten features of section "payments"; the same for all weeks of a user."""
    zero = [f.name for f in FEATURES if f.section == "payments" and f.when_absent == 0]
    return (
        user_static(users, cfg)
        .join(subscription_changes(sub_events, cfg), "user_id", "left")
        .join(payment_summary(payments, cfg).drop("n_now", "baseline_payment_count"), "user_id", "left")
        .fillna(0, subset=zero)
    )
