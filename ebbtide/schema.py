"""Registry of the weekly features; every column list derives from it."""

from __future__ import annotations

from dataclasses import dataclass

KEYS = ("user_id", "week_num")


@dataclass(frozen=True)
class Feature:
    """One column of the weekly table.

    ``when_absent`` is the value of a user-week without rows behind it (None
    keeps the null), ``flat`` says how the per-user table reads the column
    (any of "mean", "last", "static"), ``sequence_fill`` replaces nulls in the
    sequence form, and ``profile`` names the segment profiles that show its mean ("t"
    the trend of a segment over the weeks, "s" the comparison of all segments).
    """

    name: str
    section: str
    flat: tuple[str, ...]
    when_absent: int | None = None
    sequence_fill: float = 0.0
    integral: bool = False
    profile: str = ""


def _section(section: str, *rows: Feature) -> list[Feature]:
    return [Feature(**{**row.__dict__, "section": section}) for row in rows]


def _f(name: str, *flat: str, absent=None, fill=0.0, integral=False, profile="") -> Feature:
    return Feature(name, "", flat, absent, fill, integral, profile)


# Names, order, null rules and fills are part of the data model.
FEATURES: list[Feature] = [
    *_section(
        "sessions",
        _f("weekly_session_count", "mean", "last", absent=0, integral=True, profile="ts"),
        _f("avg_session_duration_min", "mean", absent=0, profile="ts"),
        _f("total_playtime_min", "mean", "last", absent=0, profile="ts"),
        _f("peak_hour_ratio", "mean", absent=0, profile="s"),
        _f("weekend_ratio", "mean", absent=0, profile="s"),
        _f("session_regularity", "mean", absent=0, profile="s"),
        _f("weekly_session_count_norm", "mean", absent=0, profile="t"),
        _f("total_playtime_min_norm", "mean", absent=0),
    ),
    *_section(
        "engagement",
        _f("session_count_wow_change", "last", profile="ts"),
        _f("playtime_wow_change", "last"),
        _f("session_count_vs_baseline", "last", fill=1.0, profile="ts"),
        _f("playtime_vs_baseline", "last", fill=1.0, profile="ts"),
        _f("longest_inactive_days", "last", absent=0, integral=True, profile="ts"),
    ),
    *_section(
        "quality",
        _f("avg_latency", "mean", profile="ts"),
        _f("avg_fps", "mean", profile="s"),
        _f("frame_drop_rate", "mean"),
        _f("disconnect_rate", "mean", profile="ts"),
        _f("avg_bitrate", "mean"),
        _f("avg_jitter", "mean"),
        _f("packet_loss_avg", "mean"),
        _f("crash_exit_ratio", "mean", "last", profile="ts"),
    ),
    *_section(
        "diversity",
        _f("unique_games_played", "mean", integral=True, profile="s"),
        _f("top_game_concentration", "mean", profile="s"),
        _f("genre_entropy", "mean", profile="s"),
        _f("new_game_trial_rate", "last"),
    ),
    *_section(
        "volatility",
        _f("daily_playtime_std", "mean", absent=0),
        _f("daily_playtime_cv", "mean"),
        _f("session_duration_std", "mean"),
    ),
    *_section(
        "payments",
        _f("current_tier_numeric", "static", integral=True, profile="s"),
        _f("days_since_signup", "static", integral=True),
        _f("tier_changes_count", "static", absent=0, integral=True),
        _f("has_downgraded", "static", absent=0, integral=True, profile="s"),
        _f("total_spend_last_4w", "static", absent=0, profile="s"),
        _f("payment_count_last_4w", "static", absent=0, integral=True),
        _f("failed_payment_count", "static", absent=0, integral=True, profile="s"),
        _f("refund_count", "static", absent=0, integral=True, profile="s"),
        _f("days_since_last_payment", "static", fill=-1.0, integral=True),
        _f("payment_frequency_change", "static", profile="s"),
    ),
]

# Mean of a session column per user-week, feature <- source column.
QUALITY_MEANS = {
    "avg_latency": "avg_latency_ms",
    "avg_fps": "avg_fps",
    "frame_drop_rate": "total_frame_drops",
    "disconnect_rate": "disconnect_count",
    "avg_bitrate": "avg_bitrate_mbps",
    "avg_jitter": "avg_jitter_ms",
    "packet_loss_avg": "packet_loss_rate",
}


def names(section: str | None = None) -> list[str]:
    return [f.name for f in FEATURES if section in (None, f.section)]


def flat_names(how: str) -> list[str]:
    return [f.name for f in FEATURES if how in f.flat]


def profiled(kind: str) -> list[str]:
    return [f.name for f in FEATURES if kind in f.profile]


INTEGRAL = {f.name for f in FEATURES if f.integral}


# Limits and null rules that the quality checks enforce.
NEVER_NULL = (
    "user_id",
    "week_num",
    "weekly_session_count",
    "avg_session_duration_min",
    "total_playtime_min",
    "weekly_session_count_norm",
    "total_playtime_min_norm",
    "peak_hour_ratio",
    "weekend_ratio",
    "session_regularity",
    "longest_inactive_days",
    "daily_playtime_std",
    "current_tier_numeric",
    "days_since_signup",
    "tier_changes_count",
    "has_downgraded",
    "total_spend_last_4w",
    "payment_count_last_4w",
    "failed_payment_count",
    "refund_count",
)
UNIT_INTERVAL = (
    "peak_hour_ratio",
    "weekend_ratio",
    "crash_exit_ratio",
    "packet_loss_avg",
    "top_game_concentration",
)
NON_NEGATIVE = (
    "weekly_session_count",
    "avg_session_duration_min",
    "total_playtime_min",
    "weekly_session_count_norm",
    "total_playtime_min_norm",
    "session_regularity",
    "longest_inactive_days",
    "avg_latency",
    "avg_fps",
    "avg_bitrate",
    "avg_jitter",
    "frame_drop_rate",
    "disconnect_rate",
    "unique_games_played",
    "genre_entropy",
    "daily_playtime_std",
    "daily_playtime_cv",
    "session_duration_std",
    "days_since_signup",
    "tier_changes_count",
    "total_spend_last_4w",
    "payment_count_last_4w",
    "failed_payment_count",
    "refund_count",
)
NULL_IN_ZERO_WEEKS = (
    *QUALITY_MEANS,
    "crash_exit_ratio",
    "unique_games_played",
    "top_game_concentration",
    "genre_entropy",
)
FORBIDDEN_IN_DATASETS = ("persona", "subscription_tier", "signup_date", "user_id")
