"""Weekly features against answers worked out by hand."""

from __future__ import annotations

import math

import pytest
from fixture import day, session_row, tables

from ebbtide import WindowConfig, schema
from ebbtide.plans.weekly import weekly_features

CFG = WindowConfig()

EXPECTED_A = {
    "weekly_session_count": [2, 1, 0, 0],
    "avg_session_duration_min": [45, 90, 0, 0],
    "total_playtime_min": [90, 90, 0, 0],
    "peak_hour_ratio": [0.5, 1, 0, 0],
    "weekend_ratio": [0.5, 0, 0, 0],
    "session_regularity": [0, 0, 0, 0],
    "weekly_session_count_norm": [1, 1, 0, 0],
    "total_playtime_min_norm": [1, 1, 0, 0],
    "session_count_wow_change": [None, 0, -1, None],
    "playtime_wow_change": [None, 0, -1, None],
    "session_count_vs_baseline": [None] * 4,
    "playtime_vs_baseline": [None] * 4,
    "longest_inactive_days": [3, 5, 12, 19],
    "avg_latency": [20, 20, None, None],
    "avg_fps": [60, 60, None, None],
    "frame_drop_rate": [3, 3, None, None],
    "disconnect_rate": [1, 1, None, None],
    "avg_bitrate": [25, 25, None, None],
    "avg_jitter": [2, 2, None, None],
    "packet_loss_avg": [0.01, 0.01, None, None],
    "crash_exit_ratio": [0.5, 0, None, None],
    "unique_games_played": [2, 1, None, None],
    "top_game_concentration": [0.666667, 1, None, None],
    "genre_entropy": [1, 0, None, None],
    "new_game_trial_rate": [None, 0, None, None],
    "daily_playtime_std": [23.603874, 34.016803, 0, 0],
    "daily_playtime_cv": [1.835857, 2.645751, None, None],
    "session_duration_std": [21.213203, None, None, None],
    "current_tier_numeric": [1] * 4,
    "days_since_signup": [242] * 4,
    "tier_changes_count": [2] * 4,
    "has_downgraded": [1] * 4,
    "total_spend_last_4w": [9.99] * 4,
    "payment_count_last_4w": [2] * 4,
    "failed_payment_count": [1] * 4,
    "refund_count": [0] * 4,
    "days_since_last_payment": [16] * 4,
    "payment_frequency_change": [1] * 4,
}


def by_user_week(df):
    return {(r["user_id"], r["week_num"]): r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def base(spark):
    return by_user_week(weekly_features(tables(spark), CFG))


@pytest.fixture(scope="module")
def edge(spark):
    """The base rows with sessions and payments at the edges of the rules."""
    extra = [
        # Same week as s3: peak limits, an unknown game, part of a second, an overlap.
        session_row("t1", "D", "g1", "2024-02-05 23:59:59", "2024-02-06 00:01:30.900000"),
        session_row("t2", "D", "g9", "2024-02-06 00:00:00", "2024-02-06 00:10:00"),
        session_row("t3", "D", "g2", "2024-02-06 18:59:59", "2024-02-06 19:29:59"),
        # Just outside the observation window.
        session_row("t4", "D", "g1", "2024-01-28 23:59:00", "2024-01-29 00:30:00"),
        session_row("t5", "D", "g1", "2024-02-26 00:00:00", "2024-02-26 00:30:00"),
        # Not in the user table.
        session_row("t6", "Z", "g1", "2024-02-01 10:00:00", "2024-02-01 11:00:00"),
    ]
    users = [("D", day("2024-01-01"), "gold", "regular")]
    payments = [("q1", "D", day("2024-02-05"), 5.0, "in_app", "failed")]
    return by_user_week(weekly_features(tables(spark, extra, users, payments), CFG))


def test_columns(spark):
    df = weekly_features(tables(spark), CFG)
    assert df.columns == ["user_id", "week_num", *schema.names()]
    assert len(schema.names()) == 38


@pytest.mark.parametrize("feature", schema.names())
def test_hand_computed(base, feature):
    for week, expected in enumerate(EXPECTED_A[feature], 1):
        got = base["A", week][feature]
        assert got == (None if expected is None else pytest.approx(expected, abs=1e-6)), f"week {week}"


def test_every_user_has_every_week(base):
    assert set(base) == {(u, w) for u in "ABC" for w in range(1, 5)}


@pytest.mark.parametrize("user", ["B", "C"])
def test_unobserved_users(base, user):
    filled = [f.name for f in schema.FEATURES if f.section != "payments" and f.when_absent == 0]
    assert len(filled) == 10
    for week in range(1, 5):
        row = base[user, week]
        assert all(row[c] == 0 for c in filled)
        assert row["session_count_vs_baseline"] is None and row["playtime_vs_baseline"] is None
        assert row["avg_latency"] is None and row["genre_entropy"] is None


def test_payment_rules(base):
    assert base["B", 1]["payment_frequency_change"] == -1
    assert base["B", 1]["days_since_last_payment"] is None
    assert base["B", 1]["total_spend_last_4w"] == 0 and base["B", 1]["payment_count_last_4w"] == 0
    assert base["C", 1]["payment_frequency_change"] is None
    assert (base["B", 1]["current_tier_numeric"], base["C", 1]["current_tier_numeric"]) == (0, 2)


def test_strict_inactivity(spark):
    rows = by_user_week(weekly_features(tables(spark), CFG, strict_inactivity=True))
    assert [rows["C", w]["longest_inactive_days"] for w in range(1, 5)] == [7, 14, 21, 28]
    assert [rows["A", w]["longest_inactive_days"] for w in range(1, 5)] == [3, 5, 12, 19]


def test_window_borders_and_peak_hours(edge):
    row = edge["D", 2]
    assert row["weekly_session_count"] == 3
    assert sum(edge["D", w]["weekly_session_count"] for w in range(1, 5)) == 3
    assert row["peak_hour_ratio"] == pytest.approx(1 / 3)


def test_whole_seconds(edge):
    # 91, 600 and 1800 seconds: the end of t1 loses its 0.9 s.
    assert edge["D", 2]["total_playtime_min"] == pytest.approx((91 + 600 + 1800) / 60)


def test_negative_gap_is_kept(edge):
    # t2 starts 90 s before t1 ends; t3 starts 18:49:59 after t2 ends.
    gaps = [-90 / 60, (18 * 3600 + 49 * 60 + 59) / 60]
    mean = sum(gaps) / 2
    assert edge["D", 2]["session_regularity"] == pytest.approx(math.sqrt(sum((g - mean) ** 2 for g in gaps)))


def test_unknown_game_is_its_own_genre(edge):
    assert edge["D", 2]["genre_entropy"] == pytest.approx(math.log2(3))
    assert edge["D", 2]["unique_games_played"] == 3


def test_unknown_tier_and_failed_payments(edge):
    row = edge["D", 2]
    assert row["current_tier_numeric"] is None
    assert row["days_since_last_payment"] is None and row["total_spend_last_4w"] == 0
    assert row["payment_count_last_4w"] == 1 and row["failed_payment_count"] == 1


def test_sessions_of_unknown_user_are_kept(edge):
    assert edge["Z", 1]["weekly_session_count"] == 1
    assert edge["Z", 1]["days_since_signup"] is None
    assert edge["Z", 1]["tier_changes_count"] is None


def test_baseline_ratio(edge):
    # One baseline session of 31 minutes against a quarter of it per week.
    assert edge["D", 2]["session_count_vs_baseline"] == pytest.approx(3 / 0.25)
    assert edge["D", 1]["session_count_vs_baseline"] == 0
    assert edge["D", 2]["playtime_vs_baseline"] == pytest.approx((2491 / 60) / (31 / 4))
