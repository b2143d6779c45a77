"""Small tables in 7-day weeks with answers worked out by hand."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from ebbtide.sources.tables import Tables

SESSION = (
    "session_id string, user_id string, game_id string, start_time timestamp_ntz, end_time timestamp_ntz, "
    "avg_latency_ms double, avg_fps double, total_frame_drops long, disconnect_count long, "
    "avg_bitrate_mbps double, avg_jitter_ms double, packet_loss_rate double, exit_type string"
)
USER = "user_id string, signup_date date, subscription_tier string, persona string"
GAME = "game_id string, genre string, popularity_tier string"
EVENT = "event_id string, user_id string, event_date date, event_type string"
PAYMENT = "payment_id string, user_id string, payment_date date, amount_usd double, payment_type string, status string"


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def session_row(sid, user, game, start, end, exit_type="normal", latency=20.0):
    return (sid, user, game, ts(start), ts(end), latency, 60.0, 3, 1, 25.0, 2.0, 0.01, exit_type)


BASE_SESSIONS = [
    session_row("s1", "A", "g1", "2024-01-30 20:00:00", "2024-01-30 21:00:00", latency=10.0),
    session_row("s2", "A", "g2", "2024-02-03 10:00:00", "2024-02-03 10:30:00", "crash", latency=30.0),
    session_row("s3", "A", "g1", "2024-02-06 19:00:00", "2024-02-06 20:30:00"),
    session_row("s4", "B", "g1", "2024-01-10 12:00:00", "2024-01-10 13:00:00"),
    session_row("s5", "A", "g1", "2024-02-27 12:00:00", "2024-02-27 12:10:00"),
]
BASE_USERS = [
    ("A", day("2023-06-01"), "priority", "hardcore"),
    ("B", day("2023-06-01"), "free", "casual"),
    ("C", day("2023-06-01"), "ultimate", "casual"),
]
BASE_GAMES = [("g1", "FPS", "S"), ("g2", "RPG", "A")]
BASE_EVENTS = [
    ("e1", "A", day("2024-02-01"), "renew"),
    ("e2", "A", day("2024-02-20"), "downgrade"),
]
BASE_PAYMENTS = [
    ("p1", "A", day("2024-02-05"), 9.99, "subscription", "failed"),
    ("p2", "A", day("2024-02-10"), 9.99, "subscription", "success"),
    ("p3", "A", day("2024-01-05"), 9.99, "subscription", "success"),
    ("p4", "B", day("2024-01-06"), 3.99, "day_pass", "success"),
]


def tables(spark: SparkSession, sessions=(), users=(), payments=(), games=()) -> Tables:
    """The base rows plus the given ones."""
    return Tables.of(
        users=spark.createDataFrame([*BASE_USERS, *users], USER),
        sessions=spark.createDataFrame([*BASE_SESSIONS, *sessions], SESSION),
        games=spark.createDataFrame([*BASE_GAMES, *games], GAME),
        sub_events=spark.createDataFrame(BASE_EVENTS, EVENT),
        payments=spark.createDataFrame([*BASE_PAYMENTS, *payments], PAYMENT),
    )
