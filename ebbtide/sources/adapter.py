"""The five raw tables derived from the star-schema test tables.

Every table is mapped whole: a mapping computes columns, it never drops rows.
The event table covers 30 days, so the analysis runs on periods of 3 days.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.config import WindowConfig
from ebbtide.sources.tables import Tables, read_parquet

TEST_WINDOWS = WindowConfig(period_days=3)

# Schemas of the source files.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
}

# Spread of the order dates over days from the start of the data.
DATE_SPREAD = 90


def _source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet", schema=SCHEMAS[name])


def _choose(col: Column, mapping: dict[str, str], default: str) -> Column:
    picked = F.lit(default)
    for value, label in mapping.items():
        picked = F.when(col == value, label).otherwise(picked)
    return picked


def _pick(number: Column, labels: list[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, labels)), (number % len(labels) + 1).cast("int"))


def _order_day(day: str) -> Column:
    offset = F.pmod(F.datediff(F.col(day).cast("date"), F.lit("1995-01-01").cast("date")), F.lit(DATE_SPREAD))
    return F.date_add(F.lit("2024-01-01").cast("date"), offset)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _source(spark, sf_dir, "customer")
    nation = _source(spark, sf_dir, "nation")
    region = _source(spark, sf_dir, "region")
    key = F.col("c_custkey")
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            key.alias("user_id"),
            F.date_add(F.lit("2023-01-01").cast("date"), (key % 365).cast("int")).alias("signup_date"),
            _pick(key, ["free", "priority", "ultimate"]).alias("subscription_tier"),
            _pick(key, ["PC", "Mac", "Chromebook", "TV", "Mobile"]).alias("device_type"),
            F.col("r_name").alias("region"),
            _pick(F.col("n_nationkey"), ["organic", "ad", "friend_referral", "bundled"]).alias("referral_source"),
            _pick(F.floor(key / 3), ["18-24", "25-34", "35-44", "45+"]).alias("age_group"),
            _pick(F.floor(key / 7), ["M", "F", "other", "undisclosed"]).alias("gender"),
            _choose(
                F.col("c_mktsegment"),
                {"AUTOMOBILE": "hardcore", "BUILDING": "regular", "HOUSEHOLD": "about_to_churn"},
                "casual",
            ).alias("persona"),
        )
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    played = F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.round(F.col("value") * 60, 6).cast("decimal(18,6)")
    )
    return _source(spark, sf_dir, "events").select(
        F.col("event_id").alias("session_id"),
        (F.col("user_id") * 10 + F.col("event_id") % 10).alias("user_id"),
        # The stride leaves some ids without a catalogue row.
        (k * 21).cast("long").alias("game_id"),
        F.col("ts").alias("start_time"),
        (F.col("ts") + played).alias("end_time"),
        F.col("value").alias("avg_latency_ms"),
        k.cast("double").alias("avg_fps"),
        (F.col("event_id") % 97).alias("total_frame_drops"),
        (F.col("event_id") % 4).alias("disconnect_count"),
        (F.lit(100) - k).cast("double").alias("avg_bitrate_mbps"),
        (F.col("value") / 2).alias("avg_jitter_ms"),
        (k / 1000).alias("packet_loss_rate"),
        _choose(
            F.col("event_type"),
            {"error": "crash", "signup": "disconnect", "purchase": "timeout"},
            "normal",
        ).alias("exit_type"),
    )


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return _source(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("game_id"),
        F.col("p_name").alias("game_title"),
        F.col("p_type").alias("genre"),
        F.col("p_brand").alias("publisher"),
        F.when(size <= 3, "S").when(size <= 10, "A").when(size <= 28, "B").otherwise("C").alias("popularity_tier"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _source(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_custkey").alias("user_id"),
        _order_day("o_orderdate").alias("payment_date"),
        F.col("o_totalprice").alias("amount_usd"),
        _choose(
            F.col("o_orderpriority"), {"1-URGENT": "day_pass", "2-HIGH": "in_app"}, "subscription"
        ).alias("payment_type"),
        _choose(F.col("o_orderstatus"), {"F": "failed", "P": "refunded"}, "success").alias("status"),
    )


def sub_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _source(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("event_id"),
        F.col("o_custkey").alias("user_id"),
        _order_day("o_orderdate").alias("event_date"),
        _choose(
            F.col("o_orderpriority"),
            {"1-URGENT": "downgrade", "2-HIGH": "upgrade", "3-MEDIUM": "renew"},
            "cancel",
        ).alias("event_type"),
    )


def load(spark: SparkSession, sf_dir: str) -> Tables:
    makers = {"users": users, "sessions": sessions, "games": games, "sub_events": sub_events, "payments": payments}
    return Tables(spark, {name: partial(make, spark, sf_dir) for name, make in makers.items()})
