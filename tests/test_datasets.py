"""Labels, flat and sequence datasets, split."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import pytest
from fixture import tables
from pyspark.sql import functions as F

from ebbtide import SplitConfig, WindowConfig, schema
from ebbtide.operators import audit, checks, flat, labels, sequence, split
from ebbtide.plans.weekly import weekly_features

CFG = WindowConfig()


@pytest.fixture(scope="module")
def raw(spark):
    return tables(spark)


@pytest.fixture(scope="module")
def weekly(raw):
    return weekly_features(raw, CFG).checkpoint()


@pytest.fixture(scope="module")
def label(raw):
    return labels.churn_labels(raw.users, raw.sessions, CFG)


def test_labels(label):
    assert {r["user_id"]: r["churn"] for r in label.collect()} == {"A": 0, "B": 1, "C": 1}


def test_flat(weekly, label):
    df = flat.flat_dataset(weekly, label, CFG)
    assert len(df.columns) == 44
    rows = {r["user_id"]: r for r in df.collect()}
    assert rows["A"]["playtime_slope"] == pytest.approx(-36)
    assert rows["B"]["playtime_slope"] == 0
    assert rows["A"]["crash_exit_ratio"] == pytest.approx(0.25)
    assert rows["A"]["unique_games_played"] == pytest.approx(1.5)
    assert rows["A"]["longest_inactive_days_last"] == 19
    assert rows["A"]["crash_exit_ratio_last"] is None
    assert rows["A"]["churn"] == 0


def test_flat_column_order(weekly, label):
    df = flat.flat_dataset(weekly, label, CFG)
    last = [c for c in df.columns if c.endswith("_last")]
    assert last == [
        "session_count_wow_change_last", "playtime_wow_change_last", "session_count_vs_baseline_last",
        "playtime_vs_baseline_last", "longest_inactive_days_last", "new_game_trial_rate_last",
        "weekly_session_count_last", "total_playtime_min_last", "crash_exit_ratio_last",
    ]
    assert len(schema.flat_names("mean")) == 22 and len(schema.flat_names("static")) == 10


def test_sequence(weekly, label):
    df = sequence.sequence_dataset(weekly, label)
    rows = {r["user_id"]: r["X"] for r in df.collect()}
    at = {name: i for i, name in enumerate(schema.names())}
    for matrix in rows.values():
        assert len(matrix) == 4 and all(len(week) == 38 for week in matrix)
        assert not any(v is None or math.isnan(v) for week in matrix for v in week)
    a = rows["A"]
    assert [week[at["weekly_session_count"]] for week in a] == [2, 1, 0, 0]
    assert [week[at["session_count_wow_change"]] for week in a] == [0, 0, -1, 0]
    assert [week[at["session_count_vs_baseline"]] for week in a] == [1, 1, 1, 1]
    assert [week[at["days_since_last_payment"]] for week in rows["B"]] == [-1] * 4
    assert [week[at["avg_latency"]] for week in rows["C"]] == [0] * 4


def naive_split(ids: dict[str, int], cfg: SplitConfig) -> dict[str, str]:
    """Order each class by hash in one list and cut it."""
    result = {}
    for churn in set(ids.values()):
        members = sorted(
            (u for u, c in ids.items() if c == churn),
            key=lambda u: (hashlib.md5(f"{u}|{cfg.seed}".encode()).hexdigest(), u),
        )
        train, val = int(len(members) * cfg.train), int(len(members) * cfg.val)
        for i, u in enumerate(members):
            result[u] = "train" if i < train else "val" if i < train + val else "test"
    return result


@pytest.mark.parametrize("digits", [1, 2, 3])
def test_split_equals_global_order(spark, digits):
    cfg = SplitConfig(bucket_digits=digits)
    ids = {f"U{i:05d}": int(i % 7 == 0) for i in range(3000)}
    df = split.stratified_split(spark.createDataFrame(list(ids.items()), "user_id string, churn int"), cfg)
    assert {r["user_id"]: r["split"] for r in df.collect()} == naive_split(ids, cfg)


@pytest.mark.parametrize("n, sizes", [(90, (62, 13, 15)), (170, (118, 25, 27)), (1, (0, 0, 1)), (20, (14, 3, 3))])
def test_split_sizes(spark, n, sizes):
    df = spark.range(n).select(F.col("id").alias("user_id"), F.lit(1).alias("churn"))
    counts = Counter(r["split"] for r in split.stratified_split(df).collect())
    assert tuple(counts[s] for s in ("train", "val", "test")) == sizes


def test_split_universe(spark):
    df = spark.range(50).select(F.col("id").alias("user_id"), (F.col("id") % 2).cast("int").alias("churn"))
    part = split.stratified_split(df, universe=spark.range(20).select(F.col("id").alias("user_id")))
    assert {r["user_id"] for r in part.collect()} == set(range(20))


def test_split_depends_on_seed_only(spark):
    df = spark.range(500).select(F.col("id").alias("user_id"), F.lit(0).alias("churn"))
    first = {r["user_id"]: r["split"] for r in split.stratified_split(df).collect()}
    again = {r["user_id"]: r["split"] for r in split.stratified_split(df.repartition(7)).collect()}
    other = {r["user_id"]: r["split"] for r in split.stratified_split(df, SplitConfig(seed=7)).collect()}
    assert first == again and first != other


def verdicts(df):
    return {r["check_name"]: (r["n_checked"], r["n_violations"], r["passed"]) for r in df.collect()}


def test_checks_pass_on_good_data(raw, weekly):
    got = verdicts(audit.weekly_report(weekly, raw.users, CFG))
    assert got["row_count"] == (12, 0, True)
    assert got["unique_key"] == (12, 0, True)
    # Three users say nothing about the segments.
    segments = {"group_order", "segment_decay", "segment_stability"}
    assert segments < set(got)
    assert all(passed for name, (_, _, passed) in got.items() if name not in segments), got


def test_checks_find_errors(raw, weekly):
    broken = weekly.unionByName(weekly.filter("user_id = 'A' and week_num = 1"))
    got = verdicts(audit.weekly_report(broken, raw.users, CFG))
    assert got["row_count"][1:] == (1, False)
    assert got["unique_key"][1:] == (1, False)
    assert not got["uniform_weeks"][2]
    negative = weekly.withColumn("peak_hour_ratio", F.lit(1.5)).withColumn("refund_count", F.lit(-1))
    negative = negative.withColumn("days_since_signup", F.lit(None).cast("int"))
    got = verdicts(checks.weekly_rows(negative))
    assert got["bounded"][1] == 12 and got["non_negative"][1] == 12 and got["never_null"][1] == 12


def test_split_checks(spark):
    users = spark.range(10).select(F.col("id").alias("user_id"))
    good = users.select("user_id", F.when(F.col("user_id") < 7, "train").otherwise("test").alias("split"))
    twice = good.unionByName(spark.createDataFrame([(1, "test")], "user_id long, split string"))
    assert verdicts(checks.split_disjoint(good))["split_disjoint"] == (10, 0, True)
    assert verdicts(checks.split_disjoint(twice))["split_disjoint"] == (10, 1, False)
    assert verdicts(checks.split_exhaustive(good, users))["split_exhaustive"] == (10, 0, True)
    assert verdicts(checks.split_exhaustive(good.filter("user_id > 2"), users))["split_exhaustive"][1] == 3
    assert verdicts(checks.cross_format(good, good))["cross_format"] == (10, 0, True)
    moved = good.withColumn("split", F.when(F.col("user_id") == 0, "val").otherwise(F.col("split")))
    assert verdicts(checks.cross_format(good, moved))["cross_format"][1] == 2


def test_leakage(weekly, label):
    df = flat.flat_dataset(weekly, label, CFG)
    names = sequence.feature_names(df.sparkSession)
    assert verdicts(checks.leakage(df, names))["leakage"] == (3, 0, True)
    assert verdicts(checks.leakage(df.withColumn("persona", F.lit("x")), names))["leakage"] == (3, 1, False)
