"""Rewrites for scale against the direct definitions, with one dominant user and game."""

from __future__ import annotations

import datetime as dt
import math
import random
import statistics
from collections import defaultdict

import pytest
from fixture import SESSION, session_row
from pyspark.sql import functions as F

from ebbtide import WindowConfig
from ebbtide.functions import exprs as X
from ebbtide.operators import diversity, engagement, gaps, quantiles, scaffold, sessions

CFG = WindowConfig()


def make_rows(seed: int, n: int) -> list[tuple]:
    """Sessions of which a third belongs to one user and a third to one game."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = "hot" if rng.random() < 1 / 3 else f"u{rng.randrange(40)}"
        game = "g1" if rng.random() < 1 / 3 else f"g{rng.randrange(2, 12)}"
        start = dt.datetime(2024, 1, 29) + dt.timedelta(seconds=rng.randrange(28 * 86400))
        if i % 5 == 0:
            start = start.replace(minute=0, second=0)  # equal start times
        end = start + dt.timedelta(seconds=rng.randrange(0, 7200))
        rows.append(session_row(f"s{i:06d}", user, game, str(start), str(end)))
    return rows


@pytest.fixture(scope="module")
def rows():
    return make_rows(1, 4000)


@pytest.fixture(scope="module")
def obs(spark, rows):
    return scaffold.observe(spark.createDataFrame(rows, SESSION), CFG).checkpoint()


def naive_gaps(rows):
    weeks = defaultdict(list)
    for r in rows:
        week = (r[3] - dt.datetime(2024, 1, 29)).days // 7 + 1
        weeks[r[1], week].append((r[3], r[0], r[4]))
    result = {}
    for key, items in weeks.items():
        items.sort()
        result[key] = [
            int((b[0] - a[2].replace(microsecond=0)).total_seconds()) for a, b in zip(items, items[1:])
        ]
    return result


@pytest.mark.parametrize("pieces", [1, 16, 1000])
def test_sliced_gaps_equal_one_ordering(obs, rows, pieces):
    got = defaultdict(list)
    for r in gaps.inter_session_gaps(obs, pieces).collect():
        got[r["user_id"], r["week_num"]].append(r["gap_s"])
    expected = naive_gaps(rows)
    assert set(got) == set(expected)
    for key, values in expected.items():
        assert sorted(v for v in got[key] if v is not None) == sorted(values)
        assert got[key].count(None) == 1


@pytest.mark.parametrize("pieces", [None, 16, 1000])
def test_regularity(obs, rows, pieces):
    expected = naive_gaps(rows)
    for r in gaps.session_regularity(obs, pieces).collect():
        values = [g / 60 for g in expected[r["user_id"], r["week_num"]]]
        want = statistics.stdev(values) if len(values) > 1 else 0.0
        assert r["session_regularity"] == pytest.approx(want, abs=1e-7)


def test_gaps_of_sessions_without_a_user(spark):
    """They are ordered like those of one user, also where the session id is null."""
    start = dt.datetime(2024, 1, 30)
    at = [start + dt.timedelta(hours=h) for h in (0, 1, 5, 30, 31, 80)]
    rows = [session_row(f"n{i}", None, "g1", str(t), str(t + dt.timedelta(minutes=10))) for i, t in enumerate(at)]
    rows += [session_row(None, "u", "g1", str(t), str(t + dt.timedelta(minutes=10))) for t in at]
    obs = scaffold.observe(spark.createDataFrame(rows, SESSION), CFG)
    want = statistics.stdev([(b - a).total_seconds() / 60 - 10 for a, b in zip(at, at[1:])])
    got = {r["user_id"]: r["session_regularity"] for r in gaps.session_regularity(obs).collect()}
    assert got == {None: pytest.approx(want), "u": pytest.approx(want)}
    assert gaps.inter_session_gaps(obs).filter("gap_s is not null").count() == 10


def test_an_hour_with_a_third_of_all_sessions_is_split(spark):
    """Sessions without a user, all in one hour, many of them at the same second."""
    n, partitions = 120_000, 16
    hot = F.col("id") % 3 == 0
    second = F.when(hot, F.pmod(F.xxhash64("id"), F.lit(3600)) % 600).otherwise(F.pmod(F.xxhash64("id"), F.lit(20 * 86400)))
    start = F.lit("2024-01-29 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=second.cast("decimal(18,6)"))
    sessions_ = spark.range(n).select(
        F.concat(F.lit("s"), F.col("id")).alias("session_id"),
        F.when(~hot, F.concat(F.lit("u"), F.col("id") % 997)).alias("user_id"),
        start.alias("start_time"),
        (start + F.make_dt_interval(secs=(F.col("id") % 50).cast("decimal(18,6)"))).alias("end_time"),
    )
    settings_ = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    saved = {k: spark.conf.get(k) for k in settings_}
    try:
        for k, v in settings_.items():
            spark.conf.set(k, v)
        obs = scaffold.observe(sessions_, CFG)
        ordered = gaps._ordered(obs, None)
        tasks = ordered.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max("prev_end"))
        in_task = sorted(r["n"] for r in tasks.collect())
        assert sum(in_task) == n and len(in_task) == partitions
        assert in_task[-1] <= 3 * in_task[partitions // 2], in_task
        in_slice = ordered.groupBy("user_id", "week_num", "slice").count().agg(F.max("count")).first()[0]
        assert in_slice <= 3 * n / (gaps.PIECES * partitions)
        got = gaps.session_regularity(obs).where("user_id is null").collect()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    rows = sorted((r["start_time"], r["session_id"], r["end_time"]) for r in sessions_.where("user_id is null").collect())
    want = statistics.stdev([(b[0] - a[2]).total_seconds() / 60 for a, b in zip(rows, rows[1:])])
    assert [r["session_regularity"] for r in got] == [pytest.approx(want)]


def test_cuts_are_few_whatever_the_data(spark, obs):
    for pieces in (1, 8, 64):
        found = gaps.cut_points(obs, pieces).collect()
        assert sum(len(r["cuts"]) for r in found) <= pieces
        assert all(r["cuts"] == sorted(r["cuts"]) for r in found)
    assert gaps.cut_points(obs.limit(0), 8).collect() == []


def test_streaks_from_bits_equal_day_scaffold(obs):
    dense = scaffold.fill_missing_weeks(sessions.session_profile(obs, CFG), CFG)
    bits = engagement.longest_inactive_days(dense, CFG)
    streaks = engagement.inactive_streaks(engagement.daily_activity(dense, CFG))
    by_day = streaks.groupBy("user_id", "week_num").agg(F.max("streak_len").alias("n"))
    expected = {(r[0], r[1]): r[2] for r in by_day.collect()}
    got = {(r["user_id"], r["week_num"]): r["longest_inactive_days"] for r in bits.collect()}
    assert {k: v for k, v in got.items() if v > 0} == expected


def test_day_volatility_equals_dense_days(obs):
    dates = scaffold.user_dates(scaffold.observed_users(obs), CFG)
    daily = sessions.daily_playtime(obs).drop("week_num")
    dense = dates.join(daily, ["user_id", "date"], "left").fillna(0, subset=["daily_playtime_min"])
    expected = {
        (r[0], r[1]): r[2]
        for r in dense.groupBy("user_id", "week_num").agg(F.stddev("daily_playtime_min")).collect()
    }
    for r in sessions.session_profile(obs, CFG).collect():
        assert r["daily_playtime_std"] == pytest.approx(expected[r["user_id"], r["week_num"]], abs=1e-7)


def test_game_features_by_brute_force(spark, obs, rows):
    genre = {f"g{i}": f"genre{i % 4}" for i in range(1, 9)}  # g9 and above are unknown
    games = spark.createDataFrame([(g, n) for g, n in genre.items()], "game_id string, genre string")
    plays = defaultdict(lambda: defaultdict(list))
    for r in rows:
        week = (r[3] - dt.datetime(2024, 1, 29)).days // 7 + 1
        plays[r[1]][week].append((r[2], int((r[4] - r[3]).total_seconds())))
    for r in diversity.game_features(obs, games, CFG).collect():
        weeks = plays[r["user_id"]]
        mine = weeks[r["week_num"]]
        seconds, genres = defaultdict(int), defaultdict(int)
        for game, s in mine:
            seconds[game] += s
            genres[genre.get(game)] += 1
        assert r["unique_games_played"] == len(seconds)
        assert r["top_game_concentration"] == pytest.approx(max(seconds.values()) / sum(seconds.values()))
        entropy = -sum(c / len(mine) * math.log2(c / len(mine)) for c in genres.values())
        assert r["genre_entropy"] == pytest.approx(entropy, abs=1e-9)
        before = {g for w, played in weeks.items() if w < r["week_num"] for g, _ in played}
        if any(w < r["week_num"] for w in weeks):
            assert r["new_game_trial_rate"] == pytest.approx(len(set(seconds) - before) / len(seconds))
        else:
            assert r["new_game_trial_rate"] is None


def test_shuffle_join_of_the_catalogue_gives_the_same(spark, obs):
    games = spark.createDataFrame([(f"g{i}", f"genre{i % 4}") for i in range(1, 9)], "game_id string, genre string")

    def result():
        rounded = [F.round(c, 9).alias(c) for c in ("top_game_concentration", "genre_entropy", "new_game_share")]
        profile = diversity.game_profile(obs, games, CFG)
        return sorted(map(tuple, profile.select("user_id", "week_num", "unique_games_played", *rounded).collect()))

    expected = result()
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1b")
        assert result() == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
        spark.conf.unset("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")


def naive_quantile(values, p):
    ordered = sorted(values)
    return ordered[max(math.ceil(round(p * len(ordered), 9)), 1) - 1]


@pytest.mark.parametrize("kind", ["normal", "constant", "negative", "wide", "one"])
def test_quantiles(spark, kind):
    rng = random.Random(7)
    make = {
        "normal": lambda: round(rng.gauss(100, 30), 3),
        "constant": lambda: 5.0,
        "negative": lambda: rng.uniform(-50, 3),
        "wide": lambda: rng.choice([-1, 1]) * 10 ** rng.uniform(-6, 12),
        "one": lambda: rng.gauss(0, 1),
    }[kind]
    n = 1 if kind == "one" else 2003
    values = [(i % 3, make()) for i in range(n)]
    # A third of all rows carries one value.
    values += [(g, 42.0) for g, _ in values[: n // 3]]
    df = spark.createDataFrame(values, "g int, v double")
    probs = ["0.01", "0.25", "0.5", "0.95", "0.99"]
    got = {(r["g"], r["p"]): r["value"] for r in quantiles.exact_quantiles(df, ["g"], ["v"], probs).collect()}
    for g in {g for g, _ in values}:
        for p in probs:
            assert got[g, float(p)] == naive_quantile([v for h, v in values if h == g], float(p))


def test_quantiles_rank_nan_highest(spark):
    nan, inf = float("nan"), float("inf")
    for values in ([1.0, 2.0, 3.0, 4.0, nan], [nan, nan, 1.0], [-inf, inf, nan, 0.0, -1.0, 5.0, -inf]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        ordered = sorted(values, key=lambda v: (math.isnan(v), v if not math.isnan(v) else 0))
        for p in ("0.01", "0.25", "0.5", "0.75", "0.99"):
            got = quantiles.exact_quantiles(df, [], ["v"], [p]).collect()[0]["value"]
            want = ordered[max(math.ceil(round(float(p) * len(values), 9)), 1) - 1]
            assert got == want or math.isnan(got) and math.isnan(want), (values, p)


def test_near_equal_values_are_not_ordered_in_one_task(spark):
    """A hundred thousand doubles of one coarse bin: only one part of it is ordered."""
    df = spark.range(100_000).select((F.lit(60.0) + F.col("id") * 1e-9).alias("v"))
    assert df.select(quantiles._bin(F.col("v"))).distinct().count() == 1
    found = quantiles._candidates(df, [], ["v"], ["0.5"])
    assert found.agg(F.min("value")).first()[0] == pytest.approx(60 + 49_999e-9, abs=1e-12)
    assert found.count() < 200


def test_a_repeated_catalogue_row_changes_only_the_entropy(spark, obs):
    games = spark.createDataFrame([("g1", "a"), ("g2", "b")], "game_id string, genre string")
    columns = ["user_id", "week_num", "unique_games_played", "top_game_concentration", "new_game_share"]
    plain = diversity.game_profile(obs, games, CFG)
    twice = diversity.game_profile(obs, games.union(games.limit(1)), CFG)
    assert sorted(map(tuple, plain.select(*columns).collect()), key=repr) == sorted(
        map(tuple, twice.select(*columns).collect()), key=repr
    )


def test_quantiles_of_whole_table_skip_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,), (3.0,), (4.0,)], "v double")
    got = quantiles.exact_quantiles(df, [], ["v"], ["0.5"]).collect()
    assert [(r["metric"], r["value"]) for r in got] == [("v", 2.0)]


def test_period_index_rounds_down(spark):
    df = spark.createDataFrame([("2024-01-28",), ("2024-01-29",), ("2024-02-04",), ("2024-02-05",)], "d string")
    got = df.select(X.period_index(CFG.obs_start, F.col("d").cast("date"), 7)).collect()
    assert [r[0] for r in got] == [0, 1, 1, 2]
