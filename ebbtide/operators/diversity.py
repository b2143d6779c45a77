"""Variety of the games a user plays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.config import WindowConfig
from ebbtide.functions import exprs as X
from ebbtide.schema import KEYS


# Measures of a (user, week, game): column, from sessions, from counts of sessions.
MEASURES = (
    ("n_rows", "count(*)", "sum(n_rows)"),
    ("game_sessions", "count(session_id)", "sum(game_sessions)"),
    ("game_seconds", "sum(duration_s)", "sum(game_seconds)"),
)


def game_counts(obs: DataFrame) -> DataFrame:
    """The measures per (user, week, game); sums that merge over parts of the sessions."""
    return obs.groupBy(*KEYS, "game_id").agg(*[F.expr(f"{total} as {name}") for name, total, _ in MEASURES])


def game_weeks(obs: DataFrame, cfg: WindowConfig, counted: bool = False) -> DataFrame:
    """One row per (user, week, game) with playtime, sessions and ``is_new``.

    Sessions, or rows of ``game_counts`` if ``counted``, are summed per (user, game) with
    one column per week, so the first week of a game is known in the same row and no
    self-join over earlier weeks is needed. They collapse on the map side before the shuffle.
    """
    weeks = range(1, cfg.obs_periods + 1)
    wide = obs.groupBy("user_id", "game_id").agg(
        F.min("week_num").alias("first_week"),
        *[
            F.expr(f"{merged if counted else total} filter (where week_num = {w}) as {name}_{w}")
            for w in weeks
            for name, total, merged in MEASURES
        ],
    )
    names = [name for name, _, _ in MEASURES]
    cells = ", ".join(f"{w}, " + ", ".join(f"{name}_{w}" for name in names) for w in weeks)
    by_week = f"stack({cfg.obs_periods}, {cells}) as (week_num, {', '.join(names)})"
    return (
        wide.selectExpr("user_id", "game_id", "first_week", by_week)
        .filter("n_rows > 0")
        .withColumn("is_new", F.col("first_week") == F.col("week_num"))
        .drop("n_rows", "first_week")
    )


def genre_weeks(games_played: DataFrame, games: DataFrame) -> DataFrame:
    """Game rows merged per genre; a game without catalogue row has a null genre.

    A game that the catalogue lists more than once counts in each of its genres, but
    only its first row counts as the game. The catalogue is broadcast if Spark finds it
    small enough; otherwise the join is a shuffle join, whose hot games adaptive
    execution splits.
    """
    copy = F.row_number().over(Window.partitionBy("game_id").orderBy("genre"))
    genre = games.select("game_id", "genre", (copy > 1).alias("again"))
    once = ~F.coalesce("again", F.lit(False))
    return (
        games_played.join(genre, "game_id", "left")
        .groupBy(*KEYS, "genre")
        .agg(
            F.sum("game_sessions").alias("genre_sessions"),
            F.sum(F.when(once, F.col("game_seconds"))).alias("genre_seconds"),
            F.max("game_seconds").alias("top_game_seconds"),
            F.count_if(once & F.col("game_id").isNotNull()).alias("n_games"),
            F.count_if(once & F.col("is_new") & F.col("game_id").isNotNull()).alias("n_new"),
        )
    )


def game_profile(obs: DataFrame, games: DataFrame, cfg: WindowConfig, counted: bool = False) -> DataFrame:
    """Unique games, playtime share of the top game, genre entropy, share of new games.

    Only the entropy depends on the catalogue; what it lacks or repeats leaves the other
    columns as they are. With c the sessions per genre and N their sum, the entropy in
    bits is ``log2 N - sum(c log2 c) / N``, which needs no pass for the shares.
    """
    c = F.col("genre_sessions").cast("double")
    weekly = (
        genre_weeks(game_weeks(obs, cfg, counted), games)
        .groupBy(*KEYS)
        .agg(
            F.sum("n_games").alias("unique_games_played"),
            F.sum("n_new").alias("n_new"),
            F.sum("genre_seconds").alias("seconds"),
            F.max("top_game_seconds").alias("top_seconds"),
            F.sum("genre_sessions").cast("double").alias("sessions"),
            F.sum(F.when(c > 0, c * F.log2(c)).otherwise(0.0)).alias("c_log_c"),
        )
    )
    entropy = F.log2("sessions") - X.safe_ratio("c_log_c", "sessions")
    return weekly.select(
        *KEYS,
        "unique_games_played",
        X.safe_ratio("top_seconds", "seconds").alias("top_game_concentration"),
        F.greatest(entropy, F.lit(0.0)).alias("genre_entropy"),
        X.share("n_new", "unique_games_played").alias("new_game_share"),
    )


def new_game_trial_rate(active: DataFrame) -> DataFrame:
    """Share of new games, null in a user's first active week.

    Takes the rows of active weeks only.
    """
    earlier = F.lag("week_num").over(Window.partitionBy("user_id").orderBy("week_num"))
    return active.withColumn(
        "new_game_trial_rate", F.when(earlier.isNotNull(), F.col("new_game_share"))
    ).drop("new_game_share")


def game_features(obs: DataFrame, games: DataFrame, cfg: WindowConfig) -> DataFrame:
    return new_game_trial_rate(game_profile(obs, games, cfg))


def game_share(games_played: DataFrame) -> DataFrame:
    """Share of each game in the playtime of the user-week."""
    totals = games_played.groupBy(*KEYS).agg(F.sum("game_seconds").alias("total_seconds"))
    return games_played.join(totals, list(KEYS)).select(
        *KEYS,
        "game_id",
        (F.col("game_seconds") / F.lit(60.0)).alias("game_playtime"),
        X.safe_ratio("game_seconds", "total_seconds").alias("playtime_share"),
    )


def prior_game_counts(games_played: DataFrame) -> DataFrame:
    """Number of distinct games a user had played before each active week."""
    before = Window.partitionBy("user_id").orderBy("week_num").rowsBetween(Window.unboundedPreceding, -1)
    return (
        games_played.groupBy(*KEYS)
        .agg(F.count_if("is_new").alias("n_new_games"))
        .withColumn("n_prior_games", F.coalesce(F.sum("n_new_games").over(before), F.lit(0)))
        .select(*KEYS, "n_prior_games", "n_new_games")
    )
