"""Idle time between consecutive sessions of a user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions import exprs as X
from ebbtide.schema import KEYS

# Slices that a user-week with all sessions would have, for each shuffle partition, and
# the sampled sessions behind a slice.
PIECES, SAMPLED = 4, 16


def cut_points(obs: DataFrame, pieces: int) -> DataFrame:
    """Rows ``(cut_user, cut_week, cuts)``: where the sessions of a busy user-week are cut
    into ranges of time.

    The sessions with the ``pieces * SAMPLED`` lowest hashes are a sample; every user-week
    is cut at each of its ``SAMPLED``-th sampled session, so only user-weeks with a share
    of about one in ``pieces`` are cut at all, and there are at most ``pieces`` cuts.
    """
    columns = ["user_id", "week_num", "start_time", "session_id"]
    sample = obs.select(*columns).orderBy(F.xxhash64(*columns), *columns).limit(pieces * SAMPLED)
    number = F.row_number().over(Window.partitionBy(*KEYS).orderBy("start_time", "session_id"))
    chosen = sample.withColumn("number", number).filter(F.col("number") % SAMPLED == 0)
    place = F.struct("start_time", "session_id")
    return chosen.groupBy(F.col("user_id").alias("cut_user"), F.col("week_num").alias("cut_week")).agg(
        F.collect_list(place).alias("cuts")
    )


def _sliced(obs: DataFrame, pieces: int | None) -> DataFrame:
    """Sessions with the number of their slice, in the order of time within a user-week."""
    if pieces is None:
        pieces = PIECES * int(obs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # At most ``pieces`` rows, whatever the number of sessions.
    cuts = F.broadcast(cut_points(obs, pieces))
    same = F.col("user_id").eqNullSafe(F.col("cut_user")) & F.col("week_num").eqNullSafe(F.col("cut_week"))
    here = F.struct("start_time", "session_id")
    passed = F.when(F.col("cuts").isNull(), 0).otherwise(F.size(F.filter("cuts", lambda cut: cut <= here)))
    rows = obs.select(*KEYS, "session_id", "start_time", "end_time").join(cuts, same, "left")
    return rows.select(*KEYS, "session_id", "start_time", "end_time", passed.alias("slice"))


def _ordered(obs: DataFrame, pieces: int | None) -> DataFrame:
    """Sessions with the end of their predecessor in the same slice.

    A slice is the sessions of a user-week between two cuts, so no task orders much more
    than its share whoever the sessions belong to. Ties in start time are ordered by
    session id; rows without a user are users like any other here.
    """
    in_slice = Window.partitionBy(*KEYS, "slice").orderBy("start_time", "session_id")
    return (
        _sliced(obs, pieces)
        .withColumn("prev_end", F.lag("end_time").over(in_slice))
        .withColumn("follows", F.lag(F.lit(True)).over(in_slice).isNotNull())
    )


def _last_end() -> Column:
    return F.max(F.struct("start_time", "session_id", "end_time"))


def inter_session_gaps(obs: DataFrame, pieces: int | None = None) -> DataFrame:
    """Seconds from the end of a session to the start of the next in the week.

    The gap is negative where sessions overlap and null for the first session of a
    week. The first session of a slice takes its predecessor from the slice before:
    one row per slice moves for that.
    """
    ordered = _ordered(obs, pieces)
    whole = Window.partitionBy(*KEYS, "slice")
    across = Window.partitionBy(*KEYS).orderBy("slice")
    heads = (
        ordered.withColumn("last_end", _last_end().over(whole)["end_time"])
        .filter(~F.col("follows"))
        .withColumn("prev_end", F.lag("last_end").over(across))
    )
    columns = [*KEYS, "session_id", "start_time", "prev_end"]
    return (
        ordered.filter("follows")
        .select(*columns)
        .unionByName(heads.select(*columns))
        .select(*KEYS, "session_id", X.seconds_between("prev_end", "start_time").alias("gap_s"))
    )


def session_regularity(obs: DataFrame, pieces: int | None = None) -> DataFrame:
    """Standard deviation of the gaps per user-week, 0 below two gaps.

    One shuffle of the sessions; a slice leaves it as one row with the sums of its gaps,
    its first start and its last end, and the slices of a week are chained.
    """
    gap = X.seconds_between("prev_end", "start_time")
    slices = (
        _ordered(obs, pieces)
        .withColumn("gap", gap)
        .groupBy(*KEYS, "slice")
        .agg(
            F.count("gap").alias("n"),
            F.sum("gap").alias("total"),
            F.sum(X.square("gap")).alias("squares"),
            F.min("start_time").alias("first_start"),
            _last_end()["end_time"].alias("last_end"),
        )
    )
    across = Window.partitionBy(*KEYS).orderBy("slice")
    edge = X.seconds_between(F.lag("last_end").over(across), "first_start")
    sums = slices.withColumn("edge", edge).groupBy(*KEYS).agg(
        (F.sum("n") + F.count("edge")).alias("n"),
        (F.coalesce(F.sum("total"), F.lit(0)) + F.coalesce(F.sum("edge"), F.lit(0))).alias("total"),
        (F.coalesce(F.sum("squares"), F.lit(0.0)) + F.coalesce(F.sum(X.square("edge")), F.lit(0.0))).alias("squares"),
    )
    return sums.select(
        *KEYS, F.coalesce(X.sample_std("n", "total", "squares") / 60, F.lit(0.0)).alias("session_regularity")
    )
