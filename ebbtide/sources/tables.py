"""Readers of the five raw tables and the container they travel in."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions import exprs as X

Window = tuple[dt.date, dt.date]


class Tables:
    """The five tables, each opened when it is first used.

    ``session_parts``, if given, opens the sessions that start in a window, or all, as one
    or more tables of which no two have a user in common.
    """

    names = ("users", "sessions", "games", "sub_events", "payments")

    def __init__(
        self,
        spark: SparkSession,
        openers: Mapping[str, Callable[[], DataFrame]],
        session_parts: Callable[[Window | None], list[DataFrame]] | None = None,
    ) -> None:
        self.spark = spark
        self._openers = openers
        self._session_parts = session_parts

    @classmethod
    def of(cls, **frames: DataFrame) -> Tables:
        spark = next(iter(frames.values())).sparkSession
        return cls(spark, {name: (lambda df=df: df) for name, df in frames.items()})

    @cached_property
    def users(self) -> DataFrame:
        return self._openers["users"]()

    @cached_property
    def sessions(self) -> DataFrame:
        return self._openers["sessions"]()

    @cached_property
    def games(self) -> DataFrame:
        return self._openers["games"]()

    @cached_property
    def sub_events(self) -> DataFrame:
        return self._openers["sub_events"]()

    @cached_property
    def payments(self) -> DataFrame:
        return self._openers["payments"]()

    def with_sessions(self, parts: Callable[[Window | None], list[DataFrame]]) -> Tables:
        """The same tables with the sessions in parts."""
        return Tables(self.spark, {**self._openers, "sessions": lambda: reduce(DataFrame.unionByName, parts(None))}, parts)

    def session_parts(self, window: Window) -> list[DataFrame]:
        """Sessions that start in a half-open window of days, filtered in the scan whatever
        encoding the file has; in tables that share no user."""
        if self._session_parts:
            return self._session_parts(window)
        return [self.sessions.filter(X.ts_within("start_time", window))]

    def sessions_between(self, window: Window) -> DataFrame:
        return reduce(DataFrame.unionByName, self.session_parts(window))

    def per_user(self, window: Window, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """What ``compute`` makes of the sessions of a window, whose rows depend on the
        sessions of a single user."""
        return reduce(DataFrame.unionByName, map(compute, self.session_parts(window)))

    def named(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self.names}


# File that holds each table below the input folder.
FILES = {
    "users": "users",
    "sessions": "session_logs",
    "games": "game_catalog",
    "sub_events": "subscription_events",
    "payments": "payments",
}


def read_parquet(
    spark: SparkSession, path: str, columns: list[str] | None = None, schema: str | None = None
) -> DataFrame:
    """Parquet scan; ``columns`` narrows the read schema, ``schema`` declares it.

    A declared schema spares the job that reads the footers. Old INT96 values are
    taken as they stand instead of being shifted to the pre-Gregorian calendar.
    """
    reader = spark.read.option("int96RebaseMode", "CORRECTED").option("datetimeRebaseMode", "CORRECTED")
    if schema:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


EPOCH = dt.date(1970, 1, 1)
MOST_LONG = 2**63 - 1


def stored_within(df: DataFrame, name: str, window: Window) -> Column:
    """A half-open window of UTC days on a time column as the file stores it.

    The bounds are literals in the column's own encoding, so the filter reaches the scan; on
    the wall time computed from the column it would not. Spark prunes row groups by the
    statistics of instants in micro- or milliseconds only; for the other encodings the filter
    just comes before the conversion, and the job ``arrange`` rewrites them as instants.
    """
    kind = df.schema[name].dataType
    low, high = ((day - EPOCH).days * 86_400_000_000 for day in window)
    if isinstance(kind, T.LongType):
        # A bound that nanoseconds can't hold lies beyond every stored value.
        low, high = (max(-MOST_LONG, min(MOST_LONG, 1000 * micros)) for micros in (low, high))
        return (F.col(name) >= F.lit(low)) & (F.col(name) < F.lit(high))
    if isinstance(kind, T.TimestampType):
        first, last = (F.timestamp_micros(F.lit(micros)) for micros in (low, high))
        return (F.col(name) >= first) & (F.col(name) < last)
    return X.ts_within(name, window)


def without_zone(df: DataFrame, *columns: str) -> DataFrame:
    """Bring timestamp columns to ``timestamp_ntz`` whatever the file stored.

    Nanosecond timestamps arrive as longs when the session reads them so
    (``spark.sql.legacy.parquet.nanosAsLong``); a column that already has no
    zone is left untouched, which keeps its filters pushable.
    """
    changed = {}
    for name in columns:
        kind = df.schema[name].dataType
        if isinstance(kind, T.LongType):
            changed[name] = _wall_time(F.expr(f"`{name}` div 1000 - int(`{name}` % 1000 < 0)"))
        elif isinstance(kind, T.TimestampType):
            changed[name] = _wall_time(F.unix_micros(F.col(name)))
    return df.withColumns(changed) if changed else df


def _wall_time(micros: Column) -> Column:
    """UTC wall time, counted from the epoch, whatever the zone of the session."""
    seconds = micros.cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    zero = F.lit(0)
    since = F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since


def utc_instant(name: str) -> Column:
    """The instant of a wall time of UTC, whatever the zone of the session."""
    time = F.col(name)
    days = F.datediff(time.cast("date"), F.lit(EPOCH)).cast("long")
    seconds = (days * 24 + F.hour(time)) * 3600 + F.minute(time) * 60
    micros = F.expr(f"cast(extract(second from `{name}`) * 1000000 as long)")
    return F.timestamp_micros(seconds * 1_000_000 + micros)


# Declared input schemas. Session times come in several encodings, so that schema is
# read from the files.
SCHEMAS = {
    "users": "user_id string, signup_date date, subscription_tier string, device_type string, region string, "
    "referral_source string, age_group string, gender string, persona string",
    "games": "game_id string, game_title string, genre string, publisher string, popularity_tier string, "
    "supported_max_resolution string",
    "sub_events": "event_id string, user_id string, event_date date, event_type string, from_tier string, to_tier string",
    "payments": "payment_id string, user_id string, payment_date date, amount_usd double, payment_type string, "
    "payment_method string, status string",
}


def read_tables(spark: SparkSession, input_dir: str) -> Tables:
    def stored(name: str) -> DataFrame:
        return read_parquet(spark, f"{input_dir}/{FILES[name]}.parquet", schema=SCHEMAS.get(name))

    def sessions(df: DataFrame) -> DataFrame:
        return without_zone(df, "start_time", "end_time")

    def session_parts(window: Window | None) -> list[DataFrame]:
        df = stored("sessions")
        return [sessions(df.filter(stored_within(df, "start_time", window)) if window else df)]

    openers = {name: (lambda name=name: stored(name)) for name in FILES}
    openers["sessions"] = lambda: sessions(stored("sessions"))
    return Tables(spark, openers, session_parts)
