"""Sessions arranged by user.

Ordinary users lie in buckets by user, in the order of time, so aggregates and windows per
user read them without an exchange. A user with more sessions than a bucket should hold, and
the sessions without a user, lie in a table of their own, ordered by time, where the map side
combines as usual. No user is in both, so what is computed per user in either is complete, and
the results are put side by side.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.sources.sinks import settings, write_time_ordered
from ebbtide.sources.tables import (
    FILES, Tables, Window, read_parquet, read_tables, stored_within, utc_instant, without_zone,
)
from ebbtide.sources.versions import Folder

BY_USER = f"{FILES['sessions']}_by_user_"  # followed by the number of buckets
BUSY = f"{FILES['sessions']}_busy.parquet"
TIMES = ("start_time", "end_time")


def busy_users(sessions: DataFrame, most: int) -> DataFrame:
    """Users with more than ``most`` sessions, and the null user."""
    counts = sessions.groupBy(F.col("user_id").alias("busy_user")).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter((F.col("n") > most) | F.col("busy_user").isNull()).select("busy_user")


def write_by_user(sessions: DataFrame, folder: str, buckets: int) -> None:
    """Write both tables, times as instants."""
    spark = sessions.sparkSession
    stored = sessions.withColumns({name: utc_instant(name) for name in TIMES})
    # Fewer users than buckets can have more than a bucket's share, so this is broadcast.
    busy = F.broadcast(busy_users(sessions, sessions.count() // buckets))
    same = F.col("user_id").eqNullSafe(F.col("busy_user"))
    write_time_ordered(stored.join(busy, same, "left_semi"), f"{folder}/{BUSY}", "start_time")
    path = f"{folder}/{BY_USER}{buckets}"
    ordinary = stored.join(busy, same, "left_anti").repartition(buckets, "user_id")
    with settings(spark, spark__sql__parquet__outputTimestampType="TIMESTAMP_MICROS"):
        writer = ordinary.write.mode("overwrite").format("parquet").bucketBy(buckets, "user_id").sortBy("start_time")
        writer.option("path", path).saveAsTable(_name(path))


def _name(path: str) -> str:
    return f"ebbtide_{hashlib.md5(path.encode()).hexdigest()}"


def _buckets(spark: SparkSession, folder: str) -> int:
    found = [name for name in Folder(spark, folder).names(folder) if name.startswith(BY_USER)]
    if len(found) != 1:
        raise FileNotFoundError(f"{folder} holds {len(found)} tables of sessions by user")
    return int(found[0].removeprefix(BY_USER))


def _open(spark: SparkSession, folder: str) -> DataFrame:
    """The table of buckets; a catalog that does not know it learns it from its files."""
    buckets = _buckets(spark, folder)
    path = f"{folder}/{BY_USER}{buckets}"
    name = _name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read_parquet(spark, path).schema)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (user_id) SORTED BY (start_time) "
            f"INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)


def read_by_user(spark: SparkSession, input_dir: str, folder: str) -> Tables:
    """The raw tables with the sessions that ``write_by_user`` has arranged."""

    def parts(window: Window | None) -> list[DataFrame]:
        frames = [_open(spark, folder), read_parquet(spark, f"{folder}/{BUSY}")]
        if window:
            frames = [df.filter(stored_within(df, "start_time", window)) for df in frames]
        return [without_zone(df, *TIMES) for df in frames]

    return read_tables(spark, input_dir).with_sessions(parts)
