"""Sequence dataset: a weeks x features matrix per user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide import schema


def sequence_filled(weekly: DataFrame) -> DataFrame:
    """Weekly features as doubles with every null replaced by its fill value."""
    doubles = weekly.selectExpr(*schema.KEYS, *[f"double({c}) as {c}" for c in schema.names()])
    return doubles.fillna({f.name: f.sequence_fill for f in schema.FEATURES})


def sequence_dataset(weekly: DataFrame, labels: DataFrame) -> DataFrame:
    """``(user_id, X, churn)`` with ``X[week][feature]``, weeks in order.

    A user has as many rows as the window has weeks, so the list is short.
    """
    step = F.struct("week_num", F.array(*schema.names()).alias("features"))
    return (
        sequence_filled(weekly)
        .groupBy("user_id")
        .agg(F.array_sort(F.collect_list(step)).alias("steps"))
        .select("user_id", F.col("steps.features").alias("X"))
        .join(labels, "user_id", "left")
    )


def sequence_rows(dataset: DataFrame) -> DataFrame:
    """The matrix in long form: one row per user, week and feature."""
    name = F.array(*map(F.lit, schema.names()))
    weeks = dataset.select("user_id", "churn", F.posexplode("X").alias("week", "features"))
    return weeks.select("user_id", "churn", "week", F.posexplode("features").alias("pos", "value")).select(
        "user_id",
        (F.col("week") + 1).alias("week_num"),
        F.get(name, F.col("pos")).alias("feature"),
        "value",
        "churn",
    )


def matrix_text(dataset: DataFrame) -> DataFrame:
    """The nested form with the matrix as text: whole millionths, weeks apart by ``;``."""
    cell = lambda v: F.floor(v * F.lit(1e6) + F.lit(0.501)).cast("long").cast("string")
    weeks = F.transform("X", lambda week: F.array_join(F.transform(week, cell), ","))
    return dataset.select("user_id", F.array_join(weeks, ";").alias("X"), "churn")


def feature_names(spark: SparkSession) -> DataFrame:
    """One row that names the positions of the inner arrays of ``X``."""
    return spark.createDataFrame([(schema.names(),)], "feature_names array<string>")
