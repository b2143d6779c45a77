"""Churn label: no session in the prediction window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.config import WindowConfig
from ebbtide.functions import exprs as X


def churn_labels(users: DataFrame, sessions: DataFrame, cfg: WindowConfig) -> DataFrame:
    """``(user_id, churn)`` for every user; reads two columns of the sessions."""
    returned = (
        sessions.filter(X.ts_within("start_time", cfg.prediction))
        .select("user_id")
        .distinct()
        .withColumn("returned", F.lit(True))
    )
    return (
        users.select("user_id")
        .join(returned, "user_id", "left")
        .select("user_id", F.col("returned").isNull().cast("int").alias("churn"))
    )
