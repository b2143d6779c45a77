"""Exact stratified split with a reproducible random order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.config import SplitConfig


def stratified_split(
    labels: DataFrame, cfg: SplitConfig = SplitConfig(), universe: DataFrame | None = None
) -> DataFrame:
    """``(user_id, churn, split)``: users of each class ranked by a seeded hash.

    Of n users of a class the first ``floor(n * train)`` go to train, the next
    ``floor(n * val)`` to val, the rest to test. The hash also names a bucket,
    and bucket sizes alone settle nearly every user: a bucket that lies between
    two cuts goes to one split as a whole. Only the buckets that a cut runs
    through are ordered, so no class is ever sorted in one task.

    ``universe`` limits the labels to its ``user_id`` values.
    """
    if universe is not None:
        labels = labels.join(universe.select("user_id").distinct(), "user_id", "left_semi")
    key = F.md5(F.concat(F.col("user_id").cast("string"), F.lit(f"|{cfg.seed}")))
    hashed = labels.select("user_id", "churn", key.alias("hash")).withColumn(
        "bucket", F.substring("hash", 1, cfg.bucket_digits)
    )

    in_order = Window.partitionBy("churn").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    buckets = (
        hashed.groupBy("churn", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(in_order))
        .withColumn("before", F.col("upto") - F.col("n"))
        .withColumn("size", F.sum("n").over(Window.partitionBy("churn")))
        .withColumn("train_end", F.floor(F.col("size") * F.lit(cfg.train)))
        .withColumn("val_end", F.col("train_end") + F.floor(F.col("size") * F.lit(cfg.val)))
        .select("churn", "bucket", "before", "upto", "train_end", "val_end")
    )
    # At most 16**bucket_digits rows per class: the broadcast is bounded.
    placed = hashed.join(F.broadcast(buckets), ["churn", "bucket"])

    whole = (
        F.when(F.col("upto") <= F.col("train_end"), "train")
        .when((F.col("before") >= F.col("train_end")) & (F.col("upto") <= F.col("val_end")), "val")
        .when(F.col("before") >= F.col("val_end"), "test")
    )
    placed = placed.withColumn("split", whole)
    settled = placed.filter(F.col("split").isNotNull()).select("user_id", "churn", "split")

    in_bucket = Window.partitionBy("churn", "bucket").orderBy("hash", "user_id")
    rank = F.col("before") + F.row_number().over(in_bucket)
    cut = (
        placed.filter(F.col("split").isNull())
        .withColumn("rank", rank)
        .select(
            "user_id",
            "churn",
            F.when(F.col("rank") <= F.col("train_end"), "train")
            .when(F.col("rank") <= F.col("val_end"), "val")
            .otherwise("test")
            .alias("split"),
        )
    )
    return settled.unionByName(cut)


def split_report(split: DataFrame) -> DataFrame:
    """Users, churners and churn rate per split, with a line for all users."""
    return (
        split.groupBy("split")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("churn").alias("n_churn"))
        .withColumn("part", F.explode(F.array(F.col("split"), F.lit("all"))))
        .groupBy(F.col("part").alias("split"))
        .agg(F.sum("n").alias("users"), F.sum("n_churn").alias("churned"))
        .withColumn("churn_rate", F.try_divide("churned", "users"))
    )


def members(dataset: DataFrame, split: DataFrame, part: str) -> DataFrame:
    """Rows of the users of one split."""
    return dataset.join(split.filter(F.col("split") == part).select("user_id"), "user_id", "left_semi")


def tagged(dataset: DataFrame, split: DataFrame) -> DataFrame:
    """The dataset with the split of each row, e.g. to partition an output by it."""
    return dataset.join(split.select("user_id", "split"), "user_id")
