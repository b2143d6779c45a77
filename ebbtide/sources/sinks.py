"""Sinks of the jobs and the place for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints: the cluster's if it names one.

    A cluster sets ``spark.checkpoint.dir`` to a folder that all nodes share.
    Only a local session without that setting gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named is None:
        named = context.getConf().get("spark.checkpoint.dir", None)
    if named is None:
        named = context.getCheckpointDir()
    if named is None:
        if not re.match(r"local($|\[)", context.master):  # local-cluster has executors of its own
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        named = tempfile.mkdtemp(prefix="ebbtide-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


class Staging:
    """Intermediate tables of a job as Parquet under its output folder, which all nodes
    share; branches read them instead of recomputing, a lost executor costs no more than
    its own tasks, and the folder goes when the job ends."""

    def __init__(self, spark: SparkSession, output_dir: str) -> None:
        self.spark = spark
        self.path = f"{output_dir}/_staging-{uuid.uuid4().hex}"

    def __enter__(self) -> Staging:
        return self

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        write_table(df, f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def __exit__(self, *error) -> None:
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings that hold for the statements inside, then what held before."""
    names = {name: name.replace("__", ".") for name in values}
    saved = {name: spark.conf.get(key, None) for name, key in names.items()}
    for name, key in names.items():
        spark.conf.set(key, values[name])
    try:
        yield
    finally:
        for name, key in names.items():
            if saved[name] is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, saved[name])


def write_time_ordered(df: DataFrame, path: str, time_column: str) -> None:
    """Range-partition by time, so row-group statistics prune date filters; instants are
    written in microseconds, as the older form has no statistics."""
    ordered = df.repartitionByRange(time_column).sortWithinPartitions(time_column)
    with settings(df.sparkSession, spark__sql__parquet__outputTimestampType="TIMESTAMP_MICROS"):
        ordered.write.mode("overwrite").parquet(path)
