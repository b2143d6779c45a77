"""Batch jobs: read the raw tables, compose the operators, write the results.

``python -m ebbtide.plans.jobs inspect|arrange|features|overview|dataset|validate <raw dir> <output dir>``
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.config import SplitConfig, WindowConfig
from ebbtide.operators import audit, checks, profile, sequence, split
from ebbtide.plans import periods
from ebbtide.plans.dataset import build_datasets
from ebbtide.sources import layout, sinks
from ebbtide.sources.tables import FILES, SCHEMAS, Tables, read_parquet, read_tables, utc_instant
from ebbtide.sources.versions import Versions

WEEKLY = "weekly_features.parquet"
WEEKLY_CHECKS = "weekly_checks.parquet"
FLAT = "flat.parquet"
SEQUENCE = "sequence.parquet"
SEQUENCE_NAMES = "sequence_features.parquet"
SPLIT = "split.parquet"


def session(name: str) -> SparkSession:
    """Session of the submitted job; master and sizes come from the submission."""
    return (
        SparkSession.builder.appName(name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.legacy.parquet.nanosAsLong", "true")
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
        .getOrCreate()
    )


# Publications whose tables are kept, for readers that opened them before the last one.
KEPT = 3


def features(
    tables: Tables, output_dir: str, cfg: WindowConfig = WindowConfig(), only: list[int] | None = None
) -> DataFrame:
    """Publish the weekly table and return it as read back.

    ``only`` names the periods whose sessions have changed since the last run (0 and below
    are those of the baseline); the sums of the others are taken over. The row checks
    are observed while the table is written; their verdicts are published with it.
    """
    store = Versions(tables.spark, output_dir)
    with store.publish() as draft:
        fresh = only is None or WEEKLY not in draft.tables
        periods.refresh(draft, tables, cfg, periods.all_periods(cfg) if fresh else only)
        weekly, watch = audit.observed(periods.weekly_from_parts(draft, tables, cfg))
        draft.write(weekly, WEEKLY)
        draft.write(audit.observed_verdicts(weekly, watch), WEEKLY_CHECKS)
    store.prune(KEPT)
    return store.read(WEEKLY)[0]


def overview(tables: Tables, output_dir: str, cfg: WindowConfig = WindowConfig()) -> DataFrame:
    """Extent, distinct counts and percentiles of the sessions, from what was kept of them."""
    store = Versions(tables.spark, output_dir)
    return periods.overview(store.read_parts(periods.SUMMARY, periods.schemas(tables, cfg)[periods.SUMMARY]))


def dataset(
    tables: Tables, output_dir: str, cfg: WindowConfig = WindowConfig(), split_cfg: SplitConfig = SplitConfig()
) -> DataFrame:
    """Publish both dataset forms together, one folder per split, and return the split report."""
    spark, store = tables.spark, Versions(tables.spark, output_dir)
    (weekly,) = store.read(WEEKLY)
    with sinks.Staging(spark, output_dir) as stage, store.publish() as draft:
        built = build_datasets(
            weekly,
            tables.users.select("user_id"),
            tables.sessions_between(cfg.prediction).select("user_id", "start_time"),
            cfg,
            split_cfg,
            stage=stage,
        )
        draft.write(built.split, SPLIT)
        draft.write(built.flat, FLAT, partition_by="split")
        draft.write(built.sequence, SEQUENCE, partition_by="split")
        draft.write(sequence.feature_names(spark), SEQUENCE_NAMES)
    store.prune(KEPT)
    return split.split_report(store.read(SPLIT)[0])


def validate(tables: Tables, output_dir: str, cfg: WindowConfig = WindowConfig()) -> DataFrame:
    """Run the quality checks over the published tables."""
    spark, store = tables.spark, Versions(tables.spark, output_dir)
    current = store.current
    weekly, flat, matrices, names, parts = store.read(WEEKLY, FLAT, SEQUENCE, SEQUENCE_NAMES, SPLIT, current=current)
    columns = [
        row
        for form, name in (("flat", FLAT), ("sequence", SEQUENCE))
        for row in checks.schema_rows(spark, form, f"{output_dir}/{current[name]}")
    ]
    return (
        audit.weekly_report(weekly, tables.users, cfg)
        .unionByName(audit.dataset_report(flat, matrices, names, parts, tables.users, cfg))
        .unionByName(checks.split_schema(spark.createDataFrame(columns, checks.SCHEMA_ROW)))
    )


def inspect(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Columns of the raw files that differ from the declared ones: name, stored and
    declared type. Times of sessions may have several encodings and are not declared."""
    rows = [
        (name, *difference)
        for name, declared in SCHEMAS.items()
        for difference in profile.schema_differences(read_parquet(spark, f"{raw_dir}/{FILES[name]}.parquet"), declared)
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, stored string, declared string")


def arrange(tables: Tables, output_dir: str, buckets: int | None = None) -> None:
    """Write the sessions with their times as instants, the encoding that Spark prunes by:
    ordered by start, so that the windows read few row groups, or in ``buckets`` by user, so
    that nothing per user needs an exchange of them (``layout`` reads these)."""
    if buckets:
        layout.write_by_user(tables.sessions, output_dir, buckets)
        return
    times = {name: utc_instant(name) for name in ("start_time", "end_time")}
    sinks.write_time_ordered(tables.sessions.withColumns(times), f"{output_dir}/{FILES['sessions']}.parquet", "start_time")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="ebbtide")
    parser.add_argument("job", choices=["inspect", "arrange", "features", "overview", "dataset", "validate"])
    parser.add_argument("raw_dir")
    parser.add_argument("output_dir")
    parser.add_argument("--period", type=int, action="append", help="features: only this period has changed")
    parser.add_argument("--buckets", type=int, help="arrange: by user, in so many buckets")
    parser.add_argument("--arranged", help="folder with the sessions that arrange wrote by user")
    args = parser.parse_args(argv)
    spark = session(f"ebbtide-{args.job}")
    tables = layout.read_by_user(spark, args.raw_dir, args.arranged) if args.arranged else read_tables(spark, args.raw_dir)
    if args.job == "inspect":
        inspect(spark, args.raw_dir).show(200, truncate=False)
        profile.table_schemas(tables).show(200, truncate=False)
    elif args.job == "arrange":
        arrange(tables, args.output_dir, args.buckets)
    elif args.job == "features":
        weekly = features(tables, args.output_dir, only=args.period)
        weekly.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(weekly.columns)).alias("columns")).show()
    elif args.job == "overview":
        overview(tables, args.output_dir).show(truncate=False)
    elif args.job == "dataset":
        dataset(tables, args.output_dir).show()
    else:
        validate(tables, args.output_dir).show(50, truncate=False)


if __name__ == "__main__":
    main()
