"""Headline queries and the batch jobs, timed; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads, ``BENCH_RUNS``
the timed runs per query after one warm-up; their median counts. Once ``BENCH_BUDGET``
seconds have passed, a query is timed once. Every query is executed in full into a sink
that discards the rows.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from ebbtide.plans import jobs
from ebbtide.queries.registry import QUERIES
from ebbtide.sources import adapter

HEADLINE = [
    "session_patterns",
    "inter_session_gap",
    "session_regularity",
    "population_medians",
    "session_features",
    "engagement_features",
    "streaming_quality",
    "game_features",
    "volatility_features",
    "payment_features",
    "weekly_features",
    "churn_labels",
    "stratified_split",
    "flat_dataset",
    "sequence_matrix",
    "dq_bounded",
    "persona_feature_means",
    "persona_session_stats",
    "persona_weekly_activity",
    "duration_percentiles",
    "session_totals",
    "pivot_exit_by_persona",
]


def discard(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    until = time.perf_counter() + float(os.environ.get("BENCH_BUDGET", "240"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ebbtide-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    out = tempfile.mkdtemp(prefix="ebbtide-bench-")
    tables, cfg = adapter.load(spark, sf_dir), adapter.TEST_WINDOWS
    work = {name: (lambda name=name: discard(QUERIES[name].run(spark, sf_dir))) for name in HEADLINE}
    work["job_features"] = lambda: jobs.features(tables, out, cfg)
    work["job_dataset"] = lambda: discard(jobs.dataset(tables, out, cfg))
    work["job_validate"] = lambda: discard(jobs.validate(tables, out, cfg))

    seconds = {}
    for name, run in work.items():
        taken = []
        while len(taken) < 2 or len(taken) <= runs and time.perf_counter() < until:
            start = time.perf_counter()
            run()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
