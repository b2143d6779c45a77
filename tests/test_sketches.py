"""Mergeable summaries against the exact forms."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import norm, profile, quantiles, sketches

N = 60_000


@pytest.fixture(scope="module")
def facts(spark):
    """Heavy ties, a long tail, nulls, and a group of one row; half of all rows in group 1."""
    group = F.when(F.col("id") == 7, 3).when(F.col("id") % 2 == 0, 1).otherwise(2)
    mixed = F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003
    return spark.range(N).select(
        group.alias("week_num"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(6)).alias("part"),
        F.when(F.col("id") % 11 == 0, 5.0).when(F.col("id") % 13 != 0, F.pow(mixed, F.lit(-1.5))).alias("weekly_session_count"),
        F.floor(mixed * 20).alias("total_playtime_min"),
        F.concat(F.lit("k"), F.floor(F.pow(mixed, 2) * 20_000)).alias("key"),
    ).checkpoint()


COLUMNS = ["weekly_session_count", "total_playtime_min"]
PROBS = [0.01, 0.5, 0.95]


@pytest.mark.parametrize("merge", [False, True])
def test_ranks_stay_within_the_bound(facts, merge):
    by = ["week_num"]
    summaries = sketches.value_summaries(facts, [*by, "part"] if merge else by, COLUMNS)
    if merge:
        summaries = sketches.merged_values(summaries, by, COLUMNS)
    found = sketches.summarised_quantiles(summaries, by, COLUMNS, PROBS)
    rows = sketches.rank_errors(facts, found, by, COLUMNS).collect()
    assert len(rows) == 3 * len(COLUMNS) * len(PROBS) and all(r["within"] for r in rows)
    assert {(r["week_num"], r["metric"]): r["n"] for r in rows}[1, "total_playtime_min"] == N // 2


def test_an_answer_that_is_off_is_told(facts):
    by = ["week_num"]
    exact = quantiles.exact_quantiles(facts, by, COLUMNS, ["0.5"])
    assert all(r["within"] for r in sketches.rank_errors(facts, exact, by, COLUMNS, 0.0).collect())
    off = exact.withColumn("value", F.col("value") + 1)
    wrong = [r for r in sketches.rank_errors(facts, off, by, COLUMNS).collect() if not r["within"]]
    assert {r["metric"] for r in wrong} == set(COLUMNS)


def test_a_summary_is_of_bounded_size(facts):
    summary = f"{COLUMNS[0]}_summary"
    small, large = (
        sketches.value_summaries(df, [], COLUMNS[:1]).select(F.length(summary)).first()[0]
        for df in (facts.limit(20_000), facts.union(facts).union(facts))
    )
    assert large < 2 * small < 400_000


def test_small_groups_are_exact(spark):
    rows = [(1, float(v), float(v % 3)) for v in range(999)] + [(2, None, None)]
    totals = spark.createDataFrame(rows, "week_num int, weekly_session_count double, total_playtime_min double")
    found = {r["week_num"]: tuple(r)[1:] for r in norm.summarised_medians(totals).collect()}
    exact = {r["week_num"]: tuple(r)[1:] for r in norm.population_medians(totals).collect()}
    assert found[1] == exact[1] == (499.0, 1.0)
    assert found[2] == (None, None)


def test_distinct_counts_merge(facts):
    by, keys = ["week_num"], ["key", "part"]
    parts = sketches.key_summaries(facts, [*by, "part"], keys)
    found = sketches.distinct_counts(parts, by, keys)
    rows = sketches.count_errors(facts, found, by, keys).collect()
    assert len(rows) == 6 and all(r["within"] for r in rows)
    wrong = sketches.count_errors(facts, found.withColumn("n_key", F.col("n_key") * 2), by, keys).collect()
    assert {(r["week_num"], r["key"]) for r in wrong if not r["within"]} == {(1, "key"), (2, "key")}


def test_exact_extent_multiplies_no_row_of_the_facts(spark, facts):
    df = profile.extent(facts.withColumn("t", F.col("total_playtime_min")), "t", "key", "part")
    plan = df._jdf.queryExecution().executedPlan().toString()
    expand = plan.index("Expand")
    # Below the expansion the facts have been merged into combinations of the keys.
    assert "HashAggregate(keys=[key" in plan[expand:]
    row = df.first()
    assert (row["n_rows"], row["n_key"], row["n_part"]) == (N, facts.select("key").distinct().count(), 6)
    assert (row["first_time"], row["last_time"]) == (0, 19)
    empty = profile.extent(facts.limit(0), "part", "key", "week_num").first()
    assert tuple(empty) == (None, None, 0, 0, 0)
