"""Shape of the physical plans."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from ebbtide.operators import gaps, sessions
from ebbtide.queries.base import Inputs
from ebbtide.queries.registry import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def final_plan(df) -> str:
    """The plan after adaptive execution, where reused exchanges show."""
    df.collect()
    return plan(df)


def test_no_python_and_no_cartesian_product(spark):
    for name in ("weekly_features", "flat_dataset", "sequence_matrix", "split_union", "dq_cross_format"):
        text = plan(QUERIES[name].run(spark, SF))
        for operator in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
            assert operator not in text, (name, operator)


def test_window_filter_is_pushed(spark):
    text = plan(QUERIES["filter_obs_window"].run(spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-13" in text and "LessThan(ts,2024-01-25" in text


def test_pruned_scan(spark):
    text = plan(QUERIES["churn_labels"].run(spark, SF))
    schemas = [line for line in text.splitlines() if "ReadSchema" in line and "ts:" in line]
    assert schemas and all("value" not in s and "props" not in s for s in schemas)


def test_weekly_totals_combine_before_the_shuffle(spark):
    text = plan(sessions.weekly_totals(Inputs(spark, SF).obs))
    assert text.count("Exchange") >= 1
    assert "partial_sum" in text


def scans(df) -> int:
    """Scans of the fact table in the plan before adaptive execution, reused ones once."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"FileScan parquet [^\n]*events\.parquet", text))


def test_gaps_take_one_large_shuffle_and_a_sample(spark, static_shuffle_plans):
    df = gaps.session_regularity(Inputs(spark, SF).obs)
    assert scans(df) == 2
    # The sessions move by slice; what moves by user-week is one row per slice, and, of a
    # sample of bounded size, the cuts.
    assert shuffles(df) == ["user_id, week_num", "user_id, week_num, slice"] or len(shuffles(df)) <= 3, shuffles(df)
    assert "TakeOrderedAndProject" in plan(df)


def test_weekly_features_scan_the_sessions_six_times(spark, static_shuffle_plans):
    """Profile, gaps and their sample, games, medians, and the baseline window."""
    assert scans(QUERIES["weekly_features"].run(spark, SF)) <= 6


def test_late_period_is_pushed(spark):
    text = plan(QUERIES["pivot_late_exit_by_persona"].run(spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-22" in text


def shuffles(df) -> list[str]:
    """Keys of each hash shuffle."""
    found = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", df._jdf.queryExecution().executedPlan().toString())
    return [re.sub(r"#\d+L?", "", keys) for keys in found]


@pytest.fixture
def static_shuffle_plans(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    saved = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in saved.items():
        spark.conf.set(k, v)


def test_weekly_parts_join_without_a_shuffle(spark, static_shuffle_plans):
    found = shuffles(QUERIES["weekly_features"].run(spark, SF))
    # By (user, week): profile; slices of the gaps; games, genres; and the totals behind
    # the medians, whose further uses are reused exchanges.
    assert found.count("user_id, week_num") <= 8, found
    # By user: the merged weeks, baseline, users, subscriptions, payments.
    assert found.count("user_id") == 5, found


def test_flat_dataset_adds_only_the_labels(spark, static_shuffle_plans):
    """The users of a week table are in place already when it is folded to users."""
    weekly = shuffles(QUERIES["weekly_features"].run(spark, SF))
    flat = shuffles(QUERIES["flat_dataset"].run(spark, SF))
    # The label table shuffles users and active users; the join reuses the aggregate's order.
    assert flat.count("user_id") == weekly.count("user_id") + 3, flat
    assert flat.count("user_id, week_num") == weekly.count("user_id, week_num")
