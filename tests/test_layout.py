"""Sessions by user: no exchange of facts, and equal results."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from fixture import SESSION, session_row, tables
from pyspark.sql import functions as F

from ebbtide import WindowConfig
from ebbtide.operators import diversity, engagement, gaps, scaffold, sessions
from ebbtide.plans import jobs, periods
from ebbtide.plans.weekly import weekly_features
from ebbtide.sources import layout
from ebbtide.sources.sinks import write_table
from ebbtide.sources.tables import FILES, Tables, read_tables

CFG = WindowConfig()
BUCKETS = 8


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """A third of the sessions of one user, some without a user, users of all windows."""
    rows = []
    for i in range(900):
        user = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"u{i % 41}"
        start = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i * 97 % (10 * 7 * 1440))
        rows.append(session_row(f"x{i:04d}", user, f"g{i % 5}", str(start), str(start + dt.timedelta(minutes=i % 90))))
    root = tmp_path_factory.mktemp("layout")
    base = tables(spark).named()
    for name, df in {**base, "sessions": spark.createDataFrame(rows, SESSION)}.items():
        write_table(df, f"{root}/raw/{FILES[name]}.parquet")
    plain = read_tables(spark, f"{root}/raw")
    jobs.arrange(plain, f"{root}/arranged", BUCKETS)
    return root, plain, layout.read_by_user(spark, f"{root}/raw", f"{root}/arranged")


def rows(df) -> list[str]:
    """Doubles without their last digits, which depend on the order of addition."""
    rounded = [[f"{v:.10g}" if isinstance(v, float) else str(v) for v in r] for r in df.collect()]
    return sorted(map(str, rounded))


def test_no_user_is_in_both_tables(spark, folders):
    root, plain, arranged = folders
    assert rows(arranged.sessions) == rows(plain.sessions)
    ordinary, busy = (df.select("user_id").distinct() for df in arranged.session_parts((CFG.data_start, CFG.pred_end)))
    assert {r["user_id"] for r in busy.collect()} == {"hot", None}
    assert ordinary.join(busy, "user_id").count() == 0 and ordinary.filter("user_id is null").count() == 0
    in_bucket = spark.read.parquet(f"{root}/arranged/{layout.BY_USER}{BUCKETS}").groupBy(F.input_file_name()).count()
    assert in_bucket.count() <= BUCKETS
    assert in_bucket.agg(F.max("count")).first()[0] <= 2 * 900 / BUCKETS


def test_equal_results(folders):
    _, plain, arranged = folders
    for window in (CFG.baseline, CFG.observation, CFG.prediction):
        assert rows(arranged.sessions_between(window)) == rows(plain.sessions_between(window))
    assert rows(weekly_features(arranged, CFG)) == rows(weekly_features(plain, CFG))


def test_equal_results_of_the_jobs(folders, tmp_path):
    _, plain, arranged = folders
    got, expected = (jobs.features(t, str(tmp_path / n), CFG) for t, n in ((arranged, "a"), (plain, "b")))
    assert rows(got) == rows(expected)
    assert rows(jobs.overview(arranged, str(tmp_path / "a"))) == rows(jobs.overview(plain, str(tmp_path / "b")))


def exchanges(df) -> list[str]:
    text = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", keys) for keys in re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", text)]


def per_user(obs, past, games) -> dict:
    return {
        "profile": sessions.session_profile(obs, CFG),
        "gaps": gaps.inter_session_gaps(obs),
        "regularity": gaps.session_regularity(obs),
        "games": diversity.game_counts(obs),
        "game weeks": diversity.game_weeks(obs, CFG),
        "activity": periods.activity(obs, CFG),
        "baseline": engagement.user_baseline(past, CFG),
    }


def test_nothing_per_user_exchanges_the_sessions(spark, folders):
    _, plain, arranged = folders
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        # As the session of the jobs has it: tables in buckets by user also join by user and week.
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
    }
    saved = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        made = []
        for source in (arranged, plain):
            obs = scaffold.observe(source.session_parts(CFG.observation)[0], CFG)
            made.append({n: exchanges(df) for n, df in per_user(obs, source.session_parts(CFG.baseline)[0], source.games).items()})
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    by_user, plainly = made
    assert not any(by_user.values()), by_user
    assert all(plainly.values()), plainly


def test_a_catalog_that_has_never_seen_the_table(spark, folders):
    root, plain, arranged = folders
    path = f"{root}/arranged/{layout.BY_USER}{BUCKETS}"
    spark.sql(f"DROP TABLE {layout._name(path)}")  # an external table: the files stay
    again = layout.read_by_user(spark, f"{root}/raw", f"{root}/arranged")
    assert rows(again.sessions) == rows(plain.sessions)
    obs = scaffold.observe(again.session_parts(CFG.observation)[0], CFG)
    assert exchanges(sessions.session_profile(obs, CFG)) == []
    with pytest.raises(FileNotFoundError):
        layout.read_by_user(spark, f"{root}/raw", f"{root}/raw").sessions


def test_no_sessions_at_all(spark, folders, tmp_path):
    root, plain, _ = folders
    empty = Tables.of(**{**plain.named(), "sessions": plain.sessions.limit(0)})
    jobs.arrange(empty, str(tmp_path), 4)
    assert layout.read_by_user(spark, f"{root}/raw", str(tmp_path)).sessions.count() == 0
