"""Publications of an output folder, and reruns of single periods."""

from __future__ import annotations

import os
import shutil

import pytest
from fixture import BASE_SESSIONS, SESSION, session_row, tables
from pyspark.sql import functions as F

from ebbtide import WindowConfig
from ebbtide.operators import audit
from ebbtide.plans import jobs, periods
from ebbtide.plans.weekly import weekly_features
from ebbtide.sources import sinks
from ebbtide.sources.tables import Tables
from ebbtide.sources.versions import MANIFESTS, Overtaken, Versions

CFG = WindowConfig()
# Late sessions: of a new user and of an old one, in week 3; and one of the baseline.
LATE = [
    session_row("l1", "A", "g2", "2024-02-13 10:00:00", "2024-02-13 10:30:00"),
    session_row("l2", "A", "g1", "2024-02-13 12:00:00", "2024-02-13 12:45:00"),
    session_row("l3", "C", "g2", "2024-02-14 20:00:00", "2024-02-14 21:00:00", "crash"),
]
LATE_BASELINE = [session_row("l4", "A", "g1", "2024-01-05 10:00:00", "2024-01-05 10:30:00")]
# Moved out of week 2, which has no session then.
MOVED = [r for r in BASE_SESSIONS if r[0] != "s3"]


def with_sessions(spark, rows) -> Tables:
    base = tables(spark)
    return Tables.of(**{**base.named(), "sessions": spark.createDataFrame(rows, SESSION)})


def rows(df) -> list[str]:
    return sorted(map(str, df.collect()))


def folders(store: Versions, table: str) -> dict[str, str]:
    return {name: path for name, path in store.current.items() if name.startswith(f"{table}/")}


def test_periods_of_the_windows():
    assert periods.all_periods(CFG) == [-3, -2, -1, 0, 1, 2, 3, 4]
    days = [day for p in periods.all_periods(CFG) for day in CFG.period(p)]
    assert days[0] == CFG.data_start and days[-1] == CFG.obs_end and days[1:-1:2] == days[2::2]
    assert CFG.period(1)[0] == CFG.obs_start
    with pytest.raises(ValueError, match="no period"):
        CFG.period(5)


def test_the_kept_sums_give_the_weekly_table(spark, tmp_path):
    for n, sessions in enumerate(([*BASE_SESSIONS, *LATE], [])):
        source = with_sessions(spark, sessions)
        assert rows(jobs.features(source, str(tmp_path / str(n)))) == rows(weekly_features(source, CFG))


@pytest.fixture(scope="module")
def first_run(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("first")
    jobs.features(tables(spark), str(out))
    return out


@pytest.fixture
def out(first_run, tmp_path):
    """A copy of the first run; manifests name folders relative to theirs."""
    return str(shutil.copytree(first_run, tmp_path / "out"))


@pytest.mark.parametrize(
    ("changed", "only"),
    [([*BASE_SESSIONS, *LATE], [3]), ([*MOVED, *LATE_BASELINE], [2, -3])],
    ids=["one week", "a week that became empty, and one of the baseline"],
)
def test_a_rerun_of_some_periods_equals_a_full_run(spark, out, changed, only):
    store = Versions(spark, out)
    before = {name: folders(store, name) for name in (periods.ACTIVITY, periods.PLAYED, periods.BASELINE, periods.SUMMARY)}
    source = with_sessions(spark, changed)
    got = jobs.features(source, out, only=only)
    assert rows(got) == rows(weekly_features(source, CFG))
    for name, parts in before.items():
        own = [p for p in only if name == periods.SUMMARY or (p >= 1) == (name != periods.BASELINE)]
        now = folders(store, name)
        touched = {f"{name}/{p}" for p in own}
        assert {k: v for k, v in now.items() if k not in touched} == {k: v for k, v in parts.items() if k not in touched}
        assert all(now.get(k) != parts.get(k) for k in touched)


def test_a_rerun_reads_the_sessions_of_its_period_alone(spark, out, monkeypatch):
    source = tables(spark)
    asked = []
    whole = Tables.sessions_between
    monkeypatch.setattr(Tables, "sessions_between", lambda self, window: (asked.append(window), whole(self, window))[1])
    with Versions(spark, out).publish() as draft:
        periods.refresh(draft, source, CFG, [2, 3, -1])
        assert set(asked) == {(CFG.period(2)[0], CFG.period(3)[1]), CFG.period(-1)}
        asked.clear()
        weekly = periods.weekly_from_parts(draft, source, CFG)
        plan = weekly._jdf.queryExecution().optimizedPlan().toString()
        assert "start_time" not in plan and "session_id" not in plan


def test_the_overview_needs_no_session(spark, out):
    """Extent, distinct counts and percentiles merge over periods, also after a rerun."""
    jobs.features(with_sessions(spark, [*BASE_SESSIONS, *LATE]), out, only=[3])
    got = jobs.overview(tables(spark), out)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "session_id" not in plan and plan.count("summary") > 0
    row = got.first()
    inside = [r for r in [*BASE_SESSIONS, *LATE] if CFG.data_start <= r[3].date() < CFG.obs_end]
    lengths = sorted((r[4] - r[3]).total_seconds() / 60 for r in inside)
    assert (row["n_rows"], row["first_time"], row["last_time"]) == (len(inside), min(r[3] for r in inside), max(r[3] for r in inside))
    assert (row["n_user_id"], row["n_game_id"]) == (3, 2)
    assert row["p50"] == lengths[(len(lengths) + 1) // 2 - 1] and row["p99"] == lengths[-1]


def test_without_a_first_run_all_periods_are_computed(spark, first_run, tmp_path):
    got = jobs.features(tables(spark), str(tmp_path), only=[2])
    assert rows(got) == rows(Versions(spark, str(first_run)).read(jobs.WEEKLY)[0])


def test_a_failed_run_changes_nothing(spark, out, monkeypatch):
    store = Versions(spark, out)
    before, kept, listed = store.current, rows(store.read(jobs.WEEKLY)[0]), sorted(os.listdir(out))

    def fails(weekly, watch):
        raise RuntimeError("lost")

    monkeypatch.setattr(audit, "observed_verdicts", fails)  # after the parts and the table are written
    with pytest.raises(RuntimeError, match="lost"):
        jobs.features(with_sessions(spark, LATE), out, only=[3])
    assert store.current == before and rows(store.read(jobs.WEEKLY)[0]) == kept
    assert sorted(os.listdir(out)) == listed


def test_a_task_that_fails_while_writing_changes_nothing(spark, tmp_path):
    store = Versions(spark, str(tmp_path))
    with store.publish() as draft:
        draft.write(spark.range(10), "t")
    broken = spark.range(1000).repartition(8).select(F.when(F.col("id") == 77, F.raise_error(F.lit("bad row"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="bad row"), store.publish() as draft:
        draft.write(broken, "t")
    assert store.read("t")[0].count() == 10


def test_both_forms_of_the_dataset_change_together(spark, out, monkeypatch):
    """A failure between the two writes leaves both as they were."""
    source = tables(spark)
    jobs.dataset(source, out)
    store = Versions(spark, out)
    names = jobs.SPLIT, jobs.FLAT, jobs.SEQUENCE
    before = [rows(df) for df in store.read(*names)]
    with store.publish() as draft:  # a new user
        draft.write(store.read(jobs.WEEKLY)[0].filter("user_id = 'B'").withColumn("user_id", F.lit("D")).union(store.read(jobs.WEEKLY)[0]), jobs.WEEKLY)
    source = tables(spark, users=[("D", BASE_SESSIONS[0][3].date(), "free", "regular")])
    real = sinks.write_table

    def fails(df, path, partition_by=None):
        if path.endswith(jobs.SEQUENCE):
            raise OSError("disk full")
        real(df, path, partition_by)

    monkeypatch.setattr("ebbtide.sources.versions.write_table", fails)
    with pytest.raises(OSError, match="disk full"):
        jobs.dataset(source, out)
    assert [rows(df) for df in store.read(*names)] == before
    monkeypatch.undo()
    jobs.dataset(source, out)
    assert all({r["user_id"] for r in df.collect()} == set("ABCD") for df in store.read(*names))


def test_a_reader_keeps_the_version_it_opened(spark, tmp_path):
    store = Versions(spark, str(tmp_path))
    for n in range(3):
        with store.publish() as draft:
            draft.write(spark.range(n + 1), "a")
            if n == 0:
                draft.write(spark.range(7), "b")
        if n == 0:
            opened = store.read("a")[0]
    assert opened.count() == 1 and store.read("a")[0].count() == 3
    store.prune(2)
    assert len(os.listdir(tmp_path / MANIFESTS)) - sum(f.startswith(".") for f in os.listdir(tmp_path / MANIFESTS)) == 2
    # A table that no later publication replaced stays, with the folder it lies in.
    assert store.read("b")[0].count() == 7 and store.read("a")[0].count() == 3
    assert len([f for f in os.listdir(tmp_path) if f.startswith("v-")]) == 3
    with store.publish() as draft:
        draft.write(spark.range(9), "b")
    store.prune(1)
    assert len([f for f in os.listdir(tmp_path) if f.startswith("v-")]) == 2
    assert [df.count() for df in store.read("a", "b")] == [3, 9]


def test_of_two_publications_at_once_one_fails(spark, tmp_path):
    store = Versions(spark, str(tmp_path))
    with pytest.raises(Overtaken), store.publish() as slow:
        with store.publish() as fast:
            fast.write(spark.range(2), "t")
        slow.write(spark.range(5), "t")
    assert store.read("t")[0].count() == 2
    assert len([f for f in os.listdir(tmp_path) if f.startswith("v-")]) == 1
