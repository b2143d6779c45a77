"""Jobs end to end over files, sources and sinks."""

from __future__ import annotations

import re
import shutil

import pytest
from fixture import tables
from pyspark.sql import functions as F

from ebbtide import WindowConfig, schema
from ebbtide.operators import audit, checks
from ebbtide.plans import jobs
from ebbtide.plans.weekly import weekly_features
from ebbtide.sources import sinks
from ebbtide.sources.tables import FILES, read_parquet, read_tables, without_zone
from ebbtide.sources.versions import Versions

CFG = WindowConfig()


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("job")
    for name, df in tables(spark).named().items():
        sinks.write_table(df, f"{root}/raw/{FILES[name]}.parquet")
    raw = read_tables(spark, f"{root}/raw")
    out = f"{root}/out"
    jobs.features(raw, out)
    report = {r["split"]: r for r in jobs.dataset(raw, out).collect()}
    return raw, out, report


def test_features_job(spark, folders):
    raw, out, _ = folders
    written = stored(spark, out, jobs.WEEKLY)
    assert written.columns == ["user_id", "week_num", *schema.names()]
    direct = weekly_features(tables(spark), CFG)
    assert sorted(map(str, written.collect())) == sorted(map(str, direct.collect()))


def test_dataset_job(spark, folders):
    _, out, report = folders
    assert (report["all"]["users"], report["all"]["churned"]) == (3, 2)
    flat = stored(spark, out, jobs.FLAT)
    matrix = stored(spark, out, jobs.SEQUENCE)
    assert len(flat.columns) == 45
    # One class of one user and one of two: everyone but one lands in test.
    split = {r["user_id"]: r["split"] for r in stored(spark, out, jobs.SPLIT).collect()}
    assert {r["user_id"]: r["split"] for r in flat.select("user_id", "split").collect()} == split
    assert {r["user_id"]: r["split"] for r in matrix.select("user_id", "split").collect()} == split
    assert sorted(split.values()) == ["test", "test", "train"]
    names = stored(spark, out, jobs.SEQUENCE_NAMES).first()["feature_names"]
    assert names == schema.names()


def test_one_folder_per_split(spark, folders):
    _, out, _ = folders
    only_test = spark.read.parquet(f"{Versions(spark, out).path(jobs.FLAT)}/split=test")
    assert only_test.count() == 2 and "split" not in only_test.columns


def test_jobs_overwrite(spark, folders):
    raw, out, _ = folders
    before = stored(spark, out, jobs.WEEKLY).count()
    jobs.features(raw, out)
    assert stored(spark, out, jobs.WEEKLY).count() == before


def test_validate_job(folders):
    raw, out, _ = folders
    verdicts = {r["check_name"]: r["passed"] for r in jobs.validate(raw, out).collect()}
    # Three users cannot be stratified; all structural checks hold.
    for name in ("stratification", "label_signal", "group_order", "segment_decay", "segment_stability", "churn_rate_limits"):
        verdicts.pop(name)
    assert len(verdicts) >= 19 and all(verdicts.values()), verdicts


def test_validate_job_emits_every_check(folders):
    raw, out, _ = folders
    names = [r["check_name"] for r in jobs.validate(raw, out).collect()]
    assert set(names) == set(
        """row_count unique_key uniform_weeks never_null wow_first_week nulls_match_zero_weeks bounded
        non_negative norm_median group_order segment_decay segment_stability split_disjoint sequence_split_disjoint split_exhaustive
        cross_format sequence_shape sequence_no_null stratification label_match leakage sequence_names
        flat_rows label_domain churn_rate_limits label_signal split_schema""".split()
    )


def stored(spark, out, name):
    return Versions(spark, out).read(name)[0]


def broken_weekly(weekly):
    return weekly.union(weekly.limit(2)).filter("not (user_id = 'B' and week_num = 3)")


def verdicts(df) -> dict:
    return {r["check_name"]: (r["n_checked"], r["n_violations"], r["passed"]) for r in df.collect()}


def test_one_pass_over_the_weekly_table_equals_the_single_checks(spark, folders):
    raw, out, _ = folders
    weekly = stored(spark, out, jobs.WEEKLY)
    for df in (weekly, broken_weekly(weekly), weekly.limit(0)):
        once = verdicts(audit.weekly_checks(df, raw.users, CFG))
        single = checks.row_count(df, raw.users, CFG).union(checks.unique_key(df)).union(checks.weekly_rows(df))
        for name, expected in verdicts(single).items():
            assert once[name] == expected
        assert once["uniform_weeks"][1:] == verdicts(checks.uniform_weeks(df, CFG))["uniform_weeks"][1:]
        for name, rows in (("group_order", checks.group_order(df, raw.users)), ("segment_decay", checks.segment_decay(df, raw.users, CFG)),
                           ("segment_stability", checks.segment_stability(df, raw.users, CFG))):
            passed = [r["passed"] for r in rows.collect()]
            assert once[name] == (len(passed), passed.count(False), all(passed))


def test_means_of_one_pass_equal_the_join(spark, folders):
    """Also with a user that the user table lists twice, under two personas."""
    raw, out, _ = folders
    weekly = broken_weekly(stored(spark, out, jobs.WEEKLY))
    users = raw.users.union(raw.users.limit(1).withColumn("persona", F.lit("regular")))
    means = [checks.Mean("weekly_session_count", p, w) for p in audit.PERSONAS for w in (None, 1, 3)]
    means += [checks.Mean("avg_latency", "hardcore"), checks.Mean("longest_inactive_days", "casual", 4)]
    once = audit.weekly_totals(weekly, users, means, CFG).select([m.name for m in means]).first()
    assert once == checks.segment_means(weekly, users, means).first()


def dataset_tables(spark, out):
    return [stored(spark, out, name) for name in (jobs.FLAT, jobs.SEQUENCE, jobs.SEQUENCE_NAMES, jobs.SPLIT)]


def test_one_pass_over_the_datasets_equals_the_single_checks(spark, folders):
    raw, out, _ = folders
    flat, matrix, names, parts = dataset_tables(spark, out)
    other = {"test": "train", "train": "val"}
    moved = flat.replace(other, subset=["split"]).withColumn("churn", F.lit(2))
    holed = matrix.withColumn("X", F.when(F.col("user_id") == "B", F.slice("X", 1, 3)).otherwise(F.col("X")))
    leaked = flat.withColumn("persona", F.lit("x"))
    cases = [
        (flat, matrix, names, parts),
        (moved, holed, names, parts.union(parts.limit(1))),
        (flat.union(flat.withColumn("split", F.lit("val"))), matrix.filter("user_id != 'A'"), names, parts.filter("user_id != 'C'")),
        (leaked, matrix, names.select(F.array_append("feature_names", F.lit("persona")).alias("feature_names")), parts),
        (flat.limit(0), matrix.limit(0), names, parts.limit(0)),
    ]
    for f, m, n, p in cases:
        once = verdicts(audit.dataset_report(f, m, n, p, raw.users, CFG))
        single = [
            checks.split_disjoint(f), checks.split_exhaustive(p, raw.users), checks.cross_format(f, m), checks.sequence_cells(m, CFG),
            checks.stratification(p), checks.leakage(f.drop("split"), n), checks.sequence_names(n), checks.flat_rows(f, raw.users),
            checks.label_domain(f), checks.churn_rate_limits(f.select("user_id", "churn"), raw.users),
            checks.label_signal_check(f.filter("split = 'train'")),
        ]
        for df in single:
            for name, expected in verdicts(df).items():
                assert once[name] == expected, name
        assert once["sequence_split_disjoint"] == verdicts(checks.split_disjoint(m))["split_disjoint"]
        assert once["label_match"][2] == verdicts(checks.label_match(f, m))["label_match"][2]


def test_validate_reads_each_table_once(spark, folders):
    """The weekly table once for all checks, besides what the medians read of it."""
    raw, out, _ = folders
    weekly = stored(spark, out, jobs.WEEKLY)

    def scans(df, name: str) -> int:
        return len(re.findall(rf"FileScan parquet [^\n]*/{name}", df._jdf.queryExecution().executedPlan().toString()))

    with sinks.settings(spark, spark__sql__maxMetadataStringLength="2000"):
        report, medians = jobs.validate(raw, out), checks.norm_median(weekly)
        assert scans(report, jobs.WEEKLY) - scans(medians, jobs.WEEKLY) == 1
        for name in (jobs.FLAT, jobs.SEQUENCE, jobs.SEQUENCE_NAMES, jobs.SPLIT):
            assert scans(report, name) == 1, name
        assert scans(report, "users.parquet") == 2


def test_writing_the_weekly_table_leaves_its_row_checks(spark, folders):
    _, out, _ = folders
    left = verdicts(stored(spark, out, jobs.WEEKLY_CHECKS))
    assert left == verdicts(checks.weekly_rows(stored(spark, out, jobs.WEEKLY)))
    empty, watch = audit.observed(stored(spark, out, jobs.WEEKLY).limit(0))
    empty.collect()
    assert all(v == (0, 0, True) for v in verdicts(audit.observed_verdicts(empty, watch)).values())


def test_a_planted_leak_is_found(spark, folders):
    _, out, _ = folders
    flat = stored(spark, out, jobs.FLAT).drop("split")
    kept = stored(spark, out, jobs.SEQUENCE_NAMES)
    planted = kept.select(F.array_append("feature_names", F.lit("persona")).alias("feature_names"))
    verdict = lambda df: df.first()["passed"]
    assert verdict(checks.leakage(flat, kept)) and verdict(checks.sequence_names(kept))
    assert not verdict(checks.leakage(flat, planted)) and not verdict(checks.sequence_names(planted))
    assert not verdict(checks.leakage(flat.withColumn("persona", F.lit("x")), kept))


def test_a_column_that_one_split_has_besides_is_found(spark, folders, tmp_path):
    """Also in one of several files of a split, and a changed type."""
    raw, out, _ = folders
    flat, matrix = (stored(spark, out, name) for name in (jobs.FLAT, jobs.SEQUENCE))
    columns = {}
    for form, df in (("flat", flat), ("sequence", matrix)):
        sinks.write_table(df, str(tmp_path / form), "split")
        columns[form] = checks.schema_rows(spark, form, str(tmp_path / form))
    good = spark.createDataFrame([*columns["flat"], *columns["sequence"]], checks.SCHEMA_ROW)
    n = 2 * (len(flat.columns) - 1 + len(matrix.columns) - 1)
    assert verdicts(checks.split_schema(good)) == {"split_schema": (n, 0, True)}
    only_train = flat.filter("split = 'train'").drop("split")
    only_train.withColumn("more", F.lit(1)).write.mode("append").parquet(str(tmp_path / "flat" / "split=train"))
    rows = checks.schema_rows(spark, "flat", str(tmp_path / "flat"))
    assert verdicts(checks.split_schema(spark.createDataFrame(rows, checks.SCHEMA_ROW)))["split_schema"][1:] == (1, False)
    matrix.filter("split = 'train'").drop("split").withColumn("churn", F.col("churn").cast("string")).write.mode("overwrite").parquet(
        str(tmp_path / "sequence" / "split=train")
    )
    rows = checks.schema_rows(spark, "sequence", str(tmp_path / "sequence"))
    assert verdicts(checks.split_schema(spark.createDataFrame(rows, checks.SCHEMA_ROW)))["split_schema"][1:] == (2, False)


def test_a_planted_column_fails_the_validate_job(spark, folders, tmp_path):
    raw, out, _ = folders
    copy = shutil.copytree(out, tmp_path / "out")
    path = Versions(spark, str(copy)).path(jobs.FLAT)
    extra = spark.read.parquet(f"{path}/split=train").withColumn("persona", F.lit("x"))
    extra.write.mode("append").parquet(f"{path}/split=train")
    assert not verdicts(jobs.validate(raw, str(copy)))["split_schema"][2]


def test_declared_and_stored_schemas(spark, folders, tmp_path):
    raw, out, _ = folders
    for name, df in raw.named().items():
        sinks.write_table(df, f"{tmp_path}/{FILES[name]}.parquet")
    assert jobs.inspect(spark, str(tmp_path)).collect() == []
    games = raw.games.drop("genre").withColumn("more", F.lit(1)).withColumn("publisher", F.lit(7))
    sinks.write_table(games, f"{tmp_path}/{FILES['games']}.parquet")
    found = [tuple(r) for r in jobs.inspect(spark, str(tmp_path)).collect()]
    assert found == [("games", "genre", None, "string"), ("games", "publisher", "int", "string"), ("games", "more", "int", None)]


def test_no_staging_is_left(spark, folders):
    import os

    _, out, _ = folders
    assert not [name for name in os.listdir(out) if name.startswith("_staging")]


def test_arranged_sessions_give_the_same_features(spark, folders, tmp_path):
    raw, out, _ = folders
    jobs.arrange(raw, str(tmp_path))
    stored = read_parquet(spark, f"{tmp_path}/{FILES['sessions']}.parquet")
    assert stored.schema["start_time"].dataType.simpleString() == "timestamp"
    again = without_zone(stored, "start_time", "end_time")
    assert sorted(map(str, again.collect())) == sorted(map(str, raw.sessions.collect()))


def test_column_pruned_read(spark, folders, tmp_path_factory):
    raw, out, _ = folders
    df = read_parquet(spark, Versions(spark, out).path(jobs.WEEKLY), ["user_id", "week_num"])
    assert df.columns == ["user_id", "week_num"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("stored", ["timestamp", "timestamp_ntz", "nanoseconds"])
def test_timestamps_lose_their_zone(spark, stored, zone):
    saved = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for wall in ("2024-01-29 10:00:00.123456", "1969-12-31 23:59:59.999999"):
            df = spark.sql(f"select timestamp_ntz'{wall}' as t")
            if stored != "timestamp_ntz":
                instant = F.lit(f"{wall} UTC").cast("timestamp")
                df = df.select((instant if stored == "timestamp" else F.unix_micros(instant) * 1000 + 789).alias("t"))
            got = without_zone(df, "t")
            assert got.schema["t"].dataType.simpleString() == "timestamp_ntz"
            assert str(got.first()["t"]) == wall
    finally:
        spark.conf.set("spark.sql.session.timeZone", saved)


def test_time_ordered_write_prunes(spark, tmp_path):
    df = spark.range(20000).select(
        "id", (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("t")
    )
    sinks.write_time_ordered(df.repartition(8, "id"), str(tmp_path / "t"), "t")
    files = spark.read.parquet(str(tmp_path / "t")).groupBy(F.input_file_name()).agg(F.min("t").alias("a"), F.max("t").alias("b"))
    spans = sorted((r["a"], r["b"]) for r in files.collect())
    assert all(left[1] < right[0] for left, right in zip(spans, spans[1:]))


def test_checkpoint_folder_is_the_session_s(spark):
    assert sinks.ensure_checkpoint_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_command_line(spark, folders, tmp_path, capsys):
    raw, _, _ = folders
    for name, df in raw.named().items():
        sinks.write_table(df, f"{tmp_path}/raw/{FILES[name]}.parquet")
    raw_dir, arranged, out = (f"{tmp_path}/{n}" for n in ("raw", "arranged", "out"))
    # The session of the tests keeps its own settings.
    with sinks.settings(spark, **{k: spark.conf.get(k.replace("__", ".")) for k in SESSION_SETTINGS}):
        jobs.main(["inspect", raw_dir, out])
        jobs.main(["arrange", raw_dir, arranged, "--buckets", "4"])
        jobs.main(["features", raw_dir, out, "--arranged", arranged])
        jobs.main(["features", raw_dir, out, "--period", "2", "--period", "-1"])
        jobs.main(["overview", raw_dir, out])
        jobs.main(["dataset", raw_dir, out])
        jobs.main(["validate", raw_dir, out])
    said = capsys.readouterr().out
    assert "start_time" in said and "n_game_id" in said and "split_schema" in said
    assert rounded(stored(spark, out, jobs.WEEKLY)) == rounded(stored(spark, folders[1], jobs.WEEKLY))


SESSION_SETTINGS = [
    name.replace(".", "__")
    for name in ("spark.sql.requireAllClusterKeysForCoPartition", "spark.sql.legacy.parquet.nanosAsLong", "spark.sql.parquet.outputTimestampType")
]


def rounded(df) -> list:
    return sorted(str([f"{v:.9g}" if isinstance(v, float) else v for v in r]) for r in df.collect())
