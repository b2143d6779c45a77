"""Windows on session times in every encoding that files store them in."""

from __future__ import annotations

import contextlib
import datetime as dt
import io

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from fixture import BASE_SESSIONS, SESSION, tables
from pyspark.sql import functions as F

from ebbtide import WindowConfig
from ebbtide.functions import exprs as X
from ebbtide.plans import jobs
from ebbtide.plans.weekly import weekly_features
from ebbtide.sources.tables import FILES, read_tables, utc_instant, without_zone

CFG = WindowConfig()
NAMES = [field.split()[0] for field in SESSION.split(", ")]
STORED = {
    "nanoseconds": (pa.timestamp("ns"), {}),
    "zoned nanoseconds": (pa.timestamp("ns", "UTC"), {}),
    "zoned microseconds": (pa.timestamp("us", "UTC"), {}),
    "zoned milliseconds": (pa.timestamp("ms", "UTC"), {}),
    "microseconds": (pa.timestamp("us"), {}),
    "int96": (pa.timestamp("ns"), {"use_deprecated_int96_timestamps": True}),
}
# Sessions at the very edges of the windows.
EDGES = [
    ("x1", "B", "g1", dt.datetime(2024, 1, 29), dt.datetime(2024, 1, 29, 1)),
    ("x2", "B", "g1", dt.datetime(2024, 1, 28, 23, 59, 59, 999000), dt.datetime(2024, 1, 29, 2)),
    ("x3", "B", "g2", dt.datetime(2024, 2, 25, 23, 59, 59, 999000), dt.datetime(2024, 2, 26, 1)),
    ("x4", "B", "g2", dt.datetime(2024, 2, 26), dt.datetime(2024, 2, 26, 1)),
]
ROWS = [*BASE_SESSIONS, *[(*e, *BASE_SESSIONS[0][5:]) for e in EDGES]]


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(spark, request):
    settings = {"spark.sql.session.timeZone": request.param, "spark.sql.legacy.parquet.nanosAsLong": "true"}
    saved = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in saved.items():
        spark.conf.set(k, v)


@pytest.fixture(params=STORED)
def raw(spark, request, tmp_path):
    kind, options = STORED[request.param]
    columns = dict(zip(NAMES, zip(*ROWS, strict=True), strict=True))
    table = pa.table({n: pa.array(v, kind if n in ("start_time", "end_time") else None) for n, v in columns.items()})
    pq.write_table(table, tmp_path / f"{FILES['sessions']}.parquet", **options)
    for name, df in tables(spark).named().items():
        if name != "sessions":
            df.write.parquet(str(tmp_path / f"{FILES[name]}.parquet"))
    return request.param, read_tables(spark, str(tmp_path))


def scan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return next(line for line in out.getvalue().splitlines() if "PushedFilters" in line)


def test_the_window_is_pushed_in_the_stored_encoding(zone, raw):
    stored, source = raw
    pushed = scan(source.sessions_between(CFG.observation))
    assert "GreaterThanOrEqual(start_time," in pushed and "LessThan(start_time," in pushed
    if "nano" in stored:
        start = int(dt.datetime(2024, 1, 29, tzinfo=dt.UTC).timestamp()) * 10**9
        assert f"GreaterThanOrEqual(start_time,{start})" in pushed
    # On the computed wall time nothing but the null check could be pushed.
    late = scan(source.sessions.filter(X.ts_within("start_time", CFG.observation)))
    assert ("GreaterThanOrEqual" in late) == (stored == "microseconds")


def test_wall_times_and_instants(spark, zone):
    for wall in ("2024-03-10 02:30:00.000001", "1969-12-31 23:59:59.999999", "0001-01-01 00:00:00", "2024-11-03 01:30:59.5"):
        df = spark.sql(f"select timestamp_ntz'{wall}' as t")
        instant = df.withColumn("t", utc_instant("t"))
        assert without_zone(instant, "t").first() == df.first()
        assert instant.filter(F.col("t") == F.lit(f"{wall} UTC").cast("timestamp")).count() == 1


def test_rows_and_features_are_those_of_the_wall_time(spark, zone, raw):
    stored, source = raw
    for window in (CFG.baseline, CFG.observation, CFG.prediction, (dt.date(1600, 1, 1), dt.date(2400, 1, 1))):
        found = source.sessions_between(window)
        expected = source.sessions.filter(X.ts_within("start_time", window))
        assert found.schema == expected.schema
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
        assert {r["session_id"] for r in found.collect()} == {r[0] for r in ROWS if window[0] <= r[3].date() < window[1]}
    if zone == "UTC" or stored not in ("nanoseconds", "zoned microseconds"):
        return
    plain = tables(spark, sessions=ROWS[len(BASE_SESSIONS) :])
    features = [sorted(map(str, weekly_features(t, CFG).collect())) for t in (source, plain)]
    assert features[0] == features[1]


def rows_scanned(spark, df) -> int:
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        read = df.agg(F.max("start_time"))
        read.collect()
        return read._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("stored", [pa.timestamp("us", "UTC"), pa.timestamp("ms", "UTC"), pa.timestamp("us"), pa.timestamp("ns")], ids=str)
def test_row_groups_outside_the_window_are_skipped(spark, zone, tmp_path, stored):
    """Of files in order of time, a day reads a few row groups. Spark prunes by instants in
    micro- and milliseconds; the job that arranges the sessions writes the others so."""
    start = int(dt.datetime(2024, 1, 1, tzinfo=dt.UTC).timestamp() * 10**6)
    times = pa.array([start + i * 60 * 10**6 for i in range(50_000)], pa.timestamp("us")).cast(stored)
    columns = {n: times if n in ("start_time", "end_time") else pa.array(["x"] * len(times)) for n in NAMES}
    pq.write_table(pa.table(columns), tmp_path / f"{FILES['sessions']}.parquet", row_group_size=1000)
    source = read_tables(spark, str(tmp_path))
    day = (dt.date(2024, 1, 10), dt.date(2024, 1, 11))
    assert source.sessions_between(day).count() == 24 * 60
    if stored in (pa.timestamp("ns"), pa.timestamp("us")):
        assert rows_scanned(spark, source.sessions_between(day)) == len(times)
        spark.conf.set("spark.sql.files.maxRecordsPerFile", "1000")
        try:
            jobs.arrange(source, str(tmp_path / "arranged"))
        finally:
            spark.conf.unset("spark.sql.files.maxRecordsPerFile")
        source = read_tables(spark, str(tmp_path / "arranged"))
        assert source.sessions_between(day).count() == 24 * 60
    assert rows_scanned(spark, source.sessions_between(day)) <= 3000
