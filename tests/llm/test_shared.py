from __future__ import annotations

import os

import pytest

from ebbtide.llm import shared as m
from ebbtide.llm.queries import QUERIES


def test_batches_are_bounded_but_never_raised(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    saved = spark.conf.get(name)
    try:
        for before, after in (("10000", m.BATCH_ROWS), ("0", m.BATCH_ROWS), ("500", 500)):
            spark.conf.set(name, before)
            m.small_batches(spark)
            assert int(spark.conf.get(name)) == after
    finally:
        spark.conf.set(name, saved)


def test_staged_tables_lie_in_the_shared_folder(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, text string")
    stored = m.staged(df, "t")
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert all(folder in f for f in stored.inputFiles())
    assert stored.schema == df.schema and sorted(map(tuple, stored.collect()), key=str) == [(1, "a"), (2, None)]


def test_rows_are_packed_whatever_their_names(spark):
    df = spark.createDataFrame([(1, "x", 2)], "id long, `doc` string, `a.b` int")
    assert m.unpacked(df.select(m.packed(df))).collect() == df.collect()


def folders(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return {f for f in os.listdir(root) if f.startswith("ebbtide-")}


def test_tables_stored_on_the_way_are_deleted(spark):
    before = folders(spark)

    def inner():
        return m.staged(spark.range(10), "a").where("id > 2")

    def outer():
        found, _ = m.finished(spark, "inner", inner)
        return m.staged(found, "b").join(found, "id")

    df, kept = m.finished(spark, "outer", outer)
    assert df.count() == 7 and len(folders(spark) - before) == len(kept) == 1
    m.discard(spark, kept)
    assert folders(spark) == before

    def fails():
        m.staged(spark.range(3), "c")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        m.finished(spark, "fails", fails)
    assert folders(spark) == before


def test_queries_leave_only_their_result(spark):
    """Those whose tables on the way are large against their result."""
    before = folders(spark)
    for name in ("op10_ngram_join", "op12_collocations", "op13_hard_negatives"):
        df = QUERIES[name](spark, "/root/testdata/sf0.001")
        assert df.count() > 0 and len(folders(spark) - before) == 1, name
        before = folders(spark)


def test_worker_functions_end_as_they_are(spark):
    def run(batches):
        for batch in batches:
            yield batch
        raise ValueError("after the last batch")

    with pytest.raises(ValueError, match="after the last"):
        list(m.tidy(run)(iter([1, 2])))
    assert spark.range(5).mapInArrow(m.tidy(lambda batches: batches), "id long").count() == 5
