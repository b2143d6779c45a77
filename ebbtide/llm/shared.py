"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ebbtide.sources.sinks import ensure_checkpoint_dir
from ebbtide.sources.versions import Folder

ROW = "doc"
BATCH_ROWS = 2_000  # rows of whole texts that a Python worker holds at a time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Folders of the tables that are stored while a result is computed, innermost last.
_HELD: ContextVar[list[str] | None] = ContextVar("_HELD", default=None)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors share."""
    folder = f"{ensure_checkpoint_dir(spark)}/ebbtide-{uuid.uuid4().hex}"
    if (held := _HELD.get()) is not None:
        held.append(folder)
    return f"{folder}/{name}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files: the lineage
    ends there and a lost executor takes none of the rows along."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def finished(spark: SparkSession, name: str, compute: Callable[[], DataFrame]) -> tuple[DataFrame, list[str]]:
    """Store what ``compute`` returns, then delete the tables that were stored on the way.
    The result, and the folder it lies in, for whoever reads it last to delete."""
    held, kept = [], []
    outer = _HELD.set(held)
    try:
        df = compute()
        _HELD.set(kept)
        return staged(df, name), kept
    finally:
        _HELD.reset(outer)
        if (before := _HELD.get()) is not None:
            before += kept
        discard(spark, held)


def discard(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        Folder(spark, folder).delete(folder)


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that no name can clash with a result."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns]).alias(ROW)


def unpacked(df: DataFrame, *more: str) -> DataFrame:
    """The columns inside the struct again, then the named result columns."""
    fields = df.schema[ROW].dataType.names
    return df.select(*[F.col(ROW)[f].alias(f) for f in fields], *more)


def small_batches(spark: SparkSession) -> None:
    """Send whole texts to Python workers in batches that fit beside an executor's heap."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task. What it has freed goes back to the system at the
    end, as a Python worker waits for its next task beside the heap of the executor."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # a C library without it
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


Texts = list[bytes | None]


def map_texts(
    df: DataFrame,
    text: Column,
    start: Callable[[], Callable[[Texts], list[list]]],
    fields: T.StructType,
    row: Column | None = None,
) -> DataFrame:
    """One row per row of ``df``: ``row`` (all columns unless given) and what the function
    from ``start()`` makes of the whole text, a list of values for each of ``fields``.

    ``start`` runs once a task. Texts arrive as UTF-8 bytes, so that bytes which are
    no valid UTF-8 don't end the task; null stays ``None``.
    """
    small_batches(df.sparkSession)
    packed_row = (packed(df) if row is None else row).alias(ROW)
    source = df.select(packed_row, text.cast("binary").alias("text"))
    schema = T.StructType([source.schema[ROW], *fields])
    kinds = [to_arrow_type(f.dataType) for f in fields]
    names = [ROW, *fields.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            made = work(batch.column(1).to_pylist())
            cells = [pa.array(v, k) for v, k in zip(made, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cells], names)

    return source.mapInArrow(tidy(run), schema)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone, whatever the language."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
