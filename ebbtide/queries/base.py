"""A registered query: the Spark form, its SQL twin and their common columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ebbtide.operators import diversity, flat, labels, scaffold, sequence, split
from ebbtide.plans.weekly import weekly_features
from ebbtide.queries import oracle
from ebbtide.sources import adapter
from ebbtide.sources.tables import Tables

# Sums of doubles differ in their last bits with the order of addition, so both
# sides round them by the same arithmetic. An offset just above one half keeps
# decimal ties such as 0.0505625 from falling to either side.
SCALE = {"d": 1e6, "m": 1e2}
HALF = 0.501
CASTS = {"i": "bigint", "s": "string"}


class Inputs:
    """Tables of one scale and the derived frames that queries start from."""

    cfg = adapter.TEST_WINDOWS

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def tables(self) -> Tables:
        return adapter.load(self.spark, self.sf_dir)

    @cached_property
    def obs(self) -> DataFrame:
        return scaffold.observe(self.tables.sessions, self.cfg)

    @cached_property
    def played(self) -> DataFrame:
        return diversity.game_weeks(self.obs, self.cfg)

    @cached_property
    def weekly(self) -> DataFrame:
        return weekly_features(self.tables, self.cfg)

    @cached_property
    def labels(self) -> DataFrame:
        return labels.churn_labels(self.tables.users, self.tables.sessions, self.cfg)

    @cached_property
    def split(self) -> DataFrame:
        return split.stratified_split(self.labels)

    @cached_property
    def flat(self) -> DataFrame:
        return flat.flat_dataset(self.weekly, self.labels, self.cfg)

    @cached_property
    def sequence(self) -> DataFrame:
        return sequence.sequence_dataset(self.weekly, self.labels)


@dataclass(frozen=True)
class Query:
    """``columns`` names the output: ``c`` as is, ``c:d`` a double to round, ``c:m`` a
    sum of money, ``c:i`` a long, ``c:s`` a date or timestamp as text."""

    name: str
    columns: str
    build: Callable[[Inputs], DataFrame]
    sql: str | None = None
    steps: tuple[str, ...] = ()

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.on(Inputs(spark, sf_dir))

    def on(self, inputs: Inputs) -> DataFrame:
        df = self.build(inputs)
        cells = []
        for name, kind in self._columns():
            if kind in SCALE:
                scale = f"{SCALE[kind]:.0f}D"
                cells.append(f"floor(double({name}) * {scale} + {HALF}D) / {scale} as {name}")
            else:
                cells.append(f"{CASTS[kind]}({name}) as {name}" if kind else name)
        return df.selectExpr(*cells)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        cells = []
        for name, kind in self._columns():
            if kind in SCALE:
                scale = f"{SCALE[kind]}::DOUBLE"
                cells.append(f"floor(CAST({name} AS DOUBLE) * {scale} + {HALF}::DOUBLE) / {scale} AS {name}")
            elif kind == "i":
                cells.append(f"CAST({name} AS BIGINT) AS {name}")
            elif kind == "s":
                cells.append(f"CAST({name} AS VARCHAR) AS {name}")
            else:
                cells.append(name)
        return oracle.with_steps(f"SELECT {', '.join(cells)} FROM (\n{self.sql}\n)", *self.steps)

    def _columns(self) -> list[tuple[str, str]]:
        return [tuple((c + ":").split(":")[:2]) for c in self.columns.split()]
