"""Data-quality checks.

Every check returns rows ``(check_name, n_checked, n_violations, passed)`` from one
aggregation; nothing is collected.
"""

from __future__ import annotations

import operator
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide import schema
from ebbtide.config import WindowConfig
from ebbtide.functions import exprs as X
from ebbtide.operators.quantiles import exact_quantiles
from ebbtide.schema import KEYS


def verdict(df: DataFrame, name: str | Column, n_checked: Column, n_violations: Column) -> DataFrame:
    n_violations = F.coalesce(n_violations, F.lit(0)).cast("long")
    return df.select(
        (F.lit(name) if isinstance(name, str) else name).alias("check_name"),
        F.coalesce(n_checked, F.lit(0)).cast("long").alias("n_checked"),
        n_violations.alias("n_violations"),
        (n_violations == 0).alias("passed"),
    )


def _total(columns: list[Column]) -> Column:
    return sum(columns[1:], columns[0])


def _outer_counts(**frames: DataFrame) -> DataFrame:
    """Rows per user in each frame, as one aggregation instead of outer joins."""
    parts = [
        df.select("user_id", *[F.lit(int(other == name)).alias(f"n_{other}") for other in frames])
        for name, df in frames.items()
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.groupBy("user_id").agg(*[F.sum(f"n_{name}").alias(f"n_{name}") for name in frames])


# --- weekly table ---------------------------------------------------------------------


def row_count(weekly: DataFrame, users: DataFrame, cfg: WindowConfig) -> DataFrame:
    """Each user of the user table has one row per week and nobody else has any."""
    off = F.count_if(F.col("n_weekly") != F.col("n_users") * cfg.obs_periods)
    sums = _outer_counts(weekly=weekly, users=users).agg(F.sum("n_weekly").alias("n"), off.alias("off"))
    return verdict(sums, "row_count", F.col("n"), F.col("off"))


def unique_key(weekly: DataFrame) -> DataFrame:
    keys = weekly.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    sums = keys.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 1).alias("dup"))
    return verdict(sums, "unique_key", F.col("n"), F.col("dup"))


def uniform_weeks(weekly: DataFrame, cfg: WindowConfig) -> DataFrame:
    weeks = weekly.groupBy("week_num").agg(F.count(F.lit(1)).alias("n"))
    sums = weeks.agg(
        F.count(F.lit(1)).alias("weeks"), (F.max("n") - F.min("n")).alias("spread")
    )
    return verdict(
        sums, "uniform_weeks", F.col("weeks"), F.abs(F.col("weeks") - cfg.obs_periods) + F.col("spread")
    )


def null_inventory(df: DataFrame) -> DataFrame:
    """Nulls per column as rows, from one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    return counts.unpivot("n_rows", df.columns, "column_name", "n_nulls")


def row_checks() -> dict[str, tuple[Column, Column]]:
    """Checks of single rows of the weekly table: name -> (checked, violations) of a row."""
    first = F.col("week_num") == 1
    changed = F.col("session_count_wow_change").isNotNull() | F.col("playtime_wow_change").isNotNull()
    empty = F.col("weekly_session_count") == 0

    def one(holds: Column) -> Column:
        return F.coalesce(holds.cast("int"), F.lit(0))

    def values(columns) -> Column:
        return _total([one(F.col(c).isNotNull()) for c in columns])

    def rows(columns, wrong) -> Column:
        return _total([one(wrong(F.col(c))) for c in columns])

    return {
        "never_null": (F.lit(len(schema.NEVER_NULL)), rows(schema.NEVER_NULL, lambda c: c.isNull())),
        "wow_first_week": (one(first), one(first & changed)),
        # Quality and game features are null in exactly the weeks without sessions.
        "nulls_match_zero_weeks": (one(empty), rows(schema.NULL_IN_ZERO_WEEKS, lambda c: c.isNull() != empty)),
        "bounded": (values(schema.UNIT_INTERVAL), rows(schema.UNIT_INTERVAL, lambda c: ~c.between(0, 1))),
        "non_negative": (values(schema.NON_NEGATIVE), rows(schema.NON_NEGATIVE, lambda c: c < 0)),
    }


def weekly_rows(weekly: DataFrame, *only: str) -> DataFrame:
    """Row checks of the weekly table, all of them (or ``only`` some) in one pass."""
    checks = {name: c for name, c in row_checks().items() if not only or name in only}
    sums = [F.sum(c).alias(f"{name}_{part}") for name, pair in checks.items() for part, c in zip(("n", "bad"), pair)]
    return verdicts(weekly.agg(*sums), list(checks))


def verdicts(sums: DataFrame, names: list[str]) -> DataFrame:
    """Verdicts from one row with columns ``<name>_n`` and ``<name>_bad``."""
    cells = [
        F.struct(F.lit(name).alias("name"), F.col(f"{name}_n").alias("n"), F.col(f"{name}_bad").alias("bad"))
        for name in names
    ]
    return verdict(sums.select(F.inline(F.array(*cells))), F.col("name"), F.col("n"), F.col("bad"))


def value_ranges(weekly: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Minimum and maximum of each column as rows, from one pass."""
    columns = columns or schema.names()
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"{c}_min").alias("min_value"),
                F.col(f"{c}_max").alias("max_value"),
            )
            for c in columns
        ]
    )
    bounds = [f(F.col(c).cast("double")).alias(f"{c}_{n}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return weekly.agg(*bounds).select(F.inline(cells))


def norm_median(weekly: DataFrame, low: float = 0.9, high: float = 1.1) -> DataFrame:
    """Weekly median of the normalised columns over active users is about 1."""
    norms = ["weekly_session_count_norm", "total_playtime_min_norm"]
    medians = exact_quantiles(weekly.filter("weekly_session_count > 0"), ["week_num"], norms, ["0.5"])
    sums = medians.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("value").between(low, high)).alias("bad")
    )
    return verdict(sums, "norm_median", F.col("n"), F.col("bad"))


# --- comparisons between segments -------------------------------------------------------


@dataclass(frozen=True)
class Mean:
    """The mean of a weekly column over a persona, in all weeks or in one."""

    column: str
    persona: str
    week: int | None = None

    @property
    def rows(self) -> str:
        """Its rows as a filter."""
        return f"persona = '{self.persona}'" + (f" and week_num = {self.week}" if self.week else "")

    @property
    def name(self) -> str:
        return f"{self.column}_of_{self.persona}" + (f"_in_{self.week}" if self.week else "")


@dataclass(frozen=True)
class Expectation:
    """``left op right``; the right side may be a fixed value."""

    name: str
    left: Mean
    op: str
    right: Mean | float


_COMPARE = {">": operator.gt, "<": operator.lt}


def _order(column: str, left: str, op: str, right: str) -> Expectation:
    return Expectation(f"{column}: {left} {op} {right}", Mean(column, left), op, Mean(column, right))


def _trend(column: str, left: int, op: str, right: int, who: str = "about_to_churn") -> Expectation:
    return Expectation(f"{column}: week {left} {op} week {right}", Mean(column, who, left), op, Mean(column, who, right))


# The orderings that the data design promises.
GROUP_ORDER = (
    _order("weekly_session_count", "hardcore", ">", "regular"),
    _order("weekly_session_count", "regular", ">", "casual"),
    _order("total_playtime_min", "hardcore", ">", "regular"),
    _order("session_count_vs_baseline", "about_to_churn", "<", "regular"),
    _order("longest_inactive_days", "about_to_churn", ">", "hardcore"),
    _order("unique_games_played", "hardcore", ">", "casual"),
    _order("genre_entropy", "hardcore", ">", "casual"),
    _order("top_game_concentration", "casual", ">", "hardcore"),
    _order("current_tier_numeric", "hardcore", ">", "casual"),
    _order("total_spend_last_4w", "hardcore", ">", "casual"),
    _order("has_downgraded", "about_to_churn", ">", "hardcore"),
)
DECAY = (
    _trend("weekly_session_count_norm", 4, "<", 1),
    _trend("weekly_session_count_norm", 3, "<", 2),
    _trend("longest_inactive_days", 4, ">", 1),
)


def with_persona(weekly: DataFrame, users: DataFrame) -> DataFrame:
    return weekly.join(users.select("user_id", "persona"), "user_id")


def means_of(expectations: Iterable[Expectation]) -> list[Mean]:
    """The means that expectations compare, each once."""
    sides = [side for e in expectations for side in (e.left, e.right) if isinstance(side, Mean)]
    return list(dict.fromkeys(sides))


def decay_of(cfg: WindowConfig) -> tuple[Expectation, ...]:
    """Users about to churn decline from week to week and end below their baseline."""
    last = Mean("playtime_vs_baseline", "about_to_churn", cfg.obs_periods)
    return *DECAY, Expectation(f"playtime_vs_baseline: week {cfg.obs_periods} < 1", last, "<", 1.0)


def stability_means(cfg: WindowConfig, persona: str = "hardcore") -> dict[str, tuple[Mean, Mean]]:
    """Mean activity in the first and in the last week, raw and normalised."""
    columns = {"raw": "weekly_session_count", "norm": "weekly_session_count_norm"}
    return {kind: (Mean(c, persona, 1), Mean(c, persona, cfg.obs_periods)) for kind, c in columns.items()}


def segment_means(weekly: DataFrame, users: DataFrame, means: list[Mean]) -> DataFrame:
    """One row with a column per mean."""
    cells = [F.avg(F.when(F.expr(m.rows), F.col(m.column))).alias(m.name) for m in means]
    return with_persona(weekly, users).agg(*cells)


def _side(side: Mean | float) -> Column:
    return F.col(side.name) if isinstance(side, Mean) else F.lit(side)


def holds(e: Expectation) -> Column:
    """Whether an expectation holds, from a row of means."""
    return F.coalesce(_COMPARE[e.op](_side(e.left), _side(e.right)), F.lit(False))


def judged(means: DataFrame, expectations: Iterable[Expectation]) -> DataFrame:
    """Rows ``(expectation, left_mean, right_mean, passed)`` from the row of means."""
    rows = [
        F.struct(
            F.lit(e.name).alias("expectation"),
            _side(e.left).alias("left_mean"),
            _side(e.right).alias("right_mean"),
            holds(e).alias("passed"),
        )
        for e in expectations
    ]
    return means.select(F.inline(F.array(*rows)))


def group_order(weekly: DataFrame, users: DataFrame, expectations: Iterable[Expectation] = GROUP_ORDER) -> DataFrame:
    """Orderings between the segments of users, all from one aggregation."""
    return judged(segment_means(weekly, users, means_of(expectations)), expectations)


def segment_decay(weekly: DataFrame, users: DataFrame, cfg: WindowConfig) -> DataFrame:
    return group_order(weekly, users, decay_of(cfg))


STABILITY_LIMIT = 0.3


def relative_changes(cfg: WindowConfig, persona: str = "hardcore") -> dict[str, Column]:
    """Relative change from the first to the last week, from a row of means."""
    pairs = stability_means(cfg, persona)
    return {kind: F.abs(X.relative_change(last.name, first.name)) for kind, (first, last) in pairs.items()}


def segment_stability(
    weekly: DataFrame, users: DataFrame, cfg: WindowConfig, persona: str = "hardcore", limit: float = STABILITY_LIMIT
) -> DataFrame:
    """Relative change of the mean activity from the first to the last week."""
    means = [m for pair in stability_means(cfg, persona).values() for m in pair]
    change = relative_changes(cfg, persona)
    return segment_means(weekly, users, list(dict.fromkeys(means))).select(
        F.lit(persona).alias("persona"),
        change["raw"].alias("raw_change"),
        change["norm"].alias("norm_change"),
        F.coalesce(change["norm"] < limit, F.lit(False)).alias("passed"),
    )


# --- datasets and splits ------------------------------------------------------------------


def split_disjoint(tagged: DataFrame) -> DataFrame:
    """No user is in two splits."""
    per_user = tagged.groupBy("user_id").agg((F.min("split") != F.max("split")).alias("overlap"))
    sums = per_user.agg(F.count(F.lit(1)).alias("n"), F.count_if("overlap").alias("bad"))
    return verdict(sums, "split_disjoint", F.col("n"), F.col("bad"))


def split_exhaustive(split: DataFrame, users: DataFrame) -> DataFrame:
    """The splits hold every user once and nobody else."""
    sums = _outer_counts(split=split, users=users).agg(
        F.sum("n_split").alias("n"), F.count_if((F.col("n_split") != 1) | (F.col("n_users") != 1)).alias("bad")
    )
    return verdict(sums, "split_exhaustive", F.col("n"), F.col("bad"))


def cross_format(flat_split: DataFrame, sequence_split: DataFrame) -> DataFrame:
    """A user is in the same split in both dataset forms."""
    both = (
        flat_split.select("user_id", "split", F.lit(1).alias("flat"), F.lit(0).alias("seq"))
        .unionByName(sequence_split.select("user_id", "split", F.lit(0).alias("flat"), F.lit(1).alias("seq")))
        .groupBy("user_id", "split")
        .agg(F.sum("flat").alias("flat"), F.sum("seq").alias("seq"))
    )
    sums = both.agg(F.sum("flat").alias("n"), F.count_if(F.col("flat") != F.col("seq")).alias("bad"))
    return verdict(sums, "cross_format", F.col("n"), F.col("bad"))


def wrong_cells(cfg: WindowConfig) -> dict[str, Column]:
    """Whether a matrix lacks its shape, weeks x features, or has a hole."""
    width = len(schema.names())
    good = (F.size("X") == cfg.obs_periods) & F.forall("X", lambda week: F.size(week) == width)
    hole = F.exists("X", lambda week: F.exists(week, lambda v: v.isNull() | F.isnan(v)))
    return {"sequence_shape": ~good, "sequence_no_null": hole}


def sequence_cells(sequence: DataFrame, cfg: WindowConfig, *only: str) -> DataFrame:
    """Every matrix has weeks x features cells ("shape") and no hole ("no_null")."""
    wrong = {name: c for name, c in wrong_cells(cfg).items() if not only or name in only}
    sums = sequence.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(c).cast("long").alias(name) for name, c in wrong.items()]
    )
    return verdict(sums.unpivot("n", list(wrong), "name", "bad"), F.col("name"), F.col("n"), F.col("bad"))


TOLERANCE = 0.005


def schema_rows(spark: SparkSession, form: str, path: str) -> list[tuple[str, str, int, str, str]]:
    """Form, split, position, name and type of the columns of each ``split=...`` folder, from
    the footers of all its files."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    listed = folder.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(folder)
    splits = sorted(name.removeprefix("split=") for name in (f.getPath().getName() for f in listed) if name.startswith("split="))
    found = []
    for split in splits:
        df = spark.read.option("mergeSchema", "true").parquet(f"{path}/split={split}")
        found += [(form, split, i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)]
    return found


SCHEMA_ROW = "form string, split string, position int, column_name string, data_type string"


def split_schema(columns: DataFrame) -> DataFrame:
    """Every split of a form has the same columns in the same order and types."""
    splits = columns.groupBy("form").agg(F.count_distinct("split").alias("splits"))
    cells = columns.groupBy("form", "position", "column_name", "data_type").agg(F.count(F.lit(1)).alias("n"))
    sums = cells.join(splits, "form").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("n") != F.col("splits"), F.col("n"))).alias("bad")
    )
    return verdict(sums, "split_schema", F.col("n"), F.col("bad"))


def stratification(split: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Churn rates of the splits differ by less than ``tolerance``."""
    rates = split.groupBy("split").agg(F.avg("churn").alias("rate"))
    sums = rates.agg(
        F.count(F.lit(1)).alias("n"), (F.max("rate") - F.min("rate") >= tolerance).cast("int").alias("bad")
    )
    return verdict(sums, "stratification", F.col("n"), F.col("bad"))


def label_match(flat: DataFrame, sequence: DataFrame) -> DataFrame:
    pair = flat.select("user_id", F.col("churn").alias("flat_churn")).join(
        sequence.select("user_id", F.col("churn").alias("sequence_churn")), "user_id", "full_outer"
    )
    differ = ~F.col("flat_churn").eqNullSafe(F.col("sequence_churn"))
    sums = pair.agg(F.count(F.lit(1)).alias("n"), F.count_if(differ).alias("bad"))
    return verdict(sums, "label_match", F.col("n"), F.col("bad"))


def leaked_columns(flat: DataFrame) -> set[str]:
    """Forbidden features among the columns; the user id and label are no features."""
    return (set(flat.columns) - {"user_id", "churn"}) & set(schema.FORBIDDEN_IN_DATASETS)


def name_sums(names: DataFrame) -> DataFrame:
    """One row of counts over the stored lists of feature names."""
    expected = F.array(*map(F.lit, schema.names()))
    forbidden = F.size(F.array_intersect("feature_names", F.array(*map(F.lit, schema.FORBIDDEN_IN_DATASETS))))
    return names.agg(
        F.sum(F.size("feature_names")).alias("stored_names"),
        F.count_if(~F.col("feature_names").eqNullSafe(expected)).alias("wrong_names"),
        F.coalesce(F.sum(F.greatest(forbidden, F.lit(0))), F.lit(0)).alias("forbidden_names"),
    )


def leakage(flat: DataFrame, names: DataFrame) -> DataFrame:
    """Neither form has a forbidden feature.

    ``names`` is the stored list of the sequence features, ``feature_names`` in a row.
    """
    rows = flat.agg(F.count(F.lit(1)).alias("n"), F.lit(len(leaked_columns(flat))).cast("long").alias("bad"))
    stored = name_sums(names).select(F.lit(0).cast("long").alias("n"), F.col("forbidden_names").alias("bad"))
    both = rows.unionByName(stored)
    return verdict(both.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "leakage", F.col("n"), F.col("bad"))


def sequence_names(names: DataFrame) -> DataFrame:
    """The stored list names the features of the data model in their order."""
    return verdict(name_sums(names), "sequence_names", F.col("stored_names"), F.col("wrong_names"))


def flat_rows(flat: DataFrame, users: DataFrame) -> DataFrame:
    """One labelled row per user."""
    per_user = _outer_counts(flat=flat, users=users).agg(
        F.sum("n_flat").alias("n"), F.count_if(F.col("n_flat") != F.col("n_users")).alias("off")
    )
    return verdict(per_user, "flat_rows", F.col("n"), F.col("off"))


def label_domain(labels: DataFrame) -> DataFrame:
    sums = labels.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.coalesce(~F.col("churn").isin(0, 1), F.lit(True))).alias("bad"),
    )
    return verdict(sums, "label_domain", F.col("n"), F.col("bad"))


def churn_rate_by_persona(labels: DataFrame, users: DataFrame) -> DataFrame:
    return (
        labels.join(users.select("user_id", "persona"), "user_id")
        .groupBy("persona")
        .agg(F.sum("churn").alias("churned"), F.count("churn").alias("users"), F.avg("churn").alias("churn_rate"))
    )


# Limits of the churn rate per persona, (low, high) exclusive.
CHURN_LIMITS = {"about_to_churn": (0.5, None), "hardcore": (None, 0.01), "regular": (None, 0.05)}


def outside_limits(persona: str, rate: Column) -> Column:
    low, high = CHURN_LIMITS[persona]
    return rate <= low if low is not None else rate >= high


def churn_rate_limits(labels: DataFrame, users: DataFrame) -> DataFrame:
    outside = F.lit(False)
    for persona in CHURN_LIMITS:
        outside = outside | ((F.col("persona") == persona) & outside_limits(persona, F.col("churn_rate")))
    sums = (
        churn_rate_by_persona(labels, users)
        .filter(F.col("persona").isin(*CHURN_LIMITS))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(outside).alias("bad"))
    )
    return verdict(sums, "churn_rate_limits", F.col("n"), F.col("bad"))


# Columns that should tell churners apart.
SIGNAL_COLUMNS = (
    "weekly_session_count",
    "weekly_session_count_last",
    "total_playtime_min",
    "total_playtime_min_last",
    "playtime_slope",
    "longest_inactive_days_last",
)


def label_signal(flat: DataFrame) -> DataFrame:
    return flat.groupBy("churn").agg(*[F.avg(c).alias(c) for c in SIGNAL_COLUMNS])


SIGNAL_LIMIT = 0.5


def label_signal_check(flat: DataFrame, limit: float = SIGNAL_LIMIT) -> DataFrame:
    """Churners have less than ``limit`` of the others' sessions in the last week."""
    last = F.col("weekly_session_count_last")
    sums = flat.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.when(F.col("churn") == 1, last)).alias("churned"),
        F.avg(F.when(F.col("churn") == 0, last)).alias("stayed"),
    )
    weak = F.coalesce(F.col("churned") >= F.col("stayed") * limit, F.lit(True)).cast("int")
    return verdict(sums, "label_signal", F.col("n"), weak)
