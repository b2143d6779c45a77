"""All checks of a table compiled into one aggregate.

The checks of a table are declared once (``checks``); here their sums become columns of
one chain of aggregates: marks of single rows, rows per key, keys per user, users met with
the user table, totals. A table is read once and shuffled once, by user, whatever the number
of checks, and all verdicts come from the one row of totals.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ebbtide import schema
from ebbtide.config import WindowConfig
from ebbtide.functions import exprs as X
from ebbtide.operators import checks
from ebbtide.schema import KEYS

PERSONAS = "hardcore", "regular", "casual", "about_to_churn"
SPLITS = "train", "val", "test"


def _marks() -> dict[str, Column]:
    """What single rows of the weekly table add to the row checks."""
    pairs = checks.row_checks().items()
    return {f"{name}_{part}": c for name, pair in pairs for part, c in zip(("n", "bad"), pair)}


def _known(users: DataFrame) -> DataFrame:
    """Rows of each user in the user table, by persona."""
    of = [F.count_if(F.col("persona") == p).alias(f"n_{p}") for p in PERSONAS]
    return users.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_users"), *of)


def _or_zero(*names: str) -> dict[str, Column]:
    return {name: F.coalesce(name, F.lit(0)) for name in names}


# --- weekly table -------------------------------------------------------------------------


def weekly_totals(weekly: DataFrame, users: DataFrame, means: list[checks.Mean], cfg: WindowConfig) -> DataFrame:
    """One row: the sums behind the structural and row checks, and the ``means``."""
    marks = _marks()
    columns = list(dict.fromkeys(m.column for m in means))
    weeks = range(1, cfg.obs_periods + 1)
    moments = [(c, k) for c in columns for k in ("sum", "count")]
    by_key = (
        weekly.select(*KEYS, *[c.alias(name) for name, c in marks.items()], *columns)
        .repartition("user_id")
        .groupBy(*KEYS)
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(name).alias(name) for name in marks],
            *[(F.sum if k == "sum" else F.count)(c).alias(f"{c}_{k}") for c, k in moments],
        )
    )

    def in_week(value: str, week: int | None) -> Column:
        return F.col(value) if week is None else F.when(F.col("week_num") == week, F.col(value))

    parts = list(dict.fromkeys((m.column, m.week) for m in means))
    by_user = by_key.groupBy("user_id").agg(
        F.sum("n").alias("n"),
        F.count_if(F.col("n") > 1).alias("repeated"),
        F.count_if(~F.coalesce(F.col("week_num").between(1, cfg.obs_periods), F.lit(False))).alias("strange"),
        *[F.sum(in_week("n", w)).alias(f"week_{w}") for w in weeks],
        *[F.sum(name).alias(name) for name in marks],
        *[F.sum(in_week(f"{c}_{k}", w)).alias(f"{c}_{w}_{k}") for c, w in parts for k in ("sum", "count")],
    )
    both = by_user.join(_known(users), "user_id", "full_outer").withColumns(_or_zero("n", "n_users"))

    def mean(m: checks.Mean) -> Column:
        of = F.col(f"n_{m.persona}")
        total, count = (F.sum(F.col(f"{m.column}_{m.week}_{k}") * of) for k in ("sum", "count"))
        return X.safe_ratio(total, count).alias(m.name)

    return both.agg(
        F.sum("n").alias("rows"),
        F.count_if(F.col("n") != F.col("n_users") * cfg.obs_periods).alias("off"),
        F.sum("repeated").alias("repeated"),
        F.sum("strange").alias("strange"),
        *[F.sum(f"week_{w}").alias(f"week_{w}") for w in weeks],
        *[F.sum(name).alias(name) for name in marks],
        *map(mean, means),
    )


def _segment_verdicts(cfg: WindowConfig) -> dict[str, Column]:
    """Number of broken expectations by check, from a row of means."""
    broken = {
        "group_order": [~checks.holds(e) for e in checks.GROUP_ORDER],
        "segment_decay": [~checks.holds(e) for e in checks.decay_of(cfg)],
        "segment_stability": [~F.coalesce(checks.relative_changes(cfg)["norm"] < checks.STABILITY_LIMIT, F.lit(False))],
    }
    return {
        f"{name}_{part}": c
        for name, wrong in broken.items()
        for part, c in (("n", F.lit(len(wrong))), ("bad", reduce(Column.__add__, [w.cast("long") for w in wrong])))
    }


def weekly_checks(weekly: DataFrame, users: DataFrame, cfg: WindowConfig) -> DataFrame:
    """Structure, row checks and what the segments of users promise, in one pass."""
    expected = [*checks.GROUP_ORDER, *checks.decay_of(cfg)]
    stable = [m for pair in checks.stability_means(cfg).values() for m in pair]
    means = list(dict.fromkeys([*checks.means_of(expected), *stable]))
    sizes = F.array(*[F.coalesce(f"week_{w}", F.lit(0)) for w in range(1, cfg.obs_periods + 1)])
    uneven = F.array_max(sizes) - F.array_min(sizes) + F.coalesce("strange", F.lit(0))
    total = weekly_totals(weekly, users, means, cfg).withColumns(
        {
            "row_count_n": F.col("rows"), "row_count_bad": F.col("off"),
            "unique_key_n": F.col("rows"), "unique_key_bad": F.col("repeated"),
            "uniform_weeks_n": F.lit(cfg.obs_periods), "uniform_weeks_bad": uneven,
            **_segment_verdicts(cfg),
        }
    )
    names = ["row_count", "unique_key", "uniform_weeks", *checks.row_checks(), "group_order", "segment_decay", "segment_stability"]
    return checks.verdicts(total, names)


def weekly_report(weekly: DataFrame, users: DataFrame, cfg: WindowConfig) -> DataFrame:
    """All checks of the weekly table: one pass, and one over two columns for the medians."""
    return weekly_checks(weekly, users, cfg).unionByName(checks.norm_median(weekly))


def observed(weekly: DataFrame) -> tuple[DataFrame, Observation]:
    """The table, and the sums of the row checks that its next action leaves behind."""
    watch = Observation("row checks")
    sums = [F.sum(c).alias(name) for name, c in _marks().items()]
    return weekly.observe(watch, F.count(F.lit(1)).alias("rows"), *sums), watch


def observed_verdicts(weekly: DataFrame, watch: Observation) -> DataFrame:
    """Verdicts of the row checks without another pass over the table."""
    seen = {name: value or 0 for name, value in watch.get.items()}
    row = weekly.sparkSession.range(1).select(*[F.lit(v).cast("long").alias(name) for name, v in seen.items()])
    return checks.verdicts(row, list(checks.row_checks()))


# --- datasets -------------------------------------------------------------------------------


def _in_split(flag: Column | str, split: str) -> Column:
    return F.count_if((F.col("split") == split) & F.col(flag) if isinstance(flag, str) else flag)


def dataset_totals(flat: DataFrame, sequence: DataFrame, split: DataFrame, users: DataFrame, cfg: WindowConfig) -> DataFrame:
    """One row of sums over both dataset forms, the split and the users, met by user."""
    last = F.col("weekly_session_count_last").cast("double")
    wrong = checks.wrong_cells(cfg)
    forms = {
        "flat": flat.select("user_id", "split", "churn", last.alias("last")),
        "sequence": sequence.select("user_id", "split", "churn", *[c.alias(name) for name, c in wrong.items()]),
        "split": split.select("user_id", "split", "churn"),
    }
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [df.withColumn("form", F.lit(name)) for name, df in forms.items()],
    )
    here = {name: F.col("form") == name for name in forms}

    def of(form: str, value: str) -> Column:
        return F.when(here[form], F.col(value))

    train = here["flat"] & (F.col("split") == "train")
    by_user = stacked.groupBy("user_id").agg(
        *[F.count_if(c).alias(f"n_{name}") for name, c in here.items()],
        *[f(of(name, v)).alias(f"{name}_{v}_{k}") for name in ("flat", "sequence") for v in ("split", "churn") for k, f in (("min", F.min), ("max", F.max))],
        *[F.count_if(c & (F.col("split") == s)).alias(f"{name}_in_{s}") for name, c in here.items() for s in SPLITS],
        *[F.sum(F.when(here["split"] & (F.col("split") == s), F.col("churn"))).alias(f"churn_in_{s}") for s in SPLITS],
        *[F.count_if(of("sequence", name)).alias(name) for name in wrong],
        F.count_if(here["flat"] & F.coalesce(~F.col("churn").isin(0, 1), F.lit(True))).alias("strange_labels"),
        F.sum(of("flat", "churn")).alias("churned"),
        F.count(of("flat", "churn")).alias("labelled"),
        *[F.sum(F.when(train & (F.col("churn") == k), F.col("last"))).alias(f"last_{k}") for k in (0, 1)],
        *[F.count(F.when(train & (F.col("churn") == k), F.col("last"))).alias(f"count_{k}") for k in (0, 1)],
        F.count_if(train).alias("n_train"),
    )
    both = by_user.join(_known(users), "user_id", "full_outer")
    both = both.withColumns(_or_zero("n_users", *[f"n_{name}" for name in forms]))
    in_flat, in_sequence = F.col("n_flat") > 0, F.col("n_sequence") > 0
    labels = [F.col(f"{form}_churn_{k}") for form in ("flat", "sequence") for k in ("min", "max")]
    differ = reduce(Column.__or__, [~labels[0].eqNullSafe(c) for c in labels[1:]])
    elsewhere = {form: F.col(f"n_{form}") - sum(F.col(f"{form}_in_{s}") for s in SPLITS) for form in ("flat", "sequence")}
    apart = [(F.col(f"flat_in_{s}") != F.col(f"sequence_in_{s}")).cast("long") for s in SPLITS]
    apart.append((elsewhere["flat"] != elsewhere["sequence"]).cast("long"))
    return both.agg(
        *[F.sum(f"n_{name}").alias(f"n_{name}") for name in forms],
        *[F.count_if(F.col(f"n_{f}") > 0).alias(f"users_{f}") for f in ("flat", "sequence")],
        *[F.count_if(F.col(f"{f}_split_min") != F.col(f"{f}_split_max")).alias(f"overlap_{f}") for f in ("flat", "sequence")],
        F.count_if(((F.col("n_split") > 0) | (F.col("n_users") > 0)) & ((F.col("n_split") != 1) | (F.col("n_users") != 1))).alias("not_split"),
        F.sum(F.when(in_flat | in_sequence, reduce(Column.__add__, apart))).alias("apart"),
        F.count_if(in_flat | in_sequence).alias("either"),
        F.count_if((in_flat | in_sequence) & differ).alias("differ"),
        F.count_if(F.col("n_flat") != F.col("n_users")).alias("flat_off"),
        *[F.sum(name).alias(name) for name in (*wrong, "strange_labels", "n_train", "last_0", "last_1", "count_0", "count_1")],
        *[F.sum(f"split_in_{s}").alias(f"split_in_{s}") for s in SPLITS],
        *[F.sum(f"churn_in_{s}").alias(f"churn_in_{s}") for s in SPLITS],
        *[F.sum(F.col(v) * F.col(f"n_{p}")).alias(f"{v}_{p}") for v in ("churned", "labelled") for p in PERSONAS],
    )


def dataset_report(
    flat: DataFrame, sequence: DataFrame, names: DataFrame, split: DataFrame, users: DataFrame, cfg: WindowConfig
) -> DataFrame:
    """Checks of both dataset forms; ``flat`` and ``sequence`` carry their split, and
    ``names`` is the stored list of sequence features. Each table is read once."""
    rates = [X.safe_ratio(f"churn_in_{s}", f"split_in_{s}") for s in SPLITS]
    spread = F.array_max(F.array(*rates)) - F.array_min(F.array(*rates))
    limits = {p: X.safe_ratio(f"churned_{p}", f"labelled_{p}") for p in checks.CHURN_LIMITS}
    outside = [checks.outside_limits(p, rate).cast("long") for p, rate in limits.items()]
    churned, stayed = (X.safe_ratio(f"last_{k}", f"count_{k}") for k in (1, 0))
    wrong = list(checks.wrong_cells(cfg))
    found = {
        "split_disjoint": ("users_flat", "overlap_flat"),
        "sequence_split_disjoint": ("users_sequence", "overlap_sequence"),
        "split_exhaustive": ("n_split", "not_split"),
        "cross_format": ("n_flat", "apart"),
        **{name: ("n_sequence", name) for name in wrong},
        "stratification": (
            sum(F.coalesce((F.col(f"split_in_{s}") > 0).cast("long"), F.lit(0)) for s in SPLITS),
            F.coalesce(spread >= checks.TOLERANCE, F.lit(False)).cast("long"),
        ),
        "label_match": ("either", "differ"),
        "leakage": ("n_flat", F.lit(len(checks.leaked_columns(flat.drop("split")))) + F.col("forbidden_names")),
        "sequence_names": ("stored_names", "wrong_names"),
        "flat_rows": ("n_flat", "flat_off"),
        "label_domain": ("n_flat", "strange_labels"),
        "churn_rate_limits": (sum(rate.isNotNull().cast("long") for rate in limits.values()), sum(F.coalesce(c, F.lit(0)) for c in outside)),
        "label_signal": ("n_train", F.coalesce(churned >= stayed * checks.SIGNAL_LIMIT, F.lit(True)).cast("long")),
    }
    totals = dataset_totals(flat, sequence, split, users, cfg)
    # Two single rows side by side, by a constant key.
    one = F.lit(0).alias("one")
    totals = totals.select("*", one).join(checks.name_sums(names).select("*", one), "one")
    cells = {
        f"{name}_{part}": F.col(value) if isinstance(value, str) else value
        for name, pair in found.items()
        for part, value in zip(("n", "bad"), pair)
    }
    return checks.verdicts(totals.select(*[c.alias(name) for name, c in cells.items()]), list(found))
