"""Labels, flat and sequence datasets and their common split."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ebbtide.config import SplitConfig, WindowConfig
from ebbtide.operators import flat, labels, sequence, split

Stage = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Datasets:
    """Both forms carry the split of each user."""

    labels: DataFrame
    split: DataFrame
    flat: DataFrame
    sequence: DataFrame


def build_datasets(
    weekly: DataFrame,
    users: DataFrame,
    sessions: DataFrame,
    cfg: WindowConfig = WindowConfig(),
    split_cfg: SplitConfig = SplitConfig(),
    stage: Stage | None = None,
) -> Datasets:
    """The split covers the users of the weekly table.

    ``stage`` stores the labels and the split, which every other part reads.
    """
    label = labels.churn_labels(users, sessions, cfg)
    if stage:
        label = stage(label, "labels")
    parts = split.stratified_split(label, split_cfg, universe=weekly)
    if stage:
        parts = stage(parts, "split")
    return Datasets(
        labels=label,
        split=parts,
        flat=split.tagged(flat.flat_dataset(weekly, label, cfg), parts),
        sequence=split.tagged(sequence.sequence_dataset(weekly, label), parts),
    )
