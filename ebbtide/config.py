"""Time layout of the analysis and parameters of the dataset split."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class WindowConfig:
    """Baseline, observation and prediction windows laid end to end.

    All windows are half-open ``[start, end)`` and made of whole periods. The
    default is 4 + 4 + 2 weeks of 7 days; ``period_days`` shortens the period
    for data that covers less time.
    """

    data_start: dt.date = dt.date(2024, 1, 1)
    baseline_periods: int = 4
    obs_periods: int = 4
    pred_periods: int = 2
    period_days: int = 7

    def __post_init__(self) -> None:
        # Active days of one period are kept as bits of one long.
        if not 1 <= self.period_days <= 62:
            raise ValueError("period_days must be between 1 and 62")

    def _after(self, periods: int) -> dt.date:
        return self.data_start + dt.timedelta(days=periods * self.period_days)

    @property
    def obs_start(self) -> dt.date:
        return self._after(self.baseline_periods)

    @property
    def obs_end(self) -> dt.date:
        return self._after(self.baseline_periods + self.obs_periods)

    @property
    def pred_end(self) -> dt.date:
        return self._after(self.baseline_periods + self.obs_periods + self.pred_periods)

    @property
    def first_period(self) -> int:
        """Number of the first baseline period; the observed ones are 1 and up."""
        return 1 - self.baseline_periods

    def period(self, number: int) -> tuple[dt.date, dt.date]:
        """Window of a period, the baseline ones being 0 and below."""
        if not self.first_period <= number <= self.obs_periods:
            raise ValueError(f"no period {number}")
        return self._after(self.baseline_periods + number - 1), self._after(self.baseline_periods + number)

    @property
    def baseline(self) -> tuple[dt.date, dt.date]:
        return self.data_start, self.obs_start

    @property
    def observation(self) -> tuple[dt.date, dt.date]:
        return self.obs_start, self.obs_end

    @property
    def prediction(self) -> tuple[dt.date, dt.date]:
        return self.obs_end, self.pred_end


@dataclass(frozen=True)
class SplitConfig:
    """Shares of the stratified split; what train and val leave goes to test."""

    train: float = 0.70
    val: float = 0.15
    seed: int = 42
    # Hex digits of the hash that name a bucket: 16**digits buckets per class.
    bucket_digits: int = 2
