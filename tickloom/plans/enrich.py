"""Enriched bars: resampling, volatility and event tags in one plan."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame

from ..operators.bars import bars_per_window, resample
from ..operators.features import DEFAULTS, EventThresholds, bar_events, realized_volatility

log = logging.getLogger(__name__)
VOLATILITY_WINDOWS = ("1m", "5m")


def enriched_bars(trades: DataFrame, timeframe: str, limits: EventThresholds = DEFAULTS) -> DataFrame:
    """Bars with the realized volatility of each window that they divide, and event tags.

    Two shuffles: partial aggregates by series and interval, and bars by series.
    """
    bars = resample(trades, timeframe)
    for window in VOLATILITY_WINDOWS:
        n = bars_per_window(timeframe, window)
        if n is None:
            log.info("no realized_vol_%s: %s bars do not divide it", window, timeframe)
        else:
            bars = realized_volatility(bars, n, f"realized_vol_{window}")
    return bar_events(bars, limits)
