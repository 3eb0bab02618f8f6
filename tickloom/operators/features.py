"""Features and event tags of bars, by window functions over each series.

All work on one shuffle by series: Spark plans windows of one partitioning and
order together.  Frames count rows, not time, so a gap does not widen them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.numeric import ieee_div, ieee_ln, sum_over
from ..schemas import SERIES


@dataclass(frozen=True)
class EventThresholds:
    """Limits from which bars and books are tagged."""

    flash_move_pct: float = 3.0
    flash_move_window_bars: int = 1
    spread_blowout_bps: float = 50.0
    volume_surge_zscore: float = 3.0
    volume_surge_window_bars: int = 20


DEFAULTS = EventThresholds()


def series_window(bars: DataFrame, order: str = "bar_timestamp_utc") -> WindowSpec:
    """Each series in time; timeframes apart where bars have several."""
    keys = [*SERIES, *(["timeframe"] if "timeframe" in bars.columns else [])]
    return Window.partitionBy(*keys).orderBy(order)


def realized_volatility(bars: DataFrame, window_bars: int, column: str, order: str = "bar_timestamp_utc") -> DataFrame:
    """Root of the summed squared log returns of the last ``window_bars`` bars; null without a return.

    Returns from and to a close of 0 are infinite, and between two of them NaN, as IEEE arithmetic has it.
    """
    if window_bars < 1:
        raise ValueError("window_bars must be at least 1")
    w = series_window(bars, order)
    r = ieee_ln(F.col("close")) - ieee_ln(F.lag("close").over(w))
    bars = bars.withColumn("__r2", r * r)
    return bars.withColumn(column, F.sqrt(sum_over(F.col("__r2"), w.rowsBetween(1 - window_bars, 0)))).drop("__r2")


def flash_moves(bars: DataFrame, limits: EventThresholds = DEFAULTS, order: str = "bar_timestamp_utc") -> DataFrame:
    """price_change_pct over the window, and is_flash_move: its size is above the limit (false without one)."""
    before = F.lag("close", limits.flash_move_window_bars).over(series_window(bars, order))
    bars = bars.withColumn("price_change_pct", (ieee_div(F.col("close"), before) - 1) * 100)
    return bars.withColumn("is_flash_move", F.coalesce(F.abs("price_change_pct") > limits.flash_move_pct, F.lit(False)))


def volume_surges(bars: DataFrame, limits: EventThresholds = DEFAULTS, order: str = "bar_timestamp_utc") -> DataFrame:
    """volume_zscore against the bars before (two at least, sample deviation), and is_volume_surge above the limit.

    After a flat window the score is infinite or NaN, as IEEE division has it;
    NaN counts as above.
    """
    w = series_window(bars, order).rowsBetween(-limits.volume_surge_window_bars, -1)
    bars = bars.withColumns({"__mean": F.avg("volume_base").over(w), "__std": F.stddev_samp("volume_base").over(w)})
    bars = bars.withColumn("volume_zscore", ieee_div(F.col("volume_base") - F.col("__mean"), F.col("__std"))).drop("__mean", "__std")
    return bars.withColumn("is_volume_surge", F.coalesce(F.col("volume_zscore") > limits.volume_surge_zscore, F.lit(False)))


def bar_events(bars: DataFrame, limits: EventThresholds = DEFAULTS, order: str = "bar_timestamp_utc") -> DataFrame:
    """Both tags of bars."""
    return volume_surges(flash_moves(bars, limits, order), limits, order)


def liquidity_dry_ups(book: DataFrame, limits: EventThresholds = DEFAULTS) -> DataFrame:
    """is_liquidity_dry_up: the spread is above the limit; null without one."""
    return book.withColumn("is_liquidity_dry_up", F.col("spread_bps") > limits.spread_blowout_bps)
