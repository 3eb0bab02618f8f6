"""OHLCV bars from trades."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ieee_div
from ..functions.times import bucket_start, from_micros
from ..schemas import BARS, SERIES, TIMEFRAMES, width_of


def bars_per_window(timeframe: str, window: str) -> int | None:
    """How many bars make up a window; None if it is shorter or not a multiple."""
    bar, whole = TIMEFRAMES[timeframe], TIMEFRAMES[window]
    return whole // bar if whole >= bar and whole % bar == 0 else None


def resample(trades: DataFrame, timeframe: str, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Bars of each series and epoch-aligned interval, labelled by its start.

    Open and close are by (timestamp_utc, trade_id).  One shuffle of partial
    aggregates; a hot interval is combined before it.  ``extra_keys`` (such as
    market_type) keep apart what shares exchange and symbol.
    """
    width = width_of(timeframe)
    order = F.struct("timestamp_utc", "trade_id")
    side = lambda s: F.coalesce(F.sum(F.when(F.col("side") == s, F.col("quantity"))), F.lit(0.0))
    grouped = trades.groupBy(*SERIES, *extra_keys, bucket_start(F.col("timestamp_utc"), width).alias("bucket")).agg(
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.sum("quantity").alias("volume_base"),
        F.sum("quote_quantity").alias("volume_quote"),
        F.count(F.lit(1)).alias("trade_count"),
        side("buy").alias("buy_volume_base"),
        side("sell").alias("sell_volume_base"),
        F.sum(F.col("price") * F.col("quantity")).alias("turnover"),
    )
    return grouped.withColumns(
        {
            "timeframe": F.lit(timeframe),
            "bar_timestamp_utc": from_micros(F.col("bucket")),
            "volume_delta": F.col("buy_volume_base") - F.col("sell_volume_base"),
            "vwap": ieee_div(F.col("turnover"), F.col("volume_base")),
        }
    ).select(*extra_keys, *BARS.fieldNames())
