"""Live bars with Structured Streaming."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator, Sequence
from math import log, sqrt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import from_micros
from ..schemas import BAR_KEY, SERIES, TIMEFRAMES, TRADE_KEY, width_of
from ..session import ship
from ..sources.lake import Lake


def with_event_time(trades: DataFrame, late: str = "2 minutes") -> DataFrame:
    """Trades with event_time, of which those more than ``late`` behind may be dropped."""
    return trades.withColumn("event_time", F.timestamp_micros("timestamp_utc")).withWatermark("event_time", late)


def distinct_trades(trades: DataFrame, late: str = "2 minutes", key: Sequence[str] = TRADE_KEY) -> DataFrame:
    """The first of each key within the watermark."""
    return with_event_time(trades, late).dropDuplicatesWithinWatermark(list(key))


def live_bars(trades: DataFrame, timeframe: str, late: str = "2 minutes") -> DataFrame:
    """Bars of a stream of trades, each once its interval is behind the watermark (append mode)."""
    width_of(timeframe)
    stream = trades if "event_time" in trades.columns else with_event_time(trades, late)
    order = F.struct("timestamp_utc", "trade_id")
    side = lambda s: F.coalesce(F.sum(F.when(F.col("side") == s, F.col("quantity"))), F.lit(0.0))
    width = f"{TIMEFRAMES[timeframe] // 1_000_000} seconds"
    bars = stream.groupBy(F.window("event_time", width).alias("w"), *SERIES).agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"),
        F.sum("quantity").alias("volume_base"), F.sum("quote_quantity").alias("volume_quote"), F.count(F.lit(1)).alias("trade_count"),
        side("buy").alias("buy_volume_base"), side("sell").alias("sell_volume_base"), F.sum(F.col("price") * F.col("quantity")).alias("turnover"),
    )
    return bars.select(
        *SERIES, F.lit(timeframe).alias("timeframe"), from_micros(F.unix_micros("w.start")).alias("bar_timestamp_utc"),
        "open", "high", "low", "close", "volume_base", "volume_quote", "trade_count", "buy_volume_base", "sell_volume_base",
        (F.col("buy_volume_base") - F.col("sell_volume_base")).alias("volume_delta"), F.try_divide("turnover", "volume_base").alias("vwap"),
    )


def rolling_volatility(bars: DataFrame, window_bars: int) -> DataFrame:
    """exchange, symbol, bar_timestamp_utc, close and realized_vol of a stream of bars.

    Streams have no row windows; the state of a series is its last closes.
    Bars of one series must come in the order of time over the batches.
    """

    ship(bars.sparkSession)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        closes = deque(state.get[0] if state.exists else [], maxlen=window_bars + 1)
        rows = pd.concat(list(frames)).sort_values("bar_timestamp_utc")
        out = []
        for close in rows["close"]:
            closes.append(float(close))
            r2 = [(log(b) - log(a)) ** 2 for a, b in zip(closes, list(closes)[1:], strict=False)]
            out.append(sqrt(sum(r2)) if r2 else None)
        state.update((list(closes),))
        yield pd.DataFrame({"exchange": key[0], "symbol": key[1], "bar_timestamp_utc": rows["bar_timestamp_utc"].to_numpy(), "close": rows["close"].to_numpy(), "realized_vol": pd.array(out, "Float64")})

    schema = "exchange string, symbol string, bar_timestamp_utc timestamp_ntz, close double, realized_vol double"
    return bars.groupBy(*SERIES).applyInPandasWithState(step, schema, "closes array<double>", "append", "NoTimeout")


def into_lake(lake: Lake, table: str = "bars", time: str = "bar_timestamp_utc", key: Sequence[str] = BAR_KEY) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: merges each batch by key, so that a repeated batch changes nothing."""
    return lambda batch, batch_id: lake.write(batch, table, time, merge_key=key) and None
