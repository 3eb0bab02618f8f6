"""Tables of the engine and the keys that identify their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType


def _table(**columns) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in columns.items()])


TRADES = _table(
    exchange=StringType, market_type=StringType, symbol=StringType, timestamp_utc=LongType, trade_id=StringType,
    price=DoubleType, quantity=DoubleType, quote_quantity=DoubleType, side=StringType, is_liquidation=BooleanType,
)
BOOK_DEPTH = _table(exchange=StringType, symbol=StringType, timestamp_utc=LongType, percentage=LongType, depth=DoubleType, notional=DoubleType)
BARS = _table(
    exchange=StringType, symbol=StringType, timeframe=StringType, bar_timestamp_utc=TimestampNTZType,
    open=DoubleType, high=DoubleType, low=DoubleType, close=DoubleType, volume_base=DoubleType, volume_quote=DoubleType,
    trade_count=LongType, buy_volume_base=DoubleType, sell_volume_base=DoubleType, volume_delta=DoubleType, vwap=DoubleType,
)
GAPS = _table(exchange=StringType, symbol=StringType, missing_bar_utc=TimestampNTZType)

SERIES = ("exchange", "symbol")
TRADE_KEY = ("exchange", "symbol", "trade_id")
BAR_KEY = ("exchange", "symbol", "timeframe", "bar_timestamp_utc")
DEPTH_KEY = ("exchange", "symbol", "timestamp_utc", "percentage")
LAKE_KEYS = ("exchange", "symbol", "year", "month")

#: The order of rows at the edge, in flat files and reports: of trades, bars, gaps and books, by the columns they have.
ORDER = ("exchange", "symbol", "timeframe", "timestamp_utc", "bar_timestamp_utc", "missing_bar_utc", "trade_id", "percentage")

#: Width of a bar in microseconds.
TIMEFRAMES = {"1s": 1_000_000, "1m": 60_000_000, "5m": 300_000_000}


def in_order(df: DataFrame) -> DataFrame:
    """Rows in their table's canonical order; for output, since Spark keeps no order between operators."""
    return df.orderBy(*[c for c in ORDER if c in df.columns])


def width_of(timeframe: str) -> int:
    if timeframe not in TIMEFRAMES:
        raise ValueError(f"unsupported timeframe {timeframe!r}; known: {', '.join(TIMEFRAMES)}")
    return TIMEFRAMES[timeframe]
