"""Gaps and summaries of what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import from_micros, to_micros
from ..schemas import SERIES, width_of


def _steps(bars: DataFrame, *keys: str) -> DataFrame:
    """Time of each bar and of the next one of its series, in microseconds."""
    at = to_micros(F.col("bar_timestamp_utc"))
    rows = bars.select(*keys, at.alias("at")).where("at IS NOT NULL")
    return rows.withColumn("next", F.lead("at").over(Window.partitionBy(*keys).orderBy("at")))


def bar_gaps(bars: DataFrame, timeframe: str) -> DataFrame:
    """Each bar missing between the first and the last of its series.

    Only the holes are expanded, not the whole grid, so the work follows the
    bars and the gaps.
    """
    width = width_of(timeframe)
    holes = _steps(bars, *SERIES).where(F.col("next") > F.col("at") + width)
    missing = F.explode(F.sequence(F.col("at") + width, F.col("next") - 1, F.lit(width)))
    return holes.select(*SERIES, missing.alias("us")).select(*SERIES, from_micros(F.col("us")).alias("missing_bar_utc"))


def gap_counts(bars: DataFrame) -> DataFrame:
    """Number of missing bars of every series and timeframe, 0 included; counted, not expanded."""
    keys = (*SERIES, "timeframe")
    width = F.create_map(*[F.lit(x) for pair in _widths() for x in pair])[F.col("timeframe")]
    missing = F.greatest(F.floor((F.col("next") - F.col("at") - 1) / width), F.lit(0))
    return _steps(bars, *keys).groupBy(*keys).agg(F.coalesce(F.sum(missing), F.lit(0)).cast("long").alias("missing_bars"))


def _widths() -> list[tuple[str, int]]:
    from ..schemas import TIMEFRAMES

    return list(TIMEFRAMES.items())


def trade_summary(trades: DataFrame) -> DataFrame:
    """Rows, first and last time, price range and invalid rows of each series."""
    invalid = F.sum(F.when((F.col("price") <= 0) | (F.col("quantity") <= 0), 1).otherwise(0))
    return trades.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("row_count"),
        from_micros(F.min("timestamp_utc")).alias("first_trade_utc"),
        from_micros(F.max("timestamp_utc")).alias("last_trade_utc"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        invalid.alias("invalid_rows"),
    )
