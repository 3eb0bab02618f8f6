"""Order book metrics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ieee_div, total

DEPTH_SHARES = (0.01, 0.02)
DEPTH_ROW = ("exchange", "symbol", "timestamp_utc")


def _quotes(bid: Column, ask: Column) -> dict[str, Column]:
    return {"mid_price": (bid + ask) / 2, "spread": ask - bid}


def _with_spread_bps(df: DataFrame) -> DataFrame:
    return df.withColumn("spread_bps", ieee_div(F.col("spread"), F.col("mid_price")) * 10_000)


def book_metrics(book: DataFrame, levels: int = 20, shares: Sequence[float] = DEPTH_SHARES) -> DataFrame:
    """Mid price, spread and the value of bids and asks within each share of the mid.

    Levels are columns bid_price_i, bid_size_i, ask_price_i, ask_size_i from 1;
    those that are absent, or null in a row, count as nothing.
    """
    out = _with_spread_bps(book.withColumns(_quotes(F.col("bid_price_1"), F.col("ask_price_1"))))
    there = [i for i in range(1, levels + 1)]
    depths = {}
    for p in shares:
        low, high = F.col("mid_price") * (1 - p), F.col("mid_price") * (1 + p)
        value = lambda side, inside, i: F.when(inside, F.col(f"{side}_price_{i}") * F.col(f"{side}_size_{i}"))
        bids = [value("bid", F.col(f"bid_price_{i}") >= low, i) for i in there if f"bid_price_{i}" in book.columns]
        asks = [value("ask", F.col(f"ask_price_{i}") <= high, i) for i in there if f"ask_price_{i}" in book.columns]
        label = f"{int(p * 100)}pct"
        depths |= {f"bid_depth_usd_{label}": total(*bids), f"ask_depth_usd_{label}": total(*asks)}
    return out.withColumns(depths)


def _at_least(low: Column) -> Callable[[Column], Column]:
    return lambda level: level["price"] >= low


def _at_most(high: Column) -> Callable[[Column], Column]:
    return lambda level: level["price"] <= high


def nested_book_metrics(book: DataFrame, shares: Sequence[float] = DEPTH_SHARES) -> DataFrame:
    """The same for books with arrays ``bids`` and ``asks`` of structs of price and size, best first."""
    out = _with_spread_bps(book.withColumns(_quotes(F.get("bids", F.lit(0))["price"], F.get("asks", F.lit(0))["price"])))
    add = lambda sum_, x: sum_ + F.coalesce(x["price"] * x["size"], F.lit(0.0))
    value = lambda side, inside: F.coalesce(F.aggregate(F.filter(side, inside), F.lit(0.0), add), F.lit(0.0))
    depths = {}
    for p in shares:
        low, high, label = F.col("mid_price") * (1 - p), F.col("mid_price") * (1 + p), f"{int(p * 100)}pct"
        depths[f"bid_depth_usd_{label}"] = value("bids", _at_least(low))
        depths[f"ask_depth_usd_{label}"] = value("asks", _at_most(high))
    return out.withColumns(depths)


def pivot_depth(depth: DataFrame, percentages: Sequence[int] = (1, 2), unique: bool = True) -> DataFrame:
    """One row for each book with the notional at minus (bid) and plus (ask) each percentage.

    With one row for each percentage of a book, as the table's key has it, this
    is one aggregation.  ``unique=False`` joins instead, which multiplies rows
    where a percentage repeats.  Books without those percentages have nulls.
    """
    columns = {f"{side}_depth_usd_{p}pct": sign * p for p in percentages for side, sign in (("bid", -1), ("ask", 1))}
    if unique:
        wanted = [F.max(F.when(F.col("percentage") == at, F.col("notional"))).alias(name) for name, at in columns.items()]
        return depth.groupBy(*DEPTH_ROW).agg(*wanted)
    out = depth.select(*DEPTH_ROW).distinct()
    for name, at in columns.items():
        out = out.join(depth.where(F.col("percentage") == at).select(*DEPTH_ROW, F.col("notional").alias(name)), list(DEPTH_ROW), "left")
    return out


def crossed_books(book: DataFrame) -> DataFrame:
    """Books whose best bid is above their best ask."""
    return book.where("spread < 0")
