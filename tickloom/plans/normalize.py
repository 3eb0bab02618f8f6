"""From raw archives to clean trades and depth, with unified symbols."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.symbols import unify_symbol
from ..operators.trades import clean_trades
from ..sources import raw


def archive_trades(spark: SparkSession, path: str, symbol: str, market: str = "spot", data_type: str = "trades") -> DataFrame:
    return clean_trades(raw.archive_trades(spark, path, unify_symbol(symbol, "binance"), market, data_type))


def execution_trades(spark: SparkSession, path: str, symbol: str, market: str = "linear") -> DataFrame:
    return clean_trades(raw.execution_trades(spark, path, unify_symbol(symbol, "bybit"), market))


def page_trades(spark: SparkSession, folder: str, pair: str) -> DataFrame:
    return clean_trades(raw.page_trades(spark, folder, unify_symbol(pair, "kraken")))


def archive_depth(spark: SparkSession, path: str, symbol: str) -> DataFrame:
    return raw.archive_depth(spark, path, unify_symbol(symbol, "binance"))
