"""Bars, features, books and quality on tiny tables with results worked out by hand."""

from __future__ import annotations

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickloom.functions.numeric import ieee_div
from tickloom.functions.symbols import unified_symbol, unify_symbol
from tickloom.functions.times import bucket_start, from_micros, micros_of
from tickloom.operators import asof, bars, book, features, quality, trades
from tickloom.plans.enrich import enriched_bars
from tickloom.schemas import BARS, TRADES

B = 1_704_067_200_000_000
T = datetime(2024, 1, 1)


def make_trades(spark, rows):
    """rows: (symbol, us, id, price, quantity, side)."""
    full = [("binance", "spot", s, t, i, p, q, None if p is None or q is None else p * q, side, False) for s, t, i, p, q, side in rows]
    return spark.createDataFrame(full, TRADES)


def make_series(spark, **columns):
    n = len(next(iter(columns.values())))
    rows = [("x", "A-B", i, *[float(c[i]) for c in columns.values()]) for i in range(n)]
    return spark.createDataFrame(rows, "exchange string, symbol string, n int, " + ", ".join(f"{c} double" for c in columns))


def values(df, column, order="n"):
    return [r[0] for r in df.orderBy(order).select(column).collect()]


@pytest.mark.parametrize(("bar", "window", "n"), [("1s", "1m", 60), ("1s", "5m", 300), ("1m", "5m", 5), ("1m", "1m", 1), ("5m", "1m", None)])
def test_bars_per_window(bar, window, n):
    assert bars.bars_per_window(bar, window) == n


def test_one_bar(spark):
    t = make_trades(spark, [("BTC-USDT", B, "1", 100.0, 1.0, "buy"), ("BTC-USDT", B + 500_000, "2", 110.0, 2.0, "sell"), ("BTC-USDT", B + 900_000, "3", 105.0, 1.0, "buy")])
    out = bars.resample(t, "1s")
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in BARS]
    (r,) = out.collect()
    assert (r.open, r.high, r.low, r.close, r.volume_base, r.volume_quote, r.trade_count) == (100, 110, 100, 105, 4, 425, 3)
    assert (r.buy_volume_base, r.sell_volume_base, r.volume_delta, r.vwap) == (2, 2, 0, 425 / 4)
    assert r.bar_timestamp_utc == T and r.timeframe == "1s"


def test_bars_of_several_series_and_ties(spark):
    t = make_trades(spark, [("BTC-USDT", B, "9", 1.0, 1.0, "buy"), ("BTC-USDT", B, "10", 2.0, 1.0, "buy"), ("BTC-USDT", B + 1_000_000, "1", 3.0, 1.0, "buy"), ("ETH-USDT", B, "1", 4.0, 1.0, "buy"), ("OLD", -1, "1", 5.0, 1.0, "buy")])
    rows = {(r.symbol, r.bar_timestamp_utc): r for r in bars.resample(t, "1s").collect()}
    assert len(rows) == 4
    first = rows["BTC-USDT", T]
    assert (first.open, first.close) == (2.0, 1.0)  # ids compare as text
    assert ("OLD", datetime(1969, 12, 31, 23, 59, 59)) in rows
    with pytest.raises(ValueError, match="timeframe"):
        bars.resample(t, "2h")
    assert bars.resample(t.limit(0), "1m").count() == 0


def test_extra_keys_keep_markets_apart(spark):
    t = make_trades(spark, [("BTC-USDT", B, "1", 1.0, 1.0, "buy")])
    both = t.unionByName(t.withColumn("market_type", F.lit("linear_perpetual")))
    assert bars.resample(both, "1m").count() == 1
    assert bars.resample(both, "1m", ("market_type",)).count() == 2


def test_realized_volatility(spark):
    flat = features.realized_volatility(make_series(spark, close=[100, 100, 100]), 3, "vol", order="n")
    assert values(flat, "vol") == [None, 0.0, 0.0]
    up = features.realized_volatility(make_series(spark, close=[100, 110]), 2, "vol", order="n")
    assert values(up, "vol")[1] == pytest.approx(math.log(1.1))
    with pytest.raises(ValueError):
        features.realized_volatility(flat, 0, "x", order="n")


def test_flash_moves(spark):
    out = features.flash_moves(make_series(spark, close=[100, 101, 200]), features.EventThresholds(flash_move_pct=5), order="n")
    assert values(out, "is_flash_move") == [False, False, True]


def test_volume_surges(spark):
    limits = features.EventThresholds(volume_surge_window_bars=5)
    out = features.volume_surges(make_series(spark, volume_base=[10, 11, 9, 10, 10, 500]), limits, order="n")
    assert values(out, "is_volume_surge") == [False] * 5 + [True]
    assert values(out, "volume_zscore")[:2] == [None, None]


@pytest.mark.parametrize(("last", "score", "tag"), [(11, math.inf, True), (9, -math.inf, False), (10, math.nan, True)])
def test_flat_window(spark, last, score, tag):
    out = features.volume_surges(make_series(spark, volume_base=[10, 10, 10, last]), order="n")
    got = values(out, "volume_zscore")[-1]
    assert got == score or math.isnan(got) and math.isnan(score)
    assert values(out, "is_volume_surge")[-1] is tag


def test_dry_ups_keep_null(spark):
    df = spark.createDataFrame([(5.0,), (80.0,), (None,)], "spread_bps double")
    assert [r[1] for r in features.liquidity_dry_ups(df).collect()] == [False, True, None]


def test_book_metrics_wide_and_nested(spark):
    wide = spark.createDataFrame([(100.0, 1.0, 99.0, 10.0, 100.2, 1.0, 102.0, 10.0)], "bid_price_1 double, bid_size_1 double, bid_price_2 double, bid_size_2 double, ask_price_1 double, ask_size_1 double, ask_price_2 double, ask_size_2 double")
    r = book.book_metrics(wide).first()
    assert r.mid_price == pytest.approx(100.1) and r.spread == pytest.approx(0.2)
    assert r.bid_depth_usd_1pct == 100 and r.ask_depth_usd_2pct > r.ask_depth_usd_1pct
    level = lambda s, i: F.struct(F.col(f"{s}_price_{i}").alias("price"), F.col(f"{s}_size_{i}").alias("size"))
    nested = wide.select(F.array(level("bid", 1), level("bid", 2)).alias("bids"), F.array(level("ask", 1), level("ask", 2)).alias("asks"))
    n = book.nested_book_metrics(nested).first()
    for c in ("mid_price", "spread_bps", "bid_depth_usd_1pct", "ask_depth_usd_1pct", "bid_depth_usd_2pct", "ask_depth_usd_2pct"):
        assert n[c] == pytest.approx(r[c])


def test_book_with_nulls(spark):
    df = spark.createDataFrame([(100.0, None, 101.0, 2.0)], "bid_price_1 double, bid_size_1 double, ask_price_1 double, ask_size_1 double")
    r = book.book_metrics(df).first()
    assert (r.bid_depth_usd_1pct, r.ask_depth_usd_1pct) == (0.0, 202.0)


def test_pivot(spark):
    rows = [("binance", "BTC-USDT", B, p, 1.0, n) for p, n in ((-1, 50000.0), (-2, 95000.0), (1, 75500.0), (2, 124000.0))] + [("binance", "BTC-USDT", B + 1, 5, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "exchange string, symbol string, timestamp_utc long, percentage long, depth double, notional double")
    for unique in (True, False):
        a, b = book.pivot_depth(df, unique=unique).orderBy("timestamp_utc").collect()
        assert (a.bid_depth_usd_1pct, a.bid_depth_usd_2pct, a.ask_depth_usd_1pct, a.ask_depth_usd_2pct) == (50000, 95000, 75500, 124000)
        assert b.bid_depth_usd_1pct is None
    twice = df.unionByName(df.where("percentage = 1"))
    assert book.pivot_depth(twice).count() == 2 and book.pivot_depth(twice, unique=False).count() == 3


def test_crossed(spark):
    assert book.crossed_books(spark.createDataFrame([(0.1,), (-0.2,), (0.0,)], "spread double")).count() == 1


def minute_bars(spark, *minutes):
    return spark.createDataFrame([("x", "A-B", "1m", datetime(2024, 1, 1, 0, m)) for m in minutes], "exchange string, symbol string, timeframe string, bar_timestamp_utc timestamp_ntz")


def test_gaps(spark):
    assert [r.missing_bar_utc for r in quality.bar_gaps(minute_bars(spark, 0, 2), "1m").collect()] == [datetime(2024, 1, 1, 0, 1)]
    assert quality.bar_gaps(minute_bars(spark, 0, 1, 2), "1m").count() == 0
    assert [r.missing_bars for r in quality.gap_counts(minute_bars(spark, 0, 2, 6)).collect()] == [4]
    assert [r.missing_bars for r in quality.gap_counts(minute_bars(spark, 3)).collect()] == [0]
    with pytest.raises(ValueError):
        quality.bar_gaps(minute_bars(spark, 0), "7m")


def test_anomalies_and_cleaning(spark):
    t = make_trades(spark, [("A", 1, "a", 100.0, 1.0, "buy"), ("A", 2, "b", -5.0, 1.0, "buy"), ("A", 3, "c", 0.0, 1.0, "buy"), ("A", None, "d", 100.0, 1.0, "buy"), ("A", 5, None, 100.0, 1.0, "buy"), ("A", 9, "a", 101.0, 1.0, "buy")])
    assert trades.price_anomalies(t).count() == 3
    (r,) = trades.clean_trades(t).collect()
    assert (r.trade_id, r.timestamp_utc) == ("a", 1)
    text = t.select(*[F.col(c).cast("string").alias(c) for c in t.columns]).withColumn("price", F.lit("n/a"))
    assert trades.clean_trades(text).count() == 0


def test_merge_keeps_new(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 1.0)], "k int, v string, only_old double")
    new = spark.createDataFrame([(2, "c", 5)], "k int, v string, only_new int")
    rows = {r.k: r.asDict() for r in trades.merge_rows(old, new, ["k"]).collect()}
    assert rows == {1: {"k": 1, "v": "a", "only_old": 1.0, "only_new": None}, 2: {"k": 2, "v": "c", "only_old": None, "only_new": 5}}


def test_asof(spark):
    left = spark.createDataFrame([("k", 5, "x"), ("k", 1, "y"), ("l", 9, "z")], "k string, at int, name string")
    right = spark.createDataFrame([("k", 2, 1.0), ("k", 5, 2.0), ("k", 6, 3.0)], "k string, at int, q double")
    assert {(r.name, r.q) for r in asof.asof_join(left, right, ["k"], "at", ["q"]).collect()} == {("x", 2.0), ("y", None), ("z", None)}


@pytest.mark.parametrize(("a", "b", "out"), [(1.0, 0.0, math.inf), (-1.0, 0.0, -math.inf), (0.0, 0.0, math.nan), (1.0, 4.0, 0.25), (None, 0.0, None), (1.0, None, None)])
def test_ieee_division(spark, a, b, out):
    got = spark.createDataFrame([(a, b)], "a double, b double").select(ieee_div(F.col("a"), F.col("b"))).first()[0]
    assert got == out or math.isnan(got) and math.isnan(out)


@pytest.mark.parametrize(("raw", "exchange", "out"), [("BTCUSDT", "binance", "BTC-USDT"), ("ETHUSD", "bybit", "ETH-USD"), ("XXBTZUSD", "kraken", "BTC-USD"), ("XBTUSD", "kraken", "BTC-USD"), ("XETHZUSD", "kraken", "ETH-USD"), ("DOTUSD", "binance", "DO-TUSD"), ("btc/usd", "x", "BTC-USD"), ("A/B/C", "x", "A-B-C"), ("USDT", "binance", "USDT"), ("FDUSD", "x", "FD-USD"), ("XXBT-ZUSD", "kraken", "BTC-ZUSD"), ("QQQ", "x", "QQQ")])
def test_symbols(spark, raw, exchange, out):
    assert unify_symbol(raw, exchange) == out
    assert spark.createDataFrame([(raw, exchange)], "r string, e string").select(unified_symbol(F.col("r"), F.col("e"))).first()[0] == out


def test_times(spark):
    r = spark.sql("SELECT -1L AS us").select(bucket_start(F.col("us"), 1_000_000), from_micros(F.col("us"))).first()
    assert r[0] == -1_000_000 and r[1] == datetime(1969, 12, 31, 23, 59, 59, 999999)
    with pytest.raises(ValueError):
        micros_of(T)


def test_enriched_plan_has_two_shuffles(spark):
    t = make_trades(spark, [("A", B + i * 1_000_000, str(i), 1.0 + i, 1.0, "buy") for i in range(5)])
    df = enriched_bars(t, "1s")
    assert {"realized_vol_1m", "realized_vol_5m", "is_flash_move", "is_volume_surge"} <= set(df.columns)
    assert "realized_vol_1m" not in enriched_bars(t, "5m").columns
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
