"""The registered queries of the engine, on ticks made of the ``events`` table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import round_binary
from ..functions.symbols import unified_symbol
from ..functions.times import from_micros, to_micros, year_and_month
from ..operators import asof, bars, book, features, quality, trades
from ..schemas import TRADE_KEY, TRADES, in_order
from ..session import shared_folder
from ..sources.lake import Lake
from .dialect import spark_sql
from .enrich import enriched_bars

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query by its function's name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Doubles that depend on the order of additions, rounded."""
    return df.withColumns({c: round_binary(F.col(c), n) for c, n in digits.items()})


# --- tables made of the driver's -------------------------------------------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades out of events: three exchanges by user, price by value, quantity by id."""
    quantity = (F.col("event_id") % 7 + 1).cast("double")
    at = F.col("user_id") % 3
    columns = {
        "exchange": F.when(at == 0, "binance").when(at == 1, "bybit").otherwise("kraken"), "market_type": F.lit("spot"), "symbol": F.lit("BTC-USDT"),
        "timestamp_utc": to_micros(F.col("ts")), "trade_id": F.col("event_id").cast("string"), "price": F.col("value"), "quantity": quantity,
        "quote_quantity": F.col("value") * quantity, "side": F.when(F.col("user_id") % 2 == 0, "buy").otherwise("sell"), "is_liquidation": F.lit(False),
    }
    return events(spark, sf_dir).select(*[columns[f.name].alias(f.name) for f in TRADES.fields])


TICKS = """ticks AS (
  SELECT CASE user_id % 3 WHEN 0 THEN 'binance' WHEN 1 THEN 'bybit' ELSE 'kraken' END AS exchange, 'spot' AS market_type, 'BTC-USDT' AS symbol,
         epoch_us(ts) AS timestamp_utc, CAST(event_id AS VARCHAR) AS trade_id, value AS price, CAST(1 + event_id % 7 AS DOUBLE) AS quantity,
         value * CAST(1 + event_id % 7 AS DOUBLE) AS quote_quantity, CASE WHEN user_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side, FALSE AS is_liquidation
  FROM events)"""


def bars_cte(us: int, timeframe: str) -> str:
    return f"""bars AS (
  SELECT exchange, symbol, '{timeframe}' AS timeframe, make_timestamp(timestamp_utc - timestamp_utc % {us}) AS bar_timestamp_utc,
         arg_min(price, (timestamp_utc, trade_id)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (timestamp_utc, trade_id)) AS close,
         sum(quantity) AS volume_base, sum(quote_quantity) AS volume_quote, CAST(count(*) AS BIGINT) AS trade_count,
         coalesce(sum(quantity) FILTER (side = 'buy'), 0.0) AS buy_volume_base, coalesce(sum(quantity) FILTER (side = 'sell'), 0.0) AS sell_volume_base,
         coalesce(sum(quantity) FILTER (side = 'buy'), 0.0) - coalesce(sum(quantity) FILTER (side = 'sell'), 0.0) AS volume_delta,
         sum(price * quantity) / sum(quantity) AS vwap
  FROM ticks GROUP BY ALL)"""


B1S, B1M, B5M = bars_cte(1_000_000, "1s"), bars_cte(60_000_000, "1m"), bars_cte(300_000_000, "5m")
SERIES_WINDOW = "(PARTITION BY exchange, symbol ORDER BY bar_timestamp_utc"
#: Rounded columns of bars.
BAR_DIGITS = {"volume_quote": 4, "vwap": 6}
BAR_SELECT = "* REPLACE (round(volume_quote, 4) AS volume_quote, round(vwap, 6) AS vwap)"


# --- trades ------------------------------------------------------------------------------------


@query(f"WITH {TICKS} SELECT * FROM ticks")
def tick_adapter(spark, sf_dir):
    return ticks(spark, sf_dir)


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks as text, with what cleaning must take out: repeats, bad numbers, missing ids."""
    t = ticks(spark, sf_dir)
    n = F.col("trade_id").cast("long")
    text = t.select(*[F.col(c).cast("string").alias(c) for c in t.columns])
    late = text.where(n % 10 == 0).withColumn("timestamp_utc", (F.col("timestamp_utc").cast("long") + 5).cast("string"))
    broken = text.withColumns(
        {
            "price": F.when(n % 13 == 0, "-1").when(n % 17 == 0, "none").otherwise(F.col("price")),
            "quantity": F.when(n % 19 == 0, "0").otherwise(F.col("quantity")),
            "trade_id": F.when(n % 23 == 0, F.lit(None)).otherwise(F.col("trade_id")),
            "is_liquidation": F.when(n % 2 == 0, F.col("is_liquidation")),
        }
    )
    return broken.unionByName(late)


@query(f"""WITH {TICKS}, dirty AS (
  SELECT exchange, market_type, symbol, timestamp_utc, CASE WHEN n % 23 = 0 THEN NULL ELSE trade_id END AS trade_id,
         CASE WHEN n % 13 = 0 THEN -1.0 WHEN n % 17 = 0 THEN NULL ELSE price END AS price, CASE WHEN n % 19 = 0 THEN 0.0 ELSE quantity END AS quantity,
         quote_quantity, side, is_liquidation FROM (SELECT *, CAST(trade_id AS BIGINT) AS n FROM ticks)
  UNION ALL SELECT exchange, market_type, symbol, timestamp_utc + 5, trade_id, price, quantity, quote_quantity, side, is_liquidation FROM ticks WHERE CAST(trade_id AS BIGINT) % 10 = 0)
SELECT * FROM dirty WHERE trade_id IS NOT NULL AND timestamp_utc IS NOT NULL AND price > 0 AND quantity > 0
QUALIFY row_number() OVER (PARTITION BY exchange, symbol, trade_id ORDER BY timestamp_utc) = 1""")
def clean_trades(spark, sf_dir):
    return trades.clean_trades(dirty(spark, sf_dir))


@query(f"""WITH {TICKS}, twice AS (SELECT * FROM ticks UNION ALL SELECT * REPLACE (timestamp_utc - 7 AS timestamp_utc) FROM ticks WHERE CAST(trade_id AS BIGINT) % 3 = 0)
SELECT * FROM twice QUALIFY row_number() OVER (PARTITION BY exchange, symbol, trade_id ORDER BY timestamp_utc) = 1""")
def dedupe_first(spark, sf_dir):
    t = ticks(spark, sf_dir)
    earlier = t.where(F.col("trade_id").cast("long") % 3 == 0).withColumn("timestamp_utc", F.col("timestamp_utc") - 7)
    return trades.first_of_key(t.unionByName(earlier))


@query(f"""WITH {TICKS} SELECT * REPLACE (CASE WHEN CAST(trade_id AS BIGINT) % 4 = 0 THEN price + 1 ELSE price END AS price,
  CASE WHEN CAST(trade_id AS BIGINT) % 4 = 0 THEN 'buy' ELSE side END AS side) FROM ticks""")
def upsert_last(spark, sf_dir):
    t = ticks(spark, sf_dir)
    newer = t.where(F.col("trade_id").cast("long") % 4 == 0).withColumns({"price": F.col("price") + 1, "side": F.lit("buy")})
    return trades.merge_rows(t, newer, TRADE_KEY)


ANOMALIES = """odd AS (SELECT * REPLACE (CASE WHEN CAST(trade_id AS BIGINT) % 11 = 0 THEN -price ELSE price END AS price,
  CASE WHEN CAST(trade_id AS BIGINT) % 29 = 0 THEN NULL ELSE timestamp_utc END AS timestamp_utc) FROM ticks)"""


def odd_ticks(spark, sf_dir):
    n = F.col("trade_id").cast("long")
    return ticks(spark, sf_dir).withColumns(
        {"price": F.when(n % 11 == 0, -F.col("price")).otherwise(F.col("price")), "timestamp_utc": F.when(n % 29 != 0, F.col("timestamp_utc"))}
    )


@query(f"WITH {TICKS}, {ANOMALIES} SELECT * FROM odd WHERE price <= 0 OR quantity <= 0 OR timestamp_utc IS NULL")
def price_anomalies(spark, sf_dir):
    return trades.price_anomalies(odd_ticks(spark, sf_dir))


@query(f"""WITH {TICKS}, {ANOMALIES} SELECT exchange, symbol, CAST(count(*) AS BIGINT) AS row_count, make_timestamp(min(timestamp_utc)) AS first_trade_utc,
  make_timestamp(max(timestamp_utc)) AS last_trade_utc, min(price) AS min_price, max(price) AS max_price,
  CAST(sum(CASE WHEN price <= 0 OR quantity <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS invalid_rows FROM odd GROUP BY exchange, symbol""")
def trade_summary(spark, sf_dir):
    return quality.trade_summary(odd_ticks(spark, sf_dir))


# --- bars ---------------------------------------------------------------------------------------


@query(f"WITH {TICKS}, {B1S} SELECT {BAR_SELECT} FROM bars")
def bars_1s(spark, sf_dir):
    return rounded(bars.resample(ticks(spark, sf_dir), "1s"), **BAR_DIGITS)


@query(f"WITH {TICKS}, {B1M} SELECT {BAR_SELECT} FROM bars")
def bars_1m(spark, sf_dir):
    return rounded(bars.resample(ticks(spark, sf_dir), "1m"), **BAR_DIGITS)


@query(f"WITH {TICKS}, {B5M} SELECT {BAR_SELECT} FROM bars")
def bars_5m(spark, sf_dir):
    return rounded(bars.resample(ticks(spark, sf_dir), "5m"), **BAR_DIGITS)


def volatility_sql(cte: str, n: int) -> str:
    return f"""WITH {TICKS}, {cte}, r AS (SELECT *, ln(close) - ln(lag(close) OVER {SERIES_WINDOW})) AS r FROM bars)
SELECT exchange, symbol, bar_timestamp_utc, close, round(sqrt(sum(r * r) OVER {SERIES_WINDOW} ROWS {n - 1} PRECEDING)), 9) AS realized_vol FROM r"""


def volatility(spark, sf_dir, timeframe, n):
    df = features.realized_volatility(bars.resample(ticks(spark, sf_dir), timeframe), n, "realized_vol")
    return rounded(df.select("exchange", "symbol", "bar_timestamp_utc", "close", "realized_vol"), realized_vol=9)


@query(volatility_sql(B1M, 1))
def realized_vol_w1(spark, sf_dir):
    return volatility(spark, sf_dir, "1m", 1)


@query(volatility_sql(B1M, 5))
def realized_vol_w5(spark, sf_dir):
    return volatility(spark, sf_dir, "1m", 5)


def flash_sql(cte: str, pct: float) -> str:
    return f"""WITH {TICKS}, {cte}, c AS (SELECT exchange, symbol, bar_timestamp_utc, close, (close / lag(close) OVER {SERIES_WINDOW}) - 1) * 100 AS x FROM bars)
SELECT exchange, symbol, bar_timestamp_utc, close, round(x, 6) AS price_change_pct, coalesce(abs(x) > {pct}, FALSE) AS is_flash_move FROM c"""


def flash(spark, sf_dir, pct):
    df = features.flash_moves(bars.resample(ticks(spark, sf_dir), "1m"), features.EventThresholds(flash_move_pct=pct))
    return rounded(df.select("exchange", "symbol", "bar_timestamp_utc", "close", "price_change_pct", "is_flash_move"), price_change_pct=6)


@query(flash_sql(B1M, 3.0))
def flash_moves(spark, sf_dir):
    return flash(spark, sf_dir, 3.0)


@query(flash_sql(B1M, 400.0))
def flash_moves_rare(spark, sf_dir):
    return flash(spark, sf_dir, 400.0)


Z = f"""z AS (SELECT *, avg(volume_base) OVER {SERIES_WINDOW} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS m,
  stddev_samp(volume_base) OVER {SERIES_WINDOW} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS s FROM bars),
y AS (SELECT *, CASE WHEN s = 0 THEN CASE WHEN volume_base > m THEN 'inf'::DOUBLE WHEN volume_base < m THEN '-inf'::DOUBLE ELSE 'nan'::DOUBLE END ELSE (volume_base - m) / s END AS x FROM z)"""
#: No infinity or NaN goes into compared columns: null with a flag.
FINITE = "CASE WHEN isfinite(x) THEN round(x, 6) END AS volume_zscore, x IS NOT NULL AND NOT isfinite(x) AS is_flat_window"


def finite_score(df: DataFrame) -> DataFrame:
    x = F.col("volume_zscore")
    finite = F.abs(x) < float("inf")  # false for NaN, which is largest
    return df.withColumns({"is_flat_window": x.isNotNull() & ~F.coalesce(finite, F.lit(False)), "volume_zscore": F.when(finite, round_binary(x, 6))})


@query(f"WITH {TICKS}, {B5M}, {Z} SELECT exchange, symbol, bar_timestamp_utc, volume_base, {FINITE}, coalesce(x > 3, FALSE) AS is_volume_surge FROM y")
def volume_surges(spark, sf_dir):
    df = finite_score(features.volume_surges(bars.resample(ticks(spark, sf_dir), "5m")))
    return df.select("exchange", "symbol", "bar_timestamp_utc", "volume_base", "volume_zscore", "is_flat_window", "is_volume_surge")


def enriched_sql(cte: str, windows: dict[str, int]) -> str:
    vols = "".join(f", round(sqrt(sum(r * r) OVER {SERIES_WINDOW} ROWS {n - 1} PRECEDING)), 9) AS realized_vol_{w}" for w, n in windows.items())
    return f"""WITH {TICKS}, {cte}, {Z}, e AS (SELECT *, ln(close) - ln(lag(close) OVER {SERIES_WINDOW})) AS r, (close / lag(close) OVER {SERIES_WINDOW}) - 1) * 100 AS c FROM y)
SELECT {BAR_SELECT.replace("*", "* EXCLUDE (m, s, x, r, c)")}{vols}, round(c, 6) AS price_change_pct, coalesce(abs(c) > 3, FALSE) AS is_flash_move,
  {FINITE}, coalesce(x > 3, FALSE) AS is_volume_surge FROM e"""


def enriched(spark, sf_dir, timeframe, *windows):
    df = finite_score(enriched_bars(ticks(spark, sf_dir), timeframe))
    return rounded(df, **BAR_DIGITS, price_change_pct=6, **{f"realized_vol_{w}": 9 for w in windows})


@query(enriched_sql(B1M, {"1m": 1, "5m": 5}))
def enriched_bars_1m(spark, sf_dir):
    return enriched(spark, sf_dir, "1m", "1m", "5m")


@query(enriched_sql(B5M, {"5m": 1}))
def enriched_bars_5m(spark, sf_dir):
    return enriched(spark, sf_dir, "5m", "5m")


@query(enriched_sql(B1S, {"1m": 60, "5m": 300}))
def enriched_bars_1s(spark, sf_dir):
    return enriched(spark, sf_dir, "1s", "1m", "5m")


@query(f"""WITH {TICKS}, {B5M}, {Z} SELECT exchange, symbol, bar_timestamp_utc, coalesce(abs((close / lag(close) OVER {SERIES_WINDOW}) - 1) * 100) > 3, FALSE) AS is_flash_move,
  coalesce(x > 3, FALSE) AS is_volume_surge FROM y""")
def bar_events(spark, sf_dir):
    return features.bar_events(bars.resample(ticks(spark, sf_dir), "5m")).select("exchange", "symbol", "bar_timestamp_utc", "is_flash_move", "is_volume_surge")


def gaps_sql(cte: str, step: str) -> str:
    return f"""WITH {TICKS}, {cte}, grid AS (
  SELECT exchange, symbol, unnest(generate_series(min(bar_timestamp_utc), max(bar_timestamp_utc), INTERVAL {step})) AS missing_bar_utc FROM bars GROUP BY exchange, symbol)
SELECT * FROM grid g ANTI JOIN bars b ON g.exchange = b.exchange AND g.symbol = b.symbol AND g.missing_bar_utc = b.bar_timestamp_utc"""


@query(gaps_sql(B5M, "5 minutes"))
def bar_gaps(spark, sf_dir):
    return quality.bar_gaps(bars.resample(ticks(spark, sf_dir), "5m"), "5m")


@query(gaps_sql(B1M, "1 minute"))
def bar_gaps_1m(spark, sf_dir):
    return quality.bar_gaps(bars.resample(ticks(spark, sf_dir), "1m"), "1m")


@query(f"""WITH {TICKS}, {B1S} SELECT exchange, symbol, timeframe,
  CAST(date_diff('second', min(bar_timestamp_utc), max(bar_timestamp_utc)) + 1 - count(*) AS BIGINT) AS missing_bars FROM bars GROUP BY ALL""")
def gap_counts(spark, sf_dir):
    return quality.gap_counts(bars.resample(ticks(spark, sf_dir), "1s"))


# --- books --------------------------------------------------------------------------------------

LEVELS = 3


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books out of events: prices around the value, spread by id, some crossed."""
    half = F.col("value") * (F.col("event_id") % 50 - 2) / 5000
    columns = {}
    for i in range(1, LEVELS + 1):
        step = F.col("value") * ((i - 1) * 0.006)
        columns |= {f"bid_price_{i}": F.col("value") - half - step, f"ask_price_{i}": F.col("value") + half + step}
        columns |= {f"bid_size_{i}": (F.col("event_id") % (i + 2) + 1).cast("double"), f"ask_size_{i}": F.when(F.col("event_id") % 9 != i, (F.col("event_id") % (i + 4)).cast("double"))}
    return events(spark, sf_dir).select("event_id", *[c.alias(n) for n, c in columns.items()])


def books_cte() -> str:
    half = "value * (event_id % 50 - 2) / 5000"
    columns = []
    for i in range(1, LEVELS + 1):
        step = f"value * CAST({(i - 1) * 0.006!r} AS DOUBLE)"
        columns += [f"value - {half} - {step} AS bid_price_{i}", f"value + {half} + {step} AS ask_price_{i}"]
        columns += [f"CAST(event_id % {i + 2} + 1 AS DOUBLE) AS bid_size_{i}", f"CASE WHEN event_id % 9 <> {i} THEN CAST(event_id % {i + 4} AS DOUBLE) END AS ask_size_{i}"]
    return f"books AS (SELECT event_id, {', '.join(columns)} FROM events)"


def depth_term(side: str, sign: str, compare: str, p: str) -> str:
    return " + ".join(f"coalesce(CASE WHEN {side}_price_{i} {compare} mid_price * (CAST(1 AS DOUBLE) {sign} CAST({p} AS DOUBLE)) THEN {side}_price_{i} * {side}_size_{i} END, 0)" for i in range(1, LEVELS + 1))


METRICS = f"""{books_cte()}, quoted AS (SELECT *, (bid_price_1 + ask_price_1) / 2 AS mid_price, ask_price_1 - bid_price_1 AS spread FROM books),
metrics AS (SELECT event_id, mid_price, spread, spread / mid_price * 10000 AS spread_bps, {depth_term("bid", "-", ">=", "0.01")} AS bid_depth_usd_1pct, {depth_term("ask", "+", "<=", "0.01")} AS ask_depth_usd_1pct,
  {depth_term("bid", "-", ">=", "0.02")} AS bid_depth_usd_2pct, {depth_term("ask", "+", "<=", "0.02")} AS ask_depth_usd_2pct FROM quoted)"""
METRIC_COLUMNS = ("mid_price", "spread", "spread_bps", "bid_depth_usd_1pct", "ask_depth_usd_1pct", "bid_depth_usd_2pct", "ask_depth_usd_2pct")
METRIC_SELECT = "event_id, " + ", ".join(f"round({c}, 5) AS {c}" for c in METRIC_COLUMNS)


@query(f"WITH {METRICS} SELECT {METRIC_SELECT} FROM metrics")
def book_metrics(spark, sf_dir):
    return rounded(book.book_metrics(books(spark, sf_dir)).select("event_id", *METRIC_COLUMNS), **dict.fromkeys(METRIC_COLUMNS, 5))


@query(f"WITH {METRICS} SELECT {METRIC_SELECT} FROM metrics")
def book_metrics_nested(spark, sf_dir):
    side = lambda s: F.array(*[F.struct(F.col(f"{s}_price_{i}").alias("price"), F.col(f"{s}_size_{i}").alias("size")) for i in range(1, LEVELS + 1)])
    nested = books(spark, sf_dir).select("event_id", side("bid").alias("bids"), side("ask").alias("asks"))
    return rounded(book.nested_book_metrics(nested).select("event_id", *METRIC_COLUMNS), **dict.fromkeys(METRIC_COLUMNS, 5))


@query(f"WITH {METRICS} SELECT {METRIC_SELECT} FROM metrics WHERE spread < 0")
def crossed_books(spark, sf_dir):
    df = book.crossed_books(book.book_metrics(books(spark, sf_dir)))
    return rounded(df.select("event_id", *METRIC_COLUMNS), **dict.fromkeys(METRIC_COLUMNS, 5))


@query(f"WITH {METRICS} SELECT event_id, round(spread_bps, 5) AS spread_bps, spread_bps > 51 AS is_liquidity_dry_up FROM metrics")
def liquidity_dry_ups(spark, sf_dir):
    df = features.liquidity_dry_ups(book.book_metrics(books(spark, sf_dir)), features.EventThresholds(spread_blowout_bps=51.0))
    return rounded(df.select("event_id", "spread_bps", "is_liquidity_dry_up"), spread_bps=5)


def depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth out of order lines; percentages repeat in orders of more than five lines."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    levels = F.element_at(F.array(*[F.lit(p) for p in (-2, -1, 1, 2, 3)]), (F.col("l_linenumber") % 5 + 1).cast("int"))
    return lines.select(F.lit("binance").alias("exchange"), F.lit("BTC-USDT").alias("symbol"), F.col("l_orderkey").cast("long").alias("timestamp_utc"), levels.cast("long").alias("percentage"), F.col("l_quantity").alias("depth"), F.col("l_extendedprice").alias("notional"))


PIVOT = """WITH depth AS (SELECT 'binance' AS exchange, 'BTC-USDT' AS symbol, CAST(l_orderkey AS BIGINT) AS timestamp_utc, [-2, -1, 1, 2, 3][l_linenumber % 5 + 1] AS percentage, l_extendedprice AS notional FROM lineitem)
SELECT exchange, symbol, timestamp_utc, max(notional) FILTER (percentage = -1) AS bid_depth_usd_1pct, max(notional) FILTER (percentage = 1) AS ask_depth_usd_1pct,
  max(notional) FILTER (percentage = -2) AS bid_depth_usd_2pct, max(notional) FILTER (percentage = 2) AS ask_depth_usd_2pct FROM depth GROUP BY ALL"""


@query(PIVOT)
def pivot_depth(spark, sf_dir):
    return book.pivot_depth(depth(spark, sf_dir))


@query(PIVOT.split("SELECT exchange, symbol, timestamp_utc, max")[0] + """, k AS (SELECT DISTINCT exchange, symbol, timestamp_utc FROM depth)
SELECT exchange, symbol, timestamp_utc, a.notional AS bid_depth_usd_1pct, b.notional AS ask_depth_usd_1pct, c.notional AS bid_depth_usd_2pct, d.notional AS ask_depth_usd_2pct FROM k
  LEFT JOIN (SELECT * FROM depth WHERE percentage = -1) a USING (exchange, symbol, timestamp_utc) LEFT JOIN (SELECT * FROM depth WHERE percentage = 1) b USING (exchange, symbol, timestamp_utc)
  LEFT JOIN (SELECT * FROM depth WHERE percentage = -2) c USING (exchange, symbol, timestamp_utc) LEFT JOIN (SELECT * FROM depth WHERE percentage = 2) d USING (exchange, symbol, timestamp_utc)""")
def pivot_depth_joined(spark, sf_dir):
    return book.pivot_depth(depth(spark, sf_dir), unique=False)


# --- symbols, keys, ranges -------------------------------------------------------------------------

#: Raw symbols and what they are unified to.
SYMBOLS = [
    ("BTCUSDT", "binance", "BTC-USDT"), ("ethusd", "bybit", "ETH-USD"), ("XXBTZUSD", "kraken", "BTC-USD"), ("XBTUSD", "kraken", "BTC-USD"),
    ("XETHZUSD", "kraken", "ETH-USD"), ("DOTUSD", "binance", "DO-TUSD"), ("BNBUSD", "binance", "BN-BUSD"), ("BTC/EUR", "bybit", "BTC-EUR"),
    ("SOL-USD", "binance", "SOL-USD"), ("USDT", "binance", "USDT"), ("XDGZEUR", "kraken", "DOGE-EUR"), ("ABC", "kraken", "ABC"), ("XXBT/ZUSD", "kraken", "BTC-ZUSD"),
]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{r}', '{e}', '{s}')" for r, e, s in SYMBOLS) + ") AS t(raw, exchange, symbol)")
def normalize_symbol(spark, sf_dir):
    raw = spark.createDataFrame([s[:2] for s in SYMBOLS], "raw string, exchange string")
    return raw.withColumn("symbol", unified_symbol(F.col("raw"), F.col("exchange")))


@query(f"WITH {TICKS} SELECT exchange, symbol, trade_id, CAST(year(make_timestamp(timestamp_utc)) AS INTEGER) AS year, strftime(make_timestamp(timestamp_utc), '%m') AS month FROM ticks")
def partition_keys(spark, sf_dir):
    return ticks(spark, sf_dir).select("exchange", "symbol", "trade_id", *[c.alias(n) for n, c in year_and_month(from_micros(F.col("timestamp_utc"))).items()])


@query(f"""WITH {TICKS} SELECT * FROM ticks WHERE exchange = 'bybit' AND symbol = 'BTC-USDT' AND timestamp_utc >= epoch_us(TIMESTAMP '2024-01-05') AND timestamp_utc < epoch_us(TIMESTAMP '2024-01-06')""")
def sample_window(spark, sf_dir):
    day = 1_704_412_800_000_000
    return ticks(spark, sf_dir).where((F.col("exchange") == "bybit") & (F.col("symbol") == "BTC-USDT") & (F.col("timestamp_utc") >= day) & (F.col("timestamp_utc") < day + 86_400_000_000))


# --- a lake and SQL over it ------------------------------------------------------------------------


def ticks_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake that holds the ticks, written in two overlapping batches."""
    import uuid

    lake = Lake(spark, f"{shared_folder(spark)}/tickloom/lake-{uuid.uuid4().hex}")
    t = ticks(spark, sf_dir)
    n = F.col("trade_id").cast("long")
    lake.write(t.where(n % 3 != 0), "trades", "timestamp_utc", merge_key=TRADE_KEY)
    lake.write(t.where(n % 3 != 1), "trades", "timestamp_utc", merge_key=TRADE_KEY)
    return lake


@query(f"""WITH {TICKS} SELECT *, CAST(year(make_timestamp(timestamp_utc)) AS INTEGER) AS year, CAST(month(make_timestamp(timestamp_utc)) AS INTEGER) AS month FROM ticks""")
def lake_round_trip(spark, sf_dir):
    return ticks_lake(spark, sf_dir).read("trades")


LAKE_ROWS = "*, CAST(year(make_timestamp(timestamp_utc)) AS INTEGER) AS year, CAST(month(make_timestamp(timestamp_utc)) AS INTEGER) AS month"


def new_lake(spark: SparkSession) -> Lake:
    import uuid

    return Lake(spark, f"{shared_folder(spark)}/tickloom/lake-{uuid.uuid4().hex}")


@query(f"""WITH {TICKS}, m AS (SELECT DISTINCT exchange, strftime(make_timestamp(timestamp_utc), '%Y-%m') AS month FROM ticks WHERE CAST(trade_id AS BIGINT) % 2 = 1)
SELECT {LAKE_ROWS} FROM ticks WHERE CAST(trade_id AS BIGINT) % 2 = 1 OR (exchange, strftime(make_timestamp(timestamp_utc), '%Y-%m')) NOT IN (SELECT exchange, month FROM m)""")
def lake_overwrite(spark, sf_dir):
    """Touched partitions hold the rows of the second write only."""
    lake, t = new_lake(spark), ticks(spark, sf_dir)
    lake.write(t, "trades", "timestamp_utc")
    lake.write(t.where(F.col("trade_id").cast("long") % 2 == 1), "trades", "timestamp_utc")
    return lake.read("trades")


@query(f"""WITH {TICKS} SELECT {LAKE_ROWS} FROM ticks WHERE CAST(trade_id AS BIGINT) % 4 <> 0""")
def lake_batches(spark, sf_dir):
    """Batches of names that begin alike, one of them written again."""
    lake, t, n = new_lake(spark), ticks(spark, sf_dir), F.col("trade_id").cast("long") % 4
    for batch, rest in (("jan", 0), ("jan-2", 1), ("jan-2-00000", 2), ("jan", 3)):
        lake.write(t.where(n == rest), "trades", "timestamp_utc", batch=batch)
    return lake.read("trades")


@query(f"""WITH {TICKS} SELECT * FROM ticks ORDER BY exchange, symbol, timestamp_utc, trade_id""")
def sorted_trades(spark, sf_dir):
    return in_order(ticks(spark, sf_dir))


DUCKDB_PROFILE = "SELECT exchange, quantile(price, 0.5) AS median, array_length(list(trade_id)) AS n, time_bucket(INTERVAL '1 hour', make_timestamp(timestamp_utc)) AS hour FROM ticks GROUP BY ALL"


@query(f"WITH {TICKS} " + DUCKDB_PROFILE.replace("array_length(list(trade_id))", "CAST(count(*) AS INTEGER)"))
def sql_dialect(spark, sf_dir):
    """A query in DuckDB's own functions, run by Spark."""
    ticks(spark, sf_dir).createOrReplaceTempView("tickloom_ticks")
    return spark.sql(spark_sql(DUCKDB_PROFILE.replace("FROM ticks", "FROM tickloom_ticks")))


@query(f"""WITH {TICKS} SELECT exchange, symbol, CAST(count(*) AS BIGINT) AS n, sum(quantity) AS quantity FROM ticks GROUP BY exchange, symbol""")
def lake_sql_totals(spark, sf_dir):
    return ticks_lake(spark, sf_dir).sql("SELECT exchange, symbol, COUNT(*) AS n, SUM(quantity) AS quantity FROM trades GROUP BY exchange, symbol")


def over_ticks(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    ticks(spark, sf_dir).createOrReplaceTempView("tickloom_ticks")
    spark.read.parquet(f"{sf_dir}/orders.parquet").createOrReplaceTempView("tickloom_orders")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").createOrReplaceTempView("tickloom_lineitem")
    return spark.sql(sql)


@query(f"""WITH {TICKS} SELECT exchange, side, CAST(grouping(exchange) + 2 * grouping(side) AS INTEGER) AS level, CAST(count(*) AS BIGINT) AS n, sum(quantity) AS quantity FROM ticks GROUP BY CUBE (exchange, side)""")
def sql_cube(spark, sf_dir):
    return over_ticks(spark, sf_dir, "SELECT exchange, side, CAST(grouping(exchange) + 2 * grouping(side) AS INT) AS level, COUNT(*) AS n, SUM(quantity) AS quantity FROM tickloom_ticks GROUP BY CUBE (exchange, side)")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0 INTERSECT SELECT l_orderkey FROM lineitem WHERE l_quantity > 30 EXCEPT SELECT l_orderkey FROM lineitem WHERE l_quantity > 45")
def sql_set_operations(spark, sf_dir):
    return over_ticks(spark, sf_dir, "SELECT o_orderkey FROM tickloom_orders WHERE o_orderkey % 2 = 0 INTERSECT SELECT l_orderkey FROM tickloom_lineitem WHERE l_quantity > 30 EXCEPT SELECT l_orderkey FROM tickloom_lineitem WHERE l_quantity > 45")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 49) AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity < 5)")
def sql_semi_anti(spark, sf_dir):
    return over_ticks(spark, sf_dir, "SELECT o_orderkey, o_custkey FROM tickloom_orders LEFT SEMI JOIN tickloom_lineitem a ON a.l_orderkey = o_orderkey AND a.l_quantity > 49 LEFT ANTI JOIN tickloom_lineitem b ON b.l_orderkey = o_orderkey AND b.l_quantity < 5")


@query(f"WITH {TICKS} SELECT exchange, trade_id, price FROM ticks ORDER BY price DESC, trade_id LIMIT 25")
def sql_top_k(spark, sf_dir):
    return over_ticks(spark, sf_dir, "SELECT exchange, trade_id, price FROM tickloom_ticks ORDER BY price DESC, trade_id LIMIT 25")


@query(f"""WITH {TICKS}, q AS (SELECT exchange, timestamp_utc, max(price) AS quote FROM ticks WHERE side = 'sell' GROUP BY ALL)
SELECT t.exchange, t.timestamp_utc, t.trade_id, t.price, q.quote FROM (SELECT * FROM ticks WHERE side = 'buy') t ASOF LEFT JOIN q ON t.exchange = q.exchange AND t.timestamp_utc >= q.timestamp_utc""")
def asof_quotes(spark, sf_dir):
    t = ticks(spark, sf_dir)
    buys = t.where("side = 'buy'").select("exchange", "timestamp_utc", "trade_id", "price")
    sells = t.where("side = 'sell'").select("exchange", "timestamp_utc", F.col("price").alias("quote"))
    return asof.asof_join(buys, sells, ["exchange"], "timestamp_utc", ["quote"])
