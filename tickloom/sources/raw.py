"""Raw archives as trade and depth tables, before cleaning."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BOOK_DEPTH, TRADES
from ..session import ship

#: Market types by the exchanges' names of markets.
ARCHIVE_MARKETS = {"spot": "spot", "futures/um": "linear_perpetual", "futures/cm": "inverse_perpetual"}
EXECUTION_MARKETS = {"linear": "linear_perpetual", "inverse": "inverse_perpetual"}
#: Columns of archives by kind, in order.
ARCHIVE_COLUMNS = {
    "trades": ("id", "price", "qty", "quote_qty", "time", "is_buyer_maker", "is_best_match"),
    "aggTrades": ("agg_trade_id", "price", "quantity", "first_trade_id", "last_trade_id", "transact_time", "is_buyer_maker", "is_best_match"),
}
DEPTH_COLUMNS = ("timestamp", "percentage", "depth", "notional")
LINES = 100_000


def _known(table: dict, key: str, what: str):
    if key not in table:
        raise ValueError(f"unknown {what} {key!r}; known: {', '.join(table)}")
    return table[key]


def csv_member(archive: zipfile.ZipFile) -> str:
    """The name of an archive's only csv file."""
    members = [n for n in archive.namelist() if n.lower().endswith(".csv")]
    if len(members) != 1:
        raise ValueError(f"an archive must hold exactly one .csv, this has {len(members)}")
    return members[0]


def _unzipped(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for path, content in zip(frame["path"], frame["content"], strict=True):
            with zipfile.ZipFile(io.BytesIO(content)) as archive, archive.open(csv_member(archive)) as member:
                lines: list[str] = []
                n = 0
                for line in io.TextIOWrapper(member, "utf-8"):
                    lines.append(line.rstrip("\r\n"))
                    if len(lines) == LINES:
                        yield pd.DataFrame({"path": path, "n": range(n, n + len(lines)), "line": lines})
                        n, lines = n + len(lines), []
                if lines:
                    yield pd.DataFrame({"path": path, "n": range(n, n + len(lines)), "line": lines})


def zipped_lines(spark: SparkSession, path: str) -> DataFrame:
    """path, n (from 0) and line of every line in zipped csv files, which Spark itself does not read.

    Archives are read in parallel, each by one task as a stream of lines; the
    compressed file has to fit in its memory.
    """
    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(_unzipped, "path string, n long, line string")


def _fields(lines: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Columns by position.  A first line whose first field is no number is a header."""
    cut = lines.where("trim(line) <> ''").withColumn("f", F.split("line", ","))
    rows = cut.where((F.col("n") > 0) | F.trim(F.get("f", F.lit(0))).try_cast("double").isNotNull())
    return rows.select(*[F.trim(F.get("f", F.lit(i))).alias(c) for i, c in enumerate(columns)])


def _trades(df: DataFrame, exchange: str, market_type: str, symbol: str, **columns: Column) -> DataFrame:
    fixed = {"exchange": F.lit(exchange), "market_type": F.lit(market_type), "symbol": F.lit(symbol), "is_liquidation": F.lit(False)}
    columns = fixed | columns
    return df.select(*[columns[f.name].try_cast(f.dataType).alias(f.name) for f in TRADES.fields])


def archive_trades(spark: SparkSession, path: str, symbol: str, market: str = "spot", data_type: str = "trades") -> DataFrame:
    """Trades of zipped archives.  A buyer that is maker means a sell; a missing flag a buy."""
    market_type = _known(ARCHIVE_MARKETS, market, "market")
    names = _known(ARCHIVE_COLUMNS, data_type, "data type")
    rows = _fields(zipped_lines(spark, path), names)
    quantity = F.col("qty" if data_type == "trades" else "quantity").try_cast("double")
    price = F.col("price").try_cast("double")
    return _trades(
        rows, "binance", market_type, symbol,
        trade_id=F.col(names[0]), price=price, quantity=quantity,
        timestamp_utc=F.col("time" if data_type == "trades" else "transact_time").try_cast("long") * 1000,
        quote_quantity=F.col("quote_qty") if data_type == "trades" else price * quantity,
        side=F.when(F.lower("is_buyer_maker") == "true", "sell").otherwise("buy"),
    )


def execution_trades(spark: SparkSession, path: str, symbol: str, market: str = "linear") -> DataFrame:
    """Trades of gzipped daily execution files with a header; the notional columns are the quantities."""
    market_type = _known(EXECUTION_MARKETS, market, "market")
    rows = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return _trades(
        rows, "bybit", market_type, symbol,
        trade_id=F.col("trdMatchID"), price=F.col("price"), quantity=F.col("homeNotional"), quote_quantity=F.col("foreignNotional"),
        timestamp_utc=F.rint(F.col("timestamp").try_cast("double") * 1e6), side=F.lower("side"),
    )


def _page_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for content in frame["content"]:
            result = json.loads(content)["result"]
            rows = next(v for k, v in result.items() if k != "last")
            out = [(str(r[0]), str(r[1]), float(r[2]), str(r[3]), str(r[6]) if len(r) > 6 else f"{r[2]}-{i}") for i, r in enumerate(rows)]
            yield pd.DataFrame(out, columns=["price", "volume", "seconds", "side", "id"])


def page_trades(spark: SparkSession, folder: str, symbol: str) -> DataFrame:
    """Trades of a folder of JSON pages.  A row without id is named by its time, as the page writes it, and place."""
    ship(spark)
    pages = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(folder).select("content")
    rows = pages.mapInPandas(_page_rows, "price string, volume string, seconds double, side string, id string")
    price, quantity = F.col("price").try_cast("double"), F.col("volume").try_cast("double")
    return _trades(
        rows, "kraken", "spot", symbol,
        trade_id=F.col("id"), price=price, quantity=quantity, quote_quantity=price * quantity,
        timestamp_utc=F.rint(F.col("seconds") * 1e6), side=F.when(F.col("side") == "b", "buy").otherwise("sell"),
    )


def archive_depth(spark: SparkSession, path: str, symbol: str) -> DataFrame:
    """Depth by percentage of zipped files with a header, whose columns may be in any order."""
    lines = zipped_lines(spark, path)
    headers = [r.line for r in lines.where("n = 0").select("line").distinct().collect()]  # one kind of header, as a rule
    parts = []
    for header in headers:
        names = tuple(h.strip() for h in header.split(","))
        if missing := [c for c in DEPTH_COLUMNS if c not in names]:
            raise ValueError(f"missing expected bookDepth column(s): {', '.join(missing)}")
        own = lines.join(lines.where((F.col("n") == 0) & (F.col("line") == header)).select("path"), "path", "left_semi") if len(headers) > 1 else lines
        rows = _fields(own, names)
        columns = {
            "exchange": F.lit("binance"), "symbol": F.lit(symbol), "timestamp_utc": F.col("timestamp").try_cast("long") * 1000,
            "percentage": F.col("percentage").try_cast("double"), "depth": F.col("depth"), "notional": F.col("notional"),
        }
        parts.append(rows.select(*[columns[f.name].try_cast(f.dataType).alias(f.name) for f in BOOK_DEPTH.fields]))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], BOOK_DEPTH)
