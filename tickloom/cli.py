"""Command line: downloads, normalization, bars, SQL, report and samples."""

from __future__ import annotations

import argparse
import asyncio
import glob
from datetime import UTC, date, datetime, time
from pathlib import Path

from .plans import enrich, normalize, report
from .schemas import BAR_KEY, DEPTH_KEY, TIMEFRAMES, TRADE_KEY
from .session import build_session
from .sources import download
from .sources.export import export_sample, write_flat
from .sources.lake import Lake

DATA = Path("data")
RAW, GOLD = DATA / "bronze" / "raw", DATA / "gold"
MARKETS, EXECUTION_MARKETS, DATA_TYPES = ("spot", "futures/um", "futures/cm"), ("linear", "inverse"), ("trades", "aggTrades")


def a_day(text: str) -> date:
    return date.fromisoformat(text)


def a_month(text: str) -> date:
    return datetime.strptime(text, "%Y-%m").date()


def a_utc_day(text: str) -> datetime:
    return datetime.combine(a_day(text), time(), UTC)


def _nanos(day: date) -> int:
    return int(datetime.combine(day, time(), UTC).timestamp()) * 1_000_000_000


def get_archives(a) -> str:
    found = asyncio.run(download.harvest_monthly(download.Downloader(a.concurrency), a.market, a.symbol, a.start, a.end, RAW / "binance", a.data_type))
    return f"binance: {len(found)} file(s) ready"


def get_depth(a) -> str:
    found = asyncio.run(download.harvest_daily(download.Downloader(a.concurrency), "futures/um", a.symbol, a.start, a.end, "bookDepth", RAW / "binance"))
    return f"binance-bookdepth: {len(found)} file(s) ready"


def get_executions(a) -> str:
    found = asyncio.run(download.fetch_executions(download.Downloader(a.concurrency), a.symbol, a.start, a.end, RAW / "bybit"))
    return f"bybit: {len(found)} file(s) ready"


def get_pages(a) -> str:
    pages = asyncio.run(download.fetch_pages(download.Downloader(a.concurrency, rate=a.rps), a.pair, _nanos(a.start), _nanos(a.end), RAW / "kraken"))
    return f"kraken: {len(pages)} page(s), {sum(p.trade_count for p in pages)} trade(s)"


def _store(df, a, label: str, table: str, key) -> str:
    if a.out is not None:
        return f"normalize {label}: {write_flat(df, a.out)} row(s) -> {a.out}"
    parts = Lake(df.sparkSession, a.root).write(df, table, "timestamp_utc", merge_key=key)
    return f"normalize {label}: {parts} partition(s) under {a.root}/{table}"


def normalize_archives(a) -> str:
    return _store(normalize.archive_trades(build_session(), str(a.path), a.symbol, a.market, a.data_type), a, "binance", "trades", TRADE_KEY)


def normalize_executions(a) -> str:
    return _store(normalize.execution_trades(build_session(), str(a.path), a.symbol, a.market), a, "bybit", "trades", TRADE_KEY)


def normalize_pages(a) -> str:
    return _store(normalize.page_trades(build_session(), str(a.path), a.pair), a, "kraken", "trades", TRADE_KEY)


def normalize_depth(a) -> str:
    return _store(normalize.archive_depth(build_session(), str(a.path), a.symbol), a, "binance-bookdepth", "book_depth_pct", DEPTH_KEY)


def make_bars(a) -> str:
    paths = sorted(glob.glob(a.path, recursive=True))
    if not paths:
        raise SystemExit(f"no files matched {a.path!r}")
    spark = build_session()
    reader = spark.read
    for path in paths:  # the keys in folder names are columns too, where files lie in a lake
        if "exchange=" in path:
            reader = reader.option("basePath", path.split("exchange=")[0])
            break
    bars = enrich.enriched_bars(reader.parquet(*paths), a.timeframe)
    if a.out is not None:
        return f"resample: {write_flat(bars, a.out)} bar(s) -> {a.out}"
    parts = Lake(spark, a.root).write(bars, "bars", "bar_timestamp_utc", merge_key=BAR_KEY)
    return f"resample: {parts} partition(s) under {a.root}/bars"


def run_sql(a) -> str:
    lake = Lake(build_session(), a.root)
    (lake.sql if a.dialect == "spark" else lake.duckdb_sql)(a.sql).show(a.limit, truncate=False)
    return ""


def make_report(a) -> str:
    text = report.quality_report(Lake(build_session(), a.root))
    if a.out is None:
        return text
    a.out.parent.mkdir(parents=True, exist_ok=True)
    a.out.write_text(text)
    return f"report: wrote -> {a.out}"


def make_sample(a) -> str:
    done = export_sample(Lake(build_session(), a.root), a.exchange, a.symbol, a.start, a.out, a.hours)
    return f"sample-export: {done.row_count} row(s) -> {done.csv_path}, {done.parquet_path}"


#: Options by name, then commands with their function and options; ``name!`` is required.
OPTIONS = {
    "market": {"choices": MARKETS, "default": "spot"},
    "execution-market": {"choices": EXECUTION_MARKETS, "default": "linear", "dest": "market"},
    "data-type": {"choices": DATA_TYPES, "default": "trades"},
    "symbol": {}, "pair": {}, "exchange": {}, "sql": {}, "dialect": {"choices": ("duckdb", "spark"), "default": "duckdb"},
    "start-month": {"type": a_month}, "end-month": {"type": a_month},
    "start-day": {"type": a_day}, "end-day": {"type": a_day}, "start-utc": {"type": a_utc_day},
    "rps": {"type": float, "default": 1.0}, "hours": {"type": int, "default": 24}, "limit": {"type": int, "default": 100},
    "path": {}, "glob": {}, "out": {"type": Path}, "root": {"default": str(GOLD)},
    "timeframe": {"choices": tuple(TIMEFRAMES), "default": "1m"},
}
FLAGS = {"execution-market": "market", "start-month": "start", "end-month": "end", "start-day": "start", "end-day": "end", "start-utc": "start", "glob": "path"}
COMMANDS = {
    "binance": (get_archives, "market symbol! data-type start-month! end-month!"),
    "bybit": (get_executions, "symbol! start-day! end-day!"),
    "kraken": (get_pages, "pair! start-day! end-day! rps"),
    "binance-bookdepth": (get_depth, "symbol! start-day! end-day!"),
    "normalize binance": (normalize_archives, "path! market symbol! data-type out root"),
    "normalize bybit": (normalize_executions, "path! symbol! execution-market out root"),
    "normalize kraken": (normalize_pages, "path! pair! out root"),
    "normalize binance-bookdepth": (normalize_depth, "path! symbol! out root"),
    "resample": (make_bars, "glob! timeframe out root"),
    "query": (run_sql, "root sql! limit dialect"),
    "report": (make_report, "root out"),
    "sample-export": (make_sample, "root exchange! symbol! start-utc! hours out!"),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tickloom", description=__doc__)
    top.add_argument("--concurrency", type=int, default=8)
    levels = {(): top.add_subparsers(required=True, metavar="command")}
    for name, (function, options) in COMMANDS.items():
        *above, last = name.split()
        if tuple(above) not in levels:
            levels[tuple(above)] = levels[()].add_parser(above[0]).add_subparsers(required=True, metavar="exchange")
        command = levels[tuple(above)].add_parser(last)
        command.set_defaults(function=function)
        for option in options.split():
            key = option.rstrip("!")
            command.add_argument("--" + FLAGS.get(key, key), required=option.endswith("!"), **OPTIONS[key])
    return top


def main(arguments: list[str] | None = None) -> None:
    a = parser().parse_args(arguments)
    if said := a.function(a):
        print(said)


if __name__ == "__main__":
    main()
