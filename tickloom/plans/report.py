"""The data quality report of a lake, in Markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.quality import gap_counts, trade_summary
from ..sources.lake import Lake


def _table(*rows: tuple) -> list[str]:
    head, *body = rows
    return [f"| {' | '.join(map(str, r))} |" for r in (head,)] + ["|" + "---|" * len(head)] + [f"| {' | '.join(map(str, r))} |" for r in body]


def _trades(df: DataFrame) -> list[str]:
    stats = trade_summary(df).orderBy("exchange", "symbol").collect()  # one row for each series
    head = ("Exchange", "Symbol", "Rows", "First Trade (UTC)", "Last Trade (UTC)", "Min Price", "Max Price", "Invalid Rows")
    return _table(head, *((r.exchange, r.symbol, f"{r.row_count:,}", r.first_trade_utc, r.last_trade_utc, f"{r.min_price:g}", f"{r.max_price:g}", r.invalid_rows) for r in stats))


def _gaps(df: DataFrame) -> list[str]:
    counts = gap_counts(df).orderBy("exchange", "symbol", "timeframe").collect()
    if not counts:
        return ["_No bars found._"]
    return _table(("Exchange", "Symbol", "Timeframe", "Missing Bars"), *((r.exchange, r.symbol, r.timeframe, r.missing_bars) for r in counts))


def quality_report(lake: Lake) -> str:
    """Rows, dates, prices and invalid rows of each series, and missing bars where there are bars."""
    tables, lines = lake.tables(), ["# Data Quality Summary", ""]
    if "trades" not in tables:
        return "\n".join([*lines, "_No `trades` dataset found under the lake root._"])
    lines += ["## Trades", "", *_trades(lake.read("trades"))]
    if "bars" in tables:
        lines += ["", "## Bar Gaps", "", *_gaps(lake.read("bars"))]
    return "\n".join(lines)
