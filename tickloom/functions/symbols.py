"""Unified BASE-QUOTE symbols from the exchanges' own."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Quote assets in the order in which they are tried.
QUOTES = ("USDT", "USDC", "BUSD", "TUSD", "FDUSD", "USD", "EUR", "GBP", "BTC", "ETH")
#: Legacy asset codes of one exchange and what they stand for.
LEGACY = {
    "XXBT": "BTC", "XXDG": "DOGE", "XETH": "ETH", "XBT": "BTC", "XDG": "DOGE",
    "ZUSD": "USD", "ZEUR": "EUR", "ZGBP": "GBP", "ZJPY": "JPY", "ZCAD": "CAD",
}
LEGACY_EXCHANGE = "kraken"

_codes = "|".join(sorted(LEGACY, key=len, reverse=True))
_LEGACY_PAIR = re.compile(rf"^({_codes})({_codes})?")
#: The quote tried first wins, so each alternative must not end in one before it.
_SPLIT = [re.compile(rf"^(.+)({q})$", re.S) for q in QUOTES]


def unify_symbol(raw: str, exchange: str) -> str:
    """BASE-QUOTE of a raw symbol; unchanged but for case where no known quote ends it."""
    symbol = raw.upper()
    if exchange == LEGACY_EXCHANGE:
        symbol = _LEGACY_PAIR.sub(lambda m: LEGACY[m[1]] + LEGACY.get(m[2] or "", ""), symbol)
    if re.search("[-/]", symbol):
        base, quote = re.split("[-/]", symbol, maxsplit=1)
        return f"{base}-{quote.replace('/', '-')}"
    return next((f"{m[1]}-{m[2]}" for m in (p.match(symbol) for p in _SPLIT) if m), symbol)


def unified_symbol(raw: Column, exchange: Column) -> Column:
    """unify_symbol as an expression, for columns of symbols."""
    upper = F.upper(raw)
    code = F.regexp_extract(upper, f"^({_codes})({_codes})?", 1)
    second = F.regexp_extract(upper, f"^({_codes})({_codes})?", 2)
    names = F.create_map(*[F.lit(x) for pair in {**LEGACY, "": ""}.items() for x in pair])
    modern = F.concat(names[code], names[second], F.substring(upper, F.length(code) + F.length(second) + 1, F.length(upper)))
    symbol = F.when(exchange.eqNullSafe(LEGACY_EXCHANGE), modern).otherwise(upper)
    out = F.when(symbol.rlike("[-/]"), F.replace(symbol, F.lit("/"), F.lit("-")))
    for q in QUOTES:
        out = out.when(symbol.endswith(q) & (F.length(symbol) > len(q)), F.concat(F.substring(symbol, F.lit(1), F.length(symbol) - len(q)), F.lit(f"-{q}")))
    return out.otherwise(symbol)
