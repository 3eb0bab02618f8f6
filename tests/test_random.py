"""Random trades: bars, windows, gaps and cleaning against plain Python."""

from __future__ import annotations

import math
import random
from collections import defaultdict
from datetime import UTC, datetime, timedelta
from statistics import mean, stdev

import pytest

from tickloom.operators.bars import resample
from tickloom.operators.features import bar_events, realized_volatility
from tickloom.operators.quality import bar_gaps, gap_counts
from tickloom.operators.trades import clean_trades
from tickloom.schemas import TRADES

EPOCH = datetime(1970, 1, 1)


def random_trades(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        p, q = rng.choice([rng.uniform(1, 200), -1.0, None, 5.0]), rng.choice([float(rng.randrange(1, 9)), 0.0, 2.0])
        t = rng.choice([rng.randrange(-600_000_000, 1_800_000_000), None])
        rows.append((rng.choice("xy"), "spot", rng.choice(["A", "B"]), t, rng.choice([str(rng.randrange(250)), None]), p, q, None if p is None else p * q, rng.choice(["buy", "sell"]), None))
    return rows


def cleaned(rows):
    best = {}
    for r in rows:
        if r[3] is not None and r[4] is not None and r[5] is not None and r[5] > 0 and r[6] > 0:
            key = (r[0], r[2], r[4])
            order = (r[3], r[1], r[5], r[6], r[7], r[8])
            if key not in best or order < best[key][0]:
                best[key] = (order, (*r[:9], False))
    return [v for _, v in best.values()]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_plain_python(spark, seed):
    rows = random_trades(seed)
    trades = clean_trades(spark.createDataFrame(rows, TRADES)).cache()
    want = cleaned(rows)
    assert sorted(tuple(r) for r in trades.collect()) == sorted(want)

    width = 60_000_000
    groups = defaultdict(list)
    for r in want:
        groups[r[0], r[2], r[3] // width * width].append(r)
    bars = resample(trades, "1m").cache()
    got = {(r.exchange, r.symbol, (r.bar_timestamp_utc - EPOCH) // timedelta(microseconds=1)): r for r in bars.collect()}
    assert set(got) == set(groups)
    for key, own in groups.items():
        own.sort(key=lambda r: (r[3], r[4]))
        b = got[key]
        assert (b.open, b.close, b.trade_count) == (own[0][5], own[-1][5], len(own))
        assert (b.high, b.low) == (max(r[5] for r in own), min(r[5] for r in own))
        assert b.volume_base == pytest.approx(sum(r[6] for r in own))
        assert b.vwap == pytest.approx(sum(r[5] * r[6] for r in own) / sum(r[6] for r in own))
        assert b.volume_delta == pytest.approx(sum(r[6] * (1 if r[8] == "buy" else -1) for r in own))

    series = defaultdict(list)
    for (e, s, t), b in sorted(got.items()):
        series[e, s].append((t, b))
    rows = {(r.exchange, r.symbol, r.bar_timestamp_utc): r for r in realized_volatility(bar_events(bars), 5, "vol").collect()}
    missing = set()
    for (e, s), own in series.items():
        for i, (t, b) in enumerate(own):
            r = rows[e, s, b.bar_timestamp_utc]
            closes = [x.close for _, x in own[max(0, i - 5) : i + 1]]
            returns = [math.log(y / x) ** 2 for x, y in zip(closes, closes[1:], strict=False)]
            assert r.vol is None if not returns else r.vol == pytest.approx(math.sqrt(sum(returns)))
            before = [x.volume_base for _, x in own[max(0, i - 20) : i]]
            if len(before) < 2:
                assert r.volume_zscore is None and not r.is_volume_surge
            elif stdev(before) > 0:
                assert r.volume_zscore == pytest.approx((b.volume_base - mean(before)) / stdev(before), abs=1e-9)
            if i:
                assert r.price_change_pct == pytest.approx((b.close / own[i - 1][1].close - 1) * 100)
        have = {t for t, _ in own}
        missing |= {(e, s, t) for t in range(own[0][0], own[-1][0], width) if t not in have}
    gaps = {(r.exchange, r.symbol, int(r.missing_bar_utc.replace(tzinfo=UTC).timestamp()) * 1_000_000) for r in bar_gaps(bars, "1m").collect()}
    assert gaps == missing
    assert sum(r.missing_bars for r in gap_counts(bars).collect()) == len(missing)
