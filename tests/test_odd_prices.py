"""Registered queries against their SQL on few events with prices that small data do not hold."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.test_queries import table
from tickloom.functions.numeric import ieee_ln, round_binary
from tickloom.operators.features import realized_volatility
from tickloom.plans.queries import QUERIES, SQL

#: Closes of 0, alone and two in a row, with a step that makes each a bar of every timeframe.
ZEROS = [3.0, 0.0, 5.0, 7.5, 0.0, 0.0, 2.0, *[1.5 + i % 3 for i in range(8)]]


def agrees(spark, tmp_path, name, values, step):
    rows = [(i, datetime(2024, 1, 1) + i * step, 3, "t", v, "{}") for i, v in enumerate(values)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    df, want = QUERIES[name](spark, str(tmp_path)), con.sql(SQL[name])
    want = table(want.columns, want.fetchall())
    assert table(df.columns, df.collect()) == want
    return want


def test_ieee_ln(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-0.0,), (-2.0,), (None,), (float("inf"),)], "x double")
    got = [r[0] for r in df.select(ieee_ln(df.x)).collect()]
    assert got[:3] == [0.0, float("-inf"), float("-inf")] and got[3] != got[3] and got[4:] == [None, float("inf")]


@pytest.mark.parametrize("name", ["enriched_bars_1m", "enriched_bars_1s", "realized_vol_w1", "realized_vol_w5"])
def test_zero_prices(spark, tmp_path, name):
    _, rows = agrees(spark, tmp_path, name, ZEROS, timedelta(minutes=5))
    assert {"nan", float("inf")} <= {v for r in rows for v in r}


def test_round_binary(spark):
    values = [65.6240625, 70.90656249999999, -65.6240625, 0.5e-6, -1e-9, 0.0, 1e300, 1e308, float("inf"), float("nan"), None, -2.5, 123456.7890125]
    rng = random.Random(4)
    values += [rng.randrange(1, 10**8) / rng.choice([16, 32, 64, 700, 1e6, 2e6]) for _ in range(2000)]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(round_binary(F.col("x"), 6)).collect()]
    con = duckdb.connect()
    want = [con.execute("SELECT round($1::DOUBLE, 6)", [v]).fetchone()[0] for v in values]
    assert [repr(v) for v in got] == [repr(v) for v in want]


def test_halves_of_the_sixth_digit(spark, tmp_path):
    """Bars of one trade each, whose vwap is its price."""
    prices = [65.6240625, 70.90656249999999, 32.2990625, *[(1000 * i + 985) / 16 / 1000 for i in range(40)]]
    agrees(spark, tmp_path, "enriched_bars_5m", prices, timedelta(minutes=5))


@pytest.mark.parametrize("n", [1, 5, 300])
def test_volatility_to_the_last_digit(spark, n):
    """The root of the exact sum, which a sum that rounds at each of 300 additions is not."""
    rng = random.Random(9)
    bars = spark.createDataFrame([("x", "y", i, rng.randrange(1, 50000) / 100) for i in range(900)], "exchange string, symbol string, at long, close double")
    r = F.ln("close") - F.ln(F.lag("close").over(Window.orderBy("at")))
    rows = realized_volatility(bars, n, "vol", "at").withColumn("r", r).orderBy("at").collect()
    assert rows[0].vol is None
    for i in range(1, len(rows)):
        assert rows[i].vol == math.sqrt(math.fsum(x.r * x.r for x in rows[max(1, i - n + 1) : i + 1]))


@pytest.mark.parametrize("values", [[1e300, 1e-300, 5.0, 5.0, 1e-300], [3.0, 3.0], [7.0]])
def test_volatility_of_far_prices(spark, tmp_path, values):
    agrees(spark, tmp_path, "realized_vol_w5", values, timedelta(minutes=1))
