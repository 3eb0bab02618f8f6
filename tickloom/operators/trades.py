"""Cleaning and identity of trades."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import TRADE_KEY, TRADES


def first_of_key(df: DataFrame, key: Sequence[str] = TRADE_KEY, order: Sequence[str] = ("timestamp_utc",)) -> DataFrame:
    """One row of each key: the first by ``order``, then by all other columns, so that reruns agree."""
    rest = [c for c in df.columns if c not in (*key, *order)]
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order, *rest))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def clean_trades(df: DataFrame) -> DataFrame:
    """The trade table of rows that may be of any types.

    What cannot be read as its type is null.  Rows without time or id, or with
    a price or quantity that is not positive, go; of rows with one key the
    earliest stays.  A missing liquidation flag is false.
    """
    typed = df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in TRADES.fields])
    typed = typed.withColumn("is_liquidation", F.coalesce("is_liquidation", F.lit(False)))
    valid = typed.where("timestamp_utc IS NOT NULL AND trade_id IS NOT NULL AND price > 0 AND quantity > 0")
    return first_of_key(valid)


def merge_rows(existing: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of both with one of each key: the new one, of several new ones the last by its other columns.

    Columns that only one side has are null on the other.
    """
    both = existing.withColumn("__age", F.lit(1)).unionByName(new.withColumn("__age", F.lit(0)), allowMissingColumns=True)
    rest = [F.col(c).desc_nulls_last() for c in both.columns if c not in (*key, "__age")]
    rank = F.row_number().over(Window.partitionBy(*key).orderBy("__age", *rest))
    return both.withColumn("__rank", rank).where("__rank = 1").drop("__rank", "__age")


def price_anomalies(trades: DataFrame) -> DataFrame:
    """Trades that cleaning would drop: no time, or price or quantity not positive."""
    return trades.where("price <= 0 OR quantity <= 0 OR timestamp_utc IS NULL")
