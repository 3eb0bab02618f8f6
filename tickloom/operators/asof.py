"""As-of join: each left row with the latest right row not after it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, values: Sequence[str]) -> DataFrame:
    """left with ``values`` of the last right row of its keys with right.at <= left.at; null without one.

    Both sides go through one union and one window instead of a range join, so
    the cost does not grow with the number of matches.  Of right rows at one
    time the one with the largest values is taken.
    """
    own = [c for c in left.columns if c not in (*keys, at)]
    rows = left.select(*keys, at, F.lit(1).alias("__side"), F.struct(*own, F.lit(True).alias("__left")).alias("__row"), F.lit(None).cast(right.select(F.struct(*values)).schema[0].dataType).alias("__value"))
    quotes = right.select(*keys, at, F.lit(0).alias("__side"), F.lit(None).cast(rows.schema["__row"].dataType).alias("__row"), F.struct(*values).alias("__value"))
    window = Window.partitionBy(*keys).orderBy(at, "__side", "__value").rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.unionByName(quotes).withColumn("__value", F.last("__value", ignorenulls=True).over(window)).where("__side = 1")
    return joined.select(*keys, at, *[F.col(f"__row.{c}").alias(c) for c in own], *[F.col(f"__value.{v}").alias(v) for v in values])
