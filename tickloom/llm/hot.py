"""Joins whose keys may be hot, and numbers of partitions that follow the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text, or of arrays, that one task of a shuffle should meet; and the most partitions of one.
TASK_BYTES, MOST_PARTITIONS = 4 << 20, 20_000
#: A key is hot from so many rows, or from this share of all of them: so there are at most 1 / HOT_SHARE hot keys.
HOT_ROWS, HOT_SHARE = 1_000, 1e-5


def pieces(total: int | None, each: int = TASK_BYTES) -> int:
    """How many pieces of ``each`` make up ``total``; one at least."""
    return max(1, -(-int(total or 0) // each))


def partitions(total: int | None, each: int = TASK_BYTES) -> int:
    """The number of partitions for a shuffle of ``total`` bytes."""
    return min(pieces(total, each), MOST_PARTITIONS)


def spread(df: DataFrame) -> DataFrame:
    """df over as many tasks as the session has cores, where its files make fewer; a large input stays as it is read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts."""
    return int(docs.select(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0)


def hot_limit(rows: int) -> int:
    return max(HOT_ROWS, int(rows * HOT_SHARE))


def join_split(rows: DataFrame, named: DataFrame, on: list[str], uses: str, limit: int) -> DataFrame:
    """rows joined (inner) with ``named``, which has one row for each key, and in ``uses`` how many rows have it.

    Keys of over ``limit`` rows are broadcast, so their rows stay where they
    are; with the limit of ``hot_limit`` those are 1 / HOT_SHARE at most.  The
    others are joined as Spark sees fit.  rows is read twice: give a table.
    """
    hot = F.broadcast(named.where(F.col(uses) > limit))
    cold = rows.join(hot.select(*on), on, "left_anti").join(named.where(F.col(uses) <= limit), on)
    return rows.join(hot, on).unionByName(cold)
