"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed pseudo-random number h of 60 bits.  What a source
must give beyond whole copies of itself is a budget, and the documents with h
below the source's threshold give it.  The threshold is found without sorting
documents: sizes are summed by source and leading digit of h, the bucket in
which the running sum passes the budget is the boundary, and only its rows are
summed again by the next digit.  After the last digit one value of h is left,
which is taken if that brings the sum nearer to the budget.

Each round shuffles one row per source and bucket and task at most.  Thresholds
are nested: a larger budget keeps every document of a smaller one.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .hot import hot_limit
from .scratch import Scratch
from .text import n_words

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
DIGITS, DIGIT_BITS = 6, 10


def document_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of doc_id and text, so that rows of one doc_id are taken each for itself."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and h of every row."""
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), document_hash(F.col("doc_id"), F.col("text")).alias("h"))


def _side(df: DataFrame) -> DataFrame:
    """df with the source as two columns that joins and groups take without nulls."""
    return df.withColumns({"named": F.col("source").isNotNull(), "name": F.coalesce("source", F.lit(""))})


ON = ["named", "name"]
#: Places over which documents of a hot source are dealt in joins.
SALTS = 64


def _salted(rows: DataFrame, per: DataFrame, limit: int) -> DataFrame:
    """rows with a salt: one of SALTS for documents of sources of over ``limit`` rows, of which there are few; else 0."""
    hot = F.broadcast(per.where(F.col("n") > limit).select(*ON, F.lit(True).alias("hot")))
    return rows.join(hot, ON, "left").withColumn("salt", F.when(F.col("hot"), F.pmod("h", F.lit(SALTS)).cast("int")).otherwise(0)).drop("hot")


def _spread(per: DataFrame, limit: int) -> DataFrame:
    """Rows of sources for each salt that their documents have."""
    return per.withColumn("salt", F.explode(F.when(F.col("n") > limit, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))


def _ranked(per: DataFrame, scratch: Scratch) -> DataFrame:
    """per with ``turn``, the number of each source in code point order, null last, from 0.

    Sources may be web hosts: they are sorted over tasks, and only how many
    each task has is gathered.
    """
    order = F.col("source").asc_nulls_last()
    rows = per.repartitionByRange(order).sortWithinPartitions(order).withColumn("at", F.monotonically_increasing_id())
    rows = scratch.save(rows, "ranked")
    task = F.shiftright("at", 33).cast("int")
    counts = sorted(tuple(r) for r in rows.groupBy(task.alias("task")).count().collect())  # one row for each task
    before, total = [], 0
    for _, n in counts:
        before.append(total)
        total += n
    before = pa.table([pa.array([k for k, _ in counts], pa.int32()), pa.array(before, pa.int64())], ["task", "before"])
    before = F.broadcast(rows.sparkSession.createDataFrame(before))  # from a list it would start Python workers
    return rows.withColumn("task", task).join(before, "task").withColumn("turn", F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("task", "before", "at")


def targets(sizes: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, n (rows) and target of every source.

    Shares follow the weights, which the sources take in turn in code point
    order, null last.  A share stops at ``most`` times its source and the
    excess goes to the others by weight, until none is above.  Each round is
    one sum over the sources.
    """
    per = _ranked(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")), scratch)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("turn") % len(weights) + 1).cast("int")).cast("long"))
    per = scratch.save(per, "sources")
    big = lambda c: c.cast("decimal(19,0)")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    left, rest, n_open, is_open = total, None, None, F.lit(True)
    while True:
        closed = F.coalesce(F.sum(F.when(~is_open, F.col("source_size") * most)), F.lit(0))
        spent, others, count = per.select(closed, F.coalesce(F.sum(F.when(is_open, F.col("weight"))), F.lit(0)), F.count(F.when(is_open, 1))).first()
        left, rest = total - spent, others
        if count == n_open or not count:
            break
        n_open = count
        is_open = big(F.lit(left).cast("long") * F.col("weight")) < big(F.col("source_size") * most) * big(F.lit(rest).cast("long"))
    share = (F.lit(left).cast("long") * F.col("weight")).cast("double") / F.lit(max(rest, 1)).cast("double")
    target = F.when(is_open, share).otherwise((F.col("source_size") * most).cast("double"))
    return per.select("source", "source_size", "n", target.alias("target"), is_open.alias("open"))


def thresholds(sizes: DataFrame, per: DataFrame, limit: int) -> DataFrame:
    """per with copies (whole ones of every document) and limit: h below it gives one copy more; 0 for closed sources."""
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    per = _side(per.withColumn("copies", copies))
    budget = (F.col("target") - F.col("copies") * F.col("source_size")).alias("budget")
    bounds = per.where("open and source_size > 0").select(*ON, "n", F.lit(0).cast("long").alias("prefix"), budget)
    sizes = _salted(_side(sizes), per, limit)
    for digit in range(1, DIGITS + 1):
        shift = DIGIT_BITS * (DIGITS - digit)
        inside = sizes.join(_spread(bounds, limit), [*ON, "salt"]).where(F.shiftright("h", shift + DIGIT_BITS) == F.col("prefix"))
        buckets = inside.groupBy(*ON, "n", "budget", F.shiftright("h", shift).alias("prefix")).agg(F.sum("size").alias("m"))
        by = Window.partitionBy(*ON).orderBy("prefix")
        bounds = (
            buckets.withColumn("reached", F.sum("m").over(by)).where("reached > budget").withColumn("first", F.row_number().over(by)).where("first = 1")
            .select(*ON, "n", "prefix", "m", (F.col("budget") - F.col("reached") + F.col("m")).alias("budget"))
        )
    found = bounds.select(*ON, (F.col("prefix") + (F.col("budget") * 2 > F.col("m")).cast("long")).alias("limit"))
    return per.join(found, ON, "left").withColumn("limit", F.coalesce("limit", F.lit(0)))


def _plan(sizes: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """The thresholds as a table, whose size Spark knows when it plans the join with documents; and from how many rows a source is hot."""
    limit = hot_limit(sizes.count())
    return scratch.save(thresholds(sizes, targets(sizes, scratch), limit).drop("source"), "plan"), limit


def mix_sources(sizes: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, source, size, source_size, target, n_copies and taken of every row of ``sized``, a table.

    Empty texts and sources without words take part with size 0.  Rows that
    repeat in doc_id and text share h and are taken together.
    """
    plan, limit = _plan(sizes, scratch)
    joined = _salted(_side(sizes), plan, limit).join(_spread(plan, limit), [*ON, "salt"]).drop("salt")
    n = (F.col("copies") + (F.col("h") < F.col("limit")).cast("long")).alias("n_copies")
    return joined.select("doc_id", "source", "size", "source_size", "target", n).withColumn("taken", F.col("size") * F.col("n_copies"))


def mixed_rows(docs: DataFrame, sizes: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of docs, each as often as the mix takes it: three times at most.  Columns of any name pass through.

    sizes: ``sized(docs)`` as a table.
    """
    plan, limit = _plan(sizes, scratch)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = _side(rows.withColumns({"source": F.col("row.source"), "h": document_hash(F.col("row.doc_id"), F.col("row.text"))}))
    joined = _salted(rows, plan, limit).join(_spread(plan, limit), [*ON, "salt"])
    n = (F.col("copies") + (F.col("h") < F.col("limit")).cast("long")).cast("int")
    taken = joined.select("row", n.alias("n")).where("n > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*")
