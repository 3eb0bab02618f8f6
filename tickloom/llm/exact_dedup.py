"""Exact deduplication by deterministic block naming.

The normalised text is cut into fixed-size blocks.  Blocks that occur more
than once are sorted and numbered; the number is the block's name.  Adjacent
names are then paired, repeated pairs are sorted and numbered in turn, and so
on until every document has one name.  Equal names at equal level mean equal
texts, with no reliance on hashes being free of collisions.

A block or pair that occurs once in the whole table needs no name: its document
is like no other and leaves the rounds at once.  Only names (16 bytes) travel
after the first round, and every count is combined before its shuffle, so a
text that a third of all documents share costs a few rows, and where rows meet
the names of hot parts, those are broadcast (see ``hot``).  A document of b
blocks takes log2(b) rounds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hot import hot_limit, join_split
from .scratch import Scratch
from .text import SPACES

BLOCK_BYTES = 4096
#: Blocks are sorted by so many first bytes, then by digest, then whole.
HEAD_BYTES = 32


def normalised(text: Column) -> Column:
    """The text without the characters ``[\\x20\\x09-\\x0D]``; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for space in SPACES:
        out = F.replace(out, F.lit(space), F.lit(""))
    return out


def _numbered(rows: DataFrame, ranges: list[str], *rest: str) -> DataFrame:
    """The rows in the order of ranges and rest with a number each; unique, not gapless.

    Bounds of ranges are sampled to the driver, so those columns are short.
    """
    return rows.repartitionByRange(*ranges).sortWithinPartitions(*ranges, *rest).withColumn("name", F.monotonically_increasing_id())


def _whole(named: DataFrame) -> DataFrame:
    """Documents all of whose n parts have names, with the names in order."""
    return (
        named.groupBy("rid", "n")
        .agg(F.array_sort(F.collect_list(F.struct("i", "name"))).alias("parts"))
        .where(F.size("parts") == F.col("n"))
        .select("rid", F.col("parts.name").alias("names"))
    )


def _block_names(base: DataFrame, scratch: Scratch, block_bytes: int, digest: Callable[[Column], Column]) -> DataFrame:
    """rid, names of documents all of whose blocks occur elsewhere too.

    Occurrences meet the names by a short digest of the block.  A digest that
    two different blocks share is found in the counts, and those blocks (none,
    as a rule) meet by their bytes.
    """
    body = normalised(F.col("row.text")).cast("binary")
    n = F.greatest(F.ceil(F.octet_length(F.col("body")) / F.lit(block_bytes)), F.lit(1)).cast("int")
    blocks = (
        base.select("rid", body.alias("body"))
        .select("rid", "body", n.alias("n"))
        .select("rid", "n", "body", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
        .select("rid", "n", "i", F.substring("body", F.col("i") * block_bytes + 1, F.lit(block_bytes)).alias("block"))
        .select("rid", "n", "i", "block", digest(F.col("block")).alias("h"))
    )
    counts = blocks.groupBy("h", "block").agg(F.count(F.lit(1)).alias("c"))
    counts = scratch.save(counts.select("h", "c", F.when(F.col("c") > 1, F.col("block")).alias("block")), "counts")
    repeated = counts.where("c > 1").select("h", "c", "block", F.substring("block", 1, HEAD_BYTES).alias("head"))
    names = scratch.save(_numbered(repeated, ["head", "h"], "block").drop("head"), "names")
    clash = counts.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("h")
    clash = scratch.save(clash, "clash")
    parts, clean = scratch.save(blocks.drop("block"), "parts"), clash.isEmpty()
    alone = names if clean else names.join(clash, "h", "left_anti")
    named = join_split(parts, alone.select("h", "c", "name"), ["h"], "c", hot_limit(parts.count())).select("rid", "n", "i", "name")
    if not clean:
        again = blocks.join(clash, "h", "left_semi").join(names, ["h", "block"])
        named = named.unionByName(again.select("rid", "n", "i", "name"))
    return _whole(named)


def _identities(base: DataFrame, scratch: Scratch, block_bytes: int, digest: Callable[[Column], Column]) -> DataFrame:
    """rid, level, name; equal level and name: equal texts.  Documents without a row are alone."""
    done, level, n_rows = [], 0, base.count()
    current = scratch.save(_block_names(base, scratch, block_bytes, digest), "level0")
    while True:
        done.append(current.where(F.size("names") == 1).select("rid", F.lit(level).alias("level"), F.col("names")[0].alias("name")))
        current = current.where(F.size("names") > 1)
        if current.isEmpty():
            break
        level += 1
        n = F.ceil(F.size("names") / F.lit(2)).cast("int")
        pairs = (
            current.select("rid", n.alias("n"), "names", F.explode(F.sequence(F.lit(0), n - 1)).alias("i"))
            .select("rid", "n", "i", F.get("names", F.col("i") * 2).alias("a"), F.coalesce(F.get("names", F.col("i") * 2 + 1), F.lit(-1)).alias("b"))
        )
        names = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        names = scratch.save(_numbered(names, ["a", "b"]), f"pairs{level}")
        named = join_split(pairs, names, ["a", "b"], "c", hot_limit(n_rows)).select("rid", "n", "i", "name")
        current = scratch.save(_whole(named), f"level{level}")
    out = done[0]
    for rows in done[1:]:
        out = out.unionByName(rows)
    return out


def exact_dedup(
    docs: DataFrame,
    scratch: Scratch,
    block_bytes: int = BLOCK_BYTES,
    digest: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """Every row of docs with the group of equal texts that it belongs to.

    docs has doc_id and text; other columns pass through.  Returns row (a
    struct of all of them), keep_id, group_size, kept and text_sha256.

    Texts are equal when they are after deleting ``[\\x20\\x09-\\x0D]``.  Of equal
    texts the row with the most code points, then the smallest doc_id (null
    last), then an arbitrary one of rows that agree in both, is kept; exactly
    one row of a group is.  Null text counts as empty.  An empty table gives an
    empty result.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    text = F.col("row.text")
    base = docs.select(F.struct(*columns).alias("row")).select("row", F.monotonically_increasing_id().alias("rid"))
    base = base.select(
        "rid", "row", F.length(F.coalesce(text, F.lit(""))).alias("points"), F.unhex(F.sha2(normalised(text).cast("binary"), 256)).alias("sha")
    )
    base = scratch.save(base, "base")
    identity = scratch.save(_identities(base, scratch, block_bytes, digest), "identity")
    order = F.struct(-F.col("points"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("rid"))
    members = identity.join(base.select("rid", "points", F.col("row.doc_id").alias("doc_id")), "rid")
    groups = members.groupBy("level", "name").agg(F.count(F.lit(1)).alias("group_size"), F.min(order).alias("best")).where("group_size > 1")
    groups = groups.select("level", "name", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.rid").alias("keep_rid"))
    groups = scratch.save(groups, "groups")
    found = join_split(identity, groups, ["level", "name"], "group_size", hot_limit(identity.count()))
    found = scratch.save(found.select("rid", "group_size", "keep_id", "keep_rid"), "found")
    alone = F.col("keep_rid").isNull()
    return base.join(found, "rid", "left").select(
        "row",
        F.when(alone, F.col("row.doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("keep_rid") == F.col("rid"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
