"""Similarity join of documents on word shingles, by signature trees.

Trees compare the documents of one group; which documents can meet at all is
settled before, without losing a pair.

1.  A document's set is its distinct shingles, each as 128 bits that are made
    of its words' BLAKE2b.  The BLAKE2b of the sorted set is its identity (124
    bits); documents of equal identity are compared once.
2.  Hash space is dealt into parts.  Two sets that are similar enough differ in
    at most D elements, so of the first D + 1 parts that are not empty in one of
    them, one is the same in both.  Those parts are a document's keys.  Parts
    hold about four elements, so a passage that many texts share makes a key
    only where nothing else falls into the part.  The number of parts follows
    from the size class, and a document has keys for its own class and for that
    of a smaller partner.  Should a document have too few parts that are not
    empty, all keys are made again with more parts.
3.  Keys travel packed, as rows of raw arrays.  Those that several identities
    have are named by these, so that keys of the same sets are one, and joined by trees over bitmaps: what is left are the pairs that may
    be similar, as links that connect families.
4.  Families are joined by trees with exact overlaps of the full sets.
5.  Links are made into components.

No group has to fit a task.  A large one is dealt into tiles that are joined
each for itself, which connects near copies.  Then only members that are not
yet connected with most of their key meet its other tiles, so a family of m near
copies costs m rows, and what is compared across tiles is what is still apart.
Hashes of 64 bits only propose; overlaps are counted on all 128 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import packing
from .components import components
from .hot import hot_limit, join_split, partitions, pieces, text_bytes
from .scratch import Scratch
from .signature_tree import bitmaps, linked_pairs, similar_sets, words_for
from .text import LAST, U64, WORD, Words, binary_text, chained, gives_back, keyed, mix64, slices

SHINGLE, PERCENT = 4, 85
CHUNK_BYTES = 1 << 20
#: Bytes of text for each bucket of keys; groups are dealt over as many buckets as hot.TASK_BYTES asks for.
BUCKET_BYTES = 16 << 20
#: Bytes of a key beside its bucket.  Keys that collide cost a comparison, no result.
KEY_BYTES = 6
#: Bits for each element in the bitmaps that meet at keys.
SKETCH_BITS = 2
#: The probability, for each document, that it has too few parts to be sure of a key; each further try takes MISS times it.
MISS = 1e-15
#: The largest group that one task joins, in members and in elements of all sets; and a tile of a larger one.
GROUP_MEMBERS, GROUP_ELEMENTS, TILE = 1000, 4_000_000, 500
#: Keys that a set has at one address; sets of more keys have several, so that no address is hot for its length.
ADDRESS_KEYS = 1000
SID = "decimal(38,0)"


def shingle_sets(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of all rows of a batch, one row after the other, and how many each row has.

    A shingle is two uint64.  A text of fewer words than ``width`` has its
    whole sequence as its only shingle.
    """
    words = Words(*binary_text(batch.column("text")), lower=True)
    a, b = words.digests
    first = words.runs(width)
    low, high, row = [chained(a, width, 1)[first]] if len(first) else [], [chained(b, width, 2)[first]] if len(first) else [], [words.row[first]]
    for n in range(1, width):
        short = np.flatnonzero(words.counts == n)
        if len(short):
            at = words.bounds[short]
            low.append(chained(a, n, 1)[at])
            high.append(chained(b, n, 2)[at])
            row.append(short)
    if not low:
        return np.zeros((0, 2), U64), np.zeros(words.rows, np.int64)
    h, high, row = np.concatenate(low), np.concatenate(high), np.concatenate(row)
    order = np.lexsort((h, row))
    h, high, row = h[order], high[order], row[order]
    same = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    if (high[1:] != high[:-1])[same].any():
        order = np.lexsort((high, h, row))
        h, high, row = h[order], high[order], row[order]
        same = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    new = np.r_[True, ~same | (high[1:] != high[:-1])]
    return np.stack([h[new], high[new]], 1), np.bincount(row[new], minlength=words.rows)


def identities(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """124 bits, as two uint64, that tell sets apart; zeros where empty."""
    ends, data = np.cumsum(n) * 16, np.ascontiguousarray(h).tobytes()
    found = [blake2b(data[e - 16 * k : e], digest_size=16).digest() if k else bytes(16) for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
    out = np.frombuffer(b"".join(found), U64).reshape(-1, 2).copy()
    out[:, 1] &= U64((1 << 60) - 1)
    return out


def _decimals(values: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.decimal128(38, 0), len(values), [None, pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def _numbers(column: pa.ChunkedArray) -> tuple[np.ndarray, list]:
    """Decimals as numbers from 0 in their order, and the decimals."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    found = column.dictionary_encode()
    return found.indices.to_numpy(), found.dictionary


def difference(n, percent: int):
    """The most elements in which a set of n elements and a similar one, of any size, can differ."""
    return n * (100 - percent) // percent


def difference_from_smaller(n, percent: int):
    """The same where the other set is not larger."""
    return n * 2 * (100 - percent) // (100 + percent)


def _log_chance(parts: int, most: int, n: int) -> float:
    """Bound on the log of the chance that n elements fall into at most ``most`` of the parts."""
    if most <= 0:
        return -math.inf
    if most >= parts:
        return 0.0
    return math.lgamma(parts + 1) - math.lgamma(most + 1) - math.lgamma(parts - most + 1) + n * math.log(most / parts)


@lru_cache(maxsize=8)
def size_classes(percent: int, miss: float = MISS, largest: int = 1 << 31) -> tuple[np.ndarray, np.ndarray]:
    """The smallest size of each class and its number of parts; 0 parts: every element is one.

    A class spans sizes that may be similar, so a partner is of the same class
    or the next.  It has as few parts as leave every document with one part
    more than it may differ in, but for a chance of ``miss``.
    """
    lows, parts = [1], []
    while lows[-1] < largest:
        low = lows[-1]
        high = max(low + 1, low * 100 // percent)
        checks = [(n, difference(n, percent)) for n in {low, (low + high) // 2, high - 1}]
        checks += [(n, difference_from_smaller(n, percent)) for n in {high - 1, (high - 1) * 100 // percent}]
        few, many = 1, low
        while few < many:
            middle = (few + many) // 2
            if all(_log_chance(middle, most, n) <= math.log(miss) for n, most in checks):
                many = middle
            else:
                few = middle + 1
        parts.append(few if few < low else 0)
        lows.append(high)
    return np.array(lows), np.array(parts)


def keys(h: np.ndarray, n: np.ndarray, percent: int, miss: float = MISS) -> tuple[np.ndarray, np.ndarray, bool]:
    """Keys of all sets (of 64-bit elements) and the row of each, and whether some set has too few parts to be sure of one.

    None at 100 percent, where only equal sets are similar.
    """
    if percent == 100:
        return np.zeros(0, U64), np.zeros(0, np.int64), False
    lows, parts = size_classes(percent, miss)
    short = False
    row = np.repeat(np.arange(len(n)), n)
    own, other = (np.searchsorted(lows, size, "right") - 1 for size in (n, -(-n * percent // 100)))
    out_key, out_row = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    for which, wanted, most in ((own, n > 0, difference(n, percent)), (other, (n > 0) & (other < own), difference_from_smaller(n, percent))):
        use = wanted[row]
        e, r = h[use], row[use]
        if not len(e):
            continue
        k = parts[which][r].astype(U64)
        part = np.where(k == 0, e, e % np.maximum(k, U64(1)))
        # Sets with a part for every element have the same keys in all classes.
        salt = np.where(k == 0, 0, which[r] + 1).astype(U64)
        order = np.lexsort((part, r))
        e, r, part, salt = e[order], r[order], part[order], salt[order]
        begins = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (part[1:] != part[:-1])])
        value = mix64(np.add.reduceat(mix64(e ^ U64(0x8EBC6AF09C88C6E3)), begins) + (part[begins] + U64(1)) * U64(0x589965CC75374CC3) + salt[begins] * U64(0x1D8E4E27C47D124F))
        r = r[begins]
        short |= bool(((np.bincount(r, minlength=len(n)) <= most) & (parts[which] > 0))[wanted].any())  # all elements as parts suffice
        first = np.arange(len(r)) - np.searchsorted(r, r) <= most[r]
        out_key.append(value[first])
        out_row.append(r[first])
    return np.concatenate(out_key), np.concatenate(out_row), short


_ROWS = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("digest", pa.int64()), ("n", pa.int64()), ("sid", pa.decimal128(38, 0)), ("sketch", pa.binary()), ("addresses", pa.list_(pa.int64())), ("bucket", pa.int32()), ("payload", pa.binary())])
ROWS_DDL = f"doc_id long, key long, digest long, n long, sid {SID}, sketch binary, addresses array<long>, bucket int, payload binary"
#: The bucket of a row that says that a set had too few parts.
SHORT = -1


def _addresses(sid: np.ndarray, most_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the keys of each set are sent from: one address for every ADDRESS_KEYS; and how many each set has."""
    each = most_keys // ADDRESS_KEYS + 1
    which = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    return mix64(np.repeat(sid[:, 0], each) + which.astype(U64) * U64(0x9E3779B97F4A7C15)), each


@gives_back
def _documents(batches: Iterator[pa.RecordBatch], width: int, percent: int, miss: float, buckets: int) -> Iterator[pa.RecordBatch]:
    """A row for each document, and the keys of a chunk as a row for each bucket."""
    for batch in slices(batches, CHUNK_BYTES):
        both, n = shingle_sets(batch, width)
        h, sid = np.ascontiguousarray(both[:, 0]), identities(both, n)
        sketches = bitmaps(h, n, words_for(n, SKETCH_BITS))
        address, each = _addresses(sid, 2 * difference(n, percent) + 2)
        cuts = np.r_[0, np.cumsum(each)]
        own = [*(batch.column(c) for c in ("doc_id", "key", "digest")), pa.array(n, pa.int64()), _decimals(sid), pa.array([s.tobytes() for s in sketches], pa.binary())]
        own += [pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(address.view(np.int64))), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())]
        yield pa.RecordBatch.from_arrays(own, schema=_ROWS)
        once = np.zeros(len(n), bool)
        once[np.unique(sid, axis=0, return_index=True)[1]] = True  # copies within a chunk count once
        once &= n > 0
        key, row, short = keys(h[np.repeat(once, n)], n[once], percent, miss)
        rows = [(SHORT, b"")] if short else []
        if len(key):
            order = np.argsort(row, kind="stable")
            row = row[order]
            at = cuts[np.flatnonzero(once)[row]] + (np.arange(len(row)) - np.searchsorted(row, row)) // ADDRESS_KEYS
            rest, by, deals = packing.dealt(key[order], buckets)
            for b, i, j in deals:
                there, per = np.unique(at[by[i:j]], return_counts=True)
                rows.append((b, packing.join(packing.short(rest[by[i:j]], KEY_BYTES), address[there].tobytes(), packing.planes(per.astype(np.uint32)))))
        if rows:
            none = [pa.nulls(len(rows), f.type) for f in list(_ROWS)[:7]]
            yield pa.RecordBatch.from_arrays([*none, pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], schema=_ROWS)


_SHARED = pa.schema([("key", pa.int64()), ("address", pa.int64())])


@gives_back
def _shared(table: pa.Table) -> pa.Table:
    """key and address, of keys that several addresses have.

    A key is named by its addresses, so keys of the same members become one and
    a family meets once, not for each of its keys.  Different ones that share a
    name meet together, which costs comparisons and loses no pair.
    """
    parts = [packing.split(p) for p in table.column("payload").to_pylist()]
    key = np.concatenate([packing.from_short(p[0], KEY_BYTES) for p in parts])
    address = np.concatenate([np.repeat(np.frombuffer(p[1], np.int64), packing.from_planes(p[2], np.uint32)) for p in parts])
    order = np.argsort(key)
    again = key[order][1:] == key[order][:-1]
    order = order[np.r_[again, False] | np.r_[False, again]]
    key, address = key[order], address[order]
    order = np.lexsort((address, key))
    key, address = key[order], address[order]
    if len(key):
        new = np.r_[True, (key[1:] != key[:-1]) | (address[1:] != address[:-1])]
        key, address = key[new], address[new]
        begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        each = np.diff(np.r_[begins, len(key)])
        several = np.repeat(each > 1, each)
        address, each = address[several], each[each > 1]
    if not len(address):
        return _SHARED.empty_table()
    name = np.repeat(mix64(np.add.reduceat(mix64(address.view(U64)), np.cumsum(each) - each)), each).view(np.int64)
    order = np.lexsort((address, name))
    name, address = name[order], address[order]
    new = np.r_[True, (name[1:] != name[:-1]) | (address[1:] != address[:-1])]
    return pa.Table.from_arrays([pa.array(name[new]), pa.array(address[new])], schema=_SHARED)


_LINKS = pa.schema([("a", pa.decimal128(38, 0)), ("b", pa.decimal128(38, 0))])
LINKS_DDL = f"a {SID}, b {SID}"


def stars(pairs: list[tuple[int, int]], rank: np.ndarray) -> np.ndarray:
    """Pairs that connect the same, each of a node and the node of the least rank that it is connected with.

    Groups of one family link it in many ways; as stars these are mostly the
    same links, so a family costs about a link for each member, not for each key.
    """
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            root[x if rank[y] < rank[x] else y] = y if rank[y] < rank[x] else x
    return np.array([(find(x), x) for x in root if find(x) != x], np.int64).reshape(-1, 2)


def _links(pairs: list[tuple[int, int]], sids: pa.Array) -> pa.Table:
    lanes = np.frombuffer(sids.buffers()[1], U64).reshape(-1, 2)[sids.offset : sids.offset + len(sids)] if len(sids) else np.zeros((0, 2), U64)
    rank = np.empty(len(sids), np.int64)
    rank[np.lexsort((lanes[:, 0], lanes[:, 1]))] = np.arange(len(sids))
    found = stars(pairs, rank)
    return pa.Table.from_arrays([sids.take(pa.array(found[:, 0])), sids.take(pa.array(found[:, 1]))], schema=_LINKS)


def _by_group(group: np.ndarray, member: np.ndarray) -> list[np.ndarray]:
    """The rows of each group of two members or more, in the order of member, without repeats."""
    order = np.lexsort((member, group))
    g, s = group[order], member[order]
    order = order[np.r_[True, (g[1:] != g[:-1]) | (s[1:] != s[:-1])]]
    g = group[order]
    return [x for x in np.split(order, np.flatnonzero(g[1:] != g[:-1]) + 1) if len(x) > 1]


def _own_labels(label: np.ndarray) -> np.ndarray:
    """Labels of the members of a group as numbers below their count."""
    return np.unique(label, return_inverse=True)[1]


@gives_back
def _joined(table: pa.Table, percent: int, exact: bool) -> pa.Table:
    """Links within each group, by signature trees: of similar sets, or of those that may be by their bitmaps.

    Groups of equal members are joined once.  Members of equal label are
    connected already.
    """
    sid, sids = _numbers(table.column("sid"))
    label = _numbers(table.column("label"))[0]
    content = table.column("content").combine_chunks()
    n = table.column("n").to_numpy()
    out, seen = [], set()
    for own in _by_group(table.column("grp").to_numpy(), sid):
        members = sid[own].tobytes()
        if members in seen:
            continue
        seen.add(members)
        sets = [np.frombuffer(content[int(k)].as_buffer(), U64) for k in own]
        if exact:
            found = similar_sets([s.reshape(-1, 2) for s in sets], percent, _own_labels(label[own]))
        else:
            found = linked_pairs(n[own], sets, percent, label=_own_labels(label[own]))
        out += [(int(sid[own[x]]), int(sid[own[y]])) for x, y in found]
    return _links(out, sids)


@gives_back
def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The sets of texts whose identity is the expected one, once for a slice."""
    for batch in slices(batches, CHUNK_BYTES):
        h, n = shingle_sets(batch, width)
        found = _decimals(identities(h, n))
        ends = np.cumsum(n)
        right, seen = [], set()
        for r, (x, y) in enumerate(zip(found.to_pylist(), batch.column("sid").to_pylist(), strict=True)):
            if x == y and x not in seen:
                seen.add(x)
                right.append(r)
        yield pa.RecordBatch.from_arrays([found.take(pa.array(right, pa.int64())), pa.array([h[ends[r] - n[r] : ends[r]].tobytes() for r in right], pa.binary())], ["sid", "content"])


def cross_groups(rows: DataFrame, members: int, elements: int, tile: int, limit: int) -> DataFrame:
    """grp, sid, n and label so that of every key any two members of different label meet.

    rows: key, sid, n and label, as a table.  Keys all of whose members have one
    label are done.  A key that fits is a group.  Of others the members of the
    commonest label are dealt into tiles, and the rest are sent to each tile.
    """
    per = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total"))
    per = per.groupBy("key").agg(F.count(F.lit(1)).alias("labels"), F.sum("m").alias("m"), F.sum("total").alias("total"), F.max(F.struct("m", "label")).alias("main"))
    fits = (F.col("m") <= members) & (F.col("total") <= elements)
    q = F.greatest(F.ceil(F.col("m") / F.lit(tile)), F.ceil(F.col("total") * 2 / F.lit(elements)))
    per = per.where("labels > 1").select("key", "m", F.col("main.label").alias("main"), F.when(fits, F.lit(1)).otherwise(q).cast("int").alias("q"))
    joined = join_split(rows, per, ["key"], "m", limit)
    tiles = F.when(F.col("label") == F.col("main"), F.array(_tile("sid", "q"))).otherwise(F.sequence(F.lit(0), F.col("q") - 1))
    return joined.withColumn("tile", F.explode(tiles)).select(F.xxhash64("key", "tile").alias("grp"), "sid", "n", "label")


def _tile(member: str, q: str) -> Column:
    return F.pmod(F.xxhash64(member, F.lit(1)), F.col(q)).cast("int")


class _Join:
    """What the steps of one join have in common."""

    def __init__(self, scratch: Scratch, percent: int, width: int, total: int, members: int, elements: int, tile: int):
        self.scratch, self.percent, self.width, self.total = scratch, percent, width, total
        self.members, self.elements, self.tile = members, elements, tile

    def keys(self, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The documents with their sets' identities, and the shared keys with the addresses of their sets."""
        width, percent, buckets, miss, attempt = self.width, self.percent, pieces(self.total, BUCKET_BYTES), MISS, 0
        while True:
            rows = texts.mapInArrow(lambda b, m=miss: _documents(b, width, percent, m, buckets), ROWS_DDL)
            rows = self.scratch.save(rows, f"documents{attempt}")
            if rows.where(F.col("bucket") == SHORT).isEmpty():
                break
            attempt, miss = attempt + 1, miss * MISS
        base = rows.where("bucket is null").drop("bucket", "payload")
        packed = rows.where("bucket is not null").select("bucket", "payload").repartition(partitions(self.total, BUCKET_BYTES), "bucket")
        return base, self.scratch.save(packed.groupBy("bucket").applyInArrow(_shared, "key long, address long").distinct(), "shared")

    def links(self, groups: DataFrame, exact: bool, weight: int) -> DataFrame:
        """Links within groups (grp, sid, n, label, content), which have about ``weight`` bytes."""
        buckets, percent = pieces(weight), self.percent
        dealt = groups.withColumn("bucket", F.pmod(F.xxhash64("grp"), F.lit(buckets)).cast("int"))
        return dealt.repartition(partitions(weight), "bucket").groupBy("bucket").applyInArrow(lambda t: _joined(t, percent, exact), LINKS_DDL)

    def possible(self, shared: DataFrame, sizes: DataFrame) -> DataFrame:
        """Links that connect any two sets with a common key that may be similar by their bitmaps."""
        n_rows = shared.count()
        limit = hot_limit(n_rows)
        addressed = sizes.select(F.explode("addresses").alias("address"), "sid", "n", F.col("sketch").alias("content"))
        counts = shared.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > self.members)
        large = self.scratch.save(counts.withColumn("q", F.ceil(F.col("m") / F.lit(self.tile)).cast("int")), "large-keys")
        whole = shared.join(large.select("key"), "key", "left_anti").select(F.col("key").alias("grp"), "address")
        tiles = join_split(shared, large, ["key"], "m", limit).select(F.xxhash64("key", _tile("address", "q")).alias("grp"), "address")
        met = whole.unionByName(tiles).join(addressed, "address").select("grp", "sid", "n", F.col("sid").alias("label"), "content")
        links = self.links(met, False, n_rows * 256)
        if large.isEmpty():
            return links
        links = self.scratch.save(links, "possible-tiles")
        hot = shared.join(large.select("key"), "key", "left_semi").join(addressed.drop("content"), "address").select("key", "sid", "n").distinct()
        groups = self.across(hot, components(links, self.scratch, "tiles"), "possible")
        content = groups.join(sizes.select("sid", F.col("sketch").alias("content")), "sid")
        return links.unionByName(self.links(content, False, groups.count() * 256))

    def across(self, rows: DataFrame, linked: DataFrame, name: str) -> DataFrame:
        """``cross_groups`` of rows (key, sid, n), labelled by the components that links made so far."""
        roots = linked.select(F.col("node").alias("sid"), "root")
        rows = self.scratch.save(rows.join(roots, "sid", "left").select("key", "sid", "n", F.coalesce("root", "sid").alias("label")), f"{name}-labelled")
        return self.scratch.save(cross_groups(rows, self.members, self.elements, self.tile, hot_limit(rows.count())), f"{name}-across")

    def exact(self, groups: DataFrame, texts: DataFrame, sizes: DataFrame, name: str) -> DataFrame:
        """Links of similar sets within groups (grp, sid, n, label), a table."""
        active = groups.select("sid").distinct().join(sizes, "sid").select("sid", "key", "digest", "n")
        active = self.scratch.save(active, f"{name}-active")
        once, every = (16 * int(df.agg(F.sum("n")).first()[0] or 0) for df in (active, groups))
        width, parts, on = self.width, partitions(self.total), ["key", "digest"]
        wanted = texts.repartition(parts, *on).join(active.select("sid", *on).repartition(parts, *on), on).select("sid", "text")
        parts = partitions(once)
        sets = wanted.mapInArrow(lambda b: _sets(b, width), f"sid {SID}, content binary").repartition(parts, "sid").dropDuplicates(["sid"])
        return self.links(groups.repartition(parts, "sid").join(sets, "sid"), True, every)

    def similar(self, families: DataFrame, shared: DataFrame, texts: DataFrame, sizes: DataFrame) -> DataFrame:
        """Links that connect any two similar sets of a family."""
        rows = families.join(sizes.select("sid", "n"), families.node == sizes.sid).select(F.col("root").alias("key"), "sid", "n")
        rows = self.scratch.save(rows, "members")
        totals = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total")).where((F.col("m") > self.members) | (F.col("total") > self.elements))
        q = F.greatest(F.ceil(F.col("m") / F.lit(self.tile)), F.ceil(F.col("total") * 2 / F.lit(self.elements)), F.lit(2)).cast("int")
        large = self.scratch.save(totals.select("key", "m", q.alias("q")), "large-families")
        whole = rows.join(large.select("key"), "key", "left_anti").withColumn("q", F.lit(1))
        inside = join_split(rows, large, ["key"], "m", hot_limit(rows.count()))
        tiles = whole.unionByName(inside.drop("m")).select(F.xxhash64("key", _tile("sid", "q")).alias("grp"), "sid", "n", F.col("sid").alias("label"))
        links = self.exact(self.scratch.save(tiles, "groups"), texts, sizes, "groups")
        if large.isEmpty():
            return links
        links = self.scratch.save(links, "links-tiles")
        members = inside.select("sid").distinct()
        addressed = sizes.select(F.explode("addresses").alias("address"), "sid", "n").join(members, "sid", "left_semi")
        common = shared.join(addressed, "address").select("key", "sid", "n").distinct()
        groups = self.across(common, components(links, self.scratch, "links-tiles"), "links")
        return links.unionByName(self.exact(groups, texts, sizes, "across"))


def jaccard_components(
    docs: DataFrame,
    scratch: Scratch,
    width: int = SHINGLE,
    percent: int = PERCENT,
    group_members: int = GROUP_MEMBERS,
    group_elements: int = GROUP_ELEMENTS,
    tile: int = TILE,
) -> DataFrame:
    """doc_id, key, digest (of the text), n_shingles, component_id and root (null where empty) of every row.

    Texts are lower-cased in A-Z.  Two documents link when 100 * overlap >=
    percent * union of their sets of ``width``-word shingles; component_id is
    the smallest doc_id reachable by links.  Documents without words (null and
    empty texts among them) link with nothing and are their own component.  A
    null doc_id is nobody's smallest unless the whole component has none.  Rows
    that repeat, and rows that share a doc_id, each count with their own text.
    Of docs only doc_id and text are read.  An empty table gives an empty result.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    texts = keyed(docs)
    join = _Join(scratch, percent, width, text_bytes(docs), group_members, group_elements, tile)
    base, shared = join.keys(texts)
    one = F.min(F.struct("key", "digest", "n", "sketch", "addresses")).alias("one")
    sizes = scratch.save(base.where("n > 0").groupBy("sid").agg(one).select("sid", "one.*"), "sizes")
    families = scratch.save(components(join.possible(shared, sizes), scratch, "possible"), "families")
    linked = components(join.similar(families, shared, texts, sizes), scratch, "links")

    reached = linked.join(sizes, linked.node == sizes.sid).select("sid", "root", F.col("key").alias("least"))
    least = reached.groupBy("root").agg(F.min("least").alias("least"), F.count(F.lit(1)).alias("m"))
    smallest = sizes.select("sid", F.col("key").alias("own")).join(reached.select("sid", "root").join(least, "root"), "sid", "left")
    copies = base.where("n > 0").groupBy("sid").agg(F.count(F.lit(1)).alias("copies"))
    smallest = smallest.join(copies, "sid").select("sid", F.coalesce("root", "sid").alias("root"), F.coalesce("least", "own").alias("least"), "copies")
    rows = base.select("doc_id", "key", "digest", F.col("n").alias("n_shingles"), "sid")
    found = join_split(rows.where("n_shingles > 0"), scratch.save(smallest, "smallest"), ["sid"], "copies", hot_limit(base.count()))
    component = F.when(F.col("least") != int(LAST), F.col("least")).otherwise(F.col("doc_id"))
    empty = rows.where("n_shingles = 0").select("doc_id", "key", "digest", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast(SID).alias("root"))
    return found.select("doc_id", "key", "digest", "n_shingles", component.alias("component_id"), "root").unionByName(empty)


def one_per_group(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """The rows of docs without those that a row of their component stands for.

    Of each component the row with the smallest doc_id (null last) stays, of
    rows that repeat in doc_id and text one, and every row without words.
    Columns of any name pass through.
    """
    found = jaccard_components(docs, scratch, **options)
    best = F.min(F.struct("key", "digest")).alias("best")
    stays = scratch.save(found.where("root is not null").groupBy("root").agg(best).select("best.*"), "stays")
    text, doc_id = F.coalesce(F.col("row.text"), F.lit("")), F.col("row.doc_id").cast("long")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.coalesce(doc_id, F.lit(int(LAST))).alias("key"), F.xxhash64(text).alias("digest"), (~text.rlike(WORD)).alias("empty"))
    # Copies of other doc_ids go where they are or spread over tasks; rows that repeat in full are combined before their shuffle.
    kept = rows.where("not empty").join(stays, ["key", "digest"], "left_semi").groupBy("key", "digest").agg(F.first("row").alias("row"))
    return kept.select("row").unionByName(rows.where("empty").select("row")).select("row.*")
