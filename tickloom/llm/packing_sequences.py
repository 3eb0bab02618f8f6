"""Best-fit packing of documents into sequences, by hierarchical residual packing.

Every task encodes its documents, cuts only those longer than a sequence, and
packs its pieces by best fit in falling order of length.  Full sequences are
done.  Those with room left are items of their own: they are dealt into groups
and packed by best fit again.  Best fit leaves one sequence at most half full
in a group, and of two sequences that fit into one, one is at most half full.
So these go on, with as many of the roomiest others, until one group holds
them; then no two sequences of all fit into one.  A round moves two numbers for
each sequence, never texts or ids, and a group is bounded by its items.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pretokens import CLASSED_BELOW, OTHERS, as_letters, ranges
from .scratch import Scratch
from .text import gives_back

LENGTH = 2048
#: Items that one task packs in a round, and pieces that it packs at once at first.
GROUP_ITEMS, LOCAL_PIECES = 200_000, 500_000
#: Pre-tokens whose ids a worker remembers.
MEMO = 300_000
END = (0).to_bytes(4, "little")


class _Ids(dict):
    """Ids of a lower-cased pre-token, each as 4 bytes."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def __missing__(self, s: str) -> bytes:
        ids = np.array([t.id for t in self.model.tokenize(as_letters(s))], "<u4").tobytes()
        if len(self) >= MEMO:
            self.clear()
        self[s] = ids
        return ids


class Encoder:
    """Ids as a tokenizer file with NFC, lower case and word ends gives them, without added special tokens.

    Texts of characters that the library was seen to treat like Python does are
    cut by one regular expression and encoded by pre-token; others are left to
    the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        special = {x.content: i for i, x in t.get_added_tokens_decoder().items()}
        self.special = {s: int(i).to_bytes(4, "little") for s, i in special.items()}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        pieces = lambda s: len(t.pre_tokenizer.pre_tokenize_str(s))
        kind, odd = {}, set()
        for i in range(CLASSED_BELOW):
            c = chr(i)
            kind[i] = "a" if pieces("a" + c) == 1 and pieces(c) == 1 else "!" if pieces("!" + c) == 1 and pieces(c) == 1 else "1" if pieces(c) == 1 else " "
            low = c.lower()
            if kind[i] != " " and (t.normalizer.normalize_str(c) != low or OTHERS.search(low) or c == "Σ"):
                odd.add(i)
        letter, number, space = (ranges(lambda i, k=k: kind[i] == k) for k in "a1 ")
        self.odd = re.compile(f"[{ranges(lambda i: i in odd)}]")
        self.pre_token = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{space}{letter}{number}]+")
        self.ids = _Ids(t.model)

    def _plain(self, text: str) -> bytes:
        if text.isascii() or not (OTHERS.search(text) or self.odd.search(text)) and unicodedata.is_normalized("NFC", text):
            return b"".join(map(self.ids.__getitem__, self.pre_token.findall(text.lower())))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        if self.at_special is None or "<" not in text or not self.at_special.search(text):
            return self._plain(text)
        return b"".join(self.special[p] if p in self.special else self._plain(p) for p in self.at_special.split(text) if p)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every item, and the fill of every bin; largest items first, each into the fullest bin that takes it.

    Open bins are kept by room, and a bit set of the rooms that occur finds the
    least sufficient one.
    """
    bins, offsets, fill = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    occurring = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        enough = occurring >> size
        if enough:
            room = size + (enough & -enough).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                occurring &= ~(1 << room)
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        room -= size
        if room:
            rooms[room].append(b)
            occurring |= 1 << room
    return bins, offsets, np.array(fill, np.int64)


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("bin", pa.int64()), ("within", pa.int64()), ("fill", pa.int64())])
PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, within long, fill long"


@gives_back
def _packed(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    own = encoder(path)
    first_bin = TaskContext.get().partitionId() << 36
    rows: list[tuple] = []

    def emit() -> pa.RecordBatch:
        nonlocal rows, first_bin
        columns = [np.array(c) for c in list(zip(*rows, strict=True))[1:]]
        bins, within, fill = best_fit(columns[2], capacity)
        arrays = [pa.array([r[0] for r in rows], pa.int64()), *(pa.array(c) for c in columns), pa.array(bins + first_bin), pa.array(within), pa.array(fill[bins])]
        first_bin += len(fill)
        rows = []
        return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, _PIECES, strict=True)], schema=_PIECES)

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            ids = (own.encode(text) if text else b"") + END
            for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                piece = ids[at : at + 4 * capacity]
                rows.append((doc_id, k, at // 4, len(piece) // 4, zlib.crc32(piece)))
        if len(rows) >= LOCAL_PIECES:
            yield emit()
    if rows:
        yield emit()


@gives_back
def _merged(table: pa.Table, capacity: int) -> pa.Table:
    """One round in one group: the item that each becomes part of, named by its smallest, and its place and fill."""
    order = np.argsort(table.column("item").to_numpy())
    item, size = table.column("item").to_numpy()[order], table.column("fill").to_numpy()[order]
    bins, offsets, fill = best_fit(size, capacity)
    names = np.full(len(fill), np.iinfo(np.int64).max)
    np.minimum.at(names, bins, item)
    return pa.Table.from_arrays([pa.array(item), pa.array(names[bins]), pa.array(offsets), pa.array(fill[bins])], ["item", "into", "at", "fill"])


def pack_sequences(docs: DataFrame, path: str, scratch: Scratch, capacity: int = LENGTH, group_items: int = GROUP_ITEMS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece.

    A document is its ids and id 0; null text is empty, so its document is one
    id.  Documents over ``capacity`` ids are cut into pieces of it and a rest;
    no other document is cut.  Rows that repeat are packed each for itself.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    pieces = scratch.save(texts.mapInArrow(lambda b: _packed(b, path, capacity), PIECES_DDL), "pieces")
    roomy = F.col("fill") < capacity
    # bin: a sequence of the first round; into, base: the one it is part of by now, and where.
    open_ = scratch.save(pieces.where(roomy).select("bin", F.col("bin").alias("into"), F.lit(0).cast("long").alias("base"), "fill").distinct(), "open0")
    half = F.col("fill") <= capacity // 2
    done, n = [], 0
    while True:
        items = open_.select(F.col("into").alias("item"), "fill").distinct()
        count = items.count()
        if not count:
            break
        n += 1
        groups = -(-count // max(group_items, 4))  # fewer items a group might not make the groups fewer
        dealt = items.withColumn("grp", F.pmod(F.xxhash64("item", F.lit(n)), F.lit(groups)))
        rounds = dealt.groupBy("grp").applyInArrow(lambda t: _merged(t, capacity), "item long, into long, at long, fill long")
        moved = open_.drop("fill").join(rounds.withColumnRenamed("into", "next"), F.col("into") == F.col("item"))
        moved = scratch.save(moved.select("bin", F.col("next").alias("into"), (F.col("base") + F.col("at")).alias("base"), "fill"), f"open{n}")
        few = moved.where(half).select("into").distinct().count() if groups > 1 else 0
        if not few:
            done.append(moved)
            break
        # If one of few fits into any other sequence, it fits into one of the few roomiest that the rest of them leave.
        others = moved.where(roomy & ~half).select("fill", "into").distinct().orderBy("fill", "into").limit(few)
        last = others.agg(F.max(F.struct("fill", "into")).alias("last")).first().last
        goes_on = half
        if last is not None:
            goes_on |= (F.col("fill") < last.fill) | ((F.col("fill") == last.fill) & (F.col("into") <= last.into))
        done.append(moved.where(~goes_on))
        open_ = moved.where(goes_on)
    places = scratch.spark.range(0).select(*[F.col("id").alias(c) for c in ("bin", "into", "base")])  # a list would start Python workers
    for rows in done:
        places = places.unionByName(rows.select("bin", "into", "base"))
    return pieces.join(places, "bin", "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.coalesce("into", "bin").alias("sequence_id"),
        (F.col("within") + F.coalesce("base", F.lit(0))).alias("offset"),
    )
