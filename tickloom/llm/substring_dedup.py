"""Substring deduplication by Rabin-Karp hashes of every window of tokens.

Every window of ``width`` consecutive words is hashed and counted in Spark; a
window whose sequence also starts in a document with a smaller doc_id marks its
words, and overlapping marks merge into maximal intervals that are removed.

Windows are as many as words, so they travel packed: documents are hashed in
chunks, and what a chunk sends to one hash bucket is one row of raw arrays,
about 8 bytes a window.  Of the windows of a chunk that are equal only those of
the smallest doc_id are sent; the others are decided where they are, so a
passage that a third of all documents share reaches its bucket once a chunk.
There are as many buckets as the text asks for, whatever the session's number of
partitions, and a task holds one bucket at a time.

Hashes only propose.  The bucket answers each chunk with the places of its
marked windows and where their sequence was seen before.  Runs of them are
claims, "these words are those words"; when spans meet the texts again, both
sides of every claim are digested by SHA-256, and claims whose sides differ are
dropped.  Should there be any, another hash, which mixes word by word, is tried
for all, until every window was either confirmed once or, once, not proposed.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import packing
from .hot import partitions, pieces, text_bytes
from .scratch import Scratch
from .text import SPACES, WORD_BREAK, Words, binary_text, keyed, slices

WIDTH = 13
#: Bytes of text that are hashed at once: more where there are many buckets, so that the rows of a chunk do not get short.
CHUNK_BYTES, MOST_CHUNK_BYTES, CHUNK_BYTES_A_BUCKET = 1 << 20, 16 << 20, 512
HASH_BYTES = 7
#: A claim does not reach over a multiple of so many words of its source, so that claims on one source are few kinds.
CLAIM = 256
WINDOWS, MARKED, DOCS = 0, 1, 2
_PACKED = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int8()), ("payload", pa.binary())])
_ANSWER = pa.schema([("chunk", pa.int64()), ("kind", pa.int8()), ("payload", pa.binary())])
_CLAIM = pa.struct([("start", pa.int32()), ("n", pa.int32()), ("chunk", pa.int64()), ("place", pa.int64())])
_SPANS = pa.schema([("chunk", pa.int64()), ("docs", pa.binary()), ("key", pa.int64()), ("digest", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("claims", pa.list_(_CLAIM))])
PACKED_DDL = "bucket int, chunk long, kind byte, payload binary"
ANSWER_DDL = "chunk long, kind byte, payload binary"
SPANS_DDL = "chunk long, docs binary, key long, digest long, starts array<int>, ends array<int>, claims array<struct<start int, n int, chunk long, place long>>"
SOURCES_DDL = "key long, digest long, start int, n int, chunk long, place long"


def _marked(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows whose hash another one of a smaller doc_id has, and the first window of the smallest one."""
    order = np.argsort(h, kind="stable")
    h, doc = h[order], doc[order]
    begins = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    sizes = np.diff(np.r_[begins, len(h)])
    least = np.repeat(np.minimum.reduceat(doc, begins), sizes)
    group = np.repeat(np.arange(len(begins)), sizes)
    smallest = np.flatnonzero(doc == least)
    source = np.zeros(len(begins), np.int64)
    source[group[smallest][::-1]] = order[smallest][::-1]
    later = doc > least
    by = np.argsort(order[later], kind="stable")
    return order[later][by], source[group[later]][by]


def _pack(batches: Iterator[pa.RecordBatch], width: int, buckets: int, chunk_bytes: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Windows by bucket, marks within the chunk, and the documents of the chunk.

    The place of a window is its first word's in the chunk, with a gap of one
    after each document.
    """
    for batch in slices(batches, chunk_bytes):
        words = Words(*binary_text(batch.column("text")))
        h, row, first = words.windows(width, seed)
        if not len(h):
            continue
        ids = batch.column("key").to_numpy(zero_copy_only=False)
        docs = packing.join(ids.tobytes(), batch.column("digest").to_numpy(zero_copy_only=False).tobytes(), words.counts.astype(np.int32).tobytes())
        chunk = int.from_bytes(blake2b(docs, digest_size=8).digest(), "little", signed=True)
        place = (first + row).astype(np.uint32)
        marked, source = _marked(h, ids[row])
        rows = [(chunk % buckets, DOCS, docs)]
        if len(marked):
            rows.append((chunk % buckets, MARKED, _marks(place[marked], np.full(len(marked), chunk), place[source])))
        sent = np.ones(len(h), bool)
        sent[marked] = False
        sent = np.flatnonzero(sent)
        rest, by, cuts = packing.dealt(h[sent], buckets)
        for b, i, j in cuts:
            own = sent[by[i:j]]
            there, per_doc = np.unique(row[own], return_counts=True)
            payload = packing.join(packing.short(rest[by[i:j]], HASH_BYTES), packing.steps(place[own]), packing.steps(ids[there]), packing.planes(per_doc.astype(np.uint32)))
            rows.append((b, WINDOWS, payload))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([chunk] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.int8()), pa.array([r[2] for r in rows], pa.binary())], schema=_PACKED)


def _marks(place: np.ndarray, chunk: np.ndarray, source: np.ndarray) -> bytes:
    """Places of marked windows, and chunk and place of the same sequence in a smaller doc_id."""
    chunks, which = np.unique(chunk, return_inverse=True)
    return packing.join(packing.steps(place), chunks.tobytes(), packing.planes(which.astype(np.uint32)), packing.steps(source))


def _from_marks(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    place, chunks, which, source = packing.split(payload)
    return packing.from_steps(place, np.uint32), np.frombuffer(chunks, np.int64)[packing.from_planes(which, np.uint32)], packing.from_steps(source, np.uint32)


def _windows(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, place and doc_id of the windows of a row."""
    h, place, ids, per_doc = packing.split(payload)
    doc = np.repeat(packing.from_steps(ids, np.int64), packing.from_planes(per_doc, np.uint32))
    return packing.from_short(h, HASH_BYTES), packing.from_steps(place, np.uint32), doc


def _answer(table: pa.Table) -> pa.Table:
    """Marks for each chunk of a bucket."""
    chunks, kinds, payloads = (table.column(c).to_pylist() for c in ("chunk", "kind", "payload"))
    out = [(c, k, p) for c, k, p in zip(chunks, kinds, payloads, strict=True) if k != WINDOWS]
    parts = [(c, *_windows(p)) for c, k, p in zip(chunks, kinds, payloads, strict=True) if k == WINDOWS]
    parts.sort(key=lambda p: p[0])
    del payloads
    if parts:
        h, place, doc = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
        sizes = [len(p[1]) for p in parts]
        chunk = np.repeat(np.array([p[0] for p in parts]), sizes)
        marked, source = _marked(h, doc)
        cuts = np.searchsorted(marked, np.r_[0, np.cumsum(sizes)])
        for (c, *_), i, j in zip(parts, cuts, cuts[1:], strict=False):
            if i < j:
                out.append((c, MARKED, _marks(place[marked[i:j]], chunk[source[i:j]], place[source[i:j]])))
    return pa.Table.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int8()), pa.array([r[2] for r in out], pa.binary())], schema=_ANSWER)


def _documents(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and digests of the documents of a chunk, and the place at which each begins."""
    ids, digests, n = (np.frombuffer(x, t) for x, t in zip(packing.split(payload), (np.int64, np.int64, np.int32), strict=True))
    return ids, digests, np.r_[0, np.cumsum(n.astype(np.int64) + 1)]


def _maximal(start: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (excluded) of maximal intervals of words under windows, and the row of each."""
    first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (start[1:] > start[:-1] + width)])
    return start[first], start[np.r_[first[1:], len(start)] - 1] + width, row[first]


def _lists(row: np.ndarray, *values: pa.Array) -> tuple[np.ndarray, list[pa.Array]]:
    """The distinct rows, and lists of the values of each."""
    heads = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    cuts = pa.array(np.r_[heads, len(row)].astype(np.int32))
    return row[heads], [pa.ListArray.from_arrays(cuts, v) for v in values]


def _claims(table: pa.Table, width: int) -> pa.Table:
    """The documents of a chunk as a row, and a row of claims for each document with marks.

    A claim is a run of n windows from a word on, with the chunk and place of
    the run that it repeats.
    """
    chunk = table.column("chunk")[0].as_py()
    kinds, payloads = table.column("kind").to_pylist(), table.column("payload").to_pylist()
    docs = next((p for k, p in zip(kinds, payloads, strict=True) if k == DOCS), None)
    marks = [_from_marks(p) for k, p in zip(kinds, payloads, strict=True) if k == MARKED]
    head = pa.Table.from_arrays([pa.array([chunk]), pa.array([docs], pa.binary()), *(pa.nulls(1, f.type) for f in list(_SPANS)[2:])], schema=_SPANS)
    if not marks or docs is None:
        return head
    ids, digests, begins = _documents(docs)
    place, source_chunk, source = (np.concatenate([m[i] for m in marks]) for i in range(3))
    # Rows that repeat in full may make equal chunks, with equal marks.
    place, once = np.unique(place.astype(np.int64), return_index=True)
    source_chunk, source = source_chunk[once], source[once].astype(np.int64)
    row = np.searchsorted(begins, place, "right") - 1
    new = np.r_[True, (np.diff(place) != 1) | (np.diff(source) != 1) | (source_chunk[1:] != source_chunk[:-1]) | (source[1:] % CLAIM == 0)]
    first = np.flatnonzero(new)
    n = np.diff(np.r_[first, len(place)])
    start = (place - begins[row]).astype(np.int32)
    starts, ends, of = _maximal(start, row, width)
    at, intervals = _lists(of, pa.array(starts), pa.array(ends))
    _, claims = _lists(row[first], pa.StructArray.from_arrays([pa.array(start[first]), pa.array(n.astype(np.int32)), pa.array(source_chunk[first]), pa.array(source[first])], fields=list(_CLAIM)))
    body = [pa.array(np.full(len(at), chunk)), pa.nulls(len(at), pa.binary()), pa.array(ids[at]), pa.array(digests[at]), *intervals, *claims]
    return pa.concat_tables([head, pa.Table.from_arrays([b.cast(f.type) for b, f in zip(body, _SPANS, strict=True)], schema=_SPANS)])


_SOURCES = pa.schema([("key", pa.int64()), ("digest", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("chunk", pa.int64()), ("place", pa.int64())])


def _sources(asked: pa.Table, docs: pa.Table) -> pa.Table:
    """The documents and first words of the places asked for in one chunk."""
    if not asked.num_rows:
        return _SOURCES.empty_table()
    ids, digests, begins = _documents(docs.column("docs")[0].as_py())
    place = asked.column("place").to_numpy()
    row = np.searchsorted(begins, place, "right") - 1
    return pa.Table.from_arrays([pa.array(ids[row]), pa.array(digests[row]), pa.array((place - begins[row]).astype(np.int32)), *(asked.column(c) for c in ("n", "chunk", "place"))], schema=_SOURCES)


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_BREAK))


def _run(start: Column, n: Column) -> Column:
    """Digest of n words from start on."""
    return F.unhex(F.sha2(F.array_join(F.slice("words", start + 1, n), " ").cast("binary"), 256))


def _proposed(docs: DataFrame, width: int, scratch: Scratch, seed: int, total: int) -> DataFrame:
    """Claims and intervals by document, and the documents of each chunk, of one pass over all windows."""
    buckets = pieces(total)
    chunk_bytes = min(max(CHUNK_BYTES, buckets * CHUNK_BYTES_A_BUCKET), MOST_CHUNK_BYTES)
    texts = docs.select("key", "digest", F.col("text").cast("binary").alias("text"))
    packed = texts.mapInArrow(lambda b: _pack(b, width, buckets, chunk_bytes, seed), PACKED_DDL)
    answered = packed.repartition(partitions(total), "bucket").groupBy("bucket").applyInArrow(_answer, ANSWER_DDL)
    return scratch.save(answered.groupBy("chunk").applyInArrow(lambda t: _claims(t, width), SPANS_DDL), f"claims{seed}")


def _met(docs: DataFrame, found: DataFrame, width: int, total: int) -> DataFrame:
    """Documents without what is claimed to be repeated, with the digests of both sides of claims: says and is."""
    claims = found.where("key is not null")
    # Rows that repeat in full lie in several chunks, with the same intervals.
    own = claims.groupBy("key", "digest").agg(F.first(F.struct("starts", "ends", "claims")).alias("own"))
    asked = claims.select(F.explode("claims").alias("c")).select("c.chunk", "c.place", "c.n").distinct()
    places = found.where("docs is not null").select("chunk", "docs").dropDuplicates(["chunk"])
    sources = asked.groupBy("chunk").cogroup(places.groupBy("chunk")).applyInArrow(_sources, SOURCES_DDL)
    sources = sources.groupBy("key", "digest").agg(F.collect_list(F.struct("start", "n", "chunk", "place")).alias("asked"))
    per = own.join(sources, ["key", "digest"], "full")
    parts, on = partitions(total), ["key", "digest"]
    joined = docs.repartition(parts, *on).join(per.repartition(parts, *on), on, "left").withColumn("words", _words(F.col("text")))
    sides = lambda claims: F.transform(claims, lambda c: F.struct(c.chunk, c.place, c.n, _run(c.start, c.n + (width - 1)).alias("sha")))
    return joined.select("doc_id", "key", "digest", *_cut(F.col("words"), F.col("own.starts"), F.col("own.ends")), sides("own.claims").alias("says"), sides("asked").alias("is"))


def _cut(words: Column, starts: Column, ends: Column) -> list[Column]:
    """n_words, n_removed, and kept, the words outside the intervals; null intervals remove nothing."""
    begins, stops = F.concat(F.array(F.lit(0)), ends), F.concat(starts, F.array(F.size(words)))
    rest = F.flatten(F.zip_with(begins, stops, lambda i, j: F.slice(words, i + 1, j - i)))
    removed = F.aggregate(F.zip_with(starts, ends, lambda i, j: j - i), F.lit(0), lambda a, x: a + x)
    kept = F.array_join(F.when(starts.isNull(), words).otherwise(rest), " ")
    return [F.size(words).cast("long").alias("n_words"), F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"), kept.alias("kept_text")]


def _wrong(met: DataFrame) -> DataFrame:
    """chunk, place and n of claims whose two sides are not the same words."""
    key = ["chunk", "place", "n"]
    side = lambda c: met.select(F.explode(c).alias("c")).select("c.*").groupBy(*key).agg(F.min("sha").alias(f"{c}0"), F.max("sha").alias(f"{c}1"))
    both = side("says").join(side("is"), key, "left")
    return both.where("is0 is null or says0 <> is0 or says1 <> is0 or is1 <> is0").select(*key)


def _split(found: DataFrame, wrong: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Windows (key, digest, at) of claims that hold, and of those that do not."""
    claims = found.where("key is not null").select("key", "digest", F.explode("claims").alias("c")).select("key", "digest", "c.*")
    at = F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("at")
    on, columns = ["chunk", "place", "n"], ["key", "digest", at]
    return claims.join(wrong, on, "left_anti").select(*columns).distinct(), claims.join(wrong, on, "left_semi").select(*columns).distinct()


def _merged(table: pa.Table, width: int) -> pa.Table:
    """Maximal intervals of the windows of one document."""
    at = np.sort(table.column("at").to_numpy())
    starts, ends = _maximal(at, np.zeros(len(at), np.int64), width)[:2]
    return pa.Table.from_arrays([table.column("key")[:1], table.column("digest")[:1], pa.array([starts], pa.list_(pa.int32())), pa.array([ends], pa.list_(pa.int32()))], ["key", "digest", "starts", "ends"])


def substring_dedup(docs: DataFrame, width: int = WIDTH, with_text: bool = True, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept_text (kept words joined by one space; null unless asked for).

    Windows are judged on the input, not on what is left.  Null and empty texts
    have no words; texts under ``width`` words lose none; an empty table gives
    an empty result.  A null doc_id is larger than all others; rows of one
    doc_id never mark one another, so rows that repeat in full all stay.  Of
    docs only doc_id and text are read, whatever its other columns' names.
    """
    scratch = scratch or Scratch(docs.sparkSession, "substring")
    total, rows, seed = text_bytes(docs), keyed(docs), 0
    found = _proposed(rows, width, scratch, seed, total)
    met = scratch.save(_met(rows, found, width, total).withColumn("kept_sha256", _sha(F.col("kept_text"))).withColumn("kept_text", _if(with_text)), "met")
    wrong = _wrong(met)
    if not wrong.isEmpty():
        sure, doubt = (scratch.save(x, name) for x, name in zip(_split(found, wrong, width), ("sure0", "doubt0"), strict=True))
        while not doubt.isEmpty():
            seed += 1
            found = _proposed(rows, width, scratch, seed, total)
            wrong = scratch.save(_wrong(_met(rows, found, width, total)), f"wrong{seed}")
            good, bad = _split(found, wrong, width)
            sure = scratch.save(sure.unionByName(good).distinct(), f"sure{seed}")
            on = ["key", "digest", "at"]
            doubt = scratch.save(doubt.join(bad, on, "left_semi").join(sure, on, "left_anti"), f"doubt{seed}")
        spans = sure.groupBy("key", "digest").applyInArrow(lambda t: _merged(t, width), "key long, digest long, starts array<int>, ends array<int>")
        met = rows.join(spans, ["key", "digest"], "left").withColumn("words", _words(F.col("text")))
        met = met.select("doc_id", *_cut(F.col("words"), F.col("starts"), F.col("ends"))).withColumn("kept_sha256", _sha(F.col("kept_text"))).withColumn("kept_text", _if(with_text))
    return met.select("doc_id", "n_words", "n_removed", "kept_sha256", "kept_text")


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _if(with_text: bool) -> Column:
    return F.col("kept_text") if with_text else F.lit(None).cast("string")
