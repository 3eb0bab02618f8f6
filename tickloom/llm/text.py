"""Column expressions and array kernels on texts that several operators share.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``.  The kernels work on the
UTF-8 bytes of many texts at once, so no Python code runs per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cached_property, wraps
from hashlib import blake2b
from inspect import isgeneratorfunction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

WORD = r"[^\x20\x09-\x0D]+"
WORD_BREAK = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
U64 = np.uint64
_WORD_BASE = 0xD1342543DE82EF95 | 1


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


LAST = np.iinfo(np.int64).max  # stands for a null doc_id, which is the largest


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and key and digest, which tell rows of different texts apart; a null doc_id has the largest key."""
    text = F.coalesce(F.col("text"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), text.alias("text"), F.coalesce(doc_id, F.lit(int(LAST))).alias("key"), F.xxhash64(text).alias("digest"))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all bits."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp: the sum of values[i + j] * base**j modulo 2**64 for every run of width values, by doubling."""
    part, size, out, done = values, 1, None, 0
    while True:
        if width & size:
            n = len(values) - size - done + 1
            out = part if out is None else part[:n] + U64(pow(_WORD_BASE, size, 2**64)) * out[size : size + n]
            done += size
        if 2 * size > width:
            return out
        n = len(values) - 2 * size + 1
        part = part[:n] + U64(pow(_WORD_BASE, size, 2**64)) * part[size : size + n]
        size *= 2


def chained(values: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A hash of every run of width values that mixes after each of them, so that no sequence is a sum of others."""
    n = len(values) - width + 1
    out = np.full(n, U64(mix_int(seed + width)))
    for j in range(width):
        out = mix64((out ^ values[j : j + n]) * U64(_WORD_BASE))
    return out


def mix_int(x: int) -> int:
    return int(mix64(np.array([x], U64))[0])


def strings_of(values: pa.Array) -> list[bytes]:
    """The strings of a large_binary array without nulls."""
    data, offsets = binary_text(values)
    text, cuts = data.tobytes(), offsets.tolist()
    return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def digests(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit values of each string, the halves of its BLAKE2b."""
    both = np.frombuffer(b"".join([blake2b(v, digest_size=16).digest() for v in strings_of(values)]), U64).reshape(-1, 2)
    return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


def coded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number of each string data[start:end]; equal numbers are equal strings."""
    sizes = ends - starts
    cuts = np.r_[0, np.cumsum(sizes)].astype(np.int64)
    at = np.repeat(starts - cuts[:-1], sizes) + np.arange(cuts[-1])
    strings = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(cuts), pa.py_buffer(data[at])])
    return strings.dictionary_encode().indices.to_numpy()


def ranked(*keys: tuple[np.ndarray, int]) -> np.ndarray:
    """One number for each combination of keys (each with a bound above it); equal numbers are equal combinations."""
    out, bound = keys[0]
    out = out.astype(np.int64)
    for key, size in keys[1:]:
        if bound * size >= 1 << 62:
            values, out = np.unique(out, return_inverse=True)
            bound = len(values)
        out, bound = out * size + key, bound * size
    return out


def repeated(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur more than once, and which of them are not the first such."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    several, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    several[order] = np.r_[same, False] | np.r_[False, same] if len(key) else False
    later[order] = np.r_[False, same] if len(key) else False
    return several, later


def binary_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null(b"" if pa.types.is_binary(column.type) else "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of the batches in pieces of about max_bytes of text; one row may be longer."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = binary_text(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + max_bytes, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def give_back() -> None:
    """Returns memory that is free to the system: Arrow's, and that of numpy where the C library can."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def gives_back(kernel: Callable) -> Callable:
    """A kernel of Arrow batches or tables that ends with ``give_back``.

    Workers outlive their tasks: each would keep what its largest slice took,
    beside tasks that need none of it.
    """
    if isgeneratorfunction(kernel):

        @wraps(kernel)
        def run(rows, *args):
            yield from kernel(rows, *args)
            give_back()
    else:

        @wraps(kernel)
        def run(rows, *args):
            out = kernel(rows, *args)
            give_back()
            return out

    return run


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


class Words:
    """Places of the words of several texts: starts and ends in the bytes, and the row of each.

    bounds[r] to bounds[r + 1] are the words of row r.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, inside: np.ndarray | None = None):
        """inside: which bytes words are made of, where they are not the words above."""
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        self.data, self.offsets, self.rows = data, offsets, len(offsets) - 1
        self.inside = inside = ~is_space(data) if inside is None else inside
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        begins[cuts] = inside[cuts]  # a text begins: no word runs over from the one before
        ends[cuts - 1] = inside[cuts - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)

    @cached_property
    def row(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(self.rows), self.counts)

    @cached_property
    def coded(self) -> pa.DictionaryArray:
        """The words as numbers, equal where words are equal: told apart by their bytes, not by hashes."""
        inked = self.data[self.inside]
        cuts = np.r_[0, np.cumsum(self.ends - self.starts)].astype(np.int64)
        strings = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.starts), [None, pa.py_buffer(cuts), pa.py_buffer(inked)])
        return strings.dictionary_encode()

    @property
    def codes(self) -> tuple[np.ndarray, int]:
        """The numbers, and how many there are."""
        return self.coded.indices.to_numpy(), max(len(self.coded.dictionary), 1)

    @cached_property
    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent 64-bit values of every word."""
        code = self.codes[0]
        return tuple(d[code] for d in digests(self.coded.dictionary))

    def runs(self, width: int) -> np.ndarray:
        """First words of all runs of width words within one text."""
        first = np.arange(max(len(self.starts) - width + 1, 0))
        return first[self.row[first] == self.row[first + width - 1]]

    def windows(self, width: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, row and first word of every run of width words within one text.

        Seed 0 is the rolling Rabin-Karp hash of the words' digests; others mix
        after each word.
        """
        first = self.runs(width)
        if not len(first):
            return np.zeros(0, U64), first, first
        h = mix64(rolling(self.digests[0], width)) if seed == 0 else chained(self.digests[0], width, seed)
        return h[first], self.row[first], first

    def sequences(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A number of every run of width words, its row and its first word; equal numbers are equal runs in equal rows."""
        first = self.runs(width)
        code, size = self.codes
        keys = [(code[first + j], size) for j in range(width)]
        return ranked((self.row[first], max(self.rows, 1)), *keys), self.row[first], first

    def prefix_hashes(self, lengths: tuple[int, ...]) -> list[np.ndarray]:
        """Hashes of whole words, then for each length of the first bytes of every word longer than that, else 0."""
        words, code = strings_of(self.coded.dictionary), self.codes[0]
        out = [np.array([xxh3_64_intdigest(w) for w in words], U64)[code]]
        for n in lengths:
            out.append(np.array([xxh3_64_intdigest(w[:n], n) if len(w) > n else 0 for w in words], U64)[code])
        return out
