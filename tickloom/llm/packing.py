"""Arrays as strings for rows of a shuffle, laid out so that its compression finds what is the same."""

from __future__ import annotations

import numpy as np

from .text import U64


def join(*parts: bytes) -> bytes:
    """Strings in one, with their lengths before them."""
    return b"".join([np.array([len(parts), *map(len, parts)], np.int64).tobytes(), *parts])


def split(payload: bytes) -> list[bytes]:
    n = int(np.frombuffer(payload, np.int64, 1)[0])
    ends = np.cumsum(np.frombuffer(payload, np.int64, n, 8)) + 8 * (n + 1)
    return [payload[a:b] for a, b in zip([8 * (n + 1), *ends[:-1]], ends, strict=True)]


def planes(a: np.ndarray) -> bytes:
    """All first bytes, all second bytes and so on: small numbers leave planes of zeros."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def from_planes(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(size, -1).T.copy().view(kind).ravel()


def steps(a: np.ndarray) -> bytes:
    """Differences from one to the next, in planes; for rising numbers."""
    return planes(np.diff(a, prepend=a.dtype.type(0)))


def from_steps(data: bytes, kind) -> np.ndarray:
    return np.cumsum(from_planes(data, kind), dtype=kind)


def short(a: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of 64-bit values."""
    return np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), 8)[:, :width]).tobytes()


def from_short(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view(U64).ravel()


def dealt(values: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """Values dealt over buckets: what is left of each, the order by bucket, and (bucket, from, to) in that order."""
    bucket = (values % U64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.cumsum(np.bincount(bucket, minlength=buckets)).tolist()
    return values // U64(buckets), order, [(b, i, j) for b, (i, j) in enumerate(zip([0, *ends[:-1]], ends, strict=True)) if i < j]
