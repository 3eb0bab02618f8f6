"""Similarity join of sets inside one group by signature trees.

Every set has a bitmap of its hashed elements.  Leaves hold some sets each, and
a node holds the OR of the bitmaps below it with the range of their sizes.  Two
nodes are compared by the largest overlap that any two of their sets could
have; where that is too small for the threshold, no pair below is looked at.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

LEAF, FANOUT = 32, 8
#: Bits of a bitmap for each element of the largest set, within MOST_WORDS.
BITS_PER_ELEMENT, MOST_WORDS = 8, 512


class _Node:
    __slots__ = ("children", "excess", "high", "low", "members", "mask")

    def __init__(self, members: slice, children: list[_Node], low: int, high: int, excess: int, mask: np.ndarray):
        self.members, self.children, self.low, self.high, self.excess, self.mask = members, children, low, high, excess, mask


def bitmaps(elements: np.ndarray, lengths: np.ndarray, words: np.ndarray) -> list[np.ndarray]:
    """64-bit words of each set, words[i] (a power of two) for set i; element e has bit e modulo the size."""
    rows = np.repeat(np.arange(len(lengths)), lengths)
    starts = np.cumsum(words) - words
    bits = elements & (words[rows] * 64 - 1).astype(np.uint64)
    flat = np.zeros(int(words.sum()), np.uint64)
    at = starts[rows] + (bits >> np.uint64(6)).astype(np.int64)
    np.bitwise_or.at(flat, at, np.uint64(1) << (bits & np.uint64(63)))
    return np.split(flat, np.cumsum(words)[:-1])


def words_for(n: np.ndarray, bits_per_element: int) -> np.ndarray:
    """The power of two of 64-bit words that gives sets of n elements so many bits each."""
    return 1 << np.ceil(np.log2(np.maximum(n * bits_per_element / 64, 1))).astype(np.int64)


def folded(mask: np.ndarray, words: int) -> np.ndarray:
    """The bitmap that the same elements have in ``words`` words."""
    return np.bitwise_or.reduce(mask.reshape(-1, words), axis=0)


def _tree(sizes: np.ndarray, excess: np.ndarray, masks: np.ndarray) -> _Node:
    level = []
    for i in range(0, len(sizes), LEAF):
        j = min(i + LEAF, len(sizes))
        level.append(_Node(slice(i, j), [], int(sizes[i:j].min()), int(sizes[i:j].max()), int(excess[i:j].max()), np.bitwise_or.reduce(masks[i:j])))
    while len(level) > 1:
        above = []
        for i in range(0, len(level), FANOUT):
            own = level[i : i + FANOUT]
            above.append(_Node(slice(own[0].members.start, own[-1].members.stop), own, min(n.low for n in own), max(n.high for n in own), max(n.excess for n in own), np.bitwise_or.reduce([n.mask for n in own])))
        level = above
    return level[0]


def linked_pairs(sizes: np.ndarray, masks: list[np.ndarray], percent: int, overlap: Callable[[int, int], int] | None = None, label: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect sets just as all pairs with 100 * overlap >= percent * union would.

    sizes and bitmaps of the sets; overlap gives the exact overlap of two of
    them.  Without it pairs link that by their bitmaps may be that similar.
    Pairs that links found so far connect already are not compared, so a family
    of near copies costs one comparison or so for each member.  ``label``, a
    number below the number of sets, tells which are connected from before.
    """
    if len(sizes) < 2:
        return []
    words = min(map(len, masks))
    masks = np.stack([folded(m, words) for m in masks])
    # Alike sets side by side: by size class, then by bitmap.
    order = np.lexsort((masks[:, 0], np.log(sizes) // np.log(1.2)))
    sizes, masks = sizes[order], masks[order]
    excess = sizes - np.bitwise_count(masks).sum(axis=1)  # elements that share a bit with another
    label = np.arange(len(sizes)) if label is None else np.asarray(label)[order]
    links: list[tuple[int, int]] = []

    def too_small(a: _Node, b: _Node) -> bool:
        if 100 * a.high < percent * b.low or 100 * b.high < percent * a.low:
            return True
        most = int(np.bitwise_count(a.mask & b.mask).sum()) + min(a.excess, b.excess)
        return (100 + percent) * most < percent * (a.low + b.low)

    def compare(a: slice, b: slice) -> None:
        i, j = np.meshgrid(np.arange(a.start, a.stop), np.arange(b.start, b.stop), indexing="ij")
        open_ = (i < j) & (label[i] != label[j]) & (100 * np.minimum(sizes[i], sizes[j]) >= percent * np.maximum(sizes[i], sizes[j]))
        i, j = i[open_], j[open_]
        if not len(i):
            return
        most = np.concatenate([np.bitwise_count(masks[i[k : k + 4096]] & masks[j[k : k + 4096]]).sum(axis=1) for k in range(0, len(i), 4096)]) + np.minimum(excess[i], excess[j])
        likely = (100 + percent) * most >= percent * (sizes[i] + sizes[j])
        i, j, most = i[likely], j[likely], most[likely]
        by = np.argsort(-most / (sizes[i] + sizes[j]), kind="stable")
        i, j = i[by], j[by]
        while len(i):
            x, y = int(i[0]), int(j[0])
            i, j = i[1:], j[1:]
            common = None if overlap is None else overlap(int(order[x]), int(order[y]))
            if common is None or 100 * common >= percent * (sizes[x] + sizes[y] - common):
                links.append((int(order[x]), int(order[y])))
                label[label == label[y]] = label[x]
                apart = label[i] != label[j]
                i, j = i[apart], j[apart]

    root = _tree(sizes, excess, masks)
    stack = [(root, root)]
    while stack:
        a, b = stack.pop()
        if a is not b and too_small(a, b):
            continue
        if not a.children and not b.children:
            compare(a.members, b.members)
        elif a is b:
            stack += [(x, y) for k, x in enumerate(a.children) for y in a.children[k:]]
        elif a.children and (not b.children or a.members.stop - a.members.start >= b.members.stop - b.members.start):
            stack += [(x, b) for x in a.children]
        else:
            stack += [(a, y) for y in b.children]
    return links


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many elements of 128 bits, rows of two, two sorted sets have in common."""
    _, i, j = np.intersect1d(a[:, 0], b[:, 0], assume_unique=True, return_indices=True)
    both = int((a[i, 1] == b[j, 1]).sum())
    if both == len(i) and not (a[1:, 0] == a[:-1, 0]).any() and not (b[1:, 0] == b[:-1, 0]).any():
        return both
    return len({*map(tuple, a.tolist())} & {*map(tuple, b.tolist())})  # halves of different elements are equal


def similar_sets(sets: list[np.ndarray], percent: int, label: np.ndarray | None = None) -> list[tuple[int, int]]:
    """linked_pairs of sets given as sorted distinct elements of two uint64 each (or of one), none empty."""
    sets = [s if s.ndim == 2 else np.stack([s, np.zeros_like(s)], 1) for s in sets]
    sizes = np.array([len(s) for s in sets])
    words = np.minimum(words_for(np.full(len(sets), sizes.max(initial=1)), BITS_PER_ELEMENT), MOST_WORDS)
    masks = bitmaps(np.concatenate([s[:, 0] for s in sets]), sizes, words) if sets else []
    return linked_pairs(sizes, masks, percent, lambda x, y: common(sets[x], sets[y]), label)
