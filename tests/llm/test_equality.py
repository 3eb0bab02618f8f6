"""Equality is that of words and lines, not of their hashes."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import base_counts, components, documents, shingles
from tests.llm.test_substring_dedup import brute, run
from tickloom.llm import jaccard_join, quality_rules, substring_dedup
from tickloom.llm.jaccard_join import jaccard_components, keys
from tickloom.llm.scratch import Scratch
from tickloom.llm.text import Words, binary_text, chained, rolling


def thue_morse(n):
    """Two strings whose polynomial hashes modulo 2**64 are equal for every odd base."""
    x = "a"
    while len(x) < n:
        x += x.translate(str.maketrans("ab", "ba"))
    return x, x.translate(str.maketrans("ab", "ba"))


PAIRS = [thue_morse(n) for n in (512, 1024, 4096)]


def texts():
    rng, out = random.Random(2), []
    for a, b in PAIRS:
        rest = " ".join(str(rng.random()) for _ in range(20))
        out += [f"{a} " * 13, f"{b} " * 13, f"{a} {rest}", f"{b} {rest}", f"{a} {a} {b}\n{a}\n{b}\n{a}", f"{a} x {a} {b} x {b}"]
    return out


def test_lines_and_words():
    got = quality_rules.base_counts(*binary_text(pa.array(texts())))
    for i, t in enumerate(texts()):
        assert tuple(int(got[k][i]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == base_counts(t)


def test_windows(spark):
    rows = list(enumerate(texts()))
    assert run(documents(spark, [t for _, t in rows])) == brute(rows, 13)


def test_sets(spark):
    got = {r.doc_id: r.component_id for r in jaccard_components(documents(spark, texts()), Scratch(spark, "t")).collect()}
    assert got == components({i: shingles(t) for i, t in enumerate(texts())})


@pytest.mark.parametrize("hash_bytes", [1, 2])
def test_windows_of_equal_hashes(spark, monkeypatch, hash_bytes):
    """Hashes of a byte or two propose much that is not so; the words decide."""
    monkeypatch.setattr(substring_dedup, "HASH_BYTES", hash_bytes)
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 1)
    rng = random.Random(4)
    passage = " ".join(str(rng.random()) for _ in range(20))
    rows = [(i, f"{rng.random()} " * 2 + (passage if i % 3 == 0 else "") + " " + " ".join(str(rng.random()) for _ in range(14))) for i in range(30)]
    assert run(documents(spark, [t for _, t in rows])) == brute(rows, 13)


def test_rolling_and_chained():
    values = np.random.default_rng(1).integers(0, 2**63, 40).astype(np.uint64)
    base = 0xD1342543DE82EF95 | 1
    for width in (1, 2, 3, 7, 8, 13, 40):
        want = [sum(int(v) * pow(base, j, 2**64) for j, v in enumerate(values[i : i + width])) % 2**64 for i in range(len(values) - width + 1)]
        assert rolling(values, width).tolist() == want
        assert len(set(chained(values, width, 1).tolist()) | set(chained(values, width, 2).tolist())) == 2 * len(want)


def test_words_are_numbered_by_content():
    words = Words(*binary_text(pa.array(["b a b", None, " é b ", "a"])))
    code, size = words.codes
    assert size == 3 and code[0] == code[2] == code[4] != code[1] == code[5]
    low, high = words.digests
    assert len(set(low.tolist())) == len(set(high.tolist())) == 3 and not set(low.tolist()) & set(high.tolist())


def test_sets_with_too_few_parts_are_noticed():
    rng = np.random.default_rng(3)
    sets = [np.sort(rng.integers(0, 2**63, 400).astype(np.uint64)) for _ in range(50)]
    for h in sets:
        for miss in (0.999999, jaccard_join.MISS):
            lows, parts = jaccard_join.size_classes(85, miss)
            k = int(parts[np.searchsorted(lows, 400, "right") - 1])
            lacks = len(np.unique(h % np.uint64(k))) <= jaccard_join.difference(400, 85)
            assert keys(h, np.array([400]), 85, miss)[2] >= lacks
    assert not any(keys(h, np.array([400]), 85)[2] for h in sets)


def test_keys_are_made_again(spark, monkeypatch):
    """Where sets have too few parts, more parts are tried, and no link is lost."""
    rng = random.Random(1)
    base = [str(rng.random()) for _ in range(60)]
    near = [" ".join(base[:k] + ["x"] + base[k + 1 :]) for k in range(3)]
    monkeypatch.setattr(jaccard_join, "MISS", 0.5)
    got = {r.doc_id: r.component_id for r in jaccard_components(documents(spark, near), Scratch(spark, "t")).collect()}
    assert got == components({i: shingles(t) for i, t in enumerate(near)})
