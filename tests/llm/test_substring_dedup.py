from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, documents, words
from tickloom.llm import substring_dedup as op


def brute(rows, width):
    """rows: (doc_id, text); n_words, n_removed, kept text."""
    key = lambda d: float("inf") if d is None else d
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - width + 1):
            k = tuple(w[i : i + width])
            first[k] = min(first.get(k, key(d)), key(d))
    out = []
    for d, t in rows:
        w = words(t)
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i : i + width])] < key(d):
                gone |= set(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def run(df, width=13):
    return sorted((tuple(r) for r in op.substring_dedup(df, width).collect()), key=str)


@pytest.mark.parametrize("chunk", [1, 4 << 20])
def test_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(op, "CHUNK_BYTES", chunk)
    rng = random.Random(3)
    vocabulary = ["a", "b", "é", "dd", "x\u00a0y"]
    passage = " ".join(rng.choice(vocabulary) for _ in range(30))
    texts = [None, "", " \t", passage, "q " + passage + " z", passage[:20], passage + "\n" + passage, "a " * 40, "a " * 15]
    texts += [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60))) for _ in range(40)]
    for width in (3, 13):
        rows = list(enumerate(texts))
        assert run(documents(spark, texts).repartition(3), width) == brute(rows, width)


def test_null_ids_repeated_rows_and_other_columns(spark):
    t = " ".join(map(str, range(20)))
    rows = [(5, t), (5, t), (None, t), (2, "x " + t), (5, t + " y"), (None, t)]
    df = spark.createDataFrame([(*r, "l", "s", 1) for r in rows], DOCS).withColumns({"digest": F.lit("mine"), "bucket": F.lit(1)})
    assert run(df) == brute(rows, 13)


def test_long_text(spark):
    t = " ".join(f"w{i % 5000}" for i in range(200_000))
    rows = [(1, t), (2, "start " + t[: len(t) // 2])]
    assert run(documents(spark, [None, *[r[1] for r in rows]])) == brute([(0, None), *rows], 13)


def test_empty_table(spark):
    assert run(documents(spark, [])) == []
