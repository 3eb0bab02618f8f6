"""Token counts and packing against the tokenizer library."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
from tests.llm.helpers import DOCS, documents  # noqa: E402
from tickloom.llm.packing_sequences import Encoder, best_fit, pack_sequences  # noqa: E402
from tickloom.llm.scratch import Scratch  # noqa: E402
from tickloom.llm.token_counts import TokenCounter, n_tokens  # noqa: E402

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
COUNTER, ENCODER = TokenCounter(BYTES), Encoder(WORDS)
HARD = ["", "a", "it's  we'll\n\n x", "<|endoftext|>", "a<|endoftext|> b<|startoftext|>", "</w>", "ΑΣ ΣΑ", "İ ŉ ß ẞ", "e\u0301 \u0301", "你好　世界", "\x1c\x85\xa0\u2028", "12½² ١٢", "x" * 5000, "👍🏽 é", "#" * 300 + "\t" * 300]


def library(path, text):
    tokenizer = (COUNTER if path == BYTES else ENCODER).tokenizer
    return tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(text):
    assert COUNTER.count(text) == len(library(BYTES, text))
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == library(WORDS, text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n'sЖa1#")), max_size=60))
def test_any_text(text):
    assert COUNTER.count(text) == len(library(BYTES, text))
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == library(WORDS, text)


def test_whole_tokens_are_proved():
    assert len(COUNTER.whole_tokens()) > 40_000
    assert all(len(library(BYTES, s)) == 1 for s in random.Random(1).sample(sorted(COUNTER.whole_tokens()), 500))


def test_counts_in_spark(spark):
    df = documents(spark, [*HARD, None])
    got = {r.doc_id: r.n for r in df.select("doc_id", n_tokens(F.col("text"), BYTES).alias("n")).collect()}
    assert got == {i: len(library(BYTES, t)) for i, t in enumerate(HARD)} | {len(HARD): 0}


def test_best_fit():
    sizes = np.array([7, 5, 5, 3, 10, 2, 8])
    bins, offsets, fill = best_fit(sizes, 10)
    assert fill.tolist() == [10] * 4
    for b in range(len(fill)):
        at = 0
        for i in np.argsort(offsets + 100 * (bins != b))[: (bins == b).sum()]:
            assert offsets[i] == at
            at += sizes[i]
    assert len(best_fit(np.zeros(0, int), 10)[2]) == 0


@pytest.mark.parametrize("group_items", [3, 1000])
def test_packing(spark, group_items):
    rng = random.Random(7)
    texts = [" ".join(rng.choice(["alpha", "beta", "Gamma", "x1"]) for _ in range(rng.choice([0, 1, 5, 30, 90]))) for _ in range(60)] + [None, "z " * 400]
    df = documents(spark, texts).repartition(5)
    df = df.unionByName(df.where("doc_id = 3")).unionByName(spark.createDataFrame([(None, "alpha", "l", "s", 1)], DOCS)).withColumn("bin", F.lit(1))
    got = pack_sequences(df, WORDS, Scratch(spark, "t"), capacity=64, group_items=group_items).collect()
    pieces, total = {}, 0
    for r in got:
        assert r.start == r.piece * 64
        pieces.setdefault(r.doc_id, []).append((r.piece, r.length, r.ids_crc32))
        total += r.length
    for i, t in enumerate([*texts]):
        ids = np.array([*library(WORDS, t or ""), 0], "<u4")
        want = [(k, len(p), zlib.crc32(p.tobytes())) for k, p in enumerate(ids[a : a + 64] for a in range(0, len(ids), 64))]
        assert sorted(pieces[i]) == sorted(want * (2 if i == 3 else 1))
    assert len(pieces[None]) == 1
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert len(sequences) <= 1.15 * -(-total // 64)


def fills(spark, texts, partitions, **options):
    """How full each sequence is, of texts that are dealt to tasks by their number."""
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, partitions), DOCS)
    got = pack_sequences(df, WORDS, Scratch(spark, "t"), **options)
    return sorted(r.n for r in got.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect())


def test_packing_fills_the_last_tokens(spark):
    assert fills(spark, ["alpha " * 62, ""], 2, capacity=64) == [64]


def test_packing_leaves_no_two_that_fit(spark):
    for seed in range(3):
        rng = random.Random(seed)
        got = fills(spark, ["alpha " * rng.choice([rng.randrange(12), rng.randrange(40, 62)]) for _ in range(40)], 40, capacity=64, group_items=4)
        assert got[0] + got[1] > 64


def test_packing_nothing(spark):
    assert pack_sequences(documents(spark, []), WORDS, Scratch(spark, "t")).count() == 0
