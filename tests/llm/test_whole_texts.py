"""The quality classifier is fitted on whole texts."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import Row

from tests.llm.helpers import documents
from tests.llm.test_models import LABELS, accuracy
from tickloom.llm import quality_classifier
from tickloom.llm.text import binary_text


def test_fit_reads_the_ends_of_texts(spark):
    """Texts that are alike in their first 64 passages, and differ after them."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
    start = " ".join(word() for _ in range(64 * quality_classifier.PASSAGE))
    texts = [start + " " + " ".join(word() if i % 2 else word().upper() + "###" for _ in range(400)) for i in range(120)]
    docs, labels = documents(spark, texts), spark.createDataFrame([(i, i % 2, 0) for i in range(120)], LABELS)
    assert accuracy(quality_classifier.score(docs, quality_classifier.fit(docs, labels)), labels, "quality", 0.5) > 0.95


def test_pieces_in_any_order(monkeypatch):
    rng = random.Random(2)
    texts = ["", None, "a " * 700, "B", *[" ".join(rng.choice(["x", "yy", "Zed", "#"]) for _ in range(rng.randrange(900))) for _ in range(20)]]
    labels = [i % 2 for i in range(len(texts))]
    data = binary_text(pa.array(texts))
    x, n = quality_classifier.passages(*data)
    ids, sizes = quality_classifier.word_bags(*data)
    monkeypatch.setattr(quality_classifier, "STEPS", 20)
    want = quality_classifier.train(x, n, np.array(labels, float), (ids, sizes))
    batch = pa.RecordBatch.from_pydict({"doc_id": range(len(texts)), "label": pa.array(labels, pa.int32()), "text": pa.array(texts)})
    for piece, order in ((4_096, 1), (3, 1), (3, -1)):
        monkeypatch.setattr(quality_classifier, "PIECE", piece)
        rows = [Row(**r) for b in quality_classifier._encoded(iter([batch])) for r in b.to_pylist()]
        assert len(rows) == (len(texts) if piece > 20 else sum(-(-k // piece) for k in n))
        got = quality_classifier._trained(rows[::order])
        assert all(np.allclose(got.p[k], v, rtol=0, atol=1e-9) for k, v in want.p.items())
    monkeypatch.setattr(quality_classifier, "AT_ONCE", 9)
    one_by_one = quality_classifier.train(x, n, np.array(labels, float), spans=None)
    monkeypatch.setattr(quality_classifier, "AT_ONCE", 10**9)
    at_once = quality_classifier.train(x, n, np.array(labels, float), spans=None)
    assert all(np.allclose(one_by_one.p[k], v, rtol=0, atol=1e-9) for k, v in at_once.p.items())
    assert quality_classifier._trained([]) is None
