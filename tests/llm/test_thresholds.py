"""Thresholds of all labelled documents, whatever their number."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import documents
from tests.llm.test_models import corpus
from tickloom.llm import labelled, quality_rules


def by_hand(scores, labels, cost):
    """Every cut, one at a time: least errors, then widest gap, then lowest."""
    s = sorted(set(scores))
    cuts = [(s[0] - 1e-9, 0.0), *[((a + b) / 2, b - a) for a, b in zip(s, s[1:], strict=False)], (s[-1] + 1e-9, 0.0)]
    errors = lambda t: sum(cost if y == 1 and x < t else y == 0 and x >= t for x, y in zip(scores, labels, strict=True))
    return min(cuts, key=lambda c: (errors(c[0]), -c[1]))[0] if {0, 1} <= set(labels) else float("-inf")


def cases():
    rng = random.Random(6)
    yield [1.0, 2.0], [1, 1]
    yield [0.0, 1.0, 2.0, 5.0], [0, 0, 1, 1]
    yield [2.0, 1.0, 1.0], [0, 1, 1]
    for i in range(12):
        labels = [rng.choice([0, 1, 1, 2]) for _ in range(200)]
        spread = (0.1, 3, 30, 1000)[i % 4]
        yield [rng.randrange(-60, 60) / 8 if i % 2 else rng.gauss(y * 40 / spread, 1) for y in labels], labels


def test_best_threshold():
    for scores, labels in cases():
        for cost in (1.0, 20.0):
            assert quality_rules.best_threshold(np.array(scores), np.array(labels), cost) == by_hand(scores, labels, cost)


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_threshold_of_many_partitions(spark, coalesce):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    for (k, _), v in zip(before.items(), ("9", coalesce, "7"), strict=True):
        spark.conf.set(k, v)
    try:
        for scores, labels in cases():
            rows = spark.createDataFrame(list(zip(scores, labels, strict=True)), "score double, label int").repartition(3)
            assert quality_rules.threshold_of(rows) == by_hand(scores, labels, quality_rules.TRUSTED_COST)
        assert quality_rules.threshold_of(rows.limit(0)) == float("-inf")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


BAD = "concat_ws(' ', transform(sequence(1, 55), i -> concat('XYZ###', (doc_id + i * i) % 977))) as text"


def many_labels(spark):
    """Documents, labels and bad ids: more labels than the bounded sample had, of which those behind it alone are 0."""
    ids = spark.range(70_000).selectExpr("id as doc_id")
    ones = ids.selectExpr("doc_id", "1 as quality", "0 as toxic")
    late = {r.doc_id for r in labelled.training_labels(ones, "quality").collect()} - {r.doc_id for r in labelled.label_sample(ones, "quality").collect()}
    assert len(late) > 20_000
    bad = spark.createDataFrame([(d,) for d in sorted(late)[:3000]], "doc_id long")
    text = lambda word: f"concat_ws(' ', transform(sequence(1, 55), i -> concat('{word}', (doc_id + i * i) % 977))) as text"
    good = ids.join(bad, "doc_id", "anti")
    docs = good.selectExpr("doc_id", text("abc")).union(bad.selectExpr("doc_id", text("XYZ###")))
    return docs, good.selectExpr("doc_id", "1 as quality").union(bad.selectExpr("doc_id", "0")), bad


def test_threshold_takes_every_label(spark):
    """Labels behind the sample decide."""
    docs, labels, bad = many_labels(spark)
    model = quality_rules.fit(docs, labels)
    assert model.threshold > float("-inf")  # the sample had none that is marked 0
    assert quality_rules.judge(docs.join(bad, "doc_id"), model).where("kept").count() == 0
    assert quality_rules.judge(docs.join(bad, "doc_id", "anti"), model).where("not kept").count() == 0


def test_pipeline_takes_every_label(spark, tmp_path):
    docs, labels, bad = many_labels(spark)
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.keep_good(spark, docs, str(tmp_path)).select("doc_id").cache()
    assert kept.count() == 67_000 and kept.join(bad, "doc_id").count() == 0


def test_pipeline_takes_labels_of_every_third(spark, tmp_path):
    """Labels that op 10 holds out decide in the pipeline, which judges nothing on them."""
    docs, _, bad = many_labels(spark)
    held = spark.range(70_000).where(labelled.held_out(F.col("id"))).selectExpr("id as doc_id")
    docs = docs.join(bad, "doc_id", "anti").join(held, "doc_id", "anti").limit(500).union(held.limit(60).selectExpr("doc_id", BAD)).cache()
    labels = docs.selectExpr("doc_id", "if(text like 'XYZ%', 0, 1) as quality", "0 as toxic").cache()
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert quality_rules.fit(docs, labels).threshold == float("-inf")
    kept = corpus_pipeline.keep_good(spark, docs, str(tmp_path))
    assert kept.count() == 500 and kept.where("text like 'XYZ%'").count() == 0


def test_rows_that_share_an_id(spark):
    """Every row of a labelled document counts, in whatever partition it is."""
    docs, labels = corpus(spark)
    docs = docs.unionByName(docs.where("doc_id % 3 = 0")).unionByName(documents(spark, ["x " * 60] * 4))
    model = quality_rules.fit(docs, labels)
    train = {r.doc_id: r.label for r in labelled.training_labels(labels, "quality").collect()}
    rows = [(r.llr, train[r.doc_id]) for r in quality_rules.judge(docs, model).collect() if r.doc_id in train]
    assert model.threshold == by_hand(*zip(*rows, strict=True), quality_rules.TRUSTED_COST)
    assert quality_rules.fit(docs.repartition(7), labels.repartition(5)).threshold == model.threshold
