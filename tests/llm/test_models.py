"""Quality rules, quality classifier and toxicity: exact parts by brute force, models by held-out accuracy."""

from __future__ import annotations

import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, base_counts, documents
from tickloom.llm import quality_classifier, quality_rules, toxicity
from tickloom.llm.labelled import held_out, label_sample
from tickloom.llm.queries import QUERIES
from tickloom.llm.scratch import Scratch
from tickloom.llm.text import binary_text

DATA = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"
needs_data = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")
HARD = ["", None, "a", " a", "a\nb\na\n \n \nb", "x y z x y z\n\n", "a b c " * 60, "é # $ |\n" * 3, "\n\n", "w" * 100_000]


def test_base_counts():
    rng = random.Random(1)
    texts = HARD + ["".join(rng.choice("ab \n#é\t") for _ in range(rng.randrange(80))) for _ in range(300)]
    got = quality_rules.base_counts(*binary_text(pa.array(texts, pa.string())))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for i, t in enumerate(texts):
        assert tuple(int(got[n][i]) for n in names) == base_counts(t)


def test_grams_stay_in_their_text():
    gram, row = quality_rules.grams(*binary_text(pa.array(["abcd", "ab", "", None, "abc"])))
    assert row.tolist() == [0, 0, 4] and gram[0] == gram[2] != gram[1]


def test_thresholds():
    best = quality_rules.best_threshold
    assert best(np.array([0.0, 1.0, 2.0, 5.0]), np.array([0, 0, 1, 1])) == 1.5
    assert best(np.array([1.0]), np.array([1])) == float("-inf")
    assert best(np.array([1.0, 1.0]), np.array([0, 1])) < 1.0


def corpus(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
    texts, labels = [], []
    for i in range(240):
        bad, toxic = i % 4 == 0, i % 5 == 0
        w = [word() for _ in range(80)]
        w = [x.upper() + "###" for x in w] if bad else w
        for k in rng.sample(range(80), 6) if toxic else ():
            w[k] = rng.choice(["idiot", "moron", "scum", "trash", "loser"])
        texts.append(" ".join(w))
        labels.append((i, int(not bad), int(toxic)))
    return documents(spark, [*texts, None, ""]), spark.createDataFrame(labels, LABELS)


def test_rules(spark):
    docs, labels = corpus(spark)
    out = quality_rules.judge(docs.withColumn("kept", F.lit("mine")), quality_rules.fit(docs, labels)).collect()
    for r in out:
        counts = base_counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert r.base_failed is failed
        assert r.kept is (not failed and r.doc_id % 4 != 0)
    plain = quality_rules.judge(docs, quality_rules.fit(docs, labels.limit(0))).collect()
    assert all(r.kept is not r.base_failed and r.llr == 0 for r in plain)
    assert quality_rules.judge(docs.limit(0), quality_rules.fit(docs.limit(0), labels)).count() == 0


def test_llr_by_brute_force(spark):
    docs, labels = corpus(spark)
    model = quality_rules.fit(docs, labels)
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    from collections import Counter

    grams = lambda t: [t[i : i + 3] for i in range(len(t) - 2)]
    bucket = {}
    for g in {g for t in texts.values() for g in grams(t)}:
        bucket[g] = int(quality_rules.grams(*binary_text(pa.array([g], pa.binary())))[0][0])
    raw, trusted = Counter(), Counter()
    for d, t in texts.items():
        for g in grams(t):
            raw[bucket[g]] += 1
            trusted[bucket[g]] += d in good
    all_raw = sum(raw.values()) + 1e-3 * quality_rules.BUCKETS
    p = {b: (n + 1e-3) / all_raw for b, n in raw.items()}
    q = {b: (trusted[b] + quality_rules.PRIOR * p[b]) / (sum(trusted.values()) + quality_rules.PRIOR) for b in raw}
    for d in list(texts)[:20]:
        ratio = [np.log(q[bucket[g]] / p[bucket[g]]) for g in grams(texts[d])]
        assert model.scores(*binary_text(pa.array([texts[d]], pa.binary())))[0] == pytest.approx(np.mean(ratio))


def test_trusted_counts_take_every_label(spark):
    docs, labels = corpus(spark)
    docs = docs.unionByName(docs.where("doc_id < 20")).unionByName(docs.limit(9).withColumn("doc_id", F.lit(None).cast("long")))
    want = quality_rules.fit(docs, labels).ratio
    assert np.array_equal(quality_rules.fit(docs, labels, sample=10).ratio, want)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert np.array_equal(quality_rules.fit(docs.repartition(5), labels, sample=10).ratio, want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_label_sample(spark):
    rows = [(i % 50, i % 2, None) for i in range(100)] + [(None, 1, 1), (7, None, 1)]
    labels = spark.createDataFrame(rows, LABELS)
    got = {r.doc_id: r.label for r in label_sample(labels, "quality", 1000).collect()}
    assert got == {i: i % 2 for i in range(50) if zlib.crc32(str(i).encode()) % 3 != 1}
    assert label_sample(labels, "quality", 7).count() == 7
    flags = {r[0]: r[1] for r in labels.select("doc_id", held_out(F.col("doc_id"))).collect()}
    assert flags[None] is False and all(v == (zlib.crc32(str(k).encode()) % 3 == 1) for k, v in flags.items() if k is not None)


def test_passages():
    texts = ["", None, "a " * 100, "B", " x"]
    x, n = quality_classifier.passages(*binary_text(pa.array(texts)))
    assert n.tolist() == [1, 1, 3, 1, 1] and not x[:2].any() and x.shape == (7, quality_classifier.FEATURES)
    alone, _ = quality_classifier.passages(*binary_text(pa.array(["B"])))
    assert np.allclose(alone[0], x[5])


def test_gradient():
    rng = np.random.default_rng(0)
    x, n, y = rng.normal(size=(7, quality_classifier.FEATURES)), np.array([3, 1, 3]), np.array([1.0, 0.0, 1.0])
    model = quality_classifier.train(x, n, y)

    def loss():
        s, _ = model.forward(x, n)
        return np.mean(np.log1p(np.exp(s)) - y * s)

    s, state = model.forward(x, n)
    gradient = model.gradient(state, 1 / (1 + np.exp(-s)) - y)
    for name, value in model.p.items():
        at = tuple(0 for _ in value.shape)
        old = value[at]
        value[at] = old + 1e-6
        up = loss()
        value[at] = old - 1e-6
        down = loss()
        value[at] = old
        assert gradient[name][at] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def accuracy(scored, labels, name, limit):
    rows = scored.join(labels, "doc_id").where(held_out(F.col("doc_id"))).select("score", name).collect()
    return np.mean([(r.score >= limit) == (r[name] == 1) for r in rows])


def test_quality_classifier(spark):
    docs, labels = corpus(spark)
    model = quality_classifier.fit(docs, labels)
    scored = quality_classifier.score(docs, model)
    assert accuracy(scored, labels, "quality", 0.5) > 0.95
    rows = {r.doc_id: r.score for r in scored.collect()}
    assert len(rows) == 242 and all(0 <= s <= 1 for s in rows.values())
    again = quality_classifier.score(docs.repartition(5), quality_classifier.fit(docs.repartition(3), labels))
    assert {r.doc_id: r.score for r in again.collect()} == pytest.approx(rows)
    assert {r.score for r in quality_classifier.score(docs, quality_classifier.fit(docs, labels.limit(0))).collect()} == {0.5}
    assert quality_classifier.score(docs.limit(0), model).count() == 0


def test_label_model_recovers_rates():
    rng = np.random.default_rng(5)
    n, prior = 40_000, 0.1
    toxic = rng.random(n) < prior
    hit, miss = np.array([0.5, 0.4, 0.3, 0.45, 0.05, 0.4]), np.array([0.01, 0.002, 0.01, 0.03, 0.05, 0.01])
    votes = (rng.random((n, 6)) < np.where(toxic[:, None], hit, miss)).astype(int)
    votes = np.c_[votes, votes[:, 0] & (rng.random(n) < 0.95)]  # nearly a copy of the first
    model = toxicity.fit_label_model(votes.T @ votes, n, prior)
    assert model.rate_toxic[[0, 1, 2, 3, 5]] == pytest.approx(hit[[0, 1, 2, 3, 5]], abs=0.08)
    assert model.correlated[0, 6] and model.correlated[6, 0] and not model.correlated[1, 2]
    assert model.weight[4] < 0.2 < model.weight[1]
    assert model.weight[0] < np.log(model.rate_toxic[0] / model.rate_other[0])
    p = model.posterior(votes)
    assert p[toxic].mean() > 0.6 > 0.2 > p[~toxic].mean()


def test_entries():
    h = toxicity.entry_hashes(["idiot", "shut up"])
    row, entry = toxicity.Lookup(h).present(*toxicity._hashed(pa.array(["You IDIOT!!", "shut  up", "shutup idiots", None, "idiot#idiot"])))
    assert list(zip(row.tolist(), entry.tolist(), strict=True)) == [(0, 0), (1, 1), (4, 0)]


def test_toxicity(spark):
    docs, labels = corpus(spark)
    model = toxicity.fit(docs, labels, Scratch(spark, "t"))
    scored = toxicity.score(docs, model)
    assert accuracy(scored, labels, "toxic", 0.7) > 0.95
    assert scored.count() == 242
    bare = toxicity.score(docs, toxicity.fit(docs, labels.limit(0), Scratch(spark, "t")))
    assert accuracy(bare, labels, "toxic", 0.7) > 0.9
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels, Scratch(spark, "t"))).count() == 0
    odd = spark.createDataFrame([(None, "idiot", "l", "s", 1), (1, None, "l", "s", 1), (1, "x" * 200_000, "l", "s", 1)], DOCS)
    assert toxicity.score(odd, model).count() == 3


@needs_data
@pytest.mark.parametrize(("name", "label", "least"), [("op7_quality_classifier", "quality", 0.95), ("op8_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    out = QUERIES[name](spark, DATA)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r[label] for r in rows]) >= least


def test_attention_by_brute_force():
    """Scores of whole texts, one passage and one word at a time."""
    texts = ["", None, "one two three " * 40, "B", "Long words and short ones, " * 9]
    data = binary_text(pa.array(texts))
    rng = np.random.default_rng(2)
    x, n = quality_classifier.passages(*data)
    ids, sizes = quality_classifier.word_bags(*data)
    assert sizes.tolist() == [0, 0, 96, 96, 48, 2, 90]
    model = quality_classifier.train(x, n, np.array([0.0, 1.0, 1.0, 0.0, 1.0]), (ids, sizes))
    p = model.p
    p["W"] = rng.normal(size=p["W"].shape)
    got, at, word = model.scores(*data), 0, 0
    for k, score in zip(n, got, strict=True):
        z, a = [], []
        for i in range(at, at + k):
            own = ids[word : word + sizes[i]]
            word += sizes[i]
            mean = np.mean([p["W"][j] for j in own], axis=0) if len(own) else np.zeros(quality_classifier.WORD_WIDTH)
            z.append(np.tanh(np.r_[(x[i] - model.mean) / model.scale, mean] @ p["E"] + p["e"]))
            a.append(np.sum(p["w"] * np.tanh(z[-1] @ p["V"]) / (1 + np.exp(-(z[-1] @ p["U"])))))
        weight = np.exp(a) / np.exp(a).sum()
        odds = sum(w * v for w, v in zip(weight, z, strict=True)) @ p["c"] + p["d"][0]
        assert score == pytest.approx(1 / (1 + np.exp(-odds)), abs=1e-6)
        at += k


def test_embedding_gradient():
    rng = np.random.default_rng(0)
    x, n, y = rng.normal(size=(4, quality_classifier.FEATURES)), np.array([3, 1]), np.array([1.0, 0.0])
    bag = np.array([5, 6, 5, 7, 8], np.int32), np.array([2, 0, 2, 1])
    model = quality_classifier.train(x, n, y, bag)

    def loss():
        s, _ = model.forward(x, n, bag)
        return np.mean(np.log1p(np.exp(s)) - y * s)

    s, state = model.forward(x, n, bag)
    gradient = model.gradient(state, 1 / (1 + np.exp(-s)) - y)["W"]
    for at in ((5, 0), (6, 1), (7, 2), (8, 3), (9, 0)):
        old = model.p["W"][at]
        model.p["W"][at] = old + 1e-6
        up = loss()
        model.p["W"][at] = old - 1e-6
        down = loss()
        model.p["W"][at] = old
        assert gradient[at] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_label_model_by_brute_force():
    """Gaps from each triplet of voters, and posteriors vote by vote."""
    rng = np.random.default_rng(8)
    n, prior = 30_000, 0.2
    toxic = rng.random(n) < prior
    votes = (rng.random((n, 4)) < np.where(toxic[:, None], [0.5, 0.4, 0.6, 0.3], [0.02, 0.01, 0.03, 0.01])).astype(int)
    model = toxicity.fit_label_model(votes.T @ votes, n, prior)
    assert not model.correlated.any()
    rate = votes.mean(0)
    cov = lambda i, j: (votes[:, i] * votes[:, j]).mean() - rate[i] * rate[j]
    for i in range(4):
        others = [j for j in range(4) if j != i]
        gap = np.sqrt(np.median([cov(i, j) * cov(i, k) / cov(j, k) / prior / (1 - prior) for j in others for k in others if j != k]))
        high, low = rate[i] + (1 - prior) * gap, max(rate[i] - prior * gap, 0.02 * rate[i] + 1e-7)
        assert model.weight[i] == pytest.approx(np.clip(np.log(high / low), 0, 6))
    for row in votes[:50]:
        odds = np.log(prior / (1 - prior)) + sum(w for w, v in zip(model.weight, row, strict=True) if v)
        assert model.posterior(row[None])[0] == pytest.approx(1 / (1 + np.exp(-odds)))


def test_best_cut():
    assert toxicity.best_cut(np.array([3.0, 2.0, 1.0, 0.0]), np.array([1, 1, 0, 0])) == 1.5
    assert toxicity.best_cut(np.array([1.0, 1.0, 0.0]), np.array([1, 0, 0])) == 0.5
