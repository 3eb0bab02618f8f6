from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, components, documents, shingles
from tickloom.llm.components import components as connected
from tickloom.llm.jaccard_join import difference, jaccard_components, keys, one_per_group, size_classes
from tickloom.llm.scratch import Scratch
from tickloom.llm.signature_tree import similar_sets


def families(rng, n, sizes):
    """Texts and changed copies of them, around the threshold."""
    texts = []
    for _ in range(n):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice(sizes))]
        texts.append(base)
        for _ in range(rng.randrange(4)):
            copy = list(base)
            for _ in range(rng.randrange(1 + len(base) // 40)):
                copy[rng.randrange(len(copy))] = "new"
            texts.append(copy[: len(copy) - rng.randrange(1 + len(copy) // 12)])
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("options", [{}, {"group_members": 2, "tile": 2}, {"group_members": 2, "tile": 2, "group_elements": 50}, {"group_elements": 50}])
def test_against_brute_force(spark, options):
    texts = [None, "", " ", "a", "A", "a b", "A  B", "a b c d", "a b c d e", "É é", "é É", *families(random.Random(5), 40, [5, 12, 40, 70, 150, 400])]
    docs = documents(spark, texts).repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs, Scratch(spark, "t"), **options).collect()}
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    want = components({i: s for i, s in sets.items() if s})
    assert got == {i: (len(s), want.get(i, i)) for i, s in sets.items()}
    assert any(want[i] != i for i in want)


def test_hot_groups(spark):
    rng = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(60))
    near = [" ".join(f"n{i}" for i in range(200)).replace(f"n{k} ", "other ") for k in range(60)]
    texts = ["same text of some words here"] * 200 + near + [passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(3, 40))) for _ in range(80)]
    got = {r.doc_id: r.component_id for r in jaccard_components(documents(spark, texts), Scratch(spark, "t"), group_members=20, tile=10).collect()}
    assert got == components({i: shingles(t) for i, t in enumerate(texts)})


@pytest.mark.parametrize("percent", [50, 70, 85, 99])
def test_similar_sets_share_a_key(percent):
    rng = np.random.default_rng(1)
    for size in (1, 2, 5, 7, 20, 64, 65, 99, 300, 1200):
        for _ in range(20):
            a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            drop = rng.integers(0, difference(len(a), percent) + 1)
            add = rng.integers(0, difference(len(a), percent) + 1)
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, add).astype(np.uint64)]))
            common = len(np.intersect1d(a, b))
            if not len(b) or 100 * common < percent * (len(a) + len(b) - common):
                continue
            k, row, short = keys(np.concatenate([a, b]), np.array([len(a), len(b)]), percent)
            assert not short and np.intersect1d(k[row == 0], k[row == 1]).size


def test_only_equal_sets_at_100_percent(spark):
    docs = documents(spark, ["a b c d e", "A b  c d e", "a b c d f"])
    got = {r.doc_id: r.component_id for r in jaccard_components(docs, Scratch(spark, "t"), percent=100).collect()}
    assert got == {0: 0, 1: 0, 2: 2}
    with pytest.raises(ValueError):
        jaccard_components(docs, Scratch(spark, "t"), percent=40)


def test_size_classes_grow():
    lows, parts = size_classes(85)
    assert (np.diff(lows) > 0).all() and (lows[1:-1] <= np.maximum(lows[:-2] + 1, lows[:-2] * 100 / 85)).all()
    at = int(np.searchsorted(lows, 500))
    assert 3.5 < lows[at] / parts[at] < 5


def test_trees_agree_with_all_pairs():
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(150):
        base = rng.integers(0, 2**63, rng.integers(1, 200)).astype(np.uint64)
        for _ in range(3):
            sets.append(np.unique(base[rng.random(len(base)) < 0.95]) if len(base) > 3 else np.unique(base))
    want = components({i: frozenset(s.tolist()) for i, s in enumerate(sets)})
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in similar_sets(sets, 85):
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert {i: find(i) for i in range(len(sets))} == want
    assert similar_sets([], 85) == [] == similar_sets(sets[:1], 85)


def test_null_ids_and_repeated_rows(spark):
    a, b = "one two three four five six", "seven eight nine ten"
    rows = [(3, a), (3, a), (None, a), (None, b), (3, b), (7, None), (7, None)]
    df = spark.createDataFrame([(*r, "l", "s", 1) for r in rows], DOCS).withColumns({"sid": F.lit(1), "digest": F.lit("d"), "root": F.lit(0)})
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(df, Scratch(spark, "t")).collect()), key=str)
    assert got == sorted([(3, 3, 3), (3, 3, 3), (None, 3, 3), (None, 1, 3), (3, 1, 3), (7, 0, 7), (7, 0, 7)], key=str)
    kept = one_per_group(df, Scratch(spark, "t"))
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(3, a), (3, b), (7, None), (7, None)], key=str)


def test_empty_table(spark):
    assert jaccard_components(documents(spark, []), Scratch(spark, "t")).count() == 0
    assert one_per_group(documents(spark, [None, "x"]), Scratch(spark, "t")).count() == 2


def test_connected_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2100)] + [(5, 5)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t"), "c").collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert got == {x: find(x) for x in root}
