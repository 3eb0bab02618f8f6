from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, documents
from tickloom.llm.mixing import mix_sources, mixed_rows, sized
from tickloom.llm.queries import OP4_SQL
from tickloom.llm.scratch import Scratch


def mix(spark, docs):
    scratch = Scratch(spark, "t")
    return mix_sources(scratch.save(sized(docs), "sizes"), scratch)


def water(sizes):
    """Targets by sharing again and again what is above three times a source."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, rest, open_ = dict.fromkeys(names, 0.0), float(sum(sizes.values())), set(names)
    while open_ and rest > 1e-9:
        unit = rest / sum(weight[s] for s in open_)
        rest = 0.0
        for s in sorted(open_, key=str):
            target[s] += unit * weight[s]
        for s in list(open_):
            if target[s] >= 3 * sizes[s]:
                rest += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.discard(s)
    return target


def test_targets_and_taken(spark):
    texts, sources = [], []
    for source, n in (("a", 400), ("b", 30), ("c", 5), ("Z", 90), ("é", 60), (None, 40), ("empty", 3)):
        for i in range(n):
            texts.append(None if source == "empty" else "w " * (i % 17 + 1))
            sources.append(source)
    docs = documents(spark, texts, sources)
    rows = mix(spark, docs).collect()
    sizes = {}
    for r in rows:
        sizes[sources[r.doc_id]] = sizes.get(sources[r.doc_id], 0) + r.size
        assert r.size == len((texts[r.doc_id] or "").split()) and 0 <= r.taken <= 3 * r.size
    want, taken, got = water(sizes), {}, {}
    for r in rows:
        s = sources[r.doc_id]
        got[s], taken[s] = r.target, taken.get(s, 0) + r.taken
        assert r.source_size == sizes[s]
    assert got == pytest.approx(want)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    assert all(abs(taken[s] - want[s]) <= 9 for s in want)  # half of the largest document
    again = {(r.doc_id, r.taken) for r in mix(spark, docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def test_sql_agrees(spark):
    texts = ["w " * (i * 7 % 23) for i in range(300)] + [None]
    docs = documents(spark, texts, [("x", "y", "z", None)[i * i % 4] for i in range(301)])
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    got = sorted(tuple(r) for r in mix(spark, docs).select("doc_id", "size", "source_size", "target", "taken").collect())
    assert got == sorted(con.sql(OP4_SQL).fetchall())


def test_rows_follow_the_plan(spark):
    docs = documents(spark, ["w " * (i % 9 + 1) for i in range(200)], ["ab"[i % 10 == 0] for i in range(200)]).withColumn("h", F.lit("mine"))
    plan = {r.doc_id: r.n_copies for r in mix(spark, docs).collect()}
    rows = mixed_rows(docs, sized(docs), Scratch(spark, "t"))
    assert rows.columns == docs.columns
    got = {r.doc_id: r["count"] for r in rows.groupBy("doc_id").count().collect()}
    assert got == {d: n for d, n in plan.items() if n}


def test_hard_rows(spark):
    assert mix(spark, documents(spark, [])).count() == 0
    nothing = mix(spark, documents(spark, [None, "", " "])).collect()
    assert [(r.size, r.target, r.taken) for r in nothing] == [(0, 0.0, 0)] * 3
    same = spark.createDataFrame([(1, "a b", "l", "s", 1)] * 4 + [(None, "c", "l", None, 1)] * 2, DOCS)
    assert len(mix(spark, same).collect()) == 6
