"""Nulls in any column, empty and very long texts, repeated rows, empty tables and columns of clashing names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import components, documents, shingles
from tickloom.llm import quality_classifier, quality_rules, toxicity
from tickloom.llm.components import components as connected
from tickloom.llm.exact_dedup import exact_dedup
from tickloom.llm.hot import join_split, pieces
from tickloom.llm.jaccard_join import jaccard_components, one_per_group
from tickloom.llm.mixing import mix_sources, mixed_rows, sized
from tickloom.llm.packing_sequences import pack_sequences
from tickloom.llm.queries import URL_RULES
from tickloom.llm.scratch import Scratch
from tickloom.llm.substring_dedup import substring_dedup
from tickloom.llm.url_filter import Rule, filter_rows, filter_urls

public_tokenizers = pytest.importorskip("public_tokenizers")
NAMES = ("kept", "N_Words", "a.b", "__n", "h", "row", "key", "digest", "rid", "level", "name", "bucket", "chunk", "label", "score", "text2", "copies", "limit", "target", "size")
LONG = " ".join(f"w{i % 4000}" for i in range(150_000)) + " end"
ROWS = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None), (2, None), (2, ""), (3, " \n"), (4, LONG), (5, LONG + " more"), (None, "other words than those"), (1, "a text of its own, under an id of others")]


def hard(spark, rows=ROWS):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame([(d, t, None, ("s", None, "t")[i % 3], None) for i, (d, t) in enumerate(rows)], schema)
    return df.select("*", *[F.lit(f"own {n}").alias(n) for n in NAMES])


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, None), (4, None, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")


def operators(spark):
    """How many rows each gives of the hard ones."""
    scratch = lambda: Scratch(spark, "hard")
    path = public_tokenizers.path("word_bpe_49k.json")
    return {
        "exact_dedup": lambda d: exact_dedup(d, scratch()),
        "mix_sources": lambda d: mix_sources((s := scratch()).save(sized(d), "sizes"), s),
        "substring_dedup": lambda d: substring_dedup(d),
        "pack_sequences": lambda d: pack_sequences(d, path, scratch()).where("piece = 0"),
        "quality_classifier": lambda d: quality_classifier.score(d, quality_classifier.fit(d, labels(spark))),
        "toxicity": lambda d: toxicity.score(d, toxicity.fit(d, labels(spark), scratch())),
        "jaccard": lambda d: jaccard_components(d, scratch()),
        "quality_rules": lambda d: quality_rules.judge_rows(d, quality_rules.fit(d, labels(spark))),
    }


@pytest.mark.parametrize("name", ["exact_dedup", "mix_sources", "substring_dedup", "pack_sequences", "quality_classifier", "toxicity", "jaccard", "quality_rules"])
def test_every_row_has_a_result(spark, name):
    run = operators(spark)[name]
    assert run(hard(spark)).count() == len(ROWS)
    assert run(hard(spark, [])).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, tmp_path, name):
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    stage = dict(corpus_pipeline.STAGES)[name]
    for rows in (ROWS, []):
        out = stage(spark, hard(spark, rows), str(tmp_path))
        if name != "pack_sequences":
            assert out.columns == hard(spark).columns
            assert all(r[n] == f"own {n}" for r in out.collect() for n in NAMES)
        else:
            assert out.where("piece = 0").count() == len(rows)


def test_columns_of_judgements(spark):
    docs = documents(spark, ["a b", None]).withColumns({"Kept": F.lit("mine"), "a.b": F.lit(1)})
    model = quality_rules.fit(docs, labels(spark))
    assert [r.kept for r in quality_rules.judge(docs, model).collect()] == [False, False]
    assert {r.row["Kept"] for r in quality_rules.judge_rows(docs, model).collect()} == {"mine"}


def test_urls(spark):
    rows = [(1, "http://x.net/"), (1, "http://x.net/"), (None, None), (2, ""), (3, "http://x.net/" + "y" * 1_000_000), (4, "no url")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({"Rule": F.lit("mine"), "uses": F.lit(1), "a.b": F.lit(2)})
    assert sorted(r.verdict for r in filter_urls(df, URL_RULES).collect()) == ["allow"] * 3 + ["block"] * 3
    assert {r.row["Rule"] for r in filter_rows(df, URL_RULES).collect()} == {"mine"}
    assert filter_urls(df.limit(0), URL_RULES).count() == 0
    table = spark.createDataFrame([tuple(r) for r in URL_RULES] + [("x.net", "/", "allow")], "host string, path string, verdict string")
    assert {r.rule for r in filter_urls(df, table).collect()} == {"x.net/", None}
    assert filter_urls(df, [Rule("net", "/", "allow"), Rule("net", "/", "block")]).where("verdict = 'block'").count() == 3


def test_null_ids_do_not_multiply(spark):
    docs = spark.createDataFrame([(None, f"text number {i % 200} of these words that are its own {i % 200}", "l", "s", 1) for i in range(400)], "doc_id long, text string, lang string, source string, n_chars long")
    found = jaccard_components(docs, Scratch(spark, "t"))
    assert found.count() == 400 and found.where("component_id is not null").count() == 0
    assert one_per_group(docs, Scratch(spark, "t"), percent=100).count() <= 200


def test_a_large_family_makes_as_many_rows(spark):
    """Near copies of one text, in small tiles: every member meets its tile, and little more."""
    base = [f"n{i}" for i in range(120)]
    near = [" ".join(base[:k] + ["other"] + base[k + 1 :]) for k in range(110)] + [" ".join(f"m{i * k}" for i in range(60)) for k in range(1, 30)]
    scratch = Scratch(spark, "t")
    got = {r.doc_id: r.component_id for r in jaccard_components(documents(spark, near), scratch, group_members=20, tile=10).collect()}
    assert got == components({i: shingles(t) for i, t in enumerate(near)})
    met = spark.read.parquet(f"{scratch.root}/groups")
    assert met.count() <= 2 * len(near)


def test_closed_sources_and_shared_ids(spark):
    """No copy beyond three, also of empty documents; rows of one doc_id are taken each for itself."""
    texts = [None if i % 4 == 0 else "w " * (i % 7 + 1) for i in range(900)]
    docs = documents(spark, texts, [("tiny" if i < 40 else "huge") for i in range(900)])
    scratch = Scratch(spark, "t")
    sizes = scratch.save(sized(docs), "sizes")
    rows = mix_sources(sizes, scratch).collect()
    assert max(r.n_copies for r in rows) == 3 and all(r.taken <= 3 * r.size for r in rows)
    emitted = {r.doc_id: r["count"] for r in mixed_rows(docs, sizes, Scratch(spark, "t")).groupBy("doc_id").count().collect()}
    assert max(emitted.values()) == 3 and sum(emitted.values()) == sum(r.n_copies for r in rows)
    same = spark.createDataFrame([(7, f"word{i} and {i}", "l", "ab"[i % 2], 1) for i in range(300)], "doc_id long, text string, lang string, source string, n_chars long")
    scratch = Scratch(spark, "t")
    taken = {}
    for r in mix_sources(scratch.save(sized(same), "sizes"), scratch).collect():
        total, target = taken.get(r.source, (0, 0))
        taken[r.source] = (total + r.taken, r.target)
    assert all(abs(total - target) <= 3 for total, target in taken.values())


def test_hot_keys(spark):
    rows = spark.createDataFrame([(i % 3 if i < 30 else 9, i) for i in range(60)], "k int, i int")
    named = spark.createDataFrame([(0, "a", 10), (1, "b", 10), (9, "c", 30)], "k int, v string, uses int")
    for limit in (0, 15, 100):
        got = sorted((r.i, r.v) for r in join_split(rows, named, ["k"], "uses", limit).collect())
        assert got == [(i, "abc"[i % 3] if i < 30 else "c") for i in range(60) if i >= 30 or i % 3 < 2]
    assert [pieces(n, 10) for n in (None, 0, 1, 10, 11)] == [1, 1, 1, 1, 2]
    star = spark.createDataFrame([(0, i) for i in range(1, 500)], "a long, b long")
    assert {r.root for r in connected(star, Scratch(spark, "t"), "c").collect()} == {0}
