"""The pipeline's stages against brute force, and its queries' columns."""

from __future__ import annotations

import re
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from tests.llm.helpers import base_counts, components, shingles
from tickloom.llm import quality_rules
from tickloom.llm.queries import QUERIES, SQL
from tickloom.llm.scratch import Scratch

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")
COLUMNS = {
    "op1_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op5_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op6_pack_sequences": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op9_jaccard_join": ["doc_id", "n_shingles", "component_id"],
    "op10_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept"],
}


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, scratch, kept = docs.columns, Scratch(spark, "t"), []
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in docs.collect()]
        docs = scratch.save(stage(spark, docs, DATA), name)
        kept.append((name, before, [r.asDict() for r in docs.collect()]))
        if name != "pack_sequences":
            assert docs.columns == columns
    stages = {n: (b, a) for n, b, a in kept}
    ids = lambda rows: sorted(r["doc_id"] for r in rows)

    before, after = stages["quality_rules"]
    model = quality_rules.fit(spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet"))
    from tickloom.llm.text import binary_text
    import pyarrow as pa

    scores = model.scores(*binary_text(pa.array([r["text"] for r in before])))
    good = []
    for r, s in zip(before, scores, strict=True):
        n, _, _, _, again = base_counts(r["text"])
        if n >= 50 and 100 * again <= 50 * n and s >= model.threshold:
            good.append(r)
    assert ids(after) == ids(good) and 0 < len(after) < len(before)

    before, after = stages["exact_dedup"]
    best = {}
    for r in before:
        best.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r["text"] or ""), []).append(r)
    assert ids(after) == ids(min(g, key=lambda r: (-len(r["text"]), r["doc_id"])) for g in best.values())

    before, after = stages["jaccard_join"]
    roots = components({r["doc_id"]: shingles(r["text"], 5) for r in before}, 80)
    assert ids(after) == sorted(set(roots.values()))

    before, after = stages["mix_sources"]
    texts = {r["doc_id"]: r["text"] for r in before}
    assert {r["doc_id"] for r in after} <= set(texts) and all(r["text"] == texts[r["doc_id"]] for r in after)
    size = lambda rows: sum(len(r["text"].split()) for r in rows)
    assert size(after) == pytest.approx(size(before), rel=0.1)
    assert max(ids(after).count(i) for i in texts) <= 3

    before, after = stages["pack_sequences"]
    assert sorted({r["doc_id"] for r in after}) == sorted(set(ids(before)))
    assert len([r for r in after if r["piece"] == 0]) == len(before)


def test_run(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 0
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries(spark, name):
    df = QUERIES[name](spark, DATA)
    if name in COLUMNS:
        assert df.columns == COLUMNS[name]
    rows = df.collect()
    assert name.startswith(("op3", "op6")) or len(rows) == 200
    if name in SQL:
        con = duckdb.connect()
        for path in Path(DATA).glob("*.parquet"):
            con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
        want = con.sql(SQL[name])
        order = [want.columns.index(c) for c in df.columns]
        assert sorted(tuple(map(str, r)) for r in rows) == sorted(tuple(str(r[i]) for i in order) for r in want.fetchall())
