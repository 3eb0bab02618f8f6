from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, documents
from tickloom.llm.exact_dedup import exact_dedup
from tickloom.llm.scratch import Scratch

LONG = "ab" * 50_000
TEXTS = ["a b", "ab", "a\tb ", None, "", " \n", "c", LONG, LONG[:-1] + "x", " " + LONG, "é" * 5000, "é" * 4999 + "e", "x" * 4096, "x" * 8192, "x" * 8193, "x " * 8193, "x" * 12288]


def brute(texts):
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append(i)
    out = {}
    for key, ids in groups.items():
        keep = min(ids, key=lambda i: (-len(texts[i] or ""), i))
        for i in ids:
            out[i] = (keep, len(ids), i == keep, hashlib.sha256(key.encode()).hexdigest())
    return out


def run(spark, df, **options):
    return exact_dedup(df, Scratch(spark, "t"), **options).select("row.*", "keep_id", "group_size", "kept", "text_sha256")


@pytest.mark.parametrize("block", [16, 4096])
def test_against_brute_force(spark, block):
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in run(spark, documents(spark, TEXTS), block_bytes=block).collect()}
    assert got == brute(TEXTS)


def test_digests_that_collide(spark):
    texts = [t for t in TEXTS if t is None or len(t) < 20_000]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in run(spark, documents(spark, texts), block_bytes=64, digest=lambda b: F.pmod(F.xxhash64(b), F.lit(3))).collect()}
    assert got == brute(texts)


def test_repeated_rows_null_ids_and_other_columns(spark):
    rows = [(1, "a", "l", "s", 1)] * 3 + [(None, "a", None, None, None), (None, "q", None, None, None)]
    df = spark.createDataFrame(rows, DOCS).withColumns({"kept": F.lit("mine"), "rid": F.lit(7), "name": F.lit("n"), "h": F.lit(1)})
    out = exact_dedup(df, Scratch(spark, "t")).select("row.doc_id", "row.rid", "kept", "group_size", "keep_id").collect()
    assert sorted((r.doc_id or 0, r.kept, r.group_size, r.keep_id) for r in out if r.group_size > 1) == [(0, False, 4, 1), (1, False, 4, 1), (1, False, 4, 1), (1, True, 4, 1)]
    assert all(r.rid == 7 for r in out) and sum(r.kept for r in out) == 2


def test_empty_table(spark):
    assert run(spark, documents(spark, [])).count() == 0
