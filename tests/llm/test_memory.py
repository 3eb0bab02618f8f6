"""What Python workers hold beside the tasks of an executor."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark import SparkContext

import corpus_pipeline
from tests.llm.helpers import documents

SMAPS = Path("/proc/self/smaps_rollup")
KERNEL = """
import re, pathlib
import numpy as np, pyarrow as pa
from tickloom.llm import jaccard_join, quality_rules

def held():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", pathlib.Path("/proc/self/smaps_rollup").read_text())[1]) >> 10

def batches(rng):
    for _ in range(3):
        texts = [b" ".join(b"%x" % x for x in rng.integers(0, 1 << 20, 800)) for _ in range(400)]
        number = pa.array(np.arange(len(texts)))
        yield pa.RecordBatch.from_arrays([number, number, number, number, pa.array(texts, pa.binary())], ["doc_id", "row", "key", "digest", "text"])

model = quality_rules.Model(np.zeros(quality_rules.BUCKETS), 0.0)
kernels = {
    "scored": lambda b: quality_rules._scored(b, model),
    "judged": lambda b: quality_rules._judged(b, model),
    "documents": lambda b: jaccard_join._documents(b, 5, 80, 1e-15, 4),
}
started = held()
for _ in kernels[NAME](batches(np.random.default_rng(1))):
    pass
print(held() - started)
"""


@pytest.mark.skipif(not SMAPS.exists(), reason="needs /proc")
@pytest.mark.parametrize("name", ["scored", "judged", "documents"])
def test_a_worker_gives_back_what_a_task_took(name):
    code = f"NAME = {name!r}{KERNEL}"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=Path(__file__).parents[2])
    assert int(out.stdout) < 45


@pytest.mark.parametrize("stage", ["mix_sources", "pack_sequences"])
def test_small_tables_start_no_python_workers(spark, stage, monkeypatch):
    """createDataFrame sends a list through Python workers, of an environment of their own."""
    docs = documents(spark, ["a b c", "d e", None, ""]).localCheckpoint()
    monkeypatch.setattr(SparkContext, "parallelize", lambda *a, **b: pytest.fail("rows of a list"))
    assert dict(corpus_pipeline.STAGES)[stage](spark, docs, "").count() >= 4 * (stage == "pack_sequences")
