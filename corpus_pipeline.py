"""A corpus pipeline: quality rules, exact and near deduplication, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one
before kept.  All but the last return the columns of ``documents``, or of what
they are given, whatever the names of further ones.  Null and empty texts do not
pass the quality rules; a stage that is given them keeps one row of all that are
equal (exact copies) or every one (near copies), mixes them with size 0 and
packs them as one token.  Null ids and rows that repeat are documented at the
operators.  Empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import quality_rules
from tickloom.llm.exact_dedup import exact_dedup
from tickloom.llm.hot import spread
from tickloom.llm.jaccard_join import one_per_group
from tickloom.llm.mixing import mixed_rows, sized
from tickloom.llm.packing_sequences import pack_sequences
from tickloom.llm.scratch import Scratch
from tickloom.session import ship


#: Words of a shingle, and the similarity from which documents are near copies.
NEAR_WIDTH, NEAR_PERCENT = 5, 80


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; the raw multinomial is that of docs, the threshold that of every label."""
    ship(spark)
    model = quality_rules.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), hold_out=False)
    return quality_rules.judge_rows(docs, model).where("kept").select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact_dedup(docs, Scratch(spark, "pipeline-copies")).where("kept").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of similar texts: of five-word shingles, four fifths of which are the same."""
    return one_per_group(docs, Scratch(spark, "pipeline-near"), width=NEAR_WIDTH, percent=NEAR_PERCENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it, up to three times."""
    scratch = Scratch(spark, "pipeline-mix")
    return mixed_rows(docs, scratch.save(sized(docs), "sizes"), scratch)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    return pack_sequences(docs, public_tokenizers.path("word_bpe_49k.json"), Scratch(spark, "pipeline-pack"))


STAGES = [
    ("quality_rules", keep_good),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("mix_sources", mix),
    ("pack_sequences", pack),
]

#: Signature trees, importance ratios and packing have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs
