"""Labelled documents, for fitting: all of them, or bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The most labelled documents that a model is fitted on; all statistics of the corpus cover all documents.
SAMPLE = 20_000
#: Places of a label where labels are shuffled.
SALTS = 8


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of doc_id as text is 1 modulo 3; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def every_label(labels: DataFrame, label: str) -> DataFrame:
    """doc_id and label of every labelled document.

    Rows without doc_id or label do not count; a document with several labels
    has the smallest.
    """
    rows = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id is not null and label is not null")
    return rows.groupBy("doc_id").agg(F.min("label").alias("label"))


def training_labels(labels: DataFrame, label: str) -> DataFrame:
    """``every_label`` without held-out documents."""
    return every_label(labels, label).where(~held_out(F.col("doc_id")))


def label_sample(labels: DataFrame, label: str, most: int = SAMPLE, train_only: bool = True) -> DataFrame:
    """Of ``every_label`` at most ``most`` rows, those with the smallest hash of doc_id.

    Of held-out documents none is taken unless asked for.
    """
    rows = training_labels(labels, label) if train_only else every_label(labels, label)
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def beside_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows that have a doc_id with the label of it, for any number of labels, one for each doc_id.

    Labels and rows are shuffled whatever their number, so the plan is the
    same at every size; each label goes to ``SALTS`` places, so that a doc_id
    of many rows is not one task's.
    """
    salted = labels.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    rows = rows.where("doc_id is not null").withColumn("salt", F.spark_partition_id() % SALTS)
    return rows.join(salted.hint("merge"), ["doc_id", "salt"]).drop("salt")


def with_every_label(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """label and text of documents of any number of labels, one for each doc_id; texts are shuffled."""
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return beside_labels(texts, labels).select("label", "text")
