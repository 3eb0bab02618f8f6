"""Intermediate tables on the storage that all executors share.

Lineage is cut by writing a Parquet table and reading it again, so a lost
executor costs a re-read rather than a recomputation.  The folder is that of
``session.shared_folder``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_folder, ship


class Scratch:
    """A folder of intermediate tables that belongs to one run of an operator."""

    def __init__(self, spark: SparkSession, label: str):
        ship(spark)
        self.spark = spark
        self.root = f"{shared_folder(spark)}/tickloom/{label}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        """Write ``df`` and return the table that was written."""
        path = f"{self.root}/{name}"
        df.write.option("compression", codec).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing returned so far still reads."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
