"""A lake of hive-partitioned Parquet tables: exchange, symbol, year, month.

Months are two digits in folder names and integers when read.  Files are sorted
by time, so that row groups can be skipped, and a hot partition is written by
as many tasks as its share of the rows asks for.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions.times import from_micros, micros_of, year_and_month
from ..operators.trades import merge_rows
from ..schemas import LAKE_KEYS

#: Columns that folders name.
FOLDERS = [StructField(k, IntegerType() if k in ("year", "month") else StringType()) for k in LAKE_KEYS]
ROWS_PER_FILE = 50_000_000
WRITE_OPTIONS = {"compression": "zstd", "parquet.block.size": str(256 << 20), "maxRecordsPerFile": str(ROWS_PER_FILE)}


class Lake:
    """Tables under one root, of any file system that Spark reads."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, str(root).rstrip("/")

    def _files(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._files(path)
        return fs.exists(p)

    def tables(self) -> list[str]:
        """Names of the tables; none where the root is missing."""
        fs, p = self._files(self.root)
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
        return sorted(n for n in names if not n.startswith(("_", ".")))

    def read(self, table: str) -> DataFrame:
        """A table with its partition keys as columns; bars of different columns side by side.

        The columns are those of the schema that ``write`` keeps beside the
        data; footers are read for them only where there is none.
        """
        schema = self._schema(table)
        if schema is not None:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{table}")
        df = self.spark.read.option("mergeSchema", True).parquet(f"{self.root}/{table}")
        return df.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in FOLDERS if f.name in df.columns})

    def _schema(self, table: str) -> StructType | None:
        fs, p = self._files(f"{self.root}/_schemas/{table}.json")
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return StructType.fromJson(json.loads(text))

    def _keep_schema(self, table: str, df: DataFrame) -> None:
        """Adds the columns of df to those kept; the folders' keys come last."""
        before = self._schema(table)
        if before is None and self._exists(f"{self.root}/{table}"):
            before = self.read(table).schema
        keys = [f.name for f in FOLDERS]
        fields = {f.name: f for f in [*df.schema.fields, *(before or [])] if f.name not in keys}
        order = [*(f.name for f in before or []), *df.columns]
        schema = StructType([*(StructField(n, fields[n].dataType) for n in dict.fromkeys(order) if n in fields), *FOLDERS])
        if schema == before:
            return
        fs, p = self._files(f"{self.root}/_schemas/{table}.json")
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(json.dumps(schema.jsonValue()).encode()))
        finally:
            stream.close()

    def between(self, table: str, start_us: int, end_us: int, time: str = "timestamp_utc") -> DataFrame:
        """Rows with start <= time < end.  Bounds on months are added, which prune folders that bounds on time do not."""
        low, high = (from_micros(F.lit(us)) for us in (start_us, end_us - 1))
        month = F.col("year") * 12 + F.col("month")
        inside = (month >= F.year(low) * 12 + F.month(low)) & (month <= F.year(high) * 12 + F.month(high))
        return self.read(table).where(inside & (F.col(time) >= start_us) & (F.col(time) < end_us))

    def register(self) -> list[str]:
        """A temporary view for each table, by its folder's name."""
        for name in (names := self.tables()):
            self.read(name).createOrReplaceTempView(f"`{name}`" if not re.fullmatch(r"\w+", name) else name)
        return names

    def sql(self, text: str, **parameters) -> DataFrame:
        """SQL over the tables, with named parameters."""
        self.register()
        return self.spark.sql(text, args=parameters or None)

    def duckdb_sql(self, text: str, **parameters) -> DataFrame:
        """The same for queries written for DuckDB."""
        from ..plans.dialect import spark_sql

        return self.sql(spark_sql(text), **parameters)

    def write(self, df: DataFrame, table: str, time: str, merge_key: Sequence[str] | None = None, batch: str | None = None) -> int:
        """Writes rows and returns the number of partitions touched.

        Without more, a touched partition is replaced.  With merge_key, rows
        of touched partitions stay unless a new row has their key.  With batch,
        rows are added in files of that name; the same batch again replaces
        only its own files.  An empty df writes nothing.

        New files are moved in under names of their own, each move is checked,
        and what they replace is deleted last.  Where a move fails the table is
        as it was; where the process ends in between, old and new rows lie side
        by side until the same write is run again, and none is lost.
        """
        if batch is not None and not re.fullmatch(r"\w[\w.=-]*", batch):
            raise ValueError(f"not a name for files: {batch!r}")
        if merge_key and batch:
            if df.isEmpty():
                return 0
            raise ValueError("merge_key and batch are mutually exclusive")
        stamp = F.col(time) if dict(df.dtypes)[time].startswith("timestamp") else from_micros(F.col(time))
        keyed = df.drop("year", "month").withColumns(year_and_month(stamp))
        path, staging = f"{self.root}/{table}", f"{self.root}/_staging/{uuid.uuid4().hex}"
        try:
            # Written apart first: df is computed once, its folders are known, a failed write leaves the table as it
            # was, and a merge does not read what it replaces.
            source = f"{staging}/new"
            self._save(keyed, source, time)
            touched = self._partitions(source)
            there = [f"{path}/{folder}" for folder in touched if merge_key and self._exists(f"{path}/{folder}")]
            if there:
                merged = merge_rows(self._rows(path, there), self._rows(source, [source]), merge_key)
                source = f"{staging}/merged"
                self._save(merged, source, time)
            if touched:
                self._keep_schema(table, keyed)
            for folder in touched:
                self._publish(f"{source}/{folder}", f"{path}/{folder}", batch)
        finally:
            fs, p = self._files(staging)
            fs.delete(p, True)
        return len(touched)

    def _rows(self, base: str, folders: list[str]) -> DataFrame:
        """Rows of some folders of a table, with keys as they are named in folders."""
        df = self.spark.read.option("mergeSchema", True).option("basePath", base).parquet(*folders)
        text = {k: F.col(k).cast("string") for k in LAKE_KEYS}
        return df.withColumns(text | {"year": F.col("year").cast(IntegerType()), "month": F.lpad(text["month"], 2, "0")})

    def _save(self, df: DataFrame, path: str, time: str) -> None:
        order = [*LAKE_KEYS, time, *(c for c in ("trade_id", "percentage", "timeframe") if c in df.columns)]
        df.repartitionByRange(*order).sortWithinPartitions(*order).write.options(**WRITE_OPTIONS).partitionBy(*LAKE_KEYS).parquet(path)

    def _partitions(self, path: str) -> list[str]:
        fs, p = self._files(path)
        depth = len(LAKE_KEYS)
        parents = {s.getPath().getParent().toString() for s in _walk(fs, p)}
        return sorted("/".join(x.split("/")[-depth:]) for x in parents if "=" in x.split("/")[-1])

    def _publish(self, source: str, target: str, batch: str | None) -> None:
        """Moves the files of one partition into place, then deletes what they replace: all others, or those of the batch."""
        fs, to = self._files(target)
        _, frm = self._files(source)
        Path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs.mkdirs(to)
        there = {s.getPath().getName(): s.getPath() for s in fs.listStatus(to)}
        if batch:
            own = re.compile(rf"part-{re.escape(batch)}-(\d+)\.parquet")
            there = {name: path for name, path in there.items() if own.fullmatch(name)}
            next_number = max((int(own.fullmatch(name)[1]) for name in there), default=-1) + 1
        moved = []
        for n, s in enumerate(sorted(fs.listStatus(frm), key=lambda s: s.getPath().getName())):
            place = Path(to, f"part-{batch}-{next_number + n:05d}.parquet" if batch else s.getPath().getName())
            if not fs.rename(s.getPath(), place):
                for path in moved:
                    fs.delete(path, False)
                raise OSError(f"could not move {s.getPath()} to {place}")
            moved.append(place)
        for path in there.values():
            fs.delete(path, True)


def _walk(fs, path) -> list:
    """Parquet files under a folder."""
    out, files = [], fs.listFiles(path, True)
    while files.hasNext():
        s = files.next()
        if s.getPath().getName().endswith(".parquet"):
            out.append(s)
    return out


def in_hours(lake: Lake, exchange: str, symbol: str, start: datetime, hours: int, table: str = "trades") -> DataFrame:
    """Rows of one series from start for so many hours, the end excluded; start needs a zone."""
    begin = micros_of(start)
    rows = lake.between(table, begin, begin + hours * 3_600_000_000)
    return rows.where((F.col("exchange") == exchange) & (F.col("symbol") == symbol))
