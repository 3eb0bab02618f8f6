"""Single files for people: flat tables and samples."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame

from ..schemas import in_order
from .lake import Lake, in_hours


@dataclass(frozen=True)
class SampleExport:
    csv_path: Path
    parquet_path: Path
    row_count: int


def _one_file(df: DataFrame, path: Path, kind: str, **options) -> None:
    """Writes one file by way of a folder beside it, of rows that fit one task, where the driver sees what executors write."""
    if not df.sparkSession.sparkContext.master.startswith("local"):
        raise RuntimeError("single files are written to the driver's disk: use a local session, or Lake.write on a cluster")
    folder = path.with_name(f".{path.name}.tmp")
    df.coalesce(1).write.mode("overwrite").format(kind).options(**options).save(folder.absolute().as_uri())
    part = next(p for p in folder.iterdir() if p.name.startswith("part-"))
    part.replace(path)
    for rest in folder.iterdir():
        rest.unlink()
    folder.rmdir()


def write_flat(df: DataFrame, path: Path) -> int:
    """One zstd Parquet file, in canonical order, for small extracts on the driver's disk; the number of rows."""
    path.parent.mkdir(parents=True, exist_ok=True)
    _one_file(in_order(df), path, "parquet", compression="zstd")
    return df.sparkSession.read.parquet(path.absolute().as_uri()).count()


def export_sample(lake: Lake, exchange: str, symbol: str, start: datetime, out_dir: Path, hours: int = 24) -> SampleExport:
    """Trades of one series from start for so many hours, as CSV and Parquet, in the order of time and id."""
    rows = in_hours(lake, exchange, symbol, start, hours).orderBy("timestamp_utc", "trade_id").cache()
    try:
        out_dir.mkdir(parents=True, exist_ok=True)
        stem = out_dir / f"{exchange}_{symbol}_{start:%Y%m%d}_{hours}h"
        csv, parquet = stem.with_name(stem.name + ".csv"), stem.with_name(stem.name + ".parquet")
        _one_file(rows, csv, "csv", header=True)
        _one_file(rows, parquet, "parquet", compression="zstd")
        return SampleExport(csv, parquet, rows.count())
    finally:
        rows.unpersist()
