"""Sessions: settings that results depend on, and those that suit the engine."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def build_session(app: str = "tickloom", master: str | None = None, **settings: str) -> SparkSession:
    """A session with SETTINGS; further ones with ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Timestamps of epoch microseconds are rendered in the session's zone, so it must be UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"the session time zone must be UTC, not {zone}")


def shared_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share: that of spark.checkpoint.dir.

    A temporary one only where that is unset and all run on one machine; on a
    cluster its absence is an error, since executors would not see the files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='tickloom-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once for a session's context, so that it need not be installed there."""
    context = spark.sparkContext
    if getattr(context, "_tickloom_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tickloom-")) / "tickloom.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._tickloom_shipped = True
