"""Session settings the results depend on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone
from time import sleep

from pyspark.sql import SparkSession

# Dates and hours are UTC, casts fail on bad input, and skewed or tiny
# partitions are split or merged at run time.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
}
# Shuffle files are deleted as soon as the query that wrote them ends.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "tidemark", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**REQUIRED, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_settings(spark: SparkSession) -> None:
    """Refuse to run where the time zone or cast rules would change results."""
    wrong = {
        key: spark.conf.get(key, None)
        for key, wanted in REQUIRED.items()
        if (spark.conf.get(key, None) or "").lower() != wanted.lower()
    }
    if wrong:
        raise ValueError(f"session settings must be {REQUIRED}, found {wrong}")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Free the disk of each query's shuffles at its end; else they stay until the driver collects garbage."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)
        # Spark asks for the deletions without waiting. A removal of nothing, waited for, is behind them in all queues.
        spark._jvm.org.apache.spark.SparkEnv.get().blockManager().master().removeShuffle(-1, True)
        sleep(0.1)


def scratch_folder(spark: SparkSession, scratch: str | None = None, location: str | None = None) -> str:
    """A new path for data in between, in a folder that all executors reach.

    That is ``scratch``, else what ``spark.checkpoint.dir`` names, else a
    folder beside the tables: at ``location``, or where databases are made.
    """
    shared = scratch or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        tables = location or spark.conf.get("spark.sql.warehouse.dir", None)
        if not tables:
            raise ValueError("no folder for data in between: give scratch, location or spark.checkpoint.dir")
        shared = f"{tables.rstrip('/')}/_scratch"
    return f"{shared.rstrip('/')}/tidemark-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it is absent; what is inside them is not listed."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [entry.getPath().getName() for entry in system.listStatus(target)] if system.exists(target) else []


def folder_times(spark: SparkSession, path: str) -> list[tuple[str, datetime]]:
    """Names in a folder and when they were changed."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    entries = system.listStatus(target) if system.exists(target) else []
    return [
        (e.getPath().getName(), datetime.fromtimestamp(e.getModificationTime() / 1000, timezone.utc)) for e in entries
    ]
