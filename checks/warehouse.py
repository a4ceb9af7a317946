"""A warehouse filled by the pipeline from landed documents, once per session and folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, timedelta
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures
from tidemark import schemas
from tidemark.operators import quality, tables
from tidemark.plans import job
from tidemark.session import delete_folder, scratch_folder, shuffles_freed

# Half a day of the smallest tables holds fewer stations than a real snapshot.
MIN_RECORDS = quality.MIN_RECORDS | {schemas.BIKE_POINTS: 50}

# Documents of so many events, about 1.5 GB of JSON, are landed and loaded at once, more only where one date has more.
EVENTS_PER_RUN = 450_000
# A compressed file is read by one task, so none is large.
DOCUMENTS_PER_FILE = 10_000
# Documents are read once and deleted, so packing them well costs more time than it saves.
_PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}

_BUILT: dict[tuple[str, str], Warehouse] = {}


@dataclass(frozen=True)
class Warehouse:
    database: str
    dates: list[date]

    def table(self, spark: SparkSession, table: schemas.Table) -> DataFrame:
        return tables.read_table(spark, self.database, table)


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        _BUILT[key] = build(spark, sf_dir)
    return _BUILT[key]


def build(spark: SparkSession, sf_dir: str) -> Warehouse:
    """All dates, landed and loaded in runs; the documents of a run are deleted when bronze is loaded, before gold is.

    While a run is loaded the next one is landed, which fills the gaps between the small jobs of a load.
    """
    folder = scratch_folder(spark)
    counts = event_counts(spark, sf_dir)
    built = Warehouse(new_database(), sorted(counts))
    runs = tables.date_runs(counts, EVENTS_PER_RUN, most_runs=None) or [[]]
    with shuffles_freed(spark), ThreadPoolExecutor(1) as ahead:
        begin = partial(ahead.submit, inheritable_thread_target(spark)(land), spark, sf_dir)
        landed = begin(f"{folder}/landing-0", runs[0])
        for number, dates in enumerate(runs, 1):
            landing = landed.result()
            if number < len(runs):
                landed = begin(f"{folder}/landing-{number}", runs[number])
            fill(spark, landing, built.database, dates, f"{folder}/warehouse", partial(delete_folder, spark, landing))
    return built


def load(spark: SparkSession, landing: str, dates: list[date], location: str) -> Warehouse:
    built = Warehouse(new_database(), dates)
    fill(spark, landing, built.database, dates, location)
    return built


def fill(
    spark: SparkSession, landing: str, database: str, dates: list[date], location: str,
    loaded: Callable[[], None] = lambda: None,
) -> None:
    job.run(spark, landing, database, dates, location, MIN_RECORDS, loaded=loaded)


def land(spark: SparkSession, sf_dir: str, landing: str, dates: Iterable[date] | None = None) -> str:
    """Write the documents, of ``dates`` or of all, as compressed JSON; the events are read once for all three datasets."""
    kept = f"{landing}-events"
    _of_dates(fixtures.events(spark, sf_dir), dates).write.parquet(kept)
    for dataset, documents in documents_by_date(spark, sf_dir, dates, spark.read.parquet(kept)).items():
        files = _PACKED | {"maxRecordsPerFile": DOCUMENTS_PER_FILE}
        documents.write.options(**files).partitionBy("date").json(f"{landing}/{dataset}")
    delete_folder(spark, kept)
    return landing


def documents_by_date(
    spark: SparkSession, sf_dir: str, dates: Iterable[date] | None = None, kept: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Documents in the order of their dates; the events are shuffled and sorted, not the far larger documents.

    ``kept`` are the events of ``dates``, where they have been read already.
    """
    dates = None if dates is None else list(dates)

    def dealt(ev: DataFrame) -> DataFrame:
        ev = _of_dates(ev, dates) if kept is None else kept
        parts = max(1, -(-ev.count() // DOCUMENTS_PER_FILE))
        return ev.repartitionByRange(parts, "extracted_date", "event_id").sortWithinPartitions("extracted_date")

    return fixtures.landed_documents(spark, sf_dir, dealt)


def _of_dates(ev: DataFrame, dates: list[date] | None) -> DataFrame:
    """The events of ``dates``; the time is compared first, since it needs no date of every event."""
    if dates and None not in dates:
        first, behind = (F.lit(day).cast("timestamp_ntz") for day in (min(dates), max(dates) + timedelta(days=1)))
        ev = ev.where((F.col("ts") >= first) & (F.col("ts") < behind))
    return ev if dates is None else tables.of_dates(ev, "extracted_date", dates)


def days(spark: SparkSession, sf_dir: str) -> list[date]:
    return sorted(event_counts(spark, sf_dir))


def event_counts(spark: SparkSession, sf_dir: str) -> dict[date, int]:
    rows = fixtures.events(spark, sf_dir).groupBy("extracted_date").agg(F.count(F.lit(1)).alias("events")).collect()
    return {row.extracted_date: row.events for row in rows}


def new_database() -> str:
    return f"tidemark_{uuid.uuid4().hex[:12]}"
