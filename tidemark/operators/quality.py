"""Quality gates before and after loading.

Metrics are ordinary aggregates over all dates at once. Only the rows that
fail a gate reach the driver: at most one per dataset or table and requested
date, and one per dataset for all dates that were not requested.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.tables import row_counts

# Fewest records per snapshot, and fewest bronze rows per date.
MIN_RECORDS = {schemas.LINE_STATUS: 5, schemas.BIKE_POINTS: 100, schemas.AIR_QUALITY: 1}

DAILY_GOLD = (schemas.GOLD_DAILY_LINE, schemas.GOLD_DAILY_BIKE, schemas.GOLD_DAILY_AIR)
HOURLY_GOLD = (schemas.GOLD_HOURLY_LINE, schemas.GOLD_HOURLY_BIKE)


class QualityError(ValueError):
    """One or more gates failed; the message names all of them."""


def violation(dataset: str) -> Column:
    """Whether a flat record breaks its dataset's rule; a NULL breaks it too."""
    if dataset == schemas.LINE_STATUS:
        holds = F.col("status_severity").between(*schemas.SEVERITY_RANGE)
    elif dataset == schemas.BIKE_POINTS:
        holds = (F.col("nb_bikes") >= 0) & (F.col("nb_docks") >= 0)
    else:
        # The raw band, white space and all: ' Low' is not a band.
        holds = F.col("forecast_band").isin(*schemas.BAND_SCORES)
    return ~F.coalesce(holds, F.lit(False))


def raw_metrics(
    records: dict[str, DataFrame],
    dates: Iterable[date] = (),
    min_records: dict[str, int] = MIN_RECORDS,
) -> DataFrame:
    """One row per dataset and date, over flat records before cleaning.

    A snapshot is what shares one ``extracted_at``. Frames flattened with
    ``keep_empty`` also count snapshots without records, and documents of a
    snapshot that are there more than once. A column ``violates`` is taken as
    it is, where there is one. Dates in ``dates``
    that nothing landed for appear with zero snapshots. Snapshots of any other
    date do not pass; they are one row for each dataset, without a date but
    with the number of such dates, the first and the last.
    """
    per_dataset = [
        _dataset_metrics(records[dataset], dataset, min_records[dataset]) for dataset in schemas.DATASETS
    ]
    found = reduce(DataFrame.unionByName, per_dataset)
    dates = list(dates)
    measures = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in
                ("snapshots", "records", "short_snapshots", "violations", "repeated_documents")]
    keys, asked_for = ["dataset", "extracted_date"], F.lit(True)
    if dates:
        missing = _expected(found.sparkSession, "dataset", schemas.DATASETS, "extracted_date", dates)
        found = found.unionByName(missing, allowMissingColumns=True)
        asked_for = F.coalesce(F.col("extracted_date").isin(*dates), F.lit(False))
        found = found.withColumn("stray", F.when(~asked_for, F.col("extracted_date"))).withColumn(
            "extracted_date", F.when(asked_for, F.col("extracted_date"))
        )
        measures += [F.count("stray").alias("stray_dates"), F.min("stray").alias("first_stray"),
                     F.max("stray").alias("last_stray")]
        asked_for = F.col("extracted_date").isNotNull()
    return (
        found.groupBy(*keys)
        .agg(*measures)
        .withColumn(
            "passed",
            asked_for
            & (F.col("snapshots") > 0)
            & (F.col("short_snapshots") == 0)
            & (F.col("violations") == 0)
            & (F.col("repeated_documents") == 0),
        )
    )


def _dataset_metrics(records: DataFrame, dataset: str, min_records: int) -> DataFrame:
    is_record = F.col("is_record") if "is_record" in records.columns else F.lit(True)
    instant = F.col("extracted_at").cast("timestamp")
    # One row of each document names it, so few rows are left of this before the shuffle.
    document = F.col("document") if "document" in records.columns else F.lit(None).cast("long")
    violates = F.col("violates") if "violates" in records.columns else violation(dataset)
    per_document = records.groupBy(instant.alias("snapshot"), document.alias("document")).agg(
        F.count_if(is_record).alias("records"),
        F.count_if(is_record & violates).alias("violations"),
        F.count("document" if "document" in records.columns else document).alias("times"),
    )
    per_snapshot = per_document.groupBy("snapshot").agg(
        F.sum("records").alias("records"),
        F.sum("violations").alias("violations"),
        F.count_if(F.col("times") > 1).alias("repeated"),
    )
    return per_snapshot.groupBy(
        F.lit(dataset).alias("dataset"), F.to_date("snapshot").alias("extracted_date")
    ).agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.sum("records").alias("records"),
        F.count_if(F.col("records") < min_records).alias("short_snapshots"),
        F.sum("violations").alias("violations"),
        F.sum("repeated").alias("repeated_documents"),
    )


def load_metrics(
    spark: SparkSession,
    database: str,
    dates: Iterable[date],
    gold: Iterable[schemas.Table] = DAILY_GOLD,
    min_records: dict[str, int] = MIN_RECORDS,
) -> DataFrame:
    """Rows per checked table and date, from the files' footers; no row is read.

    A row per table and date passes through the driver, as their partitions do.
    """
    dates = list(dates)
    minimum = {schemas.BRONZE[dataset]: min_records[dataset] for dataset in schemas.DATASETS}
    minimum.update({table: 1 for table in gold})
    counts = [(table.name, day, rows) for table in minimum for day, rows in row_counts(spark, database, table, dates).items()]
    found = spark.createDataFrame(counts, "table_name string, day date, rows_loaded long")
    expected = _expected(spark, "table_name", [t.name for t in minimum], "day", dates)
    found = found.unionByName(expected, allowMissingColumns=True)
    needed = F.element_at(
        F.create_map(*(F.lit(part) for t, rows in minimum.items() for part in (t.name, rows))),
        F.col("table_name"),
    )
    return (
        found.groupBy("table_name", "day")
        .agg(F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("rows_loaded"))
        .withColumn("passed", F.col("rows_loaded") >= needed)
    )


def assert_not_empty(dataset: str, records: int, rows: int) -> None:
    """A cleaner must get records and leave rows."""
    if not records:
        raise QualityError(f"no {dataset.replace('_', ' ')} records to clean")
    if not rows:
        raise QualityError(f"cleaned {dataset.replace('_', ' ')} is empty")


def assert_valid(metrics: DataFrame) -> None:
    """Raise with every failing row of a metrics frame."""
    failed = metrics.where(~F.col("passed")).drop("passed").collect()
    if failed:
        lines = sorted(", ".join(f"{k}={v}" for k, v in row.asDict().items()) for row in failed)
        raise QualityError("quality gate failed:\n" + "\n".join(lines))


def _expected(spark: SparkSession, label: str, names: Iterable[str], day: str, dates: list[date]) -> DataFrame:
    rows = [(name, when) for name in names for when in dates]
    return spark.createDataFrame(rows, f"{label} string, {day} date")
