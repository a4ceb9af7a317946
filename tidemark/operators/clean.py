"""Cleaners: flat records in, typed and enriched bronze rows out.

They are projections only, so they run inside the scan stage. Columns named in
``extra`` pass through behind those of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import (
    bucket_label,
    code_label,
    occupancy,
    strip,
    title_case,
    trailing_number,
    utc_date,
)
from tidemark.session import require_settings


def clean_line_status(records: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    severity = F.col("status_severity").cast("int")
    return records.select(
        *_extracted(records),
        "line_id",
        title_case(strip(F.col("line_name"))).alias("line_name"),
        severity.alias("status_severity"),
        code_label(severity, schemas.SEVERITY_LABELS, schemas.UNKNOWN_SEVERITY).alias("severity_label"),
        strip(F.col("status_description")).alias("status_description"),
        strip(F.col("disruption_reason")).alias("disruption_reason"),
        F.col("is_disrupted").cast("boolean").alias("is_disrupted"),
        *extra,
    ).select(*schemas.BRONZE_LINE_STATUS.columns, *extra)


def clean_bike_points(records: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    station = trailing_number(F.col("bike_point_id"))
    if "is_record" in records.columns:
        # The row of an empty document has no identifier, which must not fail here.
        station = F.when(F.col("is_record"), station)
    bikes = F.col("nb_bikes").cast("int")
    docks = F.col("nb_docks").cast("int")
    return (
        records.select(
            *_extracted(records),
            station.alias("station_id"),
            "bike_point_id",
            strip(F.col("name")).alias("name"),
            _coordinate("lat"),
            _coordinate("lon"),
            bikes.alias("nb_bikes"),
            F.col("nb_empty_docks").cast("int").alias("nb_empty_docks"),
            docks.alias("nb_docks"),
            occupancy(bikes, docks).alias("occupancy_pct"),
            *extra,
        )
        .withColumn(
            "availability_status",
            bucket_label(F.col("occupancy_pct"), schemas.OCCUPANCY_BUCKETS, schemas.NO_BUCKET),
        )
        .select(*schemas.BRONZE_BIKE_POINTS.columns, *extra)
    )


def clean_air_quality(records: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    texts = ("forecast_type", "forecast_band", "forecast_summary", *schemas.POLLUTANT_BANDS)
    return (
        records.select(*_extracted(records), *(strip(F.col(name)).alias(name) for name in texts), *extra)
        .withColumn(
            "forecast_score",
            code_label(F.col("forecast_band"), schemas.BAND_SCORES, schemas.UNKNOWN_SCORE),
        )
        .select(*schemas.BRONZE_AIR_QUALITY.columns, *extra)
    )


CLEANERS = {
    schemas.LINE_STATUS: clean_line_status,
    schemas.BIKE_POINTS: clean_bike_points,
    schemas.AIR_QUALITY: clean_air_quality,
}


def clean_all(records: dict[str, DataFrame], extra: Sequence[str] = ()) -> dict[str, DataFrame]:
    return {dataset: clean(records[dataset], extra) for dataset, clean in CLEANERS.items()}


def _extracted(records: DataFrame) -> tuple[Column, Column]:
    require_settings(records.sparkSession)
    instant = F.col("extracted_at").cast("timestamp")
    return instant.alias("extracted_at"), utc_date(instant).alias("extracted_date")


def _coordinate(name: str) -> Column:
    """The table column holds no NULL, so an unknown position is NaN."""
    return F.coalesce(F.col(name).cast("double"), F.lit(float("nan"))).alias(name)
