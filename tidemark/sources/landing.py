"""Landed JSON documents and their flat records.

Layout: ``<landing>/<dataset>/date=YYYY-MM-DD/*.json``, one envelope
``{"extracted_at": ..., "payload": "<document as received>"}`` per line.

A snapshot that is landed in several envelopes numbers them by ``page``; without
that member an envelope is page 0.

Each flattener takes envelopes and returns one row per record. With
``keep_empty`` a document without records still yields one row, marked by a
false ``is_record``, so that the quality gates can count empty snapshots; and
the first row of each document carries its page as ``document``, so that they
can tell a document that was landed twice.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tidemark import schemas
from tidemark.functions import integer_property, required
from tidemark.session import folder_names, require_settings

_FAIL = {"mode": "FAILFAST"}
_ENVELOPE = ("extracted_at", "page", "payload")
# How a document of each kind begins. The parser alone would take an object for an array of one.
_ARRAY, _OBJECT = r"^\s*\[", r"^\s*\{"


def read_documents(
    spark: SparkSession, landing: str, dataset: str, dates: Iterable[date] | None = None
) -> DataFrame:
    """Envelopes of one dataset; with ``dates``, only files in the folders of these are listed and read."""
    root = f"{landing.rstrip('/')}/{dataset}"
    reader = spark.read.schema(schemas.LANDED).options(**_FAIL)
    if dates is None:
        return reader.json(root).select(*_ENVELOPE)
    wanted = {f"date={day}" for day in dates}
    present = sorted(wanted.intersection(folder_names(spark, root)))
    if not present:
        return spark.createDataFrame([], schemas.LANDED).select(*_ENVELOPE)
    envelopes = reader.option("basePath", root).json([f"{root}/{name}" for name in present])
    return envelopes.select(*_ENVELOPE)


def read_snapshots(
    spark: SparkSession, landing: str, dates: Iterable[date] | None = None, keep_empty: bool = False
) -> dict[str, DataFrame]:
    """Flat records of all three datasets, lazily."""
    dates = None if dates is None else list(dates)
    return {
        dataset: flatten(read_documents(spark, landing, dataset, dates), keep_empty)
        for dataset, flatten in FLATTENERS.items()
    }


def flatten_line_status(documents: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per status of a line; a line without statuses has good service."""
    lines = _explode(documents, _parse(schemas.LINE_DOCUMENT, _ARRAY), "line", keep_empty)
    statuses = lines.select(
        *_kept(keep_empty),
        "line",
        F.posexplode_outer("line.lineStatuses").alias("status_pos", "status"),
    )
    if keep_empty:
        # The first status of a line that is the first of its document.
        first = F.coalesce(F.col("status_pos"), F.lit(0)) == 0
        statuses = statuses.withColumn("document", F.when(first, F.col("document")))
    status = F.col("status")
    severity = F.coalesce(status["statusSeverity"], F.lit(schemas.GOOD_SEVERITY))
    return statuses.select(
        *_kept(keep_empty),
        _text("line.id").alias("line_id"),
        _text("line.name").alias("line_name"),
        F.when(F.col("status_pos").isNotNull() & status.isNull(), F.raise_error(F.lit("null line status")))
        .otherwise(severity)
        .cast("int")
        .alias("status_severity"),
        _text("status.statusSeverityDescription", schemas.GOOD_DESCRIPTION).alias("status_description"),
        status["disruption"]["description"].alias("disruption_reason"),
        (severity != schemas.GOOD_SEVERITY).alias("is_disrupted"),
    )


def flatten_bike_points(documents: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per station, its counts taken from the key/value list."""
    points = _explode(documents, _parse(schemas.BIKE_DOCUMENT, _ARRAY), "point", keep_empty)
    listed = F.col("point.additionalProperties")
    keyless = F.exists(listed, lambda entry: entry["key"].isNull())
    checked = F.when(keyless, F.raise_error(F.lit("property without a key"))).otherwise(listed)
    points = points.withColumn("properties", checked)
    properties = F.col("properties")
    return points.select(
        *_kept(keep_empty),
        _text("point.id").alias("bike_point_id"),
        _text("point.commonName").alias("name"),
        _coordinate("lat"),
        _coordinate("lon"),
        integer_property(properties, "NbBikes").alias("nb_bikes"),
        integer_property(properties, "NbEmptyDocks").alias("nb_empty_docks"),
        integer_property(properties, "NbDocks").alias("nb_docks"),
    )


def flatten_air_quality(documents: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per forecast; a document without forecasts has none."""
    forecasts = _explode(
        documents, _parse(schemas.AIR_DOCUMENT, _OBJECT)["currentForecast"], "forecast", keep_empty
    )
    return forecasts.select(
        *_kept(keep_empty),
        _text("forecast.forecastType").alias("forecast_type"),
        _text("forecast.forecastBand").alias("forecast_band"),
        _text("forecast.forecastSummary").alias("forecast_summary"),
        _text("forecast.nO2Band").alias("no2_band"),
        _text("forecast.o3Band").alias("o3_band"),
        _text("forecast.pM10Band").alias("pm10_band"),
        _text("forecast.pM25Band").alias("pm25_band"),
        _text("forecast.sO2Band").alias("so2_band"),
    )


FLATTENERS = {
    schemas.LINE_STATUS: flatten_line_status,
    schemas.BIKE_POINTS: flatten_bike_points,
    schemas.AIR_QUALITY: flatten_air_quality,
}


def _parse(schema: DataType, opening: str) -> Column:
    document = F.when(F.col("payload").rlike(opening), F.from_json("payload", schema, _FAIL))
    return required(document, "payload is not a JSON document of the expected kind")


def _explode(documents: DataFrame, elements: Column, name: str, keep_empty: bool) -> DataFrame:
    """One row per array element; a null element is an error, not a record."""
    require_settings(documents.sparkSession)
    if keep_empty:
        page = F.coalesce("page", F.lit(0)).cast("long") if "page" in documents.columns else F.lit(0).cast("long")
        rows = documents.select("extracted_at", page.alias("page"), F.posexplode_outer(elements).alias("pos", name))
        is_record = F.col("pos").isNotNull()
        element = F.when(is_record, required(F.col(name), f"null {name} in document"))
        document = F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("page"))
        return rows.select(
            "extracted_at", is_record.alias("is_record"), document.alias("document"), element.alias(name)
        )
    rows = documents.select("extracted_at", F.explode(elements).alias(name))
    return rows.select("extracted_at", required(F.col(name), f"null {name} in document").alias(name))


def _kept(keep_empty: bool) -> list[str]:
    return ["extracted_at", "is_record", "document"] if keep_empty else ["extracted_at"]


def _text(path: str, default: str = "") -> Column:
    return F.coalesce(F.col(path), F.lit(default))


def _coordinate(name: str) -> Column:
    return F.col(f"point.{name}").cast("double").alias(name)
