"""Document, record and table schemas of the snapshot warehouse."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

LINE_STATUS = "line_status"
BIKE_POINTS = "bike_points"
AIR_QUALITY = "air_quality"
DATASETS = (LINE_STATUS, BIKE_POINTS, AIR_QUALITY)


def _struct(*fields: tuple, nullable: bool = True) -> StructType:
    return StructType([StructField(name, type_, nullable) for name, type_ in fields])


# One landed document: when it was fetched, and its JSON text as received.
ENVELOPE = _struct(("extracted_at", StringType()), ("payload", StringType()))
LANDED = _struct(
    ("extracted_at", StringType()), ("page", LongType()), ("payload", StringType()), ("date", DateType())
)

# Only the members that reach a table are listed, so nothing else is parsed.
# Numbers that the source may quote are read as text and cast afterwards.
LINE_DOCUMENT = ArrayType(
    _struct(
        ("id", StringType()),
        ("name", StringType()),
        (
            "lineStatuses",
            ArrayType(
                _struct(
                    ("statusSeverity", IntegerType()),
                    ("statusSeverityDescription", StringType()),
                    ("disruption", _struct(("description", StringType()))),
                )
            ),
        ),
    )
)

BIKE_DOCUMENT = ArrayType(
    _struct(
        ("id", StringType()),
        ("commonName", StringType()),
        ("lat", StringType()),
        ("lon", StringType()),
        (
            "additionalProperties",
            ArrayType(_struct(("key", StringType()), ("value", StringType()))),
        ),
    )
)

AIR_DOCUMENT = _struct(
    (
        "currentForecast",
        ArrayType(
            _struct(
                ("forecastType", StringType()),
                ("forecastBand", StringType()),
                ("forecastSummary", StringType()),
                ("nO2Band", StringType()),
                ("o3Band", StringType()),
                ("pM10Band", StringType()),
                ("pM25Band", StringType()),
                ("sO2Band", StringType()),
            )
        ),
    )
)

# Severity code to label.
SEVERITY_LABELS = {
    0: "Special Service",
    1: "Closed",
    2: "Suspended",
    3: "Part Closure",
    4: "Planned Closure",
    5: "Part Suspended",
    6: "Bus Service",
    7: "Reduced Service",
    8: "Severe Delays",
    9: "Minor Delays",
    10: "Good Service",
    20: "Not Running",
}
UNKNOWN_SEVERITY = "Unknown"
GOOD_SEVERITY = 10
GOOD_DESCRIPTION = "Good Service"
SEVERITY_RANGE = (0, 20)

# Air-quality band to score.
BAND_SCORES = {"Low": 1, "Moderate": 2, "High": 3, "Very High": 4}
UNKNOWN_SCORE = 0

# Availability label by occupancy, each (above, up to and including, label).
OCCUPANCY_BUCKETS = (
    (-1, 0, "Empty"),
    (0, 25, "Low"),
    (25, 75, "Available"),
    (75, 101, "Full"),
)
# What stands in the label when occupancy is outside every bucket.
NO_BUCKET = "nan"


@dataclass(frozen=True)
class Table:
    """A date-partitioned table; its column order is part of the contract."""

    name: str
    schema: StructType
    date_column: str
    sort_columns: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return self.schema.names


def _table(name: str, date_column: str, sort_columns: tuple, *fields: tuple, nullable: tuple = ()) -> Table:
    schema = StructType([StructField(n, t, n in nullable) for n, t in fields])
    return Table(name, schema, date_column, sort_columns)


_EXTRACTED = (("extracted_at", TimestampType()), ("extracted_date", DateType()))
_DAY = (("summary_date", DateType()),)
_HOUR = (("summary_date", DateType()), ("summary_hour", IntegerType()))
_LINE = (("line_id", StringType()), ("line_name", StringType()))
# One value each per station, by whose id rows are sorted.
STATION_COLUMNS = ("station_id", "bike_point_id", "name", "lat", "lon")
_STATION_AVERAGES = (
    ("station_id", IntegerType()),
    ("name", StringType()),
    ("lat", DoubleType()),
    ("lon", DoubleType()),
    ("avg_bikes", DoubleType()),
    ("avg_empty_docks", DoubleType()),
    ("avg_occupancy_pct", DoubleType()),
    ("total_snapshots", IntegerType()),
)
POLLUTANT_BANDS = ("no2_band", "o3_band", "pm10_band", "pm25_band", "so2_band")
_POLLUTANTS = tuple((band, StringType()) for band in POLLUTANT_BANDS)

BRONZE_LINE_STATUS = _table(
    "bronze_line_status",
    "extracted_date",
    ("line_id",),
    *_EXTRACTED,
    *_LINE,
    ("status_severity", IntegerType()),
    ("severity_label", StringType()),
    ("status_description", StringType()),
    ("disruption_reason", StringType()),
    ("is_disrupted", BooleanType()),
    nullable=("disruption_reason",),
)

BRONZE_BIKE_POINTS = _table(
    "bronze_bike_points",
    "extracted_date",
    ("station_id",),
    *_EXTRACTED,
    ("station_id", IntegerType()),
    ("bike_point_id", StringType()),
    ("name", StringType()),
    ("lat", DoubleType()),
    ("lon", DoubleType()),
    ("nb_bikes", IntegerType()),
    ("nb_empty_docks", IntegerType()),
    ("nb_docks", IntegerType()),
    ("occupancy_pct", DoubleType()),
    ("availability_status", StringType()),
)

BRONZE_AIR_QUALITY = _table(
    "bronze_air_quality",
    "extracted_date",
    ("forecast_type",),
    *_EXTRACTED,
    ("forecast_type", StringType()),
    ("forecast_band", StringType()),
    ("forecast_score", IntegerType()),
    ("forecast_summary", StringType()),
    *_POLLUTANTS,
)

GOLD_DAILY_LINE = _table(
    "gold_daily_line_summary",
    "summary_date",
    ("line_id",),
    *_DAY,
    *_LINE,
    ("total_snapshots", IntegerType()),
    ("disrupted_snapshots", IntegerType()),
    ("disruption_rate_pct", DoubleType()),
    ("min_severity", IntegerType()),
    ("max_severity", IntegerType()),
    ("avg_severity", DoubleType()),
)

GOLD_HOURLY_LINE = _table(
    "gold_hourly_line_summary",
    "summary_date",
    ("summary_hour", "line_id"),
    *_HOUR,
    *_LINE,
    ("total_snapshots", IntegerType()),
    ("disrupted_snapshots", IntegerType()),
    ("disruption_rate_pct", DoubleType()),
    ("avg_severity", DoubleType()),
)

GOLD_DAILY_BIKE = _table(
    "gold_daily_bike_summary", "summary_date", ("station_id",), *_DAY, *_STATION_AVERAGES
)

GOLD_HOURLY_BIKE = _table(
    "gold_hourly_bike_summary", "summary_date", ("summary_hour", "station_id"), *_HOUR, *_STATION_AVERAGES
)

GOLD_DAILY_AIR = _table(
    "gold_daily_air_quality",
    "summary_date",
    ("forecast_type",),
    *_DAY,
    ("forecast_type", StringType()),
    ("forecast_band", StringType()),
    ("forecast_score", IntegerType()),
    *_POLLUTANTS,
)

BRONZE = {
    LINE_STATUS: BRONZE_LINE_STATUS,
    BIKE_POINTS: BRONZE_BIKE_POINTS,
    AIR_QUALITY: BRONZE_AIR_QUALITY,
}
GOLD = (GOLD_DAILY_LINE, GOLD_HOURLY_LINE, GOLD_DAILY_BIKE, GOLD_HOURLY_BIKE, GOLD_DAILY_AIR)
TABLES = {table.name: table for table in (*BRONZE.values(), *GOLD)}
