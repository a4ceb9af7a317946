"""Daily and hourly gold aggregates.

Lines and stations go through an unrounded *state* of counts, sums and
extremes. A state is built from bronze rows, or by merging a finer state, so
averages are never taken of rounded averages. All state columns are
fixed-width, which keeps both aggregation phases hash-based, and all sums are
of integers, so a retry gives the same result whatever order rows arrive in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import rate_pct, round2, utc_date, utc_hour
from tidemark.session import require_settings

LINE_KEYS = ("line_id", "line_name")
BIKE_KEYS = ("station_id", "name", "lat", "lon")
AIR_KEYS = ("forecast_type", "forecast_band")

DAY = ("summary_date",)
HOUR = ("summary_date", "summary_hour")


def _day(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("summary_date", F.to_date("extracted_date"))


def _hour(bronze: DataFrame) -> DataFrame:
    require_settings(bronze.sparkSession)
    instant = F.col("extracted_at").cast("timestamp")
    return bronze.withColumn("summary_date", utc_date(instant)).withColumn("summary_hour", utc_hour(instant))


def _total(name: str) -> Column:
    return F.sum(name).alias(name)


# --- lines -----------------------------------------------------------------


def line_state(rows: DataFrame, grain: tuple[str, ...]) -> DataFrame:
    severity = F.col("status_severity")
    return rows.groupBy(*grain, *LINE_KEYS).agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.count_if("is_disrupted").alias("disrupted"),
        F.sum(severity.cast("long")).alias("severity_sum"),
        F.min(severity).alias("min_severity"),
        F.max(severity).alias("max_severity"),
    )


def hourly_line_state(bronze: DataFrame) -> DataFrame:
    return line_state(_hour(bronze), HOUR)


def merge_line_state(state: DataFrame, grain: tuple[str, ...]) -> DataFrame:
    return state.groupBy(*grain, *LINE_KEYS).agg(
        _total("snapshots"),
        _total("disrupted"),
        _total("severity_sum"),
        F.min("min_severity").alias("min_severity"),
        F.max("max_severity").alias("max_severity"),
    )


def finish_line(state: DataFrame, table: schemas.Table) -> DataFrame:
    measures = {
        "total_snapshots": F.col("snapshots").cast("int"),
        "disrupted_snapshots": F.col("disrupted").cast("int"),
        "disruption_rate_pct": rate_pct(F.col("disrupted"), F.col("snapshots")),
        "avg_severity": round2(F.col("severity_sum") / F.col("snapshots")),
    }
    return _finish(state, measures, table)


def daily_line(bronze: DataFrame) -> DataFrame:
    return finish_line(line_state(_day(bronze), DAY), schemas.GOLD_DAILY_LINE)


def hourly_line(bronze: DataFrame) -> DataFrame:
    return finish_line(hourly_line_state(bronze), schemas.GOLD_HOURLY_LINE)


# --- bike stations ---------------------------------------------------------


def bike_state(rows: DataFrame, grain: tuple[str, ...]) -> DataFrame:
    # Occupancy is stored at two decimals, so its hundredths are whole numbers.
    hundredths = F.rint(F.col("occupancy_pct") * F.lit(100.0)).cast("long")
    return rows.groupBy(*grain, *BIKE_KEYS).agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.sum(F.col("nb_bikes").cast("long")).alias("bikes_sum"),
        F.sum(F.col("nb_empty_docks").cast("long")).alias("empty_docks_sum"),
        F.sum(hundredths).alias("occupancy_sum"),
    )


def hourly_bike_state(bronze: DataFrame) -> DataFrame:
    return bike_state(_hour(bronze), HOUR)


def merge_bike_state(state: DataFrame, grain: tuple[str, ...]) -> DataFrame:
    return state.groupBy(*grain, *BIKE_KEYS).agg(
        _total("snapshots"),
        _total("bikes_sum"),
        _total("empty_docks_sum"),
        _total("occupancy_sum"),
    )


def finish_bike(state: DataFrame, table: schemas.Table) -> DataFrame:
    snapshots = F.col("snapshots")
    measures = {
        "avg_bikes": round2(F.col("bikes_sum") / snapshots),
        "avg_empty_docks": round2(F.col("empty_docks_sum") / snapshots),
        "avg_occupancy_pct": round2(F.col("occupancy_sum") / F.lit(100.0) / snapshots),
        "total_snapshots": snapshots.cast("int"),
    }
    return _finish(state, measures, table)


def daily_bike(bronze: DataFrame) -> DataFrame:
    return finish_bike(bike_state(_day(bronze), DAY), schemas.GOLD_DAILY_BIKE)


def hourly_bike(bronze: DataFrame) -> DataFrame:
    return finish_bike(hourly_bike_state(bronze), schemas.GOLD_HOURLY_BIKE)


# --- air quality -----------------------------------------------------------


def daily_air(bronze: DataFrame) -> DataFrame:
    """Highest score per day, type and band, with the bands of the first row.

    "First" is by time, then by the bands themselves, and all five bands come
    from that one row. Picking a row needs a struct in the aggregation buffer,
    which Spark can only aggregate by sorting; the equal rows are therefore
    folded by hash first, leaving few to sort.
    """
    folded = (
        _day(bronze)
        .groupBy(*DAY, *AIR_KEYS, *schemas.POLLUTANT_BANDS)
        .agg(F.min("extracted_at").alias("first_at"), F.max("forecast_score").alias("forecast_score"))
    )
    picked = folded.groupBy(*DAY, *AIR_KEYS).agg(
        F.max("forecast_score").cast("int").alias("forecast_score"),
        F.min(F.struct("first_at", *schemas.POLLUTANT_BANDS)).alias("first"),
    )
    bands = {band: F.col("first")[band] for band in schemas.POLLUTANT_BANDS}
    return _finish(picked, bands, schemas.GOLD_DAILY_AIR)


def _finish(state: DataFrame, measures: dict[str, Column], table: schemas.Table) -> DataFrame:
    return state.select(
        *(measures[name].alias(name) if name in measures else F.col(name) for name in table.columns)
    )
