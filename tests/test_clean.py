"""Cleaners against what pandas makes of the same records."""

from __future__ import annotations

from datetime import date, datetime

import math
import pytest
from pyspark.sql import functions as F

from tests.plans import formatted_plan
from tidemark import schemas
from tidemark.operators.clean import CLEANERS, clean_air_quality, clean_all, clean_bike_points, clean_line_status

AT = "2026-07-20T23:30:00.123456+00:00"
LINE = "extracted_at string, line_id string, line_name string, status_severity int, status_description string, disruption_reason string, is_disrupted boolean"
BIKE = "extracted_at string, bike_point_id string, name string, lat double, lon double, nb_bikes int, nb_empty_docks int, nb_docks int"
AIR = "extracted_at string, forecast_type string, forecast_band string, forecast_summary string, no2_band string, o3_band string, pm10_band string, pm25_band string, so2_band string"


def test_clean_line_status(spark):
    records = spark.createDataFrame(
        [
            (AT, " a ", "\twaterloo-city\n", 10, " Good Service ", None, False),
            ("2026-07-21T00:30:00+01:00", "b", "king's ", 11, "x", " reason ", True),
        ],
        LINE,
    )
    rows = {r.line_id: r for r in clean_line_status(records).collect()}
    first, second = rows[" a "], rows["b"]
    assert first.extracted_date == second.extracted_date == date(2026, 7, 20)
    assert (first.line_name, first.severity_label, first.status_description, first.disruption_reason) == (
        "Waterloo-City", "Good Service", "Good Service", None)
    assert (second.line_name, second.severity_label, second.disruption_reason, second.is_disrupted) == (
        "King'S", "Unknown", "reason", True)
    wall = clean_line_status(records).where("line_id = 'b'").select(F.col("extracted_at").cast("string")).first()[0]
    assert wall == "2026-07-20 23:30:00"


def test_clean_bike_points(spark):
    counts = [(0, 0), (1, 0), (2, 0), (1, 4), (2, 7), (3, 4), (101, 100), (51, 50), (-1, 3)]
    records = spark.createDataFrame(
        [(AT, f"BikePoints_{i}", " n  ", None, -0.1, b, 1, d) for i, (b, d) in enumerate(counts)], BIKE
    )
    got = clean_bike_points(records).orderBy("station_id").collect()
    # Worked out by hand: 2 of 7 is 28.571..., -1 of 3 is -33.333...; a station without docks counts as one dock.
    assert [(r.occupancy_pct, r.availability_status) for r in got] == [
        (0.0, "Empty"), (100.0, "Full"), (200.0, "nan"), (25.0, "Low"), (28.57, "Available"), (75.0, "Available"),
        (101.0, "Full"), (102.0, "nan"), (-33.33, "nan"),
    ]
    assert {r.name for r in got} == {"n"}
    assert all(math.isnan(r.lat) and r.lon == -0.1 for r in got)


def test_clean_air_quality(spark):
    bands = [" Low ", "Moderate", "High\n", "Very High", "Extreme", ""]
    records = spark.createDataFrame([(AT, " t ", b, " s ", " a", "b ", "c", "d", "e") for b in bands], AIR)
    rows = clean_air_quality(records).collect()
    assert {r.forecast_band: r.forecast_score for r in rows} == {
        "Low": 1, "Moderate": 2, "High": 3, "Very High": 4, "Extreme": 0, "": 0}
    assert {tuple(r)[-5:] for r in rows} == {("a", "b", "c", "d", "e")}
    assert {(r.forecast_type, r.forecast_summary) for r in rows} == {("t", "s")}


@pytest.mark.parametrize("bad", ["yesterday", "", "2026-02-30T00:00:00+00:00"])
def test_malformed_instants_fail(spark, bad):
    records = spark.createDataFrame([(bad, "t", "Low", "", "", "", "", "", "")], AIR)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean_air_quality(records).collect()


def test_identifier_without_number_fails(spark):
    records = spark.createDataFrame([(AT, "BikePoints_x", "n", 0.0, 0.0, 1, 1, 1)], BIKE)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean_bike_points(records).collect()


def test_cleaned_schemas_are_the_table_schemas(spark):
    records = {
        schemas.LINE_STATUS: spark.createDataFrame([], LINE),
        schemas.BIKE_POINTS: spark.createDataFrame([], BIKE),
        schemas.AIR_QUALITY: spark.createDataFrame([], AIR),
    }
    cleaned = clean_all(records)
    assert set(cleaned) == set(CLEANERS)
    for dataset, table in schemas.BRONZE.items():
        expected = [(f.name, f.dataType) for f in table.schema]
        assert [(f.name, f.dataType) for f in cleaned[dataset].schema] == expected


def test_cleaners_need_no_shuffle_and_no_python(spark, tmp_path):
    spark.createDataFrame([(AT, "BikePoints_1", "n", 0.0, 0.0, 1, 1, 1)], BIKE).write.parquet(str(tmp_path / "r"))
    records = spark.read.parquet(str(tmp_path / "r"))
    plan = formatted_plan(clean_bike_points(records))
    assert "Exchange" not in plan and "Python" not in plan


def test_dates_are_utc(spark):
    assert datetime.fromisoformat(AT).utcoffset().total_seconds() == 0
    records = spark.createDataFrame([("2026-07-20T01:00:00+02:00", "t", "Low", "", "", "", "", "", "")], AIR)
    assert clean_air_quality(records).first().extracted_date == date(2026, 7, 19)


@pytest.mark.parametrize(("key", "value"), [("spark.sql.ansi.enabled", "false"), ("spark.sql.session.timeZone", "Asia/Tokyo")])
def test_settings_that_would_change_results_are_refused(spark, key, value):
    records = spark.createDataFrame([], AIR)
    old = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        with pytest.raises(ValueError, match=key):
            clean_air_quality(records)
    finally:
        spark.conf.set(key, old)
