"""Gold aggregates against plain Python over the same bronze rows."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.plans import formatted_plan
from tidemark import schemas
from tidemark.operators import gold


def instants(n, seed):
    rng = random.Random(seed)
    start = datetime(2026, 7, 19)
    return [start + timedelta(minutes=rng.randrange(2 * 24 * 60)) for _ in range(n)]


def bronze_lines(n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for at in instants(n, seed):
        line, severity = rng.choice("abc"), rng.randrange(21)
        rows.append((at, at.date(), line, line.upper(), severity, "l", "d", None, severity != 10))
    return rows


def bronze_bikes(n=600, seed=2):
    rng = random.Random(seed)
    rows = []
    for at in instants(n, seed):
        station, bikes, docks = rng.randrange(4), rng.randrange(30), rng.randrange(1, 40)
        pct = float(np.round(bikes / docks * 100, 2))
        rows.append((at, at.date(), station, f"B_{station}", f"S{station}", 51.0 + station, float("nan"),
                     bikes, max(docks - bikes, 0), docks, pct, "x"))
    return rows


def frame(spark, rows, table):
    return spark.createDataFrame(rows, table.schema)


def rounded(value):
    return float(np.round(value, 2))


def groups(rows, key):
    grouped = defaultdict(list)
    for row in rows:
        grouped[key(row)].append(row)
    return grouped


def collected(df):
    return sorted(tuple("nan" if v != v else v for v in row) for row in df.collect())


@pytest.mark.parametrize("hourly", [False, True])
def test_line_summaries(spark, hourly):
    rows = bronze_lines()
    key = (lambda r: (r[1], r[0].hour, r[2], r[3])) if hourly else (lambda r: (r[1], r[2], r[3]))
    expected = []
    for k, members in groups(rows, key).items():
        severities = [m[4] for m in members]
        bad = sum(m[8] for m in members)
        measures = [len(members), bad, rounded(bad * 100.0 / len(members))]
        if not hourly:
            measures += [min(severities), max(severities)]
        expected.append((*k, *measures, rounded(sum(severities) / len(severities))))
    bronze = frame(spark, rows, schemas.BRONZE_LINE_STATUS)
    got = gold.hourly_line(bronze) if hourly else gold.daily_line(bronze)
    assert collected(got) == sorted(expected)


@pytest.mark.parametrize("hourly", [False, True])
def test_bike_summaries(spark, hourly):
    rows = bronze_bikes()
    key = (lambda r: (r[1], r[0].hour, *r[2:3], r[4], r[5], "nan")) if hourly else (lambda r: (r[1], r[2], r[4], r[5], "nan"))
    expected = []
    for k, members in groups(rows, key).items():
        n = len(members)
        occupancy = sum(round(m[10] * 100) for m in members) / 100.0
        expected.append((*k, rounded(sum(m[7] for m in members) / n), rounded(sum(m[8] for m in members) / n),
                         rounded(occupancy / n), n))
    bronze = frame(spark, rows, schemas.BRONZE_BIKE_POINTS)
    got = gold.hourly_bike(bronze) if hourly else gold.daily_bike(bronze)
    assert collected(got) == sorted(expected)


def test_daily_from_hourly_state_equals_daily_from_bronze(spark):
    lines = frame(spark, bronze_lines(), schemas.BRONZE_LINE_STATUS)
    merged = gold.merge_line_state(gold.hourly_line_state(lines), gold.DAY)
    assert collected(gold.finish_line(merged, schemas.GOLD_DAILY_LINE)) == collected(gold.daily_line(lines))
    bikes = frame(spark, bronze_bikes(), schemas.BRONZE_BIKE_POINTS)
    merged = gold.merge_bike_state(gold.hourly_bike_state(bikes), gold.DAY)
    assert collected(gold.finish_bike(merged, schemas.GOLD_DAILY_BIKE)) == collected(gold.daily_bike(bikes))


def test_renamed_station_is_a_group_of_its_own(spark):
    rows = bronze_bikes(50)
    rows = [(*r[:4], f"{r[4]}-{i % 2}", *r[5:]) for i, r in enumerate(rows)]
    got = gold.daily_bike(frame(spark, rows, schemas.BRONZE_BIKE_POINTS))
    assert got.count() == len({(r[1], r[2], r[4]) for r in rows})


def test_air_summary_takes_all_bands_from_one_row(spark):
    rng = random.Random(3)
    rows = []
    for at in instants(500, 3):
        band = rng.choice(["Low", "High", "Odd"])
        pollutants = [rng.choice("xyz") for _ in range(5)]
        # Many rows share an instant, so the bands have to break ties.
        at = at.replace(minute=0, hour=at.hour // 8)
        rows.append((at, at.date(), rng.choice(["Current", "Future"]), band, rng.randrange(3), "s", *pollutants))
    expected = []
    for k, members in groups(rows, lambda r: (r[1], r[2], r[3])).items():
        first = min(members, key=lambda m: (m[0], *m[6:]))
        expected.append((*k, max(m[4] for m in members), *first[6:]))
    got = gold.daily_air(frame(spark, rows, schemas.BRONZE_AIR_QUALITY).repartition(7))
    assert collected(got) == sorted(expected)


def test_gold_schemas_are_the_table_schemas(spark):
    lines = spark.createDataFrame([], schemas.BRONZE_LINE_STATUS.schema)
    bikes = spark.createDataFrame([], schemas.BRONZE_BIKE_POINTS.schema)
    air = spark.createDataFrame([], schemas.BRONZE_AIR_QUALITY.schema)
    frames = (gold.daily_line(lines), gold.hourly_line(lines), gold.daily_bike(bikes), gold.hourly_bike(bikes), gold.daily_air(air))
    for df, table in zip(frames, schemas.GOLD, strict=True):
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in table.schema]


def test_aggregates_are_hash_based_and_combine_before_the_shuffle(spark, tmp_path):
    spark.createDataFrame(bronze_bikes(50), schemas.BRONZE_BIKE_POINTS.schema).write.parquet(str(tmp_path / "b"))
    bikes = spark.read.parquet(str(tmp_path / "b"))
    plan = formatted_plan(gold.daily_bike(bikes))
    tree = plan.split("\n\n\n")[0]
    assert tree.count("HashAggregate") == 2 and "SortAggregate" not in plan and tree.count("Exchange") == 1
    assert "availability_status" not in plan and "bike_point_id" not in plan


def test_extreme_counts_overflow_loudly(spark):
    state = gold.line_state(
        spark.createDataFrame([(1,)], "x int").select(
            F.lit("d").alias("summary_date"), F.lit("a").alias("line_id"), F.lit("A").alias("line_name"),
            F.lit(1).alias("status_severity"), F.lit(True).alias("is_disrupted")), gold.DAY)
    huge = state.withColumn("snapshots", F.lit(2**31))
    with pytest.raises(Exception, match="OVERFLOW"):
        gold.finish_line(huge, schemas.GOLD_DAILY_LINE).collect()
