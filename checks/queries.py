"""Registered queries: name to a callable of (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import fixtures
from checks.warehouse import days, new_database, warehouse
from tidemark import schemas
from tidemark.operators import clean, gold, quality, tables
from tidemark.plans import analytics
from tidemark.session import REQUIRED, scratch_folder
from tidemark.sources import flatten_air_quality, flatten_bike_points, flatten_line_status

Query = Callable[[SparkSession, str], DataFrame]

# A date that nothing landed for.
ABSENT = date(2030, 1, 1)


def _wall_clock(df: DataFrame) -> DataFrame:
    """UTC instants as plain timestamps, as the test tables have them."""
    return df.withColumn("extracted_at", F.col("extracted_at").cast("timestamp_ntz"))


def _over(operator: Callable[[DataFrame], DataFrame], fixture: Query, finish=lambda df: df) -> Query:
    return lambda spark, sf_dir: finish(operator(fixture(spark, sf_dir)))


# --- stored tables -----------------------------------------------------------------


def _stored(table: schemas.Table, spark: SparkSession, sf_dir: str) -> DataFrame:
    df = warehouse(spark, sf_dir).table(spark, table)
    return _wall_clock(df) if "extracted_at" in df.columns else df


def row_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.stored_row_totals(spark, warehouse(spark, sf_dir).database)


def latest_disruption(spark: SparkSession, sf_dir: str) -> DataFrame:
    built, table = warehouse(spark, sf_dir), schemas.GOLD_DAILY_LINE
    return analytics.latest_disruption(built.table(spark, table), tables.latest_date(spark, built.database, table))


def stored_row_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each stored table, and how many are smaller than the row before them in their file."""
    database = warehouse(spark, sf_dir).database
    return reduce(DataFrame.unionByName, (_misplaced(spark, database, table) for table in schemas.TABLES.values()))


def _misplaced(spark: SparkSession, database: str, table: schemas.Table) -> DataFrame:
    """Rows are compared where they are read; only the ends of the stretches that a batch holds are shuffled."""
    keys = table.sort_columns
    rows = spark.table(f"{database}.{table.name}").select(*keys, "_metadata.file_path", "_metadata.row_index")
    types = dict(rows.dtypes)
    ends = ", ".join(f"{end}_{key} {types[key]}" for end in ("first", "last") for key in keys)
    stretches = rows.mapInArrow(
        partial(_stretches, keys=keys), f"file_path string, row_index long, stored long, smaller long, {ends}"
    )
    first, last = (F.struct(*(F.col(f"{end}_{key}").alias(key) for key in keys)) for end in ("first", "last"))
    before = F.lag(last).over(Window.partitionBy("file_path").orderBy("row_index"))
    return stretches.withColumn("first", first).withColumn("before", before).agg(
        F.lit(table.name).alias("table_name"), F.coalesce(F.sum("stored"), F.lit(0)).alias("rows_stored"),
        (F.coalesce(F.sum("smaller"), F.lit(0)) + F.count_if(F.col("first") < F.col("before"))).alias("misplaced"),
    )


def _stretches(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Per batch and run of rows that follow each other in a file: its rows, those under the one before, and both ends."""
    for batch in batches:
        if not batch.num_rows:
            continue
        path, index = batch.column("file_path"), batch.column("row_index").to_numpy(zero_copy_only=False)
        follows = pc.equal(path.slice(1), path.slice(0, len(path) - 1)).to_numpy(zero_copy_only=False)
        follows = np.append(False, follows & (np.diff(index) == 1)).astype(bool)
        smaller, equal = np.zeros(len(index), bool), np.ones(len(index), bool)
        for key in keys:
            one, other = batch.column(key).slice(1), batch.column(key).slice(0, len(index) - 1)
            # A null is smaller than any value.
            less = pc.or_(pc.less(one, other).fill_null(False), pc.and_(one.is_null(), other.is_valid()))
            same = pc.or_(pc.equal(one, other).fill_null(False), pc.and_(one.is_null(), other.is_null()))
            smaller[1:] |= equal[1:] & less.to_numpy(zero_copy_only=False)
            equal[1:] &= same.to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(~follows)
        lasts = np.append(starts[1:], len(index)) - 1
        columns = {
            "file_path": path.take(starts), "row_index": pa.array(index[starts]),
            "stored": pa.array(lasts - starts + 1), "smaller": pa.array(np.add.reduceat(smaller & follows, starts, dtype=np.int64)),
        }
        columns |= {f"first_{key}": batch.column(key).take(starts) for key in keys}
        columns |= {f"last_{key}": batch.column(key).take(lasts) for key in keys}
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _over_stored(operator: Callable[..., DataFrame], *needed: schemas.Table) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        built = warehouse(spark, sf_dir)
        return operator(*(built.table(spark, table) for table in needed))

    return query


def quality_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.raw_metrics(fixtures.gate_records(spark, sf_dir))


def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty and repeated documents, a date that is absent, one not asked for, and a dataset without any document."""
    dates = [*days(spark, sf_dir)[1:], ABSENT]
    records = fixtures.faulty_records(spark, sf_dir)
    faulty = quality.raw_metrics(records, dates)
    empty = quality.raw_metrics(records | {"line_status": records["line_status"].where("false")}, dates)
    return faulty.withColumn("input", F.lit("faulty")).unionByName(
        empty.where("dataset = 'line_status'").withColumn("input", F.lit("empty"))
    )


def quality_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts per stored table and date, all eight tables, and one date never loaded."""
    built = warehouse(spark, sf_dir)
    dates = [*built.dates, ABSENT]
    return quality.load_metrics(spark, built.database, dates, quality.DAILY_GOLD + quality.HOURLY_GOLD)


# --- table maintenance -------------------------------------------------------------


def _bike_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.bike_bronze(spark, sf_dir).select(
        "extracted_date", "station_id", "nb_bikes", "nb_docks", "occupancy_pct"
    )


def replace_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dates loaded; then even days replaced, every sixth of which has no rows any more."""
    rows = _bike_rows(spark, sf_dir)
    dates = days(spark, sf_dir)
    database = new_database()
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{scratch_folder(spark)}'")
    table = f"{database}.stations"
    columns = ", ".join(f"{name} {type_}" for name, type_ in rows.dtypes)
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet "
        "OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (extracted_date)"
    )
    tables.replace_dates(rows, table, "extracted_date", dates, ["station_id"])
    again = rows.where((F.day("extracted_date") % 2 == 0) & (F.day("extracted_date") % 6 != 0))
    again = again.withColumn("nb_bikes", F.col("nb_bikes") + 1000)
    even = [day for day in dates if day.day % 2 == 0]
    if even:
        tables.replace_dates(again, table, "extracted_date", even, ["station_id"])
    return spark.table(table).select(*rows.columns)


def repartition_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flat table swapped for a partitioned copy, and read back."""
    rows = _bike_rows(spark, sf_dir)
    database = new_database()
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{scratch_folder(spark)}'")
    rows.write.saveAsTable(f"{database}.stations")
    tables.repartition_by_date(spark, database, "stations", "extracted_date", ["station_id"])
    return spark.table(f"{database}.stations").select(*rows.columns)


def repartition_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight stored tables as flat ones, partitioned in place, twice, and counted."""
    built = warehouse(spark, sf_dir)
    database = new_database()
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{scratch_folder(spark)}'")
    for table in schemas.TABLES.values():
        built.table(spark, table).write.option("compression", "zstd").saveAsTable(f"{database}.{table.name}")
    first, second = (tables.repartition_all(spark, database) for _ in range(2))
    counts = [
        spark.table(f"{database}.{name}").agg(
            F.lit(name).alias("table_name"), F.lit(first[name]).alias("swapped"),
            F.lit(second[name]).alias("swapped_again"), F.count("*").alias("rows_after"),
        )
        for name in schemas.TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


def _daily_line_from_hours(bronze: DataFrame) -> DataFrame:
    daily = gold.merge_line_state(gold.hourly_line_state(bronze), gold.DAY)
    return gold.finish_line(daily, schemas.GOLD_DAILY_LINE)


def _daily_bike_from_hours(bronze: DataFrame) -> DataFrame:
    daily = gold.merge_bike_state(gold.hourly_bike_state(bronze), gold.DAY)
    return gold.finish_bike(daily, schemas.GOLD_DAILY_BIKE)


QUERIES: dict[str, Query] = {
    "flatten_line_status": _over(flatten_line_status, fixtures.line_documents),
    "flatten_bike_points": _over(flatten_bike_points, fixtures.bike_documents),
    "flatten_air_quality": _over(flatten_air_quality, fixtures.air_documents),
    "clean_line_status": _over(clean.clean_line_status, fixtures.line_records, _wall_clock),
    "clean_bike_points": _over(clean.clean_bike_points, fixtures.bike_records, _wall_clock),
    "clean_air_quality": _over(clean.clean_air_quality, fixtures.air_records, _wall_clock),
    "gold_daily_line": _over(gold.daily_line, fixtures.line_bronze),
    "gold_hourly_line": _over(gold.hourly_line, fixtures.line_bronze),
    "gold_daily_bike": _over(gold.daily_bike, fixtures.bike_bronze),
    "gold_hourly_bike": _over(gold.hourly_bike, fixtures.bike_bronze),
    "gold_daily_air": _over(gold.daily_air, fixtures.air_bronze),
    "gold_daily_line_from_hours": _over(_daily_line_from_hours, fixtures.line_bronze),
    "gold_daily_bike_from_hours": _over(_daily_bike_from_hours, fixtures.bike_bronze),
    "stored_row_order": stored_row_order,
    # Tables as the whole pipeline leaves them, from landed JSON on.
    **{f"stored_{name}": partial(_stored, table) for name, table in schemas.TABLES.items()},
    "row_totals": row_totals,
    "latest_disruption": latest_disruption,
    "busiest_stations": _over_stored(analytics.busiest_stations, schemas.GOLD_DAILY_BIKE),
    "air_trend_30d": _over_stored(
        partial(analytics.air_trend, as_of=date(2024, 2, 14)), schemas.GOLD_DAILY_AIR
    ),
    "snapshot_history": _over_stored(analytics.snapshot_history, schemas.BRONZE_LINE_STATUS),
    "quality_raw": quality_raw,
    "quality_gate": quality_gate,
    "quality_load": quality_load,
    "replace_dates": replace_dates,
    "repartition_by_date": repartition_by_date,
    "repartition_all": repartition_all,
}


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        for key, value in REQUIRED.items():
            spark.conf.set(key, value)
        return query(spark, sf_dir)

    return run


def registered() -> dict[str, Query]:
    return {name: _prepared(query) for name, query in QUERIES.items()}
