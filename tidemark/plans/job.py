"""The pipeline: landed documents to bronze to gold, for any set of dates at once.

    spark-submit --py-files tidemark.zip tidemark/plans/job.py \
        --landing <folder> --database <name> \
        --first 2024-01-01 --last 2024-01-31
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import date, timedelta
from functools import partial
from typing import TypeVar

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType, TimestampType

from tidemark import schemas
from tidemark.operators import gold, quality, tables
from tidemark.operators.clean import clean_all
from tidemark.session import build_session, delete_folder, require_settings, scratch_folder, shuffles_freed
from tidemark.sources import read_snapshots

Result = TypeVar("Result")

# What the gate needs of a record and its table lacks: nearly constant columns, which take no room in the files.
GATE = StructType(
    [StructField("is_record", BooleanType()), StructField("document", LongType()), StructField("violates", BooleanType())]
)
GATE_READ = StructType([StructField("extracted_at", TimestampType()), *GATE.fields])


def run(
    spark: SparkSession,
    landing: str,
    database: str,
    dates: Iterable[date],
    location: str | None = None,
    min_records: dict[str, int] = quality.MIN_RECORDS,
    checked_gold: Iterable[schemas.Table] = quality.DAILY_GOLD,
    scratch: str | None = None,
    staged: bool = False,
    loaded: Callable[[], None] = lambda: None,
) -> None:
    """Gate, clean and load the landed documents of ``dates``, then rebuild their gold.

    Bronze is written once, to folders that no partition points to yet, and
    the gate reads its flags from those files; what passes is published. With
    ``staged`` the flat records are written to ``scratch`` first, gated there
    and read again to be loaded: twice the bytes, for a gate before any
    cleaning. ``loaded`` is called once bronze is published, when the documents
    are not read any more.
    """
    require_settings(spark)
    dates = sorted(set(dates))
    with shuffles_freed(spark):
        if staged:
            _load_staged(spark, landing, database, dates, location, min_records, scratch)
        else:
            _load_once(spark, landing, database, dates, location, min_records)
        loaded()
        build_gold(spark, database, dates)
        quality.assert_valid(quality.load_metrics(spark, database, dates, checked_gold, min_records))


def _load_staged(spark, landing, database, dates, location, min_records, scratch) -> None:
    folder = scratch_folder(spark, scratch, location)
    try:
        records = stage(read_snapshots(spark, landing, dates, keep_empty=True), folder)
        quality.assert_valid(quality.raw_metrics(records, dates, min_records))
        tables.ensure_tables(spark, database, location)
        cleaned = clean_all({name: frame.where("is_record") for name, frame in records.items()})
        load_bronze(spark, cleaned, database, dates)
    finally:
        delete_folder(spark, folder)


def _load_once(spark, landing, database, dates, location, min_records) -> None:
    tables.ensure_tables(spark, database, location)
    records = read_snapshots(spark, landing, dates, keep_empty=True)
    flagged = {name: frame.withColumn("violates", quality.violation(name)) for name, frame in records.items()}
    asked_for = F.coalesce(F.col("extracted_date").isin(*dates), F.lit(False))
    kept = F.col("is_record") & ~F.col("violates") & asked_for
    cleaned = {name: frame.withColumn("kept", kept) for name, frame in clean_all(flagged, list(GATE.names)).items()}

    def check(loads: dict[str, tables.Load]) -> None:
        found = {name: spark.read.schema(GATE_READ).parquet(load.folder) for name, load in loads.items()}
        quality.assert_valid(quality.raw_metrics(found, dates, min_records))

    _load_checked(spark, cleaned, database, dates, check)


def stage(frames: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """The frames, read back from parquet in a shared folder."""
    spark = next(iter(frames.values())).sparkSession
    writes = (partial(frame.write.parquet, f"{folder}/{name}") for name, frame in frames.items())
    _side_by_side(spark, writes)
    return {name: spark.read.schema(frame.schema).parquet(f"{folder}/{name}") for name, frame in frames.items()}


def load_bronze(
    spark: SparkSession, cleaned: dict[str, DataFrame], database: str, dates: Iterable[date]
) -> None:
    """Replace ``dates`` of the three bronze tables; nothing changes unless every cleaner has left rows."""
    _load_checked(spark, cleaned, database, list(dates))


def _load_checked(
    spark: SparkSession,
    cleaned: dict[str, DataFrame],
    database: str,
    dates: list[date],
    check: Callable[[dict[str, tables.Load]], None] = lambda loads: None,
) -> None:
    """Write all datasets, count them on the way, ``check`` what was written, and publish it or remove it."""
    new = {
        dataset: tables.new_load(spark, tables.qualified(database, table.name), table.date_column, dates)
        for dataset, table in schemas.BRONZE.items()
    }

    def write(dataset: str) -> tables.Load:
        table, df = schemas.BRONZE[dataset], cleaned[dataset]
        extra = [name for name in GATE.names if name in df.columns]
        if "kept" in df.columns:
            df = tables.required_columns(df, table, F.col("kept"))
        else:
            df = tables.required_columns(tables.only_dates(df, table.date_column, dates), table)
        return tables.write_load(df, new[dataset], table.sort_columns, extra)

    try:
        written = dict(zip(new, _side_by_side(spark, [partial(write, dataset) for dataset in new]), strict=True))
        check(written)
        for dataset, load in written.items():
            quality.assert_not_empty(dataset, load.rows, load.kept)
    except BaseException:
        for load in new.values():
            tables.discard(spark, load)
        raise
    _side_by_side(spark, [partial(tables.publish, spark, load) for load in written.values()])


def build_gold(
    spark: SparkSession, database: str, dates: Iterable[date], share_hourly: bool = False
) -> None:
    """Rebuild the five gold tables for ``dates`` from bronze.

    By default each table is one scan and one aggregation. With
    ``share_hourly`` the daily tables are merged from the kept hourly state
    instead of read from bronze again. That pays where an hour holds many
    snapshots; where it holds about one, the state is as large as bronze.
    """
    require_settings(spark)
    dates = sorted(set(dates))
    lines, bikes, air = (tables.read_table(spark, database, table, dates) for table in schemas.BRONZE.values())

    def load(table: schemas.Table, df: DataFrame) -> None:
        tables.load_table(df, database, table, dates)

    def load_lines_from_state() -> None:
        with _kept(gold.hourly_line_state(lines)) as hourly:
            daily = gold.merge_line_state(hourly, gold.DAY)
            load(schemas.GOLD_HOURLY_LINE, gold.finish_line(hourly, schemas.GOLD_HOURLY_LINE))
            load(schemas.GOLD_DAILY_LINE, gold.finish_line(daily, schemas.GOLD_DAILY_LINE))

    def load_bikes_from_state() -> None:
        with _kept(gold.hourly_bike_state(bikes)) as hourly:
            daily = gold.merge_bike_state(hourly, gold.DAY)
            load(schemas.GOLD_HOURLY_BIKE, gold.finish_bike(hourly, schemas.GOLD_HOURLY_BIKE))
            load(schemas.GOLD_DAILY_BIKE, gold.finish_bike(daily, schemas.GOLD_DAILY_BIKE))

    if share_hourly:
        loads = [load_lines_from_state, load_bikes_from_state]
    else:
        # The tables of stations have the largest shuffles, so only one of the two is on disk at a time.
        stations = [
            partial(load, schemas.GOLD_DAILY_BIKE, gold.daily_bike(bikes)),
            partial(load, schemas.GOLD_HOURLY_BIKE, gold.hourly_bike(bikes)),
        ]
        loads = [
            partial(load, schemas.GOLD_DAILY_LINE, gold.daily_line(lines)),
            partial(load, schemas.GOLD_HOURLY_LINE, gold.hourly_line(lines)),
            partial(_one_by_one, stations),
        ]
    _side_by_side(spark, [*loads, partial(load, schemas.GOLD_DAILY_AIR, gold.daily_air(air))])


@contextmanager
def _kept(df: DataFrame) -> Iterator[DataFrame]:
    """The frame with its rows kept for reuse; lost ones are computed again."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def _side_by_side(spark: SparkSession, actions: Iterable[Callable[[], Result]]) -> list[Result]:
    """Submit independent jobs together, so small ones fill the gaps of large ones."""
    actions = list(actions)
    with_session = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(actions)) as pool:
        running = [pool.submit(with_session(action)) for action in actions]
    return [job.result() for job in running]


def _one_by_one(actions: Iterable[Callable[[], Result]]) -> list[Result]:
    return [action() for action in actions]


def rebuild_gold(
    spark: SparkSession,
    database: str,
    dates: Iterable[date],
    checked_gold: Iterable[schemas.Table] = quality.DAILY_GOLD,
) -> None:
    """Rebuild the gold tables of ``dates`` from bronze and check what was loaded."""
    dates = sorted(set(dates))
    with shuffles_freed(spark):
        build_gold(spark, database, dates)
        quality.assert_valid(quality.load_metrics(spark, database, dates, checked_gold))


def _parse_arguments(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument(
        "command", nargs="?", choices=("load", "gold", "repartition", "tidy"), default="load",
        help="load documents (the default), rebuild gold from bronze, partition old tables by date, "
        "or delete the files of rows that were replaced a day ago or earlier",
    )
    parser.add_argument("--landing", help="folder of landed documents, to load")
    parser.add_argument("--database", required=True, help="database of the bronze and gold tables")
    parser.add_argument("--location", help="folder of the database, where it is to be created")
    parser.add_argument("--scratch", help="shared folder for data in between, spark.checkpoint.dir by default")
    parser.add_argument("--first", type=date.fromisoformat, help="first date to load or rebuild")
    parser.add_argument("--last", type=date.fromisoformat, help="last date, the first by default")
    parser.add_argument("--check-hourly", action="store_true", help="check the hourly gold tables too")
    options = parser.parse_args(arguments)
    if options.command == "load" and not options.landing:
        parser.error("load needs --landing")
    if options.command in ("load", "gold") and not options.first:
        parser.error(f"{options.command} needs --first")
    return options


def main(arguments: list[str] | None = None) -> None:
    options = _parse_arguments(arguments)
    spark = build_session()
    if options.command == "repartition":
        tables.repartition_all(spark, options.database)
        return
    if options.command == "tidy":
        for table in schemas.TABLES:
            tables.drop_stale_loads(spark, tables.qualified(options.database, table))
        return
    last = options.last or options.first
    dates = [options.first + timedelta(days=n) for n in range((last - options.first).days + 1)]
    checked = quality.DAILY_GOLD + (quality.HOURLY_GOLD if options.check_hourly else ())
    if options.command == "gold":
        rebuild_gold(spark, options.database, dates, checked)
    else:
        run(
            spark, options.landing, options.database, dates, options.location,
            checked_gold=checked, scratch=options.scratch,
        )


if __name__ == "__main__":
    main()
