"""What the build of the stored tables keeps on disk, and what it returns whatever its runs."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from pathlib import Path
from threading import Event
from time import sleep

import pyarrow.parquet as pq
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import fixtures, queries, warehouse
from tests.plans import formatted_plan
from tidemark import schemas
from tidemark.operators import tables
from tidemark.plans import job
from tidemark.session import delete_folder, scratch_folder, shuffles_freed

FIRST = datetime(2024, 1, 1, 3)
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """Six days of a hundred events, half of them before noon."""
    rows = [
        (i, FIRST + timedelta(days=i // 100, hours=12 * (i % 2)), i % 40, "abcde"[i % 5] * 2, i * 1.5,
         f'{{"k": {i % 37}}}')
        for i in range(600)
    ]
    folder = tmp_path_factory.mktemp("events")
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return str(folder)


def stored(spark, built):
    return {
        table.name: sorted(map(repr, built.table(spark, table).collect())) for table in schemas.TABLES.values()
    }


def test_runs_of_dates_give_the_same_tables_and_leave_no_documents(spark, events, monkeypatch):
    monkeypatch.setattr(warehouse, "MIN_RECORDS", dict.fromkeys(schemas.DATASETS, 1))
    kept = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(kept.rglob("*.json*"))
    whole = stored(spark, warehouse.build(spark, events))
    landed, land = [], warehouse.land

    def seen(*arguments):
        landed.append((land(*arguments), arguments[-1]))
        return landed[-1][0]

    monkeypatch.setattr(warehouse, "land", seen)
    monkeypatch.setattr(warehouse, "EVENTS_PER_RUN", 300)
    built = warehouse.build(spark, events)
    assert len(landed) == 2
    assert sorted(day for _, dates in landed for day in dates) == built.dates
    assert stored(spark, built) == whole
    assert set(kept.rglob("*.json*")) == before


def test_documents_are_gone_before_gold_is_built(spark, events, monkeypatch):
    monkeypatch.setattr(warehouse, "MIN_RECORDS", dict.fromkeys(schemas.DATASETS, 1))
    kept, build_gold, seen = Path(spark.conf.get("spark.checkpoint.dir")), job.build_gold, []
    before = set(kept.rglob("*.json*"))

    def looked_at(*arguments):
        seen.append(set(kept.rglob("*.json*")) - before)
        return build_gold(*arguments)

    monkeypatch.setattr(job, "build_gold", looked_at)
    built = warehouse.build(spark, events)
    assert seen == [set()]
    assert built.table(spark, schemas.GOLD_DAILY_BIKE).count() > 0


def test_next_run_is_landed_while_one_is_loaded(spark, monkeypatch):
    counts = {date(2024, 1, 1) + timedelta(days=i): 100 for i in range(3)}
    begun, loaded = [Event() for _ in counts], []

    def land(spark, sf_dir, landing, dates):
        begun[int(landing.rsplit("-", 1)[1])].set()
        return landing

    def fill(spark, landing, *arguments):
        number = int(landing.rsplit("-", 1)[1])
        # Never more than one run ahead.
        loaded.append((all(event.wait(60) for event in begun[: number + 2]), any(event.is_set() for event in begun[number + 2 :])))

    monkeypatch.setattr(warehouse, "event_counts", lambda spark, sf_dir: counts)
    monkeypatch.setattr(warehouse, "land", land)
    monkeypatch.setattr(warehouse, "fill", fill)
    monkeypatch.setattr(warehouse, "EVENTS_PER_RUN", 100)
    warehouse.build(spark, "nowhere")
    assert loaded == [(True, False)] * 3


def test_events_are_read_once_for_all_documents_of_a_run(spark, events, tmp_path, monkeypatch):
    read, documents_by_date = [], warehouse.documents_by_date

    def seen(*arguments):
        documents = documents_by_date(*arguments)
        read.extend(file for frame in documents.values() for file in frame.inputFiles())
        return documents

    monkeypatch.setattr(warehouse, "documents_by_date", seen)
    landing = warehouse.land(spark, events, f"{tmp_path}/landing", [date(2024, 1, 2), date(2024, 1, 4)])
    assert read and not any(file.startswith(f"file:{events}") for file in read)
    for dataset in schemas.DATASETS:
        found = spark.read.json(f"{landing}/{dataset}").groupBy("date").count().collect()
        assert {str(row.date): row["count"] for row in found} == {"2024-01-02": 100, "2024-01-04": 100}
    # The events of the run are gone.
    assert [path.name for path in tmp_path.iterdir()] == ["landing"]


def test_station_documents_are_the_json_of_their_structs(spark, tmp_path):
    """Put together as text where no value is null, and with members left out where one is."""
    rows = [(1, FIRST, 7, "a", 12.5, '{"k": 3}'), (2, FIRST, None, "a", 1.0, '{"k": 39}'), (3, FIRST, 89_999, "a", None, '{"k": 0}'),
            (4, FIRST, 0, "a", 490.02, "{}"), (5, FIRST, 10**9, "a", 44.9, '{"k": 99}')]
    spark.createDataFrame(rows, EVENTS).write.parquet(f"{tmp_path}/events.parquet")
    found = {row.page: row.payload for row in fixtures.landed_documents(spark, str(tmp_path))["bike_points"].collect()}
    kind = "array<struct<id string, commonName string, lat double, lon double, additionalProperties array<struct<key string, value string>>>>"
    again = spark.createDataFrame(list(found.items()), "page long, payload string").select(
        "page", F.to_json(F.from_json("payload", kind)).alias("payload")
    )
    assert {row.page: row.payload for row in again.collect()} == found and len(found) == 5
    assert found[1].startswith(
        '[{"id":"BikePoints_84","commonName":"Stop 84 ","lat":51.084,"lon":-0.084,"additionalProperties":'
        '[{"key":"NbBikes","value":"12"},{"key":"NbEmptyDocks","value":"0"},{"key":"NbDocks","value":"3"}]},{"id":"BikePoints_85",'
    )
    assert found[2].startswith('[{"additionalProperties":[{"key":"NbBikes","value":"1"}')
    assert found[3].count('{"key":"NbBikes"}') == 12 and found[4].count('{"key":"NbDocks"}') == 12


def test_replacing_dates_needs_no_stored_tables(spark, events, monkeypatch):
    def build(*arguments):
        raise AssertionError("the stored tables are not read")

    monkeypatch.setattr(queries, "warehouse", build)
    found = queries.replace_dates(spark, events).groupBy("extracted_date").agg(F.count("*").alias("n"), F.min("nb_bikes").alias("least"))
    assert {row.extracted_date.day: (row.n, row.least >= 1000) for row in found.collect()} == {
        1: (100, False), 2: (100, True), 3: (100, False), 4: (100, True), 5: (100, False)
    }


def test_tables_of_stations_are_built_one_after_the_other(spark, events, monkeypatch):
    monkeypatch.setattr(warehouse, "MIN_RECORDS", dict.fromkeys(schemas.DATASETS, 1))
    load_table, running, most = tables.load_table, [], []

    def watched(df, database, table, dates):
        stations = "station_id" in table.columns
        if stations:
            running.append(table.name)
            most.append(len(running))
            sleep(0.5)
        load_table(df, database, table, dates)
        if stations:
            running.remove(table.name)

    monkeypatch.setattr(tables, "load_table", watched)
    warehouse.build(spark, events)
    assert most == [1, 1]


@pytest.mark.parametrize("table", [schemas.GOLD_DAILY_BIKE, schemas.GOLD_HOURLY_BIKE], ids=lambda table: table.name)
def test_files_of_a_heavy_date_hold_ranges_of_keys(spark, database, tmp_path, table):
    """Rows that an aggregate has dealt out by hash are written by key, so that neighbours stand in one file."""
    tables.ensure_tables(spark, database, f"{tmp_path}/{database}")
    days, number = [FIRST.date(), date(2024, 1, 2)], F.col("id")
    # The second day is light.
    values = {
        "summary_date": F.when(number < 50, F.lit(days[1])).otherwise(F.lit(days[0])), "summary_hour": number % 2 * 8,
        "station_id": (number / 2).cast("int"), "name": F.concat(F.lit("Stop "), number.cast("string")),
    }
    rows = spark.range(60_000).select(
        *(values.get(f.name, F.hash("id")).cast(f.dataType).alias(f.name) for f in table.schema)
    ).repartition(8, "name")
    sizes = [f"spark.sql.adaptive.{name}" for name in ("advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionSize")]
    old = {size: spark.conf.get(size) for size in sizes}
    try:
        for size in sizes:
            spark.conf.set(size, "256k")
        tables.load_table(rows, database, table, days)
    finally:
        for size, value in old.items():
            spark.conf.set(size, value)
    found = spark.table(tables.qualified(database, table.name))
    assert found.select(*rows.columns).exceptAll(rows).isEmpty() and found.count() == 60_000
    key = F.struct(*table.sort_columns)
    ranges = (
        found.groupBy("summary_date", "_metadata.file_path").agg(F.min(key).alias("first"), F.max(key).alias("last"))
        .orderBy("summary_date", "first").collect()
    )
    heavy = [row for row in ranges if row.summary_date == days[0]]
    assert len(heavy) >= 2 and len(ranges) - len(heavy) == 1
    assert all(one.last < other.first for one, other in zip(heavy, heavy[1:]))


def test_documents_are_landed_compressed(spark, events):
    landing = warehouse.land(spark, events, f"{scratch_folder(spark)}/landing", [date(2024, 1, 2)])
    files = [file for file in Path(landing).rglob("*.json*") if file.suffix != ".crc"]
    assert files and all(file.name.endswith(".json.gz") for file in files)
    assert {file.parent.name for file in files} == {"date=2024-01-02"}
    for dataset, documents in fixtures.landed_documents(spark, events).items():
        wanted = documents.where("date = '2024-01-02'").select("payload")
        found = spark.read.json(f"{landing}/{dataset}").select("payload")
        assert sorted(wanted.collect()) == sorted(found.collect())
    delete_folder(spark, landing)


def test_events_are_shuffled_and_not_their_documents(spark, events):
    """The documents are made above the only shuffle, and stand by date, so that the writer sorts none."""
    for documents in warehouse.documents_by_date(spark, events, [date(2024, 1, 2), date(2024, 1, 3)]).values():
        plan = documents._jdf.queryExecution().optimizedPlan()
        tree = plan.toString()
        assert tree.count("RepartitionByExpression") == 1
        assert tree.index(" AS payload") < tree.index("RepartitionByExpression")
        assert [order.child().name() for order in _each(plan.outputOrdering())] == ["date"]
        assert documents.count() == 200


def _each(sequence):
    return [sequence.apply(i) for i in range(sequence.size())]


def test_runs_do_not_grow_with_the_number_of_dates(spark, monkeypatch):
    """Twenty dates of a hundred events are landed one by one, where each fills a run."""
    counts = {date(2024, 1, 1) + timedelta(days=i): 100 for i in range(20)}
    landed = []
    monkeypatch.setattr(warehouse, "event_counts", lambda spark, sf_dir: counts)
    monkeypatch.setattr(warehouse, "land", lambda spark, sf_dir, landing, dates: landed.append(dates) or landing)
    monkeypatch.setattr(warehouse, "fill", lambda *arguments: None)
    monkeypatch.setattr(warehouse, "EVENTS_PER_RUN", 100)
    built = warehouse.build(spark, "nowhere")
    assert landed == [[day] for day in built.dates] and len(landed) == 20


def test_station_columns_are_stored_as_differences(spark, database, tmp_path):
    """Sorted stations take no dictionary, and nulls, repeats and texts of any kind are read back."""
    tables.ensure_tables(spark, database, f"{tmp_path}/{database}")
    table, number = schemas.GOLD_DAILY_BIKE, F.col("id")
    values = {
        "station_id": (number % 30_000).cast("int"), "name": F.concat(F.lit("Ä "), (number % 30_000).cast("string")),
        "lat": 51 + (number % 30_000) / 1000.0, "lon": -(number % 30_000) / 1000.0, "summary_date": F.lit(FIRST.date()),
    }
    fields = table.schema.fields
    rows = spark.range(60_000).select(
        *(values.get(f.name, F.lit(7)).cast(f.dataType).alias(f.name) for f in fields)
    ).withColumn("name", F.when(F.col("station_id") % 7 != 3, F.col("name")))
    name = tables.qualified(database, table.name)
    tables.replace_dates(rows, name, "summary_date", [FIRST.date()], table.sort_columns)
    assert spark.table(name).select(*table.columns).exceptAll(rows).isEmpty() and spark.table(name).count() == 60_000
    (file,) = (Path(f.removeprefix("file:")) for f in spark.table(name).inputFiles())
    group = pq.ParquetFile(file).metadata.row_group(0)
    encodings = {group.column(i).path_in_schema: set(group.column(i).encodings) for i in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in encodings["station_id"] and "DELTA_BYTE_ARRAY" in encodings["name"]
    dictionaries = {key for key, found in encodings.items() if any("DICTIONARY" in e for e in found)}
    assert not dictionaries & {"station_id", "name", "lat", "lon"} and "total_snapshots" in dictionaries


def test_shuffles_are_freed(spark, tmp_path):
    """Blocks of a shuffle are gone when its query has ended, and the setting is as before."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)

    def shuffled():
        return {f.getName() for f in _files(manager) if f.getName().startswith("shuffle_")}

    held = shuffled()
    with shuffles_freed(spark):
        spark.range(10_000).repartition(7, "id").write.parquet(f"{tmp_path}/rows")
    assert shuffled() <= held
    assert spark.conf.get(name, None) == before
    assert spark.read.parquet(f"{tmp_path}/rows").count() == 10_000


def _files(manager):
    files = manager.getAllFiles().iterator()
    while files.hasNext():
        yield files.next()


@pytest.mark.parametrize("name", ["bronze_line_status", "gold_hourly_bike_summary"])
def test_misplaced_rows_are_counted(spark, database, tmp_path, name):
    table = schemas.TABLES[name]
    tables.ensure_tables(spark, database, f"{tmp_path}/{database}")
    fields = {field.name: field.dataType for field in table.schema}
    number = F.col("id")
    values = {
        key: F.when(number % 11 == 3, None).otherwise((number * 7919 % 101)).cast(fields[key])
        for key in table.sort_columns
    } | {table.date_column: F.date_add(F.lit(date(2024, 1, 1)), (number % 3).cast("int"))}
    rows = spark.range(0, 40_000, 1, 4).select(
        *(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in spark.table(f"{database}.{name}").schema)
    )
    rows.write.insertInto(f"{database}.{name}")
    found = queries._misplaced(spark, database, table)
    before = F.lag("key").over(Window.partitionBy("file_path").orderBy("row_index"))
    wanted = (
        spark.table(f"{database}.{name}")
        .select(F.struct(*table.sort_columns).alias("key"), "_metadata.file_path", "_metadata.row_index")
        .withColumn("before", before)
        .agg(F.count("*"), F.count_if(F.col("key") < F.col("before")))
        .first()
    )
    assert tuple(found.first()) == (name, *wanted)
    assert wanted[0] == 40_000 and wanted[1] > 1_000
    # Only stretches are shuffled.
    tree = formatted_plan(found).split("\n\n")[0]
    assert tree.rindex("Exchange") < tree.index("MapInArrow")


def test_row_order_of_an_empty_table(spark, database, tmp_path):
    tables.ensure_tables(spark, database, f"{tmp_path}/{database}")
    assert tuple(queries._misplaced(spark, database, schemas.GOLD_DAILY_AIR).first()) == ("gold_daily_air_quality", 0, 0)
