"""Partition replacement, repartitioning and warehouse tables on real parquet."""

from __future__ import annotations

from datetime import date, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.plans import formatted_plan
from tidemark import schemas
from tidemark.operators import tables
from tidemark.plans import analytics

D1, D2, D3 = date(2026, 7, 19), date(2026, 7, 20), date(2026, 7, 21)
SCHEMA = "extracted_date date, station_id int, nb_bikes int"


@pytest.fixture
def table(spark, database, tmp_path):
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/{database}'")
    spark.sql(
        f"CREATE TABLE {database}.t ({SCHEMA}) USING parquet "
        "OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (extracted_date)"
    )
    return f"{database}.t"


def batch(spark, n, *days, bikes=5):
    return spark.createDataFrame([(d, i, bikes) for d in days for i in range(n)], SCHEMA)


def content(spark, table, day=None):
    df = spark.table(table)
    if day:
        df = df.where(F.col("extracted_date") == day)
    return sorted(tuple(r) for r in df.select("extracted_date", "station_id", "nb_bikes").collect())


def replace(df, table, *days):
    tables.replace_dates(df, table, "extracted_date", days, ["station_id"])


def test_date_holds_exactly_the_new_rows(spark, table):
    replace(batch(spark, 5, D2, bikes=1), table, D2)
    replace(batch(spark, 3, D2), table, D2)
    assert content(spark, table) == [(D2, i, 5) for i in range(3)]


def test_reloading_neither_duplicates_nor_loses(spark, table):
    for _ in range(2):
        replace(batch(spark, 798, D2), table, D2)
        assert spark.table(table).count() == 798
    assert content(spark, table) == [(D2, i, 5) for i in range(798)]


def test_other_dates_are_untouched(spark, table):
    replace(batch(spark, 1, D1, bikes=1), table, D1)
    before = content(spark, table, D1)
    replace(batch(spark, 2, D2), table, D2)
    assert content(spark, table, D1) == before
    assert spark.table(table).count() == 3


def test_dates_without_rows_become_empty(spark, table):
    replace(batch(spark, 4, D1, D2, D3), table, D1, D2, D3)
    replace(batch(spark, 2, D2), table, D2, D3)
    assert content(spark, table, D1) == [(D1, i, 5) for i in range(4)]
    assert content(spark, table, D2) == [(D2, i, 5) for i in range(2)]
    assert content(spark, table, D3) == []
    # Rows again after having been emptied.
    replace(batch(spark, 1, D3), table, D3)
    assert content(spark, table, D3) == [(D3, 0, 5)]


def test_empty_batch_empties_its_dates_only(spark, table):
    replace(batch(spark, 4, D1, D2), table, D1, D2)
    replace(batch(spark, 4, D2).where(F.col("nb_bikes") < 0), table, D2)
    assert content(spark, table) == [(D1, i, 5) for i in range(4)]
    replace(spark.createDataFrame([], SCHEMA), table, D1)
    assert content(spark, table) == []


@pytest.mark.parametrize("stray", [D3, None])
def test_stray_date_fails_before_anything_changes(spark, table, stray):
    replace(batch(spark, 4, D1, D2), table, D1, D2)
    before = content(spark, table)
    with pytest.raises(Exception, match="row outside the requested dates"):
        replace(batch(spark, 1, D2).union(batch(spark, 1, stray)), table, D2)
    assert content(spark, table) == before


def test_no_dates_is_an_error(spark, table):
    with pytest.raises(ValueError, match="no dates"):
        replace(batch(spark, 1, D1), table)


def test_plain_overwrite_of_a_table_keeps_other_dates(spark, table):
    replace(batch(spark, 4, D1), table, D1)
    batch(spark, 1, D2).select("station_id", "nb_bikes", "extracted_date").write.insertInto(table, overwrite=True)
    assert len(content(spark, table)) == 5


def files(root, day):
    return sorted(Path(root).rglob(f"*extracted_date={day}/*.parquet"))


def test_heavy_date_is_split_and_light_dates_are_not(spark, table, tmp_path):
    """One date with nearly all rows must not be written by one task."""
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        heavy = spark.range(0, 400_000, numPartitions=16).select(
            F.lit(D1).alias("extracted_date"), F.col("id").cast("int").alias("station_id"),
            F.hash("id").alias("nb_bikes"))
        light = heavy.limit(100).withColumn("extracted_date", F.lit(D2))
        replace(heavy.union(light), table, D1, D2)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert len(files(tmp_path, D1)) >= 4
    assert len(files(tmp_path, D2)) == 1
    assert spark.table(table).count() == 400_100


def test_files_are_sorted_by_key(spark, table, tmp_path):
    replace(batch(spark, 500, D1).orderBy(F.rand(1)), table, D1)
    for file in files(tmp_path, D1):
        ids = [r.station_id for r in spark.read.parquet(str(file)).collect()]
        assert ids == sorted(ids)


def test_equal_keys_are_sorted_by_the_other_columns(spark, table, tmp_path):
    """Rows of one key stand by their values, nulls first, so that equal ones are neighbours; none is lost."""
    rows = spark.range(3_000).select(
        F.lit(D1).alias("extracted_date"), (F.col("id") % 7).cast("int").alias("station_id"),
        F.when(F.col("id") % 5 != 0, F.col("id") * 7919 % 11).cast("int").alias("nb_bikes"))
    replace(rows, table, D1)
    (file,) = files(tmp_path, D1)
    found = [(r.station_id, -1 if r.nb_bikes is None else r.nb_bikes) for r in spark.read.parquet(str(file)).collect()]
    assert found == sorted(found) and len(found) == 3_000
    assert spark.table(table).select(*rows.columns).exceptAll(rows).isEmpty()


def test_neighbours_in_the_sort_share_a_page(spark, table, tmp_path):
    """A page is compressed by itself: with 20,000 rows in each, values that recur later take their room again."""
    rows = spark.range(0, 200_000, 1, 1).select(
        F.lit(D1).alias("extracted_date"), F.col("id").cast("int").alias("station_id"),
        F.hash(F.col("id") % 30_000).alias("nb_bikes"))
    replace(rows, table, D1)
    (file,) = files(tmp_path, D1)
    small = rows.drop("extracted_date").write.option("compression", "zstd").option("parquet.writer.version", "v2")
    small.parquet(f"{tmp_path}/small_pages")
    (other,) = Path(f"{tmp_path}/small_pages").glob("*.parquet")
    here, there = (pq.ParquetFile(f).metadata.row_group(0).column(1) for f in (file, other))
    assert here.path_in_schema == there.path_in_schema == "nb_bikes"
    assert here.total_compressed_size < 0.6 * there.total_compressed_size
    assert spark.table(table).select(*rows.columns).exceptAll(rows).isEmpty() and spark.table(table).count() == 200_000


# --- warehouse ---------------------------------------------------------------


def air_rows(spark, *days):
    row = ("t", "Low", 1, "s", "a", "b", "c", "d", "e")
    df = spark.createDataFrame([(d, d, *row) for d in days], schemas.BRONZE_AIR_QUALITY.schema.fieldNames())
    return df.select(*(F.col(f.name).cast(f.dataType) for f in schemas.BRONZE_AIR_QUALITY.schema))


def test_ensure_tables_creates_eight_partitioned_tables_once(spark, database, tmp_path):
    tables.ensure_tables(spark, database, f"{tmp_path}/db")
    tables.load_table(air_rows(spark, D1), database, schemas.BRONZE_AIR_QUALITY, [D1])
    tables.ensure_tables(spark, database, f"{tmp_path}/db")
    assert {t.name for t in spark.catalog.listTables(database)} == set(schemas.TABLES)
    assert tables.read_table(spark, database, schemas.BRONZE_AIR_QUALITY).count() == 1
    for table in schemas.TABLES.values():
        assert tables.is_partitioned(spark, f"{database}.{table.name}")
        df = tables.read_table(spark, database, table)
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in table.schema]


def test_null_in_a_required_column_fails(spark, database, tmp_path):
    tables.ensure_tables(spark, database, f"{tmp_path}/db")
    rows = air_rows(spark, D1).withColumn("no2_band", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="bronze_air_quality.no2_band is NULL"):
        tables.load_table(rows, database, schemas.BRONZE_AIR_QUALITY, [D1])


def test_date_scan_prunes_partitions_and_columns(spark, database, tmp_path):
    tables.ensure_tables(spark, database, f"{tmp_path}/db")
    tables.load_table(air_rows(spark, D1, D2, D3), database, schemas.BRONZE_AIR_QUALITY, [D1, D2, D3])
    df = tables.read_table(spark, database, schemas.BRONZE_AIR_QUALITY, [D2]).select("forecast_band")
    plan = formatted_plan(df)
    assert "ReadSchema: struct<forecast_band:string>" in plan
    assert str(D2) in plan and f"extracted_date={D1}" not in plan
    assert df.count() == 1


# --- repartitioning ------------------------------------------------------------


@pytest.fixture
def flat(spark, database, tmp_path):
    """All eight tables, unpartitioned, bronze air quality with rows."""
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/{database}'")
    for table in schemas.TABLES.values():
        rows = air_rows(spark, D1, D2, D2) if table is schemas.BRONZE_AIR_QUALITY else spark.createDataFrame([], table.schema)
        rows.write.saveAsTable(f"{database}.{table.name}")
    return database


def test_repartition_keeps_rows_and_backup(spark, flat):
    name = "bronze_air_quality"
    before = sorted(map(tuple, tables.read_table(spark, flat, schemas.BRONZE_AIR_QUALITY).collect()))
    assert tables.repartition_by_date(spark, flat, name, "extracted_date", ("forecast_type",)) is True
    assert tables.is_partitioned(spark, f"{flat}.{name}")
    assert sorted(map(tuple, tables.read_table(spark, flat, schemas.BRONZE_AIR_QUALITY).collect())) == before
    assert spark.table(f"{flat}.{name}_pre_partition_backup").count() == 3
    assert not spark.catalog.tableExists(f"{flat}.{name}_new")
    # Again: skipped. And the swapped table takes partition replacement.
    assert tables.repartition_by_date(spark, flat, name, "extracted_date", ("forecast_type",)) is False
    tables.load_table(air_rows(spark, D2), flat, schemas.BRONZE_AIR_QUALITY, [D2])
    assert tables.read_table(spark, flat, schemas.BRONZE_AIR_QUALITY).count() == 2
    tables.load_table(air_rows(spark, D3), flat, schemas.BRONZE_AIR_QUALITY, [D2, D3])
    assert tables.read_table(spark, flat, schemas.BRONZE_AIR_QUALITY).count() == 2


def test_repartition_all(spark, flat):
    assert tables.repartition_all(spark, flat) == dict.fromkeys(schemas.TABLES, True)
    assert tables.repartition_all(spark, flat) == dict.fromkeys(schemas.TABLES, False)


def test_repartition_of_a_missing_table_fails(spark, flat):
    with pytest.raises(ValueError, match="does not exist"):
        tables.repartition_by_date(spark, flat, "absent", "extracted_date", ())


def test_count_mismatch_keeps_the_copy_and_the_table(spark, flat, monkeypatch):
    name = "bronze_air_quality"
    original = tables._rebalance
    monkeypatch.setattr(tables, "_rebalance", lambda df, column: original(df, column).where("extracted_date > '2026-07-19'"))
    with pytest.raises(RuntimeError, match="3 rows but 2 in the copy"):
        tables.repartition_by_date(spark, flat, name, "extracted_date", ("forecast_type",))
    assert spark.table(f"{flat}.{name}").count() == 3
    assert spark.table(f"{flat}.{name}_new").count() == 2
    assert not tables.is_partitioned(spark, f"{flat}.{name}")


def test_failed_swap_is_undone(spark, flat, monkeypatch):
    name = "bronze_air_quality"
    real = type(spark).sql

    def failing(self, text, *args, **kwargs):
        if "_new` RENAME TO" in text:
            raise RuntimeError("lost the catalog")
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(RuntimeError, match="lost the catalog"):
        tables.repartition_by_date(spark, flat, name, "extracted_date", ("forecast_type",))
    monkeypatch.undo()
    assert spark.table(f"{flat}.{name}").count() == 3
    assert not spark.catalog.tableExists(f"{flat}.{name}_pre_partition_backup")


def broken_off(spark, database, name, monkeypatch, keep_copy):
    """A swap that ends after its first rename, with or without its copy."""
    real = type(spark).sql

    def failing(self, text, *args, **kwargs):
        if "RENAME TO" in text and "_pre_partition_backup`" not in text.split("RENAME TO")[1]:
            raise KeyboardInterrupt
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(KeyboardInterrupt):
        tables.repartition_by_date(spark, database, name, "extracted_date", ("forecast_type",))
    monkeypatch.undo()
    if not keep_copy:
        spark.sql(f"DROP TABLE {database}.{name}_new")
    assert not spark.catalog.tableExists(f"{database}.{name}")


@pytest.mark.parametrize("keep_copy", [True, False])
def test_broken_off_swap_is_finished(spark, flat, monkeypatch, keep_copy):
    name = "bronze_air_quality"
    broken_off(spark, flat, name, monkeypatch, keep_copy)
    assert tables.repartition_by_date(spark, flat, name, "extracted_date", ("forecast_type",)) is not keep_copy
    assert tables.is_partitioned(spark, f"{flat}.{name}")
    assert tables.read_table(spark, flat, schemas.BRONZE_AIR_QUALITY).count() == 3


@pytest.mark.parametrize("keep_copy", [True, False])
def test_no_table_is_created_over_a_broken_off_swap(spark, flat, monkeypatch, keep_copy):
    name = "bronze_air_quality"
    broken_off(spark, flat, name, monkeypatch, keep_copy)
    tables.ensure_tables(spark, flat)
    assert tables.read_table(spark, flat, schemas.BRONZE_AIR_QUALITY).count() == 3
    assert tables.is_partitioned(spark, f"{flat}.{name}") is keep_copy


# --- publishing --------------------------------------------------------------


def watch_sql(spark, monkeypatch, after):
    """Calls ``after(statement)`` when a statement that changes partitions has run."""
    real = type(spark).sql

    def watched(self, text, *args, **kwargs):
        result = real(self, text, *args, **kwargs)
        if text.startswith("ALTER TABLE") and "PARTITION" in text:
            after(text)
        return result

    monkeypatch.setattr(type(spark), "sql", watched)


def test_readers_never_miss_a_date(spark, table, monkeypatch):
    replace(batch(spark, 4, D1, D2, bikes=1), table, D1, D2)
    seen = []
    watch_sql(spark, monkeypatch, lambda text: seen.append([content(spark, table, day) for day in (D1, D2)]))
    replace(batch(spark, 3, D1, D2, D3), table, D1, D2, D3)
    monkeypatch.undo()
    old, new = ([[(day, i, bikes) for i in range(n)] for day in (D1, D2)] for n, bikes in ((4, 1), (3, 5)))
    assert seen == [[new[0], old[1]], new, new]
    assert content(spark, table, D3) == [(D3, i, 5) for i in range(3)]


def test_stopped_job_leaves_whole_dates(spark, table, monkeypatch):
    replace(batch(spark, 4, D1, D2, bikes=1), table, D1, D2)
    before = content(spark, table)
    with monkeypatch.context() as patch:
        patch.setattr(tables, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            replace(batch(spark, 3, D1, D2), table, D1, D2)
    assert content(spark, table) == before

    def stop(text):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        watch_sql(spark, patch, stop)
        with pytest.raises(KeyboardInterrupt):
            replace(batch(spark, 3, D1, D2), table, D1, D2)
    assert content(spark, table) == [(D1, i, 5) for i in range(3)] + [(D2, i, 1) for i in range(4)]
    replace(batch(spark, 3, D1, D2), table, D1, D2)
    assert content(spark, table) == [(d, i, 5) for d in (D1, D2) for i in range(3)]


def loads(tmp_path):
    return sorted(p.name for p in tmp_path.rglob("load=*"))


def test_failed_write_leaves_nothing_behind(spark, table, tmp_path):
    replace(batch(spark, 4, D1), table, D1)
    before = loads(tmp_path)
    with pytest.raises(Exception, match="row outside"):
        replace(batch(spark, 4, D1, D2), table, D1)
    assert loads(tmp_path) == before and len(before) == 1


def test_stale_loads_are_dropped_once_old_enough(spark, table, tmp_path):
    for n in (4, 3):
        replace(batch(spark, n, D1, D2), table, D1, D2)
    replace(batch(spark, 2, D1), table, D1)
    assert tables.drop_stale_loads(spark, table) == [] and len(loads(tmp_path)) == 3
    assert len(tables.drop_stale_loads(spark, table, timedelta(seconds=-5))) == 1 and len(loads(tmp_path)) == 2
    assert content(spark, table) == [(D1, i, 5) for i in range(2)] + [(D2, i, 5) for i in range(3)]


def test_rows_that_are_not_kept_belong_to_no_partition(spark, table):
    load = tables.new_load(spark, table, "extracted_date", [D1, D2])
    rows = batch(spark, 4, D1, D2, D3).withColumn("kept", (F.col("station_id") > 0) & (F.col("extracted_date") < D3))
    written = tables.write_load(rows.withColumn("flag", F.lit(True)), load, ["station_id"], ["flag"])
    assert (written.rows, written.kept, written.written) == (12, 6, (D1, D2))
    assert content(spark, table) == []
    assert spark.read.schema("flag boolean").parquet(load.folder).where("flag").count() == 12
    tables.publish(spark, written)
    assert content(spark, table) == [(d, i, 5) for d in (D1, D2) for i in range(1, 4)]


# --- metadata ------------------------------------------------------------------


def test_counts_come_from_footers_of_both_layouts(spark, flat):
    table = schemas.BRONZE_AIR_QUALITY
    tables.repartition_by_date(spark, flat, table.name, table.date_column, ("forecast_type",))
    tables.load_table(air_rows(spark, D3, D3, D3), flat, table, [D3])
    assert tables.row_counts(spark, flat, table) == {D1: 1, D2: 2, D3: 3}
    assert tables.row_counts(spark, flat, table, [D2, date(2030, 1, 1)]) == {D2: 2}
    assert tables.row_counts(spark, flat, table, [date(2030, 1, 1)]) == {}
    frames = tables._footer_counts(spark, flat, table, None)
    assert len(frames) == 2
    for frame in frames:
        plan = formatted_plan(frame)
        assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [extracted_date" in plan


def test_answers_of_the_catalog_take_no_job(spark, table):
    replace(batch(spark, 4, D3, D1), table, D1, D3)
    spark.sparkContext.setJobGroup("catalog", "answers")
    try:
        assert tables.partition_dates(spark, table, "extracted_date") == [D1, D3]
        assert tables._location(spark, table).endswith("/t")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("catalog")


def test_latest_date_reads_nothing(spark, database, tmp_path):
    tables.ensure_tables(spark, database, f"{tmp_path}/db")
    table = schemas.BRONZE_AIR_QUALITY
    assert tables.latest_date(spark, database, table) is None
    tables.load_table(air_rows(spark, D1, D3), database, table, [D1, D3])
    for file in files(tmp_path, D3):
        file.unlink()
    assert tables.latest_date(spark, database, table) == D3
    daily = tables.read_table(spark, database, schemas.GOLD_DAILY_LINE)
    assert "ubquery" not in formatted_plan(analytics.latest_disruption(daily, D3))


# --- swaps ---------------------------------------------------------------------


def test_copy_with_one_changed_value_is_refused(spark, flat, monkeypatch):
    name, original = "bronze_air_quality", tables._rebalance
    changed = F.when(F.col("extracted_date") == D1, "changed").otherwise(F.col("no2_band"))
    monkeypatch.setattr(tables, "_rebalance", lambda df, column: original(df, column).withColumn("no2_band", changed))
    with pytest.raises(RuntimeError, match="differ on 1 dates from 2026-07-19 to 2026-07-19: 3 rows but 3 in the copy"):
        tables.repartition_by_date(spark, flat, name, "extracted_date", ("forecast_type",))
    assert not tables.is_partitioned(spark, f"{flat}.{name}")


def test_differing_dates_see_repeated_rows(spark):
    one = batch(spark, 2, D1, D2)
    assert tables.differing_dates(one, one.orderBy(F.desc("station_id")), "extracted_date").count() == 0
    twice = one.where(f"extracted_date = '{D1}' AND station_id = 0")
    swapped = one.where(f"NOT (extracted_date = '{D1}' AND station_id = 1)").union(twice)
    assert [r.day for r in tables.differing_dates(one, swapped, "extracted_date").collect()] == [D1]


def test_table_dropped_after_a_swap_stays_dropped(spark, flat):
    name = "bronze_air_quality"
    tables.repartition_by_date(spark, flat, name, "extracted_date", ("forecast_type",))
    spark.sql(f"DROP TABLE {flat}.{name}")
    tables.ensure_tables(spark, flat)
    assert spark.table(f"{flat}.{name}").count() == 0
    assert spark.table(f"{flat}.{name}_pre_partition_backup").count() == 3


def test_swap_that_broke_off_behind_its_second_rename_is_ended(spark, flat, monkeypatch):
    name = "bronze_air_quality"
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_find_partitions", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            tables.repartition_by_date(spark, flat, name, "extracted_date", ("forecast_type",))
    tables.finish_swap(spark, flat, name)
    assert tables.read_table(spark, flat, schemas.BRONZE_AIR_QUALITY).count() == 3
    assert tables._swap_of(spark, f"{flat}.{name}") is None
    assert tables._swap_of(spark, f"{flat}.{name}_pre_partition_backup") is None


# --- runs of dates -----------------------------------------------------------------


def test_runs_hold_every_date_once():
    counts = {D3: 5, D1: 2, D2: 2, None: 1, date(2026, 8, 1): 90}
    runs = tables.date_runs(counts, 4)
    assert runs == [[None, D1, D2, D3], [date(2026, 8, 1)]]
    assert tables.date_runs(counts, 100) == [[None, D1, D2, D3, date(2026, 8, 1)]]
    assert tables.date_runs({}, 4) == []


def test_runs_are_bounded_in_number_and_size():
    counts = {D1 + timedelta(days=n): 1 + n % 3 for n in range(1000)}
    runs = tables.date_runs(counts, 10)
    assert [day for run in runs for day in run] == sorted(counts)
    assert len(runs) <= 9 and max(sum(counts[day] for day in run) for run in runs) <= 251


def test_repartition_in_runs_keeps_all_rows(spark, table, monkeypatch):
    database = table.split(".")[0]
    rows = [(day, i, i % 3) for day in (D1, D2, D3, None) for i in range(50)] + [(D2, 7, 1)] * 2
    spark.createDataFrame(rows, SCHEMA).write.saveAsTable(f"{database}.flat")
    monkeypatch.setattr(tables, "_ROWS_PER_RUN", 60)
    written = []
    hint = tables._rebalance
    monkeypatch.setattr(tables, "_rebalance", lambda df, column: written.append(1) or hint(df, column))
    assert tables.repartition_by_date(spark, database, "flat", "extracted_date", ["station_id"])
    assert len(written) == 4
    found = spark.table(f"{database}.flat").select("extracted_date", "station_id", "nb_bikes").collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, rows))


def test_loads_and_copies_are_compressed_well(spark, table):
    database = table.split(".")[0]
    replace(batch(spark, 3, D1), table, D1)
    batch(spark, 3, D1).write.saveAsTable(f"{database}.flat")
    tables.repartition_by_date(spark, database, "flat", "extracted_date", ["station_id"])
    for name in (table, f"{database}.flat"):
        assert all(file.endswith(".zstd.parquet") for file in spark.table(name).inputFiles())
