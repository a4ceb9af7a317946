"""Date-partitioned tables: creation, scans, partition replacement, repartitioning."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta, timezone
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import required
from tidemark.session import delete_folder, folder_times, shuffles_freed

# An INSERT OVERWRITE without a partition spec must not empty other dates.
_OVERWRITE_MODE = ("partitionOverwriteMode", "dynamic")
_SPECS_PER_STATEMENT = 500
# Files of tables take a third less room than with the default codec.
_CODEC = ("compression", "zstd")
# Differences to the value before, which take little where rows are sorted.
_DELTAS = ("parquet.writer.version", "v2")
# A page is compressed by itself. The default ends one at 20,000 rows, too few for neighbours in the sort to find each other.
_PAGES = {
    "parquet.page.row.count.limit": "1000000000", "parquet.page.size": str(8 << 20), "parquet.compression.codec.zstd.level": "9",
}
# Large sets of dates are taken in this many runs, of so many rows or more, so that one run's shuffle is on disk at a time.
_RUNS = 8
_ROWS_PER_RUN = 1_000_000
# Table property that names the swap a table takes part in.
_SWAP = "tidemark.swap"


def qualified(database: str, table: str) -> str:
    return f"`{database}`.`{table}`"


def ensure_tables(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database and its eight tables where absent; a swap that broke off is finished first."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{at}")
    for table in schemas.TABLES.values():
        finish_swap(spark, database, table.name)
        columns = ", ".join(
            f"`{field.name}` {field.dataType.simpleString()}{'' if field.nullable else ' NOT NULL'}"
            for field in table.schema
        )
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {qualified(database, table.name)} ({columns}) USING parquet "
            f"OPTIONS ({_OVERWRITE_MODE[0]} '{_OVERWRITE_MODE[1]}') PARTITIONED BY (`{table.date_column}`)"
        )


def read_table(
    spark: SparkSession, database: str, table: schemas.Table, dates: Iterable[date] | None = None
) -> DataFrame:
    """The table in its contract column order; ``dates`` prunes partitions."""
    rows = spark.table(qualified(database, table.name))
    if dates is not None:
        rows = rows.where(F.col(table.date_column).isin(*_dates(dates)))
    return rows.select(*table.columns)


def load_table(df: DataFrame, database: str, table: schemas.Table, dates: Iterable[date]) -> None:
    """Replace ``dates`` of a warehouse table; a NULL in a NOT NULL column is an error."""
    replace_dates(
        required_columns(df, table), qualified(database, table.name), table.date_column, dates, table.sort_columns,
        in_ranges=True,
    )


def required_columns(df: DataFrame, table: schemas.Table, where: Column | None = None) -> DataFrame:
    """``df`` where a NULL in a NOT NULL column is an error, in rows that hold ``where``; other columns stay."""
    checked = {
        field.name: required(F.col(field.name), f"{table.name}.{field.name} is NULL")
        for field in table.schema
        if not field.nullable
    }
    if where is not None:
        checked = {name: F.when(where, column).otherwise(F.col(name)) for name, column in checked.items()}
    return df.select(*(checked[name].alias(name) if name in checked else F.col(name) for name in df.columns))


def replace_dates(
    df: DataFrame, table: str, date_column: str, dates: Iterable[date], sort_columns: Sequence[str] = (),
    in_ranges: bool = False,
) -> None:
    """Make ``df`` the whole content of the partitions ``dates``, in one job.

    Other dates are untouched. A row of another date fails the job before
    anything is replaced. A requested date without rows ends up empty.

    The rows are written to a new folder first. A date is replaced by pointing
    its partition there, so readers see its old rows or its new ones, and a
    job that is stopped leaves the old ones.
    """
    load = new_load(df.sparkSession, table, date_column, dates)
    rows = only_dates(df, date_column, load.dates)
    publish(df.sparkSession, write_load(rows, load, sort_columns, in_ranges=in_ranges))


def only_dates(df: DataFrame, date_column: str, dates: Iterable[date]) -> DataFrame:
    """``df``, failing at a row of any other date."""
    return df.withColumn(date_column, _expected_date(date_column, _dates(dates)))


# --- loads -----------------------------------------------------------------------
#
# A load is a folder ``load=<id>/kept=<true or false>/<date column>=<day>`` in the
# table's own. Partitions point into the folders of their last loads. Rows that are
# not kept belong to no partition; they are there for the gate alone.


@dataclass(frozen=True)
class Load:
    """Where new rows of a table are, and which dates they replace."""

    table: str
    date_column: str
    dates: tuple[date, ...]
    folder: str
    written: tuple[date, ...] = ()
    rows: int = 0
    kept: int = 0


def new_load(spark: SparkSession, table: str, date_column: str, dates: Iterable[date]) -> Load:
    return Load(table, date_column, tuple(_dates(dates)), f"{_location(spark, table)}/load={uuid.uuid4().hex}")


def write_load(
    df: DataFrame, load: Load, sort_columns: Sequence[str] = (), extra: Sequence[str] = (), in_ranges: bool = False
) -> Load:
    """Write ``df`` to the load's folder, nothing of which is visible yet, and count rows and dates on the way.

    Rows with a false ``kept``, where there is such a column, are set apart.
    Within ``sort_columns`` rows go by the other columns, so that equal values stand together.
    ``extra`` columns stand in the files without being columns of the table.
    With ``in_ranges`` each file of a date has a range of ``sort_columns``, for
    which the keys are read once more; it suits rows that an aggregate has dealt
    out by hash, whose files else hold keys from everywhere.
    A write that fails leaves nothing behind.
    """
    spark = df.sparkSession
    kept = F.col("kept") if "kept" in df.columns else F.lit(True)
    fields = spark.table(load.table).schema
    seen = Observation()
    ties = [name for name in (*fields.names, *extra) if name not in (load.date_column, *sort_columns)]
    dealt = partial(_in_ranges, sort_columns=sort_columns) if in_ranges else _rebalance
    batch = (
        df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in fields), *extra, kept.alias("kept"))
        .transform(dealt, load.date_column)
        .observe(
            seen, F.collect_set(F.when(F.col("kept"), F.col(load.date_column))).alias("dates"),
            F.count(F.lit(1)).alias("rows"), F.count_if("kept").alias("kept"),
        )
        .sortWithinPartitions("kept", load.date_column, *sort_columns, *ties)
    )
    try:
        writer = batch.write.option(*_CODEC).option(*_DELTAS).options(**_PAGES, **_no_dictionary(batch.columns))
        writer.partitionBy("kept", load.date_column).parquet(load.folder)
    except BaseException:
        delete_folder(spark, load.folder)
        raise
    got = seen.get
    return replace(load, written=tuple(sorted(got["dates"])), rows=got["rows"], kept=got["kept"])


def _no_dictionary(columns: Iterable[str]) -> dict[str, str]:
    """Write options: a dictionary of the columns that follow the sort takes more room than their differences."""
    return {f"parquet.enable.dictionary#{name}": "false" for name in columns if name in schemas.STATION_COLUMNS}


def discard(spark: SparkSession, load: Load) -> None:
    """Remove a load that is not to be published."""
    delete_folder(spark, load.folder)


def publish(spark: SparkSession, load: Load) -> None:
    """Point the partitions of the load's dates to its rows, one date after the other; catalog entries only."""
    known = set(partition_dates(spark, load.table, load.date_column))
    place = lambda day: f"{load.folder}/kept=true/{load.date_column}={day}"
    spec = lambda day: f"PARTITION (`{load.date_column}` = DATE'{day}')"
    for day in load.written:
        if day in known:
            spark.sql(f"ALTER TABLE {load.table} {spec(day)} SET LOCATION '{place(day)}'")
    new = [f"{spec(day)} LOCATION '{place(day)}'" for day in load.written if day not in known]
    emptied = [spec(day) for day in load.dates if day in known.difference(load.written)]
    for start in range(0, len(new), _SPECS_PER_STATEMENT):
        spark.sql(f"ALTER TABLE {load.table} ADD IF NOT EXISTS {' '.join(new[start : start + _SPECS_PER_STATEMENT])}")
    for start in range(0, len(emptied), _SPECS_PER_STATEMENT):
        spark.sql(f"ALTER TABLE {load.table} DROP IF EXISTS {', '.join(emptied[start : start + _SPECS_PER_STATEMENT])}")
    spark.catalog.refreshTable(load.table)


def drop_stale_loads(spark: SparkSession, table: str, keep: timedelta = timedelta(days=1)) -> list[str]:
    """Delete load folders that no partition points into and that are older than ``keep``; returns their names.

    Replaced rows stay until then, so that queries which began before can end.
    """
    root = _location(spark, table)
    used = {part for file in spark.table(table).inputFiles() for part in file.split("/") if part.startswith("load=")}
    before = datetime.now(timezone.utc) - keep
    stale = [
        name
        for name, changed in folder_times(spark, root)
        if name.startswith("load=") and name not in used and changed < before
    ]
    for name in stale:
        delete_folder(spark, f"{root}/{name}")
    return stale


def _location(spark: SparkSession, table: str) -> str:
    # The catalog's answer is with the driver; looked through there, it takes no job.
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return next(row.data_type for row in described if row.col_name == "Location").rstrip("/")


# --- metadata --------------------------------------------------------------------


def partition_dates(spark: SparkSession, table: str, date_column: str) -> list[date]:
    """Dates that have a partition, from the catalog; a load leaves none without rows."""
    parts = (part for row in spark.sql(f"SHOW PARTITIONS {table}").collect() for part in row.partition.split("/"))
    return sorted(date.fromisoformat(day) for name, _, day in (part.partition("=") for part in parts) if name == date_column)


def latest_date(spark: SparkSession, database: str, table: schemas.Table) -> date | None:
    """The latest date of a table, without reading it."""
    dates = partition_dates(spark, qualified(database, table.name), table.date_column)
    return dates[-1] if dates else None


def row_counts(
    spark: SparkSession, database: str, table: schemas.Table, dates: Iterable[date] | None = None
) -> dict[date, int]:
    """Rows per date from the footers of the files; no row is read. Dates without a partition are left out."""
    counts: dict[date, int] = {}
    for frame in _footer_counts(spark, database, table, dates):
        for row in frame.collect():
            counts[row.day] = counts.get(row.day, 0) + row.rows
    return counts


def _footer_counts(
    spark: SparkSession, database: str, table: schemas.Table, dates: Iterable[date] | None
) -> list[DataFrame]:
    """One aggregation per layout of partition folders, pushed down to the file footers."""
    root = _location(spark, qualified(database, table.name))
    folders: dict[bool, set[str]] = {}
    for file in read_table(spark, database, table, dates).inputFiles():
        folder = file.rsplit("/", 1)[0]
        folders.setdefault("/load=" in folder, set()).add(folder)
    own = spark.newSession()
    # The newer reader takes counts by partition column from footers.
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return [
        own.read.option("basePath", root)
        .parquet(*sorted(paths))
        # By all columns of the folders, without which nothing is pushed down.
        .groupBy(F.col(table.date_column).alias("day"), *(["load", "kept"] if is_load else []))
        .agg(F.count(F.lit(1)).alias("rows"))
        for is_load, paths in folders.items()
    ]


# --- repartitioning ----------------------------------------------------------------


def is_partitioned(spark: SparkSession, table: str) -> bool:
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist, create the tables first")
    return any(column.isPartition for column in spark.catalog.listColumns(table))


def repartition_by_date(
    spark: SparkSession, database: str, table: str, date_column: str, sort_columns: Sequence[str]
) -> bool:
    """Swap an unpartitioned table for a copy partitioned by date.

    The old table stays as ``<table>_pre_partition_backup``. Returns False
    where the table is partitioned already.
    """
    current = qualified(database, table)
    copy = qualified(database, f"{table}_new")
    backup = qualified(database, f"{table}_pre_partition_backup")
    finish_swap(spark, database, table)
    if is_partitioned(spark, current):
        return False

    spark.sql(f"DROP TABLE IF EXISTS {copy}")
    with shuffles_freed(spark):
        for rows in _by_runs(spark.table(current), date_column):
            (
                rows.transform(_rebalance, date_column)
                .sortWithinPartitions(date_column, *sort_columns)
                .write.format("parquet")
                .mode("append")
                .option(*_OVERWRITE_MODE)
                .option(*_CODEC)
                .partitionBy(date_column)
                .saveAsTable(copy)
            )

    _require_equal(spark.table(current), spark.table(copy), date_column, f"{table} and its copy {copy}")

    # Both halves of the swap carry its name until it is over.
    swap = uuid.uuid4().hex
    for side in (copy, current):
        spark.sql(f"ALTER TABLE {side} SET TBLPROPERTIES ('{_SWAP}' = '{swap}')")
    spark.sql(f"DROP TABLE IF EXISTS {backup}")
    spark.sql(f"ALTER TABLE {current} RENAME TO {backup}")
    try:
        spark.sql(f"ALTER TABLE {copy} RENAME TO {current}")
    except Exception:
        spark.sql(f"ALTER TABLE {backup} RENAME TO {current}")
        _end_swap(spark, current)
        raise
    _find_partitions(spark, current)
    _end_swap(spark, backup, current)
    return True


def finish_swap(spark: SparkSession, database: str, table: str) -> None:
    """Finish a swap that broke off between or behind its two renames.

    A backup that carries the name of a swap belongs to one that is not over.
    If the table is absent, the copy of that swap, which was compared before,
    takes its place, else the backup goes back. A backup without a name is an
    old one; a table that was dropped later stays dropped.
    """
    current = qualified(database, table)
    copy = qualified(database, f"{table}_new")
    backup = qualified(database, f"{table}_pre_partition_backup")
    exists = spark.catalog.tableExists
    swap = _swap_of(spark, backup) if exists(backup) else None
    if swap is None:
        return
    if exists(current):
        # Broken off behind the second rename, unless another table has come since.
        ended = [backup]
        if _swap_of(spark, current) == swap:
            _find_partitions(spark, current)
            ended.append(current)
        _end_swap(spark, *ended)
    elif exists(copy) and _swap_of(spark, copy) == swap:
        spark.sql(f"ALTER TABLE {copy} RENAME TO {current}")
        _find_partitions(spark, current)
        _end_swap(spark, backup, current)
    else:
        spark.sql(f"ALTER TABLE {backup} RENAME TO {current}")
        _end_swap(spark, current)


def _swap_of(spark: SparkSession, table: str) -> str | None:
    properties = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return properties.get(_SWAP)


def _end_swap(spark: SparkSession, *sides: str) -> None:
    for side in sides:
        spark.sql(f"ALTER TABLE {side} UNSET TBLPROPERTIES IF EXISTS ('{_SWAP}')")


def differing_dates(one: DataFrame, other: DataFrame, date_column: str) -> DataFrame:
    """Dates on which two tables differ, with the rows of both: a sum and a parity of row hashes, in any order of rows."""
    columns = one.columns
    row = F.xxhash64(*(F.col(c) for c in columns))
    sides = [
        df.select(F.col(date_column).alias("day"), row.alias("h"), F.lit(sign).alias("sign"))
        for df, sign in ((one, 1), (other.select(*columns), -1))
    ]
    return (
        sides[0]
        .unionAll(sides[1])
        .groupBy("day")
        .agg(
            F.count_if(F.col("sign") > 0).alias("before"), F.count_if(F.col("sign") < 0).alias("after"),
            F.sum(F.col("h").cast("decimal(20,0)") * F.col("sign")).alias("balance"), F.bit_xor("h").alias("parity"),
        )
        .where("before <> after OR balance <> 0 OR parity <> 0")
        .select("day", "before", "after")
    )


def _require_equal(one: DataFrame, other: DataFrame, date_column: str, names: str) -> None:
    found = (
        differing_dates(one, other, date_column)
        .agg(F.count("*").alias("dates"), F.min("day").alias("first"), F.max("day").alias("last"))
        .first()
    )
    if found.dates:
        raise RuntimeError(
            f"{names} differ on {found.dates} dates from {found.first} to {found.last}: "
            f"{one.count()} rows but {other.count()} in the copy, which is kept"
        )


def _find_partitions(spark: SparkSession, table: str) -> None:
    """A rename moves the folder, but some catalogs keep the old partition paths."""
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")


def repartition_all(spark: SparkSession, database: str) -> dict[str, bool]:
    return {
        table.name: repartition_by_date(spark, database, table.name, table.date_column, table.sort_columns)
        for table in schemas.TABLES.values()
    }


def date_runs(
    counts: dict[date | None, int], least: int, most_runs: int | None = _RUNS
) -> list[list[date | None]]:
    """Dates in order, in runs of an eighth of all rows, or of ``least`` where that is more; a date is never split.

    Without ``most_runs`` all runs are of ``least``, so that what one has on disk does not grow with the rows.
    """
    most = least if most_runs is None else max(least, -(-sum(counts.values()) // most_runs))
    runs, size = [], 0
    for day in sorted(counts, key=lambda day: (day is not None, day)):
        if not runs or size + counts[day] > most:
            runs.append([])
            size = 0
        runs[-1].append(day)
        size += counts[day]
    return runs


def of_dates(df: DataFrame, date_column: str, dates: Iterable[date | None]) -> DataFrame:
    """The rows of ``dates``, among which may be NULL."""
    dates, day = list(dates), F.col(date_column)
    found = day.isin(*(d for d in dates if d is not None))
    return df.where(found | day.isNull() if None in dates else found)


def _by_runs(df: DataFrame, date_column: str) -> list[DataFrame]:
    """``df`` in runs of dates; all of it where there is one run."""
    counted = df.groupBy(F.col(date_column).alias("day")).agg(F.count(F.lit(1)).alias("rows")).collect()
    runs = date_runs({row.day: row.rows for row in counted}, _ROWS_PER_RUN)
    return [of_dates(df, date_column, run) for run in runs] if len(runs) > 1 else [df]


def _dates(dates: Iterable[date]) -> list[date]:
    listed = sorted(set(dates))
    if not listed:
        raise ValueError("no dates given")
    return listed


def _rebalance(df: DataFrame, date_column: str) -> DataFrame:
    """Gather each date into few files; adaptive execution splits a heavy date."""
    return df.hint("rebalance", date_column)


def _in_ranges(df: DataFrame, date_column: str, sort_columns: Sequence[str]) -> DataFrame:
    """Deal rows out by date and key; adaptive execution merges small ranges."""
    return df.repartitionByRange(date_column, *sort_columns)


def _expected_date(date_column: str, dates: list[date]) -> Column:
    day = F.col(date_column)
    stray = F.concat(F.lit("row outside the requested dates: "), F.coalesce(day.cast("string"), F.lit("NULL")))
    return F.when(day.isin(*dates), day).otherwise(F.raise_error(stray).cast("date"))
