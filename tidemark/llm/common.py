"""Helpers shared by the text operators."""

from __future__ import annotations

import atexit
import contextlib
import hashlib
import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# Rows that a worker takes at once.
SLICE = 1024
# What a block function gets and gives: columns of one batch.
Block = Callable[[pa.RecordBatch], dict[str, pa.Array]]


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; only where that is unset, one in the warehouse."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints").rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept as compressed Parquet in the shared folder, until the application ends.

    Executors can be lost without losing it. Unlike a checkpoint it is read by column.
    """
    spark = df.sparkSession
    own = f"{shared_folder(spark)}/tidemark-{spark.sparkContext.applicationId}"
    if own not in _folders:
        _folders.add(own)
        atexit.register(_delete, spark, own)
    path = f"{own}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    # The schema is given, so that no job reads it from the files.
    return spark.read.schema(df.schema).parquet(path)


_folders: set[str] = set()


def _delete(spark: SparkSession, path: str) -> None:
    """Best effort at the end: without a session there is nothing to delete with."""
    with contextlib.suppress(Exception):
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def importable(spark: SparkSession) -> None:
    """Lets workers on this machine import the package from where the driver did; clusters get it by --py-files."""
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*paths, root])


def with_block_columns(
    df: DataFrame, fields: list[StructField], start: Callable[[], Block], without: tuple[str, ...] = ()
) -> DataFrame:
    """``df`` with columns that ``start()`` computes batch by batch inside the tasks.

    ``start`` is called once a task and returns the function for its batches.
    Columns of the same names are replaced; columns ``without`` are read but not returned.
    """
    importable(df.sparkSession)
    new = [f.name for f in fields]
    clashing = {n.lower() for n in new}
    kept = [c for c in df.columns if c.lower() not in clashing]
    df = df.select(*(F.col(f"`{c}`") for c in kept))
    back = [i for i, c in enumerate(df.columns) if c not in without]
    schema = StructType([*(df.schema.fields[i] for i in back), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = start()
        for batch in slices(batches):
            added = block(batch)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in back), *(added[n] for n in new)], names=schema.fieldNames()
            )

    return df.mapInArrow(run, schema)


def rows_from_blocks(
    df: DataFrame, schema: StructType, start: Callable[[], Block]
) -> DataFrame:
    """New rows that ``start()`` makes from the batches of ``df`` inside the tasks."""
    importable(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = start()
        for batch in slices(batches):
            made = block(batch)
            yield pa.RecordBatch.from_arrays(
                [made[f.name] for f in schema.fields], names=schema.fieldNames()
            )

    return df.mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in smaller batches, so that a worker never holds the results of a whole one."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 of a text column, null as empty."""
    values = batch.column(batch.schema.get_field_index(column))
    return [v or b"" for v in values.cast(pa.binary()).to_pylist()]


def sha256_hex(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
