"""Importance resampling of documents towards a target corpus.

Texts are bags of hashed word runs. The gain of a bucket is the log-ratio of
its smoothed shares in the target and in the documents; a document's weight is
the sum of the gains of its features, taken from one array. With Gumbel noise
from a hash of its id added, the highest scores are a draw without
replacement in proportion to the exponent of the weight.

The cutoff is found without sorting all scores: a quantile sketch brackets it,
exact counts of what lies outside validate the bracket or widen it, and only
what is inside is looked at again, by sketches first, until at most
``sort_rows`` rows are sorted. Where many rows tie at one score, the same is
done on their ids. Ranks come from ranges of the drawn rows, so no task ever
holds all of them.

Defined cases: null and empty text has no words, no features and weight 0;
documents with fewer than ``least_words`` words are scored but never drawn;
a null id draws its noise as the empty text and ranks behind equal scores;
repeated rows have equal scores and ranks next to each other; other columns
are ignored; empty documents give an empty result, an empty target is all
smoothing.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidemark.llm import words as W
from tidemark.llm.common import importable, stored, texts_of, with_block_columns

BUCKETS, RUN, SEED = 10_000, 1, 2024
# Rows that are sorted in one task to find the cutoff, and accuracy of the sketches.
SORT_ROWS, ACCURACY = 100_000, 1_000

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_COUNTS = StructType([StructField("bucket", IntegerType()), StructField("n", LongType())])


def features(text: bytes, run: int, buckets: int) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every run of 1 to ``run`` of them."""
    found = _WORD.findall(text.translate(W.LOWER))
    runs = found
    for size in range(2, run + 1):
        runs = runs + [b" ".join(found[i : i + size]) for i in range(len(found) - size + 1)]
    hashed = np.fromiter(map(zlib.crc32, runs), dtype=np.int64, count=len(runs))
    return len(found), hashed % buckets


def bucket_counts(docs: DataFrame, text: str = "text", run: int = RUN, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all texts; ``buckets`` numbers reach the driver, whatever the size of the data."""
    importable(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for value in texts_of(batch, text):
                total += np.bincount(features(value, run, buckets)[1], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=_COUNTS.names)

    own = docs.select(F.col(f"`{text}`").alias(text)).mapInArrow(count, _COUNTS)
    counts = np.zeros(buckets, dtype=np.int64)
    for row in own.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row.bucket] = row.n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the source."""
    buckets = len(source)
    every, wanted = float(source.sum() + buckets), float(target.sum() + buckets)
    return np.array(
        [math.floor(1000 * math.log((float(t) + 1) * every / ((float(s) + 1) * wanted))) for s, t in zip(source, target, strict=True)],
        dtype=np.int64,
    )


def noise(name: str, seed: int = SEED) -> int:
    """Gumbel noise in thousandths from the hash of an id."""
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(
    docs: DataFrame, gain: np.ndarray, *, id_column: str = "doc_id", text: str = "text", run: int = RUN, seed: int = SEED
) -> DataFrame:
    """``id``, ``n_words``, ``n_features``, ``weight`` and ``score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # as many numbers as there are buckets
    names = ("n_words", "n_features", "weight", "score")

    def start():
        own = shared.value

        def block(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            made = [features(t, run, len(own)) for t in texts_of(batch, "text")]
            weight = [int(own[f].sum()) for _, f in made]
            drawn = [noise(n or "", seed) for n in batch.column(batch.schema.get_field_index("name")).to_pylist()]
            columns = [n for n, _ in made], [len(f) for _, f in made], weight, list(map(int.__add__, weight, drawn))
            return {n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)}

        return block

    id_ = F.col(f"`{id_column}`")
    rows = docs.select(id_.alias("id"), id_.cast("string").alias("name"), F.col(f"`{text}`").alias("text"))
    return with_block_columns(rows, [StructField(n, LongType()) for n in names], start, ("text", "name"))


def _counts(rows: DataFrame, place: Column, low: int, high: int) -> tuple[int, int]:
    """Rows above the bracket, and inside it."""
    inside = (place >= low) & (place <= high)
    got = rows.agg(F.count_if(place > high).alias("above"), F.count_if(inside).alias("inside")).first()
    return got.above, got.inside


def _bracket(rows: DataFrame, column: str, nth: int, total: int, sort_rows: int) -> tuple[DataFrame, int, bool]:
    """The rows among which the ``nth`` highest of ``column`` is, its place among them, and whether all are equal there.

    Every turn asks a sketch for two values around the wanted one. Exact
    counts tell whether the value is between them; if not, the side that
    failed moves to the end of the range. Where that leaves all rows inside,
    the highest value is split off.
    """
    place = F.col(column)
    while total > sort_rows:
        share, slack = 1 - nth / total, 2 / ACCURACY
        around = F.percentile_approx(place, [max(0.0, share - slack), min(1.0, share + slack)], ACCURACY)
        found = rows.agg(F.min(place).alias("least"), F.max(place).alias("most"), around.alias("around")).first()
        if found.least == found.most:
            return rows, nth, True
        low, high = found.around
        above, inside = _counts(rows, place, low, high)
        if above >= nth:
            low, high = high, found.most
        elif above + inside < nth:
            low, high = found.least, low
        above, inside = _counts(rows, place, low, high)
        if inside == total:
            top = rows.where(place == found.most).count()
            low, high, above, inside = (
                (found.most, found.most, 0, top) if nth <= top else (found.least, found.most - 1, top, total - top)
            )
        rows, nth, total = rows.where((place >= low) & (place <= high)), nth - above, inside
    return rows, nth, False


def cutoff(rows: DataFrame, nth: int, total: int, sort_rows: int = SORT_ROWS) -> tuple[int, int, int]:
    """``score``, ``place`` (of the id) and ``row`` of the ``nth`` row by score from above, then place, then row from below."""
    rows, nth, tied = _bracket(rows, "score", nth, total, sort_rows)
    for column in ("place", "row"):
        if tied:
            # Among equal rows the smallest come first; the complement turns the order without an overflow.
            turned = rows.withColumn("turned", F.bitwise_not(column))
            rows, nth, tied = _bracket(turned, "turned", nth, turned.count(), sort_rows)
            rows = rows.drop("turned")
    last = rows.orderBy(F.desc("score"), "place", "row").offset(nth - 1).limit(1).first()
    return last.score, last.place, last.row


def ranked(rows: DataFrame, order: list[Column], parts: int) -> DataFrame:
    """``rows`` with ``rank``, 1 and up in ``order``, from ranges that each fit a task."""
    ranges = stored(rows.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()))
    # One row for each range.
    sizes = sorted((r["range"], r["count"]) for r in ranges.groupBy("range").count().collect())
    before = np.concatenate([[0], np.cumsum([n for _, n in sizes])]).tolist()
    offsets = ranges.sparkSession.createDataFrame(
        [(r, b) for (r, _), b in zip(sizes, before, strict=False)], "range int, before long"
    )
    within = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    return (
        ranges.withColumn("within", within)
        .join(F.broadcast(offsets), "range")
        .withColumn("rank", F.col("before") + F.col("within"))
        .drop("range", "within", "before")
    )


def resample(
    docs: DataFrame, target: DataFrame, *, id_column: str = "doc_id", text: str = "text", target_text: str = "text",
    run: int = RUN, buckets: int = BUCKETS, seed: int = SEED, least_words: int = 20, percent: int = 10,
    sort_rows: int = SORT_ROWS,
) -> DataFrame:
    """Every document's id, ``n_features``, ``weight``, ``score`` and ``rank``, null where it is not drawn.

    ``percent`` of the documents with ``least_words`` words or more are drawn.
    """
    spark = docs.sparkSession
    gain = gains(bucket_counts(docs, text, run, buckets), bucket_counts(target, target_text, run, buckets))
    made = scored(docs, gain, id_column=id_column, text=text, run=run, seed=seed)
    # Ids of any type in an order of their own: numbers as they are, others by their hash; null comes last.
    number = made.schema["id"].dataType.typeName() in ("byte", "short", "integer", "long")
    place = F.col("id").cast("long") if number else F.xxhash64("id")
    rows = stored(
        made.withColumn("place", F.coalesce(place, F.lit(2**63 - 1))).withColumn("row", F.monotonically_increasing_id())
    )
    able = rows.where(F.col("n_words") >= least_words)
    total = able.count()
    wanted = percent * total // 100
    columns = [F.col("id").alias(id_column), "n_features", "weight", "score"]
    if not wanted:
        return rows.select(*columns, F.lit(None).cast("long").alias("rank"))
    score, at, row = cutoff(able.select("score", "place", "row"), wanted, total, sort_rows)
    same = F.col("score") == score
    drawn = (F.col("score") > score) | (same & ((F.col("place") < at) | ((F.col("place") == at) & (F.col("row") <= row))))
    drawn = drawn & (F.col("n_words") >= least_words)
    order = [F.desc("score"), F.col("place"), F.col("row")]
    best = ranked(rows.where(drawn), order, int(spark.conf.get("spark.sql.shuffle.partitions")))
    others = rows.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return best.unionByName(others).select(*columns, F.col("rank").cast("long").alias("rank"))
