"""Near-duplicate classes by MinHash with tensored banding.

Two collections of ``tables`` half keys are made from ``2 * tables * rows``
minhashes of the word shingles. A table key is a pair of one half key from
each, so ``tables ** 2`` tables need minhashes for ``2 * tables`` only. Texts
with equal shingle sets are one class from the start. A class forms pairs only
from half keys that another class has too.

Candidates are the classes that share a table key. Keys of few classes give
their pairs. Keys of many classes give no pairs but a star around the class
that is in most of such keys; the rest is found exactly: members that are not
connected yet must share one of the rarest shingles of each (prefix and
position bounds of the similarity), and are joined on those. Every candidate
is first bounded by a bitmap of its shingles, which can't reject a link, and
links are confirmed on the full sets.

At a similarity of exactly 0.75, two classes share no table key with
probability 2 * (1 - 0.75 ** rows) ** tables, 0.3 % with the defaults; at 0.85
it is 0.002 %.

Defined cases: null, empty and white text has no shingles, is linked with
nothing and keeps itself; fewer words than a shingle are one shingle; repeated
rows are copies with one id and get equal results; rows with one id and
different texts are different texts; a null id is never the smallest unless
its whole component has none; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tidemark.llm import words as W
from tidemark.llm.common import rows_from_blocks, stored, texts_of, with_block_columns
from tidemark.llm.components import components

SHINGLE = 5
TABLES, ROWS = 8, 2
# A table key of more classes than this goes the way of stars and rarest shingles.
FEW = 16
BITS = 4096
# 64-bit numbers that the bitmap is folded to where it goes with every shingle.
FOLDED = 8
# Rarer shingles of a member that go with each, so that a pair is not made once more at every shingle it shares.
BEFORE = 16
# Buckets in which shingles are counted, to put them in order.
BUCKETS = 2**20

_RNG = np.random.default_rng(8)
_XOR = _RNG.integers(0, 2**63, 1024, dtype=np.uint64)
_TIMES = _RNG.integers(0, 2**63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _shingles(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Owner and hash of the distinct shingles of each text, by owner."""
    words = W.Words(texts, W.NOT_SPACE, lower=True)
    hashes = words.hashes()
    at, grams = words.gram_hashes(hashes, size)
    owner = words.owner()[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        whole = W.span_hashes(hashes, words.first[short], words.first[short + 1])
        owner, grams = np.concatenate([owner, short]), np.concatenate([grams, whole])
        order = np.argsort(owner, kind="stable")
        owner, grams = owner[order], grams[order]
    seed = W.mix(np.arange(1, len(texts) + 1, dtype=np.uint64))
    _, once = np.unique(grams + seed[owner], return_index=True)
    once.sort()
    return owner[once], grams[once]


def _signatures(texts: list[bytes], size: int, tables: int, rows: int) -> dict[str, np.ndarray]:
    owner, grams = _shingles(texts, size)
    counts = np.bincount(owner, minlength=len(texts))
    full = np.flatnonzero(counts)
    starts = np.searchsorted(owner, full)
    ids = np.zeros((2, len(texts)), dtype=np.uint64)
    halves = np.zeros((len(texts), 2 * tables), dtype=np.uint64)
    if len(full):
        for i in range(2):
            ids[i, full] = W.mix(np.add.reduceat(W.mix(grams ^ _XOR[-1 - i]), starts))
        for half in range(2 * tables):
            key = np.full(len(full), half, dtype=np.uint64)
            for row in range(rows):
                k = half * rows + row
                least = np.minimum.reduceat((grams ^ _XOR[k]) * _TIMES[k], starts)
                key = W.mix(key * W._STEP + least)
            halves[full, half] = key
    return {"n": counts, "class": ids[0] ^ ids[1], "halves": halves}


def signatures(docs: DataFrame, size: int, tables: int, rows: int) -> DataFrame:
    """``docs`` (id, text) without the text but with ``n``, ``class``, ``content`` and ``halves``."""
    fields = [
        StructField("n", LongType()), StructField("class", LongType()), StructField("halves", ArrayType(LongType()))
    ]

    def start():
        def block(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            made = [_signatures(t, size, tables, rows) for _, t in W.blocks(texts_of(batch, "text"))]
            none = np.empty(0, dtype=np.int64)
            join = lambda name: np.concatenate([none, *(m[name].ravel().view(np.int64) for m in made)])
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * 2 * tables
            return {
                "n": pa.array(join("n")),
                "class": pa.array(join("class")),
                "halves": pa.ListArray.from_arrays(pa.array(offsets), pa.array(join("halves"))),
            }

        return block

    return with_block_columns(docs.withColumn("content", F.xxhash64("text")), fields, start, without=("text",))


SETS = StructType(
    [
        StructField("class", LongType()),
        StructField("n", LongType()),
        StructField("bits", ArrayType(LongType())),
        StructField("shingles", ArrayType(LongType())),
    ]
)


def shingle_sets(texts: DataFrame, size: int, tables: int, rows: int) -> DataFrame:
    """``class``, ``n``, bitmap and full shingle set of every row of ``texts`` (text)."""

    def start():
        def block(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            out: dict[str, list] = {n: [] for n in SETS.fieldNames()}
            for _, values in W.blocks(texts_of(batch, "text")):
                owner, grams = _shingles(values, size)
                signed = _signatures(values, size, 0, 0)
                bounds = np.searchsorted(owner, np.arange(len(values) + 1))
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    bits = np.zeros(BITS, dtype=np.uint8)
                    bits[grams[a:b] % np.uint64(BITS)] = 1
                    out["bits"].append(np.packbits(bits, bitorder="little").view(np.int64))
                    out["shingles"].append(grams[a:b].view(np.int64))
                out["n"] += signed["n"].tolist()
                out["class"] += signed["class"].view(np.int64).tolist()
            longs = pa.list_(pa.int64())
            return {
                "class": pa.array(out["class"], pa.int64()),
                "n": pa.array(out["n"], pa.int64()),
                "bits": pa.array(out["bits"], longs),
                "shingles": pa.array(out["shingles"], longs),
            }

        return block

    return rows_from_blocks(texts, SETS, start)


def _similar(common: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    return 100 * common >= percent * (n_a + n_b - common)


def _near_sizes(n_a: Column, n_b: Column, percent: int) -> Column:
    return 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)


def _only_in_first(a: Column, b: Column) -> Column:
    """Bits of ``a`` that ``b`` lacks: as many shingles at least are in the first set alone."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y)))),
        F.lit(0),
        lambda total, x: total + x,
    )


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) whose full sets are similar enough."""
    small = sets.select("class", "n", "bits")
    first = small.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    second = small.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    possible = F.least(
        F.col("n_a") - _only_in_first(F.col("bits_a"), F.col("bits_b")),
        F.col("n_b") - _only_in_first(F.col("bits_b"), F.col("bits_a")),
    )
    bounded = (
        pairs.join(first, "a")
        .join(second, "b")
        .where(_near_sizes(F.col("n_a"), F.col("n_b"), percent))
        .where(_similar(possible, F.col("n_a"), F.col("n_b"), percent))
        .select("a", "b", "n_a", "n_b")
    )
    first = sets.select(F.col("class").alias("a"), F.col("shingles").alias("set_a"))
    second = sets.select(F.col("class").alias("b"), F.col("shingles").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    return (
        bounded.join(first, "a")
        .join(second, "b")
        .where(_similar(common, F.col("n_a"), F.col("n_b"), percent))
        .select("a", "b")
    )


def _table_keys(classes: DataFrame, tables: int) -> DataFrame:
    """``class`` and ``key`` for every table key that two classes or more have."""
    halves = classes.select("class", F.posexplode("halves").alias("at", "half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("size")).where("size > 1").select("half")
    own = (
        halves.join(shared, "half")
        .groupBy("class")
        .agg(
            F.collect_list(F.when(F.col("at") < tables, F.col("half"))).alias("left"),
            F.collect_list(F.when(F.col("at") >= tables, F.col("half"))).alias("right"),
        )
    )
    keys = own.select("class", "right", F.explode("left").alias("l")).select(
        "class", F.col("l"), F.explode("right").alias("r")
    ).select("class", F.xxhash64("l", "r").alias("key"))
    sizes = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    return stored(keys.join(sizes, "key"))


def _pairs_of_few(keys: DataFrame, few: int) -> DataFrame:
    members = keys.where(F.col("size") <= few).groupBy("key").agg(F.sort_array(F.collect_list("class")).alias("own"))
    return (
        members.select("own", F.posexplode("own").alias("at", "a"))
        .select("a", F.explode(F.expr("slice(own, at + 2, size(own))")).alias("b"))
        .distinct()
    )


def _stars(large: DataFrame) -> DataFrame:
    """Each member of a large key with the key's hub: the member in most large keys."""
    counts = large.groupBy("class").agg(F.count("*").alias("times"))
    ranked = large.join(counts, "class")
    hubs = ranked.groupBy("key").agg(F.max(F.struct("times", "class")).alias("hub"))
    return (
        large.join(hubs, "key")
        .select(F.least("class", "hub.class").alias("a"), F.greatest("class", "hub.class").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _unsettled(large: DataFrame, labels: DataFrame) -> DataFrame:
    """Classes of the ``large`` keys whose members are in more than one component; the other keys have nothing to add."""
    own = large.join(labels.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class")
    )
    open_keys = own.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most")
    return large.join(open_keys.select("key"), "key").select("class").distinct()


COUNTS = StructType([StructField(name, LongType()) for name in ("bucket", "df", "least", "most")])
# Shingles that are counted at once, rounded up to whole members.
COUNTED = 1 << 20


def _bucket_counts(rows: DataFrame) -> DataFrame:
    """Per run of members: each bucket with its count of shingles, and the least and greatest component that has one."""

    def start():
        def block(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            lists = batch.column(batch.schema.get_field_index("shingles"))
            component = batch.column(batch.schema.get_field_index("component")).to_numpy()
            ends = np.cumsum(lists.value_lengths().to_numpy())
            run = (ends - 1) // COUNTED
            cuts = [0, *(np.flatnonzero(run[1:] != run[:-1]) + 1).tolist(), len(ends)]
            made: dict[str, list] = {name: [np.empty(0, dtype=np.int64)] for name in COUNTS.fieldNames()}
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                part = lists.slice(low, high - low)
                bucket = part.flatten().to_numpy() % BUCKETS
                if not len(bucket):
                    continue
                order = np.argsort(bucket, kind="stable")
                bucket = bucket[order]
                owner = np.repeat(component[low:high], part.value_lengths().to_numpy())[order]
                first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                made["bucket"].append(bucket[first])
                made["df"].append(np.diff(np.append(first, len(bucket))))
                made["least"].append(np.minimum.reduceat(owner, first))
                made["most"].append(np.maximum.reduceat(owner, first))
            return {name: pa.array(np.concatenate(made[name])) for name in made}

        return block

    return rows_from_blocks(rows.select("component", "shingles"), COUNTS, start)


def _shared_counts(rows: DataFrame) -> np.ndarray:
    """Per bucket of shingles the number of members that hold one; 0 where all of them are in one component.

    Always ``BUCKETS`` numbers, so what the driver gets doesn't grow with the input.
    """
    counts = (
        _bucket_counts(rows)
        .groupBy("bucket")
        .agg(F.sum("df").alias("df"), F.min("least").alias("least"), F.max("most").alias("most"))
        .where("least < most")
        .select("bucket", F.least("df", F.lit(2**32 - 1)).alias("df"))
        .toArrow()
    )
    found = np.zeros(BUCKETS, dtype=np.uint32)
    found[counts["bucket"].to_numpy()] = counts["df"].to_numpy()
    return found


PREFIX = StructType(
    [
        *(StructField(name, LongType()) for name in ("class", "n", "component", "rest", "shingle")),
        StructField("before", ArrayType(LongType())),
        *(StructField(f"b{k}", LongType()) for k in range(FOLDED)),
    ]
)


def _prefixes(rows: DataFrame, percent: int) -> DataFrame:
    """The first shingles of each member, as many as a similar member must share one of.

    Those in buckets of one component come first and are left out; the others go by the counts of
    their buckets, then by themselves. ``rest`` counts the shingles from this one on, ``before`` holds
    the few before it, and ``b0`` and so on are the bitmap folded.
    """
    counts = rows.sparkSession.sparkContext.broadcast(_shared_counts(rows))

    def start():
        df = counts.value

        def block(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            made: dict[str, list] = {name: [] for name in PREFIX.fieldNames()}
            columns = {name: batch.column(batch.schema.get_field_index(name)) for name in batch.schema.names}
            numbers = {name: columns[name].to_numpy() for name in ("class", "n", "component")}
            for row in range(batch.num_rows):
                shingles = columns["shingles"][row].values.to_numpy()
                often = df[shingles % BUCKETS]
                between = often > 0
                n, alone = len(shingles), int(len(shingles) - between.sum())
                take = n - (n * percent + 99) // 100 + 1 - alone
                if take <= 0:
                    continue
                shingles, often = shingles[between], often[between]
                own = shingles[np.lexsort((shingles, often))][:take]
                folded = np.bitwise_or.reduce(columns["bits"][row].values.to_numpy().reshape(-1, FOLDED))
                for name in numbers:
                    made[name].append(np.full(len(own), numbers[name][row]))
                made["rest"].append(n - alone - np.arange(len(own)))
                made["shingle"].append(own)
                made["before"] += [own[max(k - BEFORE, 0) : k] for k in range(len(own))]
                for k in range(FOLDED):
                    made[f"b{k}"].append(np.full(len(own), folded[k]))
            none = np.empty(0, dtype=np.int64)
            return {
                name: pa.array(made[name], pa.list_(pa.int64())) if name == "before" else pa.array(np.concatenate([none, *made[name]]))
                for name in made
            }

        return block

    return rows_from_blocks(rows, PREFIX, start)


def _rarest_shared(members: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of ``members`` of different components that their rarest shingles allow to be similar.

    With shingles in one order, two sets that are similar enough share a
    shingle among the first n - ceil(n * percent / 100) + 1 of each, and behind
    their first common shingle enough must remain in both. Members of different
    components share no shingle that stands in one component only. The order
    is by counts of buckets; any order gives the same pairs, a good one fewer
    comparisons.
    """
    # The bitmap is folded to a few numbers, which the join compares before it gives a pair out.
    words = [f"b{k}" for k in range(FOLDED)]
    rows = stored(
        members.join(sets.select("class", "n", "bits", "shingles"), "class")
        .join(labels.select(F.col("node").alias("class"), "component"), "class", "left")
        .select("class", "n", F.coalesce("component", "class").alias("component"), "bits", "shingles")
    )
    ordered = stored(_prefixes(rows, percent))
    left, right = ordered.alias("l"), ordered.alias("r")
    lacks = lambda one, other: sum(
        F.bit_count(F.col(f"{one}.{b}").bitwiseAND(F.bitwise_not(F.col(f"{other}.{b}")))) for b in words
    )
    possible = F.least(F.col("l.n") - lacks("l", "r"), F.col("r.n") - lacks("r", "l"))
    enough = lambda side: 100 * F.col(f"{side}.rest") >= percent * (
        F.col("l.n") + F.col("r.n") - F.col(f"{side}.rest")
    )
    return (
        left.join(
            right,
            (F.col("l.shingle") == F.col("r.shingle"))
            & (F.col("l.class") < F.col("r.class"))
            & (F.col("l.component") != F.col("r.component"))
            & enough("l")
            & enough("r")
            & ~F.arrays_overlap("l.before", "r.before")
            & _similar(possible, F.col("l.n"), F.col("r.n"), percent),
        )
        .select(F.col("l.class").alias("a"), F.col("r.class").alias("b"))
        .distinct()
    )


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` with the components joined that ``links`` (a, b) connect; only those make a graph."""
    of = lambda node: labels.select(F.col("node").alias(node), F.col("component").alias(f"{node}_in"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        "a", "b", F.coalesce("a_in", "a").alias("a_in"), F.coalesce("b_in", "b").alias("b_in")
    )
    joined = components(between.select(F.col("a_in").alias("a"), F.col("b_in").alias("b")))
    # Ends of links that had no label are their own components so far.
    nodes = labels.union(links.select("a", "a")).union(links.select("b", "b")).groupBy("node").agg(F.min("component").alias("component"))
    step = joined.select(F.col("node").alias("component"), F.col("component").alias("whole"))
    return stored(nodes.join(step, "component", "left").select("node", F.coalesce("whole", "component").alias("component")))


def near_duplicates(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    percent: int = 75,
    tables: int = TABLES,
    rows: int = ROWS,
    few: int = FEW,
    with_content: bool = False,
) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` and ``kept``.

    ``with_content`` adds ``content``, the xxhash64 of the text, and ``component``, a number of
    the component that no id has a part in (null without shingles).
    """
    own = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    signed = stored(signatures(own, size, tables, rows))
    classes = stored(
        signed.where("n > 0")
        .groupBy("class")
        .agg(
            F.min("id").alias("smallest"), F.first("n").alias("n"), F.first("halves").alias("halves"),
            F.min(F.struct("content", "id")).alias("one"),
        )
        .select("class", "smallest", "n", "halves", "one.*")
    )
    keys = _table_keys(classes, tables)
    # One text of each class is enough.
    needed = keys.select("class").distinct().join(classes, "class").select("content", "id")
    texts = own.withColumn("content", F.xxhash64("text")).alias("t")
    texts = texts.join(
        needed.alias("c"),
        (F.col("t.content") == F.col("c.content")) & F.col("t.id").eqNullSafe(F.col("c.id")),
        "left_semi",
    )
    sets = stored(shingle_sets(texts.select("text"), size, tables, rows).dropDuplicates(["class"]))
    large = keys.where(F.col("size") > few).select("class", "key")
    links = stored(confirmed(_pairs_of_few(keys, few).unionByName(_stars(large)).distinct(), sets, percent))
    labels = components(links)
    if not large.isEmpty():
        rest = stored(confirmed(_rarest_shared(_unsettled(large, labels), sets, labels, percent), sets, percent))
        if not rest.isEmpty():
            labels = _merged(labels, rest)
    named = classes.select("class", "smallest").join(
        labels.select(F.col("node").alias("class"), "component"), "class", "left"
    ).select("class", "smallest", F.coalesce("component", "class").alias("component"))
    smallest = named.groupBy("component").agg(F.min("smallest").alias("component_id"))
    found = named.join(smallest, "component").select("class", "component_id", "component")
    return (
        signed.join(found, "class", "left")
        .select(
            F.col("id").alias(id_column),
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
            *(["content", "component"] if with_content else []),
        )
        .withColumn("kept", F.col(id_column).eqNullSafe(F.col("component_id")))
    )
