"""Phrase mining by vertical partitioning of a suffix tree of words.

The corpus is a string of words, cut where a piece of a text ends; words of
one language only are compared. Of its suffix tree only the upper levels are
needed, as many as the longest phrase has words. Subtrees are built on their
own: the tree is cut below prefixes of words so that what hangs below one
prefix fits a memory budget. A prefix that is too frequent is extended by one
word, again and again, after a count of its extensions alone; the others are
put into groups of about the budget. One pass over the texts then writes the
truncated suffixes, equal ones combined, to the groups of their prefixes. A
group sorts its suffixes, which makes them the leaves of its subtrees in
order; a phrase is a node, and its frequency the total of the leaves below.
Prefixes that were extended lie above several subtrees; their totals are added
up at the end.

Words rarer than ``min_count`` end a suffix, as no phrase with them counts.
Words are numbers: the most frequent ``DICTIONARY`` (language, word) pairs by
their place in a list that every task gets, all others by a 63-bit hash. Two
words with one hash would be seen when words are counted; then another hash
is taken. So all counts are exact.

A phrase is scored by its weakest cut, floor(2,000,000 a / (l + r)) with the
frequencies of the phrase and of its two parts, and dropped where a longer
phrase around it has four fifths of its occurrences.

Defined cases: null and empty text has no words; a null language is ``und``;
repeated rows count each; a null id does not matter, ids are not read; a very
long text is read whole; languages without a phrase have no rows; equal
scores and frequencies are ranked by the bytes of the phrase; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.llm import words as W
from tidemark.llm.common import importable, slices, stored, texts_of

LONGEST = 4
MIN_COUNT, CONTAINED_PERCENT, TOP = 30, 80, 2000
# Leaves of a group that fit a task's memory (40 bytes each, a few copies of them), and the most prefixes that are told
# to every task; only beyond the product of both does the budget grow with the data.
BUDGET, MOST_PREFIXES = 1 << 18, 50_000
# Groups that smaller inputs are dealt to, so that all tasks have some and the cut is alike at every size.
GROUPS, LEAST_BUDGET = 512, 1 << 12
# Words with a short number, 8 bytes each in every task.
DICTIONARY = 1 << 18
# Distinct words, and suffixes, that a task collects before it writes them; equal suffixes are combined.
COUNTED = 1 << 18
COLLECTED = 1 << 18

# Bytes of words, and bytes at which a piece ends.
_WORD_BYTES = np.ones(256, dtype=bool)
_WORD_BYTES[list(b" \t.,;:!?\n\x0b\x0c\r")] = False
_PIECE_END = np.zeros(256, dtype=bool)
_PIECE_END[list(b".,;:!?\n\x0b\x0c\r")] = True

_COLUMNS = [f"w{i}" for i in range(1, LONGEST + 1)]
_COUNTED = StructType(
    [
        StructField("hash", LongType()), StructField("lang", StringType()), StructField("word", StringType()),
        StructField("n", LongType()),
    ]
)
_LEAVES = StructType([StructField("part", IntegerType()), StructField("leaves", BinaryType())])
_NODES = StructType([*(StructField(c, LongType()) for c in _COLUMNS), StructField("f", LongType())])


def _hashes(words: W.Words, langs: list[bytes], seed: int) -> np.ndarray:
    """63-bit hash of every word with its language."""
    of = {x: int.from_bytes(hashlib.blake2b(x, digest_size=8, salt=bytes([seed])).digest()) for x in set(langs)}
    lang = np.array([of[x] for x in langs], dtype=np.uint64)
    plain = W.span_hashes(W._BYTE[words.data], words.starts, words.ends, W._BASE + 2 * seed)
    return W.mix(plain ^ lang[words.owner()]) >> np.uint64(1)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[W.Words, list[bytes]]]:
    """Words of blocks of texts, with the language of each text."""
    for batch in slices(batches):
        langs = texts_of(batch, "lang")
        for at, texts in W.blocks(texts_of(batch, "text")):
            yield W.Words(texts, _WORD_BYTES, lower=True), langs[at : at + len(texts)]


def _named(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))


def word_counts(docs: DataFrame, seed: int = 0) -> DataFrame:
    """``hash``, ``lang``, ``word``, ``n``: parts of the counts of every word; and of each language, without a hash."""
    importable(docs.sparkSession)

    def told(counts: dict[int, list]) -> pa.RecordBatch:
        columns = [pa.array(counts, pa.int64())]
        columns += [pa.array([c[i] for c in counts.values()], t) for i, t in ((1, pa.string()), (2, pa.string()), (0, pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=_COUNTED.names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, list] = {}  # by hash: count, language, word
        totals: Counter[bytes] = Counter()
        for words, langs in _read(batches):
            found, first, n = np.unique(_hashes(words, langs, seed), return_index=True, return_counts=True)
            found, n, data = found.tolist(), n.tolist(), words.data.tobytes()
            new = []
            for i, h in enumerate(found):
                if h in counts:
                    counts[h][0] += n[i]
                else:
                    new.append(i)
            at = first[new]
            owner = np.searchsorted(words.first, at, side="right") - 1
            for i, text, a, b in zip(new, owner.tolist(), words.starts[at].tolist(), words.ends[at].tolist(), strict=True):
                counts[found[i]] = [n[i], langs[text].decode(), data[a:b].decode()]
            for name, size in zip(langs, words.counts.tolist(), strict=True):
                totals[name] += size
            if len(counts) >= COUNTED:
                yield told(counts)
                counts = {}
        yield told(counts)
        none = pa.nulls(len(totals))
        yield pa.RecordBatch.from_arrays(
            [none.cast(pa.int64()), pa.array([x.decode() for x in totals], pa.string()), none.cast(pa.string()),
             pa.array(totals.values(), pa.int64())],
            names=_COUNTED.names,
        )

    return docs.mapInArrow(count, _COUNTED)


@dataclass(frozen=True)
class Vocabulary:
    """Frequent words: ``words`` (id, lang, word, f), ``totals`` (lang, n), the listed hashes, whether all are listed."""

    words: DataFrame
    totals: DataFrame
    listed: np.ndarray
    complete: bool
    seed: int


def vocabulary(docs: DataFrame, min_count: int, dictionary: int) -> Vocabulary:
    for seed in range(8):
        per_word = word_counts(docs, seed).groupBy("hash", F.when(F.col("hash").isNull(), F.col("lang")).alias("of"))
        name = F.struct("lang", "word")
        counted = stored(
            per_word.agg(F.sum("n").alias("f"), F.min(name).alias("name"), F.max(name).alias("last"))
            .where(F.col("hash").isNull() | (F.col("f") >= min_count))
        )
        frequent = counted.where("hash IS NOT NULL")
        if frequent.where("name <> last").isEmpty():
            break
    else:
        raise RuntimeError("words with equal hashes under every seed")
    totals = counted.where("hash IS NULL").select(F.col("of").alias("lang"), F.col("f").alias("n"))
    most = frequent.orderBy(F.desc("f"), "hash").limit(dictionary).select("hash").toArrow()
    listed = np.sort(most.column("hash").to_numpy().astype(np.uint64))
    complete = len(listed) < dictionary or frequent.count() <= dictionary
    spark = docs.sparkSession
    codes = spark.createDataFrame(
        pa.table({"hash": pa.array(listed.astype(np.int64)), "code": pa.array(np.arange(1, len(listed) + 1), pa.int64())})
    )
    words = frequent.join(F.broadcast(codes), "hash", "left").select(
        F.coalesce("code", F.expr("-1 - hash")).alias("id"), "name.lang", "name.word", "f"
    )
    return Vocabulary(stored(words), totals, listed, complete, seed)


class Suffixes:
    """Turns blocks of texts into truncated suffixes of word numbers; 0 stands where a suffix has ended."""

    def __init__(self, listed: np.ndarray, complete: bool, seed: int, depth: int):
        self.listed, self.complete, self.seed, self.depth = listed, complete, seed, depth

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Place in the list from 1, a negative number for other words, 0 for words that are known to be rare."""
        others = np.zeros(len(hashes), np.int64) if self.complete else -1 - hashes.astype(np.int64)
        if not len(self.listed):
            return others
        at = np.minimum(np.searchsorted(self.listed, hashes), len(self.listed) - 1)
        return np.where(self.listed[at] == hashes, at + 1, others)

    def of(self, words: W.Words, langs: list[bytes]) -> np.ndarray:
        """A row for every suffix of two words or more."""
        if len(words) < 2:
            return np.zeros((0, self.depth), np.int64)
        ids = self.ids(_hashes(words, langs, self.seed))
        ends = np.concatenate([[0], np.cumsum(_PIECE_END[words.data])])
        # Texts are joined by a line feed, which ends a piece.
        linked = np.append(ends[words.starts[1:]] == ends[words.ends[:-1]], False)
        rows = np.zeros((len(ids), self.depth), np.int64)
        rows[:, 0] = ids
        open_ = ids != 0
        for step in range(1, self.depth):
            n = len(ids) - step
            if n <= 0:
                break
            open_ = open_[:n] & linked[step - 1 : step - 1 + n] & (ids[step:] != 0)
            rows[:n, step] = np.where(open_, ids[step:], 0)
        return rows[rows[:, 1] != 0]


def combined(rows: np.ndarray, counts: np.ndarray, first: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Sorted distinct rows and the sums of their counts; sorted by ``first`` before all else, if given."""
    keys = [rows[:, i] for i in range(rows.shape[1] - 1, -1, -1)] + ([] if first is None else [first])
    order = np.lexsort(keys)
    rows, counts = rows[order], counts[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    at = np.flatnonzero(new)
    sums = np.add.reduceat(counts, at) if len(at) else counts
    return (rows[at], sums) if first is None else (rows[at], sums, first[order][at])


def _row_hashes(rows: np.ndarray, salt: int) -> np.ndarray:
    h = np.full(len(rows), salt, dtype=np.uint64)
    for i in range(rows.shape[1]):
        h = W.mix(h * W._STEP + rows[:, i].view(np.uint64))
    return h


class Prefixes:
    """A set of rows, found by a hash that tells them all apart."""

    def __init__(self, rows: np.ndarray):
        self.salt = 1
        while len(np.unique(_row_hashes(rows, self.salt))) < len(rows):
            self.salt += 1
        hashes = _row_hashes(rows, self.salt)
        order = np.argsort(hashes)
        self.rows, self.hashes = rows[order], hashes[order]

    def hold(self, rows: np.ndarray) -> np.ndarray:
        """Which of ``rows`` are in the set."""
        at = np.minimum(np.searchsorted(self.hashes, _row_hashes(rows, self.salt)), len(self.rows) - 1)
        return (self.rows[at] == rows).all(axis=1)


@dataclass(frozen=True)
class Cut:
    """Where the tree is cut: the prefixes of 1, 2, ... words that are extended, and the number of groups."""

    extended: tuple[Prefixes, ...]
    parts: int

    def depth(self, rows: np.ndarray) -> np.ndarray:
        """Words of the prefix that each suffix hangs below."""
        depth = np.ones(len(rows), np.int64)
        at = np.arange(len(rows))
        for size, known in enumerate(self.extended, 1):
            at = at[known.hold(rows[at, :size])]
            depth[at] = size + 1
        return depth

    def part(self, rows: np.ndarray) -> np.ndarray:
        depth = self.depth(rows)
        h = np.zeros(len(rows), np.uint64)
        for i in range(rows.shape[1]):
            h = np.where(depth > i, W.mix(h * W._STEP + rows[:, i].view(np.uint64)), h)
        return (h % np.uint64(self.parts)).astype(np.int64)


def _collected(
    batches: Iterator[pa.RecordBatch], suffixes: Suffixes, size: int = COLLECTED
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes and their counts (ones), ``size`` or more at a time."""
    kept, n = [], 0
    for words, langs in _read(batches):
        kept.append(suffixes.of(words, langs))
        n += len(kept[-1])
        if n >= size:
            yield np.concatenate(kept), np.ones(n, np.int64)
            kept, n = [], 0
    if n:
        yield np.concatenate(kept), np.ones(n, np.int64)


def cut_tree(docs: DataFrame, vocab: Vocabulary, depth: int, budget: int, most_prefixes: int = MOST_PREFIXES) -> Cut:
    """Prefixes with more suffixes than the budget are extended by a word until none is left or ``depth`` is reached.

    At most ``most_prefixes`` of one length can have more than the budget, as
    that is at least this part of all suffixes; so they fit every task.
    """
    total = vocab.words.agg(F.sum("f").alias("n")).first().n or 0
    budget = max(min(budget, max(total // GROUPS, LEAST_BUDGET)), total // most_prefixes)
    extended: list[Prefixes] = []
    # One word: from the counts of words. Longer ones: their suffixes are counted, of too frequent prefixes alone.
    table = vocab.words.where(F.col("f") > budget).select("id").toArrow()
    found = table.column("id").to_numpy()[:, None].astype(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((vocab.listed, vocab.complete, vocab.seed))
    while len(found) and len(extended) < depth - 1:
        extended.append(Prefixes(found))
        size = len(extended) + 1
        if size == depth:
            break
        schema = StructType([*_NODES.fields[:size], StructField("f", LongType())])

        def count(batches, known=extended[-1], size=size):
            suffixes = Suffixes(*shared.value, size)
            for rows, ones in _collected(batches, suffixes):
                own = known.hold(rows[:, : size - 1]) & (rows[:, size - 1] != 0)
                rows, n = combined(rows[own], ones[own])
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(rows[:, i]) for i in range(size)), pa.array(n)], names=[*_COLUMNS[:size], "f"]
                )

        longer = docs.mapInArrow(count, schema).groupBy(*_COLUMNS[:size]).agg(F.sum("f").alias("f"))
        table = longer.where(F.col("f") > budget).drop("f").toArrow()
        found = np.stack([c.to_numpy() for c in table.columns], axis=1).astype(np.int64).reshape(-1, size)
    return Cut(tuple(extended), max(1, -(-total // budget)))


def _packed(rows: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted leaves column by column, which presses them well."""
    wide = bool(len(rows)) and (rows.min() < 0 or rows.max() >= 1 << 31 or counts.max() >= 1 << 31)
    kind = np.int64 if wide else np.int32
    body = np.concatenate([rows.T.ravel(), counts]).astype(kind)
    # Bytes of one weight together: most high ones are zero.
    return bytes([int(wide)]) + zlib.compress(body.view(np.uint8).reshape(len(body), -1).T.tobytes(), 1)


def _unpacked(data: bytes, depth: int) -> tuple[np.ndarray, np.ndarray]:
    kind = np.dtype(np.int64 if data[0] else np.int32)
    raw = np.frombuffer(zlib.decompress(data[1:]), np.uint8).reshape(kind.itemsize, -1).T
    body = np.ascontiguousarray(raw).view(kind).ravel().astype(np.int64).reshape(depth + 1, -1)
    return body[:depth].T, body[depth]


def leaves(docs: DataFrame, vocab: Vocabulary, cut: Cut, depth: int) -> DataFrame:
    """``part`` and packed ``leaves``: the truncated suffixes of the texts, for the groups of their prefixes."""
    importable(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((vocab.listed, vocab.complete, vocab.seed, cut))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *known, own = shared.value
        for rows, ones in _collected(batches, Suffixes(*known, depth)):
            rows, n = combined(rows, ones)
            part = own.part(rows)
            order = np.argsort(part, kind="stable")
            rows, n, part = rows[order], n[order], part[order]
            edges = np.flatnonzero(np.diff(part, prepend=-1, append=cut.parts))
            for a in range(0, len(edges) - 1, 256):
                spans = list(zip(edges[a : a + 256], edges[a + 1 : a + 257], strict=False))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part[[s for s, _ in spans]].astype(np.int32)),
                        pa.array([_packed(rows[s:e], n[s:e]) for s, e in spans], pa.binary()),
                    ],
                    names=_LEAVES.names,
                )

    return docs.mapInArrow(emit, _LEAVES)


def subtree_nodes(rows: np.ndarray, counts: np.ndarray, cut: Cut, min_count: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of two words or more in the subtrees of one group, with the totals of their leaves.

    Nodes above the cut are parts of what is known of them elsewhere and stay
    whatever their totals.
    """
    rows, counts = combined(rows, counts)
    above = cut.depth(rows) if len(rows) else np.zeros(0, np.int64)
    found, totals = [], []
    new = np.zeros(len(rows), dtype=bool)
    new[:1] = True
    for depth in range(1, rows.shape[1] + 1):
        # Leaves are sorted: a node is a run of leaves that agree in its words.
        new[1:] |= rows[1:, depth - 1] != rows[:-1, depth - 1]
        if depth == 1 or not len(rows):
            continue
        at = np.flatnonzero(new)
        total = np.add.reduceat(counts, at)
        keep = (rows[at, depth - 1] != 0) & ((total >= min_count) | (above[at] > depth))
        node = rows[at[keep]].copy()
        node[:, depth:] = 0
        found.append(node)
        totals.append(total[keep])
    if not found:
        return rows[:0], counts[:0]
    return np.concatenate(found), np.concatenate(totals)


def nodes(packed: DataFrame, vocab: Vocabulary, cut: Cut, depth: int, min_count: int) -> DataFrame:
    """``w1`` to ``w4`` (0 behind the end) and ``f`` of every phrase of two words or more with ``min_count`` occurrences."""
    shared = packed.sparkSession.sparkContext.broadcast(cut)
    names = _COLUMNS[:depth]
    schema = StructType([*_NODES.fields[:depth], StructField("f", LongType())])

    def build(table: pa.Table) -> pa.Table:
        parts = [_unpacked(x, depth) for x in table.column("leaves").to_pylist()]
        rows, totals = subtree_nodes(
            np.concatenate([r for r, _ in parts]), np.concatenate([n for _, n in parts]), shared.value, min_count
        )
        return pa.table([*(pa.array(rows[:, i]) for i in range(depth)), pa.array(totals)], names=[*names, "f"])

    found = packed.groupBy("part").applyInArrow(build, schema)
    return found.groupBy(*names).agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)


def _word_ids(words: Column, first: int | Column, size: int | Column) -> Column:
    """``size`` words from place ``first`` (from 0), filled up with zeros; a key of equal form for all lengths."""
    zeros = F.array_repeat(F.lit(0).cast("long"), LONGEST)
    return F.slice(F.concat(F.slice(words, F.lit(first) + 1, F.lit(size)), zeros), 1, LONGEST)


def scored(found: DataFrame, vocab: Vocabulary, contained_percent: int = CONTAINED_PERCENT) -> DataFrame:
    """``words`` (ids), ``a``, ``l``, ``r``, ``score`` of the phrases that no longer one contains too often.

    The cut with the lowest score counts, the shorter first part on a tie.
    """
    depth = len(found.columns) - 1
    words = F.filter(F.array(*_COLUMNS[:depth]), lambda w: w != 0)
    own = found.select(words.alias("words"), F.col("f").alias("a"))
    own = stored(own.withColumn("size", F.size("words")))
    single = vocab.words.select(F.array("id").alias("words"), F.col("f").alias("a"))
    known = own.select("words", "a").union(single).select(_word_ids(F.col("words"), 0, LONGEST).alias("key"), F.col("a").alias("f"))
    cuts = own.select("words", "a", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "words", "a", "k", _word_ids(F.col("words"), 0, F.col("k")).alias("left"),
        _word_ids(F.col("words"), F.col("k"), F.col("size") - F.col("k")).alias("right"),
    )
    one = cuts.join(known.select(F.col("key").alias("left"), F.col("f").alias("l")), "left")
    both = one.join(known.select(F.col("key").alias("right"), F.col("f").alias("r")), "right")
    # Decimals of 38 digits: the product may pass 64 bits.
    score = F.expr("cast(cast(2000000 AS decimal(10,0)) * cast(a AS decimal(20,0)) div cast(l + r AS decimal(20,0)) AS bigint)")
    worst = both.withColumn("score", score).groupBy("words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = F.expr(
        "flatten(transform(sequence(2, size - 1), n -> transform(sequence(0, size - n), i -> slice(words, i + 1, n))))"
    )
    around = (
        own.where("size > 2").select("a", F.explode(inner).alias("words")).groupBy("words").agg(F.max("a").alias("longer"))
    )
    return (
        worst.join(around, "words", "left")
        .where(F.col("longer").isNull() | (100 * F.col("longer") < contained_percent * F.col("a")))
        .select("words", "a", "cut.l", "cut.r", "cut.score")
    )


def mine(
    docs: DataFrame, *, lang: str = "lang", text: str = "text", longest: int = LONGEST, min_count: int = MIN_COUNT,
    contained_percent: int = CONTAINED_PERCENT, budget: int = BUDGET, dictionary: int = DICTIONARY,
) -> DataFrame:
    """``lang``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` of every phrase that stays."""
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases have 2 to {LONGEST} words")
    own = _named(docs, lang, text)
    vocab = vocabulary(own, min_count, dictionary)
    cut = cut_tree(own, vocab, longest, budget)
    kept = scored(nodes(leaves(own, vocab, cut, longest), vocab, cut, longest, min_count), vocab, contained_percent)
    names = vocab.words.select("id", "lang", "word")
    told = (
        kept.select("*", F.posexplode("words").alias("at", "id"))
        .join(names, "id")
        .groupBy("words", "a", "l", "r", "score")
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelled"), F.first("lang").alias("lang"))
        .withColumn("phrase", F.array_join(F.transform("spelled", lambda s: s["word"]), " "))
    )
    return told.join(vocab.totals, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def top(found: DataFrame, count: int = TOP) -> DataFrame:
    """The first ``count`` phrases of each language by score, frequency and bytes, with their ``rank``."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
