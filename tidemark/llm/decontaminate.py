"""Benchmark decontamination with one FM-index per training shard.

Test items are cut into windows of 13 words (a shorter item is one window).
Each task indexes its texts shard by shard: the runs of words that the items
use at all, a separator after each run, suffixes sorted by doubling, and the
Burrows-Wheeler string in a wavelet tree kept level by level. All windows are
searched backward together by ranks, occurrences are located by sampled suffix
positions, compared with the text, and merged into spans of words.

The items are a stated query set: they are read in blocks of at most
``block_words`` words, each block is broadcast, and every shard is searched
for one block after the other.

Defined cases: null or empty text has no words, no spans and no items; an item
without words has no window; an item without an id is found but not listed;
repeated rows get equal results; other columns stay, but those with names of
the results are replaced; empty tables give empty results or no spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tidemark.llm import words as W
from tidemark.llm.common import texts_of, with_block_columns

WINDOW = 13
BLOCK_WORDS = 1_000_000
SAMPLE = 8
SPANS = ArrayType(StructType([StructField("first", LongType()), StructField("end", LongType())]))


class WaveletTree:
    """Ranks of symbols in a sequence, one level per bit, zeros before ones at each level."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels: list[tuple[int, np.ndarray, int]] = []
        for bit in range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1):
            ones = (symbols >> bit) & 1 == 1
            zeros = np.zeros(len(symbols) + 1, dtype=np.int32)
            np.cumsum(~ones, out=zeros[1:])
            self.levels.append((bit, zeros, int(zeros[-1])))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often ``symbols[i]`` occurs before place ``ends[i]``."""
        begin = np.zeros(len(ends), dtype=np.int64)
        for bit, zeros, n_zeros in self.levels:
            one = (symbols >> bit) & 1 == 1
            begin_zeros, end_zeros = zeros[begin], zeros[ends]
            begin = np.where(one, n_zeros + begin - begin_zeros, begin_zeros)
            ends = np.where(one, n_zeros + ends - end_zeros, end_zeros)
        return ends - begin


def sorted_suffixes(text: np.ndarray) -> np.ndarray:
    """Places of all suffixes in order; separators (0) are ordered by place and end a suffix."""
    n = len(text)
    rank = text.astype(np.int64)
    separators = np.flatnonzero(text == 0)
    rank += len(separators)
    rank[separators] = np.arange(len(separators))
    _, rank = np.unique(rank, return_inverse=True)
    step = 1
    while True:
        later = np.zeros(n, dtype=np.int64)
        later[: max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 1) + later
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.empty(n, dtype=np.int64)
        new[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = new
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


class FMIndex:
    """Backward search over one shard of symbols 1 and up, with 0 between the runs."""

    def __init__(self, text: np.ndarray, n_symbols: int):
        order = sorted_suffixes(text)
        self.size = len(text)
        self.bwt = text[order - 1].astype(np.int64)
        self.tree = WaveletTree(self.bwt, n_symbols)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])
        # Run starts are sampled too, so a walk never has to pass a separator.
        sampled = (order % SAMPLE == 0) | (self.bwt == 0)
        self.samples = np.where(sampled, order, -1)

    def _back(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        return self.before[symbols] + self.tree.rank(symbols, places)

    def search(self, patterns: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The patterns that occur, each with its range of suffixes. Row i holds ``sizes[i]`` symbols, at its right end."""
        live = np.arange(len(patterns))
        low, high = np.zeros(len(live), dtype=np.int64), np.full(len(live), self.size, dtype=np.int64)
        width = patterns.shape[1]
        for step in range(1, width + 1):
            moving = sizes[live] >= step
            symbols = patterns[live, width - step]
            low = np.where(moving, self._back(np.where(moving, symbols, 0), low), low)
            high = np.where(moving, self._back(np.where(moving, symbols, 0), high), high)
            found = low < high
            live, low, high = live[found], low[found], high[found]
            if not len(live):
                break
        return live, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of the suffixes in ``rows``."""
        places = np.full(len(rows), -1, dtype=np.int64)
        open_, at, steps = np.arange(len(rows)), rows, 0
        while len(open_):
            known = self.samples[at] >= 0
            places[open_[known]] = self.samples[at[known]] + steps
            open_, at = open_[~known], at[~known]
            at = self._back(self.bwt[at], at)
            steps += 1
        return places


class Phrases:
    """The windows of a block of test items as symbols, with the items each stands in."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        words = W.Words([text for _, text in items], W.ALNUM, lower=True)
        hashes = words.hashes()
        self.vocabulary, symbols = np.unique(hashes, return_inverse=True)
        owners: dict[bytes, tuple[np.ndarray, set[str]]] = {}
        data = words.data.tobytes()
        for i, (name, _) in enumerate(items):
            first, end = int(words.first[i]), int(words.first[i + 1])
            for at in range(first, max(end - window, first) + 1 if end > first else first):
                stop = min(at + window, end)
                text = b" ".join(data[words.starts[j] : words.ends[j]] for j in range(at, stop))
                known = owners.setdefault(text, (symbols[at:stop] + 1, set()))
                if name is not None:
                    known[1].add(name)
        self.texts = list(owners)
        self.items = [sorted(x[1]) for x in owners.values()]
        self.sizes = np.array([len(x[0]) for x in owners.values()], dtype=np.int64)
        self.patterns = np.zeros((len(owners), int(self.sizes.max(initial=1))), dtype=np.int64)
        for row, (sequence, _) in zip(self.patterns, owners.values(), strict=True):
            row[len(row) - len(sequence) :] = sequence
        self.shortest = int(self.sizes.min(initial=1))

    def symbols_of(self, hashes: np.ndarray) -> np.ndarray:
        """1 and up for words of the items, 0 for others."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def occurrences(self, words: W.Words) -> tuple[np.ndarray, np.ndarray]:
        """Window number and first word of every occurrence in a shard's texts."""
        none = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        symbols = self.symbols_of(words.hashes())
        known = symbols > 0
        # A run ends where an unknown word or another text begins.
        cut = np.flatnonzero(np.concatenate([[True], known[1:] != known[:-1]])) if len(known) else none[0]
        cut = np.unique(np.concatenate([cut, words.first[:-1][words.counts > 0]]))
        ends = np.concatenate([cut[1:], [len(known)]])
        runs = known[cut] & (ends - cut >= self.shortest) if len(cut) else np.empty(0, dtype=bool)
        cut, sizes = cut[runs], (ends - cut)[runs]
        if not len(cut) or not len(self.patterns):
            return none
        # Each run with one separator behind it.
        begins = np.concatenate([[0], np.cumsum(sizes + 1)])
        origin = np.arange(begins[-1]) + np.repeat(cut - begins[:-1], sizes + 1)
        text = np.zeros(begins[-1], dtype=np.int64)
        inside = np.ones(begins[-1], dtype=bool)
        inside[begins[1:] - 1] = False
        text[inside] = symbols[origin[inside]]
        index = FMIndex(text, len(self.vocabulary) + 1)
        found, low, high = index.search(self.patterns, self.sizes)
        counts = high - low
        rows = np.arange(counts.sum()) + np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        return np.repeat(found, counts), origin[index.locate(rows)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that touch or overlap as one, in order."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((first, end))
    return out


def _search(phrases: Phrases, texts: list[bytes]) -> Iterator[tuple[int, list[tuple[int, int]], set[str], bytes]]:
    """Per text: words, merged spans, items, and the text without the spans."""
    words = W.Words(texts, W.ALNUM, lower=True)
    window, place = phrases.occurrences(words)
    owner = np.searchsorted(words.first, place, side="right") - 1
    data = words.data.tobytes() if len(window) else b""
    spans: dict[int, list[tuple[int, int]]] = {}
    items: dict[int, set[str]] = {}
    for w, at, i in zip(window.tolist(), place.tolist(), owner.tolist(), strict=True):
        end = at + int(phrases.sizes[w])
        text = b" ".join(data[a:b] for a, b in zip(words.starts[at:end], words.ends[at:end], strict=True))
        if text == phrases.texts[w]:  # equal words, not only equal hashes
            spans.setdefault(i, []).append((at, end))
            items.setdefault(i, set()).update(phrases.items[w])
    for i, (text, count) in enumerate(zip(texts, words.counts.tolist(), strict=True)):
        first, own = int(words.first[i]), merged(spans.get(i, []))
        left, at = [], 0
        for a, b in own:
            left.append(text[at : int(words.starts[a] - words.offsets[i])])
            at = int(words.ends[b - 1] - words.offsets[i])
        left.append(text[at:])
        yield count, [(a - first, b - first) for a, b in own], items.get(i, set()), b"".join(left)


def _item_blocks(items: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[list[tuple[str | None, bytes]]]:
    block: list[tuple[str | None, bytes]] = []
    size = 0
    for name, value in items.select(F.col(item_id).cast("string"), F.col(text)).toLocalIterator():
        if value:
            own = len(value) // 2 + 1  # at most so many words
            if block and size + own > block_words:
                yield block
                block, size = [], 0
            block.append((name, value.encode()))
            size += own
    if block:
        yield block


def mark(
    docs: DataFrame,
    items: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    keep_text: bool = True,
    text_left: bool = True,
) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (merged spans of words), ``hit_items`` (sorted ids) and ``text_left``.

    ``text_left``, the text without the spans, is made if asked for; the text
    itself is returned with ``keep_text``.
    """
    fields = [
        StructField("n_words", LongType()),
        StructField("hit_spans", SPANS),
        StructField("hit_items", ArrayType(StringType())),
    ]
    if text_left:
        fields.append(StructField("text_left", StringType()))
    context = docs.sparkSession.sparkContext
    parts = [context.broadcast(block) for block in _item_blocks(items, item_id, item_text, block_words)] or [
        context.broadcast([])
    ]

    def start():
        kept: dict[int, Phrases] = {}

        def phrases(number: int) -> Phrases:
            if number not in kept:
                kept.clear()  # one block at a time
                kept[number] = Phrases(parts[number].value, window)
            return kept[number]

        def block(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            values = texts_of(batch, text)
            counts = [0] * len(values)
            spans: list[list[tuple[int, int]]] = [[] for _ in values]
            names: list[set[str]] = [set() for _ in values]
            left = [b""] * len(values)
            for number in range(len(parts)):
                own = phrases(number)
                for at, texts in W.blocks(values):
                    for i, (n, s, found, rest) in enumerate(_search(own, texts), at):
                        counts[i] = n
                        spans[i] = merged(spans[i] + s) if spans[i] else s
                        names[i] |= found
                        left[i] = rest
            if len(parts) > 1:
                left = [_without(t, s) for t, s in zip(values, spans, strict=True)]
            made = {
                "n_words": pa.array(counts, pa.int64()),
                "hit_spans": pa.array(
                    [[{"first": a, "end": b} for a, b in s] for s in spans],
                    pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])),
                ),
                "hit_items": pa.array([sorted(x) for x in names], pa.list_(pa.string())),
            }
            if text_left:
                null = batch.column(batch.schema.get_field_index(text)).is_null().to_pylist()
                made["text_left"] = pa.array(
                    [None if no else x.decode() for x, no in zip(left, null, strict=True)], pa.string()
                )
            return made

        return block

    return with_block_columns(docs, fields, start, () if keep_text else (text,))


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    if not spans:
        return text
    words = W.Words([text], W.ALNUM, lower=True)
    left, at = [], 0
    for a, b in spans:
        left.append(text[at : int(words.starts[a])])
        at = int(words.ends[b - 1])
    return b"".join([*left, text[at:]])


def judged(marked: DataFrame) -> DataFrame:
    """``marked`` with ``n_hit`` and ``contaminated``: a twentieth or more of the words is hit."""
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["first"])
    return marked.withColumn("n_hit", hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )
