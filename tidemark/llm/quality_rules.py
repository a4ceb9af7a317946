"""Quality rules: repetition within a text, and lines that many documents of a host share.

``measure`` computes the statistics of each text in one pass. ``judge`` hashes
normalised lines (A-Z lower-cased, white space folded), counts the distinct
contents per host that hold each line, takes lines above the limit away and
rejects documents that keep too little. Copies of one content count once, so
copies alone don't make a line frequent.

Defined cases: null or empty text has no words and fails the base rules; a
null host is a host of its own; rows with equal id, host and text get equal
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField

from tidemark.llm import words as W
from tidemark.llm.common import stored, texts_of, with_block_columns

WINDOW = 8
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", dtype=np.uint8)] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeated(hashes: np.ndarray) -> np.ndarray:
    """True where a value occurs more than once."""
    ordered = np.sort(hashes)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(hashes), dtype=bool)
    at = np.minimum(np.searchsorted(twice, hashes), len(twice) - 1)
    return twice[at] == hashes


def _lines(words: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, first word and word after the last of every line that has a word."""
    feeds = np.flatnonzero(words.data == 0x0A)
    first = np.searchsorted(words.starts, np.concatenate([[0], feeds[:-1] + 1]))
    last = np.searchsorted(words.starts, feeds)
    owner = np.searchsorted(words.offsets, feeds, side="right") - 1
    full = last > first
    return owner[full], first[full], last[full]


def _block(texts: list[bytes]) -> dict[str, list]:
    n = len(texts)
    words = W.Words(texts, W.NOT_SPACE, lower=False)
    out = {"n_words": words.counts}
    leads = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    out["word_chars"] = W.sum_by(words.first, leads[words.ends] - leads[words.starts])
    symbols = np.concatenate([[0], np.cumsum(SYMBOLS[words.data])])
    out["n_symbols"] = symbols[words.offsets[1:]] - symbols[words.offsets[:-1]]

    hashes = words.hashes()
    at, grams = words.gram_hashes(hashes, WINDOW)
    seed = W.mix(np.arange(1, n + 1, dtype=np.uint64))
    owner = words.owner()
    again = _repeated(grams + seed[owner[at]])
    marks = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(marks, at[again], 1)
    np.add.at(marks, np.minimum(at[again] + WINDOW, len(words)), -1)
    out["n_repeat_words"] = W.sum_by(words.first, np.cumsum(marks[:-1]) > 0)

    # Equal lines are compared as they stand, with their own white space.
    line_owner, first, last = _lines(words)
    feeds = np.flatnonzero(words.data == 0x0A)
    begins = np.concatenate([[0], feeds[:-1] + 1])
    full = np.searchsorted(words.starts, feeds) > np.searchsorted(words.starts, begins)
    raw = W.span_hashes(W._BYTE[words.data], begins[full], feeds[full])
    _, once = np.unique(raw + seed[line_owner], return_index=True)
    later = np.ones(len(raw), dtype=bool)
    later[once] = False
    out["n_dup_lines"] = np.bincount(line_owner[later], minlength=n)

    low = W.Words(texts, W.NOT_SPACE, lower=True)
    low_hashes = low.hashes()
    lines = W.span_hashes(low_hashes, first, last)
    sizes = last - first
    bounds = np.searchsorted(line_owner, np.arange(n + 1))
    out["line_hashes"] = [lines[a:b].view(np.int64) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    out["line_words"] = [sizes[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    content = W.span_hashes(low_hashes, low.first[:-1], low.first[1:])
    out["content_hash"] = content.view(np.int64)
    return out


def _long_arrays(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate([np.empty(0, dtype=np.int64), *parts]).astype(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def measure(docs: DataFrame, text: str = "text", without: tuple[str, ...] = ()) -> DataFrame:
    """``docs``, but for the columns ``without``, with the counts of each whole text, its lines as hashes with word counts, and a content hash."""
    longs = [*COUNTS, "content_hash"]
    lists = ["line_hashes", "line_words"]
    fields = [StructField(n, LongType()) for n in longs]
    fields += [StructField(n, ArrayType(LongType())) for n in lists]

    def start():
        def block(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            parts: dict[str, list] = {n: [] for n in longs + lists}
            for _, texts in W.blocks(texts_of(batch, text)):
                made = _block(texts)
                for n in longs:
                    parts[n].append(made[n].astype(np.int64))
                for n in lists:
                    parts[n].extend(made[n])
            none = np.empty(0, dtype=np.int64)
            return {n: pa.array(np.concatenate([none, *parts[n]])) for n in longs} | {
                n: _long_arrays(parts[n]) for n in lists
            }

        return block

    return with_block_columns(docs, fields, start, without)


def judge(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    host: str = "source",
    text: str = "text",
    max_documents: int = 10,
    min_line_words: int = 1,
    min_left: float = 0.5,
) -> DataFrame:
    """One row per document: id, counts, ``n_common_words``, ``base_failed`` and ``kept``.

    A line that more than ``max_documents`` distinct contents of the host hold
    is taken away; ``min_line_words`` spares shorter lines, if asked for. A document is rejected
    if it fails the base rules (under 20 words, or over 30 % of its words in
    repeated windows), or if less than ``min_left`` of its words are left.
    """
    # Kept, as the lines are read twice: to count them and to judge by the counts.
    measured = stored(
        measure(
            docs.select(F.col(id_column).alias("id"), F.col(host).alias("host"), F.col(text).alias("text")),
            without=("text",),
        )
    )
    key = ["id", "host", "content_hash", *COUNTS]
    lines = measured.select(
        *key, F.explode_outer(F.arrays_zip("line_hashes", "line_words")).alias("line")
    ).select(*key, F.col("line.line_hashes").alias("line"), F.col("line.line_words").alias("size"))
    common = (
        lines.where(F.col("size") >= min_line_words)
        .select(F.coalesce("host", F.lit("")).alias("c_host"), F.col("host").isNull().alias("c_none"),
                F.col("line").alias("c_line"), "content_hash")
        .groupBy("c_host", "c_none", "c_line")
        .agg(F.countDistinct("content_hash").alias("n_contents"))
        .where(F.col("n_contents") > max_documents)
        .drop("n_contents")
    )
    joined = lines.join(
        common,
        (F.coalesce("host", F.lit("")) == F.col("c_host"))
        & (F.col("host").isNull() == F.col("c_none"))
        & (F.col("line") == F.col("c_line")),
        "left",
    )
    # Repeated rows double both sums, so the share stays right.
    per_document = joined.groupBy(*key).agg(
        F.coalesce(F.sum(F.when(F.col("c_line").isNotNull(), F.col("size"))), F.lit(0)).alias("taken"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("all_words"),
        F.greatest(F.count(F.when(F.col("size").isNull(), 1)), F.lit(1)).alias("empty_rows"),
    )
    copies = F.when(F.col("n_words") > 0, F.expr("all_words div n_words")).otherwise(F.col("empty_rows"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    left = F.col("all_words") - F.col("taken")
    return per_document.select(
        F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias("copy"),
        F.col("id").alias(id_column),
        *COUNTS,
        F.when(F.col("n_words") > 0, F.expr("taken * n_words div all_words")).otherwise(F.lit(0)).cast("long").alias("n_common_words"),
        failed.alias("base_failed"),
        (~failed & (left >= min_left * F.col("all_words"))).alias("kept"),
    ).drop("copy")
