"""Language identification by a bidirectional gated recurrent network over bytes.

A text is read in windows of bytes; the network labels every position, and the
probabilities of all positions that belong to letters are averaged. Fitting
takes at most ``per_label`` texts of each language, chosen by the hash of
their ids, and ``pieces`` pieces of each; predicting reads every whole text
and nothing else.

Defined cases: null text and text without a letter is ``und`` with score 0;
without labelled texts all are ``und``; rows with a null id are not learned
from and not held out; repeated rows get equal results; other columns stay,
but those with names of the results are replaced; an empty table gives an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from tidemark.llm import gru
from tidemark.llm import words as W
from tidemark.llm.common import texts_of, with_block_columns

UNDETERMINED = "und"
WINDOW = 64
PER_LABEL, PIECES = 400, 6
# Windows that go through the network together, so that a step's arrays stay in the cache.
CHUNK = 2048

_LETTER_BYTES = np.zeros(256, dtype=bool)
_LETTER_BYTES[0x41:0x5B] = _LETTER_BYTES[0x61:0x7B] = _LETTER_BYTES[0x80:] = True


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    params: gru.Params


def held_out(id_column: str) -> Column:
    """A quarter of the ids, never learned from."""
    return F.coalesce(F.crc32(F.col(f"`{id_column}`").cast("string")) % 4 == 2, F.lit(False))


def labelled_pieces(
    docs: DataFrame, *, id_column: str = "doc_id", text: str = "text", label: str = "lang",
    per_label: int = PER_LABEL, pieces: int = PIECES,
) -> DataFrame:
    """``label`` and ``piece`` of at most ``per_label`` texts of each label that are not held out."""
    own = docs.where(~held_out(id_column)).select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{label}`").alias("label")
    )
    named = own.where("id IS NOT NULL AND label IS NOT NULL AND text IS NOT NULL")
    # Distinct texts, as one id can stand on any number of rows.
    named = named.withColumn("content", F.xxhash64("text"))
    ids = named.select("id", "label", "content").distinct().withColumn("h", F.xxhash64("id"))
    # First the least hashes of many small groups, then those of each label: no group holds a whole label.
    part = Window.partitionBy("label", F.pmod(F.xxhash64("id", "content"), F.lit(256))).orderBy("h", "id", "content")
    whole = Window.partitionBy("label").orderBy("h", "id", "content")
    chosen = (
        ids.withColumn("nth", F.row_number().over(part)).where(F.col("nth") <= per_label)
        .withColumn("nth", F.row_number().over(whole)).where(F.col("nth") <= per_label)
        .select("id", "label", "content")
    )
    cut = F.expr(
        f"transform(sequence(0, {pieces - 1}), i -> substring(text, "
        f"cast(i * greatest(length(text) - {WINDOW}, 0) div {pieces} as int) + 1, {WINDOW}))"
    )
    found = named.join(F.broadcast(chosen), ["id", "label", "content"], "left_semi").select("id", "label", "content", cut.alias("cut"))
    return found.groupBy("id", "label", "content").agg(F.first("cut").alias("cut")).select(
        "id", "label", F.explode(F.array_distinct("cut")).alias("piece")
    )


def _windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (zero behind an end) and letters of windows that begin at ``starts``."""
    at = starts[:, None] + np.arange(WINDOW)
    inside = at < ends[:, None]
    found = np.where(inside, data[np.minimum(at, len(data) - 1)], 0).astype(np.uint8)
    return found, _LETTER_BYTES[found]


def train(samples: DataFrame, **settings: int) -> Model:
    """A model from ``samples`` (id, label, piece); their number is bounded by ``labelled_pieces``."""
    rows = sorted((r.label, r.piece.encode(), str(r.id)) for r in samples.collect() if r.piece)
    rows = [r for r in rows if any(c.isalpha() for c in r[1].decode())]
    labels = tuple(sorted({r[0] for r in rows}))
    if not labels:
        return Model((), {})
    texts = [r[1][:WINDOW] for r in rows]
    data = np.frombuffer(b"".join(texts) + b"\n", dtype=np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    windows, letters = _windows(data, ends - np.array([len(t) for t in texts]), ends)
    wanted = np.array([labels.index(r[0]) for r in rows])
    # As many of each label, so that common ones don't weigh more.
    size = max(np.bincount(wanted))
    even = np.concatenate([np.resize(np.flatnonzero(wanted == i), size) for i in range(len(labels))])
    return Model(labels, gru.train(windows[even], letters[even], wanted[even], len(labels), **settings))


def _block(model: Model, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Best label and its probability for every text."""
    data = np.frombuffer(b"".join(texts) + b"\n", dtype=np.uint8)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    counts = -(-lengths // WINDOW)
    owner = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[owner] + nth * WINDOW
    total = np.zeros((len(texts), len(model.labels)))
    positions = np.zeros(len(texts))
    for a in range(0, len(owner), CHUNK):
        part = slice(a, a + CHUNK)
        windows, letters = _windows(data, starts[part], offsets[owner[part] + 1])
        probs = gru.predict(model.params, windows)
        pooled = np.einsum("tcn,nt->nc", probs, letters.astype(np.float32), optimize=True)
        for c in range(len(model.labels)):
            total[:, c] += np.bincount(owner[part], pooled[:, c], minlength=len(texts))
        positions += np.bincount(owner[part], letters.sum(axis=1), minlength=len(texts))
    best = total.argmax(axis=1)
    score = total[np.arange(len(texts)), best] / np.maximum(positions, 1)
    return best, np.clip(score, 0, 1)


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode())


def predict(docs: DataFrame, model: Model, *, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""

    def start():
        def block(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            names: list[str] = []
            scores: list[float] = []
            for _, texts in W.blocks(texts_of(batch, text), 1 << 20):
                if not model.labels:
                    names += [UNDETERMINED] * len(texts)
                    scores += [0.0] * len(texts)
                    continue
                best, score = _block(model, texts)
                for t, b, s in zip(texts, best.tolist(), score.tolist(), strict=True):
                    known = _has_letter(t)
                    names.append(model.labels[b] if known else UNDETERMINED)
                    scores.append(s if known else 0.0)
            return {"lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())}

        return block

    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    return with_block_columns(docs, fields, start, () if keep_text else (text,))


def fit(docs: DataFrame, **names: str) -> Model:
    return train(labelled_pieces(docs, **names))
