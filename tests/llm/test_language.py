from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tests.llm import cases
from tidemark.llm import gru
from tidemark.llm import language as L

SOUNDS = {"aa": "the of and ing th er", "bb": "der die und ung sch ei", "cc": "el los que ado ci ñ"}


def corpus(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SOUNDS))
        rows.append((i, " ".join("".join(rng.choices(SOUNDS[lang].split(), k=3)) for _ in range(rng.randrange(5, 120))), lang))
    return rows


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in gru.initial(3, 3, 1).items()}
    windows, mask, labels = rng.integers(0, 256, (5, 7)), rng.random((5, 7)) < 0.8, rng.integers(0, 3, 5)
    _, grad = gru.gradients(p, windows, mask, labels)
    for name in p:
        for _ in range(8):
            at = tuple(rng.integers(0, s) for s in p[name].shape)
            if name == "input":
                at = (at[0], at[1], windows[at[1] % 5, at[0]])
            up, down = ({k: v.copy() for k, v in p.items()} for _ in range(2))
            up[name][at] += 1e-3
            down[name][at] -= 1e-3
            slope = (gru.gradients(up, windows, mask, labels)[0] - gru.gradients(down, windows, mask, labels)[0]) / 2e-3
            assert slope == pytest.approx(float(grad[name][at]), abs=2e-4)


def test_held_out_texts_are_told(spark):
    docs = spark.createDataFrame(corpus(600, 1), "doc_id long, text string, lang string")
    model = L.train(L.labelled_pieces(docs, per_label=100), steps=120)
    assert model.labels == ("aa", "bb", "cc")
    rows = L.predict(docs, model).select("*", L.held_out("doc_id").alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    tested = [r for r in rows if r.out]
    assert np.mean([r.lang_pred == r.lang for r in tested]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)
    # Nothing but the text counts.
    blind = L.predict(docs.select("text"), model).collect()
    assert [(r.lang_pred, r.score) for r in blind] == [(r.lang_pred, r.score) for r in rows]


def test_learns_from_labelled_and_not_held_out_rows_only(spark):
    docs = spark.createDataFrame([*corpus(80, 2), (None, "no id", "aa"), (500, "no label", None), (501, None, "aa")], "doc_id long, text string, lang string")
    ids = {r.id for r in L.labelled_pieces(docs, per_label=10).collect()}
    assert ids and not ids & {None, 500, 501} and all(zlib.crc32(str(i).encode()) % 4 != 2 for i in ids)
    assert len(ids) <= 30


def test_odd_rows(spark):
    docs = cases.documents(spark)
    model = L.train(L.labelled_pieces(docs), steps=5)
    rows = cases.by_id(L.predict(docs, model))
    for i in (0, 1, 2, 10):
        assert (rows[i].lang_pred, rows[i].score) == ("und", 0.0)
    assert all(rows[i].lang_pred in model.labels for i in (3, 4, 5, 7))
    nothing = L.fit(cases.empty(spark))
    assert nothing.labels == () and {r.lang_pred for r in L.predict(docs, nothing).collect()} == {"und"}
    assert L.predict(cases.empty(spark), model).count() == 0


def test_one_id_on_many_rows_is_bounded(spark):
    docs = spark.range(3000).selectExpr("1L AS doc_id", "concat('text number ', id) AS text", "'en' AS lang")
    assert L.labelled_pieces(docs.union(docs), per_label=10).count() == 10
