from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm import cases
from tidemark.llm import phrases as P


def brute(docs, longest=4, least=30, percent=80):
    """docs: (lang, text); every phrase that stays."""
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, *words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    contained = {}
    for p, a in candidates.items():
        words = p[1:]
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                inner = (p[0], *words[i : i + k])
                contained[inner] = max(contained.get(inner, 0), a)
    out = Counter()
    for p, a in candidates.items():
        if 100 * contained.get(p, 0) >= percent * a:
            continue
        cuts = [(f[p[: k + 1]], f[(p[0], *p[k + 1 :])], k) for k in range(1, len(p) - 1)]
        left, right, _ = min(cuts, key=lambda c: (2000000 * a // (c[0] + c[1]), c[2]))
        out[p[0], " ".join(p[1:]), a, left, right, n[p[0]], 2000000 * a // (left + right)] += 1
    return out


def got(df):
    return Counter((r.lang, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def corpus(rng, size=400):
    words = ["Sea", "see", "c", "é", "und", "-", "x y", "\x00", "b"]
    rows = []
    for _ in range(size):
        parts = [rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " c see "]) for _ in range(rng.randrange(30))]
        rows.append((rng.choice(["en", "en", "en", "fr", "", None]), "".join(parts)))
    return rows


@pytest.mark.parametrize(
    "settings", [{}, {"budget": 16}, {"budget": 16, "dictionary": 5}, {"longest": 3, "min_count": 4}, {"longest": 2, "min_count": 1, "dictionary": 1}]
)
def test_equals_brute_force(spark, settings):
    rows = corpus(random.Random(7))
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    expected = brute(rows, settings.get("longest", 4), settings.get("min_count", 30))
    assert expected and got(P.mine(docs, **settings)) == expected


def test_frequent_prefixes_are_extended(spark):
    rows = corpus(random.Random(8)) + [("en", "hot hot hot hot hot hot ")] * 500
    docs = P._named(spark.createDataFrame(rows, "lang string, text string").repartition(3), "lang", "text")
    vocab = P.vocabulary(docs, 30, P.DICTIONARY)
    cut = P.cut_tree(docs, vocab, 4, 200)
    assert [len(p.rows[0]) for p in cut.extended] == [1, 2, 3] and cut.parts > 10
    packed = P.leaves(docs, vocab, cut, 4)
    assert packed.select("part").distinct().count() > 5
    assert got(P.mine(spark.createDataFrame(rows, "lang string, text string"), budget=200)) == brute(rows)


def test_most_prefixes_bound_what_tasks_are_told(spark):
    docs = P._named(spark.createDataFrame(corpus(random.Random(9)), "lang string, text string"), "lang", "text")
    vocab = P.vocabulary(docs, 2, P.DICTIONARY)
    cut = P.cut_tree(docs, vocab, 4, 1, most_prefixes=10)
    assert all(len(p.rows) <= 10 for p in cut.extended)


def test_packed_leaves_come_back():
    rng = np.random.default_rng(1)
    for low, high in ((0, 9), (0, 1 << 40), (-(1 << 62), 1 << 62)):
        rows, counts = P.combined(rng.integers(low, high, (500, 4)), rng.integers(1, 9, 500))
        back, n = P._unpacked(P._packed(rows, counts), 4)
        assert (back == rows).all() and (n == counts).all()


def test_words_with_equal_hashes_get_others(spark, monkeypatch):
    plain = P._hashes
    monkeypatch.setattr(P, "_hashes", lambda w, langs, seed: plain(w, langs, seed) >> np.uint64(0 if seed else 60))
    vocab = P.vocabulary(P._named(spark.createDataFrame(corpus(random.Random(1)), "lang string, text string"), "lang", "text"), 5, 100)
    assert vocab.seed == 1 and vocab.words.count() == vocab.words.select("lang", "word").distinct().count()


def test_top_breaks_ties_by_bytes(spark):
    rows = [("en", p, 40, 40, 40, 9, s) for p, s in (("b é", 7), ("b z", 7), ("a a", 7), ("c c", 8))] + [("fr", "x y", 1, 1, 1, 1, 1)]
    found = spark.createDataFrame(rows, "lang string, phrase string, a long, l long, r long, n long, score long")
    ranked = [(r.lang, r["rank"], r.phrase) for r in P.top(found, 3).orderBy("lang", "rank").collect()]
    assert ranked == [("en", 1, "c c"), ("en", 2, "a a"), ("en", 3, "b z"), ("fr", 1, "x y")]


def test_odd_rows(spark):
    texts = [*cases.TEXTS, "one two " * 40, ",.;:!?", "a" * 100_000 + " b"]
    docs = cases.documents(spark, texts)
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert got(P.mine(docs)) == brute(rows)
    assert P.top(P.mine(cases.empty(spark))).count() == 0
    nothing = spark.createDataFrame([(None, None), ("en", ""), ("en", "one")], "lang string, text string")
    assert P.mine(nothing, min_count=1).count() == 0
