from __future__ import annotations

import random

from tests.llm import cases
from tidemark.llm import minhash as M
from tidemark.llm.components import components


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    label = {i: i for i in texts}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                    a, b = sorted((root(i), root(j)))
                    label[b] = a
    return {i: (len(sets[i]), root(i)) for i in texts}


def corpus(rng):
    """A hot group of near copies, with a passage that many share, and exact copies."""
    words = [f"w{i}" for i in range(400)]
    base, passage = rng.choices(words, k=90), rng.choices(words, k=40)
    texts = []
    for _ in range(120):
        own = list(base)
        for _ in range(rng.randrange(8)):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts.append(own)
    texts += [passage + rng.choices(words, k=rng.randrange(5, 60)) for _ in range(100)]
    texts += [rng.choices(words, k=rng.randrange(8)) for _ in range(30)]
    texts += [texts[3]] * 40
    rng.shuffle(texts)
    return {i: " ".join(t) for i, t in enumerate(texts)}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_equals_brute_force_on_hot_groups(spark):
    texts = corpus(random.Random(2))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    expected = brute(texts)
    # More tables than by default, so that no link is missed by chance.
    for few in (2, 16, 10_000):
        got = M.near_duplicates(docs, few=few, tables=14)
        assert result(got) == expected, few
        assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


def test_odd_rows(spark):
    docs = cases.documents(spark)
    rows = M.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    for i in (0, 1, 2):
        assert got[i] == (0, i, True)
    assert got[3] == (1, 3, True)
    assert got[6][1] == 5 and got[8][1] == 7 and got[9] == (11, 7, False)
    assert got[None] == (1, None, True)
    assert M.near_duplicates(cases.empty(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(7, 8), (9, 9), (None, 3), (8, 7), (3, 200)]
    rows = components(spark.createDataFrame(chain, "a long, b long")).collect()
    got = {r.node: r.component for r in rows}
    assert {got[i] for i in range(100, 161)} == {100}
    assert (got[7], got[8], got[3], got[200]) == (7, 7, 3, 3) and 9 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_counts_of_buckets_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(c, [rng.randrange(-(2**62), 2**62) if rng.random() < 0.5 else rng.randrange(40) - 20 for _ in range(rng.randrange(30))])
            for c in rng.choices([-(2**60), 7, 9, 2**61], k=200)]
    held = {}
    for component, shingles in rows:
        for shingle in shingles:
            held.setdefault(shingle % M.BUCKETS, []).append(component)
    df = spark.createDataFrame(rows, "component long, shingles array<long>").repartition(3)
    got = M._shared_counts(df)
    assert {i: int(got[i]) for i in got.nonzero()[0]} == {b: len(c) for b, c in held.items() if len(set(c)) > 1}
    assert not M._shared_counts(df.where("false")).any()
