from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import words as W

TEXTS = st.lists(st.text(alphabet="ab é\n", max_size=30), min_size=1, max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_and_hashes(texts):
    raw = [t.encode() for t in texts]
    words = W.Words(raw, W.NOT_SPACE, lower=False)
    hashes = words.hashes()
    seen = {}
    for i, t in enumerate(raw):
        own = range(words.first[i], words.first[i + 1])
        found = [words.data[words.starts[j] : words.ends[j]].tobytes() for j in own]
        assert found == t.split()
        for word, j in zip(found, own, strict=True):
            assert seen.setdefault(word, hashes[j]) == hashes[j]
    assert len(set(map(int, seen.values()))) == len(seen)
    at, grams = words.gram_hashes(hashes, 2)
    expected = [(int(words.first[i]) + j, tuple(t.split()[j : j + 2])) for i, t in enumerate(raw) for j in range(len(t.split()) - 1)]
    assert at.tolist() == [x[0] for x in expected]
    assert len(set(map(int, grams))) == len({x[1] for x in expected})


def test_no_collisions_among_many_words():
    texts = [" ".join(f"{a}{b}" for b in range(500)).encode() for a in range(400)]
    words = W.Words(texts, W.NOT_SPACE, lower=False)
    distinct = {w for t in texts for w in t.split()}
    assert len(np.unique(words.hashes())) == len(distinct)


def test_blocks_keep_order_and_texts():
    texts = [b"x" * n for n in (5, 100, 1, 1, 0, 50)]
    parts = list(W.blocks(texts, 60))
    assert [t for _, part in parts for t in part] == texts
    assert all(texts[start] == part[0] for start, part in parts)
    assert list(W.blocks([])) == []
