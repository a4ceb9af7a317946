from __future__ import annotations

import hashlib
import json
import random

import pytest
from tokenizers import Tokenizer

from tests.llm import cases
from tidemark.llm import bpe
from tidemark.llm.queries import tokenizer_file

PIECES = [
    "a", "the", "ing", " ", "\n", "'s", "'", "'re", "1", "23", "é", "é", "Σ", "ΑΣ", "İ", "ß", "漢字", "😀", "!!", "<|endoftext|>",
    "<|ENDOFTEXT|>", "<|startoftext|>", "\x1c", "\x85", "​", "　", "A", "ǅ", "\x00",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_file())


@pytest.fixture(scope="module")
def own():
    with open(tokenizer_file(), encoding="utf-8") as file:
        return bpe.Encoder(file.read())


def test_ids_and_text_equal_the_library(library, own):
    rng = random.Random(1)
    texts = ["".join(rng.choices(PIECES, k=rng.randrange(40))) for _ in range(3000)]
    texts += ["".join(rng.choices("aetinsorhl", k=rng.randrange(1, 60))) for _ in range(2000)]
    texts += [c * n for c in "a!é" for n in range(1, 70)]
    for text, encoding in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert own.encode(text).tolist() == encoding.ids, text
        assert own.decode(encoding.ids) == library.decode(encoding.ids, skip_special_tokens=False)


def test_automaton_finds_all_tokens_that_end_at_a_place():
    tokens = {t: i for i, t in enumerate(["a", "b", "ab", "ba", "aba", "bb", "abab", "c"])}
    found = bpe.SuffixAutomaton(tokens).endings("ababbxca")
    for end, here in enumerate(found, 1):
        expected = [(len(t), i) for t, i in tokens.items() if "ababbxca"[:end].endswith(t)]
        assert list(here) == sorted(expected, reverse=True)


def test_operators_bear_odd_rows(spark, library):
    docs = cases.documents(spark)
    decoded = bpe.decode(bpe.encode(docs, tokenizer_file()), tokenizer_file())
    assert decoded.columns == [*docs.columns, "token_ids", "decoded"]
    digests = cases.by_id(bpe.digest(docs, tokenizer_file()))
    for row in decoded.collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.token_ids == ids and row.decoded == library.decode(ids, skip_special_tokens=False)
        digest = digests[row.doc_id]
        assert digest.n_tokens == len(ids)
        assert digest.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert digest.decoded_sha256 == hashlib.sha256(row.decoded.encode()).hexdigest()
    assert bpe.digest(cases.empty(spark), tokenizer_file()).count() == 0


@pytest.mark.parametrize(
    "change",
    [
        {"normalizer": None}, {"pre_tokenizer": {"type": "Whitespace"}}, {"decoder": {"type": "ByteLevel"}}, {"model": {"ignore_merges": True}},
        {"added_tokens": [{"id": 1, "content": "<x>", "lstrip": True}]},
    ],
)
def test_other_formats_are_refused(change):
    with open(tokenizer_file(), encoding="utf-8") as file:
        data = json.load(file)
    change = {k: data[k] | v if k == "model" else v for k, v in change.items()}
    with pytest.raises(ValueError, match=f"differs.*{next(iter(change)).split('_')[0]}"):
        bpe.Encoder(json.dumps(data | change))
