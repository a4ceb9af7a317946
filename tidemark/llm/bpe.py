"""BPE encoding by one last token per prefix.

A suffix automaton of the vocabulary yields, while a word is read, all tokens
that end at each place. A prefix of a word has exactly one last token: the one
that may follow the last token of the prefix before it. Whether two tokens may
stand side by side is decided by the merges alone and remembered. Following
the last tokens back from the end of the word gives exactly the ids of merging.

Words come from the tokenizer file's own steps: special tokens are cut out of
the raw text, the rest is composed (NFC), lower-cased and split. Results per
word are remembered during a task, up to a fixed number of words.

Defined cases: null and empty text have no tokens and decode to the empty
text; repeated rows get equal results; other columns are kept, but those with
the names of the results are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import copy
import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField

from tidemark.llm.common import sha256_hex, with_block_columns

# Pairs of tokens, and words (about 200 bytes each), that one task remembers at a time.
REMEMBERED, REMEMBERED_WORDS = 160_000, 300_000

# Fixed values of the file format: contractions, runs of letters, single
# digits, runs of anything else but white space; the suffix of a word's end.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECE = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"
END = "</w>"
# What a file must say for these steps to be its own.
FORMAT = {
    "truncation": None,
    "padding": None,
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "decoder": None,
}
MODEL = {
    "type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": END,
    "fuse_unk": False, "byte_fallback": False, "ignore_merges": False,
}
# An ending symbol stands in the private area, so that each symbol is one character.
_ENDING = 0xE000


# The same pieces for texts without characters beyond U+024F, where the classes can be written out for ``re``.
_LATIN = [chr(c) for c in range(0x250)]
_LETTERS = re.escape("".join(c for c in _LATIN if unicodedata.category(c)[0] == "L"))
_NUMBERS = re.escape("".join(c for c in _LATIN if unicodedata.category(c)[0] == "N"))
LATIN_PIECE = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\t-\r \x85\xa0{_LETTERS}{_NUMBERS}]+"
)
BEYOND_LATIN = re.compile("[^\x00-\u024f]")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class SuffixAutomaton:
    """All substrings of the vocabulary, with the tokens that end in each state."""

    def __init__(self, tokens: dict[str, int]):
        self.longest, self.link, self.go = [0], [-1], {}
        self._out: dict[int, list[int]] = {}
        ends: list[tuple[int, int, int]] = []
        for token, number in tokens.items():
            state = 0
            for symbol in token:
                state = self._extend(state, ord(symbol))
            ends.append((state, len(token), number))
        own: dict[int, list[tuple[int, int]]] = {}
        for state, size, number in ends:
            # The state may have been split since: walk up to the one that holds this length.
            while self.link[state] >= 0 and self.longest[self.link[state]] >= size:
                state = self.link[state]
            own.setdefault(state, []).append((size, number))
        self.own = {s: sorted(v, reverse=True) for s, v in own.items()}
        # All tokens that end in a state or on its way to the root, longest first.
        self.tokens: list[tuple[tuple[int, int], ...]] = [()] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.longest.__getitem__):
            self.tokens[state] = (*self.own.get(state, ()), *self.tokens[self.link[state]])
        # Needed to build it only.
        del self._out
        self._falls: dict[int, tuple[int, int]] = {}

    def _new(self, longest: int, link: int) -> int:
        self.longest.append(longest)
        self.link.append(link)
        return len(self.link) - 1

    def _copy_for(self, state: int, symbol: int, target: int) -> int:
        """A state of its own for the strings of ``target`` that are reached from ``state``."""
        copy = self._new(self.longest[state] + 1, self.link[target])
        for s in self._out.get(target, ()):
            self._put(copy, s, self.go[target << 16 | s])
        self.link[target] = copy
        while state >= 0 and self.go.get(state << 16 | symbol) == target:
            self.go[state << 16 | symbol] = copy
            state = self.link[state]
        return copy

    def _put(self, state: int, symbol: int, target: int) -> None:
        self.go[state << 16 | symbol] = target
        self._out.setdefault(state, []).append(symbol)

    def _extend(self, state: int, symbol: int) -> int:
        known = self.go.get(state << 16 | symbol)
        if known is not None:
            if self.longest[known] == self.longest[state] + 1:
                return known
            return self._copy_for(state, symbol, known)
        added = self._new(self.longest[state] + 1, 0)
        while state >= 0 and state << 16 | symbol not in self.go:
            self._put(state, symbol, added)
            state = self.link[state]
        if state >= 0:
            known = self.go[state << 16 | symbol]
            if self.longest[known] != self.longest[state] + 1:
                known = self._copy_for(state, symbol, known)
            self.link[added] = known
        return added

    def fall(self, state: int, symbol: int) -> tuple[int, int]:
        """Where a symbol leads that does not go on from ``state``, and how much of the text is known there."""
        key = state << 16 | symbol
        known = self._falls.get(key)
        if known is None:
            target = None
            while target is None and state:
                state = self.link[state]
                target = self.go.get(state << 16 | symbol)
            known = (0, 0) if target is None else (target, self.longest[state] + 1)
            if len(self._falls) >= REMEMBERED:
                self._falls.clear()
            self._falls[key] = known
        return known

    def endings(self, text: str) -> list[tuple[tuple[int, int], ...]]:
        """For each place of ``text``, length and number of every token that ends there, longest first."""
        state, size, found = 0, 0, []
        for letter in text:
            target = self.go.get(state << 16 | ord(letter))
            state, size = self.fall(state, ord(letter)) if target is None else (target, size + 1)
            # Only the state's own tokens can be longer than what has been read.
            found.append(tuple(x for x in self.tokens[state] if x[0] <= size))
        return found


def _require_format(data: dict) -> None:
    """Only the steps that are written here are borne; a file with others would be encoded wrongly."""
    wrong = [name for name, wanted in FORMAT.items() if data.get(name) != wanted]
    wrong += [f"model.{name}" for name, wanted in MODEL.items() if data["model"].get(name, wanted) != wanted]
    for token in data["added_tokens"]:
        if any(token.get(flag) for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            wrong.append(f"added token {token['content']}")
    if wrong:
        raise ValueError(f"tokenizer file differs from what can be encoded: {', '.join(wrong)}")


class Encoder:
    """Encodes single words and whole texts as one tokenizer file says."""

    def __init__(self, source: str):
        data = json.loads(source)
        _require_format(data)
        model = data["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.names = {i: t for t, i in self.vocabulary.items()}
        special = {x["content"]: x["id"] for x in data["added_tokens"]}
        self.names |= {i: t for t, i in special.items()}
        self.special = special
        self.cut = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        letters = byte_letters()
        self.inner = [ord(c) for c in letters]
        self.final = {c: chr(_ENDING + b) for b, c in enumerate(letters)}
        # Merges by pair; parts and rank by token. Tokens without parts are born at -1.
        self.merges: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            pair = self.vocabulary[a], self.vocabulary[b]
            self.merges[pair] = rank
            self.parts[self.vocabulary[a + b]] = (rank, *pair)
        self.automaton = SuffixAutomaton({self._symbols(t): i for t, i in self.vocabulary.items()})
        self.allowed: dict[int, bool] = {}
        # Ids of words as the bytes of an array.
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.special_ids = {t: array("I", [i]).tobytes() for t, i in special.items()}
        self.numbers = {i: str(i) for i in self.names}
        self.pieces = regex.compile(PIECE)

    def _symbols(self, token: str) -> str:
        if token.endswith(END) and len(token) > len(END):
            body = token[: -len(END)]
            return body[:-1] + self.final[body[-1]]
        return token

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens that have stood at one edge of ``token`` while it was merged, each with the rank that ended it."""
        out, died = [], float("inf")
        while True:
            out.append((token, died))
            if token not in self.parts:
                return out
            rank, *pair = self.parts[token]
            token, died = pair[side], rank

    def _follows(self, left: int, right: int) -> bool:
        """Whether merging leaves ``left`` and ``right`` side by side.

        It does not if two tokens at the touching edges would have merged
        before either went into its own side. At equal ranks the merge further
        left comes first.
        """
        ranks = self.merges.get
        lefts = self._edge(right, 0)
        for a, a_died in self._edge(left, 1):
            for b, b_died in lefts:
                rank = ranks((a, b))
                if rank is not None and rank < a_died and rank <= b_died:
                    return False
        return True

    def follows(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.allowed.get(key)
        if known is None:
            if len(self.allowed) >= REMEMBERED:
                self.allowed.clear()
            known = self.allowed[key] = self._follows(left, right)
        return known

    def word_ids(self, word: str) -> list[int]:
        data = word.encode()
        symbols = [self.inner[b] for b in data]
        symbols[-1] = _ENDING + data[-1]
        go, tokens, known = self.automaton.go.get, self.automaton.tokens, self.allowed.get
        # Last token of each prefix, and the place where it begins.
        last, begin = [-1], [0]
        state = size = place = 0
        for symbol in symbols:
            place += 1
            target = go(state << 16 | symbol)
            if target is None:
                state, size = self.automaton.fall(state, symbol)
            else:
                state = target
                size += 1
            for length, token in tokens[state]:
                # Only the state's own tokens can be longer than what has been read.
                if length > size:
                    continue
                if length == place:
                    break
                before = last[place - length]
                if before >= 0:
                    follows = known(before << 32 | token)
                    if self.follows(before, token) if follows is None else follows:
                        break
            else:
                token, length = -1, place
            last.append(token)
            begin.append(place - length)
        ids = []
        while place:
            ids.append(last[place])
            place = begin[place]
        return ids[::-1]

    def _word(self, word: str) -> bytes:
        made = self.older.get(word)
        if made is None:
            made = array("I", self.word_ids(word)).tobytes()
        if len(self.words) >= REMEMBERED_WORDS // 2:
            # Words used since the last turn stay at hand for one more.
            self.older, self.words = self.words, {}
        self.words[word] = made
        return made

    def encode(self, text: str) -> array:
        parts: list[bytes] = []
        place = 0
        for found in self.cut.finditer(text) if self.cut else ():
            parts += self._plain(text[place : found.start()])
            parts.append(self.special_ids[found[0]])
            place = found.end()
        parts += self._plain(text[place:] if place else text)
        return array("I", b"".join(parts))

    def _plain(self, text: str) -> list[bytes]:
        if text.isascii():
            text, split = text.lower(), LATIN_PIECE
        else:
            # Lower case letter by letter: no rule for a sigma at a word's end.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
            split = self.pieces if BEYOND_LATIN.search(text) else LATIN_PIECE
        known = self.words.get
        return [known(w) or self._word(w) for w in split.findall(text)]

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join([self.names[i] for i in ids])

    def listed(self, ids: Iterable[int]) -> str:
        return " ".join([self.numbers[i] for i in ids])


_encoders: dict[str, Encoder] = {}


def encoder(source: str) -> Encoder:
    """An encoder whose tables are made once per tokenizer file and process; what it remembers ends with the task."""
    key = hashlib.sha256(source.encode()).hexdigest()
    if key not in _encoders:
        _encoders[key] = Encoder(source)
    own = copy.copy(_encoders[key])
    own.allowed, own.words, own.older = {}, {}, {}
    return own


def _texts(batch: pa.RecordBatch, column: str) -> list[str]:
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def _shared(docs: DataFrame, tokenizer_file: str):
    """The file's text as a broadcast; a vocabulary file has a few MB at any size of the data."""
    with open(tokenizer_file, encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, tokenizer_file: str, text: str = "text") -> DataFrame:
    """``docs`` with ``token_ids``."""
    source = _shared(docs, tokenizer_file)

    def start():
        own = encoder(source.value)
        return lambda batch: {
            "token_ids": pa.array([own.encode(t).tolist() for t in _texts(batch, text)], pa.list_(pa.int32()))
        }

    return with_block_columns(docs, [StructField("token_ids", ArrayType(IntegerType()))], start)


def decode(tokens: DataFrame, tokenizer_file: str, ids: str = "token_ids") -> DataFrame:
    """``tokens`` with ``decoded``; null ids decode to the empty text."""
    source = _shared(tokens, tokenizer_file)

    def start():
        own = encoder(source.value)

        def block(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            lists = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            return {"decoded": pa.array([own.decode(x or []) for x in lists], pa.string())}

        return block

    return with_block_columns(tokens, [StructField("decoded", StringType())], start)


def digest(docs: DataFrame, tokenizer_file: str, text: str = "text") -> DataFrame:
    """``docs`` without its text, with number and hash of the ids and hash of the decoded text."""
    source = _shared(docs, tokenizer_file)
    names = ("n_tokens", "ids_sha256", "decoded_sha256")

    def start():
        own = encoder(source.value)

        def block(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            counts, hashes, decoded = [], [], []
            for t in _texts(batch, text):
                ids = own.encode(t)
                counts.append(len(ids))
                hashes.append(sha256_hex(own.listed(ids)))
                decoded.append(sha256_hex(own.decode(ids)))
            return {
                "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(hashes, pa.string()),
                "decoded_sha256": pa.array(decoded, pa.string()),
            }

        return block

    fields = [StructField(names[0], LongType()), *(StructField(n, StringType()) for n in names[1:])]
    return with_block_columns(docs, fields, start, without=(text,))
