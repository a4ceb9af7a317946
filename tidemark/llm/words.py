"""Words of many texts at once, as numpy arrays of places and 64-bit hashes.

A block is a list of UTF-8 texts joined by line feeds. A word's hash is a
polynomial of its bytes, taken from running sums, so that no Python object is
made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_RNG = np.random.default_rng(20240131)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)

# Bytes of words: all but the six ASCII white space characters; digits,
# lower-case letters and every byte of a character beyond ASCII.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))

_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < n:
        factors = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        factors[0] = 1
        table = _powers[base] = np.cumprod(factors)
    return table[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the whole value."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Hash of ``values[start:end]`` for every span; equal values give equal hashes."""
    n = len(values)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * _power_table(base, n), out=sums[1:])
    inverse = pow(base, -1, 1 << 64)
    h = (sums[ends] - sums[starts]) * _power_table(inverse, n + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64) * _STEP)


class Words:
    """Places and hashes of the words of a block.

    ``starts``, ``ends``: byte places; ``first``: for text i, its words are
    ``first[i]`` up to ``first[i + 1]``; ``offsets``: where texts start.
    """

    def __init__(self, texts: list[bytes], word_bytes: np.ndarray, lower: bool):
        data = b"\n".join(texts) + b"\n"
        if lower:
            data = data.translate(LOWER)
        self.data = np.frombuffer(data, dtype=np.uint8)
        self.lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths + 1)])
        inside = word_bytes[self.data]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edge = np.concatenate([[0], edge])
        # The block ends in a line feed, so every word has an end.
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """Text number of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(_BYTE[self.data], self.starts, self.ends)

    def gram_hashes(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of ``size`` words within one text."""
        n = len(hashes) - size + 1
        if n <= 0:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        owner = self.owner()
        at = np.flatnonzero(owner[:n] == owner[size - 1 :])
        total = np.zeros(n, dtype=np.uint64)
        for i in range(size):
            total *= _STEP
            total += hashes[i : i + n]
        return at, mix(total[at])


def sum_by(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values[first[i]:first[i + 1]]``."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def blocks(texts: list[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of whole texts of about ``limit`` bytes, each with the number of its first text."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, texts[start:]
