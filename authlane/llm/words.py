"""Hashes of the words of many texts at once, over the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# A word's hash is a polynomial in an odd number over random 64-bit values of its bytes,
# modulo 2**64, mixed at the end. Prefix sums over the whole buffer give every word of it.
_RANDOM = np.random.Generator(np.random.PCG64(20260101))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
VALUES[65:91] = VALUES[97:123]  # A to Z as a to z
_MULTIPLIERS = _RANDOM.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SPACED = np.ones(256, dtype=bool)  # bytes of words: all but white space
SPACED[[9, 10, 11, 12, 13, 32]] = False
LETTERS = np.zeros(256, dtype=bool)  # bytes of runs of letters; all of a character beyond ASCII
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True

# Bytes of text handled at once; a longer text is handled alone and whole.
CHUNK = 1 << 20
_powers: dict[str, np.ndarray] = {}


def _power_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("p", ())) < size:
        one = np.ones(1, dtype=np.uint64)
        for name, base in (("p", _BASE), ("q", _INVERSE)):
            _powers[name] = np.concatenate([one, np.cumprod(np.full(size, base, dtype=np.uint64))])
    return _powers["p"], _powers["q"]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Words:
    """The words of texts ``first`` to ``last``: hashes, and where each text's words begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int, word_bytes: np.ndarray):
        self.first, self.last = first, first + len(offsets) - 1
        self.data = data[offsets[0] : offsets[-1]]
        at = offsets - offsets[0]
        inside = word_bytes[self.data]
        before = np.concatenate([[False], inside[:-1]]) if len(inside) else inside
        borders = at[:-1][at[:-1] < len(self.data)]
        before[borders] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.concatenate([inside[1:], [False]]) if len(inside) else inside
        ends = at[1:][at[1:] > 0] - 1
        after[ends] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.bounds = np.searchsorted(self.starts, at)
        power, self._inverse = _power_table(max(len(self.data), CHUNK))
        sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum(VALUES[self.data] * power[: len(self.data)], out=sums[1:])
        self._sums = sums
        self.hashes = self.upto(self.ends)

    def upto(self, ends: np.ndarray) -> np.ndarray:
        """Hashes of the words cut at ``ends``; equal bytes give equal hashes."""
        raw = (self._sums[ends] - self._sums[self.starts]) * self._inverse[self.starts]
        return mixed(raw + (ends - self.starts).astype(np.uint64))

    def text_of(self) -> np.ndarray:
        """For every word, the number of its text within the chunk."""
        return np.repeat(np.arange(self.last - self.first), np.diff(self.bounds))


def words_of(texts: pa.Array, word_bytes: np.ndarray = SPACED) -> Iterator[Words]:
    """The words of a string column, in chunks of whole texts; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK, side="right")) - 1)
        yield Words(data, offsets[first : last + 1], first, word_bytes)
        first = last


def shingles(words: Words, size: int) -> Iterator[np.ndarray]:
    """Per text, its different runs of ``size`` words as sorted hashes.

    A text with fewer words has its whole sequence as its one shingle, one without none.
    """
    h = words.hashes
    n = max(0, len(h) - size + 1)
    runs = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        runs += h[i : i + n] * _MULTIPLIERS[i]
    runs = mixed(runs)
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if b - a >= size:
            yield np.unique(runs[a : b - size + 1])
        elif b > a:
            short = (h[a:b] * _MULTIPLIERS[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            yield mixed(np.array([short], dtype=np.uint64))
        else:
            yield runs[:0]
