"""Words of many texts at once, as numpy arrays.

A word is a longest run of ASCII letters, digits and bytes from 0x80 on, with
A-Z in lower case. Work is done on the bytes of an Arrow column: no Python
object is made per word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_WORD = np.zeros(256, bool)
_WORD[ord("0"):ord("9") + 1] = _WORD[ord("a"):ord("z") + 1] = _WORD[ord("A"):ord("Z") + 1] = _WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
#: A random number for each byte, so that words of few letters spread over 64 bits.
_BYTE = np.random.default_rng(20).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_STEP = 1 << 20
_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0..n-1, modulo 2^64."""
    known = _tables.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, _STEP), base, np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if n <= _STEP:
            _tables[base] = known
    return known


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each row starts and ends in them; null is empty."""
    texts = pc.fill_null(texts, "")
    large = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if large else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


@dataclass
class Words:
    """Words of some rows: ``rows[i]`` .. ``rows[i + 1]`` are the words of row ``i``."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word in lower case, the same in every row and process."""
        out = np.empty(len(self.starts), np.uint64)
        inverse = pow(_BASE, -1, 1 << 64)
        first = 0
        while first < len(out):
            base = self.starts[first]
            last = max(int(np.searchsorted(self.ends, base + _STEP, "right")), first + 1)
            piece = _LOWER[self.raw[base:self.ends[last - 1]]]
            sums = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(_BYTE[piece] * _powers(_BASE, len(piece))[:len(piece)], out=sums[1:])
            s, e = self.starts[first:last] - base, self.ends[first:last] - base
            out[first:last] = (sums[e] - sums[s]) * _powers(inverse, len(piece))[s] + (e - s).astype(np.uint64)
            first = last
        return mix(out)

    def counts(self) -> np.ndarray:
        return np.diff(self.rows)


class SpanHashes:
    """Hashes of any runs of an array of 64-bit numbers, from sums up to each place."""

    def __init__(self, numbers: np.ndarray):
        self._sums = np.zeros(len(numbers) + 1, np.uint64)
        np.cumsum(numbers * _powers(_BASE, len(numbers))[:len(numbers)], out=self._sums[1:])
        self._inverse = _powers(pow(_BASE, -1, 1 << 64), len(numbers) + 1)

    def of(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of each of the runs ``first`` .. ``end - 1``."""
        return mix((self._sums[end] - self._sums[first]) * self._inverse[first] + (end - first).astype(np.uint64))


def find_words(texts: pa.Array) -> Words:
    raw, offsets = text_bytes(texts)
    is_word = _WORD[raw]
    first, last = is_word.copy(), is_word.copy()
    first[1:] &= ~is_word[:-1]
    last[:-1] &= ~is_word[1:]
    edges = offsets[(offsets > 0) & (offsets < len(raw))]
    first[edges] = is_word[edges]
    last[edges - 1] = is_word[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(raw, starts, ends, np.searchsorted(starts, offsets))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers ``starts[i] .. starts[i] + lengths[i] - 1`` for every ``i``, in one array."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def shingles(hashes: np.ndarray, rows: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, word index of its start, row bounds)`` of all runs of ``n`` words.

    A row of 1 to n - 1 words has one shingle, all of its words; a row without
    words has none.
    """
    counts = np.diff(rows)
    most = np.where(counts == 0, 0, np.maximum(counts - n + 1, 1))
    at = ragged(rows[:-1], most)
    length = np.repeat(np.minimum(counts, n), most)
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        reach = k < length
        if reach.all():
            out = mix(out + hashes[at + k] if len(at) else out)
        else:
            out[reach] = mix(out[reach] + hashes[at[reach] + k])
    return out, at, np.concatenate([[0], np.cumsum(most)])
