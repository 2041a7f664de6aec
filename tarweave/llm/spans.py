"""Runs of token ids in one array, for encoders that remember what they have encoded."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tarweave.llm.words import ragged, text_bytes


def _room(array: np.ndarray, size: int) -> np.ndarray:
    return array if size <= len(array) else np.concatenate([array, np.zeros(max(size - len(array), len(array) // 2), array.dtype)])


class Spans:
    """A growing store of runs of ids; a run is known by its number."""

    def __init__(self):
        self._flat = np.zeros(1 << 16, np.int32)
        self._start = np.zeros(1 << 10, np.int64)
        self._length = np.zeros(1 << 10, np.int32)
        self._used = self._n = 0

    def __len__(self) -> int:
        return self._n

    def add(self, flat: np.ndarray, counts: np.ndarray) -> range:
        """Store runs, given one after another with their lengths; their numbers."""
        ends = np.cumsum(counts)
        total = len(flat)
        self._flat = _room(self._flat, self._used + total)
        self._flat[self._used:self._used + total] = flat
        first, last = self._n, self._n + len(counts)
        self._start, self._length = _room(self._start, last), _room(self._length, last)
        self._start[first:last] = self._used + ends - counts
        self._length[first:last] = counts
        self._used += total
        self._n = last
        return range(first, last)

    def gather(self, numbers: list[int] | np.ndarray, counts: list[int] | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that consist of ``counts`` runs each, and how many ids each has."""
        at = np.asarray(numbers, np.int64)
        sizes = self._length[at].astype(np.int64)
        ends = np.append(0, np.cumsum(sizes))[np.cumsum(np.asarray(counts, np.int64))]
        return self._flat[ragged(self._start[at], sizes)], np.diff(ends, prepend=0)


class Numbered(dict):
    """Strings and their numbers in order of appearance; looking one up notes it. ``new`` are those noted last."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, text: str) -> int:
        number = self[text] = len(self)
        self.new.append(text)
        return number

    def take_new(self) -> list[str]:
        new, self.new = self.new, []
        return new


_remembered: dict[str, dict] = {}


def _give_back() -> None:
    """Give memory that was freed between what is in use back to the system, where the C library can."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def worker_state(owner: str) -> dict:
    """What a Python worker remembers from task to task of an operator; it goes once the worker is given another's tasks."""
    if owner not in _remembered:
        _remembered.clear()
        _remembered[owner] = {}
        gc.collect()
        pa.default_memory_pool().release_unused()
        _give_back()
    return _remembered[owner]


def text_slices(texts: pa.Array, limit: int = 4 << 20) -> Iterator[pa.Array]:
    """Slices of a string column with about ``limit`` bytes, one row at least; null becomes empty."""
    _, offsets = text_bytes(texts)
    texts, done = pc.fill_null(texts, ""), 0
    while done < len(texts):
        upto = max(int(np.searchsorted(offsets, offsets[done] + limit, "right")) - 1, done + 1)
        yield texts.slice(done, upto - done)
        done = upto


def text_blocks(texts: pa.Array, limit: int) -> Iterator[list[str]]:
    """The same as lists of Python strings."""
    return (part.to_pylist() for part in text_slices(texts, limit))


def id_lists(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    """A list column from ids and lengths of blocks of rows."""
    ids = np.concatenate([np.zeros(0, np.int32), *(p[0] for p in parts)])
    lengths = np.concatenate([np.zeros(0, np.int64), *(p[1] for p in parts)])
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), pa.array(ids, pa.int32()))
