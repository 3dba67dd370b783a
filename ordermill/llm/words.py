"""Texts of an Arrow batch as flat arrays of words, so that tasks work on numbers and not word by word.

A word is a longest run of bytes other than the six ASCII blanks (space and 0x09-0x0D), that is
``[^\\x20\\x09-\\x0D]+``. All functions take whole texts; a batch is what Spark hands to a task
at a time, so memory follows the batch and not the partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"): ord("Z") + 1] += 32
#: Words are hashed in stretches of so many bytes; the tables of powers are that long.
STRETCH = 1 << 19
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def _powers(base: int) -> np.ndarray:
    out = np.empty(STRETCH + 1, np.uint64)
    out[0] = 1
    filled = 1
    while filled < len(out):  # doubling: the second half is the first half times base ** filled
        take = min(filled, len(out) - filled)
        out[filled: filled + take] = out[:take] * np.uint64(pow(base, filled, 1 << 64))
        filled += take
    return out


_TABLES: list[np.ndarray] = []


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit value depends on every bit given (the finaliser of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """All words of a batch: where they lie in ``data``, and each document's first word in ``first``."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # length documents + 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def document(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes: equal words, equal hashes, in every task and run."""
        if not _TABLES:
            _TABLES.extend((_powers(BASE), _powers(BASE_INVERSE)))
        power, inverse = _TABLES
        out = np.empty(len(self.start), np.uint64)
        at = 0
        while at < len(self.start):
            base = self.start[at]
            to = int(np.searchsorted(self.end, base + STRETCH, "right"))
            if to <= at:  # one word longer than a stretch
                out[at] = xxhash.xxh64_intdigest(self.data[base: self.end[at]].tobytes())
                at += 1
                continue
            stop = int(self.end[to - 1] - base)
            sums = np.zeros(stop + 1, np.uint64)
            piece = self.data[base: base + stop].astype(np.uint64)
            piece += np.uint64(1)
            piece *= power[:stop]
            np.cumsum(piece, out=sums[1:])
            s, e = self.start[at:to] - base, self.end[at:to] - base
            out[at:to] = mixed((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            at = to
        return out


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each begins; a null text is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    d = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return d[o[0]: o[-1]], o - o[0]


def split(column: pa.Array, lower: bool = False) -> Words:
    """The words of each text; ``lower`` maps A-Z to a-z first."""
    data, offsets = text_buffers(column)
    if lower:
        data = LOWER[data]
    solid = ~BLANK[data]
    before = np.empty(len(data) + 1, bool)  # a word ends before this byte, or nothing lies there
    before[0] = True
    before[1:] = ~solid
    before[offsets[:-1]] = True
    start = np.flatnonzero(solid & before[:-1])
    after = np.empty(len(data) + 1, bool)
    after[:-1] = ~solid
    after[-1] = True
    after[offsets[1:]] = True
    end = np.flatnonzero(solid & after[1:]) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def runs(w: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words within one document: (hash, index of its first word, first run of each document)."""
    n = len(hashes) - size + 1
    per_document = np.maximum(w.counts - size + 1, 0)
    first = np.concatenate(([0], np.cumsum(per_document)))
    if n <= 0 or not first[-1]:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), first
    h = hashes[:n].copy()
    for i in range(1, size):
        h *= np.uint64(BASE)
        h += hashes[i: i + n]
    at = np.arange(first[-1]) + np.repeat(w.first[:-1] - first[:-1], per_document)
    return mixed(h[at]), at, first


def give_back() -> None:
    """Return freed memory to the system; allocators keep it otherwise, and workers live through many stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: it has its own ways


def frugal(run: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """A task function that gives memory back after every few batches and at its end."""
    @wraps(run)
    def wrapped(rows: Iterable) -> Iterator:
        try:
            for k, out in enumerate(run(rows)):
                yield out
                if k % 16 == 15:
                    give_back()
        finally:
            give_back()

    return wrapped


def batches(column: pa.Array, max_bytes: int):
    """(from, to) rows of a column in groups of about ``max_bytes``, each of whole texts and one at least."""
    _, offsets = text_buffers(column)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1)
        yield at, to
        at = to
