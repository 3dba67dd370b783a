"""Periodic runs of words, located by block convolution.

A run is a longest stretch of consecutive words of one document in which words ``period`` apart are equal; ``period`` is
its smallest one, and its length is at least EXPONENT periods and LEAST words.

1. Scales. Periods from B to 2B - 1, B a power of two, are looked for with the document cut into blocks of B words. A run
   with such a period holds a whole block whose words lie in the run again one period on.
2. Convolution. For every block the sum of squared differences to the following window is worked out at all distances from
   B to 2B - 1 at once: squares by running sums, products by a number-theoretic transform over whole numbers modulo a prime.
   No sum is rounded, so every distance without mismatch is found; one that is zero only modulo the prime is told by a
   fingerprint. A block is skipped before it when one of its words does not come again within 2B words.
3. Extension. Neighbouring blocks that match at one distance are one seed. A seed is extended to both sides as far as words
   one distance apart are equal. Stretches that are long enough are runs; of equal stretches the smallest distance is the
   period, the others are its multiples.

Blocks of all documents of a batch are transformed together, in slices of bounded size; work is n log² n at worst, also for
a text that is one word over and over. Words compare by 64-bit hashes, stretches by two residues of these (62 bits).
Documents don't move; a task holds one batch, and of it one scale at a time.

Defined results: null and empty texts have no words and no runs; repeated rows, rows that share an id and rows without an id
are each a document of their own; an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ordermill.llm import words as W
from ordermill.llm.common import map_arrow, quoted

EXPONENT = 4
LEAST = 6
# 15 * 2^27 + 1 with a generator of its group, and 7 * 2^26 + 1; both are prime.
PRIME, GENERATOR = 2013265921, 31
SECOND_PRIME = 469762049
SLICE = 1 << 18  # numbers in a slice of blocks that is transformed at once
BATCH_BYTES = 2 << 20


def _powers(base: int, count: int, prime: int) -> np.ndarray:
    out = np.ones(max(count, 1), np.uint64)
    filled = 1
    while filled < count:
        take = min(filled, count - filled)
        out[filled: filled + take] = out[:take] * np.uint64(pow(base, filled, prime)) % np.uint64(prime)
        filled += take
    return out


def transform(rows: np.ndarray, inverse: bool = False) -> np.ndarray:
    """The number-theoretic transform of each row modulo PRIME; the inverse one is not divided by the row's length."""
    size = rows.shape[1]
    p = np.uint64(PRIME)
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    turn = _powers(pow(root, -1, PRIME) if inverse else root, size, PRIME)
    left, right = size // 2, 1
    while left:
        pair = rows.reshape(len(rows), 2, left, right)
        out = np.empty((len(rows), left, 2, right), np.uint64)
        out[:, :, 0] = (pair[:, 0] + pair[:, 1]) % p
        out[:, :, 1] = (pair[:, 0] + p - pair[:, 1]) * turn[: left * right: right, None] % p
        rows = out.reshape(len(rows), size)
        left, right = left // 2, right * 2
    return rows


def mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each block of B numbers and window of 2B: the sum of squared differences, modulo PRIME, at offsets 0 to B - 1."""
    p, size = np.uint64(PRIME), blocks.shape[1]
    padded = np.zeros(windows.shape, np.uint64)
    padded[:, :size] = blocks
    product = transform(padded, inverse=True) * transform(windows) % p
    crossed = transform(product, inverse=True)[:, :size] * np.uint64(pow(2 * size, -1, PRIME)) % p
    squares = np.zeros((len(windows), 2 * size + 1), np.uint64)
    np.cumsum(windows * windows % p, axis=1, out=squares[:, 1:])
    own = (blocks * blocks % p).sum(axis=1) % p
    there = (squares[:, size: 2 * size] - squares[:, :size]) % p
    return (own[:, None] + there + (p - crossed) * np.uint64(2)) % p


class Fingerprints:
    """Tells whether two stretches of one sequence are equal, for many pairs at once."""

    def __init__(self, values: np.ndarray):
        self.residues = []
        for prime, base in ((PRIME, 10_000_037), (SECOND_PRIME, 73_939_133)):
            p = np.uint64(prime)
            power = _powers(base, len(values) + 1, prime)
            sums = np.zeros(len(values) + 1, np.uint64)
            np.cumsum((values % p) * power[:-1] % p, out=sums[1:])
            self.residues.append((p, power, sums % p))

    def equal(self, at: np.ndarray, distance: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        same = np.ones(len(at), bool)
        for p, power, sums in self.residues:
            here = (sums[at + length] + p - sums[at]) % p
            there = (sums[at + distance + length] + p - sums[at + distance]) % p
            same &= here * power[distance] % p == there
        return same

    def reach(self, at: np.ndarray, distance: np.ndarray, limit: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words from ``at`` on (or back from it) equal those ``distance`` on, ``limit`` at most."""
        reached = np.zeros(len(at), np.int64)
        step = 1 << int(limit.max(initial=0)).bit_length()
        while step:
            fits = np.flatnonzero(reached + step <= limit)
            begin = at[fits] - reached[fits] - step if back else at[fits] + reached[fits]
            reached[fits[self.equal(begin, distance[fits], step)]] += step
            step //= 2
        return reached


def _ahead(h: np.ndarray, document: np.ndarray) -> np.ndarray:
    """How far on the same word comes next in its document; farther than anything if it does not."""
    key = W.mixed(h + document.astype(np.uint64) * np.uint64(W.BASE))
    order = np.argsort(key, kind="stable")
    out = np.full(len(h), np.iinfo(np.int64).max)
    again = key[order[1:]] == key[order[:-1]]
    out[order[:-1][again]] = (order[1:] - order[:-1])[again]
    return out


def runs(h: np.ndarray, first: np.ndarray, exponent: int = EXPONENT, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """(document, start in it, length, period) of every run, by document, start and period, of sequences of word hashes.

    Document k has the words ``first[k]`` to ``first[k + 1] - 1``.
    """
    if exponent < EXPONENT:
        raise ValueError("a run of fewer than four periods need not hold a block and its next occurrence")
    counts = np.diff(first)
    document = np.repeat(np.arange(len(counts)), counts)
    far = _ahead(h, document)
    values = h % np.uint64(PRIME)
    prints = None
    found = []
    size, owner, begin = 1, document, np.arange(len(h))
    recur = far  # the farthest next occurrence of a block's words
    while True:
        fits = exponent * size <= counts
        if not fits.any():
            break
        end = first[owner + 1]
        held = np.flatnonzero(fits[owner] & (recur < 2 * size) & (begin + 2 * size <= end))
        if len(held):
            prints = prints or Fingerprints(h)
            found.append(_seeds(values, prints, begin[held], end[held], size))
        # Two neighbouring blocks of a document, from an even one on, are one block of the next scale.
        even = (begin - first[owner]) % (2 * size) == 0
        paired = np.flatnonzero(even[:-1] & (owner[1:] == owner[:-1]))
        recur = np.maximum(recur[paired], recur[paired + 1])
        owner, begin, size = owner[paired], begin[paired], 2 * size
        whole = begin + size <= first[owner + 1]
        recur, owner, begin = recur[whole], owner[whole], begin[whole]
    nothing = np.zeros(0, np.int64)
    at, distance = (np.concatenate([nothing, *[f[k] for f in found]]) for k in (0, 1))
    if not len(at):
        return nothing, nothing, nothing, nothing
    doc = document[at]
    back = prints.reach(at, distance, at - first[doc], back=True)
    on = prints.reach(at, distance, first[doc + 1] - at - distance)
    start, length = at - back - first[doc], back + on + distance
    long = length >= np.maximum(least, exponent * distance)
    doc, start, length, distance = doc[long], start[long], length[long], distance[long]
    order = np.lexsort((distance, length, start, doc))
    doc, start, length, distance = doc[order], start[order], length[order], distance[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    doc, start, length, distance = doc[new], start[new], length[new], distance[new]
    order = np.lexsort((distance, start, doc))
    return doc[order], start[order], length[order], distance[order]


def _seeds(values: np.ndarray, prints: Fingerprints, begin: np.ndarray, end: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word of the first block, distance) of every chain of neighbouring blocks that match at one distance."""
    at, distances = [], []
    slots = np.arange(2 * size)
    for lo in range(0, len(begin), max(SLICE // (2 * size), 1)):
        part = slice(lo, lo + max(SLICE // (2 * size), 1))
        b, last = begin[part], end[part]
        blocks = values[b[:, None] + slots[:size]]
        windows = values[np.minimum(b[:, None] + size + slots, len(values) - 1)]
        row, offset = np.nonzero(mismatches(blocks, windows) == 0)
        inside = b[row] + 2 * size + offset <= last[row]
        b, d = b[row[inside]], offset[inside] + size
        same = prints.equal(b, d, size)
        at.append(b[same])
        distances.append(d[same])
    at, distance = np.concatenate(at), np.concatenate(distances)
    order = np.lexsort((at, distance))
    at, distance = at[order], distance[order]
    # A document's last block matches nothing, so blocks of two documents are never neighbours here.
    head = np.ones(len(at), bool)
    head[1:] = (distance[1:] != distance[:-1]) | (at[1:] != at[:-1] + size)
    return at[head], distance[head]


RUN = "struct<start: long, length: long, period: long>"


def collapsed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """(doc_id, n_words, runs, kept_text) of every document.

    ``runs`` are in order of start and period; ``kept_text`` has the words that no run covers behind its first period,
    joined by one space.
    """
    rows = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in W.batches(batch.column(1), BATCH_BYTES):
                part = batch.slice(lo, hi - lo)
                w = W.split(part.column(1))
                doc, start, length, period = runs(w.hashes(), w.first, exponent, least)
                cover = np.zeros(len(w.start) + 1, np.int64)
                np.add.at(cover, w.first[doc] + start + period, 1)
                np.add.at(cover, w.first[doc] + start + length, -1)
                gone = np.cumsum(cover[:-1]) > 0
                data, kept = w.data.tobytes(), []
                touched = set(doc.tolist())
                for k, (a, b) in enumerate(zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist(), strict=True)):
                    said = data[a:b].split()
                    if k in touched:
                        said = [said[i] for i in np.flatnonzero(~gone[w.first[k]: w.first[k + 1]]).tolist()]
                    kept.append(b" ".join(said))
                ends = np.searchsorted(doc, np.arange(part.num_rows + 1)).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
                    [pa.array(x.astype(np.int64)) for x in (start, length, period)], names=["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(w.counts.astype(np.int64)), listed, pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "kept_text"])

    kind = dict(rows.dtypes)["doc_id"]
    return map_arrow(rows, run, f"doc_id {kind}, n_words long, runs array<{RUN}>, kept_text string")
