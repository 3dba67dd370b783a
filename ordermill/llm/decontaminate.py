"""Benchmark decontamination by the q-gram lemma.

Texts are compared lower-cased, with each stretch of white space as one space. Benchmark items are
read as overlapping windows of characters. A document region that equals a window of L characters up
to k edits shares at least L + 1 - q(k + 1) of its q-grams with it, on diagonals (document position
less window position) that lie within k of each other. So shared q-grams are counted by window and
by overlapping band of diagonals; bands that reach the bound are aligned within the band, and
those of at most k edits are hits. So are verbatim passages of PASSAGE characters of an item, at whatever
place they begin: as many q-grams in a row on one diagonal of the item.

The benchmark is the query set. It is dealt into blocks of bounded size; a block is sent to all tasks
and every document is read against it whole, so neither the number of items nor their length is
limited. Documents are not shuffled.

Defined results: null and empty texts and items match nothing, nor do items shorter than q
characters; an item row given twice counts once, an id with two texts stands for both; empty tables give an empty result; columns named
like an added one are replaced in ``clean``'s input only where they would clash, others pass through.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ordermill.llm.common import map_arrow, quoted
from ordermill.llm.words import batches as text_batches
from ordermill.llm.words import mixed

Q = 12
WINDOW = 100
EDIT_SHARE = 0.06
PASSAGE = 50  # verbatim characters of an item that are a match wherever they lie
BLOCK_CHARS = 2_000_000
POSTINGS = 1 << 20  # places in the benchmark that shared q-grams are spread to at once
FILTER_BITS = 22
_P = [np.uint64(pow(0x9E3779B97F4A7C15, n, 1 << 64)) for n in (1, 2, 4)]


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def _points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(points: np.ndarray) -> np.ndarray:
    """A hash of the Q = 12 characters from each position on."""
    if len(points) < Q:
        return np.zeros(0, np.uint64)
    c = points.astype(np.uint64) + np.uint64(1)
    two = c[:-1] * _P[0] + c[1:]
    four = two[:-2] * _P[1] + two[2:]
    eight = four[:-4] * _P[2] + four[4:]
    return mixed(eight[:-4] * _P[2] + four[8:])


@dataclass
class Index:
    """The windows of a block of items, and where each of their q-grams occurs."""

    items: np.ndarray  # item of each window
    owner: np.ndarray  # its number in the block
    start: np.ndarray  # where the window begins in it
    points: np.ndarray  # windows x longest window, 0 beyond a window's end
    length: np.ndarray
    edits: np.ndarray  # edit budget of each window
    bound: np.ndarray  # q-grams that a region within the budget shares
    gram: np.ndarray  # distinct q-grams, sorted
    first: np.ndarray  # postings of each: from first[i] to first[i + 1]
    window: np.ndarray
    at: np.ndarray
    seen: np.ndarray  # which leading bits occur at all


def build(items: list[tuple[int, str | None]], window: int = WINDOW, edit_share: float = EDIT_SHARE) -> Index:
    """Windows step by half their length; the last one ends where the item ends."""
    texts, owner, begins = [], [], []
    for k, (_, text) in enumerate(items):
        t = normal(text)
        if len(t) >= Q:
            starts = sorted({*range(0, max(len(t) - window, 0) + 1, window // 2), max(len(t) - window, 0)})
            texts += [t[s: s + window] for s in starts]
            owner += [k] * len(starts)
            begins += starts
    length = np.array([len(t) for t in texts], np.int64)
    budget = np.minimum((length * edit_share).astype(np.int64), length // Q - 1).clip(0)
    points = np.zeros((len(texts), int(length.max(initial=0))), np.uint32)
    hashes, windows, at = [], [], []
    for w, t in enumerate(texts):
        p = _points([t])
        points[w, : len(p)] = p
        g = grams(p)
        hashes.append(g)
        windows.append(np.full(len(g), w))
        at.append(np.arange(len(g)))
    h = np.concatenate([np.zeros(0, np.uint64), *hashes])
    order = np.argsort(h, kind="stable")
    gram, first = np.unique(h[order], return_index=True)
    seen = np.zeros(1 << FILTER_BITS, bool)
    seen[(gram >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
    flat = [np.concatenate([np.zeros(0, np.int64), *x])[order] for x in (windows, at)]
    return Index(np.array([items[k][0] for k in owner], dtype=object), np.array(owner, np.int64), np.array(begins, np.int64), points, length, budget, length + 1 - Q * (budget + 1),
                 gram, np.append(first, len(h)), flat[0], flat[1], seen)


def _aligned(index: Index, points: np.ndarray, window: np.ndarray, low: np.ndarray, lead: np.ndarray, limit: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits that turn each window into a region starting on one of ``width`` diagonals from ``low`` on, and the region's end.

    ``lead`` and ``limit`` are where the region's document begins and ends in ``points``.
    """
    offset = np.arange(width)
    cost = np.zeros((len(window), width), np.int32)
    best, end = np.full(len(window), 1 << 20), np.zeros(len(window), np.int64)
    far = np.int32(1 << 20)
    for j in range(int(index.length[window].max(initial=0))):
        at = low[:, None] + j + offset
        inside = (at >= lead[:, None]) & (at < limit[:, None])
        there = points[np.clip(at, 0, len(points) - 1)]
        # A window character against the document's, against nothing, then document characters against nothing.
        step = cost + np.where(inside, (there != index.points[window, j][:, None]).astype(np.int32), far)
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
        step = np.minimum.accumulate(step - offset, axis=1) + offset
        cost = np.minimum(step, far).astype(np.int32)
        done = index.length[window] == j + 1
        if done.any():
            k = cost[done].argmin(axis=1)
            best[done] = cost[done][np.arange(len(k)), k]
            end[done] = low[done] + j + 1 + k
    return best, end


def verbatim(index: Index, text: np.ndarray, at: np.ndarray, posting: np.ndarray) -> np.ndarray:
    """(text, owner, diagonal, first, last, window) of every run of shared q-grams that spans PASSAGE characters of an item or more, whatever its windows."""
    window = index.window[posting]
    diagonal = at - index.start[window] - index.at[posting]
    owner = index.owner[window]
    order = np.lexsort((at, diagonal, owner, text))
    key, place = np.stack((text[order], owner[order], diagonal[order])), at[order]
    # Overlapping windows give a place twice; a step of two places or another key begins a new run.
    head = np.flatnonzero(np.concatenate(([True], (key[:, 1:] != key[:, :-1]).any(axis=0) | (np.diff(place) > 1))))
    last = np.append(head[1:], len(place)) - 1
    long = place[last] - place[head] + Q >= PASSAGE
    return np.stack((*key[:, head[long]], place[head[long]], place[last[long]], window[order][head[long]]))


def joined(pieces: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, window, end) of runs from pieces of theirs that overlap."""
    text, owner, diagonal, first, last, window = pieces[:, np.lexsort((pieces[3], pieces[2], pieces[1], pieces[0]))]
    head = np.ones(len(text), bool)
    same = (text[1:] == text[:-1]) & (owner[1:] == owner[:-1]) & (diagonal[1:] == diagonal[:-1])
    head[1:] = ~(same & (first[1:] <= last[:-1] + 1))  # pieces of one run reach less far the earlier they begin
    begin = np.flatnonzero(head)
    return text[begin], window[begin], (np.maximum.reduceat(last, begin) if len(begin) else last) + Q


def _postings(index: Index, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(times each hit is repeated, all postings of the hits)."""
    times = index.first[slot + 1] - index.first[slot]
    return times, np.repeat(index.first[slot] - np.cumsum(times) + times, times) + np.arange(times.sum())


def shared(index: Index, text: np.ndarray, at: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """((text, window, low diagonal) of every band that meets its window's bound, pieces of verbatim runs).

    Hits are spread to their postings in slices of POSTINGS; of a slice only sums by text, window and band are kept, and
    verbatim runs. A slice looks PASSAGE characters back, so a run is whole in one of them or falls in pieces that overlap.
    """
    upto = np.cumsum(index.first[slot + 1] - index.first[slot])
    runs, sums, lo = [], ([], []), 0
    while lo < len(at):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + POSTINGS, "right")))
        back = int(np.searchsorted(at, at[lo] - (PASSAGE - Q)))
        times, posting = _postings(index, slot[back:hi])
        runs.append(verbatim(index, np.repeat(text[back:hi], times), np.repeat(at[back:hi], times), posting))
        times, posting = _postings(index, slot[lo:hi])
        window, t = index.window[posting], np.repeat(text[lo:hi], times)
        diagonal = np.repeat(at[lo:hi], times) - index.at[posting] + index.points.shape[1]
        budget = index.edits[window]
        for shift in (0, 1):  # two tilings, half a band apart: k + 1 neighbouring diagonals share a band in one of them
            band = (diagonal + shift * (budget + 1)) // (2 * (budget + 1))
            # A text's diagonals reach a window's length below its start, so texts may share a band: they are parted here.
            sums[shift].append(_summed(np.stack((window, band, t)), np.ones(len(t), np.int64)))
        lo = hi
    found = []
    for shift in (0, 1):
        w, b, t, count = _summed(*(np.concatenate(x, axis=-1) for x in zip(*((s[:3], s[3]) for s in sums[shift]), strict=True)))
        enough = count >= index.bound[w]
        w, b, t = w[enough], b[enough], t[enough]
        found.append(np.stack((t, w, (b * 2 - shift) * (index.edits[w] + 1) - index.points.shape[1])))
    return np.concatenate(found, axis=1), np.concatenate(runs, axis=1)


def _summed(key: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Distinct columns of a key of three rows, with the sums of their counts below."""
    order = np.lexsort(key[::-1])
    key = key[:, order]
    head = np.flatnonzero(np.concatenate(([True], (key[:, 1:] != key[:, :-1]).any(axis=0))))
    return np.vstack((key[:, head], np.add.reduceat(count[order], head)))


def search(texts: list[str | None], index: Index) -> tuple[np.ndarray, ...]:
    """(text, window, edits, end in the normal text, whole) of every hit: the best one of each band, whole windows,
    and verbatim passages with the first window they touch."""
    plain = [normal(t) for t in texts]
    points = _points(plain)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in plain], dtype=np.int64)))
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    h = grams(points)
    at = np.flatnonzero(index.seen[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]) if len(index.gram) else np.zeros(0, np.int64)
    if not len(at):
        return none
    slot = np.searchsorted(index.gram, h[at]).clip(max=len(index.gram) - 1)
    real = index.gram[slot] == h[at]
    at, slot = at[real], slot[real]
    text = np.searchsorted(offsets, at, "right") - 1
    whole = at + Q <= offsets[text + 1]  # not across two texts
    at, slot, text = at[whole], slot[whole], text[whole]
    if not len(at):
        return none
    (t, w, low), pieces = shared(index, text, at, slot)
    passage, window, end = joined(pieces)
    nothing = np.zeros(len(passage), np.int64)
    out = [np.stack((passage, window, nothing, end - offsets[passage], nothing))]
    for lo in range(0, len(t), 4096):
        part = slice(lo, lo + 4096)
        k = index.edits[w[part]]
        width = int((4 * k + 3).max())
        edits, end = _aligned(index, points, w[part], low[part] - k, offsets[t[part]], offsets[t[part] + 1], width)
        hit = edits <= k
        out.append(np.stack((t[part][hit], w[part][hit], edits[hit], end[hit] - offsets[t[part][hit]], np.ones(hit.sum(), np.int64))))
    return tuple(np.concatenate(out, axis=1))


def blocks(benchmark: DataFrame, item_id: str, text: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``block_chars`` characters, one after another."""
    rows = benchmark.select(quoted(item_id).alias("item_id"), quoted(text).alias("text")).distinct()
    held = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-held // block_chars)
    n = n if n < 2 else 2 * n  # dealt by hash, so they are cut smaller than they may be
    for k in range(n):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r.item_id, r.text) for r in part.collect()]


def matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
            block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, n_windows, edits, first_end, last_end) of every document and item that share a window or a passage.

    ``edits`` is the least of the windows found, and 0 where only a verbatim passage is, with no window; ends are positions in the normalised text.
    """
    context = docs.sparkSession.sparkContext
    kind = dict(docs.dtypes)[doc_id]
    item_kind, item_type = dict(benchmark.dtypes)[item_id], to_arrow_type(benchmark.schema[item_id].dataType)
    rows = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    schema = f"doc_id {kind}, item_id {item_kind}, window int, edits int, `end` long, whole boolean"
    found = docs.sparkSession.createDataFrame([], schema)
    for items in blocks(benchmark, item_id, item_text, block_chars):
        sent = context.broadcast(vars(build(items)))

        def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = Index(**sent.value)
            for batch in batches:
                for lo, hi in text_batches(batch.column(1), 1 << 20):
                    t, w, edits, end, whole = search(batch.column(1).slice(lo, hi - lo).to_pylist(), index)
                    if len(t):
                        yield pa.RecordBatch.from_arrays([
                            batch.column(0).slice(lo, hi - lo).take(pa.array(t)), pa.array(index.items[w].tolist(), item_type), pa.array(w, pa.int32()),
                            pa.array(edits, pa.int32()), pa.array(end, pa.int64()), pa.array(whole.astype(bool))],
                            names=["doc_id", "item_id", "window", "edits", "end", "whole"])

        found = found.union(map_arrow(rows, run, schema))
    return found.groupBy("doc_id", "item_id").agg(
        F.countDistinct(F.when(F.col("whole"), F.col("window"))).alias("n_windows"),
        F.coalesce(F.min(F.when(F.col("whole"), F.col("edits"))), F.lit(0)).alias("edits"), F.min("end").alias("first_end"), F.max("end").alias("last_end"))


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without those that share a window or a verbatim passage with a benchmark item; rows don't move."""
    context, at = docs.sparkSession.sparkContext, docs.columns.index(text)
    for items in blocks(benchmark, item_id, item_text, block_chars):
        sent = context.broadcast(vars(build(items)))

        def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = Index(**sent.value)
            for batch in batches:
                for lo, hi in text_batches(batch.column(at), 1 << 20):
                    part = batch.slice(lo, hi - lo)
                    keep = np.ones(part.num_rows, bool)
                    keep[search(part.column(at).to_pylist(), index)[0]] = False
                    yield part.filter(pa.array(keep))

        docs = map_arrow(docs, run, docs.schema)
    return docs
