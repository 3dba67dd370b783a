"""Substring dedup with repeated-phrase automata.

A window is SPAN consecutive words of one document. A word goes if a window that covers it also starts
earlier in the corpus: in a document with a smaller id, or in the same one further ahead.

1. Anchors: of the short word runs in a window the one with the least hash stands for it, so equal windows
   have equal anchors at equal places. Anchors are counted over the whole corpus; those counted once
   can't belong to a recurring window.
2. Stretches: every document is read whole, and the words around its recurring anchors go to the shard of their anchor.
   Equal stretches of one stretch of input are reduced to the first and the words of the others are marked at once.
3. Shards: windows that occur twice or more in a shard are confirmed on their words and compiled, with
   their first occurrence, into Aho-Corasick automata over word numbers. All stretches run through
   them, and each occurrence that is not the first marks its words.
4. Documents meet their marks and keep the other words, joined by one space.

An anchor of very many occurrences, such as a common phrase, sends its windows to shards one by one by their
own words, so it is no group of its own; a window that recurs everywhere is one row per stretch of input.
A bit map of fixed size, built from the counts, tells tasks which anchors recur; other anchors that share
a bit are sent too and confirm nothing.

Defined results: null and empty texts have no words; rows that share an id are versions of one document: equal windows
at equal places of theirs are one occurrence, and words are removed from the version they lie in; rows without an id are returned whole and make
nobody's words a repeat; an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import map_arrow, packed, quoted
from ordermill.llm.minhash import whole_groups
from ordermill.llm.words import batches as text_batches
from ordermill.llm.words import BLANK, Words, mixed, runs, split
from ordermill.session import materialise

SPAN = 20
ANCHOR = 6
HOT = 4_096
MAP_BITS = 26
AUTOMATON_STRETCHES = 2_048


def anchors(column: pa.Array, span: int, anchor: int):
    """(words, anchor hash, document, first window, number of windows) of each anchor; windows and words count from the document's start."""
    w = split(column)
    h, at, first = runs(w, w.hashes(), anchor)
    ahead = span - anchor
    per_document = np.maximum(w.counts - span + 1, 0)
    window = np.concatenate(([0], np.cumsum(per_document)))
    doc = np.repeat(np.arange(len(column)), per_document)
    own = np.arange(window[-1]) - window[doc]  # window of its document
    run = first[doc] + own
    best, where = h[run] if len(run) else h[:0], run.copy()
    for i in range(1, ahead + 1):
        other = h[run + i] if len(run) else h[:0]
        less = other < best
        best = np.where(less, other, best)
        where = np.where(less, run + i, where)
    new = np.concatenate(([True], (where[1:] != where[:-1]) | (doc[1:] != doc[:-1])))[: len(where)]
    begin = np.flatnonzero(new)
    return w, best[begin], doc[begin], own[begin], np.diff(np.append(begin, len(where)))


def recurring(docs: DataFrame, text: str, span: int, anchor: int) -> DataFrame:
    """(anchor, n) of every anchor that occurs twice or more, however many documents those are."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_batches(batch.column(0), 4 << 20):
                keys, n = np.unique(anchors(batch.column(0).slice(lo, hi - lo), span, anchor)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n, pa.int32())], names=["anchor", "n"])

    counted = map_arrow(docs.select(quoted(text)), run, "anchor long, n int")
    return counted.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1")


def bit_map(found: DataFrame) -> np.ndarray:
    """2 ** MAP_BITS bits, set at the leading bits of each anchor: 8 MB at most, whatever is found."""
    bit = F.shiftrightunsigned("anchor", 64 - MAP_BITS)
    words = found.select(bit.alias("bit")).selectExpr("shiftright(bit, 6) AS word", "shiftleft(1L, int(bit & 63)) AS bits")
    out = np.zeros(1 << MAP_BITS - 6, np.int64)
    for batch in words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow().to_batches():
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out


def _set(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h >> np.uint64(64 - MAP_BITS)
    return (bits[(at >> np.uint64(6)).astype(np.int64)].view(np.uint64) >> (at & np.uint64(63))) & np.uint64(1) > 0


def stretches(docs: DataFrame, doc_id: str, text: str, known, hot, span: int, anchor: int) -> DataFrame:
    """(shard key, id, start, n, words, version): n windows from word ``start`` on, or without words, n words to remove from there on."""
    rows = docs.select(quoted(doc_id).alias("id"), quoted(text).alias("text"), F.xxhash64(quoted(text)).alias("version")).filter("id IS NOT NULL")
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_batches(batch.column(1), 4 << 20):
                w, h, doc, own, n = anchors(batch.column(1).slice(lo, hi - lo), span, anchor)
                keep = _set(known.value, h)
                h, doc, own, n = h[keep], doc[keep], own[keep], n[keep]
                ids, versions = (batch.column(k).slice(lo, hi - lo) for k in (0, 2))
                names = ids.to_pylist()
                said = _stretch_texts(w, w.first[doc] + own, n + span - 1)
                first, late = _firsts(said, [(names[d], k) for d, k in zip(doc.tolist(), own.tolist(), strict=True)])
                common = _set(hot.value, h)
                plain = [k for k in first if not common[k]]
                out = [(h[plain], doc[plain], own[plain], n[plain], [said[k] for k in plain])]
                out.append((mixed(h[late] + own[late].astype(np.uint64)), doc[late], own[late], n[late] + span - 1, [None] * len(late)))
                split_up = [k for k in first if common[k]]
                if split_up:  # windows of common anchors go one by one
                    times = n[split_up]
                    d, k0 = np.repeat(doc[split_up], times), np.repeat(own[split_up], times)
                    k0 = k0 + np.arange(len(k0)) - np.repeat(np.cumsum(times) - times, times)
                    said = _stretch_texts(w, w.first[d] + k0, np.full(len(d), span))
                    first, late = _firsts(said, [(names[x], k) for x, k in zip(d.tolist(), k0.tolist(), strict=True)])
                    key = np.array([hash_words(said[k]) for k in first], np.uint64)
                    out.append((key, d[first], k0[first], np.ones(len(first), np.int64), [said[k] for k in first]))
                    out.append((mixed(k0[late].astype(np.uint64)), d[late], k0[late], np.full(len(late), span), [None] * len(late)))
                key, d, k0, times = (np.concatenate(x) for x in list(zip(*out, strict=True))[:4])
                yield pa.RecordBatch.from_arrays([
                    pa.array(key.view(np.int64)), ids.take(pa.array(d)), pa.array(k0, pa.int32()), pa.array(times, pa.int32()),
                    pa.array([x for part in out for x in part[4]], pa.binary()), versions.take(pa.array(d))],
                    names=["key", "id", "start", "n", "words", "version"])

    return map_arrow(rows, run, f"key long, id {kind}, start int, n int, words binary, version long")


def _stretch_texts(w: Words, begin: np.ndarray, length: np.ndarray) -> list[bytes]:
    """The words from each index on, joined by one space."""
    data = np.where(BLANK[w.data], np.uint8(0x20), w.data).tobytes()
    wide = np.concatenate(([0], np.cumsum(w.start[1:] - w.end[:-1] > 1)))  # gaps of more than one blank ahead of each word
    last = begin + length - 1
    ragged = (wide[last] > wide[begin]).tolist()
    out = [data[x:y] for x, y in zip(w.start[begin].tolist(), w.end[last].tolist(), strict=True)]
    for k in [k for k, r in enumerate(ragged) if r]:
        out[k] = b" ".join(out[k].split())
    return out


def _firsts(said: list, places: list[tuple]) -> tuple[list[int], list[int]]:
    """(for each distinct text the position with the least place, all others that lie behind theirs)."""
    first: dict = {}
    for k, text in enumerate(said):
        old = first.setdefault(text, k)
        if places[k] < places[old]:
            first[text] = k
    # Two texts of one id may hold the same words at the same place: neither is later.
    late = [k for k, text in enumerate(said) if places[k] > places[first[text]]]
    return list(first.values()), late


def hash_words(said: bytes) -> int:
    w = split(pa.array([said], pa.binary()))
    return int(runs(w, w.hashes(), len(w.start))[0][0])


def locate(sent: DataFrame, span: int) -> DataFrame:
    """(id, version, start, n): words to remove, from all stretches of each shard."""
    kind = dict(sent.dtypes)["id"]

    def compiled(rows: list[tuple]) -> Iterator[tuple]:
        numbers: dict[bytes, int] = {}
        texts = [tuple([numbers.setdefault(x, len(numbers) + 1) for x in words.split()]) for _, _, _, _, words, _ in rows]
        first: dict[tuple, tuple] = {}
        again: set[tuple] = set()
        for (_, doc, start, n, _, _), text in zip(rows, texts, strict=True):
            for k in range(n):
                window, at = text[k: k + span], (doc, start + k)
                old = first.get(window)
                if old is None:
                    first[window] = at
                else:
                    again.add(window)
                    if at < old:
                        first[window] = at
        if not again:
            return
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for window in again:
            automaton.add_word(window, first[window])
        automaton.make_automaton()
        for (_, doc, start, _, _, version), text in zip(rows, texts, strict=True):
            begin = stop = -1
            for end, origin in automaton.iter(text):
                at = end - span + 1
                if (doc, start + at) == origin:
                    continue
                if at > stop:
                    if stop >= 0:
                        yield doc, version, start + begin, stop - begin
                    begin = at
                stop = end + 1
            if stop >= 0:
                yield doc, version, start + begin, stop - begin

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 1, 1 << 12):
            out, rows = [], []
            data = list(zip(*(c.to_pylist() for c in table.columns), strict=True))
            out += [(row[1], row[5], row[2], row[3]) for row in data if row[4] is None]
            sent = [row for row in data if row[4] is not None]
            # Equal stretches of a shard differ in their place only: the first stands for them.
            first, late = _firsts([(row[0], row[4]) for row in sent], [row[1:3] for row in sent])
            out += [(sent[k][1], sent[k][5], sent[k][2], sent[k][3] + span - 1) for k in late]
            distinct = [sent[k] for k in first]
            shared = Counter(row[0] for row in distinct)
            for row in distinct:
                if shared[row[0]] == 1:  # no other words have this anchor
                    continue
                if len(rows) >= AUTOMATON_STRETCHES and rows[-1][0] != row[0]:
                    out += compiled(rows)
                    rows = []
                rows.append(row)
            out += compiled(rows)
            ids, versions, starts, counts = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, table.schema.field(1).type), pa.array(versions, pa.int64()), pa.array(starts, pa.int32()), pa.array(counts, pa.int32())],
                names=["id", "version", "start", "n"])

    return map_arrow(sent.repartition("key").sortWithinPartitions("key"), run, f"id {kind}, version long, start int, n int")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every document."""
    context = docs.sparkSession.sparkContext
    found = materialise(recurring(docs, text, span, anchor), "anchors")
    known, common = context.broadcast(bit_map(found)), context.broadcast(bit_map(found.filter(F.col("n") > hot)))
    marks = locate(stretches(docs, doc_id, text, known, common, span, anchor), span)
    per_document = marks.groupBy("id", "version").agg(F.collect_list(F.struct("start", "n")).alias("marks"))
    kind = dict(docs.dtypes)[doc_id]
    met = packed(docs, doc_id, text, F.xxhash64(quoted(text)).alias("version")).join(per_document, ["id", "version"], "left").select("id", "packed", F.col("marks.start").alias("starts"), F.col("marks.n").alias("counts"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n_words, removed, kept = [], [], []
                for data, starts, counts in zip(*(part.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                    words = unpack.decompress(data).split() if data else []
                    n_words.append(len(words))
                    if starts:
                        gone = np.zeros(len(words) + 1, np.int64)
                        np.add.at(gone, starts, 1)
                        np.add.at(gone, np.array(starts) + np.array(counts), -1)
                        words = [words[k] for k in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
                    removed.append(n_words[-1] - len(words))
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n_words), pa.array(removed), pa.array(kept, pa.binary()).cast(pa.string())],
                                                 names=["doc_id", "n_words", "n_removed", "kept_text"])

    return map_arrow(met, run, f"doc_id {kind}, n_words long, n_removed long, kept_text string")
