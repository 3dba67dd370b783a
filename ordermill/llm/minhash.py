"""Near-duplicates: banded MinHash candidates, sequential Bayesian pruning, exact verification.

A document is the set of its distinct word shingles. Documents with equal sets are one class and go on
as one. Signatures are cut into bands; the number of bands follows from the threshold and the miss
probability. Classes that share a band are candidates. Their second, independent signatures are
compared batch by batch: given the matches so far and a uniform prior, a pair is dropped once the
probability that its similarity reaches the threshold falls below the miss probability. What survives
forms clusters; in each the full sets are compared exactly, and only pairs at or above the threshold
link. Components of these links are the result.

No pair is a row: within a band or cluster a task compares rows as arrays and gives at most one link per
row. Bands and clusters beyond a chunk are dealt by pairs of chunks, so every pair meets in some task and
no task holds a large group.

Defined results: null and empty texts have no shingles and link with nothing; a text of fewer words
than a shingle is one shingle; rows that share an id are one document of several texts; rows without an
id take the component of their equals, if any, and are kept otherwise; an empty table gives an empty result;
extra columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import map_arrow, packed, quoted
from ordermill.llm.components import components
from ordermill.llm.words import batches as text_batches
from ordermill.llm.words import mixed, runs, split
from ordermill.session import materialise

CHUNK_ROWS = 1024
CHUNK_SHINGLES = 2_000_000
TASK_SHINGLES = 500_000  # about what a task compares; its rows are few bytes


@dataclass(frozen=True)
class Settings:
    """Similarity is at least ``share`` / 100; bands of ``rows`` hashes; 64 more hashes, a byte each, to compare."""

    shingle: int = 3
    share: int = 85
    rows: int = 5
    miss: float = 1e-5
    compared: int = 64
    step: int = 16

    @property
    def bands(self) -> int:
        return math.ceil(math.log(self.miss) / math.log(1 - (self.share / 100) ** self.rows))

    def least_matches(self) -> list[int]:
        """After each step, the fewest matches of a pair that may still reach the threshold.

        Bytes match by chance once in 256. With a uniform prior the match rate given m of k is Beta(m + 1, k - m + 1),
        and its upper tail at x is the probability of at most m successes in k + 1 trials at x.
        """
        x = self.share / 100 + (1 - self.share / 100) / 256
        out = []
        for k in range(self.step, self.compared + 1, self.step):
            tail, m = 0.0, -1
            while tail < self.miss:
                m += 1
                tail += math.comb(k + 1, m) * x**m * (1 - x) ** (k + 1 - m)
            out.append(m)
        return out


def shingles(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of each text, where each text's begin): A-Z lower-cased, sorted within a text."""
    w = split(column, lower=True)
    word = w.hashes()
    h, _, first = runs(w, word, size)
    doc = np.repeat(np.arange(len(column)), np.diff(first))
    for k in range(1, size):  # texts of k words: the whole sequence is one shingle
        few = np.flatnonzero(w.counts == k)
        own = np.full(len(few), k, np.uint64)
        for i in range(k):
            own = mixed(own + word[w.first[few] + i])
        h, doc = np.concatenate((h, own)), np.concatenate((doc, few))
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])))[: len(h)]
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(column) + 1))


def _draws(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_601)
    return rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, n, dtype=np.uint64)


def signatures(h: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """The n least hashes of each set; sets are not empty. Worked through in stretches that stay in cache."""
    a, b = _draws(n)
    out = np.empty((len(first) - 1, n), np.uint64)
    at = 0
    while at < len(first) - 1:
        to = max(at + 1, int(np.searchsorted(first, first[at] + (1 << 15), "right")) - 1)
        part, starts = h[first[at]: first[to]], first[at:to] - first[at]
        for k in range(n):
            out[at:to, k] = np.minimum.reduceat((part * a[k] + b[k]) >> np.uint64(32), starts)
        at = to
    return out


def sketch(docs: DataFrame, doc_id: str, text: str, s: Settings) -> DataFrame:
    """(id, n, fp1, fp2, bands, sig) of every document; the last four are null without shingles."""
    kind = dict(docs.dtypes)[doc_id]
    rows = docs.select(quoted(doc_id).alias("id"), quoted(text).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = s.bands * s.rows
        for batch in batches:
            for lo, hi in text_batches(batch.column(1), 2 << 20):
                part = batch.slice(lo, hi - lo)
                h, first = shingles(part.column(1), s.shingle)
                n = np.diff(first)
                full = np.flatnonzero(n)
                starts = first[full]
                least = signatures(h, np.append(starts, len(h)), total + s.compared)
                fp = [np.add.reduceat(mixed(h ^ np.uint64(c)), starts) if len(starts) else np.zeros(0, np.uint64) for c in (0x51, 0xA7C3)]
                keys = np.empty((len(full), s.bands), np.uint64)
                for k in range(s.bands):
                    key = np.full(len(full), k + 1, np.uint64)
                    for c in range(k * s.rows, (k + 1) * s.rows):
                        key = mixed(key + least[:, c])
                    keys[:, k] = key
                sig = (least[:, total:] & np.uint64(255)).astype(np.uint8)
                spread = pa.array(np.where(n > 0, np.cumsum(n > 0) - 1, -1), mask=n == 0)
                columns = [
                    pa.array(fp[0].view(np.int64)), pa.array(fp[1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(full) + 1) * s.bands, pa.int32()), pa.array(keys.ravel().view(np.int64))),
                    pa.array([row.tobytes() for row in sig], pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), *[c.take(spread) for c in columns]],
                                                 names=["id", "n", "fp1", "fp2", "bands", "sig"])

    return map_arrow(rows, run, f"id {kind}, n long, fp1 long, fp2 long, bands array<long>, sig binary")


class Merged:
    """Union-find over the rows of a batch, with all roots kept flat for array work."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> list[int]:
        """Unite pairs; positions of those that united two sets."""
        parent, used = self.root, []
        for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
            while parent[x] != x:
                x = parent[x]
            while parent[y] != y:
                y = parent[y]
            if x != y:
                parent[max(x, y)] = min(x, y)
                used.append(k)
        if used:
            while True:
                flat = parent[parent]
                if (flat == parent).all():
                    break
                parent = flat
            self.root = parent
        return used


def whole_groups(batches: Iterable[pa.RecordBatch], keys: int, max_rows: int = 1 << 14) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by their first ``keys`` columns; small groups come many at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < max_rows:
            continue
        table = pa.Table.from_batches(held)
        last = [table.column(k)[-1].as_py() for k in range(keys)]
        cut = table.num_rows
        while cut and all(table.column(k)[cut - 1].as_py() == last[k] for k in range(keys)):
            cut -= 1
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def group_starts(table: pa.Table, keys: int) -> np.ndarray:
    """Which rows begin a group."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for k in range(keys):
        v = table.column(k).combine_chunks().to_numpy(zero_copy_only=False)
        new[1:] |= v[1:] != v[:-1]
    return new


def prune(candidates: DataFrame, s: Settings) -> DataFrame:
    """Links (a, b) that hold together what survives in each group of (key, i, j, id, sig)."""
    kind = dict(candidates.dtypes)["id"]
    least = s.least_matches()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 3):
            group = np.cumsum(group_starts(table, 3))
            ids = table.column(3).combine_chunks()
            code = ids.dictionary_encode()
            row, ids = code.indices.to_numpy(), code.dictionary
            sig = np.frombuffer(b"".join(table.column(4).to_pylist()), np.uint8).reshape(-1, s.compared)
            sets, links = Merged(len(ids)), []
            for lag in range(1, len(group)):
                at = np.flatnonzero(group[lag:] == group[:-lag])
                if not len(at):
                    break
                at = at[sets.root[row[at]] != sets.root[row[at + lag]]]
                matches = np.zeros(len(at), np.int64)
                for k, enough in enumerate(least):
                    part = slice(k * s.step, (k + 1) * s.step)
                    matches += (sig[at, part] == sig[at + lag, part]).sum(axis=1)
                    left = matches >= enough
                    at, matches = at[left], matches[left]
                if len(at):
                    a, b = row[at], row[at + lag]
                    used = sets.join(a, b)
                    links += [np.stack((a[used], b[used]))]
            if links:
                a, b = np.concatenate(links, axis=1)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(a)), ids.take(pa.array(b))], names=["a", "b"])

    dealt = candidates.select("key", "i", "j", "id", "sig").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return map_arrow(dealt, run, f"a {kind}, b {kind}")


def chunked(rows: DataFrame, parts: str, spread: str) -> DataFrame:
    """Each row once for every pair of chunks that its chunk is in, as (i, j) with i <= j; one pair where ``parts`` is 1.

    Any two rows of a group meet in one pair at least.
    """
    own = F.pmod(F.xxhash64(spread), F.col(parts)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col(parts).cast("int") - 1))
    return rows.withColumn("_own", own).withColumn("_other", other).withColumn("i", F.least("_own", "_other")).withColumn("j", F.greatest("_own", "_other")).drop("_own", "_other")


def candidates(classes: DataFrame, s: Settings) -> DataFrame:
    """(key, i, j, id, sig) of all classes that share a band with another."""
    banded = classes.select("id", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    parts = shared.select("key", F.ceil(F.col("n") / CHUNK_ROWS).alias("parts"))
    met = chunked(banded.join(parts, "key"), "parts", "id").select("key", "i", "j", "id")
    return met.join(classes.select("id", "sig"), "id")


def linked(inter: np.ndarray, n: np.ndarray, share: int) -> np.ndarray:
    union = n[:, None] + n[None, :] - inter
    return (100 * inter >= share * union) & (inter > 0)


def labels(link: np.ndarray) -> np.ndarray:
    """The smallest row each row is connected with."""
    label = np.arange(len(link))
    while True:
        new = np.minimum(label, np.where(link, label[None, :], len(link)).min(axis=1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def shared_counts(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many elements each two sets share, by products of 0/1 matrices over slices of the elements."""
    size = len(first) - 1
    row = np.repeat(np.arange(size), np.diff(first))
    _, column, times = np.unique(h, return_inverse=True, return_counts=True)
    useful = times[column] > 1
    row, column = row[useful], column[useful]
    _, column = np.unique(column, return_inverse=True)
    inter = np.zeros((size, size), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = max(64, (1 << 22) // max(size, 1))
    for lo in range(0, int(column.max(initial=-1)) + 1, width):
        a, b = np.searchsorted(column, (lo, lo + width))
        m = np.zeros((size, width), np.float32)
        m[row[a:b], column[a:b] - lo] = 1
        inter += m @ m.T
    out = inter.astype(np.int64)
    np.fill_diagonal(out, np.diff(first))
    return out


def verify(members: DataFrame, s: Settings, tasks: int) -> DataFrame:
    """Links (a, b) of rows whose full sets reach the threshold, enough to connect each group of (cluster, i, j, id, packed)."""
    kind = dict(members.dtypes)["id"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for table in whole_groups(batches, 3, 1 << 10):
            bounds = np.append(np.flatnonzero(group_starts(table, 3)), table.num_rows)
            ids, texts = table.column(3).combine_chunks(), table.column(4)
            at = 0
            while at < len(bounds) - 1:  # some groups at a time, a large one alone
                to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + 256, "right")) - 1)
                lo, hi = bounds[at], bounds[to]
                plain = pa.array([unpack.decompress(t) if t else b"" for t in texts.slice(lo, hi - lo).to_pylist()], pa.large_binary())
                h, first = shingles(plain, s.shingle)
                a, b = [], []
                for g in range(at, to):
                    x, y = bounds[g] - lo, bounds[g + 1] - lo
                    own = first[x: y + 1]
                    link = linked(shared_counts(h[own[0]: own[-1]], own - own[0]), np.diff(own), s.share)
                    root = labels(link)
                    moved = np.flatnonzero(root != np.arange(len(root)))
                    a.append(moved + bounds[g])
                    b.append(root[moved] + bounds[g])
                a, b = np.concatenate(a), np.concatenate(b)
                if len(a):
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(a)), ids.take(pa.array(b))], names=["a", "b"])
                at = to

    dealt = members.select("cluster", "i", "j", "id", "packed").repartition(tasks, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    return map_arrow(dealt, run, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, s: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): ``component_id`` is the smallest id reachable over links, kept where it is the own one."""
    sketched = materialise(sketch(docs, doc_id, text, s), "sketches")
    classes = materialise(
        sketched.filter("n > 0").groupBy("fp1", "fp2", "n")
        .agg(F.min("id").alias("id"), F.min_by(F.struct("bands", "sig"), "id").alias("of"))
        .select("fp1", "fp2", "n", "id", "of.bands", "of.sig"), "classes")
    known = classes.filter("id IS NOT NULL")
    survivors = components(prune(candidates(known, s), s), "a", "b")
    sized = materialise(survivors.select(F.col("node").alias("id"), F.col("root").alias("cluster"))
                        .join(known.groupBy("id").agg(F.max("n").alias("n")), "id"), "clusters")
    tasks = max(1, -(-(sized.agg(F.sum("n")).first()[0] or 0) // TASK_SHINGLES))
    parts = sized.groupBy("cluster").agg(F.ceil(F.greatest(F.count("*") / CHUNK_ROWS, F.sum("n") / CHUNK_SHINGLES)).alias("parts"))
    texts = packed(docs, doc_id, text).join(sized.select("id", "cluster"), "id")
    members = chunked(texts.join(parts, "cluster"), "parts", "id")
    found = components(verify(members, s, tasks), "a", "b")
    root = found.select(F.col("node").alias("id"), "root")
    component = classes.join(root, "id", "left").select("fp1", "fp2", "n", F.coalesce("root", "id").alias("component_id"))
    named = sketched.select("id", "n", "fp1", "fp2").join(component, ["fp1", "fp2", "n"], "left")
    component_id = F.coalesce("component_id", "id")
    return named.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component_id.alias("component_id"),
                        F.coalesce(F.col("id") == component_id, component_id.isNull()).alias("kept"))
