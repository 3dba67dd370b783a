"""Ranked lexical search with bag deduplication.

Every item of a small table ranks all documents by a sum over its terms: a term's weight falls with the number of documents
that hold it, its share rises with its occurrences in the document and falls with the document's length. All but the
weights' logarithm is whole-number arithmetic, so scores and ties are exact.

1. Bags. Documents are read once; of each only the terms of the items' vocabulary and their counts are kept, packed in
   bytes, with the number of all its terms. The bags are stored; texts are not read again.
2. Statistics over all documents: how many have terms, how many terms they have, in how many each vocabulary term occurs.
3. Classes. Documents with the same bag and the same length factor have the same score for every item. They are grouped by a
   hash, the bag itself and the factor, so equal hashes of different bags stay apart; copies are combined in every task
   before the shuffle, so a group of any size is one row of each task.
4. Scores. Each class is scored once for all items: a task sums the shares of its classes' terms into an array of classes by
   items, and hands on the ``top`` best classes of each item, by score and by the least id among their members.
   The best documents of an item lie in its best classes, as each class before has a member ahead of them.
5. Members. Only the chosen classes are expanded: their members by ascending id, ``top`` at most of each class and task,
   and the best of all classes' members are the result.

The items are the query set. Their terms are counted by Spark; they go to the tasks in blocks of at most ITEMS items and
TERMS postings, and each block is one pass over the documents, so no broadcast grows with the items.

Defined results: null and empty texts have no terms and are found by no item, nor do they count as documents; items without
terms have no rows; an item row given twice counts once, an item id with two texts is two items, each with its own ranks;
rows that share a doc_id are documents of their own, and documents without an id come after all others of equal score; empty
tables give an empty result; extra columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ordermill.llm import words as W
from ordermill.llm.common import map_arrow, quoted
from ordermill.session import materialise

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 10
ITEMS = 1_000  # items of a block at most
TERMS = 100_000  # terms of a block's items at most, about
CELLS = 1 << 18  # classes by items that a task scores at once
SPREAD = 1 << 20  # postings of these classes' terms that are summed up at once
_TERM_BYTE = np.zeros(256, bool)
_TERM_BYTE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_BLANKED = np.where(_TERM_BYTE, W.LOWER, np.uint8(0x20))


def split_terms(column: pa.Array) -> W.Words:
    """The terms of each text, A-Z lower-cased: all other bytes but those of terms are blanks."""
    data, offsets = W.text_buffers(column)
    clean = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(_BLANKED[data])])
    return W.split(clean)


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, item_id, term, times): the distinct terms of every distinct item row; ``item`` tells rows apart."""
    rows = items.select(quoted(item_id).alias("item_id"), quoted(text).cast("string").alias("text")).filter("text IS NOT NULL").distinct()
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    said = rows.select("item_id", F.md5("text").alias("version"), F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term"))
    return said.groupBy("item_id", "version", "term").agg(F.count("*").alias("times"))


def item_blocks(terms: DataFrame, most_items: int, most_terms: int) -> Iterator[tuple[list, dict[bytes, int], np.ndarray, np.ndarray, np.ndarray]]:
    """Items in blocks: (item ids, number of each term, and as arrays the postings: first of each term, item, times).

    Rows are dealt by the digest of the item, a few blocks more than the bounds ask for, so that blocks stay below them.
    """
    held = terms.agg(F.count("*").alias("terms"), F.count_distinct(F.struct("item_id", "version")).alias("items")).first()
    n = max(-(-held["items"] // most_items), -(-held["terms"] // most_terms))
    n = n if n < 2 else 2 * n
    for k in range(n):
        part = terms.filter(F.pmod(F.xxhash64("version", "item_id"), F.lit(n)) == k).orderBy("item_id", "version", "term")
        found = part.toArrow()
        if not found.num_rows:
            continue
        ids, versions, said, times = (found.column(c).to_pylist() for c in ("item_id", "version", "term", "times"))
        items: dict[tuple, int] = {}
        vocabulary: dict[bytes, int] = {}
        item = np.array([items.setdefault(x, len(items)) for x in zip(ids, versions, strict=True)])
        term = np.array([vocabulary.setdefault(x.encode(), len(vocabulary)) for x in said])
        order = np.argsort(term, kind="stable")
        first = np.searchsorted(term[order], np.arange(len(vocabulary) + 1))
        yield [x for x, _ in items], vocabulary, first, item[order], np.array(times, np.int64)[order]


def pack(terms: np.ndarray, times: np.ndarray) -> bytes:
    return np.stack((terms, times)).astype(np.int32).tobytes()


def unpack(bags: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bag of each entry, term, times) of a list of bags."""
    sizes = np.array([len(b) // 8 for b in bags], np.int64)
    flat = np.frombuffer(b"".join(bags), np.int32).astype(np.int64)
    row = np.repeat(np.arange(len(bags)), sizes)
    at = np.arange(len(row)) + np.repeat(np.cumsum(sizes) - sizes, sizes)  # two runs of numbers in each bag
    return row, flat[at], flat[at + sizes[row]]


def bags(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str, text: str) -> DataFrame:
    """(doc_id, n_terms, bag): terms of the vocabulary with their counts, in order of the terms' numbers; empty without any."""
    rows = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        names = list(known)
        lexicon = W.split(pa.array(names, pa.binary()))
        h = lexicon.hashes()
        order = np.argsort(h)
        sorted_h = h[order]
        for batch in batches:
            for lo, hi in W.batches(batch.column(1), 2 << 20):
                ids = batch.column(0).slice(lo, hi - lo)
                w = split_terms(batch.column(1).slice(lo, hi - lo))
                mine = w.hashes()
                slot = np.searchsorted(sorted_h, mine).clip(max=len(sorted_h) - 1)
                hit = np.flatnonzero(sorted_h[slot] == mine)
                term = order[slot[hit]]
                document = w.document()[hit]
                pair, where, times = np.unique(document * len(names) + term, return_index=True, return_counts=True)
                data = w.data.tobytes()
                # A hash is only a hint: one place of every pair is compared with the term itself.
                spans = zip(w.start[hit[where]].tolist(), w.end[hit[where]].tolist(), (pair % len(names)).tolist(), strict=True)
                right = np.fromiter((data[a:b] == names[t] for a, b, t in spans), bool, len(pair))
                pair, times = pair[right], times[right]
                ends = np.searchsorted(pair // len(names), np.arange(len(ids) + 1))
                packed = [pack(pair[a:b] % len(names), times[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([ids, pa.array(w.counts.astype(np.int64)), pa.array(packed, pa.binary())], names=["doc_id", "n_terms", "bag"])

    kind = dict(rows.dtypes)["doc_id"]
    return map_arrow(rows, run, f"doc_id {kind}, n_terms long, bag binary")


def holders(stored: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each of the ``size`` vocabulary terms; tasks hand on one sum a term."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size, np.int64)
        for batch in batches:
            sums += np.bincount(unpack(batch.column(0).to_pylist())[1], minlength=size)
        seen = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(sums[seen])], names=["term", "n"])

    out = np.zeros(size, np.int64)
    for r in map_arrow(stored.select("bag"), run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r.term] = r.n
    return out


def weights(documents: int, holding: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in holding], np.int64)


def scores(bags: list[bytes], factor: np.ndarray, weight: np.ndarray, first: np.ndarray, item: np.ndarray, times: np.ndarray, n_items: int) -> np.ndarray:
    """Score of every bag (with its length factor) for every item."""
    row, term, tf = unpack(bags)
    share = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * factor[row]))
    out = np.zeros(len(bags) * n_items, np.int64)
    upto = np.cumsum(first[term + 1] - first[term])
    lo = 0
    while lo < len(term):  # entries are spread to their postings in slices of bounded size
        done = int(upto[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(upto, done + SPREAD, "right")))
        part = slice(lo, hi)
        n = first[term[part] + 1] - first[term[part]]
        at = np.repeat(first[term[part]] - upto[part] + done + n, n) + np.arange(n.sum())
        np.add.at(out, np.repeat(row[part], n) * n_items + item[at], np.repeat(share[part], n) * times[at])
        lo = hi
    return out.reshape(len(bags), n_items)


def best_classes(classes: DataFrame, weight: np.ndarray, postings: tuple[np.ndarray, ...], n_items: int, top: int) -> DataFrame:
    """(item, score, key, bag, factor): the ``top`` classes of each item."""
    sent = classes.sparkSession.sparkContext.broadcast((weight, *postings))
    rows = classes.select("least", "key", "bag", "factor")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(CELLS // n_items, 1)
        held: list[list[tuple]] = [[] for _ in range(n_items)]  # the best so far, with the class
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                least, key, bag, factor = (c.to_pylist() for c in batch.slice(lo, step).columns)
                found = scores(bag, np.array(factor, np.int64), *sent.value, n_items)
                for i in np.flatnonzero(found.any(axis=0)).tolist():
                    column = found[:, i]
                    bound = max(1, held[i][-1][0] if len(held[i]) == top else 1)
                    rows_in = np.flatnonzero(column >= bound)
                    if len(rows_in) > 4 * top:  # ties at the bound stay
                        rows_in = rows_in[column[rows_in] >= np.partition(column[rows_in], len(rows_in) - top)[len(rows_in) - top]]
                    fresh = [(int(column[r]), least[r], key[r], bag[r], factor[r]) for r in rows_in.tolist()]
                    held[i] = sorted(held[i] + fresh, key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0, x[2], x[3], x[4]))[:top]
        rows = [(i, s, least, k, b, m) for i, best in enumerate(held) for s, least, k, b, m in best]
        if rows:
            item, score, least, key, bag, factor = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), pa.array(score, pa.int64()), pa.array(least, kind), pa.array(key, pa.int64()), pa.array(bag, pa.binary()), pa.array(factor, pa.int64())],
                names=["item", "score", "least", "key", "bag", "factor"])

    kind = to_arrow_type(classes.schema["least"].dataType)
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("score", T.LongType()), classes.schema["least"],
                           T.StructField("key", T.LongType()), T.StructField("bag", T.BinaryType()), T.StructField("factor", T.LongType())])
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("least").asc_nulls_last(), "key", "bag", "factor")
    return map_arrow(rows, run, schema).withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= top).drop("nth", "least")


def rank(docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
         item_text: str = "text", most_items: int = ITEMS, most_terms: int = TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every item with a score above 0."""
    spark = docs.sparkSession
    terms = materialise(item_terms(items, item_id, item_text), "item-terms")
    kinds = items.select(quoted(item_id).alias("item_id")).schema["item_id"], docs.select(quoted(doc_id).alias("doc_id")).schema["doc_id"]
    schema = T.StructType([kinds[0], T.StructField("rank", T.IntegerType()), kinds[1], T.StructField("score", T.LongType())])
    out = spark.createDataFrame([], schema)
    for ids, vocabulary, *postings in item_blocks(terms, most_items, most_terms):
        stored = materialise(bags(docs, vocabulary, doc_id, text), "bags")
        count, total = stored.agg(F.count_if(F.col("n_terms") > 0), F.sum("n_terms")).first()
        if not total:
            continue
        weight = weights(count, holders(stored, len(vocabulary)))
        factored = stored.filter(F.length("bag") > 0).withColumn(
            "factor", F.expr(f"cast(25 + (75 * n_terms * {count}L) div {total}L as bigint)")).withColumn("key", F.xxhash64("bag", "factor"))
        classes = factored.groupBy("key", "bag", "factor").agg(F.min("doc_id").alias("least"))
        chosen = materialise(best_classes(classes, weight, tuple(postings), len(ids), top), "best-classes")
        # At most ``top`` hashes an item: a block's bounds bound them too.
        wanted = F.broadcast(chosen.select("key").distinct())
        order = Window.partitionBy("key", "bag", "factor").orderBy(F.col("doc_id").asc_nulls_last())
        members = factored.join(wanted, "key", "left_semi").withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= top)
        ranked = members.select("key", "bag", "factor", "doc_id").join(chosen, ["key", "bag", "factor"]).withColumn(
            "rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())))
        names = spark.createDataFrame(list(enumerate(ids)), T.StructType([T.StructField("item", T.IntegerType()), kinds[0]]))
        found = ranked.filter(F.col("rank") <= top).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = out.union(found)
    return out
