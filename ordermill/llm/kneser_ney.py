"""Quality by perplexity under an interpolated modified Kneser-Ney model of characters.

One model per language is trained on the trusted text: five-character sequences are counted in each
task, the counts summed over all tasks, and lower orders follow as continuation counts, all as
distributed tables. The corpus's own distinct sequences are then joined with these counts, order by order, which
gives each its probability. The table is dealt into shards by hash; tasks read the shards from the
shared folder and sum the log probabilities of each whole document. A third of the trusted documents is held
out of the counts; its quantile by language is the threshold. What is compared is how far a document's mean lies from
its language's, in units of the spread that texts of its length have, so short and long texts meet one limit.

Characters are code points up to U+0FFF, those beyond share codes, and white space counts as one
space, so a sequence of five is one long. What is gathered is one row per distinct sequence and task.

Defined results: a null or empty text has no characters and is kept, with no perplexity; a null
language is a language of its own; languages without trusted text both in the counts and held out share a model and a
threshold of all trusted text, and where nothing at all is held out every document is kept;
repeated rows are scored each; empty tables give an empty result; repeated labels count as trusted when one of them is;
a column named like an added one is replaced, others pass through.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.llm.common import map_arrow, packed, quoted, without
from ordermill.llm.words import batches as text_batches
from ordermill.session import discard, materialise, scratch_folder

ORDER = 5
BITS = 12
HOLD_OUT = 3  # one of so many trusted documents
POOLED_WEIGHT = 100  # held-out documents that the quantile over all languages counts for in each
SPREAD_CHARS = 1000  # characters from which texts differ more by what they are than by their length
QUANTILE = 0.99
SHARD_ROWS = 4_000_000
HELD_ROWS = 600_000  # sequences that a task holds while it counts
NO_LANGUAGE = "\0none"
POOLED = "\0pooled"  # the model of all trusted text
TRUST = "quality = 1 AND toxic = 0"


def sequences(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(every five-character sequence as a long, where each text's begin): one per character, the first ones padded."""
    lead = "\0" * (ORDER - 1)
    plain = [" ".join(t.split()) if t else "" for t in texts]
    c = np.frombuffer((lead + lead.join(plain)).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    c = np.where(c < 1 << BITS, c, (1 << BITS - 1) + c % ((1 << BITS - 1) - 1))
    n = len(c) - ORDER + 1
    g = np.zeros(max(n, 0), np.int64)
    for i in range(ORDER):
        g = (g << BITS) | c[i: i + n]
    lengths = np.array([len(t) for t in plain], np.int64)
    first = np.concatenate(([0], np.cumsum(lengths)))
    at = np.arange(first[-1]) + np.repeat(np.arange(len(plain)) * (ORDER - 1), lengths)
    return g[at], first


def language(column: Column, known: list[str] | None = None) -> Column:
    """The language whose model a row takes: its own or, with ``known``, the pooled one for all others."""
    own = F.coalesce(column.cast("string"), F.lit(NO_LANGUAGE))
    return own if known is None else F.when(own.isin([*known, POOLED]), own).otherwise(F.lit(POOLED))


def _held_out(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("held out"), doc_id), F.lit(HOLD_OUT)) == 0


def with_models(docs: DataFrame, trusted: DataFrame, doc_id: str, lang: str) -> list[str]:
    """The languages with trusted documents both in the counts and held out."""
    marked = trusted.select(quoted(doc_id).alias("id")).distinct().withColumn("held", _held_out(F.col("id")))
    rows = docs.select(quoted(doc_id).alias("id"), language(quoted(lang)).alias("lang")).join(marked, "id")
    return [r.lang for r in rows.groupBy("lang").agg(F.countDistinct("held").alias("n")).filter("n = 2").orderBy("lang").collect()]


def count(docs: DataFrame, trusted: DataFrame, doc_id: str, text: str, lang: str) -> DataFrame:
    """(lang, gram, n): every distinct sequence of the corpus, with its count in the trusted text that is not held out."""
    marked = trusted.select(quoted(doc_id).alias("id")).distinct().withColumn("in_training", ~_held_out(F.col("id")))
    rows = packed(docs, doc_id, text, language(quoted(lang)).alias("lang")).join(marked, "id", "left").select("lang", "packed", F.coalesce("in_training", F.lit(False)).alias("in_training"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(name: str) -> tuple[np.ndarray, np.ndarray]:
            grams, n = (np.concatenate(x) for x in zip(*held[name], strict=True))
            keys, inverse = np.unique(grams, return_inverse=True)
            return keys, np.bincount(inverse, n, minlength=len(keys)).astype(np.int64)

        def out(name: str) -> pa.RecordBatch:
            keys, n = merged(name)
            del held[name]
            return pa.RecordBatch.from_arrays([pa.array([name]).take(pa.array(np.zeros(len(keys), np.int32))), pa.array(keys), pa.array(n)], names=["lang", "gram", "n"])

        for batch in batches:
            for lo, hi in text_batches(batch.column(1), 1 << 18):
                part = batch.slice(lo, hi - lo).to_pydict()
                groups: dict[tuple[str, bool], list[bytes]] = {}
                for name, data, training in zip(part["lang"], part["packed"], part["in_training"], strict=True):
                    groups.setdefault((name, training), []).append(data)
                for (name, training), texts in groups.items():
                    grams, n = np.unique(sequences([unpack.decompress(t).decode() if t else "" for t in texts])[0], return_counts=True)
                    held.setdefault(name, []).append((grams, n * training))
                if sum(len(k) for parts in held.values() for k, _ in parts) > HELD_ROWS:
                    for name in held:
                        held[name] = [merged(name)]
                    while sum(len(parts[0][0]) for parts in held.values()) > HELD_ROWS // 2:
                        yield out(max(held, key=lambda x: len(held[x][0][0])))
        while held:
            yield out(next(iter(held)))

    counted = map_arrow(rows, run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _discounts(level: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3): the modified discounts from the counts of counts."""
    n = {k: F.count(F.when(F.col("c") == k, 1)).cast("double") for k in (1, 2, 3, 4)}
    of = level.groupBy("lang").agg(*[n[k].alias(f"n{k}") for k in n])
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def d(k: int) -> Column:
        raw = k - (k + 1) * y * F.col(f"n{k + 1}") / F.nullif(F.col(f"n{k}"), F.lit(0.0))
        return F.least(F.greatest(F.coalesce(raw, F.lit(k / 2)), F.lit(0.05)), F.lit(float(k)))

    return materialise(of.select("lang", *[d(k).alias(f"d{k}") for k in (1, 2, 3)]), "kn-discounts")


def probabilities(counts: DataFrame) -> DataFrame:
    """(lang, gram, logp) of every sequence in ``counts``: orders from one character to five, each joined with its counts."""
    def cut(order: int) -> Column:
        return F.col("gram").bitwiseAND(F.lit((1 << BITS * order) - 1))

    levels = {ORDER: counts.filter("n > 0").select("lang", "gram", F.col("n").alias("c"))}
    for k in range(ORDER - 1, 0, -1):  # how many different characters a sequence is seen behind
        levels[k] = materialise(levels[k + 1].groupBy("lang", cut(k).alias("gram")).agg(F.count("*").alias("c")), f"kn-{k}")
    below = None
    for k in range(1, ORDER + 1):
        wanted = (counts.select("lang", cut(k).alias("gram")).distinct() if k < ORDER else counts.select("lang", "gram")).withColumn("head", F.shiftright("gram", BITS))
        discount = _discounts(levels[k])
        c = F.col("c")
        d = F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))
        heads = (
            levels[k].join(discount, "lang").groupBy("lang", F.shiftright("gram", BITS).alias("head"))
            .agg(F.sum("c").alias("total"), (F.sum(d) / F.sum("c")).alias("gamma"), F.count("*").alias("kinds"))
        )
        seen = levels[k].join(discount, "lang").select("lang", "gram", F.greatest(c - d, F.lit(0.0)).alias("left"))
        met = wanted.join(heads, ["lang", "head"], "left").join(seen, ["lang", "gram"], "left")
        if below is None:
            lower = F.lit(1.0) / (F.coalesce("kinds", F.lit(0)) + 1)
        else:
            met = met.withColumn("tail", cut(k - 1)).join(below.select("lang", F.col("gram").alias("tail"), F.col("p").alias("q")), ["lang", "tail"])
            lower = F.col("q")
        p = F.coalesce(F.coalesce("left", F.lit(0.0)) / F.col("total") + F.col("gamma") * lower, lower)
        below = met.select("lang", "gram", p.alias("p"))
        if k < ORDER:
            below = materialise(below, f"kn-p{k}")
    return below.select("lang", "gram", F.log("p").alias("logp"))


def store_shards(model: DataFrame, rows: int, shard_rows: int = SHARD_ROWS) -> tuple[str, int]:
    """Deal the table into shards of about ``shard_rows``; the folder and how many."""
    n = max(1, -(-rows // shard_rows))
    folder = scratch_folder(model.sparkSession, "kn-shards")
    dealt = model.withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(n)))
    (dealt.repartition(max(8, n), "shard", F.pmod(F.hash("gram"), F.lit(8))).write.partitionBy("shard").mode("overwrite").parquet(f"{folder}/model"))
    return f"{folder}/model", n


def score(docs: DataFrame, folder: str, shards: int, text: str, lang: str, known: list[str] | None = None) -> DataFrame:
    """``docs`` with ``_lang``, ``_nll`` (sum of negative log probabilities) and ``_chars``."""
    base = without(docs, ("_lang", "_nll", "_chars")).withColumn("_lang", language(quoted(lang), known))
    columns = base.columns
    at, lang_at = columns.index(text), len(columns) - 1
    schema = T.StructType([*base.schema.fields, T.StructField("_nll", T.DoubleType()), T.StructField("_chars", T.LongType())])

    def load(shard: int) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        store, path = fs.FileSystem.from_uri(f"{folder}/shard={shard}")
        parts: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for file in store.get_file_info(fs.FileSelector(path, allow_not_found=True)):
            if not file.path.endswith(".parquet"):
                continue
            with store.open_input_file(file.path) as source:
                for batch in pq.ParquetFile(source).iter_batches(1 << 16, columns=["lang", "gram", "logp"], use_threads=False):
                    names = batch.column(0).dictionary_encode()
                    codes, gram, logp = names.indices.to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
                    for k, name in enumerate(names.dictionary.to_pylist()):
                        own = codes == k
                        parts.setdefault(name, []).append((gram[own], logp[own].astype(np.float32)))
        out = {}
        for name in list(parts):
            gram, logp = (np.concatenate(x) for x in zip(*parts.pop(name), strict=True))
            order = np.argsort(gram)
            out[name] = (gram[order], logp[order])
        return out

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = load(0) if shards == 1 else None
        for batch in batches:
            for lo, hi in text_batches(batch.column(at), 1 << 20):
                part = batch.slice(lo, hi - lo)
                texts, langs = part.column(at).to_pylist(), np.array(part.column(lang_at).to_pylist(), dtype=object)
                nll, chars = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
                groups = []
                for name in set(langs):
                    own = np.flatnonzero(langs == name)
                    grams, first = sequences([texts[i] for i in own])
                    chars[own] = np.diff(first)
                    groups.append((name, own, *np.unique(grams, return_inverse=True), first))
                for shard in range(shards):
                    model = only if only is not None else load(shard)
                    for name, own, grams, inverse, first in groups:
                        keys, logp = model.get(name, (np.zeros(0, np.int64), np.zeros(0)))
                        if len(keys) and len(grams):
                            slot = np.searchsorted(keys, grams).clip(max=len(keys) - 1)
                            value = np.where(keys[slot] == grams, -logp[slot].astype(np.float64), 0.0)[inverse]
                            nll[own] += np.diff(np.concatenate(([0.0], np.cumsum(value)))[first])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(nll), pa.array(chars)], names=[*columns, "_nll", "_chars"])

    return map_arrow(base, run, schema)


def thresholds(scored: DataFrame, trusted: DataFrame, doc_id: str, quantile: float = QUANTILE, weight: float = POOLED_WEIGHT) -> DataFrame:
    """(lang, mean, deviation) from the held-out trusted documents of each language: their mean and their quantile.

    The quantile is drawn to that over all languages, as if ``weight`` documents had it.
    """
    own = trusted.select(quoted(doc_id).alias("id")).distinct().filter(_held_out(F.col("id")))
    rows = scored.filter("_chars > 0").join(own, quoted(doc_id) == F.col("id")).select(F.col("_lang").alias("lang"), "_nll", "_chars")
    rows = materialise(rows, "kn-held-out")
    mean = materialise(rows.groupBy("lang").agg((F.sum("_nll") / F.sum("_chars")).alias("mean")), "kn-means")
    rated = rows.join(mean, "lang").withColumn("deviation", (F.col("_nll") / F.col("_chars") / F.nullif(F.col("mean"), F.lit(0.0)) - 1) / spread())
    of = F.percentile_approx("deviation", F.lit(quantile), 10_000)
    pooled = rated.filter(F.col("lang") != POOLED).agg(of).first()[0]
    q = rated.groupBy("lang").agg(F.first("mean").alias("mean"), of.alias("own"), F.count("*").alias("n"))
    drawn = F.col("own") if pooled is None else (F.col("n") * F.col("own") + F.lit(weight * pooled)) / (F.col("n") + F.lit(weight))
    return q.select("lang", "mean", drawn.alias("deviation"))


def spread() -> Column:
    """How far means of texts of so many characters lie apart, up to a factor: few words vary more."""
    return F.sqrt(1 / F.nullif(F.col("_chars"), F.lit(0)) + F.lit(1 / SPREAD_CHARS))


@dataclass
class Model:
    """Where the shards lie and how many, the thresholds by language, and the pass that scores every document."""

    folder: str
    shards: int
    limits: DataFrame
    scores: DataFrame
    known: list[str]


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", trust: str = TRUST) -> Model:
    """Train on the trusted documents and set the thresholds by those held out.

    Only rows whose id may be held out are scored here, a third of all, without moving a text; ``scores`` is
    the pass over all documents, run by whoever reads it.
    """
    trusted = labels.filter(trust)
    known = with_models(docs, trusted, doc_id, lang)
    base = docs.select(quoted(doc_id), quoted(text), quoted(lang))
    rows = base.withColumn(lang, language(quoted(lang), known))
    if rows.filter(quoted(lang) == POOLED).limit(1).count():  # all trusted text again, for the pooled model and its threshold
        ids = trusted.select(quoted(doc_id).alias("_id")).distinct()
        again = rows.filter(quoted(lang) != POOLED).join(ids, quoted(doc_id) == F.col("_id"), "left_semi")
        rows = rows.union(again.withColumn(lang, F.lit(POOLED)))
    counts = materialise(count(rows, trusted, doc_id, text, lang), "kn-counts")
    folder, shards = store_shards(probabilities(counts), counts.count())
    held = score(rows.filter(_held_out(quoted(doc_id))), folder, shards, text, lang)
    limits = materialise(thresholds(held, trusted, doc_id), "kn-thresholds")
    discard(counts)
    scores = score(base, folder, shards, text, lang, known).select(quoted(doc_id), "_lang", "_nll", "_chars")
    return Model(folder, shards, limits, scores, known)


def judged(scored: DataFrame, limits: DataFrame) -> DataFrame:
    """``scored`` with ``perplexity``, ``threshold`` (nats per character, of a text of its length) and ``kept`` in place of the sums."""
    of = limits.select(F.col("lang").alias("_of"), F.col("mean").alias("_mean"), F.col("deviation").alias("_deviation"))
    met = without(scored, ("perplexity", "threshold", "kept")).join(of, F.col("_lang") == F.col("_of"), "left")
    rate, limit = F.col("_nll") / F.nullif(F.col("_chars"), F.lit(0)), F.col("_mean") * (1 + F.col("_deviation") * spread())
    return met.withColumns({
        "perplexity": F.exp(rate),
        "threshold": limit,
        "kept": F.coalesce(rate <= limit, F.lit(True)) | (F.col("_chars") == 0),
    }).drop("_lang", "_nll", "_chars", "_of", "_mean", "_deviation")


def classify(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs``, whole rows, with ``perplexity``, ``threshold`` and ``kept``; rows don't move."""
    return judged(score(docs, model.folder, model.shards, text, lang, model.known), model.limits)
