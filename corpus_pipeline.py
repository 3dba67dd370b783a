"""The corpus pipeline: quality, near-duplicates, decontamination, mixing, sharding.

Each stage takes what its predecessor kept, written as Parquet and read again, and all but the last return
the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.llm import decontaminate, kneser_ney, minhash, mixing, sharding
from ordermill.llm.common import aside, table
from ordermill.session import discard, materialise

#: Near-duplicates share four fifths of their five-word shingles.
NEAR = minhash.Settings(shingle=5, share=80)
#: Every document at least once, those of small sources up to twice.
MIX = mixing.Target(entropy_share=0.95, max_repeats=2.0, at_least_once=True)
SHARDS = 16


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within their language's perplexity threshold."""
    docs, back = aside(docs, ("doc_id", "text", "lang"))
    model = kneser_ney.fit(docs, table(spark, sf_dir, "labels"))
    return back(kneser_ney.classify(docs, model).filter("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group. Texts that share an id, and texts without one, are judged each by its own text;
    of rows equal in both one stays."""
    docs, back = aside(docs, ("doc_id", "text"))
    # An id that stands for one text is its key; texts of another id, or of none, get a key of their own.
    shared = docs.groupBy("doc_id").agg((F.count_distinct(F.xxhash64("text")) > 1).alias("shared"))
    shared = materialise(shared.filter("shared AND doc_id IS NOT NULL"), "shared-ids")
    own = F.xxhash64(F.lit("text"), "doc_id", "text")
    keyed = docs.join(shared, "doc_id", "left").withColumn(
        "key", F.when(F.col("doc_id").isNull() | F.col("shared"), own).otherwise(F.col("doc_id").cast("long"))).drop("shared")
    judged = minhash.near_duplicates(keyed.select("key", "text"), NEAR, doc_id="key")
    out = judged.filter("NOT kept").select(F.col("doc_id").alias("key")).distinct()
    one = Window.partitionBy("key").orderBy(F.xxhash64("text"))
    left = keyed.join(out, "key", "left_anti").withColumn("row", F.row_number().over(one)).filter("row = 1")
    return back(left.select(docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: rows repeat as their source's blocks do."""
    docs, back = aside(docs, ("doc_id", "text", "source"))
    return back(mixing.mix(docs, MIX))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and their place in it."""
    return sharding.shard(docs, SHARDS)


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing", mix),
    ("sharding", shard),
]

#: The language model, the near-duplicate search and the aligned matches are beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        done = materialise(stage(spark, docs, sf_dir), f"stage-{name.split()[0]}")
        discard(docs)
        docs = done
    return docs
