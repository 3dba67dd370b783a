"""Registered queries of the corpus operators: each applies one to its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import archive, chat, decontaminate, extraction, kneser_ney, lines, minhash, mixing, periods, phrases, ranking, rules, sharding
from ordermill.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


@query
def op2_histogram_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes."""
    placed = sharding.shard(table(spark, sf_dir, "documents"), 16)
    return placed.select(
        "doc_id", sharding.size_of(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op5_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = rules.cascade(docs, measures=True)
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("doc_id", *rules.MEASURES, base_failed.alias("base_failed"), (~base_failed & F.col("kept")).alias("kept"))


@query
def op4_seekable_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back."""
    folder = archive.archive_folder(spark)
    index = archive.write(archive.with_roles(table(spark, sf_dir, "pages")), folder)
    return archive.read(index, folder)


@query
def op10_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every maximal conversation, rendered."""
    return chat.collapse_and_render(table(spark, sf_dir, "conversations"))


@query
def op1_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 95 % of the largest source entropy, at most four times each, as many tokens as there are."""
    return mixing.schedule(table(spark, sf_dir, "documents"), mixing.Target(entropy_share=0.95, max_repeats=4.0))


@query
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items that they hold a passage of."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of every document."""
    model = kneser_ney.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return kneser_ney.judged(model.scores, model.limits)


@query
def op7_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near-duplicates: three-word shingles, similarity of 0.85 or more."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), minhash.Settings(shingle=3, share=85))


@query
def op8_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows of 20 that start earlier in the corpus."""
    kept = phrases.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op6_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of three lines or more that occur earlier in the corpus."""
    kept = lines.without_repeated_runs(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", "longest_run", F.sha2("kept_text", 256).alias("kept_sha256"))


def with_cycles(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the documents, by a checksum of the id, go on from some word by repeating what follows it."""
    draw = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    # Only the tenth is cut into words: an array of words takes many times its text.
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    worded = docs.select("doc_id", "text", draw.alias("h")).withColumn("w", words)
    numbered = worded.selectExpr("*", "h div 10 AS g", "size(w) AS n").selectExpr("*", "int(g % greatest(n, 1)) AS a").selectExpr(
        "*", "int(1 + (n - a) div (3 + g % 8)) AS p")
    cycled = "slice(concat(slice(w, 1, a), flatten(array_repeat(slice(w, a + 1, p), int(ceil((n - a) / p))))), 1, n)"
    return numbered.selectExpr("doc_id", f"CASE WHEN h % 10 = 0 AND n > 0 THEN array_join({cycled}, ' ') ELSE text END AS text")


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs of words, and its text with each of them cut to its first period."""
    found = periods.collapsed(with_cycles(table(spark, sf_dir, "documents")))
    # Runs are in order of start and period, so the first of equal exponents is the one wanted.
    best = ("aggregate(runs, cast(null AS struct<start: long, length: long, period: long>), (best, r) -> "
            "if(best IS NULL OR r.length * best.period > best.length * r.period, r, best))")
    listed = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    return found.selectExpr("doc_id", "kept_text", "cast(size(runs) AS long) AS n_runs", f"{best} AS best", f"{listed} AS listed").selectExpr(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", "1000 * best.length div best.period AS exponent_milli",
        "sha2(listed, 256) AS runs_sha256", "sha2(kept_text, 256) AS collapsed_sha256")


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranking.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return extraction.main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
