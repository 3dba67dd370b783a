"""Mixing sources to target weights by temperature.

Token shares of the sources are raised to an exponent and normalised. The exponent is found by
repeated section: the one nearest to 1 whose weights reach a target entropy, raised again if a source
would be repeated beyond the limit. A source's weight gives its budget of tokens. The budget is met in
blocks: every block is a permutation of the whole source under its own seed, the last one is cut where
the budget ends. Rows repeat once per block, so no document comes twice before every other of its
source has come once.

Sums are made per source, and for the cut per source and slice of the permutation; the cut is looked
for in one slice of each source only, so a source that holds most rows is no group of its own anywhere.
Texts are not shuffled: rows meet their source's plan, a few numbers, and decide on their own.

Defined results: a null source is a source of its own; a null or empty text has no tokens and rides
along at its place in the permutation; a source without any token has no weight and is taken once, as it costs
nothing; a table without any has no budget and gives an empty result, unless every document is asked for; repeated rows go
together at the cut; an empty table gives an empty result; columns named like an added one are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import quoted, without
from ordermill.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
GRID = 32
ROUNDS = 6
SLICE_BITS = 12
NO_SOURCE = "\0none"


def tokens_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _draw(doc_id: Column, block: Column, seed: int) -> Column:
    """A document's place in a block's permutation."""
    return F.xxhash64(F.lit(seed), block.cast("long"), F.coalesce(doc_id.cast("string"), F.lit("")))


@dataclass(frozen=True)
class Target:
    """Either or both limits; ``budget`` in tokens (none: as many as there are), or every document once at least."""

    entropy_share: float | None = 0.95  # of the largest possible entropy, log(number of sources)
    max_repeats: float | None = 4.0
    budget: int | None = None
    at_least_once: bool = False


def exponent(totals: DataFrame, target: Target) -> tuple[float, float, int]:
    """(exponent, sum of powered shares, budget) for stored (source, tokens).

    Each round weighs up GRID + 1 exponents in one aggregate and narrows the interval GRID-fold.
    """
    whole, n = totals.agg(F.sum("tokens"), F.count("*")).first()
    share = F.col("tokens") / F.lit(float(whole))

    def figures(exponents: list[float]) -> list[tuple[float, float, float]]:
        """(sum of powers, entropy, most repeats) for each exponent."""
        aggregates = []
        for a in exponents:
            power = F.pow(share, F.lit(a))
            aggregates += [F.sum(power), F.sum(power * F.log(share))]
        low, high = F.min(share), F.max(share)
        row = totals.agg(*aggregates, low, high).first()
        least, most = row[-2], row[-1]
        out = []
        for k, a in enumerate(exponents):
            z, logs = row[2 * k], row[2 * k + 1]
            over = most ** (1 - a) * z if target.at_least_once else (target.budget or whole) / whole
            out.append((z, math.log(z) - a * logs / z, over * least ** (a - 1) / z))
        return out

    def section(right) -> float:
        """The largest exponent in 0 to 1 for which ``right`` holds, given that it then holds for smaller ones."""
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            grid = [low + (high - low) * k / GRID for k in range(GRID + 1)]
            ok = [right(f) for f in figures(grid)]
            if ok[-1]:
                return high
            k = max((i for i, x in enumerate(ok) if x), default=0)
            low, high = grid[k], grid[k + 1]
        return low

    a = 1.0
    if target.entropy_share is not None and n > 1:
        wanted = target.entropy_share * math.log(n) - 1e-12
        a = section(lambda f: f[1] >= wanted)
    if target.max_repeats is not None and figures([a])[0][2] > target.max_repeats:
        # Repeats fall as the exponent rises: the smallest exponent that keeps the limit.
        a = max(a, section(lambda f: f[2] > target.max_repeats))
    z = figures([a])[0][0]
    most = totals.agg(F.max(share)).first()[0]
    budget = math.ceil(whole * most ** (1 - a) * z) if target.at_least_once else (target.budget or whole)
    return a, z, budget


def plan(docs: DataFrame, target: Target, seed: int = 17, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """(one row a source: ``source_key``, tokens, weight, budget, full blocks, and the last draw taken of the block after them;
    one row a document: ``doc_id``, ``source_key``, ``n_tokens``)."""
    digest = materialise(docs.select(
        quoted(doc_id).alias("doc_id"), F.coalesce(quoted(source).cast("string"), F.lit(NO_SOURCE)).alias("source_key"),
        tokens_of(quoted(text)).alias("n_tokens")), "mix-tokens")
    every = materialise(digest.groupBy("source_key").agg(F.sum("n_tokens").alias("tokens")), "mix-sources")
    totals = every.filter("tokens > 0")
    silent = every.filter("tokens = 0").select("source_key", "tokens", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("budget"),
                                               F.lit(1).cast("long").alias("blocks"), F.lit(None).cast("long").alias("cut"))
    if totals.isEmpty():
        return (silent if target.at_least_once else silent.limit(0)), digest
    a, z, budget = exponent(totals, target)
    whole = totals.agg(F.sum("tokens")).first()[0]
    weight = F.pow(F.col("tokens") / F.lit(float(whole)), F.lit(a)) / F.lit(z)
    own = F.round(weight * F.lit(float(budget)))
    least = F.col("tokens") if target.at_least_once else F.lit(0)
    sources = (
        totals.withColumn("weight", weight).withColumn("budget", F.greatest(own, least).cast("long"))
        .withColumn("blocks", F.expr("budget div tokens")).withColumn("rest", F.expr("budget % tokens"))
    )
    drawn = digest.join(sources.select("source_key", "blocks", "rest"), "source_key").withColumn("draw", _draw(F.col("doc_id"), F.col("blocks"), seed))
    drawn = drawn.withColumn("slice", F.shiftright("draw", 64 - SLICE_BITS))
    sums = drawn.groupBy("source_key", "slice").agg(F.sum("n_tokens").alias("n"), F.max("rest").alias("rest"))
    upto = F.sum("n").over(Window.partitionBy("source_key").orderBy("slice"))
    edge = (
        sums.withColumn("upto", upto).filter("upto > rest").groupBy("source_key")
        .agg(F.min(F.struct("slice", (F.col("upto") - F.col("n")).alias("before"))).alias("edge"))
        .select("source_key", F.col("edge.slice").alias("slice"), F.col("edge.before").alias("before"))
    )
    inside = drawn.join(edge, ["source_key", "slice"]).withColumn(
        "upto", F.col("before") + F.sum("n_tokens").over(Window.partitionBy("source_key").orderBy("draw")))
    last = inside.groupBy("source_key").agg(
        F.max(F.when(F.col("upto") <= F.col("rest"), F.col("draw"))).alias("within"), F.max("slice").alias("slice"))
    bottom = F.when(F.col("slice") > -(1 << (SLICE_BITS - 1)), F.shiftleft("slice", 64 - SLICE_BITS) - 1)
    cuts = last.select("source_key", F.coalesce("within", bottom).alias("cut"))
    heard = sources.join(cuts, "source_key", "left").select(*silent.columns)
    return materialise(heard.unionByName(silent), "mix-plan"), digest


def realise(rows: DataFrame, sources: DataFrame, seed: int = 17, doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """``rows`` once for every block that takes them, with ``block`` added; no shuffle while the plan is small enough to send."""
    base = without(rows, ("block",))
    plans = sources.select(F.col("source_key").alias("_key"), F.col("blocks").alias("_blocks"), F.col("cut").alias("_cut"))
    taken = F.coalesce(_draw(quoted(doc_id), F.col("_blocks"), seed) <= F.col("_cut"), F.lit(False))
    upto = F.col("_blocks") + taken.cast("long")
    key = F.coalesce(quoted(source).cast("string"), F.lit(NO_SOURCE))
    met = base.withColumn("_source", key).join(plans, F.col("_source") == F.col("_key"))
    times = met.withColumn("_upto", upto).filter("_upto > 0")
    return times.select(*[quoted(c) for c in base.columns], F.explode(F.sequence(F.lit(0), (F.col("_upto") - 1).cast("int"))).alias("block"))


def mix(docs: DataFrame, target: Target = Target(), seed: int = 17, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """``docs`` mixed: each row once for every ``block`` of its source that takes it."""
    sources, _ = plan(docs, target, seed, text, doc_id, source)
    return realise(docs, sources, seed, doc_id, source)


def schedule(docs: DataFrame, target: Target = Target(), seed: int = 17, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """(doc_id, source, block, position, tokens_before, n_tokens): the mix in order, without texts.

    ``position`` counts from 0 in each block; ``tokens_before`` counts the source's tokens ahead of this row
    over all its blocks, so rows of all sources by ``tokens_before`` over their source's budget are the mix
    at its weights from beginning to end.
    """
    sources, digest = plan(docs, target, seed, text, doc_id, source)
    taken = realise(digest.withColumnRenamed("source_key", "key"), sources, seed, "doc_id", "key")
    drawn = taken.withColumn("draw", _draw(F.col("doc_id"), F.col("block"), seed)).withColumn("slice", F.shiftright("draw", 64 - SLICE_BITS))
    sums = drawn.groupBy("key", "block", "slice").agg(F.count("*").alias("rows"), F.sum("n_tokens").alias("tokens"))
    before = Window.partitionBy("key", "block").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sums.select("key", "block", "slice", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_ahead") for c in ("rows", "tokens")])
    own = Window.partitionBy("key", "block", "slice").orderBy("draw", "doc_id", "n_tokens")
    placed = drawn.withColumn("at", F.row_number().over(own) - 1).withColumn(
        "sofar", F.coalesce(F.sum("n_tokens").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    totals = sources.select(F.col("source_key").alias("key"), "tokens")
    return placed.join(ahead, ["key", "block", "slice"]).join(totals, "key").select(
        "doc_id", F.when(F.col("key") != NO_SOURCE, F.col("key")).alias("source"), "block",
        (F.col("rows_ahead") + F.col("at")).alias("position"),
        (F.col("block") * F.col("tokens") + F.col("tokens_ahead") + F.col("sofar")).cast("long").alias("tokens_before"), "n_tokens")
