"""Line dedup with a suffix array over line numbers, sorted by distributed prefix doubling.

The corpus is a sequence of lines, each document ending it. Every place in it begins a suffix. Suffixes are ranked
by their first line, then by their first two, four, eight: the rank for the first 2h lines is the rank of the pair
(rank at the place, rank h places on), found by one sort of the distinct pairs. A pair that occurs once is dropped,
so later rounds work on what still repeats, and doubling ends when no two suffixes are equal that far.

Equal ranks are intervals of the suffix array with a common prefix. Each place but the earliest of an interval repeats an
earlier place that far; how far exactly is the common prefix of the deepest interval in which it is not the earliest.
That is found from the rounds: the earliest places of the intervals of 2h lines that share their first h lines differ
somewhere between. Such a set is split by the rank of the lines that follow, half as many each time: in a part, all but
the earliest place go on with the longer prefix, and the earliest places of all parts with the shorter one. Each place
is a row once, compared with the earliest of its set, so a round costs a row for each repeated place whatever sets hold,
and is joins by place and a minimum by part. Lines of later copies from the shortest run on are deleted.

Documents of equal text are one: all but the first repeat it from end to end, and only the first is ranked. Pairs are
counted before they are sorted, and sorted over range partitions whose totals alone reach the driver; a line that
makes up a third of the corpus is one pair in a sort, and its places are spread by adaptive execution where they meet it.

Defined results: lines end at a line feed; lines without a word are left alone and are no part of a run;
lines are equal when their characters are; earlier means a smaller id (null last), or ahead in the same
document; a run may overlap the place it repeats; rows equal in id and text are one document and treated alike; null and
empty texts have no lines; an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import bounded_rows, map_arrow, quoted
from ordermill.session import discard, materialise

MIN_RUN = 3
WORDED = r"[^\x20\x09-\x0D]"
PLACE = ["doc", "at"]


def _all_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def version(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def place_of(doc_id: Column, version: Column) -> Column:
    """Where a document stands in the corpus: by id, null last."""
    return F.struct(F.isnull(doc_id).alias("none"), doc_id.alias("id"), version.alias("version"))


def copies(rows: DataFrame) -> DataFrame:
    """(doc, copy): every document of ``rows`` (id, text), and whether one of equal text comes before it."""
    hashed = rows.select("id", version(F.col("text")).alias("v"), F.xxhash64(F.lit(1), F.coalesce("text", F.lit(""))).alias("w"))
    own = hashed.select(place_of(F.col("id"), F.col("v")).alias("doc"), "v", "w").distinct()
    lead = own.groupBy("v", "w").agg(F.min("doc").alias("lead"))
    return own.join(lead, ["v", "w"]).select("doc", (F.col("doc") != F.col("lead")).alias("copy"))


def sequences(rows: DataFrame, first: DataFrame) -> DataFrame:
    """(doc, at, line, h1, h2) of the documents in ``first``: their worded lines, ``at`` counting them and ``line`` all lines."""
    numbered = F.transform(_all_lines(F.col("text")), lambda x, i: F.struct(i.alias("line"), x.alias("said")))
    worded = F.filter(numbered, lambda x: x["said"].rlike(WORDED))
    hashed = F.transform(worded, lambda x: F.struct(x["line"].alias("line"), F.xxhash64(x["said"]).alias("h1"), F.xxhash64(F.lit(1), x["said"]).alias("h2")))
    once = rows.select(place_of(F.col("id"), version(F.col("text"))).alias("doc"), hashed.alias("lines")).dropDuplicates(["doc"])
    return once.join(first, "doc", "left_semi").select("doc", F.posexplode("lines").alias("at", "of")).select("doc", "at", "of.line", "of.h1", "of.h2")


def ranked(rows: DataFrame, a: str, b: str, *of: Column) -> DataFrame:
    """(a, b, rank) of the pairs that occur twice or more, with aggregates ``of`` their rows: how many of these are smaller, plus one."""
    pairs = rows.groupBy(a, b).agg(F.count("*").alias("n"), *of).filter("n > 1").drop("n")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema.fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.arange(done, done + n)), pa.array(np.full(n, part, np.int32))],
                                             names=[*batch.schema.names, "within", "part"])
            done += n

    ordered = pairs.repartitionByRange(a, b).sortWithinPartitions(a, b)
    stored = materialise(map_arrow(ordered, run, f"{kinds}, within long, part int"), "ranks")
    before, offsets = 0, []
    for r in stored.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():  # one row a partition
        offsets.append({"part": r.part, "before": before})
        before += r.n
    if not offsets:
        return stored.drop("part").withColumnRenamed("within", "rank")
    starts = bounded_rows(rows.sparkSession, offsets, "part: int, before: long")
    numbered = stored.join(F.broadcast(starts), "part").withColumn("rank", F.col("before") + F.col("within") + 1)
    return numbered.drop("part", "before", "within")


def _place() -> Column:
    return F.struct(*PLACE)


def doubled(places: DataFrame) -> list[DataFrame]:
    """For 1, 2, 4, ... lines: (doc, at, rank, of) of the suffixes that are equal to another one that far, ``of`` the earliest
    place of equal rank, as long as there are some."""
    rounds = []
    earliest, kept = F.min(_place()).alias("of"), [*PLACE, "rank", "of"]
    state = materialise(places.join(ranked(places, "h1", "h2", earliest), ["h1", "h2"]).select(*kept), "suffixes")
    while not state.isEmpty():
        rounds.append(state)
        step = 1 << len(rounds) - 1
        ahead = state.select("doc", (F.col("at") - step).alias("at"), F.col("rank").alias("next"))
        pairs = materialise(state.select(*PLACE, F.col("rank").alias("first")).join(ahead, PLACE), "pairs")
        state = materialise(pairs.join(ranked(pairs, "first", "next", earliest), ["first", "next"]).select(*kept), "suffixes")
        discard(pairs)
    return rounds


def _begun(own: DataFrame, deeper: DataFrame | None, length: int) -> DataFrame:
    """(of, low, doc, at): a set for each interval of ``length`` lines, of the earliest places of the intervals of twice
    as many lines in it and the places in none of these."""
    later = own.filter(_place() != F.col("of"))
    if deeper is not None:
        inner = deeper.select(*PLACE, F.col("of").alias("inner"))
        later = later.join(inner, PLACE, "left").filter(F.col("inner").isNull() | (_place() == F.col("inner")))
    return later.select("of", F.lit(length).alias("low"), *PLACE)


def _split(sets: DataFrame, own: DataFrame, length: int) -> DataFrame:
    """Each set in parts that are equal for ``length`` more lines, and the set of the first places of these parts."""
    firsts = sets.select("of", "low").distinct().select("of", "low", "of.doc", "of.at")
    behind = own.select("doc", F.col("at").alias("p"), "rank")
    met = sets.unionByName(firsts).withColumn("p", F.col("at") + F.col("low")).join(behind, ["doc", "p"], "left").drop("p")
    # A place without a rank is like no other and a part of its own.
    met = met.withColumn("rank", F.coalesce("rank", F.lit(0)))
    parts = met.filter("rank > 0").groupBy("of", "low", "rank").agg(F.min(_place()).alias("earliest"))
    told = met.join(parts, ["of", "low", "rank"], "left").filter(_place() != F.col("of"))
    longer = F.col("earliest").isNotNull() & (_place() != F.col("earliest"))
    return told.select(F.when(longer, F.col("earliest")).otherwise(F.col("of")).alias("of"),
                       F.when(longer, F.col("low") + length).otherwise(F.col("low")).alias("low"), *PLACE)


def repeated_lengths(rounds: list[DataFrame], min_run: int) -> DataFrame:
    """(doc, at, length): how many lines from a place on repeat the lines from one earlier place on, where ``min_run`` or more do.

    A row says that a place is equal to ``of``, the earliest place of its set, for the first ``low`` lines. In round k no
    two of a set are equal for 2^k lines more; after the last one ``low`` is their common prefix.
    """
    sets = None
    for k in reversed(range(len(rounds))):
        length = 1 << k
        begun = _begun(rounds[k], rounds[k + 1] if k + 1 < len(rounds) else None, length)
        now = begun if sets is None else _split(sets, rounds[k], length).unionByName(begun)
        # Sets that end below the shortest run tell nothing.
        sets = materialise(now.filter(F.col("low") + length > min_run), "sets")
    return sets.filter(F.col("low") >= min_run).select(*PLACE, F.col("low").cast("long").alias("length"))


def without_repeated_runs(docs: DataFrame, min_run: int = MIN_RUN, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_removed, longest_run, kept_text) of every document.

    ``longest_run`` is the longest stretch of its lines that one earlier place repeats from end to end, 0 below ``min_run``.
    """
    rows = docs.select(quoted(doc_id).alias("id"), quoted(text).cast("string").alias("text"))
    known = materialise(copies(rows), "documents")
    places = materialise(sequences(rows, known.filter("NOT copy").select("doc")), "lines")
    rounds = doubled(places)
    found = known.select("doc", F.array().cast("array<int>").alias("gone"), F.lit(0).cast("long").alias("longest")).filter(F.lit(False))
    if rounds:
        lengths = materialise(repeated_lengths(rounds, min_run), "lengths")
        covered = lengths.select("doc", F.explode(F.sequence("at", F.col("at") + min_run - 1)).alias("at"), "length")
        found = covered.join(places.select(*PLACE, "line"), PLACE).groupBy("doc").agg(F.collect_set("line").alias("gone"), F.max("length").alias("longest"))
    verdicts = found.withColumn("copy", F.lit(False)).unionByName(known.filter("copy"), allowMissingColumns=True)
    met = rows.withColumn("doc", place_of(F.col("id"), version(F.col("text")))).join(verdicts, "doc", "left")
    worded = F.filter("all", lambda x: x.rlike(WORDED))
    whole = F.coalesce("copy", F.lit(False)) & (F.col("n_lines") >= min_run)
    left = F.array_except(F.sequence(F.lit(0), F.size("all") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    kept = F.when(whole, F.filter("all", lambda x: ~x.rlike(WORDED))).otherwise(F.transform(left, lambda i: F.element_at("all", i + 1)))
    return met.withColumn("all", _all_lines(F.col("text"))).withColumn("n_lines", F.size(worded).cast("long")).select(
        F.col("id").alias("doc_id"), "n_lines",
        F.when(whole, F.col("n_lines")).otherwise(F.coalesce(F.size("gone"), F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.col("n_lines")).otherwise(F.coalesce("longest", F.lit(0))).cast("long").alias("longest_run"),
        F.array_join(kept, "\n").alias("kept_text"))
