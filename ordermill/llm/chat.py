"""Chat logs: collapse cumulative snapshots, then render what is left.

A logging service often stores a conversation again after every turn. Rolling prefix hashes find the
snapshots: the hash of a conversation's first k turns is the running combination of a hash of each
turn's position, role and text. A conversation whose whole hash is the hash of a proper prefix of
another goes; of equal ones the smallest id stays. Maximal conversations are rendered with role marks.

Hashes are two 64-bit values, so chance matches need some 10**19 prefixes. Sums over turns are made
in blocks of turns and then over blocks, so no task holds a whole conversation, and prefixes are made
unique before the joins, so a first turn that a third of all conversations share is one row there.
Native DataFrame operations only.

Defined results: turns are ordered by ``turn`` (null first), then role and text; repeated rows are
turns of their own; null roles and texts count as such and are rendered empty, role as ``unknown``;
rows without an id are one conversation; an empty table gives an empty result; extra columns are
left out. Role marks inside a text are written with a space, so that a text can't forge a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import quoted

TURNS_PER_BLOCK = 1024
TURNS_PER_PART = 256


def _turn_hash(salt: int) -> Column:
    """Depends on the position too, so the running xor over turns stands for their sequence."""
    return F.xxhash64(F.lit(salt), "position", F.isnull("role"), F.coalesce("role", F.lit("")), F.isnull("text"), F.coalesce("text", F.lit("")))


def positioned(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
               block: int = TURNS_PER_BLOCK) -> DataFrame:
    """(conv_id, block, position, role, text, n_turns): positions count from 1 in each conversation."""
    rows = conversations.select(
        quoted(conv_id).alias("conv_id"), quoted(turn).cast("long").alias("turn"),
        quoted(role).cast("string").alias("role"), quoted(text).cast("string").alias("text"),
    ).withColumn("block", F.coalesce(F.floor(F.col("turn") / block), F.lit(-(2**62))))
    sizes = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
        F.sum("n").over(Window.partitionBy("conv_id")).alias("n_turns"))
    own = Window.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text"))
    numbered = rows.withColumn("rank", F.row_number().over(own))
    return numbered.join(offsets, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).select(
        "conv_id", "block", (F.col("offset") + F.col("rank")).alias("position"), "role", "text", "n_turns")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, position, n_turns, h1, h2): the hash of each conversation's first ``position`` turns."""
    hashed = turns.select("conv_id", "block", "position", "n_turns", _turn_hash(1).alias("t1"), _turn_hash(2).alias("t2"))
    per_block = hashed.groupBy("conv_id", "block").agg(F.bit_xor("t1").alias("t1"), F.bit_xor("t2").alias("t2"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_block.select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"),
        *[F.coalesce(F.bit_xor(t).over(before), F.lit(0)).alias(f"{t}_before") for t in ("t1", "t2")])
    own = Window.partitionBy("conv_id", "block").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    rolled = hashed.withColumns({f"{t}_own": F.bit_xor(t).over(own) for t in ("t1", "t2")})
    return rolled.join(carried, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).select(
        "conv_id", "position", "n_turns", *[F.col(f"{t}_own").bitwiseXOR(F.col(f"{t}_before")).alias(h) for t, h in (("t1", "h1"), ("t2", "h2"))])


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_copies): conversations that no longer one begins with, the smallest id of equal ones."""
    rolled = prefixes(turns)
    whole = rolled.filter("position = n_turns").groupBy("position", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    proper = rolled.filter("position < n_turns").select("position", "h1", "h2").distinct()
    return whole.join(proper, ["position", "h1", "h2"], "left_anti").select("conv_id", "n_copies")


def render(turns: DataFrame, per_part: int = TURNS_PER_PART) -> DataFrame:
    """(conv_id, part, n_turns, rendered): a conversation in parts of ``per_part`` turns, to be read one after another."""
    safe = F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |"))
    who = F.replace(F.coalesce("role", F.lit("unknown")), F.lit("<|"), F.lit("< |"))
    said = F.concat(F.lit("<|"), who, F.lit("|>\n"), safe, F.lit("\n<|end|>\n"))
    lines = turns.select("conv_id", "n_turns", F.floor((F.col("position") - 1) / per_part).cast("int").alias("part"), F.struct("position", said.alias("said")).alias("line"))
    return lines.groupBy("conv_id", "part").agg(F.max("n_turns").alias("n_turns"), F.sort_array(F.collect_list("line")).alias("lines")).select(
        "conv_id", "part", "n_turns", F.array_join(F.col("lines.said"), "").alias("rendered"))


def collapse_and_render(conversations: DataFrame, **columns: str) -> DataFrame:
    """(conv_id, part, n_turns, n_copies, rendered) of every maximal conversation."""
    turns = positioned(conversations, **columns)
    kept = maximal(turns).select(F.col("conv_id").alias("kept_id"), "n_copies")
    same = F.col("conv_id").eqNullSafe(F.col("kept_id"))
    parts = render(turns.join(kept.select("kept_id"), same, "left_semi"))
    return parts.join(kept, same).select("conv_id", "part", "n_turns", "n_copies", "rendered")
