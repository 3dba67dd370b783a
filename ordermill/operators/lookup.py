"""Key lookups that stay balanced when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.session import materialise

# A lookup side carries a natural key of at most 255 characters and a long.
BROADCAST_ROWS = 200_000
ROWS_PER_SALT = 1_000_000
HASH_GROUPS = 1 << 16


def hot_keys(rows: DataFrame, key: str, rows_per_salt: float = ROWS_PER_SALT) -> DataFrame:
    """All keys with more rows than one task should get, and how many parts to cut them into.

    There are at most as many as ``rows`` divided by ``rows_per_salt``. Rows are counted by hash first, in few enough groups to
    add up in every map task; keys are counted only where a group has more rows than one key may have.
    """
    given = rows.select(key).filter(F.col(key).isNotNull()).withColumn("_group", F.pmod(F.xxhash64(key), F.lit(HASH_GROUPS)))
    busy = given.groupBy("_group").agg(F.count("*").alias("_rows")).filter(F.col("_rows") > rows_per_salt).select("_group")
    return (
        given.join(F.broadcast(busy), "_group", "left_semi")
        .groupBy(key)
        .agg(F.count("*").alias("_rows"))
        .filter(F.col("_rows") > rows_per_salt)
        .select(key, F.ceil(F.col("_rows") / rows_per_salt).cast("int").alias("_parts"))
    )


def lookup(rows: DataFrame, members: DataFrame, key: str, spread_on: Column, counted: DataFrame,
           broadcast_rows: int = BROADCAST_ROWS, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Left join of ``members``, unique by ``key``, whatever their size and the key's spread.

    ``counted`` is a cheap frame with the same keys as ``rows``, such as the
    stored table they come from; keys are counted there and not behind the
    lookups ``rows`` went through already.

    ``members`` is counted first (a footer read for a stored table). Few enough
    are broadcast, which ``broadcast_rows`` bounds and 0 rules out. Otherwise the join shuffles, with every hot key cut into
    parts: rows take a part by the hash of ``spread_on``, a column that differs
    from row to row, and members of a hot key are repeated once per part. Rows without key match nothing and are spread
    over all tasks. No row is dropped on either path.
    """
    if members.count() <= broadcast_rows:
        return rows.join(F.broadcast(members), key, "left")

    hot = materialise(hot_keys(counted, key, rows_per_salt), "hot-keys")
    if hot.count() <= BROADCAST_ROWS:
        hot = F.broadcast(hot)
    spread = F.xxhash64(spread_on)
    part = F.when(F.col(key).isNull(), F.pmod(spread, F.lit(1 << 20))).otherwise(
        F.pmod(spread, F.coalesce(F.col("_parts"), F.lit(1)))
    )
    left = rows.join(hot, key, "left").withColumn("_part", part.cast("int")).drop("_parts")
    right = (
        members.join(hot, key, "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)))
        .drop("_parts")
    )
    return left.join(right, [key, "_part"], "left").drop("_part")


def split(rows: DataFrame, members: DataFrame, key: str, found: bool, **limits: int) -> DataFrame:
    """Rows whose key is (or is not) among ``members``: a semi or anti-join that stays balanced."""
    marked = lookup(rows, members.select(key, F.lit(True).alias("_found")), key, F.struct("*"), rows, **limits)
    return marked.filter(F.col("_found").isNotNull() if found else F.col("_found").isNull()).drop("_found")
