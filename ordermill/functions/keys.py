"""Dense surrogate keys without a one-task global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def assign_keys(members: DataFrame, natural_key: str, key_name: str,
                after: Column | int = 0, prefix: int = 3) -> DataFrame:
    """Number members ``after + 1 ..`` in the order of ``md5(natural_key)``.

    Members fall into ``16**prefix`` buckets by the first digits of the digest,
    which are even whatever the keys look like. Each bucket is numbered by
    itself and shifted by the sizes of the buckets before it; that list of
    sizes is the only frame that is broadcast, and has at most ``16**prefix``
    rows. The order depends on the keys alone, so a lost task numbers its rows
    the same way again.
    """
    hashed = members.withColumn("_digest", F.md5(F.col(natural_key).cast("string"))).withColumn(
        "_bucket", F.substring("_digest", 1, prefix)
    )
    sizes = hashed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_digest", natural_key))
    start = after if isinstance(after, Column) else F.lit(after)
    numbered = hashed.withColumn("_rank", rank).join(F.broadcast(offsets), "_bucket")
    return numbered.select(
        (start + F.col("_offset") + F.col("_rank")).cast("long").alias(key_name),
        *members.columns,
    )
