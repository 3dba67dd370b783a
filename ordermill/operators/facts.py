"""From landed orders to the sales fact."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.dates import date_key
from ordermill.functions.text import normalise
from ordermill.operators.lookup import lookup
from ordermill.schemas import FACT_COLUMNS, STAGED_COLUMNS
from ordermill.session import in_slices

@dataclass(frozen=True)
class Star:
    """The five dimensions, as stored tables."""

    date: DataFrame
    channel: DataFrame
    store: DataFrame
    customer: DataFrame
    product: DataFrame


def staged_orders(landed: DataFrame) -> DataFrame:
    return landed.select(*STAGED_COLUMNS)


def pending(landed: DataFrame, fact: DataFrame | None) -> DataFrame:
    """Landed orders that are not in the fact yet."""
    orders = staged_orders(landed)
    return orders if fact is None else orders.join(fact.select("order_id"), "order_id", "left_anti")


def with_processed(landed: DataFrame, fact: DataFrame) -> DataFrame:
    """Landed orders with the ``processed`` flag, derived from the fact instead of updated."""
    done = fact.select("order_id").distinct().withColumn("_done", F.lit(True))
    return landed.join(done, "order_id", "left").withColumn(
        "processed", F.coalesce("_done", F.lit(False))
    ).drop("_done")


def newly_processed(landed: DataFrame, fact_before: DataFrame | None, fact: DataFrame) -> DataFrame:
    """Orders that turn processed with this load: in the fact now and not before."""
    return pending(landed, fact_before).join(fact.select("order_id"), "order_id", "left_semi")


def resolve(orders: DataFrame, star: Star, **limits: int) -> DataFrame:
    """Staged orders with all five dimension keys, NULL where a member is missing.

    The customer dimension is matched by normalised address. A missing or
    unknown store stands for ONLINE.
    """
    counted = orders.withColumns({
        "date_key": date_key(F.col("order_timestamp")),
        "_email": normalise(F.col("customer_email")),
    })
    members = {
        "date_key": star.date.select("date_key", F.lit(True).alias("_in_calendar")),
        "channel": star.channel.select(F.col("channel_code").alias("channel"), "channel_key"),
        "store_code": star.store.select("store_code", "store_key"),
        "product_ref": star.product.select("product_ref", "product_key"),
        "_email": star.customer.filter(F.col("valid_to").isNull()).select(
            normalise(F.col("email")).alias("_email"), "customer_key"),
    }
    keyed = counted
    for key, dimension in members.items():
        keyed = lookup(keyed, dimension, key, F.col("order_id"), counted, **limits)
    online = star.store.filter(F.col("store_code") == "ONLINE").agg(F.max("store_key")).scalar()
    return keyed.withColumns({
        "store_known": F.col("store_key").isNotNull(),
        "store_key": F.coalesce("store_key", online),
    })


MISSING_MEMBER = (
    ("date", "_in_calendar"),
    ("customer", "customer_key"),
    ("product", "product_key"),
    ("channel", "channel_key"),
    ("store", "store_key"),
)


def missing_member() -> Column:
    """Name of the first dimension an order could not be resolved against."""
    return F.coalesce(*[F.when(F.col(column).isNull(), F.lit(name)) for name, column in MISSING_MEMBER])


def complete(resolved: DataFrame, *more: str) -> DataFrame:
    """Fact rows: resolved orders with every key, plus any ``more`` columns."""
    kept = resolved
    for _, column in MISSING_MEMBER:
        kept = kept.filter(F.col(column).isNotNull())
    return kept.select(*FACT_COLUMNS, *more)


def incomplete(resolved: DataFrame) -> DataFrame:
    """Orders that stay pending, each with the first missing dimension."""
    keys = [c for _, c in MISSING_MEMBER] + ["store_known", "_email"]
    return resolved.withColumn("missing", missing_member()).filter(F.col("missing").isNotNull()).drop(*keys)


def resolved_slices(orders: DataFrame, star: Star, count: int, *more: str) -> Iterator[DataFrame]:
    """Resolved orders in ``count`` slices by order id, one frame each: what facts, tests and the backlog read of them, plus any ``more`` columns.

    A frame is made when it is asked for, so what the lookups of one shuffle is gone before the next begins.
    """
    read = dict.fromkeys([*FACT_COLUMNS, *[column for _, column in MISSING_MEMBER], *more])
    for part in in_slices(orders, count, "order_id"):
        yield resolve(part, star).select(*read)


def build_fact(landed: DataFrame, star: Star, fact: DataFrame | None = None, **limits: int) -> DataFrame:
    """New fact rows. Without ``fact`` this is a full refresh over everything landed."""
    return complete(resolve(pending(landed, fact), star, **limits))


def unresolved_orders(landed: DataFrame, star: Star, fact: DataFrame | None = None, **limits: int) -> DataFrame:
    return incomplete(resolve(pending(landed, fact), star, **limits))
