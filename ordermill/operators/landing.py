"""Landing accepted events once per order, and filing rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.text import digest
from ordermill.operators.rules import MONEY, accepted, error_message, rejected
from ordermill.schemas import LANDED_COLUMNS

def first_per_order(events: DataFrame) -> DataFrame:
    """The earliest arrival of each order.

    ``row_number() = 1`` lets Spark keep one row per order in every map task
    before the shuffle, so an order repeated without end stays small.
    """
    first = Window.partitionBy("order_id").orderBy("arrival")
    return events.withColumn("_nth", F.row_number().over(first)).filter("_nth = 1").drop("_nth")


def accepted_orders(judged: DataFrame) -> DataFrame:
    """Typed columns of accepted events, with ``arrival``."""
    return accepted(judged).select(
        "order_id",
        F.col("topic").alias("source_topic"),
        "channel",
        "store_code",
        "customer_email",
        "product_ref",
        F.col("quantity_number").cast("int").alias("quantity"),
        F.round("unit_price", 2).cast(MONEY).alias("unit_price_eur"),
        F.round("amount", 2).cast(MONEY).alias("amount_eur"),
        "order_timestamp",
        "payload",
        "arrival",
    )


def stamped(orders: DataFrame, consumed_at: Column | None = None) -> DataFrame:
    """Shape of ``raw.streaming_orders``: event id and time of consumption added."""
    return orders.withColumns({
        "event_id": digest(F.col("order_id")),
        "consumed_at": F.current_timestamp() if consumed_at is None else consumed_at,
    }).select(*LANDED_COLUMNS)


def land(judged: DataFrame, consumed_at: Column | None = None) -> DataFrame:
    """Accepted events, one row per order.

    Duplicates are judged after validation: a rejected event never stands in
    the way of a later valid one with the same id.
    """
    return stamped(first_per_order(accepted_orders(judged)), consumed_at)


def not_yet_landed(batch: DataFrame, landed_ids: DataFrame) -> DataFrame:
    """Rows of the batch whose order has not landed before.

    Landed ids lie in buckets by order id, so the batch alone is shuffled and
    meets the history bucket by bucket, whatever the size of either.
    """
    return batch.join(landed_ids.select("order_id"), "order_id", "left_anti")


def failed_events(judged: DataFrame, failed_at: Column | None = None) -> DataFrame:
    """Shape of ``raw.failed_events``."""
    return rejected(judged).select(
        digest(F.concat_ws("|", "topic", F.to_json(F.struct("arrival")), "payload")).alias("failed_id"),
        F.col("topic").alias("source_topic"),
        "payload",
        "error_code",
        error_message().alias("error_reason"),
        (F.current_timestamp() if failed_at is None else failed_at).alias("failed_at"),
    )


def dead_letters(failed: DataFrame) -> DataFrame:
    """Envelope ``{"original": .., "error": ..}`` for the dead-letter topic.

    The original is embedded as the JSON it was; text that is no JSON is
    embedded as ``{"text": ..}``.
    """
    return failed.select(
        F.to_json(F.struct(
            F.coalesce(F.try_parse_json("payload"), F.to_variant_object(F.struct(F.col("payload").alias("text"))))
            .alias("original"),
            F.col("error_reason").alias("error"),
        )).alias("value")
    )


def batch_counters(judged: DataFrame, landed_count_column: str = "order_id") -> DataFrame:
    """One row: messages read, failed, consumed (distinct accepted orders), duplicates.

    A distinct count inside one aggregate, so counters cost one pass and carry
    partial sums only.
    """
    ok = F.col("error_code").isNull()
    return judged.agg(
        F.count("*").alias("messages_read"),
        F.count(F.when(~ok, 1)).alias("events_failed"),
        F.count_distinct(F.when(ok, F.col(landed_count_column))).alias("events_consumed"),
        (F.count(F.when(ok, 1)) - F.count_distinct(F.when(ok, F.col(landed_count_column)))).alias("events_duplicate"),
    )


def rejects_by_reason(judged: DataFrame) -> DataFrame:
    return rejected(judged).groupBy("error_code").agg(F.count("*").alias("events"))
