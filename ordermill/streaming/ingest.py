"""Micro-batch ingestion: validate, file rejects, land each order once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordermill.functions.events import parse_events
from ordermill.operators import landing, rules
from ordermill.schemas import FAILED_EVENTS, STREAMING_ORDERS
from ordermill.session import discard, in_slices, materialise, materialise_slices, sized, slices_for, together
from ordermill.sources import ids, subjects
from ordermill.sources.tables import Warehouse

BATCH = "batch_id"
CADENCE = "2 minutes"
# What landing and rejects read of a judged message.
KEPT_COLUMNS = ("topic", "arrival", "payload", "error_code", "order_id", "customer_email", "channel", "store_code",
                "product_ref", "quantity_number", "unit_price", "amount", "order_timestamp")


@dataclass(frozen=True)
class Counters:
    messages_read: int
    events_failed: int
    events_consumed: int
    events_duplicate: int


def landed_ids(house: Warehouse) -> str:
    """Name of the table of all order ids ever landed, in buckets by id, with the batch they came with.

    It holds no personal data and outlives an erasure: an erased order does not land again.
    """
    return ids.index(house, "raw", "landed_ids")


def ingest_batch(events: DataFrame | list[DataFrame], batch_id: int, house: Warehouse,
                 dead_letter_sink: Callable[[DataFrame], None] | None = None) -> Counters:
    """Write one batch of messages to landing, rejects and dead letters.

    Each output is a slice named after the batch, and orders landed by the
    same batch do not count as landed before. A batch that is delivered again
    therefore writes the same rows to the same place. ``dead_letter_sink`` gets
    the stored dead letters ``(value)``, such as ``publish_dead_letters``; a
    batch delivered again hands them on again. Judged messages are stored aside, not cached: a batch may be larger than the
    executors' memory. A large batch lands in slices by order id, and may be given as several frames, which are judged
    one after another: so what is shuffled is one slice at a time, and judged messages go as they are filed.
    """
    given = events if isinstance(events, list) else [events]
    frames = [rules.judge(parse_events(e)).select(*KEPT_COLUMNS) for e in given]
    # Rejects may have no id; their text spreads them.
    key = F.when(F.col("error_code").isNull(), F.col("order_id")).otherwise(F.col("payload"))
    parts = materialise_slices(frames, "judged", len(frames), key) if len(frames) > 1 else [materialise(frames[0], "judged")]
    try:
        judged, spark = reduce(DataFrame.unionByName, parts), house.spark
        valid = F.when(F.col("error_code").isNull(), F.col("order_id"))
        counts = judged.agg(
            F.count("*").alias("read"), F.count("error_code").alias("failed"), F.min(valid).alias("least"), F.max(valid).alias("most")
        ).first()
        accepted = counts["read"] - counts["failed"]
        ids.fit(house, "raw", "landed_ids", accepted)
        landed_before = ids.near(house, "raw", "landed_ids", counts["least"], counts["most"]).filter(F.col(ids.LOAD) != batch_id)
        begin_slices(house, batch_id)
        slices = slices_for(counts["read"]) if len(parts) == 1 else 1
        if len(parts) * slices == 1:
            new = landing.not_yet_landed(landing.land(judged), landed_before)
            with sized(spark, counts["read"]):
                together(
                    lambda: house.write_slice(new, "raw", "streaming_orders", BATCH, batch_id),
                    lambda: house.write_slice(landing.failed_events(judged), "raw", "failed_events", BATCH, batch_id),
                )
        else:
            now = F.timestamp_micros(F.lit(spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]))
            with sized(spark, counts["read"] // (len(parts) * slices)), house.writing(
                    "raw", "streaming_orders", BATCH, batch_id) as land, house.writing("raw", "failed_events", BATCH, batch_id) as fail:
                for part in parts:
                    fail(landing.failed_events(part, now))
                    for piece in in_slices(part, slices, "order_id"):
                        land(landing.not_yet_landed(landing.land(piece, now), landed_before))
                    discard(part)
    finally:
        discard(*parts)
    filed = failed_events(house).filter(F.col(BATCH) == batch_id)
    house.write_slice(landing.dead_letters(filed), "raw", "dead_letters", BATCH, batch_id)
    begin_slices(house, batch_id)  # again: an erasure may have entered what was there before
    here = landed_orders(house).filter(F.col(BATCH) == batch_id)
    _, consumed = together(
        lambda: ids.add(house, "raw", "landed_ids", here.select("order_id", F.lit(batch_id).alias(ids.LOAD))),
        here.count,
    )
    if dead_letter_sink is not None:
        dead_letter_sink(dead_letters(house).filter(F.col(BATCH) == batch_id).select("value"))
    return Counters(counts["read"], counts["failed"], consumed, accepted - consumed)


def begin_slices(house: Warehouse, batch_id: int) -> None:
    """What is known of the persons in a batch holds no more when it is written again."""
    for table in ("streaming_orders", "failed_events", "dead_letters"):
        subjects.outdate(house, table, [batch_id])


def start_ingest(events: DataFrame, house: Warehouse, checkpoint: str, continuous: bool = False,
                 cadence: str = CADENCE, after_batch=None,
                 dead_letter_sink: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
    """Start ingestion of a streaming frame ``(topic, arrival, value)``.

    Offsets live in the checkpoint. ``continuous`` runs at the given cadence;
    otherwise everything available is read in bounded batches and the query
    ends, for use under an external scheduler. ``after_batch(counters, id)``
    runs after each batch.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        counters = ingest_batch(batch, batch_id, house, dead_letter_sink)
        if after_batch is not None:
            after_batch(counters, batch_id)

    writer = events.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": cadence} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()


def landed_orders(house: Warehouse) -> DataFrame:
    return house.read("raw", "streaming_orders", STREAMING_ORDERS + f", {BATCH} int")


def failed_events(house: Warehouse) -> DataFrame:
    return house.read("raw", "failed_events", FAILED_EVENTS + f", {BATCH} int")


def dead_letters(house: Warehouse) -> DataFrame:
    return house.read("raw", "dead_letters", f"value string, {BATCH} int")


def accepted_stream(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Accepted orders of a stream, one per id within the lateness bound.

    State is bounded by the time of arrival, not of the event: an order dated
    years back passes as any other, and an id that arrives again later than
    ``late`` after its first arrival passes once more. Exact landing is ``start_ingest``.
    """
    judged = rules.judge(parse_events(events))
    orders = landing.stamped(landing.accepted_orders(judged))
    return orders.withWatermark("consumed_at", late).dropDuplicatesWithinWatermark(["order_id"])


def revenue_stream(orders: DataFrame, window: str = "5 minutes", late: str | None = None) -> DataFrame:
    """Revenue per channel and event-time window of a stream of accepted orders.

    Every order counts however late it is; state is one row per window and
    channel, so it is bounded by the calendar. ``late`` closes windows and drops
    what comes after, for sinks that only take final rows.
    """
    bounded = orders if late is None else orders.withWatermark("order_timestamp", late)
    return (
        bounded.groupBy(F.window("order_timestamp", window), "channel")
        .agg(F.count("*").alias("orders"), F.sum("amount_eur").alias("revenue_eur"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "channel",
                "orders", "revenue_eur")
    )
