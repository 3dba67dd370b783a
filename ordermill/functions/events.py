"""Reading one order message: JSON text to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every field is read as text so that a wrong type can be told from a missing
# value. The quantity is read as VARIANT: "2" and 2 are different there.
MESSAGE_SCHEMA = """
    order_id string, customer_email string, channel string, store_code string,
    product_ref string, quantity variant, unit_price_eur string,
    amount_eur string, order_timestamp string
"""
NUMBER_TYPE = "^(BIGINT|DECIMAL|DOUBLE|FLOAT)"
ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"


def _struct(fields: str) -> str:
    """DDL of columns as that of one struct."""
    return T.StructType.fromDDL(fields).simpleString()


def parse_timestamp(text: Column) -> Column:
    """ISO timestamp with optional offset or ``Z``; NULL when unreadable."""
    return F.when(text.rlike(ISO_DATE), text.try_cast("timestamp"))


def one_value(text: Column) -> Column:
    """Whether a text is one whole JSON value and nothing behind it.

    The parser stops at the end of the first value. Put into a list, text that is
    cut off, goes on or holds a second value gives no list or one of another length.
    Numbers that are none (NaN, Infinity) are left to the rules, so zeros stand for them here.
    """
    odd = text.contains("NaN") | text.contains("Infinity")
    text = F.when(odd, F.regexp_replace(text, r"([:\[,]\s*)(?:NaN|-?Infinity)(?=\s*[,}\]])", "$10")).otherwise(text)
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    first_of_two = F.json_array_length(F.concat(F.lit("["), text, F.lit(",0]"))) == 2
    return F.coalesce(alone & first_of_two, F.lit(False))


def parse_events(events: DataFrame) -> DataFrame:
    """``(topic, arrival, value)`` to one row per message with typed columns.

    ``arrival`` is any orderable column telling which message came first.
    Columns ending in ``_text`` hold what the message said, the others the
    typed value or NULL when it does not convert.
    """
    # Read as a list, a text that is cut off, goes on or holds several objects gives no list or one of
    # another length, all in one parse; only a text that closes the list itself needs a second look.
    # Generated rows are computed once. A plain projection would be copied into
    # every later filter and expression, and with it the JSON parser.
    as_list = F.from_json(F.concat(F.lit("["), F.col("value"), F.lit("]")), f"array<{_struct(MESSAGE_SCHEMA)}>")
    message = events.select("topic", "arrival", F.col("value").alias("payload"), F.explode(F.array(as_list)).alias("said"))
    first = F.get("said", F.lit(0))
    closes = F.when(F.col("payload").rlike(r"\}\s*\]"), ~one_value(F.col("payload"))).otherwise(F.lit(False))
    fields = message.select(
        "topic",
        "arrival",
        "payload",
        (F.coalesce(F.size("said") != 1, F.lit(True)) | first.isNull() | closes).alias("bad_json"),
        first.alias("m"),
    ).select("topic", "arrival", "payload", "bad_json", "m.*")
    fields = fields.select(
        "topic",
        "arrival",
        "payload",
        "bad_json",
        "order_id",
        "customer_email",
        "channel",
        "store_code",
        "product_ref",
        F.col("quantity").cast("string").alias("quantity_text"),
        F.schema_of_variant("quantity").rlike(NUMBER_TYPE).alias("quantity_is_number"),
        F.col("unit_price_eur").alias("unit_price_text"),
        F.col("amount_eur").alias("amount_text"),
        F.col("order_timestamp").alias("timestamp_text"),
    )
    return fields.select(
        "*",
        F.when(F.col("quantity_is_number"), F.col("quantity_text").try_cast("double")).alias("quantity_number"),
        F.col("unit_price_text").try_cast("double").alias("unit_price"),
        F.col("amount_text").try_cast("double").alias("amount"),
        parse_timestamp(F.col("timestamp_text")).alias("order_timestamp"),
    )
