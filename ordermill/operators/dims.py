"""Calendar, static members and key-stable dimension loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions import dates
from ordermill.functions.keys import assign_keys

# Static members and calendar reach.
CHANNEL_MEMBERS = (
    ("web", "Site e-commerce"),
    ("app", "Application mobile"),
    ("store", "Boutique physique"),
)
ONLINE_STORE = ("ONLINE", "En ligne", "Paris", "National")
CALENDAR_DAYS = (400, 30)
CALENDAR_EXTENSION_DAYS = (30, 30)
IMAGE_BASE_URL = "http://localhost:9000/product-images/"

STORE_ATTRIBUTES = ("store_name", "city", "region")
CUSTOMER_ATTRIBUTES = ("golden_id", "email", "first_name", "last_name", "phone", "consent_marketing",
                       "consent_date", "last_activity", "is_active_12m", "email_valid")
PRODUCT_ATTRIBUTES = ("product_name", "category", "price_eur", "stock_qty", "image_object_key", "image_url")


def calendar(spans: DataFrame, padded: bool = False) -> DataFrame:
    """Calendar rows for a one-row frame of ``start`` and ``end`` dates."""
    days = spans.select(F.explode(F.sequence("start", "end", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    day = F.col("full_date")
    return days.select(
        dates.date_key(day).alias("date_key"),
        "full_date",
        dates.day_of_week(day).alias("day_of_week"),
        dates.day_name(day, padded).alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.month(day).alias("month_num"),
        dates.month_name(day, padded).alias("month_name"),
        F.quarter(day).alias("quarter_num"),
        F.year(day).alias("year_num"),
    )


def calendar_around(spark: SparkSession, as_of: Column | None = None,
                    days: tuple[int, int] = CALENDAR_DAYS, padded: bool = False) -> DataFrame:
    """Calendar from ``days[0]`` before to ``days[1]`` after a day, today by default."""
    day = F.current_date() if as_of is None else as_of
    span = spark.range(1).select(F.date_sub(day, days[0]).alias("start"), F.date_add(day, days[1]).alias("end"))
    return calendar(span, padded)


def missing_members(incoming: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Incoming rows whose key is not present yet."""
    return incoming.join(existing.select(key), key, "left_anti")


def one_per_key(incoming: DataFrame, natural_key: str, attributes: tuple[str, ...]) -> DataFrame:
    """Of rows that share a natural key, the one whose attributes sort first; rows without key are left out."""
    kept = incoming.filter(F.col(natural_key).isNotNull()).groupBy(natural_key)
    return kept.agg(F.min(F.struct(*attributes)).alias("_best")).select(natural_key, "_best.*")


def load_members(existing: DataFrame | None, incoming: DataFrame, natural_key: str, key_name: str,
                 attributes: tuple[str, ...], update: bool = True, repeated: bool = True) -> DataFrame:
    """Upsert by natural key; members already there keep their surrogate key.

    With ``update`` false, a member already there keeps its attributes too.
    ``repeated`` false tells that ``incoming`` holds each natural key once.
    """
    columns = [key_name, natural_key, *attributes]
    if repeated:
        incoming = one_per_key(incoming, natural_key, attributes)
    if existing is None:
        return assign_keys(incoming.select(natural_key, *attributes), natural_key, key_name).select(*columns)
    kept = existing.select(*columns)
    if update:
        fresh = incoming.select(natural_key, F.struct(*attributes).alias("_new"))
        kept = kept.join(fresh, natural_key, "left").select(
            key_name,
            natural_key,
            *[F.when(F.col("_new").isNull(), F.col(a)).otherwise(F.col(f"_new.{a}")).alias(a) for a in attributes],
        )
    last_key = existing.agg(F.coalesce(F.max(key_name), F.lit(0))).scalar()
    added = assign_keys(
        missing_members(incoming, existing, natural_key).select(natural_key, *attributes),
        natural_key, key_name, after=last_key,
    )
    return kept.unionByName(added.select(*columns))


def dim_channel(spark: SparkSession, existing: DataFrame | None = None) -> DataFrame:
    members = spark.createDataFrame(CHANNEL_MEMBERS, "channel_code string, channel_name string")
    return load_members(existing, members, "channel_code", "channel_key", ("channel_name",), update=False)


def dim_store(stores: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Stores by code with updated attributes, and the ONLINE member unless it is there."""
    columns = ["store_code", *STORE_ATTRIBUTES]
    online = missing_members(stores.sparkSession.createDataFrame([ONLINE_STORE], columns), stores, "store_code")
    if existing is not None:
        online = missing_members(online, existing, "store_code")
    members = stores.select(*columns).unionByName(online.select(*columns))
    return load_members(existing, members, "store_code", "store_key", STORE_ATTRIBUTES)


def dim_customer(golden: DataFrame, existing: DataFrame | None = None, loaded_at: Column | None = None) -> DataFrame:
    """Current customers; one loaded before keeps its key and the time it was first loaded."""
    now = F.current_timestamp() if loaded_at is None else loaded_at
    loaded = load_members(existing, golden, "email_normalized", "customer_key", CUSTOMER_ATTRIBUTES,
                          repeated=False)
    since = now
    if existing is not None:
        loaded = loaded.join(existing.select("customer_key", F.col("valid_from").alias("_since")), "customer_key", "left")
        since = F.coalesce(F.col("_since"), now)
    return loaded.withColumns({"valid_from": since, "valid_to": F.lit(None).cast("timestamp")}).drop("_since")


def dim_product(golden: DataFrame, existing: DataFrame | None = None, image_base_url: str = IMAGE_BASE_URL) -> DataFrame:
    with_url = golden.withColumn("image_url", F.concat(F.lit(image_base_url), "image_object_key"))
    return load_members(existing, with_url, "product_ref", "product_key", PRODUCT_ATTRIBUTES, repeated=False)


def _row_hash(attributes: tuple[str, ...]) -> Column:
    """Digest of the attributes; NULL and empty text differ."""
    return F.sha2(F.to_json(F.struct(*attributes), {"ignoreNullFields": "false"}), 256)


def customer_history(history: DataFrame, golden: DataFrame, changed_at: Column,
                     attributes: tuple[str, ...] = CUSTOMER_ATTRIBUTES) -> DataFrame:
    """Close rows whose attributes changed and open a new row for them.

    ``history`` holds ``email_normalized``, the attributes, ``valid_from`` and
    ``valid_to``. Customers missing from the load stay as they are.
    """
    key = "email_normalized"
    columns = [key, *attributes, "valid_from", "valid_to"]
    current = history.filter(F.col("valid_to").isNull())
    incoming = golden.select(key, *attributes)
    before = current.select(key, _row_hash(attributes).alias("_old"))
    compared = incoming.withColumn("_new", _row_hash(attributes)).join(before, key, "left")
    opened = compared.filter(F.col("_old").isNull() | (F.col("_old") != F.col("_new"))).select(
        key, *attributes, changed_at.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to")
    )
    after = incoming.select(key, _row_hash(attributes).alias("_new"))
    kept = (
        current.withColumn("_old", _row_hash(attributes))
        .join(after, key, "left")
        .withColumn("valid_to", F.when(F.col("_new").isNotNull() & (F.col("_old") != F.col("_new")), changed_at))
    )
    past = history.filter(F.col("valid_to").isNotNull())
    return past.select(*columns).unionByName(kept.select(*columns)).unionByName(opened.select(*columns))
