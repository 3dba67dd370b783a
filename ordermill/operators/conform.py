"""Several source systems into one table, and one best row per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.dates import active_since
from ordermill.functions.text import EMAIL_PATTERN, digest, is_blank, matches, normalise
from ordermill.schemas import CUSTOMERS_UNIFIED_COLUMNS, PRODUCTS_UNIFIED_COLUMNS

# Lower wins.
CUSTOMER_PRIORITY = {"crm": 1, "web": 2, "pos": 3}
PRODUCT_PRIORITY = {"erp": 1, "web": 2}


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def unify_customers(sources: dict[str, DataFrame]) -> DataFrame:
    """Stack customer sources, tagged with system and priority. Any source may be absent."""
    tagged = [
        source.withColumns({
            "source_system": F.lit(system),
            "source_priority": F.lit(CUSTOMER_PRIORITY[system]),
            "email_normalized": normalise(F.col("email")),
        })
        for system, source in sources.items()
    ]
    stacked = _union(tagged)
    if "store_code" not in stacked.columns:
        stacked = stacked.withColumn("store_code", F.lit(None).cast("string"))
    return stacked.select(*CUSTOMERS_UNIFIED_COLUMNS)


def unify_products(erp: DataFrame, web: DataFrame) -> DataFrame:
    tagged = [
        erp.withColumns({"source_ref": F.col("product_ref"), "source_system": F.lit("erp"),
                         "source_priority": F.lit(PRODUCT_PRIORITY["erp"])}),
        web.withColumns({"source_ref": F.col("web_sku"), "source_system": F.lit("web"),
                         "source_priority": F.lit(PRODUCT_PRIORITY["web"])}),
    ]
    return _union(tagged).select(*PRODUCTS_UNIFIED_COLUMNS)


def _best_row(rows: DataFrame, key: str, order: list[Column], columns: list[str]) -> DataFrame:
    """Best row and row count per key in a single aggregate.

    Both combine before the shuffle, so a key shared by a large part of all
    rows sends one row per map task; a counting window would gather the group.
    """
    return (
        rows.groupBy(key)
        .agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_best"),
             F.count("*").alias("duplicate_count"))
        .select(key, "_best.*", "duplicate_count")
    )


def _latest_first(day: Column) -> list[Column]:
    """Order terms for descending dates with NULL last."""
    return [day.isNull(), -F.unix_date(day)]


def golden_customers(unified: DataFrame, as_of: Column) -> DataFrame:
    """Best source, then most recent activity, per normalised address."""
    kept = unified.filter(~is_blank(F.col("email_normalized")))
    columns = [c for c in CUSTOMERS_UNIFIED_COLUMNS if c != "email_normalized"]
    order = [F.col("source_priority"), *_latest_first(F.col("last_activity")), F.col("source_id")]
    return _best_row(kept, "email_normalized", order, columns).select(
        digest(F.col("email_normalized")).alias("golden_id"),
        "email_normalized",
        "email",
        "first_name",
        "last_name",
        "phone",
        "consent_marketing",
        "consent_date",
        "last_activity",
        active_since(F.col("last_activity"), as_of).alias("is_active_12m"),
        matches(F.col("email"), EMAIL_PATTERN, ignore_case=True, strict_end=True).alias("email_valid"),
        "duplicate_count",
    )


def golden_products(unified: DataFrame) -> DataFrame:
    """ERP before web, per product reference; of rows a source repeats, the one that sorts first."""
    kept = unified.filter(F.col("product_ref").isNotNull())
    order = [F.col(c) for c in ("source_priority", "source_ref", "product_name", "category", "price_eur", "stock_qty")]
    columns = [c for c in PRODUCTS_UNIFIED_COLUMNS if c != "product_ref"]
    return _best_row(kept, "product_ref", order, columns).select(
        "product_ref",
        "product_name",
        "category",
        "price_eur",
        "stock_qty",
        F.concat("product_ref", F.lit(".jpg")).alias("image_object_key"),
        "source_system",
    )


def customers_in_stream(landed: DataFrame) -> DataFrame:
    """Each spelling of an address seen in landed orders, with its last order time."""
    return (
        landed.filter(F.col("customer_email").isNotNull())
        .groupBy(normalise(F.col("customer_email")).alias("email_normalized"), F.col("customer_email").alias("email"))
        .agg(F.max("order_timestamp").alias("last_order_at"))
    )


def enrich_golden(golden: DataFrame, landed: DataFrame) -> DataFrame:
    """Golden customers with last order time and the later of the two activity dates."""
    orders = (
        landed.filter(F.col("customer_email").isNotNull())
        .groupBy(normalise(F.col("customer_email")).alias("email_normalized"))
        .agg(F.max("order_timestamp").alias("last_order_at"), F.count("*").alias("order_count"))
    )
    return golden.join(orders, "email_normalized", "left").withColumns({
        "order_count": F.coalesce("order_count", F.lit(0)),
        "last_seen": F.greatest("last_activity", F.to_date("last_order_at")),
    })


def reconcile_products(erp: DataFrame, web: DataFrame) -> DataFrame:
    """Every reference of either catalogue: where it is listed and how prices differ.

    A catalogue may list a reference more than once; the range on the web is held
    against the lowest and the highest price of the ERP.
    """
    shop = web.groupBy("product_ref").agg(
        F.count("*").alias("web_rows"), F.min("price_eur").alias("web_min"), F.max("price_eur").alias("web_max")
    )
    master = erp.groupBy("product_ref").agg(
        F.min("price_eur").alias("erp_price"), F.max("price_eur").alias("_erp_max"), F.lit(True).alias("_in_erp"))
    joined = master.join(shop, "product_ref", "full")
    return joined.select(
        "product_ref",
        F.when(F.col("_in_erp").isNull(), "web_only").when(F.col("web_rows").isNull(), "erp_only")
        .when((F.col("web_min") != F.col("erp_price")) | (F.col("web_max") != F.col("_erp_max")), "price_differs")
        .otherwise("same").alias("finding"),
        "erp_price",
        "web_min",
        "web_max",
        F.coalesce("web_rows", F.lit(0)).alias("web_rows"),
    )


def price_variance(landed: DataFrame, products: DataFrame) -> DataFrame:
    """Charged against catalogue price, per product: orders, and how many differ.

    Orders are summed up per product and price before the join, so a best
    seller costs one row per price.
    """
    charged = landed.groupBy("product_ref", "unit_price_eur").agg(F.count("*").alias("orders"))
    priced = charged.join(products.select("product_ref", "price_eur"), "product_ref")
    return priced.groupBy("product_ref", "price_eur").agg(
        F.sum("orders").alias("orders"),
        F.sum(F.when(F.col("unit_price_eur") != F.col("price_eur"), F.col("orders")).otherwise(0))
        .alias("orders_off_price"),
        F.min("unit_price_eur").alias("lowest_price"),
        F.max("unit_price_eur").alias("highest_price"),
    )


def unify_orders(web: DataFrame, pos: DataFrame) -> DataFrame:
    """Historical orders of both kinds; pos orders belong to the store channel."""
    columns = ["order_id", "customer_email", "channel", "store_code", "order_date", "product_ref",
               "quantity", "unit_price_eur", "amount_eur"]
    return _union([
        web.withColumn("store_code", F.lit(None).cast("string")),
        pos.withColumn("channel", F.lit("store")),
    ]).select(*columns)
