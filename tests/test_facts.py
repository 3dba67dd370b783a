import datetime as dt

import pytest
from pyspark.sql import functions as F

from ordermill import schemas
from ordermill.operators import facts, lookup

TODAY = dt.datetime(2026, 6, 20, 10)


@pytest.fixture(scope="module")
def star(spark):
    row = lambda *v: list(v)
    return facts.Star(
        date=spark.createDataFrame([(20260620,)], "date_key int"),
        channel=spark.createDataFrame([(1, "web", "W"), (2, "store", "S")], schemas.DIM_CHANNEL),
        store=spark.createDataFrame([(1, "ONLINE", "o", "c", "r"), (2, "PAR01", "p", "c", "r")], schemas.DIM_STORE),
        customer=spark.createDataFrame(
            [row(1, "g1", "ann@x.com", "Ann@x.com ", *[None] * 9, None), row(2, "g2", "bob@x.com", "bob@x.com", *[None] * 9, None),
             row(9, "g2", "bob@x.com", "bob@x.com", *[None] * 9, TODAY)], schemas.DIM_CUSTOMER),
        product=spark.createDataFrame([(1, "UC-QK-001", *[None] * 6), (2, "UC-QK-002", *[None] * 6)], schemas.DIM_PRODUCT),
    )


def orders(spark, *rows):
    """(order_id, email, channel, store, product, timestamp)"""
    made = spark.createDataFrame(list(rows), "order_id string, customer_email string, channel string, store_code string, "
                                 "product_ref string, order_timestamp timestamp")
    return made.withColumns({"quantity": F.lit(1), "unit_price_eur": F.lit(1).cast("decimal(10,2)"),
                             "amount_eur": F.lit(1).cast("decimal(10,2)")})


def sample(spark):
    return orders(
        spark,
        ("ok", " ANN@x.com", "web", None, "UC-QK-001", TODAY),
        ("shop", "bob@x.com", "store", "PAR01", "UC-QK-002", TODAY),
        ("elsewhere", "bob@x.com", "store", "XXX", "UC-QK-002", TODAY),
        ("nobody", "eve@x.com", "web", None, "UC-QK-001", TODAY),
        ("no product", "ann@x.com", "web", None, "UC-QK-999", TODAY),
        ("no channel", "ann@x.com", "app", None, "UC-QK-001", TODAY),
        ("no day", "eve@x.com", "web", None, "UC-QK-001", dt.datetime(2027, 1, 1)),
    )


def test_keys_and_default_store(spark, star):
    rows = {r["order_id"]: r for r in facts.build_fact(sample(spark), star).collect()}
    assert set(rows) == {"ok", "shop", "elsewhere"}
    assert (rows["ok"]["customer_key"], rows["ok"]["store_key"], rows["ok"]["date_key"]) == (1, 1, 20260620)
    assert (rows["shop"]["customer_key"], rows["shop"]["store_key"]) == (2, 2)
    assert rows["elsewhere"]["store_key"] == 1


def test_unresolved_names_the_first_missing_dimension(spark, star):
    rows = {r["order_id"]: r["missing"] for r in facts.unresolved_orders(sample(spark), star).collect()}
    assert rows == {"nobody": "customer", "no product": "product", "no channel": "channel", "no day": "date"}


def test_incremental_build_leaves_loaded_orders_out(spark, star):
    loaded = spark.createDataFrame([("ok",)], "order_id string")
    assert {r["order_id"] for r in facts.build_fact(sample(spark), star, loaded).collect()} == {"shop", "elsewhere"}


def test_processed_flag(spark, star):
    landed = sample(spark)
    fact = facts.build_fact(landed, star)
    flags = {r["order_id"]: r["processed"] for r in facts.with_processed(landed, fact).collect()}
    assert flags["ok"] and not flags["nobody"]
    before = fact.filter("order_id = 'ok'")
    assert {r["order_id"] for r in facts.newly_processed(landed, before, fact).collect()} == {"shop", "elsewhere"}


def skewed(spark, n=3000):
    """A third of all orders by one customer, two thirds without store."""
    third = F.col("id") % 3 == 0
    return spark.range(n).select(
        F.concat(F.lit("o"), "id").alias("order_id"),
        F.when(third, "ann@x.com").otherwise(F.concat(F.lit("c"), "id", F.lit("@x.com"))).alias("customer_email"),
        F.lit("web").alias("channel"),
        F.when(third, "PAR01").alias("store_code"),
        F.when(F.col("id") % 2 == 0, "UC-QK-001").otherwise("UC-QK-002").alias("product_ref"),
        F.lit(1).alias("quantity"), F.lit(1).cast("decimal(10,2)").alias("unit_price_eur"),
        F.lit(1).cast("decimal(10,2)").alias("amount_eur"), F.lit(TODAY).alias("order_timestamp"))


def test_salted_lookup_gives_the_same_rows(spark, star):
    landed = skewed(spark)
    plain = facts.resolve(landed, star)
    salted = facts.resolve(landed, star, broadcast_rows=0, rows_per_salt=50)
    assert salted.count() == 3000
    columns = plain.columns
    assert plain.select(columns).exceptAll(salted.select(columns)).count() == 0
    assert facts.build_fact(landed, star, broadcast_rows=0, rows_per_salt=50).count() == 1000


def test_every_hot_key_is_cut_by_size(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 600, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 300)).alias("k"))
    hot = lookup.hot_keys(rows, "k", rows_per_salt=100)
    assert [tuple(r) for r in hot.collect()] == [("hot", 6)]
    assert lookup.hot_keys(spark.range(1500).selectExpr("string(id) AS k"), "k", rows_per_salt=0.5).count() == 1500


def test_salted_lookup_spreads_the_hot_key(spark, star):
    landed = skewed(spark)
    members = spark.createDataFrame([("ann@x.com", 1)], "customer_email string, customer_key long")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup.lookup(landed, members, "customer_email", F.col("order_id"), landed, broadcast_rows=0, rows_per_salt=20)
        sizes = [r["count"] for r in joined.filter("customer_key = 1").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 1000 and len(sizes) == 4 and max(sizes) < 500


def test_lookup_of_an_ambiguous_member_fans_out(spark, star):
    doubled = facts.Star(star.date, star.channel, star.store, star.customer.drop("valid_to").withColumn(
        "valid_to", F.lit(None).cast("timestamp")), star.product)
    assert facts.build_fact(sample(spark), doubled).filter("order_id = 'shop'").count() == 2
