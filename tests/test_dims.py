from pyspark.sql import functions as F

from ordermill.functions.keys import assign_keys
from ordermill.operators import dims

STORE = "store_code string, store_name string, city string, region string"


def test_keys_are_dense_unique_and_repeatable(spark):
    members = spark.range(5000).select(F.concat(F.lit("m"), "id").alias("code"))
    once = {r["code"]: r["key"] for r in assign_keys(members, "code", "key").collect()}
    again = {r["code"]: r["key"] for r in assign_keys(members.repartition(7), "code", "key", prefix=2).collect()}
    assert sorted(once.values()) == list(range(1, 5001))
    assert once == again


def test_keys_follow_the_given_start(spark):
    members = spark.range(10).select(F.col("id").cast("string").alias("code"))
    assert {r["key"] for r in assign_keys(members, "code", "key", after=100).collect()} == set(range(101, 111))


def test_no_window_over_all_members(spark):
    members = spark.range(10).select(F.col("id").cast("string").alias("code"))
    plan = assign_keys(members, "code", "key")._jdf.queryExecution().executedPlan().toString()
    assert "Window [row_number() windowspecdefinition(_bucket" in plan


def stores(spark, *rows):
    return spark.createDataFrame([(*r, "Paris", "IdF") for r in rows], STORE)


def test_store_upsert_keeps_keys_and_updates_attributes(spark):
    first = dims.dim_store(stores(spark, ("A", "old a"), ("B", "old b")))
    before = {r["store_code"]: r["store_key"] for r in first.collect()}
    second = dims.dim_store(stores(spark, ("B", "new b"), ("C", "new c")), first)
    after = {r["store_code"]: r for r in second.collect()}
    assert set(before) == {"A", "B", "ONLINE"} and set(after) == {"A", "B", "C", "ONLINE"}
    assert all(after[c]["store_key"] == k for c, k in before.items())
    assert after["C"]["store_key"] == 4
    assert (after["A"]["store_name"], after["B"]["store_name"]) == ("old a", "new b")
    assert after["ONLINE"]["region"] == "National"


def test_update_may_set_null(spark):
    first = dims.dim_store(stores(spark, ("A", "named")))
    emptied = spark.createDataFrame([("A", None, None, None)], STORE)
    row = dims.dim_store(emptied, first).filter("store_code = 'A'").first()
    assert row["store_name"] is None and row["city"] is None


def test_channels_are_loaded_once(spark):
    first = dims.dim_channel(spark)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, dims.dim_channel(spark, first).collect()))
    assert {r["channel_code"] for r in first.collect()} == {"web", "app", "store"}


def test_customer_history(spark):
    columns = "email_normalized string, email string, first_name string"
    attributes = ("email", "first_name")
    start = F.to_timestamp(F.lit("2026-01-01"))
    later = F.to_timestamp(F.lit("2026-02-01"))
    first = spark.createDataFrame([("a", "A", "Ann"), ("b", "B", None), ("c", "C", "Cy")], columns)
    history = first.withColumns({"valid_from": start, "valid_to": F.lit(None).cast("timestamp")})
    load = spark.createDataFrame([("a", "A", "Anna"), ("b", "B", None), ("d", "D", "Di")], columns)
    changed = dims.customer_history(history, load, later, attributes)
    rows = sorted((r["email_normalized"], r["first_name"] or "", r["valid_to"] is None) for r in changed.collect())
    assert rows == [("a", "Ann", False), ("a", "Anna", True), ("b", "", True), ("c", "Cy", True), ("d", "Di", True)]
    again = dims.customer_history(changed, load, F.to_timestamp(F.lit("2026-03-01")), attributes)
    assert sorted(map(str, again.collect())) == sorted(map(str, changed.collect()))
