import re

from conftest import message
from pyspark.sql import functions as F
from test_batch import house, run, seed  # noqa: F401

from ordermill.operators import profiles
from ordermill.plans import batch
from ordermill.session import materialise
from ordermill.sources import ids
from ordermill.sources.tables import Warehouse


def test_facts_of_the_first_load_are_read_once(house):  # noqa: F811
    run(house, [message(), message(order_id="B")], 0)
    assert batch.profiled(house).fresh == 0


def test_every_load_meets_an_index_fitted_to_it(house, monkeypatch):  # noqa: F811
    met = []
    original = profiles.repeated_ids

    def spied(rows, load, known, buckets=None):
        met.append((load, buckets))
        return original(rows, load, known, buckets)

    monkeypatch.setattr(ids.fit, "__defaults__", (5,))
    monkeypatch.setattr(batch.profiles, "repeated_ids", spied)
    run(house, [message(order_id=f"N{i}") for i in range(30)], 0)
    assert sorted(met) == [("batch_id", 12), ("load_id", 12)]


def test_ids_are_moved_once_into_the_buckets_of_their_index(spark, tmp_path):
    made = Warehouse(spark, str(tmp_path / "w"))
    stored = spark.range(60).select(F.format_string("A%03d", "id").alias("order_id"), F.lit(0).alias(ids.LOAD))
    ids.add(made, "raw", "ids", stored, bucket_rows=10)
    buckets = ids.buckets_of(made, "raw", "ids")
    rows = spark.range(50, 70).select(F.format_string("A%03d", "id").alias("order_id"), F.lit(1).alias("batch_id"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = profiles.repeated_ids(rows.unionByName(rows), "batch_id", ids.near(made, "raw", "ids", "A000", "A999"), buckets)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert buckets == 12 and plan.count("Exchange") == plan.count("Exchange hashpartitioning(order_id") == 1
        assert sorted((r.order_id, r.before) for r in found.collect()) == [(f"A{i:03d}", i < 60) for i in range(50, 70)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_profiles_tell_ids_apart_by_the_repeated_ones_alone(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), ("b", 1), (None, 1), ("b", 2), ("c", 2)], "order_id string, batch_id int")
    twice = profiles.repeated_ids(rows, "batch_id", rows.select("order_id", F.col("batch_id").alias(ids.LOAD)).distinct())
    made = profiles.profile(rows, "batch_id", None, materialise(twice, "twice"), {})
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" in plan and not re.search(r"hashpartitioning\([^)]*order_id", plan)
    assert sorted((r.load, r.rows, r.first_seen) for r in made.collect()) == [(1, 5, 2), (2, 2, 1)]
