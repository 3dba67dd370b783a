import datetime as dt

import pytest
from pyspark.sql import functions as F

from ordermill.operators import quality

NOW = dt.datetime(2026, 6, 20, 12)



def landed(spark, *rows):
    return spark.createDataFrame([(o, a, NOW - dt.timedelta(hours=h)) for o, a, h in rows],
                                 "order_id string, amount_eur int, consumed_at timestamp")


def value(df):
    found = df.first()["metric_value"]
    return None if found is None else float(found)


def test_null_rate_looks_at_one_day(spark):
    rows = landed(spark, ("a", 1, 0), ("b", None, 1), ("c", 1, 24), ("d", None, 25))
    assert value(quality.null_rate(rows, F.lit(NOW))) == 33.33


def test_duplicate_rate(spark):
    assert value(quality.duplicate_rate(landed(spark, ("a", 1, 0), ("a", 1, 0), ("b", 1, 0)))) == 33.33


def test_orphan_rate(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "product_key int")
    dim = spark.createDataFrame([(1,)], "product_key int")
    assert value(quality.orphan_rate(fact, dim)) == 50.0


def test_failed_count(spark):
    failed = spark.createDataFrame([(NOW,), (NOW - dt.timedelta(days=2),)], "failed_at timestamp")
    assert value(quality.failed_count(failed, F.lit(NOW))) == 1.0


def test_empty_input_has_no_rate_and_alerts(spark):
    empty = landed(spark, ("a", 1, 0)).limit(0)
    judged = quality.judge_metrics(quality.duplicate_rate(empty)).first()
    assert judged["metric_value"] is None and judged["status"] == "ALERT"


@pytest.mark.parametrize("measured, target, comparator, status", [
    (None, 0, "lte", "ALERT"), (0, 0, "lte", "OK"), (1, 0, "lte", "ALERT"), (5, 5, "gte", "OK"), (4, 5, "gte", "ALERT"),
    (1, 1, "eq", "INFO"), (None, 1, "eq", "ALERT"),
])
def test_verdict(spark, measured, target, comparator, status):
    row = spark.range(1).select(quality.verdict(F.lit(measured).cast("int"), F.lit(target), F.lit(comparator))).first()
    assert row[0] == status


def test_overall_status_and_alerts(spark):
    metrics = spark.createDataFrame([("a", "OK"), ("b", "INFO")], "metric_name string, status string")
    assert quality.overall_status(metrics).first()[0] == "OK"
    worse = metrics.union(spark.createDataFrame([("c", "ALERT")], metrics.schema))
    assert quality.overall_status(worse).first()[0] == "ALERT"
    assert [r["metric_name"] for r in quality.alerts(worse).collect()] == ["c"]


def test_column_tests_find_failures(spark):
    orders = spark.createDataFrame([("a", 1, "x"), ("a", None, "x"), (None, 1, None), (None, 1, "y")],
                                   "order_id string, amount_eur int, customer_email string")
    fact = spark.createDataFrame([("a", 1, 1, 7), ("b", 1, None, 8), ("c", 1, 3, 8)],
                                 "order_id string, amount_eur int, product_key int, customer_key int")
    found = quality.run_tests({
        "stg_orders": orders, "fact_sales": fact,
        "dim_product": spark.createDataFrame([(1,)], "product_key int"),
        "dim_customer": spark.createDataFrame([(7,)], "customer_key int"),
    })
    failures = {(r["test"], r["table"], r["column"]): (r["failures"], r["status"]) for r in found.collect()}
    assert len(failures) == len(quality.DECLARED_TESTS)
    assert failures["not_null", "stg_orders", "order_id"] == (2, "FAIL")
    assert failures["unique", "stg_orders", "order_id"] == (1, "FAIL")
    assert failures["not_null", "stg_orders", "amount_eur"] == (1, "FAIL")
    assert failures["unique", "fact_sales", "order_id"] == (0, "PASS")
    assert failures["not_null", "fact_sales", "product_key"] == (1, "FAIL")
    assert failures["relationships", "fact_sales", "product_key"] == (1, "FAIL")
    assert failures["relationships", "fact_sales", "customer_key"] == (2, "FAIL")
