"""Rate metrics with verdicts, and column tests."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.dates import within

METRIC = "decimal(14,4)"

# Metric names, targets and comparators.
TARGETS = {
    "streaming_null_order_rate_pct": ("0", "lte"),
    "streaming_duplicate_order_rate_pct": ("0", "lte"),
    "fact_sales_orphan_product_rate_pct": ("0", "lte"),
    "failed_events_count_24h": ("5", "lte"),
}


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole`` with two digits; NULL when there is nothing."""
    share = F.lit(100).cast("decimal(20,0)") * part.cast("decimal(18,0)")
    return F.round(share / F.nullif(whole.cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)")), 2)


def _metric(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.agg(value.cast(METRIC).alias("metric_value")).select(F.lit(name).alias("metric_name"), "metric_value")


def null_rate(landed: DataFrame, as_of: Column) -> DataFrame:
    recent = landed.filter(within(F.col("consumed_at"), as_of))
    blank = F.col("order_id").isNull() | F.col("amount_eur").isNull()
    return _metric(recent, "streaming_null_order_rate_pct", percent(F.count_if(blank), F.count("*")))


def duplicate_rate(landed: DataFrame) -> DataFrame:
    """Share of landed rows that repeat an order. Ids are counted once per task before the shuffle."""
    return _metric(landed, "streaming_duplicate_order_rate_pct",
                   percent(F.count("*") - F.count_distinct("order_id"), F.count("*")))


def orphan_rate(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Fact rows without product, summed up per product key before the join."""
    sold = fact.groupBy("product_key").agg(F.count("*").alias("_rows"))
    known = dim_product.select("product_key").distinct().withColumn("_known", F.lit(True))
    orphans = F.sum(F.when(F.col("_known").isNull(), F.col("_rows")).otherwise(0))
    return _metric(sold.join(known, "product_key", "left"), "fact_sales_orphan_product_rate_pct",
                   percent(orphans, F.sum("_rows")))


def failed_count(failed: DataFrame, as_of: Column) -> DataFrame:
    return _metric(failed.filter(within(F.col("failed_at"), as_of)), "failed_events_count_24h", F.count("*"))


def verdict(value: Column, target: Column, comparator: Column) -> Column:
    """ALERT without a value; OK or ALERT for ``lte`` and ``gte``; INFO otherwise."""
    return (
        F.when(value.isNull(), "ALERT")
        .when(comparator == "lte", F.when(value <= target, "OK").otherwise("ALERT"))
        .when(comparator == "gte", F.when(value >= target, "OK").otherwise("ALERT"))
        .otherwise("INFO")
    )


def judge_metrics(metrics: DataFrame, targets: dict[str, tuple[str, str]] = TARGETS) -> DataFrame:
    def of(position: int) -> Column:
        return F.coalesce(*[F.when(F.col("metric_name") == n, F.lit(t[position])) for n, t in targets.items()])

    return metrics.withColumns({"target_value": of(0).cast(METRIC), "_comparator": of(1)}).withColumn(
        "status", verdict(F.col("metric_value"), F.col("target_value"), F.col("_comparator"))
    ).drop("_comparator")


def run_checks(landed: DataFrame, failed: DataFrame, fact: DataFrame, dim_product: DataFrame,
               as_of: Column) -> DataFrame:
    """One row per metric with value, target and status."""
    return judge_metrics(reduce(DataFrame.unionByName, [
        null_rate(landed, as_of),
        duplicate_rate(landed),
        orphan_rate(fact, dim_product),
        failed_count(failed, as_of),
    ]))


def overall_status(metrics: DataFrame) -> DataFrame:
    return metrics.agg(F.when(F.bool_or(F.col("status") == "ALERT"), "ALERT").otherwise("OK").alias("dq_status"))


def alerts(metrics: DataFrame) -> DataFrame:
    return metrics.filter(F.col("status") == "ALERT")


@dataclass(frozen=True)
class ColumnTest:
    """``not_null``, ``unique`` or ``relationships`` (to ``parent``) on one column."""

    table: str
    column: str
    test: str
    parent: str | None = None


STAGED_ORDER_TESTS = (
    ColumnTest("stg_orders", "order_id", "not_null"),
    ColumnTest("stg_orders", "order_id", "unique"),
    ColumnTest("stg_orders", "amount_eur", "not_null"),
    ColumnTest("stg_orders", "customer_email", "not_null"),
)
FACT_TESTS = (
    ColumnTest("fact_sales", "order_id", "not_null"),
    ColumnTest("fact_sales", "order_id", "unique"),
    ColumnTest("fact_sales", "amount_eur", "not_null"),
    ColumnTest("fact_sales", "product_key", "not_null"),
    ColumnTest("fact_sales", "product_key", "relationships", "dim_product"),
    ColumnTest("fact_sales", "customer_key", "not_null"),
    ColumnTest("fact_sales", "customer_key", "relationships", "dim_customer"),
)
DECLARED_TESTS = STAGED_ORDER_TESTS + FACT_TESTS

# Keys the storage does not enforce: primary, unique, mandatory and foreign.
CONSTRAINTS = (
    ColumnTest("streaming_orders", "event_id", "unique"),
    ColumnTest("streaming_orders", "event_id", "not_null"),
    ColumnTest("streaming_orders", "order_id", "unique"),
    ColumnTest("streaming_orders", "order_id", "not_null"),
    ColumnTest("streaming_orders", "order_timestamp", "not_null"),
    ColumnTest("customers_golden", "email_normalized", "unique"),
    ColumnTest("products_golden", "product_ref", "unique"),
    ColumnTest("dim_date", "date_key", "unique"),
    ColumnTest("dim_date", "full_date", "unique"),
    ColumnTest("dim_date", "full_date", "not_null"),
    ColumnTest("dim_channel", "channel_code", "unique"),
    ColumnTest("dim_channel", "channel_code", "not_null"),
    ColumnTest("dim_store", "store_code", "unique"),
    ColumnTest("dim_store", "store_code", "not_null"),
    ColumnTest("dim_customer", "customer_key", "unique"),
    ColumnTest("dim_customer", "golden_id", "unique"),
    ColumnTest("dim_product", "product_key", "unique"),
    ColumnTest("dim_product", "product_ref", "unique"),
    ColumnTest("dim_product", "product_ref", "not_null"),
    ColumnTest("fact_sales", "quantity", "not_null"),
    ColumnTest("fact_sales", "order_timestamp", "not_null"),
    ColumnTest("fact_sales", "date_key", "relationships", "dim_date"),
    ColumnTest("fact_sales", "store_key", "relationships", "dim_store"),
    ColumnTest("fact_sales", "channel_key", "relationships", "dim_channel"),
)


def _null_failures(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """All mandatory columns of a table in one scan."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column", "failures").select(
        F.lit("not_null").alias("test"), F.lit(table).alias("table"), "column", "failures"
    )


def _repeated(df: DataFrame, table: str, column: str) -> DataFrame:
    repeated = df.filter(F.col(column).isNotNull()).groupBy(column).count().filter("count > 1")
    return repeated.agg(F.count("*").alias("failures")).select(
        F.lit("unique").alias("test"), F.lit(table).alias("table"), F.lit(column).alias("column"), "failures"
    )


def without_parent(children: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Of ``children``, counted per key, those whose key no parent has.

    An outer join, as Spark moves an anti-join below the count: every child row would then be shuffled and sorted by its key, and
    parts merged by their bytes hold ever more of them, as keys are short.
    """
    known = parent.select(column).distinct().withColumn("_known", F.lit(True))
    return children.join(known, column, "left").filter(F.col("_known").isNull()).drop("_known")


def _orphans(df: DataFrame, parent: DataFrame, table: str, column: str) -> DataFrame:
    """Child rows without parent, counted per key before the join."""
    children = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_rows"))
    return without_parent(children, parent, column).agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("failures")).select(
        F.lit("relationships").alias("test"), F.lit(table).alias("table"), F.lit(column).alias("column"), "failures"
    )


def run_tests(tables: dict[str, DataFrame], tests: tuple[ColumnTest, ...] = DECLARED_TESTS) -> DataFrame:
    """One row per test: failing rows (values, for ``unique``) and PASS or FAIL."""
    mandatory: dict[str, list[str]] = {}
    for t in tests:
        if t.test == "not_null":
            mandatory.setdefault(t.table, []).append(t.column)
    frames = [_null_failures(tables[table], table, columns) for table, columns in mandatory.items()]
    for t in tests:
        if t.test == "unique":
            frames.append(_repeated(tables[t.table], t.table, t.column))
        elif t.test == "relationships":
            frames.append(_orphans(tables[t.table], tables[t.parent], t.table, t.column))
    return reduce(DataFrame.unionByName, frames).withColumn(
        "status", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL")
    )


def declared_tests() -> tuple[ColumnTest, ...]:
    """The tests that ``run_tests`` runs unless told otherwise."""
    return run_tests.__defaults__[0]
