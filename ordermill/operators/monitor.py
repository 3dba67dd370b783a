"""Run log, dashboard queries, event rates and gauges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordermill.operators.facts import Star
from ordermill.schemas import PIPELINE_RUNS

# Gauge bands, rate span, scrape interval and panel lengths.
GAUGE_BANDS = ((0, "green"), (500_000_000, "yellow"), (1_000_000_000, "red"))
RATE_SECONDS = 300
SCRAPE_SECONDS = 15
SEGMENT_SECONDS = 86_400
PIPELINE_ID = "order_pipeline"


def run_status(checks_status: Column) -> Column:
    """ERROR without checks, ALERT when they alert, OK otherwise."""
    return F.when(checks_status.isNull(), "ERROR").when(checks_status == "ALERT", "ALERT").otherwise("OK")


def run_notes(checks_status: Column) -> Column:
    return (
        F.when(checks_status.isNull(), "Controles indisponibles")
        .when(checks_status == "ALERT", "Alerte DQ")
        .otherwise("Pipeline termine avec succes")
    )


def run_record(spark: SparkSession, run: dict) -> DataFrame:
    """One run as a row of ``monitoring.pipeline_runs``."""
    schema = StructType.fromDDL(PIPELINE_RUNS)
    return spark.createDataFrame([tuple(run.get(c) for c in schema.names)], schema)


def consumed_series(runs: DataFrame) -> DataFrame:
    return runs.select(F.col("started_at").alias("time"), F.col("events_consumed").alias("value")).orderBy("time")


def latest(rows: DataFrame, by: str, n: int, tie_break: str) -> DataFrame:
    """The last ``n`` rows in time: a top-k, so only ``n`` rows per task travel."""
    return rows.orderBy(F.desc(by), F.desc(tie_break)).limit(n)


def latest_metrics(metrics: DataFrame, n: int = 10) -> DataFrame:
    return latest(metrics.select("metric_name", "metric_value", "target_value", "status", "measured_at"),
                  "measured_at", n, "metric_name")


def latest_runs(runs: DataFrame, n: int = 20) -> DataFrame:
    shown = runs.select("run_id", "dag_id", "events_produced", "events_consumed", "events_failed", "dq_status",
                        "duration_sec", "started_at")
    return latest(shown, "started_at", n, "run_id")


def latest_orders(landed: DataFrame, n: int = 5) -> DataFrame:
    return latest(landed.select("order_id", "channel", "amount_eur", "consumed_at"), "consumed_at", n, "order_id")


def latest_sales(fact: DataFrame, dim_product: DataFrame, dim_channel: DataFrame, n: int = 5) -> DataFrame:
    """Latest facts with product and channel.

    The few rows are picked before the dimensions are read; both keys are
    always present and unique there.
    """
    last = latest(fact, "order_timestamp", n, "order_id")
    return (
        last.join(dim_product.select("product_key", "product_ref", "category"), "product_key")
        .join(dim_channel.select("channel_key", "channel_name"), "channel_key")
        .select("order_id", "product_ref", "category", "amount_eur", "channel_name", "order_timestamp")
    )


def latest_requests(audit: DataFrame, address: Column, n: int = 2) -> DataFrame:
    mine = audit.filter(F.lower(F.trim("customer_email")) == F.lower(F.trim(address)))
    return mine.orderBy(F.desc("request_id")).limit(n).select("request_id", "request_type", "status", "notes")


def backlog(landed_with_flag: DataFrame) -> DataFrame:
    """Pending against all landed orders."""
    return landed_with_flag.agg(F.count_if(~F.col("processed")).alias("pending"), F.count("*").alias("total"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()
    ])


def facts_of_subject(fact: DataFrame, dim_customer: DataFrame, address: Column) -> DataFrame:
    mine = dim_customer.filter(F.lower(F.trim("email")) == F.lower(F.trim(address))).select("customer_key")
    return fact.join(mine, "customer_key", "left_semi").agg(F.count("*").alias("rows"))


def _slot(ts: Column, seconds: int) -> Column:
    """Whole seconds since 1970 at which the interval of ``ts`` begins."""
    return F.unix_seconds(ts) - F.pmod(F.unix_seconds(ts), F.lit(seconds))


def event_rate(events: DataFrame, ts: str, series: str, span: int = RATE_SECONDS,
               step: int = SCRAPE_SECONDS) -> DataFrame:
    """Events per second over the last ``span`` seconds, at every ``step``.

    Events are first counted per step; only those counts are repeated for the
    ``span / step`` windows they belong to, never the events.
    """
    counted = events.groupBy(series, _slot(F.col(ts).cast("timestamp"), step).alias("_slot")).agg(
        F.count("*").alias("_n"))
    windows = counted.withColumn(
        "window_end", F.explode(F.sequence(F.col("_slot") + step, F.col("_slot") + span, F.lit(step)))
    )
    return windows.groupBy(series, "window_end").agg(F.sum("_n").alias("events")).withColumn(
        "per_second", F.col("events") / F.lit(float(span)))


def counter_rate(samples: DataFrame, ts: str, series: str, value: str, order: str, span: int = RATE_SECONDS,
                 scrape: int = SCRAPE_SECONDS, segment: int = SEGMENT_SECONDS) -> DataFrame:
    """Increase per second of a counter over the last ``span`` seconds, at every scrape; a drop is a restart from zero.

    The last reading of every scrape interval is the sample, taken at its end,
    so a series has at most ``span / scrape`` samples per window however many
    readings arrive. The rise between two samples counts in every window that
    holds both; only samples and rises are repeated, never the readings.

    Series are cut into segments of time, each a group of its own, and the last
    sample of a segment goes over its edge. A sample further back than a
    segment, ``span`` at least, shares no window, so one edge is enough.
    """
    if segment < span:
        raise ValueError(f"a segment of {segment} seconds is shorter than the span")
    when = F.col(ts).cast("timestamp")
    scraped = samples.filter(F.col(value).isNotNull()).groupBy(series, _slot(when, scrape).alias("_slot")).agg(
        F.max_by(value, F.struct(ts, order)).alias("_value")).withColumn("_segment", F.floor(F.col("_slot") / segment))
    edges = scraped.groupBy(series, "_segment").agg(F.max("_slot").alias("_slot"), F.max_by("_value", "_slot").alias("_value"))
    carried = edges.withColumns({"_segment": F.col("_segment") + 1, "_own": F.lit(False)})
    own = Window.partitionBy(series, "_segment").orderBy("_slot")
    stepped = scraped.withColumn("_own", F.lit(True)).unionByName(carried).withColumns(
        {"_before": F.lag("_value").over(own), "_since": F.lag("_slot").over(own)}).filter("_own")
    rise = F.when(F.col("_value") >= F.col("_before"), F.col("_value") - F.col("_before")).otherwise(F.col("_value"))
    windows = stepped.withColumn(
        "window_end", F.explode(F.sequence(F.col("_slot") + scrape, F.col("_slot") + span, F.lit(scrape))))
    both = F.col("window_end") <= F.col("_since") + span
    return windows.groupBy(series, "window_end").agg(
        F.count("*").alias("samples"), F.sum(F.when(both, rise).otherwise(F.lit(0))).alias("increase")
    ).withColumn("per_second", F.col("increase") / F.lit(float(span)))


def band(value: Column, bands: tuple = GAUGE_BANDS) -> Column:
    """Name of the highest band whose lower bound the value reaches; the first band is open below."""
    chosen = F.lit(bands[0][1])
    for bound, name in bands[1:]:
        chosen = F.when(value >= bound, F.lit(name)).otherwise(chosen)
    return F.when(value.isNotNull(), chosen)


def last_gauge(samples: DataFrame, ts: str, series: str, value: str, order: str,
               bands: tuple = GAUGE_BANDS) -> DataFrame:
    """Last non-null reading of each series with its band."""
    return samples.filter(F.col(value).isNotNull()).groupBy(series).agg(
        F.max_by(value, F.struct(ts, order)).alias("last_value")
    ).withColumn("band", band(F.col("last_value"), bands))


def revenue_by_channel(fact: DataFrame, dim_channel: DataFrame) -> DataFrame:
    """Orders, units and revenue per channel; summed up before the join."""
    sums = fact.groupBy("channel_key").agg(
        F.count("*").alias("orders"), F.sum("quantity").alias("units"), F.sum("amount_eur").alias("revenue_eur")
    )
    return sums.join(dim_channel, "channel_key").select("channel_code", "channel_name", "orders", "units", "revenue_eur")


def revenue_rollup(fact: DataFrame, star: Star) -> DataFrame:
    """Revenue by region, store and channel with subtotals.

    Facts are summed per store and channel first, so the rollup expands only
    that small result.
    """
    sums = fact.groupBy("store_key", "channel_key").agg(
        F.count("*").alias("orders"), F.sum("amount_eur").alias("revenue_eur"))
    named = sums.join(star.store, "store_key").join(star.channel, "channel_key")
    return named.rollup("region", "store_code", "channel_code").agg(
        F.sum("orders").alias("orders"), F.sum("revenue_eur").alias("revenue_eur"),
        F.grouping_id().alias("level"))
