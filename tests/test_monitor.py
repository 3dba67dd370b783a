import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from ordermill.operators import monitor

START = dt.datetime(2026, 6, 20, 12)


def events(spark, *rows):
    """(series, seconds after START, value)"""
    made = [(i, s, START + dt.timedelta(seconds=t), v) for i, (s, t, v) in enumerate(rows)]
    return spark.createDataFrame(made, "event_id long, series string, ts timestamp, value long")


def test_event_rate_counts_each_event_in_every_window_it_belongs_to(spark):
    rows = events(spark, ("a", 0, 1), ("a", 10, 1), ("a", 20, 1))
    rates = {r["window_end"]: r["events"] for r in monitor.event_rate(rows, "ts", "series").collect()}
    base = int(START.replace(tzinfo=dt.timezone.utc).timestamp())
    assert rates[base + 15] == 2 and rates[base + 30] == 3 and rates[base + 300] == 3 and rates[base + 315] == 1
    assert sum(rates.values()) == 3 * 20


def test_counter_rate_with_reset(spark):
    rows = events(spark, ("a", 0, 10), ("a", 15, 14), ("a", 30, 3), ("a", 45, 5), ("a", 300, 100))
    base = int(START.replace(tzinfo=dt.timezone.utc).timestamp())
    found = {r["window_end"] - base: r for r in monitor.counter_rate(rows, "ts", "series", "value", "event_id").collect()}
    assert (found[60]["increase"], found[60]["samples"]) == (4 + 3 + 2, 4)
    assert found[60]["per_second"] == 9 / 300
    # the window slides: the first sample leaves it, and rises across any five-minute mark count
    assert (found[300]["increase"], found[300]["samples"]) == (9, 4)
    assert (found[315]["increase"], found[315]["samples"]) == (3 + 2 + 95, 4)
    assert (found[345]["increase"], found[345]["samples"]) == (95, 2)
    assert (found[600]["increase"], found[600]["samples"]) == (0, 1)


def test_counter_takes_the_last_reading_of_a_scrape(spark):
    rows = events(spark, ("a", 0, 10), ("a", 1, 99), ("a", 2, 12), ("a", 15, 20))
    last = monitor.counter_rate(rows, "ts", "series", "value", "event_id").filter("samples = 2").first()
    assert last["increase"] == 8


def test_last_gauge_skips_null_and_bands(spark):
    rows = events(spark, ("a", 0, 600_000_000), ("a", 5, None), ("b", 0, 5), ("c", 0, 1_000_000_000), ("d", 0, -1))
    bands = {r["series"]: r["band"] for r in monitor.last_gauge(rows, "ts", "series", "value", "event_id").collect()}
    assert bands == {"a": "yellow", "b": "green", "c": "red", "d": "green"}


def test_run_status(spark):
    rows = spark.createDataFrame([(None,), ("ALERT",), ("OK",)], "s string")
    found = rows.select(monitor.run_status(F.col("s")).alias("status"), monitor.run_notes(F.col("s"))).collect()
    assert [r["status"] for r in found] == ["ERROR", "ALERT", "OK"]


def test_run_record_and_dashboards(spark):
    runs = monitor.run_record(spark, {"run_id": 1, "started_at": START, "events_consumed": 3}).union(
        monitor.run_record(spark, {"run_id": 2, "started_at": START + dt.timedelta(1), "events_consumed": 5}))
    assert [r["value"] for r in monitor.consumed_series(runs).collect()] == [3, 5]
    assert [r["run_id"] for r in monitor.latest_runs(runs, 1).collect()] == [2]
    plan = monitor.latest_runs(runs)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_counter_series_are_cut_and_carried_over_the_edges(spark):
    """Four or four hundred segments give what one gives, and no window holds a series."""
    rng = random.Random(3)
    rows = events(spark, *[("ab"[rng.random() < 0.2], rng.randint(0, 120_000), rng.randint(0, 50)) for _ in range(3000)])

    def rates(segment):
        return sorted(map(tuple, monitor.counter_rate(rows, "ts", "series", "value", "event_id", segment=segment).collect()))

    whole = rates(1 << 40)
    assert len(whole) > 5000 and rates(30_000) == rates(300) == whole
    plan = monitor.counter_rate(rows, "ts", "series", "value", "event_id")._jdf.queryExecution().executedPlan().toString()
    assert "series" in plan and re.search(r"Window \[.*\], \[series#\d+, _segment#\d+", plan)
    with pytest.raises(ValueError):
        rates(200)
