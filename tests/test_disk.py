"""What a job leaves and holds on disk: shuffle files, stored copies, slices of large loads."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import frame, message
from pyspark.sql import functions as F
from test_batch import house, ids, requests, run, seed  # noqa: F401

from ordermill import session
from ordermill.plans import batch
from ordermill.sources.tables import Warehouse
from ordermill.streaming import ingest


def shuffle_files(spark):
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {p.name for d in local for p in Path(d).rglob("shuffle_*.data")}


def codecs(folder):
    return {pq.ParquetFile(p).metadata.row_group(0).column(0).compression for p in Path(folder).rglob("*.parquet") if pq.ParquetFile(p).metadata.num_row_groups}


def test_shuffle_files_go_with_the_job_that_wrote_them(spark):
    session.prepare(spark)
    before = shuffle_files(spark)
    kept = session.materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "sums")
    assert shuffle_files(spark) <= before
    assert kept.count() == 7


def test_a_frame_collected_again_may_find_its_shuffle_files(spark):
    sums = session.prepare(spark).range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert len(sums.collect()) == 7
    held = shuffle_files(spark)
    session.together(*[lambda: session.materialise(spark.range(10).groupBy("id").count(), "sums")] * 3)
    assert held and shuffle_files(spark) & held and spark.conf.get(session.CLEANUP_SETTING, "false") == "false"


def test_stored_tables_and_copies_are_packed(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    ingest.ingest_batch(frame(spark, [message(), message(order_id="B"), "{bad"]), 0, house)
    house.commit(spark.range(3), "staging", "numbers")
    copy = session.materialise(spark.range(3), "copy")
    assert codecs(tmp_path / "house") == {"ZSTD"}
    assert {pq.ParquetFile(f.removeprefix("file://")).metadata.row_group(0).column(0).compression for f in copy.inputFiles()
            if pq.ParquetFile(f.removeprefix("file://")).metadata.num_row_groups} == {"ZSTD"}


def rows_of(df, *left_out):
    return sorted(map(str, df.drop(*left_out).collect()))


def orders(n, **changes):
    return [message(order_id=f"N{i % (n - 3)}", customer_email=("ann@shop.com", "bob@shop.com")[i % 2], **changes) for i in range(n)]


def test_large_batch_lands_in_slices_as_it_lands_whole(spark, tmp_path, monkeypatch):
    texts = [*orders(20), "{bad", '{"a": "ann@shop.com"', message(order_id="N1", channel="phone"), message(order_id=None)]
    events = frame(spark, texts)
    whole, cut, one = (Warehouse(spark, str(tmp_path / n)) for n in ("whole", "cut", "one"))
    counts = ingest.ingest_batch(events, 0, whole)
    monkeypatch.setattr(session, "SLICE_ROWS", 12)
    freed = []
    monkeypatch.setattr(ingest, "discard", lambda *frames: freed.append(len(frames)) or session.discard(*frames))
    parts = session.in_slices(events, 3, "arrival")
    for _ in range(2):  # delivered again, too
        assert ingest.ingest_batch(parts, 0, cut) == ingest.ingest_batch(events, 0, one) == counts
    assert freed[:4] == [1, 1, 1, 3]  # judged messages go slice by slice
    for house in (cut, one):
        for read in (ingest.landed_orders, ingest.failed_events, ingest.dead_letters):
            assert rows_of(read(house), "consumed_at", "failed_at") == rows_of(read(whole), "consumed_at", "failed_at")
        assert ingest.landed_orders(house).select("consumed_at").distinct().count() == 1


def test_large_loads_are_resolved_published_and_refreshed_in_parts(house, monkeypatch):  # noqa: F811
    monkeypatch.setattr(session, "SLICE_ROWS", 12)
    texts = [*orders(20), message(order_id="W", product_ref="UC-QK-999"), message(order_id="M", order_timestamp="2026-05-20T08:25:00+00:00")]
    assert run(house, texts, 0).status == "OK"
    assert ids(batch.sales(house)) == ids(ingest.landed_orders(house).filter("order_id <> 'W'"))
    assert ids(house.read("staging", "orders_backlog")) == ["W"]
    before = rows_of(batch.sales(house))
    assert rows_of(batch.rebuild_facts(house)) == before
    assert not list(Path(house.root).rglob("_writing/*"))


def test_large_loads_are_erased_file_by_file(house, monkeypatch):  # noqa: F811
    monkeypatch.setattr(session, "SLICE_ROWS", 12)
    run(house, [*orders(20), message(order_id="C", customer_email="bob@shop.com", channel="phone")], 0)
    kept = {name: rows_of(rows) for name, rows in (("landed", ingest.landed_orders(house).filter("customer_email = 'bob@shop.com'")),
                                                  ("failed", ingest.failed_events(house)))}
    replace, stopped = Warehouse.replace_files, []

    def stop(self, layer, table, version, names, aside):
        stopped.append(table)
        if len(stopped) == 2:
            for name in names:
                (Path(self._snapshot(layer, table, version)) / name).unlink()
            raise RuntimeError("stopped")
        replace(self, layer, table, version, names, aside)

    monkeypatch.setattr(Warehouse, "replace_files", stop)
    asked = requests(house.spark, "ann@shop.com")
    with pytest.raises(RuntimeError, match="stopped"):
        batch.erase_subjects(house, asked, full=True)
    monkeypatch.setattr(Warehouse, "replace_files", replace)
    batch.erase_subjects(house, asked, full=True)
    assert rows_of(ingest.landed_orders(house)) == kept["landed"] and rows_of(ingest.failed_events(house)) == kept["failed"]
    assert ids(batch.sales(house)) == ids(ingest.landed_orders(house))
    assert not house.exists("staging", "erasing_streaming_orders") and not house.exists("staging", "erasing_fact_sales_loads")
    batch.erase_subjects(house, requests(house.spark, "bob@shop.com"), full=True)
    assert ingest.landed_orders(house).count() == ingest.failed_events(house).count() == batch.sales(house).count() == 0
