import datetime as dt
import json
import pathlib

import pytest
from conftest import frame, message
from pyspark.sql import functions as F

from ordermill.operators import dims, landing, privacy, quality
from ordermill.plans import batch
from ordermill.sources.csvfiles import read_csv, read_seed
from ordermill.sources.tables import Warehouse
from ordermill.streaming import ingest

WEB = """source_id,email,first_name,last_name,phone,consent_marketing,consent_date,last_activity
W1,Ann@shop.com,Ann,Lee,+331,True,2025-09-13,2026-02-26
W2,bob@shop.com,Bob,Ray,,False,,2024-06-05
"""
POS = """source_id,email,first_name,last_name,phone,consent_marketing,consent_date,last_activity,store_code
P1,ann@shop.com,Ann,Lee-POS,+332,True,2024-05-30,2026-05-16,PAR01
"""
ERP = "product_ref,product_name,category,price_eur,stock_qty\nUC-QK-001,Shirt,T-shirts,41.30,486\n"
SHOP = "web_sku,product_ref,product_name,category,price_eur\nS1,UC-QK-001,Shirt web,T-shirts,31.90\nS2,WEB-AC-1,Bag,Bags,9.90\n"
STORES = "store_code,store_name,city,region,opened_date\nPAR01,Marais,Paris,IdF,2024-01-15\n"


@pytest.fixture()
def seed(tmp_path):
    folder = tmp_path / "seed"
    folder.mkdir()
    for name, text in {"customers_web": WEB, "customers_pos": POS, "products_erp": ERP, "products_web": SHOP,
                       "stores": STORES}.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


@pytest.fixture()
def house(spark, tmp_path, seed):
    made = Warehouse(spark, str(tmp_path / "house"))
    batch.load_seed(made, seed, systems=("web", "pos"))
    return made


NOW = "2026-06-21 00:00:00"


def run(house, texts, number, **options):
    days = dims.calendar(house.spark.sql("select date'2026-06-01' start, date'2026-06-30' end"))
    return batch.run_batch(house, frame(house.spark, texts), number, as_of=F.to_timestamp(F.lit(NOW)), calendar=days, **options)


def ids(df):
    return sorted(r["order_id"] for r in df.collect())


def test_csv_empty_is_null_and_unfit_lines_fail(spark, seed, tmp_path):
    rows = {r["source_id"]: r for r in read_seed(spark, seed, "customers_web").collect()}
    assert rows["W2"]["phone"] is None and rows["W2"]["consent_date"] is None
    assert rows["W1"]["consent_marketing"] is True and rows["W1"]["source_system"] == "web"
    bad = tmp_path / "bad.csv"
    bad.write_text("a,b\n1,x\n")
    with pytest.raises(Exception):
        read_csv(spark, str(bad), "a int, b int").collect()


def test_reference_load(house):
    star = batch.star(house)
    assert {r["email"]: r["last_name"] for r in star.customer.collect()} == {"Ann@shop.com": "Lee", "bob@shop.com": "Ray"}
    assert {r["product_ref"]: float(r["price_eur"]) for r in star.product.collect()} == {"UC-QK-001": 41.3, "WEB-AC-1": 9.9}
    assert star.product.filter("product_ref = 'WEB-AC-1'").first()["image_url"].endswith("/WEB-AC-1.jpg")
    assert {r["store_code"] for r in star.store.collect()} == {"PAR01", "ONLINE"}


def test_reference_reload_keeps_keys(house, seed):
    def members(star):
        return {r["email_normalized"]: (r["customer_key"], r["valid_from"]) for r in star.customer.collect()}

    before = members(batch.star(house))
    web = pathlib.Path(seed) / "customers_web.csv"
    web.write_text(WEB + "W3,new@shop.com,New,Kid,,True,2025-09-13,2026-02-26\n")
    after = members(batch.load_seed(house, seed, ("web", "pos")))
    assert after.pop("new@shop.com")[0] == 3
    assert before == after


def test_two_cycles(house):
    first = run(house, [message(), message(), message(order_id="B", product_ref="UC-QK-999"),
                        message(order_id="C", channel="phone")], 0)
    assert first.status == "OK" and first.newly_processed == 1
    assert first.counters == {"messages_read": 4, "events_failed": 1, "events_consumed": 2, "events_duplicate": 1,
                              "orders_unresolved": 1}
    assert ids(batch.sales(house)) == ["WEB-1"]

    # WEB-1 comes again and is dropped; B still waits; D is new
    second = run(house, [message(quantity=1, amount_eur=41.30), message(order_id="D", customer_email="BOB@shop.com")], 1)
    assert (second.counters["events_consumed"], second.counters["events_duplicate"]) == (1, 1)
    assert second.newly_processed == 1 and second.counters["orders_unresolved"] == 1
    assert ids(batch.sales(house)) == ["D", "WEB-1"]
    assert batch.sales(house).filter("order_id = 'WEB-1'").first()["quantity"] == 2

    # the missing product arrives: B leaves the backlog
    product = house.read("staging", "products_golden").limit(1).withColumn("product_ref", F.lit("UC-QK-999"))
    golden = house.read("staging", "products_golden").unionByName(product)
    house.commit(dims.dim_product(golden, house.read("dwh", "dim_product")), "dwh", "dim_product")
    third = run(house, [message(order_id="E")], 2)
    assert third.newly_processed == 2 and third.counters["orders_unresolved"] == 0
    assert ids(batch.sales(house)) == ["B", "D", "E", "WEB-1"]

    rebuilt = batch.rebuild_facts(house)
    assert ids(rebuilt) == ["B", "D", "E", "WEB-1"]
    run(house, [message(order_id="F")], 3)
    assert ids(batch.sales(house)) == ["B", "D", "E", "F", "WEB-1"]

    runs = {r["run_id"]: r for r in house.read("monitoring", "pipeline_runs").collect()}
    assert sorted(runs) == [0, 1, 2, 3] and {r["dq_status"] for r in runs.values()} == {"OK"}
    assert runs[0]["events_produced"] == 4 and runs[0]["duration_sec"] > 0
    assert house.read("staging", "quality_metrics").count() == 16


def test_delivering_a_batch_again_adds_nothing(house):
    texts = [message(), message(order_id="B"), message(order_id="C", channel="phone")]
    run(house, texts, 0)
    before = ids(ingest.landed_orders(house)), ids(batch.sales(house)), ingest.failed_events(house).count()
    run(house, texts, 0)
    assert (ids(ingest.landed_orders(house)), ids(batch.sales(house)), ingest.failed_events(house).count()) == before


def test_interrupted_load_is_completed(house, monkeypatch):
    def stop(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(batch, "finish_load", stop)
    with pytest.raises(RuntimeError):
        run(house, [message(), message(order_id="B", product_ref="UC-QK-999")], 0)
    logged = house.read("monitoring", "pipeline_runs").first()
    assert logged["dq_status"] == "ERROR"
    monkeypatch.undo()
    assert run(house, [message(), message(order_id="B", product_ref="UC-QK-999")], 0).status == "OK"
    assert ids(batch.sales(house)) == ["WEB-1"]
    assert ids(house.read("staging", "orders_backlog")) == ["B"]


def test_checks_see_repeats_of_earlier_loads(house):
    run(house, [message()], 0)
    repeat = ingest.landed_orders(house).drop("batch_id")
    house.write_slice(repeat, "raw", "streaming_orders", "batch_id", 1)
    rates = {r["metric_name"]: (r["metric_value"], r["status"]) for r in batch.checks(house, F.to_timestamp(F.lit(NOW))).collect()}
    rate, status = rates["streaming_duplicate_order_rate_pct"]
    assert rate > 0 and status == "ALERT"
    with pytest.raises(batch.ColumnTestsFailed):  # the doubled order is found by its test first
        run(house, [message(order_id="Z")], 2)


def test_a_load_of_repeats_only_is_fine(house):
    run(house, [message(), message(order_id="B")], 0)
    again = run(house, [message(), message(order_id="B")], 1)
    assert again.status == "OK" and again.newly_processed == 0 and again.counters["events_duplicate"] == 2
    stored = house.read("staging", "quality_metrics").filter("batch_id = 1").collect()
    assert {r["status"] for r in stored} == {"OK"} and all(r["metric_value"] is not None for r in stored)


def test_storage_does_not_grow_with_runs(house):
    def folders():
        tables = [("dwh", "dim_date"), ("dwh", "fact_sales"), ("staging", "load_progress"), ("staging", "orders_backlog"), ("raw", "streaming_orders")]
        return {t: len(house.versions(*t)) for t in tables}

    for n in range(3):
        run(house, [message(order_id=f"S{n}")], n)
    before = folders()
    for n in range(3, 6):
        run(house, [message(order_id=f"S{n}")], n)
    assert folders() == before and max(before.values()) <= 2


def test_history_of_ids_is_not_shuffled(house):
    run(house, [message(order_id=f"H{i}") for i in range(5)], 0)
    spark, limit = house.spark, house.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = spark.createDataFrame([("H1",), ("H9",)], "order_id string")
        left = landing.not_yet_landed(rows, spark.table(ingest.landed_ids(house)))
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning(order_id") == 1
        assert ids(left) == ["H9"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_stopped_rebuild_changes_nothing(house, monkeypatch):
    run(house, [message(), message(order_id="B", product_ref="UC-QK-999")], 0)
    product = house.read("staging", "products_golden").limit(1).withColumn("product_ref", F.lit("UC-QK-999"))
    golden = house.read("staging", "products_golden").unionByName(product)
    house.commit(dims.dim_product(golden, house.read("dwh", "dim_product")), "dwh", "dim_product")

    def stop(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(batch, "move_progress", stop)
    with pytest.raises(RuntimeError):
        batch.rebuild_facts(house)
    monkeypatch.undo()
    assert ids(batch.sales(house)) == ["WEB-1"]
    assert run(house, [message(order_id="E")], 1).newly_processed == 2
    assert ids(batch.sales(house)) == ["B", "E", "WEB-1"]
    assert ids(batch.rebuild_facts(house)) == ["B", "E", "WEB-1"]


def test_dead_letters_are_handed_on(house):
    sent = []
    run(house, [message(), message(order_id="C", channel="phone")], 0, dead_letter_sink=lambda letters: sent.extend(letters.collect()))
    assert [json.loads(r["value"])["original"]["order_id"] for r in sent] == ["C"]


def test_failing_column_test_fails_the_run(house, monkeypatch):
    tests = quality.DECLARED_TESTS + (quality.ColumnTest("stg_orders", "store_code", "not_null"),)
    monkeypatch.setattr(quality.run_tests, "__defaults__", (tests,))
    with pytest.raises(batch.ColumnTestsFailed):
        run(house, [message()], 0)
    row = house.read("monitoring", "pipeline_runs").first()
    assert row["dq_status"] == "ERROR" and "store_code" in row["notes"]
    assert batch.sales(house).count() == 0 and batch.progress(house)[0] == -1
    monkeypatch.undo()
    assert run(house, [message()], 0).newly_processed == 1  # the order was still pending


def test_alert_marks_the_run_but_does_not_fail_it(house):
    bad = [message(order_id=f"X{i}", channel="phone") for i in range(6)]
    result = run(house, [message(), *bad], 0)
    assert result.status == "ALERT" and result.alerts == ["failed_events_count_24h"]
    row = house.read("monitoring", "pipeline_runs").first()
    assert row["dq_status"] == "ALERT" and "failed_events_count_24h" in row["notes"]


def everything_with(house, address):
    """Every stored value that contains the address, by table."""
    found = {}
    for name, df in batch.personal_tables(house).items():
        text = df.select(F.lower(F.to_json(F.struct("*"))).alias("t"))
        hits = text.filter(F.col("t").contains(address)).count()
        if hits:
            found[name] = hits
    return found


def requests(spark, *addresses):
    return spark.createDataFrame([(a,) for a in addresses], "customer_email string")


def test_erasure_core_scope(house):
    run(house, [message(), message(order_id="B", customer_email="bob@shop.com"), message(order_id="C", channel="phone")], 0)
    counts = {r["email_normalized"]: r for r in
              batch.erase_subjects(house, requests(house.spark, " ANN@shop.com", "nobody@shop.com")).collect()}
    ann = counts["ann@shop.com"]
    assert (ann["fact_sales"], ann["streaming_orders"], ann["customers_golden"], ann["dim_customer"]) == (1, 1, 1, 1)
    assert counts["nobody@shop.com"]["dim_customer"] == 0
    assert ids(batch.sales(house)) == ["B"] and ids(ingest.landed_orders(house)) == ["B"]
    left = set(everything_with(house, "ann@shop.com"))
    assert left == {"customers_unified", "customers_web", "customers_pos", "failed_events", "dead_letters"}
    audit = house.read("audit", "gdpr_requests").collect()
    assert sorted(r["status"] for r in audit) == ["completed", "completed", "processing", "processing"]
    notes = [r["notes"] for r in audit if r["status"] == "completed" and "ANN" in r["customer_email"]]
    assert notes == ["Supprime staging=1, dwh=1, raw=1, fact_sales=1"]
    # loads go on afterwards
    assert run(house, [message(order_id="D", customer_email="bob@shop.com")], 1).newly_processed == 1


def test_erasure_full_scope_leaves_no_trace(house):
    run(house, [message(), message(order_id="B", customer_email="bob@shop.com"), message(order_id="C", channel="phone"),
                '{"customer_email": "Ann@shop.com", broken', '{"customer_email": "bob@shop.com", broken'], 0)
    batch.export_subjects(house, requests(house.spark, "ann@shop.com", "bob@shop.com")).collect()
    batch.register_views(house)
    batch.erase_subjects(house, requests(house.spark, "ann@shop.com"), full=True)
    assert everything_with(house, "ann@shop.com") == {}
    audit = house.read("audit", "gdpr_requests").filter(F.lower(F.to_json(F.struct("*"))).contains("ann@"))
    assert audit.count() == 0 and ids(batch.sales(house)) == ["B"]
    assert ids(house.spark.sql("select order_id from streaming_orders")) == ["B"]
    assert set(everything_with(house, "bob@shop.com")) >= {"failed_events", "dead_letters"}
    assert house.read("audit", "gdpr_requests").filter("customer_email = 'bob@shop.com'").count() == 1
    assert len(house.versions("raw", "streaming_orders")) == 1
    assert not [f for f in pathlib.Path(house.root).rglob("*.parquet") if b"ann@shop.com" in f.read_bytes().lower()]


def test_erasure_beside_a_load_covers_it_too(house, monkeypatch):
    run(house, [message(), message(order_id="B", customer_email="bob@shop.com")], 0)
    erase, loads = privacy.erase, iter([1])

    def with_a_load(*given):
        kept = erase(*given)
        for n in loads:
            late = [message(order_id="LATE", customer_email="bob@shop.com"), message(order_id="ANN2")]
            ingest.ingest_batch(frame(house.spark, late), n, house)
        return kept

    monkeypatch.setattr(batch.privacy, "erase", with_a_load)
    counts = batch.erase_subjects(house, requests(house.spark, "ann@shop.com")).first()
    assert (counts["fact_sales"], counts["streaming_orders"], counts["dim_customer"]) == (1, 2, 1)
    assert ids(ingest.landed_orders(house)) == ["B", "LATE"] and ids(batch.sales(house)) == ["B"]
    audit = house.read("audit", "gdpr_requests").collect()
    assert sorted((r["request_id"], r["status"]) for r in audit) == [(1, "completed"), (1, "processing")]


def stored_files(house):
    """Data files of the tables cut into loads with the time they were written."""
    root = pathlib.Path(house.root)
    return {str(f.relative_to(root)): f.stat().st_mtime_ns for t in ("raw/streaming_orders", "raw/failed_events", "raw/dead_letters", "dwh/fact_sales")
            for f in (root / t).rglob("*.parquet")}


def three_loads(house):
    """Ann is in load 1 alone, with an order, a reject and a message that can't be read."""
    bob = lambda n: message(order_id=f"B{n}", customer_email="bob@shop.com")
    for n in range(3):
        mine = [message(), message(order_id="A2", channel="phone"), '{"customer_email": "Ann@shop.com", broken'] if n == 1 else []
        run(house, [bob(n), message(order_id=f"R{n}", channel="phone", customer_email="bob@shop.com"), *mine], n)


def test_erasure_rewrites_only_folders_of_the_subject(house, monkeypatch):
    three_loads(house)
    before, read = stored_files(house), []
    digests = privacy.subject_digests
    monkeypatch.setattr(batch.privacy, "subject_digests", lambda rows, scope, load: read.append(
        (scope.table, sorted(r[0] for r in rows.select(load).distinct().collect()))) or digests(rows, scope, load))
    counts = batch.erase_subjects(house, requests(house.spark, "ann@shop.com"), full=True).first()
    assert (counts["fact_sales"], counts["streaming_orders"], counts["failed_events"], counts["dead_letters"]) == (1, 1, 2, 2)
    assert everything_with(house, "ann@shop.com") == {}
    after = stored_files(house)
    others = lambda files: {f: t for f, t in files.items() if "_id=1/" not in f}
    assert others(after) == others(before) and others(before)
    assert not {f for f in before if "_id=1/" in f} & set(after)
    assert ids(batch.sales(house)) == ids(ingest.landed_orders(house)) == ["B0", "B1", "B2"]
    assert dict(read) == {t: [0, 1, 2] for t in ("fact_sales", "streaming_orders", "failed_events", "dead_letters")}

    # The next one reads the rewritten load and the new one; loads known not to hold the subject stay as they are.
    run(house, [message(order_id="C", customer_email="cleo@shop.com")], 3)
    read.clear()
    kept = stored_files(house)
    batch.erase_subjects(house, requests(house.spark, "cleo@shop.com", "nobody@shop.com"))
    assert dict(read) == {"fact_sales": [1] if 3 not in {r[0] for r in batch.sales(house).select("load_id").collect()} else [1, 3],
                          "streaming_orders": [1, 3]}
    assert {f: t for f, t in stored_files(house).items() if "_id=3/" not in f} == {f: t for f, t in kept.items() if "_id=3/" not in f}
    assert ids(ingest.landed_orders(house)) == ["B0", "B1", "B2"]


def test_checks_after_an_erasure_are_those_of_whole_tables(house):
    three_loads(house)
    batch.erase_subjects(house, requests(house.spark, "ann@shop.com"), full=True)
    run(house, [message(order_id="B3", customer_email="bob@shop.com")], 3)
    kept = {(r["table"], r["load"]): r["rows"] for r in house.read("monitoring", "load_profiles").collect()}
    assert {n: kept["streaming_orders", n] for n in range(4)} == {n: 1 for n in range(4)}
    assert {n: kept["failed_events", n] for n in range(3)} == {n: 1 for n in range(3)}
    assert {n: kept["fact_sales", n] for n in range(4)} == {n: 1 for n in range(4)}


def test_stopped_erasure_is_finished_by_the_next(house, monkeypatch):
    three_loads(house)
    overwrite = Warehouse.overwrite_slices

    def stop(self, df, layer, table, *more):
        overwrite(self, df, layer, table, *more)
        if table == "streaming_orders":
            raise RuntimeError("stopped")

    monkeypatch.setattr(Warehouse, "overwrite_slices", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        batch.erase_subjects(house, requests(house.spark, "ann@shop.com"))
    monkeypatch.undo()
    batch.erase_subjects(house, requests(house.spark, "ann@shop.com"))
    assert ids(batch.sales(house)) == ids(ingest.landed_orders(house)) == ["B0", "B1", "B2"]
    assert not house.exists("staging", "erasing_streaming_orders") and not house.exists("staging", "erasing_streaming_orders_loads")


def test_load_written_again_is_looked_through_again(house):
    run(house, [message(order_id="B", customer_email="bob@shop.com")], 0)
    batch.erase_subjects(house, requests(house.spark, "nobody@shop.com"))
    ingest.ingest_batch(frame(house.spark, [message(order_id="B", customer_email="bob@shop.com"), message(order_id="A")]), 0, house)
    batch.erase_subjects(house, requests(house.spark, "ann@shop.com"))
    assert ids(ingest.landed_orders(house)) == ["B"]


def test_export_logs_the_access(house):
    rows = batch.export_subjects(house, requests(house.spark, "ann@shop.com")).collect()
    assert sorted(r["source_system"] for r in rows) == ["pos", "web"]
    batch.export_subjects(house, requests(house.spark, "bob@shop.com"))
    audit = house.read("audit", "gdpr_requests").collect()
    assert sorted((r["request_id"], r["request_type"], r["status"]) for r in audit) == [
        (1, "access", "completed"), (2, "access", "completed")]


def test_snapshots_and_slices(spark, tmp_path):
    made = Warehouse(spark, str(tmp_path / "w"))
    assert not made.exists("raw", "t") and made.read("raw", "t", "a int").count() == 0
    made.commit(spark.range(3), "raw", "t")
    reader = made.read("raw", "t")
    made.commit(reader.filter("id > 0"), "raw", "t")
    assert made.read("raw", "t").count() == 2 and reader.count() == 3
    (tmp_path / "w/raw/t/v000000009").mkdir()  # a writer that died
    assert made.read("raw", "t").count() == 2
    for _ in range(2):
        made.write_slice(spark.range(4), "raw", "s", "batch_id", 5)
    made.write_slice(spark.range(1), "raw", "s", "batch_id", 6)
    assert made.read("raw", "s").groupBy("batch_id").count().orderBy("batch_id").collect() == [(5, 4), (6, 1)]


def test_views_answer_sql(house):
    run(house, [message(), message(order_id="B", product_ref="UC-QK-999")], 0)
    batch.register_views(house)
    sql = house.spark.sql
    assert ids(sql("select order_id from stg_orders")) == ["B"]
    assert sql("select count(*) from streaming_orders where processed").first()[0] == 1
    sale = sql("select * from v_sales_analytics").first()
    assert (sale["email_masked"], sale["store_name"], sale["channel_name"]) == ("***@shop.com", "En ligne", "Site e-commerce")
    assert sql("select first_name_masked from dim_customer_anonymized order by 1").first()[0] == "A***"
    assert sql("select count(*) from quality_metrics").first()[0] == 4
    assert sql("select events_consumed from pipeline_runs").first()[0] == 2


def test_payload_is_kept_and_calendar_extended(house):
    run(house, [message(), message(order_id="B", product_ref="UC-QK-999")], 0)
    assert json.loads(ingest.landed_orders(house).filter("order_id = 'B'").first()["payload"])["product_ref"] == "UC-QK-999"
    assert dt.date(2026, 6, 20) in [r["full_date"] for r in batch.star(house).date.collect()]
