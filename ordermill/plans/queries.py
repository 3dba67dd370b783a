"""The registered queries: every operator over the whole retail tables.

Each query takes a session and a folder of tables. Money leaves as whole
cents and dates as text, so that results compare exactly with other engines.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.events import parse_events
from ordermill.functions.text import digest, normalise
from ordermill.operators import conform, dims, facts, landing, monitor, privacy, quality, rules
from ordermill.operators.facts import Star
from ordermill.plans import batch
from ordermill.schemas import LANDED_COLUMNS
from ordermill.session import CODEC, discard, freed, in_slices, materialise, materialise_slices, scratch_folder, sized, slices_for, together
from ordermill.sources.csvfiles import read_seed
from ordermill.sources.retail import Retail
from ordermill.sources.streams import captured_orders
from ordermill.sources.tables import Warehouse
from ordermill.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

# The share of rejects, in percent, a month may have before it alerts.
REJECT_TARGET = "17.5"
GAUGE_LEVELS = ((0, "green"), (2000, "yellow"), (6000, "red"))


def query(run: Callable[[Retail], DataFrame]) -> Callable[[Retail], DataFrame]:
    REGISTRY[run.__name__] = lambda spark, folder: run(Retail(spark, folder))
    return run


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("long")


def in_cents(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.withColumn(c.replace("_eur", "") + "_cents", cents(c)).drop(c)
    return df


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


# Stages shared by the queries.


def judged(r: Retail) -> DataFrame:
    return rules.judge(parse_events(r.order_messages()))


def landed(r: Retail, events: DataFrame | None = None) -> DataFrame:
    """Landed orders; the event time stands for the time of consumption."""
    return landing.land(judged(r) if events is None else events, F.col("order_timestamp"))


def stored_landed(r: Retail, events: DataFrame | None = None) -> DataFrame:
    """Landed orders as a table; the message text is left out, as no reader needs it.

    Columns that follow from others are not stored but added when they are read. Many messages land in slices by order id;
    then accepted ones are stored first, slice by slice of the source, and go as they have landed.
    """
    slices = slices_for(r.line_count())

    def pieces() -> Iterator[DataFrame]:
        if slices == 1:
            yield landed(r, events)
        elif events is not None:
            yield from (landed(r, part) for part in in_slices(events, slices, "order_id"))
        else:
            kept = [c for c in ingest.KEPT_COLUMNS if c != "payload"]
            accepted = [rules.accepted(rules.judge(parse_events(m)).select(*kept)) for m in r.sliced_messages()]
            for part in materialise_slices(accepted, "judged", slices, "order_id"):
                yield landed(r, part.withColumn("payload", F.lit(None).cast("string")))
                discard(part)

    stored = materialise((rows.drop("payload", "event_id", "consumed_at") for rows in pieces()), "landed")
    derived = {"event_id": digest(F.col("order_id")), "consumed_at": F.col("order_timestamp")}
    return stored.withColumns(derived).select(*[c for c in LANDED_COLUMNS if c != "payload"])


def judged_once(r: Retail) -> DataFrame:
    """Judged messages as a table, for queries that read accepted and rejected ones; with the text of rejects, as no reader needs others."""
    text = F.when(F.col("error_code").isNotNull(), F.col("payload"))
    return materialise(judged(r).select(*ingest.KEPT_COLUMNS).withColumn("payload", text), "judged")


def golden(r: Retail) -> DataFrame:
    return conform.golden_customers(conform.unify_customers(r.customer_sources()), r.as_of())


def golden_products(r: Retail) -> DataFrame:
    return conform.golden_products(conform.unify_products(r.products_erp(), r.products_web()))


def customers(r: Retail) -> DataFrame:
    return dims.dim_customer(materialise(golden(r), "golden"), loaded_at=r.as_of().cast("timestamp"))


def products(r: Retail) -> DataFrame:
    return dims.dim_product(materialise(golden_products(r), "golden-products"))


def stored_star(r: Retail) -> Star:
    return Star(*together(
        lambda: materialise(dims.calendar(r.day_span()), "dim-date"),
        lambda: materialise(dims.dim_channel(r.spark), "dim-channel"),
        lambda: materialise(dims.dim_store(r.stores()), "dim-store"),
        lambda: materialise(customers(r), "dim-customer"),
        lambda: materialise(products(r), "dim-product"),
    ))


def stored_orders(r: Retail, events: DataFrame | None = None) -> tuple[DataFrame, Star]:
    """Landed orders and dimensions, each stored once."""
    orders, star = together(lambda: stored_landed(r, events), lambda: stored_star(r))
    return orders, star


def stored_sales(r: Retail, events: DataFrame | None = None) -> tuple[DataFrame, Star, DataFrame]:
    """Landed orders, dimensions and the full fact, each stored once."""
    orders, star = stored_orders(r, events)
    resolved = facts.resolved_slices(orders, star, slices_for(r.line_count()))
    return orders, star, materialise((facts.complete(part) for part in resolved), "fact")


def fact_view(fact: DataFrame) -> DataFrame:
    return as_text(in_cents(fact, "unit_price_eur", "amount_eur"), "order_timestamp")


# Parsing, rules, landing.


@query
def order_events_parsed(r: Retail) -> DataFrame:
    parsed = parse_events(r.order_messages())
    return as_text(in_cents(parsed.select(
        "topic", "order_id", "customer_email", "channel", "store_code", "product_ref",
        F.col("quantity_number").cast("int").alias("quantity"), "unit_price", "amount", "order_timestamp",
    ), "unit_price", "amount"), "order_timestamp")


@query
def rule_verdict(r: Retail) -> DataFrame:
    return judged(r).select("topic", "order_id", "error_code")


@query
def rejects_by_reason(r: Retail) -> DataFrame:
    return landing.rejects_by_reason(judged(r))


def faulty_messages(r: Retail) -> DataFrame:
    """One hand-made message per row of ``events``, with type faults by kind of event."""
    e = r.table("events").withColumn("cents", F.expr("cast(round(value * 100) as bigint)"))

    def money(value: str) -> Column:
        return F.concat(F.expr(f"({value}) div 100").cast("string"), F.lit("."),
                        F.lpad(F.expr(f"({value}) % 100").cast("string"), 2, "0"))

    kind, n = F.col("event_type"), F.col("event_id")
    amount = (
        F.when(n % 7 == 0, '"abc"').when(n % 7 == 1, F.concat(F.lit('"'), money("cents * 2"), F.lit('"')))
        .when(n % 7 == 2, "null").otherwise(money("cents * 2"))
    )
    units = F.when(kind == "click", '"2"').when((kind == "view") & (n % 2 == 0), "1.5").otherwise("2")
    when = F.when((kind == "signup") & (n % 2 == 0), '"not a date"').when(
        (kind == "signup") & (n % 3 == 0), '"2024-13-45T00:00:00Z"').otherwise('"2024-01-31T10:00:00+02:00"')
    text = F.concat(
        F.lit('{"order_id":"EV-'), n, F.lit('","customer_email":"user'), F.col("user_id"),
        F.lit('@shop.com","channel":"web","product_ref":"UC-AA-'),
        F.lpad(F.expr("cast(user_id % 1000 as string)"), 3, "0"), F.lit('","quantity":'), units,
        F.lit(',"unit_price_eur":'), money("cents"), F.lit(',"amount_eur":'), amount,
        F.lit(',"order_timestamp":'), when, F.lit(',"props":'), F.col("props"),
        F.when((kind == "error") & (n % 2 == 0), "").otherwise("}"),
        F.when(n % 11 == 3, " trailing").when(n % 11 == 4, '{"order_id":"second"}').otherwise(""),
    )
    return e.select(F.lit("orders.web").alias("topic"), F.struct("ts", "event_id").alias("arrival"),
                    text.alias("value"))


@query
def parse_error_quarantine(r: Retail) -> DataFrame:
    return rules.judge(parse_events(faulty_messages(r))).select(
        F.col("arrival.event_id").alias("event_id"), "payload", "error_code")


@query
def landed_orders(r: Retail) -> DataFrame:
    return as_text(in_cents(landed(r).drop("payload", "consumed_at"), "unit_price_eur", "amount_eur"),
                   "order_timestamp")


@query
def batch_counters(r: Retail) -> DataFrame:
    return landing.batch_counters(judged(r))


@query
def dead_letter_envelope(r: Retail) -> DataFrame:
    letters = landing.dead_letters(landing.failed_events(judged(r), F.col("order_timestamp")))
    envelope = letters.select(F.from_json("value", "original struct<order_id: string>, error string").alias("e"))
    return envelope.select("e.original.order_id", "e.error")


@query
def failed_events(r: Retail) -> DataFrame:
    failed = landing.failed_events(judged(r), F.col("order_timestamp"))
    return as_text(failed.select("source_topic", F.get_json_object("payload", "$.order_id").alias("order_id"),
                                 "error_code", "error_reason", "failed_at"), "failed_at")


@query
def stream_landed(r: Retail) -> DataFrame:
    """The messages as a stream in three drops with one checkpoint, landed exactly once; with fields of the kept text."""
    landed_rows = ingest.landed_orders(streamed(r)).withColumns({
        "sent_order_id": F.get_json_object("payload", "$.order_id"),
        "sent_quantity": F.get_json_object("payload", "$.quantity")})
    return as_text(in_cents(landed_rows.drop("payload", "consumed_at", ingest.BATCH), "unit_price_eur", "amount_eur"),
                   "order_timestamp")


@query
def stream_failed(r: Retail) -> DataFrame:
    """The rejects of the same stream."""
    failed = ingest.failed_events(streamed(r))
    return failed.select("source_topic", F.get_json_object("payload", "$.order_id").alias("order_id"), "error_code", "error_reason")


def streamed(r: Retail) -> Warehouse:
    """Tables after a stream of all messages, dropped and ingested by thirds of the days, earliest first."""
    folder = scratch_folder(r.spark, "stream")
    house = Warehouse(r.spark, f"{folder}/tables")
    third = r.day_span().select(
        *[F.date_add("start", F.expr(f"cast(datediff(end, start) * {k} / 3 as int)")) for k in (1, 2)]).first()
    day = F.col("arrival.l_shipdate")
    for drop in (day < F.lit(third[0]), (day >= F.lit(third[0])) & (day < F.lit(third[1])), day >= F.lit(third[1])):
        # The days are cut where lines are read, so each line is joined once, and a message lies in the inbox alone.
        for messages in r.sliced_messages(share=3):
            with freed(r.spark):
                messages.filter(drop).write.option("compression", CODEC).mode("append").parquet(f"{folder}/inbox")
        stream = captured_orders(r.spark, f"{folder}/inbox", messages.schema)
        ingest.start_ingest(stream, house, f"{folder}/offsets").awaitTermination()
    return house


@query
def stream_deduplicated(r: Retail) -> DataFrame:
    """Ids let through by the bounded-state variant in several batches; its bound is far shorter than the span of the data."""
    folder = scratch_folder(r.spark, "stream")
    messages = r.order_messages()
    messages.write.parquet(f"{folder}/inbox")
    # A third of the files a batch: their number follows the rows, so that no file or task grows with the table.
    files = len(r.spark.read.schema(messages.schema).parquet(f"{folder}/inbox").inputFiles())
    stream = captured_orders(r.spark, f"{folder}/inbox", messages.schema, files_per_batch=max(-(-files // 3), 1))
    orders = ingest.accepted_stream(stream, late="1 day")
    sink = orders.select("order_id").writeStream.format("parquet").option("path", f"{folder}/kept").option(
        "checkpointLocation", f"{folder}/offsets")
    sink.trigger(availableNow=True).start().awaitTermination()
    return r.spark.read.schema("order_id string").parquet(f"{folder}/kept")


# Conforming and dimensions.


@query
def customers_unified(r: Retail) -> DataFrame:
    return as_text(conform.unify_customers(r.customer_sources()), "consent_date", "last_activity")


@query
def products_unified(r: Retail) -> DataFrame:
    return in_cents(conform.unify_products(r.products_erp(), r.products_web()), "price_eur")


@query
def customers_golden(r: Retail) -> DataFrame:
    return as_text(golden(r), "consent_date", "last_activity")


@query
def products_golden(r: Retail) -> DataFrame:
    return in_cents(golden_products(r), "price_eur")


@query
def dim_date(r: Retail) -> DataFrame:
    return as_text(dims.calendar(r.day_span()), "full_date")


@query
def dim_date_extension(r: Retail) -> DataFrame:
    """Days around the last order date that the shipping calendar does not hold yet."""
    known = dims.calendar(r.day_span().select("start", F.date_sub("end", 100).alias("end")))
    around = dims.calendar_around(r.spark, r.as_of(), dims.CALENDAR_EXTENSION_DAYS, padded=True)
    return as_text(dims.missing_members(around, known, "full_date").select(*around.columns), "full_date")


@query
def dim_channel(r: Retail) -> DataFrame:
    """Channels with the number of orders placed through them."""
    placed = landed(r).groupBy(F.col("channel").alias("channel_code")).agg(F.count("*").alias("orders"))
    return dims.dim_channel(r.spark).join(placed, "channel_code", "left")


@query
def dim_store_upsert(r: Retail) -> DataFrame:
    """Stores in credit were loaded before under an older name; now all are loaded, some codes twice."""
    older = r.stores("s_acctbal > 0").withColumn("store_name", F.concat(F.lit("Old "), "store_name"))
    copies = r.stores("s_acctbal > 5000").withColumn("store_name", F.concat(F.lit("Copy of "), "store_name"))
    now = r.stores().unionByName(copies)
    return dims.dim_store(now, materialise(dims.dim_store(older.unionByName(older)), "dim-store"))


@query
def dim_customer(r: Retail) -> DataFrame:
    return as_text(customers(r), "consent_date", "last_activity", "valid_from").drop("valid_to")


@query
def dim_product(r: Retail) -> DataFrame:
    return in_cents(products(r), "price_eur")


@query
def customer_history(r: Retail) -> DataFrame:
    """Web and pos were loaded a year earlier; with the CRM, what is known changes."""
    first = conform.golden_customers(
        conform.unify_customers({"web": r.customer_sources()["web"], "pos": r.customer_sources()["pos"]}),
        F.date_sub(r.as_of(), 365))
    started = F.to_timestamp(F.lit("1995-01-01"))
    history = first.select("email_normalized", *dims.CUSTOMER_ATTRIBUTES, started.alias("valid_from"),
                           F.lit(None).cast("timestamp").alias("valid_to"))
    changed = dims.customer_history(materialise(history, "history"), golden(r), r.as_of().cast("timestamp"))
    return as_text(changed, "consent_date", "last_activity", "valid_from", "valid_to")


@query
def golden_enriched(r: Retail) -> DataFrame:
    enriched = conform.enrich_golden(golden(r), landed(r))
    return as_text(enriched.select("email_normalized", "last_activity", "last_order_at", "order_count", "last_seen"),
                   "last_activity", "last_order_at", "last_seen")


@query
def price_reconcile(r: Retail) -> DataFrame:
    return in_cents(conform.reconcile_products(r.products_erp(), r.products_web())
                    .withColumnsRenamed({"erp_price": "erp_price_eur", "web_min": "web_min_eur",
                                         "web_max": "web_max_eur"}),
                    "erp_price_eur", "web_min_eur", "web_max_eur")


@query
def price_variance(r: Retail) -> DataFrame:
    varied = conform.price_variance(landed(r), golden_products(r))
    return in_cents(varied, "price_eur", "lowest_price", "highest_price")


# Staging and facts.


@query
def stg_orders_pending(r: Retail) -> DataFrame:
    """Orders left after everything up to two years before the end was loaded."""
    orders, star = stored_orders(r)
    loaded = materialise(facts.build_fact(before(orders, r), star).select("order_id"), "loaded")
    return fact_view(facts.pending(orders, loaded))


def before(orders: DataFrame, r: Retail, days: int = 730) -> DataFrame:
    return orders.filter(F.col("order_timestamp") < F.date_sub(r.as_of(), days))


@query
def stg_customers(r: Retail) -> DataFrame:
    return as_text(conform.customers_in_stream(landed(r)), "last_order_at")


@query
def fact_sales_full(r: Retail) -> DataFrame:
    return fact_view(facts.build_fact(*stored_orders(r)))


@query
def fact_sales_skewed(r: Retail) -> DataFrame:
    """The full fact with no dimension broadcast, and every busy key cut into parts."""
    orders, star = stored_orders(r)
    return fact_view(facts.build_fact(orders, star, broadcast_rows=0, rows_per_salt=50))


@query
def fact_sales_incremental(r: Retail) -> DataFrame:
    """New fact rows when everything up to two years before the end is loaded already."""
    orders, star = stored_orders(r)
    loaded = materialise(facts.build_fact(before(orders, r), star).select("order_id"), "loaded")
    return fact_view(facts.build_fact(orders, star, loaded))


@query
def mark_processed(r: Retail) -> DataFrame:
    """Orders that turn processed with the load after that."""
    orders, star, fact = stored_sales(r)
    loaded = materialise(facts.build_fact(before(orders, r), star).select("order_id"), "loaded")
    return facts.newly_processed(orders, loaded, fact).agg(F.count("*").alias("newly_processed"))


@query
def processed_backlog(r: Retail) -> DataFrame:
    orders, _, fact = stored_sales(r)
    return monitor.backlog(facts.with_processed(orders, fact))


@query
def unresolved_orders(r: Retail) -> DataFrame:
    waiting = facts.unresolved_orders(*stored_orders(r))
    return waiting.select("order_id", "customer_email", "product_ref", "missing")


@query
def orders_unified(r: Retail) -> DataFrame:
    return as_text(in_cents(conform.unify_orders(*r.historical_orders()), "unit_price_eur", "amount_eur"),
                   "order_date")


@query
def fact_from_history(r: Retail) -> DataFrame:
    """The fact built from the historical orders of both kinds."""
    history = conform.unify_orders(*r.historical_orders()).withColumnRenamed("order_date", "order_timestamp")
    orders, star = together(lambda: materialise(history, "history"), lambda: stored_star(r))
    return fact_view(facts.build_fact(orders, star))


@query
def pipeline_run(r: Retail) -> DataFrame:
    """The whole cycle on stored tables: reference load, ingest, fact, tests, checks, log."""
    house = Warehouse(r.spark, scratch_folder(r.spark, "run"))
    calendar = dims.calendar(r.day_span())
    with sized(r.spark, r.line_count()):
        batch.load_reference(house, r.customer_sources(), r.products_erp(), r.products_web(), r.stores(),
                             r.as_of(), calendar)
        batch.run_batch(house, r.sliced_messages(), 0, calendar=calendar)
    return fact_view(batch.sales(house).drop(batch.LOAD, batch.MONTH))


def two_cycles(r: Retail) -> Warehouse:
    """Tables after two full cycles: all messages, then a tenth of the parts' messages once more."""
    house = Warehouse(r.spark, scratch_folder(r.spark, "run"))
    calendar = dims.calendar(r.day_span())
    with sized(r.spark, r.line_count()):
        batch.load_reference(house, r.customer_sources(), r.products_erp(), r.products_web(), r.stores(),
                             r.as_of(), calendar)
        again = [m.filter(F.col("arrival.l_partkey") % 10 == 0) for m in r.sliced_messages()]
        for number, messages in enumerate((r.sliced_messages(), again)):
            batch.run_batch(house, messages, number, calendar=calendar)
    return house


@query
def pipeline_metrics(r: Retail) -> DataFrame:
    """The metrics that both cycles stored."""
    stored = two_cycles(r).read("staging", "quality_metrics")
    return stored.select(ingest.BATCH, "metric_name", F.col("metric_value").cast("double"),
                         F.col("target_value").cast("double"), "status")


@query
def pipeline_tests(r: Retail) -> DataFrame:
    """The column tests that both cycles stored."""
    return batch.column_test_results(two_cycles(r))


@query
def pipeline_log(r: Retail) -> DataFrame:
    """The run log of both cycles, as the dashboards read it."""
    runs = two_cycles(r).read("monitoring", "pipeline_runs")
    return monitor.latest_runs(runs).drop("duration_sec", "started_at").join(runs.select("run_id", "events_duplicate"), "run_id")


@query
def backlog_resolved(r: Retail) -> DataFrame:
    """Facts with the cycle that loaded them: shop products and the last year of the calendar are there from the second one on."""
    house = Warehouse(r.spark, scratch_folder(r.spark, "run"))
    whole = r.day_span()
    early = dims.calendar(whole.select("start", F.date_sub("end", 365).alias("end")))
    with sized(r.spark, r.line_count()):
        for number, (web, calendar) in enumerate(((r.products_web().limit(0), early), (r.products_web(), dims.calendar(whole)))):
            batch.load_reference(house, r.customer_sources(), r.products_erp(), web, r.stores(), r.as_of(), calendar)
            messages = [m if number == 0 else m.filter(F.col("arrival.l_partkey") % 10 == 0) for m in r.sliced_messages()]
            batch.run_batch(house, messages, number, calendar=calendar)
    return batch.sales(house).select("order_id", batch.LOAD)


@query
def fact_rebuilt(r: Retail) -> DataFrame:
    """The fact after two cycles and a full refresh."""
    return fact_view(batch.rebuild_facts(two_cycles(r)).drop(batch.LOAD, batch.MONTH))


@query
def seed_customers(r: Retail) -> DataFrame:
    """Customers of the shops, written as CSV files and read as seed."""
    folder = scratch_folder(r.spark, "seed")
    r.customer_sources()["pos"].write.option("header", True).csv(f"{folder}/customers_pos.csv")
    return as_text(read_seed(r.spark, folder, "customers_pos").drop("loaded_at"), "consent_date", "last_activity")


# Quality.


@query
def dq_metrics(r: Retail) -> DataFrame:
    events = judged_once(r)
    orders, star, fact = stored_sales(r, events)
    failed = landing.failed_events(events, F.col("order_timestamp"))
    as_of = orders.agg(F.max("consumed_at")).scalar()
    checks = quality.run_checks(orders, failed, fact, star.product, as_of)
    return checks.select("metric_name", F.col("metric_value").cast("double"), F.col("target_value").cast("double"),
                         "status")


@query
def dq_metrics_raw_events(r: Retail) -> DataFrame:
    """The same checks on what was sent: repeats count, and facts face the ERP catalogue only."""
    events = judged_once(r)
    _, star, fact = stored_sales(r, events)
    sent = events.select("order_id", F.col("amount").alias("amount_eur"), F.col("order_timestamp").alias("consumed_at"))
    sold = fact.join(star.product.select("product_key", "product_ref"), "product_key").drop("product_key")
    listed = r.products_erp().select(F.col("product_ref").alias("product_key"))
    as_of = sent.agg(F.max("consumed_at")).scalar()
    checks = quality.judge_metrics(reduce(DataFrame.unionByName, [
        quality.null_rate(sent, as_of), quality.duplicate_rate(sent),
        quality.orphan_rate(sold.withColumnRenamed("product_ref", "product_key"), listed)]))
    return checks.select("metric_name", F.col("metric_value").cast("double"), F.col("target_value").cast("double"),
                         "status")


@query
def dq_status(r: Retail) -> DataFrame:
    events = judged_once(r)
    orders, star, fact = stored_sales(r, events)
    failed = landing.failed_events(events, F.col("order_timestamp"))
    checks = quality.run_checks(orders, failed, fact, star.product, orders.agg(F.max("consumed_at")).scalar())
    status = quality.overall_status(checks)
    return status.select("dq_status", monitor.run_status(F.col("dq_status")).alias("run_status"))


@query
def column_tests(r: Retail) -> DataFrame:
    orders, star, fact = stored_sales(r)
    return quality.run_tests({"stg_orders": facts.staged_orders(orders), "fact_sales": fact,
                              "dim_product": star.product, "dim_customer": star.customer})


@query
def column_tests_raw_events(r: Retail) -> DataFrame:
    """The order tests on what was sent, where they do find failures."""
    sent = judged(r).select("order_id", "customer_email", F.col("amount").alias("amount_eur"))
    return quality.run_tests({"stg_orders": materialise(sent, "sent")}, quality.STAGED_ORDER_TESTS)


@query
def constraint_tests(r: Retail) -> DataFrame:
    orders, star, fact = stored_sales(r)
    return quality.run_tests({
        "streaming_orders": orders, "customers_golden": golden(r), "products_golden": golden_products(r),
        "dim_date": star.date, "dim_channel": star.channel, "dim_store": star.store,
        "dim_customer": star.customer, "dim_product": star.product, "fact_sales": fact,
    }, quality.CONSTRAINTS)


# Privacy.


def requests(r: Retail) -> DataFrame:
    """Customers in debt ask, spelling their address their own way."""
    return r.table("customer").filter("c_acctbal <= 0").select(
        F.concat(F.lit(" CUSTOMER"), "c_custkey", F.lit("@Email.COM ")).alias("customer_email"))


def stored_personal(r: Retail) -> dict[str, DataFrame]:
    orders, star, fact = stored_sales(r)
    return {"fact_sales": fact, "streaming_orders": orders, "customers_golden": materialise(golden(r), "golden"),
            "dim_customer": star.customer}


@query
def dim_customer_masked(r: Retail) -> DataFrame:
    return as_text(privacy.masked_customers(customers(r)), "consent_date", "last_activity")


@query
def sales_analytics(r: Retail) -> DataFrame:
    _, star, fact = stored_sales(r)
    return as_text(in_cents(privacy.sales_analytics(fact, star), "amount_eur"), "full_date")


@query
def export_subjects(r: Retail) -> DataFrame:
    exported = privacy.export_subjects(conform.unify_customers(r.customer_sources()), requests(r))
    return as_text(exported, "last_activity")


@query
def erase_counts(r: Retail) -> DataFrame:
    tables = stored_personal(r)
    return privacy.erasure_counts(tables, privacy.find_subjects(tables["dim_customer"], requests(r)))


@query
def erase_effect(r: Retail) -> DataFrame:
    tables = stored_personal(r)
    return privacy.before_after(tables, privacy.erase(tables, privacy.find_subjects(tables["dim_customer"], requests(r))))


@query
def erase_full_effect(r: Retail) -> DataFrame:
    """Rows that a full erasure deletes from each stored table after a full cycle."""
    house = Warehouse(r.spark, scratch_folder(r.spark, "erase"))
    calendar = dims.calendar(r.day_span())
    with sized(r.spark, r.line_count()):
        batch.load_reference(house, r.customer_sources(), r.products_erp(), r.products_web(), r.stores(), r.as_of(), calendar)
        batch.run_batch(house, r.sliced_messages(), 0, calendar=calendar)
    counts = batch.erase_subjects(house, requests(r), full=True)
    tables = [c for c in counts.columns if c != "email_normalized"]
    return counts.agg(*[F.sum(t).alias(t) for t in tables]).unpivot([], tables, "table", "rows_deleted")


@query
def fact_after_erasure(r: Retail) -> DataFrame:
    tables = stored_personal(r)
    return fact_view(privacy.erase(tables, privacy.find_subjects(tables["dim_customer"], requests(r)))["fact_sales"])


def audit(r: Retail) -> DataFrame:
    """Audit rows of an access and an erasure request by every subject."""
    tables, asked = stored_personal(r), materialise(requests(r), "requests")
    counts = privacy.erasure_counts(tables, privacy.find_subjects(tables["dim_customer"], asked))
    at = r.as_of().cast("timestamp")
    access = privacy.audit_requests(asked, "access", "completed", at)
    last = access.agg(F.coalesce(F.max("request_id"), F.lit(0))).scalar()
    processing = privacy.audit_requests(asked, "erasure", "processing", at, last, F.lit(privacy.ERASURE_NOTE))
    completed = privacy.complete_erasure(processing, counts, at)
    return access.unionByName(processing).unionByName(completed)


@query
def audit_trail(r: Retail) -> DataFrame:
    return as_text(privacy.current_requests(audit(r)), "requested_at", "processed_at")


@query
def latest_audit(r: Retail) -> DataFrame:
    """The last two audit rows of the subject whose address sorts last."""
    trail = materialise(audit(r), "audit")
    subject = trail.agg(F.max(normalise(F.col("customer_email")))).scalar()
    return monitor.latest_requests(privacy.current_requests(trail), subject)


@query
def subject_facts(r: Retail) -> DataFrame:
    """Facts of the customer who ordered most, found by address."""
    orders, star, fact = stored_sales(r)
    spelled = orders.groupBy("customer_email").agg(F.count("*").alias("n"))
    most = spelled.agg(F.max_by("customer_email", F.struct("n", "customer_email"))).scalar()
    return monitor.facts_of_subject(fact, star.customer, most)


# Monitoring.


def monthly_counts(r: Retail) -> DataFrame:
    """Messages, rejects and landed orders per month of event time; a month stands for a run."""
    events = judged_once(r)

    def month(df: DataFrame) -> DataFrame:
        return df.groupBy(F.trunc(F.to_date("order_timestamp"), "month").alias("month"))

    read = month(events).agg(F.count("*").alias("events_produced"), F.count("error_code").alias("events_failed"))
    kept = month(landed(r, events)).agg(F.count("*").alias("events_consumed"))
    return read.join(kept, "month", "left").withColumn("events_consumed", F.coalesce("events_consumed", F.lit(0)))


def run_log(r: Retail) -> DataFrame:
    counts = monthly_counts(r).withColumn(
        "reject_pct", quality.percent(F.col("events_failed"), F.col("events_produced")))
    checked = quality.verdict(F.col("reject_pct"), F.lit(REJECT_TARGET).cast("decimal(14,4)"), F.lit("lte"))
    return counts.select(
        (F.year("month") * 100 + F.month("month")).cast("long").alias("run_id"),
        F.lit(monitor.PIPELINE_ID).alias("dag_id"),
        F.col("month").cast("timestamp").alias("started_at"),
        "events_produced", "events_consumed", "events_failed",
        monitor.run_status(checked).alias("dq_status"),
        monitor.run_notes(checked).alias("notes"),
        F.lit(0).cast("decimal(10,2)").alias("duration_sec"),
        "reject_pct",
    )


@query
def run_history(r: Retail) -> DataFrame:
    return as_text(run_log(r).drop("duration_sec", "reject_pct"), "started_at")


@query
def consumed_series(r: Retail) -> DataFrame:
    return as_text(monitor.consumed_series(run_log(r)), "time")


@query
def latest_runs(r: Retail) -> DataFrame:
    return as_text(monitor.latest_runs(run_log(r)).drop("duration_sec"), "started_at")


@query
def latest_metrics(r: Retail) -> DataFrame:
    """Ten latest readings of the monthly reject rate."""
    read = run_log(r).select(F.lit("reject_rate_pct").alias("metric_name"), F.col("reject_pct").alias("metric_value"),
                             F.lit(REJECT_TARGET).cast("decimal(14,4)").alias("target_value"),
                             F.col("dq_status").alias("status"), F.col("started_at").alias("measured_at"))
    last = monitor.latest_metrics(read)
    return as_text(last.withColumns({"metric_value": F.col("metric_value").cast("double"),
                                     "target_value": F.col("target_value").cast("double")}), "measured_at")


@query
def alert_runs(r: Retail) -> DataFrame:
    return quality.alerts(run_log(r).withColumnRenamed("dq_status", "status")).select("run_id", "events_failed", "status")


@query
def latest_landed(r: Retail) -> DataFrame:
    return as_text(in_cents(monitor.latest_orders(landed(r)), "amount_eur"), "consumed_at")


@query
def latest_sales(r: Retail) -> DataFrame:
    _, star, fact = stored_sales(r)
    return as_text(in_cents(monitor.latest_sales(fact, star.product, star.channel), "amount_eur"), "order_timestamp")


@query
def table_counts(r: Retail) -> DataFrame:
    events = judged_once(r)
    orders, star, fact = stored_sales(r, events)
    return monitor.table_counts({"streaming_orders": orders, "fact_sales": fact, "dim_customer": star.customer,
                                 "failed_events": rules.rejected(events)})


@query
def event_rate_5m(r: Retail) -> DataFrame:
    return monitor.event_rate(r.table("events"), "ts", "event_type")


@query
def counter_rate_5m(r: Retail) -> DataFrame:
    """The readings of each kind of event as a counter that restarts whenever it drops."""
    readings = r.table("events").withColumn("reading", cents("value"))
    return monitor.counter_rate(readings, "ts", "event_type", "reading", "event_id")


@query
def gauge_bands(r: Retail) -> DataFrame:
    """Last reading of each user; an error event carries none."""
    readings = r.table("events").withColumn("reading", F.when(F.col("event_type") != "error", cents("value")))
    return monitor.last_gauge(readings, "ts", "user_id", "reading", "event_id", GAUGE_LEVELS)


# Revenue.


@query
def revenue_by_channel(r: Retail) -> DataFrame:
    orders, star = stored_orders(r)
    return in_cents(monitor.revenue_by_channel(facts.build_fact(orders, star), star.channel), "revenue_eur")


@query
def revenue_rollup(r: Retail) -> DataFrame:
    orders, star = stored_orders(r)
    return in_cents(monitor.revenue_rollup(facts.build_fact(orders, star), star), "revenue_eur").withColumn(
        "level", F.col("level").cast("int"))


@query
def revenue_window(r: Retail) -> DataFrame:
    """Weekly revenue of a stream of landed orders, in batches that are in no order of time."""
    folder = scratch_folder(r.spark, "stream")
    orders = landed(r).select("order_id", "order_timestamp", "channel", "amount_eur")
    orders.repartition(4, "order_id").write.parquet(f"{folder}/inbox")
    stream = r.spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/inbox")
    weekly = ingest.revenue_stream(stream, window="7 days")

    def keep(sums: DataFrame, batch_id: int) -> None:
        sums.write.mode("overwrite").parquet(f"{folder}/sums/{batch_id:05d}")

    writer = weekly.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{folder}/offsets")
    ended = writer.trigger(availableNow=True).start()
    ended.awaitTermination()
    sums = r.spark.read.schema(weekly.schema).parquet(f"{folder}/sums/{ended.lastProgress['batchId']:05d}")
    return as_text(in_cents(sums, "revenue_eur"), "window_start", "window_end")
