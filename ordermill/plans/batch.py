"""The whole micro-batch: reference load, ingest, fact, tests, checks, run log."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordermill import schemas
from ordermill.functions.dates import month_of_key, within
from ordermill.operators import conform, dims, facts, monitor, privacy, profiles, quality
from ordermill.operators.facts import Star
from ordermill.operators.lookup import split
from ordermill.session import discard, in_slices, materialise, materialise_slices, prepare, sized, slices_for, together
from ordermill.sources import ids, subjects
from ordermill.sources.csvfiles import read_seed
from ordermill.sources.tables import Warehouse
from ordermill.streaming.ingest import BATCH, CADENCE, dead_letters, failed_events, ingest_batch, landed_orders

LOAD = "load_id"
MONTH = "sales_month"


class ColumnTestsFailed(RuntimeError):
    """A column test found failing rows; the load stays pending."""


@dataclass
class RunResult:
    status: str
    counters: dict[str, int] = field(default_factory=dict)
    alerts: list[str] = field(default_factory=list)
    newly_processed: int = 0


def load_reference(house: Warehouse, customers: dict[str, DataFrame], erp: DataFrame, web: DataFrame,
                   stores: DataFrame, as_of: Column | None = None, calendar: DataFrame | None = None) -> Star:
    """Sources to unified tables, golden records and dimensions; repeatable, keys are kept."""
    spark = prepare(house.spark)
    today = F.current_date() if as_of is None else as_of

    def store(rows: DataFrame, layer: str, table: str) -> Callable[[], DataFrame]:
        def write() -> DataFrame:
            stored = house.commit(rows, layer, table)
            house.prune(layer, table, keep=2)  # a reader of the one before may still be at work
            return stored

        return write

    def existing(name: str) -> DataFrame | None:
        return house.read("dwh", f"dim_{name}") if house.exists("dwh", f"dim_{name}") else None

    unified, products, *_ = together(
        store(conform.unify_customers(customers), "staging", "customers_unified"),
        store(conform.unify_products(erp, web), "staging", "products_unified"),
        store(dims.dim_channel(spark, existing("channel")), "dwh", "dim_channel"),
        store(dims.dim_store(stores, existing("store")), "dwh", "dim_store"),
        *[store(rows, "raw", f"customers_{system}") for system, rows in customers.items()],
        lambda: extend_calendar(house, dims.calendar_around(spark, today) if calendar is None else calendar),
    )
    golden, golden_products = together(
        store(conform.golden_customers(unified, today), "staging", "customers_golden"),
        store(conform.golden_products(products), "staging", "products_golden"),
    )
    together(
        store(dims.dim_customer(golden, existing("customer")), "dwh", "dim_customer"),
        store(dims.dim_product(golden_products, existing("product")), "dwh", "dim_product"),
    )
    return star(house)


def load_seed(house: Warehouse, folder: str, systems: tuple[str, ...] = ("crm", "web", "pos")) -> Star:
    """Reference load from a folder of CSV files."""
    read = lambda name: read_seed(house.spark, folder, name)
    customers = {system: read(f"customers_{system}") for system in systems}
    return load_reference(house, customers, read("products_erp"), read("products_web"), read("stores"))


def extend_calendar(house: Warehouse, days: DataFrame) -> None:
    """Add the days that are missing; without any, nothing is written."""
    if house.exists("dwh", "dim_date"):
        known = house.read("dwh", "dim_date")
        missing = dims.missing_members(days, known, "full_date")
        if missing.isEmpty():
            return
        days = known.unionByName(missing)
    house.commit(days, "dwh", "dim_date")
    house.prune("dwh", "dim_date", keep=2)


def star(house: Warehouse) -> Star:
    return Star(**{name: house.read("dwh", f"dim_{name}", schema) for name, schema in schemas.DIMENSIONS.items()})


PROGRESS = "load_id int, backlog_version int, fact_version int"
FACT_STORAGE = f"{schemas.FACT_SALES}, {LOAD} int, {MONTH} int"


def progress(house: Warehouse) -> tuple[int, int, int]:
    """Last finished load, the backlog snapshot it left and the fact snapshot in force; -1 before the first."""
    row = house.read("staging", "load_progress", PROGRESS).first()
    return tuple(row) if row else (-1, -1, -1)


def sales(house: Warehouse) -> DataFrame:
    """The fact with its storage columns ``load_id`` and ``sales_month``: finished loads of the snapshot in force."""
    last, _, version = progress(house)
    if version < 0:
        return house.spark.createDataFrame([], FACT_STORAGE)
    return house.read_version("dwh", "fact_sales", version, FACT_STORAGE).filter(F.col(LOAD) <= last)


def move_progress(house: Warehouse, load_id: int, backlog_version: int, fact_version: int) -> None:
    """Put a load, its backlog and a fact snapshot in force, all in one step."""
    house.commit(house.spark.createDataFrame([(load_id, backlog_version, fact_version)], PROGRESS), "staging", "load_progress")
    house.prune("staging", "load_progress", keep=2)


def store_backlog(house: Warehouse, resolved: DataFrame) -> None:
    """Store which orders still wait; in force when the progress moves.

    The backlog names orders and the batch they came with; it holds nothing
    about the customer.
    """
    house.commit(facts.incomplete(resolved).select("order_id", BATCH, "missing"), "staging", "orders_backlog")


def finish_load(house: Warehouse, load_id: int, fact_version: int) -> None:
    """Move the progress to a load whose facts and backlog are stored."""
    move_progress(house, load_id, house.version("staging", "orders_backlog"), fact_version)
    house.prune("staging", "orders_backlog", keep=2)


@dataclass(frozen=True)
class Resolved:
    """Resolved orders, stored: in one part, or for a large load in parts by load and month, which go as their facts are written."""

    parts: list[DataFrame]

    @property
    def rows(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.parts)


def store_resolved(house: Warehouse, orders: DataFrame, rows: int) -> Resolved:
    """Resolve some ``rows`` orders and store them."""
    slices = slices_for(rows)
    with sized(house.spark, rows // slices):
        made = facts.resolved_slices(orders, star(house), slices, BATCH)
        if slices == 1:
            return Resolved([materialise(made, "resolved")])
        return Resolved(materialise_slices(made, "resolved", slices, BATCH, month_of_key(F.col("date_key"))))


def resolve_load(house: Warehouse, load_id: int) -> Resolved | None:
    """Everything landed since the last finished load, resolved and stored; None when that load is done.

    Candidates are the batches landed since then plus the backlog, so a load
    reads what is new and not the history: batches are pruned by folder, and
    waiting orders are fetched from the folders the backlog names.
    """
    last, backlog_version, _ = progress(house)
    if last >= load_id:
        return None
    landed = landed_orders(house)
    columns = [*schemas.STAGED_COLUMNS, BATCH]
    candidates = landed.filter((F.col(BATCH) > last) & (F.col(BATCH) <= load_id)).select(*columns)
    rows = candidates.count()
    if backlog_version >= 0:
        waiting = house.read_version("staging", "orders_backlog", backlog_version).select(BATCH, "order_id")
        rows += waiting.count()
        candidates = candidates.unionByName(
            landed.filter(F.col(BATCH) <= last).select(*columns).join(waiting, [BATCH, "order_id"], "left_semi"))
    return store_resolved(house, candidates, rows)


def publish_load(house: Warehouse, resolved: Resolved, load_id: int) -> tuple[int, int]:
    """Append the facts of a resolved load and move the progress.

    A load that stopped half way is run again and replaces what it had written;
    until the progress moves, no reader sees its rows. Returns the numbers of
    loaded and of still waiting orders.
    """
    version = max(progress(house)[2], 0)
    subjects.outdate(house, "fact_sales", [load_id])
    found = resolved.rows.count()
    counts = resolved.rows.agg(F.count("*").alias("all"), F.count(facts.missing_member()).alias("waiting"))

    def loaded(part: DataFrame) -> DataFrame:
        """Fact rows of a part. Ranges end inside a month when it is large, and small months share a task."""
        return facts.complete(part).withColumn(MONTH, month_of_key(F.col("date_key"))).repartitionByRange(MONTH, "order_id")

    def index(rows: DataFrame) -> None:
        ids.add(house, "dwh", fact_ids(house, version), rows.select("order_id", F.lit(load_id).alias(ids.LOAD)))

    with sized(house.spark, found // len(resolved.parts)):
        if len(resolved.parts) == 1:
            rows = resolved.rows
            *_, counted = together(
                lambda: house.write_slice(loaded(rows), "dwh", "fact_sales", LOAD, load_id, partition_by=(MONTH,), version=version),
                lambda: index(facts.complete(rows)),
                counts.first,
            )
            store_backlog(house, rows)
            discard(rows)
        else:  # one step after another, each on as little disk as it takes
            counted = counts.first()
            store_backlog(house, resolved.rows)
            with house.writing("dwh", "fact_sales", LOAD, load_id, partition_by=(MONTH,), version=version) as write:
                for part in resolved.parts:
                    write(loaded(part))
                    discard(part)
            index(house.read_version("dwh", "fact_sales", version, FACT_STORAGE).filter(F.col(LOAD) == load_id))
    subjects.outdate(house, "fact_sales", [load_id])  # again: an erasure may have entered what was there before
    finish_load(house, load_id, version)
    return counted["all"] - counted["waiting"], counted["waiting"]


def load_facts(house: Warehouse, load_id: int) -> tuple[int, int]:
    """Resolve and publish a load without tests; numbers of loaded and of waiting orders."""
    resolved = resolve_load(house, load_id)
    return (0, 0) if resolved is None else publish_load(house, resolved, load_id)


def rebuild_facts(house: Warehouse) -> DataFrame:
    """Full refresh: the fact of everything ever landed, as one new snapshot.

    The new snapshot, its backlog and the progress come into force in one step;
    a refresh that stops before it leaves the old ones and is simply repeated.
    """
    landed = landed_orders(house)
    orders = landed.count()
    resolved = store_resolved(house, landed.select(*schemas.STAGED_COLUMNS, BATCH), orders)
    last = landed.agg(F.coalesce(F.max(BATCH), F.lit(-1))).first()[0]
    version = max(progress(house)[2], house.version("dwh", "fact_sales")) + 1
    store_backlog(house, resolved.rows)
    with sized(house.spark, orders // len(resolved.parts)):
        for number, part in enumerate(resolved.parts):
            rows = facts.complete(part, BATCH).withColumnRenamed(BATCH, LOAD).withColumn(MONTH, month_of_key(F.col("date_key")))
            house.commit(rows.repartitionByRange(LOAD, MONTH, "order_id"), "dwh", "fact_sales", partition_by=(LOAD, MONTH), version=version, more=number > 0)
            discard(part)
    fact_ids(house, version - 1)  # what a stopped refresh left goes
    written = house.read_version("dwh", "fact_sales", version, FACT_STORAGE)
    ids.add(house, "dwh", f"fact_ids/e{version}", written.select("order_id", F.col(LOAD).alias(ids.LOAD)))
    finish_load(house, last, version)
    house.prune("dwh", "fact_sales")
    return sales(house)


# Tables with a profile per load: layer, load column and the time that windows ask for.
PROFILED = {
    "streaming_orders": ("raw", BATCH, "consumed_at"),
    "failed_events": ("raw", BATCH, "failed_at"),
    "fact_sales": ("dwh", LOAD, None),
}
TESTED_AS = {"stg_orders": "streaming_orders"}
PARENTS = {"product_key": "dim_product", "customer_key": "dim_customer"}
STORED_PROFILE = f"`table` string, version int, {profiles.PROFILE}"
STORED_REPEATED = f"`table` string, version int, {profiles.REPEATED}"


def fact_ids(house: Warehouse, version: int) -> str:
    """Name of the index of order ids by fact load, for the fact snapshot in force; full refreshes begin a new one."""
    fs, folder = house._folder(house.path("dwh", "fact_ids"))
    begun = [int(s.getPath().getName()[1:]) for s in fs.listStatus(folder)] if fs.exists(folder) else []
    for stale in (e for e in begun if e > version):  # of a refresh that stopped
        fs.delete(house._folder(f"{house.path('dwh', 'fact_ids')}/e{stale}")[1], True)
    return f"fact_ids/e{max((e for e in begun if e <= version), default=0)}"


def loads_of(house: Warehouse, table: str) -> set[int]:
    """Numbers of the loads a table holds, from its folders; of the fact those in force."""
    layer, column, _ = PROFILED[table]
    if table != "fact_sales":
        return {int(s.split("=")[1]) for s in house.slices(layer, table) if s.startswith(f"{column}=")}
    last, _, version = progress(house)
    return {n for s in house.slices(layer, table, version) if s.startswith(f"{column}=") and (n := int(s.split("=")[1])) <= last} if version >= 0 else set()


@dataclass
class Profiles:
    """Profiles and repeated ids of all loads: what is stored, and what was worked out now."""

    profiles: DataFrame
    repeated: DataFrame
    fresh: int  # how many loads were read

    def of(self, table: str) -> DataFrame:
        return self.profiles.filter(F.col("table") == table)


def profiled(house: Warehouse, again: int | None = None, resolved: DataFrame | None = None) -> Profiles:
    """Profiles of every load; only loads without one are read, and load ``again``, which may have been written anew.

    With the facts of a resolved load that is not published yet, as load ``again``.
    """
    stored = house.read("monitoring", "load_profiles", STORED_PROFILE)
    repeated = house.read("monitoring", "repeated_ids", STORED_REPEATED)
    known: dict[tuple[str, int], set[int]] = {}
    for r in stored.select("table", "version", ids.LOAD).collect():
        known.setdefault((r.table, r.version), set()).add(r[ids.LOAD])
    # Facts of the first load are profiled before any are in force, for the snapshot they will be in.
    at_hand, versions = star(house), {
        table: max(progress(house)[2], 0) if table == "fact_sales" else house.version(layer, table) for table, (layer, _, _) in PROFILED.items()}

    def read(table: str) -> tuple[str, list[int], DataFrame, DataFrame | None] | None:
        """The loads of a table that have no profile, their profiles and their repeated ids."""
        layer, column, at = PROFILED[table]
        missing = sorted(n for n in loads_of(house, table) if n == again or n not in known.get((table, versions[table]), ()))
        rows = CUT_TABLES[table](house).filter(F.col(column).isin(missing))
        index = {"streaming_orders": lambda: "landed_ids", "fact_sales": lambda: fact_ids(house, versions[table])}.get(table)
        if table == "fact_sales":
            rows = rows.drop(MONTH)
            if resolved is not None:
                rows = rows.filter(F.col(column) != again).unionByName(facts.complete(resolved).withColumn(column, F.lit(again)))
                missing = sorted({*missing, again})
        if not missing:
            return None
        named = F.lit(table).alias("table"), F.lit(versions[table]).alias("version")
        twice = house.spark.createDataFrame([], f"{profiles.REPEATED}, before boolean")
        if index is not None:
            if table == "fact_sales":
                fact_ids(house, progress(house)[2])  # what a stopped refresh left goes
            edge = rows.agg(F.min("order_id").alias("least"), F.max("order_id").alias("most"), F.count("order_id").alias("ids")).first()
            ids.fit(house, layer, index(), edge["ids"])
            near = ids.near(house, layer, index(), edge["least"], edge["most"])
            buckets = ids.buckets_of(house, layer, index())
            twice = materialise([profiles.repeated_ids(part, column, near, buckets) for part in in_slices(rows, slices_for(edge["ids"]), "order_id")], "repeated")
        parents = {"product_key": at_hand.product, "customer_key": at_hand.customer} if table == "fact_sales" else {}
        made = materialise(profiles.of_every_load(profiles.profile(rows, column, at, twice, parents), missing), "profiles")
        return table, missing, made.select(*named, *made.columns), twice.select(*named, ids.LOAD, "order_id")

    reads = [lambda t=t: read(t) for t in PROFILED]
    large = again is not None and slices_for(landed_orders(house).filter(F.col(BATCH) == again).count()) > 1
    read_now = [r for r in ([job() for job in reads] if large else together(*reads)) if r is not None]  # large loads shuffle one table at a time

    def in_force(rows: DataFrame) -> DataFrame:
        """Stored rows of the snapshots in force, without loads that were read now."""
        for table, version in versions.items():
            rows = rows.filter((F.col("table") != table) | (F.col("version") == version))
        for table, missing, _, _ in read_now:
            rows = rows.filter((F.col("table") != table) | ~F.col(ids.LOAD).isin(missing))
        return rows

    return Profiles(reduce(DataFrame.unionByName, [in_force(stored), *[r[2] for r in read_now]]),
                    reduce(DataFrame.unionByName, [in_force(repeated), *[r[3] for r in read_now]]), sum(len(r[1]) for r in read_now))


def keep_profiles(house: Warehouse, found: Profiles) -> Profiles:
    """Store profiles, so that later runs add up what this one read."""
    if not found.fresh:
        return found
    kept = house.commit(found.profiles.coalesce(1), "monitoring", "load_profiles")
    house.prune("monitoring", "load_profiles", keep=2)
    twice = found.repeated
    if house.exists("monitoring", "repeated_ids") or not twice.isEmpty():
        twice = house.commit(twice, "monitoring", "repeated_ids")
        house.prune("monitoring", "repeated_ids", keep=2)
    return Profiles(kept, twice, 0)


def column_tests(house: Warehouse, found: Profiles, resolved: DataFrame | None = None) -> DataFrame:
    """The declared column tests, from profiles; a test they do not answer reads its tables whole."""
    declared = quality.declared_tests()
    counted = profiles.failures(found.profiles, found.repeated)
    rows, rest = [], []
    for t in declared:
        if not profiles.answered(t, PARENTS):
            rest.append(t)
            continue
        n = counted.get((TESTED_AS.get(t.table, t.table), t.test, t.column), 0)
        rows.append((t.test, t.table, t.column, n, "PASS" if n == 0 else "FAIL"))
    out = house.spark.createDataFrame(rows, "test string, `table` string, `column` string, failures long, status string")
    return out.unionByName(quality.run_tests(tested_tables(house, resolved), tuple(rest))) if rest else out


def tested_tables(house: Warehouse, resolved: DataFrame | None = None) -> dict[str, DataFrame]:
    """Whole tables that column tests may read; with the facts of a resolved load that is not published yet."""
    fact, at_hand = sales(house).select(*schemas.FACT_COLUMNS), star(house)
    return {
        "stg_orders": facts.staged_orders(landed_orders(house)),
        "fact_sales": fact if resolved is None else fact.unionByName(facts.complete(resolved)),
        "dim_product": at_hand.product,
        "dim_customer": at_hand.customer,
    }


def checks(house: Warehouse, as_of: Column, found: Profiles | None = None) -> DataFrame:
    """The quality metrics, from profiles; of a load that the time window cuts, its rows."""
    found = keep_profiles(house, profiled(house)) if found is None else found
    cut = found.profiles.filter(~within(F.col("first_at"), as_of) & within(F.col("last_at"), as_of)).select("table", ids.LOAD).collect()

    def edge(table: str) -> DataFrame:
        return CUT_TABLES[table](house).filter(F.col(BATCH).isin([r[ids.LOAD] for r in cut if r.table == table]))

    return profiles.metrics(found.of("streaming_orders"), found.of("failed_events"), found.of("fact_sales"),
                            edge("streaming_orders"), edge("failed_events"), as_of)


def run_batch(house: Warehouse, events: DataFrame | list[DataFrame], batch_id: int, as_of: Column | None = None,
              calendar: DataFrame | None = None, dag_id: str = monitor.PIPELINE_ID,
              dead_letter_sink: Callable[[DataFrame], None] | None = None) -> RunResult:
    """One full cycle over a bounded frame of messages, or several; also fit for ``foreachBatch``.

    The column tests see the load before anyone else does: when one fails, the
    run fails, nothing of the load is published and its orders stay pending.
    An alert of a metric marks the run and never fails it. Tests and metrics
    add up what is known of earlier loads and read the new one. The run is
    logged in every case.
    """
    spark = prepare(house.spark)
    started = datetime.now(timezone.utc).replace(tzinfo=None)
    today = F.current_timestamp() if as_of is None else as_of
    result = RunResult("ERROR")
    checks_status, detail = None, None
    try:
        counters = ingest_batch(events, batch_id, house, dead_letter_sink)
        result.counters = counters.__dict__.copy()
        days = calendar
        if days is None:
            days = dims.calendar_around(spark, F.to_date(today), dims.CALENDAR_EXTENSION_DAYS)
        extend_calendar(house, days)
        resolved = resolve_load(house, batch_id)
        rows = None if resolved is None else resolved.rows
        found = profiled(house, batch_id, rows)
        tested = column_tests(house, found, rows)
        house.write_slice(tested.coalesce(1), "staging", "column_tests", BATCH, batch_id)
        broken = [r.asDict() for r in column_test_results(house).filter((F.col(BATCH) == batch_id) & (F.col("status") == "FAIL")).drop(BATCH).collect()]
        if broken:
            if resolved is not None:
                discard(*resolved.parts)
            detail = json.dumps(broken)
            raise ColumnTestsFailed(detail)
        unresolved = 0
        if resolved is not None:
            result.newly_processed, unresolved = publish_load(house, resolved, batch_id)
        result.counters["orders_unresolved"] = unresolved

        metrics = checks(house, today, keep_profiles(house, found))
        house.write_slice(metrics.withColumn("measured_at", F.current_timestamp()), "staging", "quality_metrics",
                          BATCH, batch_id)
        measured = house.read("staging", "quality_metrics").filter(F.col(BATCH) == batch_id).collect()
        result.alerts = sorted(m["metric_name"] for m in measured if m["status"] == "ALERT")
        checks_status = "ALERT" if result.alerts else "OK"
        result.status = checks_status
        if result.alerts:
            detail = "Alerte DQ: " + ", ".join(result.alerts)
    finally:
        log_run(house, batch_id, started, result, checks_status, detail, dag_id)
    refresh_views(house)
    return result


def column_test_results(house: Warehouse) -> DataFrame:
    return house.read("staging", "column_tests", f"test string, `table` string, `column` string, failures long, status string, {BATCH} int")


def start_pipeline(house: Warehouse, events: DataFrame, checkpoint: str, continuous: bool = False,
                   cadence: str = CADENCE, **options) -> StreamingQuery:
    """Run a full cycle on every micro-batch of a streaming frame of messages."""
    def cycle(rows: DataFrame, batch_id: int) -> None:
        run_batch(house, rows, batch_id, **options)

    trigger = {"processingTime": cadence} if continuous else {"availableNow": True}
    return events.writeStream.foreachBatch(cycle).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def register_views(house: Warehouse) -> list[str]:
    """Temporary views for SQL: staging models, masked customers, sales and the monitoring tables."""
    landed, fact, at_hand = landed_orders(house), sales(house).drop(LOAD, MONTH), star(house)
    views = {
        "streaming_orders": facts.with_processed(landed.drop(BATCH), fact),
        "failed_events": failed_events(house),
        "stg_orders": facts.pending(landed, fact),
        "stg_customers": conform.customers_in_stream(landed),
        "fact_sales": fact,
        **{f"dim_{name}": getattr(at_hand, name) for name in schemas.DIMENSIONS},
        "dim_customer_anonymized": privacy.masked_customers(at_hand.customer),
        "v_sales_analytics": privacy.sales_analytics(fact, at_hand),
        "quality_metrics": house.read("staging", "quality_metrics", f"{schemas.QUALITY_METRICS}, {BATCH} int"),
        "pipeline_runs": house.read("monitoring", "pipeline_runs", schemas.PIPELINE_RUNS),
        "gdpr_requests": house.read("audit", "gdpr_requests", schemas.GDPR_REQUESTS),
    }
    for name, rows in views.items():
        rows.createOrReplaceTempView(name)
    house.views = list(views)
    return house.views


def refresh_views(house: Warehouse) -> None:
    """Let registered views read the snapshots now in force."""
    if house.views:
        register_views(house)


def log_run(house: Warehouse, run_id: int, started: datetime, result: RunResult, checks_status: str | None,
            detail: str | None, dag_id: str) -> None:
    finished = datetime.now(timezone.utc).replace(tzinfo=None)
    counters = result.counters
    record = monitor.run_record(house.spark, {
        "run_id": run_id, "dag_id": dag_id, "task_id": "pipeline_run", "started_at": started,
        "finished_at": finished, "events_produced": counters.get("messages_read", 0),
        "events_consumed": counters.get("events_consumed", 0), "events_failed": counters.get("events_failed", 0),
        "events_duplicate": counters.get("events_duplicate", 0),
    })
    given = F.lit(checks_status).cast("string")
    row = record.withColumns({
        "dq_status": monitor.run_status(given),
        "notes": F.coalesce(F.lit(detail).cast("string"), monitor.run_notes(given)),
        "duration_sec": ((F.unix_micros("finished_at") - F.unix_micros("started_at")) / 1_000_000)
        .cast("decimal(10,2)"),
    }).drop("run_id")
    house.write_slice(row, "monitoring", "pipeline_runs", "run_id", run_id)


# Tables that may hold personal data: layer and folders they are cut into.
PERSONAL_TABLES = {
    "fact_sales": ("dwh", (LOAD, MONTH)),
    "streaming_orders": ("raw", (BATCH,)),
    "failed_events": ("raw", (BATCH,)),
    "dead_letters": ("raw", (BATCH,)),
    "customers_unified": ("staging", ()),
    "customers_golden": ("staging", ()),
    "dim_customer": ("dwh", ()),
    "customers_crm": ("raw", ()),
    "customers_web": ("raw", ()),
    "customers_pos": ("raw", ()),
}
CUT_TABLES = {"fact_sales": sales, "streaming_orders": landed_orders, "failed_events": failed_events,
              "dead_letters": dead_letters}


STORED_LOADS = {"fact_sales": FACT_STORAGE, "streaming_orders": f"{schemas.STREAMING_ORDERS}, {BATCH} int",
                "failed_events": f"{schemas.FAILED_EVENTS}, {BATCH} int", "dead_letters": f"value string, {BATCH} int"}


def personal_tables(house: Warehouse) -> dict[str, DataFrame]:
    """Every stored table that may hold personal data."""
    return {
        name: CUT_TABLES[name](house) if name in CUT_TABLES else house.read(layer, name)
        for name, (layer, _) in PERSONAL_TABLES.items()
        if house.exists(layer, name)
    }


def force(house: Warehouse, name: str) -> tuple[str, tuple[str, ...], int]:
    """Layer of a table cut into loads, its folders and the snapshot in force."""
    layer, cut = PERSONAL_TABLES[name]
    return layer, cut, max(progress(house)[2] if name == "fact_sales" else house.version(layer, name), 0)


def stored_loads(house: Warehouse, name: str) -> set[int]:
    """Loads in the snapshot in force, also facts that no reader sees yet."""
    layer, cut, version = force(house, name)
    return {int(s.split("=")[1]) for s in house.slices(layer, name, version) if s.startswith(f"{cut[0]}=")}


def rows_of_loads(house: Warehouse, name: str, loads: set[int]) -> DataFrame:
    """Rows of some loads, read from their folders alone."""
    layer, cut, version = force(house, name)
    if name != "fact_sales":
        rows = CUT_TABLES[name](house)
    elif house.slices(layer, name, version):
        rows = house.read_version(layer, name, version, FACT_STORAGE)
    else:
        rows = house.spark.createDataFrame([], FACT_STORAGE)
    return rows.filter(F.col(cut[0]).isin(sorted(loads)))


def concerned_loads(house: Warehouse, found: privacy.Subjects, scopes: tuple[privacy.Scope, ...],
                    asked: dict[str, set[int]]) -> dict[str, set[int]]:
    """Of the loads ``asked`` for, those that may hold rows of a subject, by the index of persons.

    Loads without an entry are read and entered. Folders reach the driver, no digests.
    """
    held = {}
    for scope in scopes:
        name = scope.table
        if not asked.get(name):
            continue
        _, cut, version = force(house, name)
        held[subjects.label(name, version)] = name
        subjects.outdate_others(house, name, version)
        missing = asked[name] - subjects.entered(house, subjects.label(name, version))
        if missing:
            read = privacy.subject_digests(rows_of_loads(house, name, missing), scope, cut[0])
            subjects.enter(house, read, sorted(missing), subjects.label(name, version))
    met = split(subjects.entries(house, held), privacy.wanted_digests(found), "digest", True)
    concerned: dict[str, set[int]] = {name: set() for name in asked}
    for r in met.select("held", subjects.LOAD).distinct().collect():
        concerned[held[r.held]].add(r[subjects.LOAD])
    return {name: loads & asked[name] for name, loads in concerned.items()}


def forget_loads(house: Warehouse, name: str, loads: list[int]) -> None:
    """Drop what is stored about loads whose rows change: who is in them and their profiles."""
    subjects.outdate(house, name, loads)
    for table, schema in (("load_profiles", STORED_PROFILE), ("repeated_ids", STORED_REPEATED)):
        if house.exists("monitoring", table):
            stored = house.read("monitoring", table, schema)
            house.commit(stored.filter((F.col("table") != name) | ~F.col(ids.LOAD).isin(loads)), "monitoring", table)
            house.prune("monitoring", table, keep=2)


def rewrite_loads(house: Warehouse, name: str, rows: DataFrame, loads: set[int]) -> None:
    """Put ``rows`` in place of everything these loads hold; folders of other loads are not touched.

    The rows are stored aside first, then the loads they replace. From there on ``finish_rewrite`` can be repeated.
    """
    house.drop("staging", f"erasing_{name}")
    house.commit(rows, "staging", f"erasing_{name}")
    _, _, version = force(house, name)
    noted = house.spark.createDataFrame([(version, n) for n in sorted(loads)], "version int, load int")
    house.commit(noted.coalesce(1), "staging", f"erasing_{name}_loads")
    finish_rewrite(house, name)


def rewrite_files(house: Warehouse, name: str, loads: set[int], count: int, kept: Callable[[DataFrame], DataFrame]) -> None:
    """Leave the ``kept`` rows of large loads, one of ``count`` groups of their files after another.

    So no more than a group is stored twice. What is kept of a group is stored aside, then the files it replaces; from there
    on ``finish_rewrite`` can be repeated.
    """
    _, cut, version = force(house, name)
    layer, schema = PERSONAL_TABLES[name][0], STORED_LOADS[name]
    files = [(n, f) for n in sorted(loads) for f in house.files(layer, name, version, f"{cut[0]}={n}")]
    for group in (files[k::count] for k in range(count)):
        if group:
            rows = kept(house.read_files(layer, name, version, [f for _, f in group], schema))
            house.drop("staging", f"erasing_{name}")
            house.commit(rows, "staging", f"erasing_{name}", partition_by=cut)
            noted = house.spark.createDataFrame([(version, n, f) for n, f in group], "version int, load int, file string")
            house.commit(noted.coalesce(1), "staging", f"erasing_{name}_loads")
            finish_rewrite(house, name)


def finish_rewrite(house: Warehouse, name: str) -> None:
    """Bring a rewrite of loads to its end, if one was begun; also that of a call that stopped."""
    if not house.exists("staging", f"erasing_{name}_loads"):
        return
    layer, cut, version = force(house, name)
    noted = house.read("staging", f"erasing_{name}_loads").collect()
    loads = sorted({r.load for r in noted if r.version == version})
    if loads and "file" in noted[0]:
        forget_loads(house, name, loads)
        house.replace_files(layer, name, version, [r.file for r in noted], ("staging", f"erasing_{name}"))
        forget_loads(house, name, loads)
    elif loads:  # else a full refresh has replaced them
        forget_loads(house, name, loads)
        rows = house.read("staging", f"erasing_{name}")
        left = {"/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if r[c] is None else r[c]}" for c in cut)
                for r in rows.select(*cut).distinct().collect()}  # one row a folder
        house.overwrite_slices(rows, layer, name, cut, version)
        tops = [f"{cut[0]}={n}" for n in loads]
        stored = tops if len(cut) == 1 else [f"{t}/{s}" for t in tops for s in house.slices(layer, name, version, t)]
        house.drop_slices(layer, name, set(stored) - left, version)
        forget_loads(house, name, loads)  # again: a cycle beside it may have stored what it read before
    house.drop("staging", f"erasing_{name}_loads")
    house.drop("staging", f"erasing_{name}")


def erase_subjects(house: Warehouse, requests: DataFrame, full: bool = False) -> DataFrame:
    """Erase all subjects of ``requests(customer_email)`` and return the counts per subject.

    One pass per table serves all requests. Of tables cut into loads, only the folders of loads that hold a subject are
    rewritten, and loads written meanwhile are looked through before the call ends; it runs beside loads but not beside a
    refresh or another erasure. Orders that come in behind the last look are new ones; facts that a load had resolved before
    and publishes behind it hold a customer key that leads nowhere. The audit row ``processing`` is written first and
    ``completed`` last; a run that stops between is repeated, and goes on where the other stopped.
    Replaced snapshots and scratch copies are deleted, as they hold the erased
    rows. ``full`` covers every table with personal data and keeps only a
    digest of the address, in the audit and in the result.
    """
    prepare(house.spark)
    requests = materialise(requests.select("customer_email"), "requests")
    scopes = privacy.FULL_SCOPE if full else privacy.CORE_SCOPE
    names = [s.table for s in scopes if house.exists(PERSONAL_TABLES[s.table][0], s.table)]
    for name in CUT_TABLES:
        finish_rewrite(house, name)
    found = privacy.find_subjects(house.read("dwh", "dim_customer"), requests)
    whole = {name: house.read(PERSONAL_TABLES[name][0], name) for name in names if name not in CUT_TABLES}
    looked: dict[str, set[int]] = {name: set() for name in names if name in CUT_TABLES}

    now = F.current_timestamp()
    waiting = waiting_erasures(house, requests)
    new = materialise(privacy.audit_requests(
        requests.withColumn("_digest", address_digest(F.col("customer_email"))).join(waiting, "_digest", "left_anti"),
        "erasure", "processing", now, last_request(house), F.lit(privacy.ERASURE_NOTE)), "audit")
    append_audit(house, hide_address(new, "customer_email") if full else new)
    processing = materialise(new.unionByName(waiting.select(*new.columns)), "audit")

    passes = []
    while True:
        asked = {name: stored_loads(house, name) - looked[name] for name in looked}
        if passes and not any(asked.values()):
            break
        concerned = concerned_loads(house, found, scopes, asked)
        cut = {name: rows_of_loads(house, name, concerned[name]) for name in looked}
        passes.append(materialise(privacy.erasure_counts({**cut, **({} if passes else whole)}, found, scopes), "erasure-counts"))
        groups = {name: slices_for(rows.count()) for name, rows in cut.items() if concerned[name]}
        kept = privacy.erase({name: cut[name] for name, n in groups.items() if n == 1}, found, scopes)
        for name, rows in kept.items():
            rewrite_loads(house, name, rows, concerned[name])
        for name, n in groups.items():
            if n > 1:
                rewrite_files(house, name, concerned[name], n, lambda rows, name=name: privacy.erase({name: rows}, found, scopes)[name])
        looked = {name: looked[name] | asked[name] for name in looked}
    for name, rows in privacy.erase(whole, found, scopes).items():
        house.commit(rows, PERSONAL_TABLES[name][0], name)
    for name in names:
        layer = PERSONAL_TABLES[name][0]
        if name in whole:
            house.prune(layer, name)
        else:
            house.drop_versions(layer, name, but=force(house, name)[2])

    counted = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), passes)
    held = [F.sum(c).alias(c) for c in passes[0].columns if c != "email_normalized"]
    counts = materialise(counted.groupBy("email_normalized").agg(*held), "erasure-counts")
    completed = privacy.complete_erasure(processing, counts, now)
    append_audit(house, hide_address(completed, "customer_email") if full else completed)
    result = materialise(hide_address(counts, "email_normalized") if full else counts, "erased")
    if full:
        hide_past_requests(house, found.addresses)
    discard(requests, counts, processing, new, waiting, found.addresses, found.keys, *passes)
    refresh_views(house)
    return result


def hide_past_requests(house: Warehouse, addresses: DataFrame) -> None:
    """Put digests in place of the subjects' addresses in all audit rows, also those of earlier requests."""
    audit = house.read("audit", "gdpr_requests")
    asked = audit.withColumn("_subject", privacy.normalise(F.col("customer_email")))
    known = addresses.withColumn("_asked", F.lit(True))
    hidden = asked.join(known, "_subject", "left").withColumn(
        "customer_email", F.when(F.col("_asked"), F.sha2("_subject", 256)).otherwise(F.col("customer_email")))
    house.commit(hidden.select(*audit.columns), "audit", "gdpr_requests")
    house.prune("audit", "gdpr_requests")


def address_digest(address: Column) -> Column:
    """Digest of a normalised address; one that is a digest already stays."""
    return F.when(address.rlike("^[0-9a-f]{64}$"), address).otherwise(F.sha2(privacy.normalise(address), 256))


def waiting_erasures(house: Warehouse, requests: DataFrame) -> DataFrame:
    """Erasures of these subjects that an earlier call began and did not complete, with their addresses.

    A repeated call goes on with them, so a request has one number however often it is tried.
    """
    audit = house.read("audit", "gdpr_requests", schemas.GDPR_REQUESTS)
    begun = privacy.current_requests(audit).filter("request_type = 'erasure' AND status = 'processing'")
    asked = requests.groupBy(address_digest(F.col("customer_email")).alias("_digest")).agg(F.min("customer_email").alias("_asked"))
    open_ones = begun.withColumn("_digest", address_digest(F.col("customer_email"))).join(asked, "_digest")
    return materialise(open_ones.withColumn("customer_email", F.col("_asked")).drop("_asked"), "waiting")


def hide_address(rows: DataFrame, column: str) -> DataFrame:
    return rows.withColumn(column, F.sha2(F.lower(F.trim(column)), 256))


def last_request(house: Warehouse) -> int:
    """Highest request id given out so far."""
    if not house.exists("audit", "gdpr_requests"):
        return 0
    return house.read("audit", "gdpr_requests").agg(F.coalesce(F.max("request_id"), F.lit(0))).first()[0]


def append_audit(house: Warehouse, rows: DataFrame) -> None:
    """Audit rows are only ever added."""
    if house.exists("audit", "gdpr_requests"):
        rows.write.mode("append").parquet(house.current("audit", "gdpr_requests"))
    else:
        house.commit(rows, "audit", "gdpr_requests")


def export_subjects(house: Warehouse, requests: DataFrame) -> DataFrame:
    """Source rows of the subjects; each request is logged as an access."""
    asked = materialise(
        privacy.audit_requests(requests, "access", "completed", F.current_timestamp(), last_request(house)), "audit")
    append_audit(house, asked)
    discard(asked)
    return privacy.export_subjects(house.read("staging", "customers_unified"), requests)
