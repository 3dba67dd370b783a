"""Masked views, subject access and subject erasure for any number of subjects at once."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.keys import assign_keys
from ordermill.functions.text import mask_email, mask_name, normalise
from ordermill.operators.facts import Star
from ordermill.operators.lookup import lookup, split
from ordermill.session import materialise

# Notes written to the audit table.
ERASURE_NOTE = "Demande droit a l effacement"
ERASURE_RESULT = "Supprime staging=%s, dwh=%s, raw=%s, fact_sales=%s"

MASKED_COLUMNS = ("customer_key", "golden_id", "email_masked", "first_name_masked", "last_name_masked",
                  "consent_marketing", "consent_date", "last_activity", "is_active_12m", "email_valid")
EXPORT_COLUMNS = ("source_system", "email", "first_name", "last_name", "consent_marketing", "last_activity")


def masked_customers(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.withColumns({
        "email_masked": F.when(F.col("email").isNotNull(), mask_email(F.col("email"))),
        "first_name_masked": mask_name(F.col("first_name")),
        "last_name_masked": mask_name(F.col("last_name")),
    }).select(*MASKED_COLUMNS)


def sales_analytics(fact: DataFrame, star: Star, **limits: int) -> DataFrame:
    """Sales with readable dimensions and masked customers; facts without a member are left out."""
    members = {
        "date_key": star.date.select("date_key", "full_date", "month_name", "year_num"),
        "customer_key": masked_customers(star.customer).select(
            "customer_key", "email_masked", "is_active_12m", "consent_marketing"),
        "product_key": star.product.select("product_key", "product_ref", "product_name", "category"),
        "store_key": star.store.select("store_key", "store_name"),
        "channel_key": star.channel.select("channel_key", "channel_name"),
    }
    named = fact.select("order_id", *members, "quantity", "amount_eur")
    for key, dimension in members.items():
        marked = dimension.withColumn("_found", F.lit(True))
        named = lookup(named, marked, key, F.col("order_id"), fact, **limits).filter("_found").drop("_found")
    return named.select("order_id", "full_date", "month_name", "year_num", "email_masked", "is_active_12m",
                        "consent_marketing", "product_ref", "product_name", "category", "store_name", "channel_name",
                        "quantity", "amount_eur")


def subjects(requests: DataFrame) -> DataFrame:
    """Distinct normalised addresses of a request frame with a ``customer_email`` column."""
    return requests.select(normalise(F.col("customer_email")).alias("_subject")).filter(
        F.col("_subject").isNotNull()).distinct()


def export_subjects(unified: DataFrame, requests: DataFrame) -> DataFrame:
    """All source rows of the subjects."""
    rows = unified.withColumn("_subject", normalise(F.col("email")))
    return split(rows, subjects(requests), "_subject", True).select(*EXPORT_COLUMNS)


@dataclass(frozen=True)
class Scope:
    """Where a subject is found: table, and SQL for the address there (by customer key without one).

    ``within`` tells that the SQL gives a text that may hold addresses anywhere, as messages
    do that can't be read or hold an address in another field.
    """

    table: str
    address: str | None = None
    within: bool = False


# Any run that looks like an address; the subject is compared with all of them.
ADDRESSES = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


# Facts first and the dimension last: facts are found through the dimension,
# so a run that stops half way can be repeated.
CORE_SCOPE = (
    Scope("fact_sales"),
    Scope("streaming_orders", "customer_email"),
    Scope("customers_golden", "email_normalized"),
    Scope("dim_customer", "email"),
)
FULL_SCOPE = CORE_SCOPE[:2] + (
    Scope("failed_events", "payload", within=True),
    Scope("dead_letters", "value", within=True),
    Scope("customers_unified", "email"),
    Scope("customers_crm", "email"),
    Scope("customers_web", "email"),
    Scope("customers_pos", "email"),
) + CORE_SCOPE[2:]


@dataclass(frozen=True)
class Subjects:
    """Stored addresses (``_subject``) and customer keys (``customer_key``, ``_subject``)."""

    addresses: DataFrame
    keys: DataFrame


def find_subjects(dim_customer: DataFrame, requests: DataFrame) -> Subjects:
    """Look the subjects up once and store them.

    Stored, they can be counted: a usual batch of requests is broadcast against
    each table, a very large one is shuffled with busy subjects split up.
    """
    addresses = materialise(subjects(requests), "subjects")
    owners = dim_customer.select("customer_key", normalise(F.col("email")).alias("_subject"))
    return Subjects(addresses, materialise(owners.join(addresses, "_subject", "left_semi"), "subject-keys"))


def _addresses(scope: Scope) -> Column:
    """Distinct normalised addresses in a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.expr(scope.address), F.lit(ADDRESSES), F.lit(0)), normalise))


def subject_digests(rows: DataFrame, scope: Scope, load: str) -> DataFrame:
    """(load, digest) of everyone a table's rows belong to, as ``wanted_digests`` has them."""
    if scope.address is None:
        return rows.select(F.col(load).cast("int").alias("load"), key_digest(F.col("customer_key")).alias("digest"))
    if scope.within:
        named = rows.select(load, F.explode(_addresses(scope)).alias("_subject"))
    else:
        named = rows.select(load, normalise(F.expr(scope.address)).alias("_subject")).filter("_subject IS NOT NULL")
    return named.select(F.col(load).cast("int").alias("load"), address_digest(F.col("_subject")).alias("digest"))


def key_digest(key: Column) -> Column:
    return F.xxhash64(F.lit("key"), key.cast("long"))


def address_digest(address: Column) -> Column:
    return F.xxhash64(F.lit("address"), address)


def wanted_digests(found: Subjects) -> DataFrame:
    """(digest) of the subjects, by address and by customer key."""
    addresses = found.addresses.select(address_digest(F.col("_subject")).alias("digest"))
    return addresses.unionByName(found.keys.select(key_digest(F.col("customer_key")).alias("digest"))).distinct()


def rows_of_subjects(tables: dict[str, DataFrame], scope: Scope, found: Subjects, **limits: int) -> DataFrame:
    """Rows of a table that belong to a subject, with ``_subject``."""
    rows = tables[scope.table]
    if scope.address is None:
        owned = lookup(rows, found.keys, "customer_key", F.struct(*rows.columns), rows, **limits)
        return owned.filter(F.col("_subject").isNotNull())
    if scope.within:
        named = rows.withColumn("_subject", F.explode(_addresses(scope)))
        return split(named, found.addresses, "_subject", True, **limits)
    return split(rows.withColumn("_subject", normalise(F.expr(scope.address))), found.addresses, "_subject", True, **limits)


def without_subjects(tables: dict[str, DataFrame], scope: Scope, found: Subjects, **limits: int) -> DataFrame:
    """The table without the rows of the subjects."""
    rows = tables[scope.table]
    if scope.address is None:
        kept = split(rows, found.keys, "customer_key", False, **limits)
    elif scope.within:
        # Equal rows hold the same addresses, so what a row holds tells it from others.
        content = F.struct(*[F.xxhash64(F.lit(salt), *rows.columns).alias(f"h{salt}") for salt in (1, 2)])
        hit = rows_of_subjects(tables, scope, found, **limits).select(F.xxhash64(F.lit(1), *rows.columns).alias("_h1"),
                                                                      F.xxhash64(F.lit(2), *rows.columns).alias("_h2")).distinct()
        marked = rows.withColumn("_content", content)
        kept = marked.join(hit, (F.col("_content.h1") == F.col("_h1")) & (F.col("_content.h2") == F.col("_h2")), "left_anti")
    else:
        addressed = rows.withColumn("_subject", normalise(F.expr(scope.address)))
        kept = split(addressed, found.addresses, "_subject", False, **limits)
    return kept.select(*rows.columns)


def erasure_counts(tables: dict[str, DataFrame], found: Subjects,
                   scopes: tuple[Scope, ...] = CORE_SCOPE) -> DataFrame:
    """Rows to delete per subject and table; every requested subject is listed."""
    present = [s for s in scopes if s.table in tables]
    counted = reduce(DataFrame.unionByName, [
        rows_of_subjects(tables, s, found).groupBy("_subject").agg(F.count("*").alias("rows"))
        .withColumn("table", F.lit(s.table))
        for s in present
    ])
    wide = counted.groupBy("_subject").agg(*[
        F.sum(F.when(F.col("table") == s.table, F.col("rows"))).alias(s.table) for s in present
    ])
    return found.addresses.join(wide, "_subject", "left").select(
        F.col("_subject").alias("email_normalized"),
        *[F.coalesce(F.col(s.table), F.lit(0)).alias(s.table) for s in present],
    )


def erase(tables: dict[str, DataFrame], found: Subjects,
          scopes: tuple[Scope, ...] = CORE_SCOPE) -> dict[str, DataFrame]:
    """Every table in scope without the subjects, in the order to commit them."""
    return {s.table: without_subjects(tables, s, found) for s in scopes if s.table in tables}


def before_after(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """Row counts per table before and after an erasure."""
    def counts(tables: dict[str, DataFrame], column: str) -> DataFrame:
        return reduce(DataFrame.unionByName, [
            tables[name].agg(F.count("*").alias(column)).withColumn("table", F.lit(name)) for name in after
        ])

    return counts(before, "rows_before").join(counts(after, "rows_after"), "table").withColumn(
        "rows_deleted", F.col("rows_before") - F.col("rows_after"))


def audit_requests(requests: DataFrame, request_type: str, status: str, requested_at: Column,
                   after: Column | int = 0, notes: Column | None = None, hashed: bool = False) -> DataFrame:
    """Audit rows with request ids following ``after``, in the order of the address digest."""
    people = requests.select("customer_email").filter(F.col("customer_email").isNotNull()).distinct()
    numbered = assign_keys(people, "customer_email", "request_id", after)
    address = F.sha2(normalise(F.col("customer_email")), 256) if hashed else F.col("customer_email")
    return numbered.select(
        "request_id",
        F.lit(request_type).alias("request_type"),
        address.alias("customer_email"),
        requested_at.alias("requested_at"),
        F.lit(None).cast("timestamp").alias("processed_at"),
        F.lit(status).alias("status"),
        (F.lit(None).cast("string") if notes is None else notes).alias("notes"),
    )


def erasure_note() -> Column:
    return F.format_string(ERASURE_RESULT, "customers_golden", "dim_customer", "streaming_orders", "fact_sales")


def complete_erasure(processing: DataFrame, counts: DataFrame, processed_at: Column) -> DataFrame:
    """The closing audit row of each erasure request, with what was deleted."""
    found = counts.select(F.col("email_normalized").alias("_subject"), erasure_note().alias("_notes"))
    return (
        processing.withColumn("_subject", normalise(F.col("customer_email")))
        .join(found, "_subject", "left")
        .withColumns({"processed_at": processed_at, "status": F.lit("completed"), "notes": F.col("_notes")})
        .select(*processing.columns)
    )


def current_requests(audit: DataFrame) -> DataFrame:
    """Latest state of each request in an append-only audit table."""
    state = F.struct(*[c for c in audit.columns if c != "request_id"])
    rank = F.struct(F.col("processed_at").isNotNull(), F.col("status") == "completed", F.col("requested_at"))
    return audit.groupBy("request_id").agg(F.max_by(state, rank).alias("s")).select("request_id", "s.*")
