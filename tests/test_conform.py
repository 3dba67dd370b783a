import datetime as dt

from pyspark.sql import functions as F

from ordermill.operators import conform, dims

CUSTOMER = """source_id string, email string, first_name string, last_name string, phone string,
    consent_marketing boolean, consent_date date, last_activity date"""


def customer(source_id, email, last_activity=None, first_name="A"):
    day = dt.date.fromisoformat(last_activity) if last_activity else None
    return (source_id, email, first_name, "B", None, True, None, day)


def sources(spark, crm=(), web=(), pos=()):
    made = {n: spark.createDataFrame(list(rows), CUSTOMER) for n, rows in
            (("crm", crm), ("web", web), ("pos", pos)) if rows}
    if "pos" in made:
        made["pos"] = made["pos"].withColumn("store_code", F.lit("PAR01"))
    return made


def golden(spark, **rows):
    unified = conform.unify_customers(sources(spark, **rows))
    as_of = F.lit(dt.date(2026, 6, 30))
    return {r["email_normalized"]: r for r in conform.golden_customers(unified, as_of).collect()}


def test_priority_before_recency(spark):
    found = golden(spark, crm=[customer("c1", "Ann@x.com", "2020-01-01")], web=[customer("w1", " ann@X.com ", "2026-01-01")])
    assert found["ann@x.com"]["email"] == "Ann@x.com"
    assert found["ann@x.com"]["duplicate_count"] == 2


def test_recency_with_null_last_then_source_id(spark):
    rows = [customer("w3", "a@x.com", None, "null"), customer("w2", "a@x.com", "2025-01-01", "late"),
            customer("w1", "a@x.com", "2024-01-01", "early")]
    assert golden(spark, web=rows)["a@x.com"]["first_name"] == "late"
    tied = [customer("w2", "a@x.com", None, "two"), customer("w1", "a@x.com", None, "one")]
    assert golden(spark, web=tied)["a@x.com"]["first_name"] == "one"


def test_blank_addresses_are_left_out_but_whitespace_trimmed(spark):
    found = golden(spark, web=[customer("w1", None), customer("w2", ""), customer("w3", "  "), customer("w4", "\ta@x.com")])
    assert set(found) == {"\ta@x.com"}


def test_activity_and_validity_flags(spark):
    found = golden(spark, web=[customer("w1", "A@X.COM", "2025-06-30"), customer("w2", "b@x.com", "2025-06-29"),
                               customer("w3", " c@x.com", None)])
    assert (found["a@x.com"]["is_active_12m"], found["a@x.com"]["email_valid"]) == (True, True)
    assert found["b@x.com"]["is_active_12m"] is False
    assert (found["c@x.com"]["is_active_12m"], found["c@x.com"]["email_valid"]) == (None, False)


def test_sources_are_optional_and_store_code_only_from_pos(spark):
    only_web = conform.unify_customers(sources(spark, web=[customer("w1", "a@x.com")])).first()
    assert only_web["store_code"] is None and only_web["source_priority"] == 2
    both = conform.unify_customers(sources(spark, web=[customer("w1", "a@x.com")], pos=[customer("p1", "b@x.com")]))
    assert {r["source_system"]: r["store_code"] for r in both.collect()} == {"web": None, "pos": "PAR01"}


def products(spark):
    erp = spark.createDataFrame([("UC-QK-001", "Shirt", "T", 10, 5)],
                                "product_ref string, product_name string, category string, price_eur int, stock_qty int")
    web = spark.createDataFrame(
        [("s2", "UC-QK-001", "Shirt web", "T", 11), ("s1", "WEB-1", "Bag", "A", 7), ("s0", "WEB-1", "Bag 0", "A", 8),
         ("s9", None, "None", "A", 1)],
        "web_sku string, product_ref string, product_name string, category string, price_eur int")
    as_money = F.col("price_eur").cast("decimal(10,2)")
    return erp.withColumn("price_eur", as_money), web.withColumn("price_eur", as_money)


def test_product_golden_prefers_erp(spark):
    found = {r["product_ref"]: r for r in conform.golden_products(conform.unify_products(*products(spark))).collect()}
    assert set(found) == {"UC-QK-001", "WEB-1"}
    assert found["UC-QK-001"]["product_name"] == "Shirt" and found["UC-QK-001"]["stock_qty"] == 5
    assert found["WEB-1"]["product_name"] == "Bag 0" and found["WEB-1"]["stock_qty"] is None
    assert found["WEB-1"]["image_object_key"] == "WEB-1.jpg"


def test_reconcile_products(spark):
    found = {r["product_ref"]: r["finding"] for r in conform.reconcile_products(*products(spark)).collect()}
    assert found == {"UC-QK-001": "price_differs", "WEB-1": "web_only", None: "web_only"}


def test_golden_has_one_shuffle(spark):
    unified = conform.unify_customers(sources(spark, web=[customer("w1", "a@x.com")]))
    plan = conform.golden_customers(unified, F.current_date())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_min_by" in plan


def test_calendar(spark):
    span = spark.sql("select date'2023-12-31' start, date'2024-01-01' end")
    sunday, monday = dims.calendar(span).orderBy("date_key").collect()
    assert (sunday["date_key"], sunday["day_of_week"], sunday["day_name"], sunday["week_of_year"]) == (20231231, 0, "Sunday", 52)
    assert (monday["day_of_week"], monday["week_of_year"], monday["quarter_num"], monday["year_num"]) == (1, 1, 1, 2024)
    assert dims.calendar(span, padded=True).orderBy("date_key").first()["day_name"] == "Sunday   "
    assert dims.calendar_around(spark).count() == 431
    assert dims.calendar_around(spark, days=dims.CALENDAR_EXTENSION_DAYS).count() == 61
