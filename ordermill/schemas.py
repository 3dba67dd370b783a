"""Declared column lists of every stored table. Nothing is inferred.

Fixed values: names and types of columns are those other systems read and write.
"""

from __future__ import annotations

CUSTOMER_CSV = """source_id string, email string, first_name string, last_name string, phone string,
    consent_marketing boolean, consent_date date, last_activity date"""
CUSTOMER_POS_CSV = CUSTOMER_CSV + ", store_code string"
PRODUCT_ERP_CSV = "product_ref string, product_name string, category string, price_eur decimal(10,2), stock_qty int"
PRODUCT_WEB_CSV = ("web_sku string, product_ref string, product_name string, category string, "
                   "price_eur decimal(10,2)")
STORE_CSV = "store_code string, store_name string, city string, region string, opened_date date"

LANDED_COLUMNS = (
    "event_id", "order_id", "source_topic", "channel", "store_code", "customer_email", "product_ref",
    "quantity", "unit_price_eur", "amount_eur", "order_timestamp", "payload", "consumed_at",
)
STREAMING_ORDERS = """event_id string, order_id string, source_topic string, channel string, store_code string,
    customer_email string, product_ref string, quantity int, unit_price_eur decimal(10,2),
    amount_eur decimal(10,2), order_timestamp timestamp, payload string, consumed_at timestamp"""
FAILED_EVENTS = """failed_id string, source_topic string, payload string, error_code string,
    error_reason string, failed_at timestamp"""
STAGED_COLUMNS = (
    "order_id", "customer_email", "channel", "store_code", "product_ref",
    "quantity", "unit_price_eur", "amount_eur", "order_timestamp",
)
STAGED_ORDERS = """order_id string, customer_email string, channel string, store_code string,
    product_ref string, quantity int, unit_price_eur decimal(10,2), amount_eur decimal(10,2),
    order_timestamp timestamp"""

CUSTOMERS_UNIFIED_COLUMNS = (
    "source_id", "source_system", "email_normalized", "email", "first_name", "last_name", "phone",
    "consent_marketing", "consent_date", "last_activity", "store_code", "source_priority",
)
PRODUCTS_UNIFIED_COLUMNS = (
    "source_ref", "source_system", "product_ref", "product_name", "category", "price_eur",
    "stock_qty", "source_priority",
)

DIM_DATE = """date_key int, full_date date, day_of_week int, day_name string, week_of_year int,
    month_num int, month_name string, quarter_num int, year_num int"""
DIM_CHANNEL = "channel_key long, channel_code string, channel_name string"
DIM_STORE = "store_key long, store_code string, store_name string, city string, region string"
DIM_CUSTOMER = """customer_key long, golden_id string, email_normalized string, email string,
    first_name string, last_name string, phone string, consent_marketing boolean, consent_date date,
    last_activity date, is_active_12m boolean, email_valid boolean, valid_from timestamp, valid_to timestamp"""
DIM_PRODUCT = """product_key long, product_ref string, product_name string, category string,
    price_eur decimal(10,2), stock_qty int, image_object_key string, image_url string"""

DIMENSIONS = {"date": DIM_DATE, "channel": DIM_CHANNEL, "store": DIM_STORE, "customer": DIM_CUSTOMER,
              "product": DIM_PRODUCT}

FACT_COLUMNS = (
    "order_id", "date_key", "customer_key", "product_key", "store_key", "channel_key",
    "quantity", "unit_price_eur", "amount_eur", "order_timestamp",
)
FACT_SALES = """order_id string, date_key int, customer_key long, product_key long, store_key long,
    channel_key long, quantity int, unit_price_eur decimal(10,2), amount_eur decimal(10,2),
    order_timestamp timestamp"""

QUALITY_METRICS = """metric_name string, metric_value decimal(14,4), target_value decimal(14,4),
    measured_at timestamp, status string"""
PIPELINE_RUNS = """run_id long, dag_id string, task_id string, started_at timestamp, finished_at timestamp,
    events_produced long, events_consumed long, events_failed long, events_duplicate long,
    dq_status string, duration_sec decimal(10,2), notes string"""
GDPR_REQUESTS = """request_id long, request_type string, customer_email string, requested_at timestamp,
    processed_at timestamp, status string, notes string"""
