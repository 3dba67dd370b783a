"""SQL giving the same results as the registered queries, for another engine."""

from __future__ import annotations

ARRIVAL = ("l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, "
           "l_returnflag, l_linestatus")

MESSAGES = f"""
as_of AS (SELECT max(CAST(o_orderdate AS DATE)) AS today FROM orders),
lines AS (
  SELECT *, o_orderkey % 3 AS kind, CAST(round(l_extendedprice * 100) AS BIGINT) AS line_cents,
         CAST(l_quantity AS BIGINT) AS units
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
sent AS (
  SELECT {ARRIVAL},
    CASE WHEN kind = 2 THEN 'orders.pos' ELSE 'orders.web' END AS topic,
    CASE WHEN kind = 2 THEN 'POS-' ELSE 'WEB-' END || l_orderkey || '-' || l_linenumber AS order_id,
    CASE WHEN l_partkey % 53 = 0 THEN 'not-an-email' WHEN l_partkey % 83 = 0 THEN 'Stranger@Email.com'
         WHEN l_partkey % 59 = 0 THEN NULL
         ELSE 'Customer' || o_custkey || '@Email.com' END AS customer_email,
    CASE WHEN l_partkey % 61 = 0 THEN 'phone' WHEN kind = 0 THEN 'web' WHEN kind = 1 THEN 'app'
         ELSE 'store' END AS channel,
    CASE WHEN kind = 2 AND l_suppkey % 47 <> 0 THEN 'S' || lpad(CAST(l_suppkey AS VARCHAR), greatest(4, length(CAST(l_suppkey AS VARCHAR)))::INTEGER, '0') END AS store_code,
    CASE WHEN l_partkey % 67 = 0 THEN 'WEB-' || l_partkey WHEN l_partkey % 79 = 0 THEN 'UC-ZZ-999'
         ELSE 'UC-' || upper(left(p_type, 2)) || '-' || lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') END AS product_ref,
    CAST(CASE WHEN l_partkey % 71 = 0 THEN 0 ELSE units END AS INTEGER) AS quantity,
    line_cents // units AS unit_price_cents,
    CASE WHEN l_linenumber = 7 THEN line_cents ELSE units * (line_cents // units) END AS amount_cents,
    l_shipdate AS order_timestamp
  FROM lines),
checked AS (
  SELECT *,
    round(quantity * (unit_price_cents / 100.0::DOUBLE), 2) AS expected,
    amount_cents / 100.0::DOUBLE AS amount,
    CASE
      WHEN customer_email IS NULL THEN 'missing_customer_email'
      WHEN NOT regexp_matches(customer_email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}$') THEN 'email'
      WHEN NOT regexp_matches(product_ref, '^UC-[A-Z]{{2}}-[0-9]{{3}}$') THEN 'product'
      WHEN quantity <= 0 THEN 'quantity'
      WHEN unit_price_cents <= 0 OR amount_cents <= 0 THEN 'price'
      WHEN abs(round(quantity * (unit_price_cents / 100.0::DOUBLE), 2) - amount_cents / 100.0::DOUBLE) > 0.05 THEN 'amount'
      WHEN channel NOT IN ('web', 'app', 'store') THEN 'channel'
      WHEN channel = 'store' AND (store_code IS NULL OR store_code = '') THEN 'store'
    END AS error_code
  FROM sent),
rejects AS (
  SELECT *, CASE error_code
      WHEN 'missing_customer_email' THEN 'Champ obligatoire manquant: customer_email'
      WHEN 'email' THEN 'Email client invalide'
      WHEN 'product' THEN 'Reference produit invalide'
      WHEN 'quantity' THEN 'Quantite doit etre positive'
      WHEN 'price' THEN 'Montants doivent etre positifs'
      WHEN 'amount' THEN 'Incoherence montant: attendu ' || expected || ', recu ' || amount
      WHEN 'channel' THEN 'Canal inconnu: ' || channel
      WHEN 'store' THEN 'store_code obligatoire pour le canal store' END AS error_reason
  FROM checked WHERE error_code IS NOT NULL),
landed AS (
  SELECT * EXCLUDE (nth) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {ARRIVAL}) AS nth FROM checked WHERE error_code IS NULL)
  WHERE nth = 1)"""

REFERENCE = """
people AS (
  SELECT c.*, first_order, last_order FROM customer c LEFT JOIN (
    SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_order, max(CAST(o_orderdate AS DATE)) AS last_order
    FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey),
known AS (
  SELECT c_custkey AS k, c_name AS first_name, c_mktsegment AS last_name,
         '+33' || lpad(CAST(c_custkey AS VARCHAR), greatest(9, length(CAST(c_custkey AS VARCHAR)))::INTEGER, '0') AS phone, c_acctbal > 0 AS consent_marketing,
         first_order AS consent_date, last_order FROM people),
unified AS (
  SELECT 'CRM-' || k AS source_id, 'crm' AS source_system, 'customer' || k || '@email.com' AS email,
         first_name, last_name, phone, consent_marketing, consent_date,
         CASE WHEN k % 11 <> 0 THEN last_order - CAST(k % 7 AS INTEGER) END AS last_activity,
         CAST(NULL AS VARCHAR) AS store_code, 1 AS source_priority
  FROM known WHERE k % 2 = 0 OR (k % 3 <> 0 AND k % 5 > 1)
  UNION ALL
  SELECT 'WEB-' || k, 'web',
         CASE WHEN k % 10 = 9 THEN ' Customer' || k || '@EMAIL.com ' ELSE 'Customer' || k || '@EMAIL.com' END,
         first_name, last_name, phone, consent_marketing, consent_date, last_order - CAST(k % 5 AS INTEGER), NULL, 2
  FROM known WHERE k % 3 = 0
  UNION ALL
  SELECT 'POS-' || k, 'pos',
         CASE WHEN k % 97 = 0 THEN NULL WHEN k % 89 = 0 THEN '' ELSE 'CUSTOMER' || k || '@email.com' END,
         first_name, last_name, phone, consent_marketing, consent_date, last_order,
         'S' || lpad(CAST(k % 10 AS VARCHAR), 4, '0'), 3
  FROM known WHERE k % 5 <= 1),
cleaned AS (
  SELECT *, lower(trim(email)) AS email_normalized FROM unified),
golden AS (
  SELECT md5(email_normalized) AS golden_id, email_normalized, email, first_name, last_name, phone, consent_marketing,
         consent_date, last_activity, last_activity >= today - INTERVAL 12 MONTH AS is_active_12m,
         regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$', 'i') AS email_valid, duplicate_count
  FROM (SELECT *, count(*) OVER (PARTITION BY email_normalized) AS duplicate_count,
               row_number() OVER (PARTITION BY email_normalized
                                  ORDER BY source_priority, last_activity DESC NULLS LAST, source_id) AS nth
        FROM cleaned WHERE email_normalized IS NOT NULL AND email_normalized <> ''), as_of
  WHERE nth = 1),
dim_customer AS (
  SELECT row_number() OVER (ORDER BY md5(email_normalized), email_normalized) AS customer_key, golden.* FROM golden),
refs AS (
  SELECT *, 'UC-' || upper(left(p_type, 2)) || '-' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') AS ref FROM part),
erp AS (
  SELECT ref AS product_ref, p_name AS product_name, p_brand AS category,
         CAST(round(p_retailprice * 100) AS BIGINT) AS price_cents, p_size AS stock_qty
  FROM refs WHERE p_partkey % 4 <> 0),
shop AS (
  SELECT 'SKU-' || p_partkey AS web_sku,
         CASE WHEN p_partkey % 21 = 0 THEN 'WEB-' || p_partkey ELSE ref END AS product_ref,
         p_name || ' (web)' AS product_name, p_brand AS category,
         CAST(round(p_retailprice * 1.05::DOUBLE * 100) AS BIGINT) AS price_cents
  FROM refs WHERE p_partkey % 3 = 0 OR p_partkey % 4 = 0),
products AS (
  SELECT product_ref AS source_ref, 'erp' AS source_system, product_ref, product_name, category, price_cents,
         stock_qty, 1 AS source_priority FROM erp
  UNION ALL
  SELECT web_sku, 'web', product_ref, product_name, category, price_cents, NULL, 2 FROM shop),
golden_products AS (
  SELECT product_ref, product_name, category, price_cents, stock_qty, product_ref || '.jpg' AS image_object_key,
         source_system
  FROM (SELECT *, row_number() OVER (PARTITION BY product_ref ORDER BY source_priority, source_ref, product_name, category,
                                                       price_cents, stock_qty) AS nth FROM products
        WHERE product_ref IS NOT NULL)
  WHERE nth = 1),
dim_product AS (
  SELECT row_number() OVER (ORDER BY md5(product_ref), product_ref) AS product_key, golden_products.*
  FROM golden_products),
stores AS (
  SELECT 'S' || lpad(CAST(s_suppkey AS VARCHAR), greatest(4, length(CAST(s_suppkey AS VARCHAR)))::INTEGER, '0') AS store_code, s_name AS store_name, n_name AS city,
         r_name AS region, s_acctbal
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
store_members AS (
  SELECT store_code, store_name, city, region, s_acctbal FROM stores
  UNION ALL SELECT 'ONLINE', 'En ligne', 'Paris', 'National', 1.0),
dim_store AS (
  SELECT row_number() OVER (ORDER BY md5(store_code), store_code) AS store_key, store_code, store_name, city, region
  FROM store_members),
dim_channel AS (
  SELECT row_number() OVER (ORDER BY md5(channel_code)) AS channel_key, * FROM (VALUES
    ('web', 'Site e-commerce'), ('app', 'Application mobile'), ('store', 'Boutique physique')) AS t(channel_code, channel_name)),
days AS (
  SELECT CAST(unnest(generate_series(min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)), INTERVAL 1 DAY)) AS DATE)
    AS full_date FROM lineitem),
dim_date AS (
  SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
         CAST(dayofweek(full_date) AS INTEGER) AS day_of_week, dayname(full_date) AS day_name,
         CAST(weekofyear(full_date) AS INTEGER) AS week_of_year, CAST(month(full_date) AS INTEGER) AS month_num,
         monthname(full_date) AS month_name, CAST(quarter(full_date) AS INTEGER) AS quarter_num,
         CAST(year(full_date) AS INTEGER) AS year_num
  FROM days)"""

FACT = """
resolved AS (
  SELECT o.*, d.date_key, c.customer_key, p.product_key, coalesce(s.store_key, online.store_key) AS store_key, h.channel_key
  FROM landed o
  LEFT JOIN dim_date d ON d.full_date = CAST(o.order_timestamp AS DATE)
  LEFT JOIN dim_customer c ON lower(trim(o.customer_email)) = lower(trim(c.email))
  LEFT JOIN dim_product p ON p.product_ref = o.product_ref
  LEFT JOIN dim_store s ON s.store_code = o.store_code
  LEFT JOIN dim_store online ON online.store_code = 'ONLINE'
  LEFT JOIN dim_channel h ON h.channel_code = o.channel),
fact AS (
  SELECT * FROM resolved WHERE date_key IS NOT NULL AND customer_key IS NOT NULL AND product_key IS NOT NULL
    AND channel_key IS NOT NULL AND store_key IS NOT NULL),
loaded_before AS (
  SELECT fact.* FROM fact, as_of WHERE order_timestamp < CAST(today - 730 AS TIMESTAMP)),
asked AS (
  SELECT ' CUSTOMER' || c_custkey || '@Email.COM ' AS customer_email,
         lower(trim(' CUSTOMER' || c_custkey || '@Email.COM ')) AS subject FROM customer WHERE c_acctbal <= 0),
monthly AS (
  SELECT date_trunc('month', order_timestamp)::DATE AS month, count(*) AS events_produced,
         count(error_code) AS events_failed
  FROM checked GROUP BY 1),
run_log AS (
  SELECT CAST(year(month) * 100 + month(month) AS BIGINT) AS run_id, 'order_pipeline' AS dag_id, month,
         events_produced, coalesce(kept, 0) AS events_consumed, events_failed,
         ((20000 * events_failed + events_produced) // (2 * events_produced)) / 100.0::DOUBLE AS reject_pct
  FROM monthly LEFT JOIN (SELECT date_trunc('month', order_timestamp)::DATE AS month, count(*) AS kept FROM landed GROUP BY 1)
  USING (month)),
run_state AS (
  SELECT *, CASE WHEN reject_pct <= 17.5 THEN 'OK' ELSE 'ALERT' END AS dq_status,
         CASE WHEN reject_pct <= 17.5 THEN 'Pipeline termine avec succes' ELSE 'Alerte DQ' END AS notes,
         CAST(CAST(month AS TIMESTAMP) AS VARCHAR) AS started_at FROM run_log)"""

FACT_ROW = """order_id, date_key, customer_key, product_key, store_key, channel_key, quantity,
  unit_price_cents, amount_cents, CAST(order_timestamp AS VARCHAR) AS order_timestamp"""


def sql(select: str, *more: str) -> str:
    return "WITH " + ",".join([MESSAGES, REFERENCE, FACT, *more]) + "\n" + select


def rounded_percent(part: str, whole: str) -> str:
    """Percent with two digits, halves up, in whole numbers."""
    return f"((20000 * ({part}) + ({whole})) // (2 * nullif({whole}, 0))) / 100.0::DOUBLE"


def failures(rows: list[tuple[str, str, str, str]]) -> str:
    counted = " UNION ALL ".join(
        f"SELECT '{test}' AS test, '{table}' AS \"table\", '{column}' AS \"column\", CAST(({query}) AS BIGINT) AS failures"
        for test, table, column, query in rows
    )
    return f"SELECT *, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({counted})"


def not_null(table: str, column: str, source: str, actual: str | None = None) -> tuple[str, str, str, str]:
    return ("not_null", table, column, f"SELECT count(*) FROM {source} WHERE {actual or column} IS NULL")


def unique(table: str, column: str, source: str) -> tuple[str, str, str, str]:
    return ("unique", table, column,
            f"SELECT count(*) FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL "
            f"GROUP BY {column} HAVING count(*) > 1)")


def relation(table: str, column: str, source: str, parent: str) -> tuple[str, str, str, str]:
    return ("relationships", table, column,
            f"SELECT count(*) FROM {source} WHERE {column} IS NOT NULL "
            f"AND {column} NOT IN (SELECT {column} FROM {parent})")


FAULTY = """
raw_events AS (
  SELECT event_id, event_type, user_id, props, CAST(round(value * 100) AS BIGINT) AS c FROM events),
faulty AS (
  SELECT event_id, '{"order_id":"EV-' || event_id || '","customer_email":"user' || user_id
    || '@shop.com","channel":"web","product_ref":"UC-AA-' || lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0')
    || '","quantity":' || CASE WHEN event_type = 'click' THEN '"2"'
         WHEN event_type = 'view' AND event_id % 2 = 0 THEN '1.5' ELSE '2' END
    || ',"unit_price_eur":' || (c // 100) || '.' || lpad(CAST(c % 100 AS VARCHAR), 2, '0')
    || ',"amount_eur":' || CASE event_id % 7 WHEN 0 THEN '"abc"'
         WHEN 1 THEN '"' || ((c * 2) // 100) || '.' || lpad(CAST((c * 2) % 100 AS VARCHAR), 2, '0') || '"'
         WHEN 2 THEN 'null' ELSE ((c * 2) // 100) || '.' || lpad(CAST((c * 2) % 100 AS VARCHAR), 2, '0') END
    || ',"order_timestamp":' || CASE WHEN event_type = 'signup' AND event_id % 2 = 0 THEN '"not a date"'
         WHEN event_type = 'signup' AND event_id % 3 = 0 THEN '"2024-13-45T00:00:00Z"'
         ELSE '"2024-01-31T10:00:00+02:00"' END
    || ',"props":' || props || CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN '' ELSE '}' END
    || CASE event_id % 11 WHEN 3 THEN ' trailing' WHEN 4 THEN '{"order_id":"second"}' ELSE '' END AS payload
  FROM raw_events),
fields AS (
  SELECT event_id, payload, json_valid(payload) AS good,
    CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.amount_eur') END AS amount_text,
    CASE WHEN json_valid(payload) THEN try_cast(json_extract_string(payload, '$.amount_eur') AS DOUBLE) END AS amount,
    CASE WHEN json_valid(payload) THEN try_cast(json_extract_string(payload, '$.unit_price_eur') AS DOUBLE) END AS price,
    CASE WHEN json_valid(payload) THEN json_type(payload, '$.quantity') END AS quantity_type,
    CASE WHEN json_valid(payload) THEN try_cast(json_extract_string(payload, '$.quantity') AS DOUBLE) END AS quantity,
    CASE WHEN json_valid(payload)
         THEN try_cast(json_extract_string(payload, '$.order_timestamp') AS TIMESTAMP WITH TIME ZONE) END AS ts
  FROM faulty)"""

ORACLE: dict[str, str] = {
    "order_events_parsed": sql("""
        SELECT topic, order_id, customer_email, channel, store_code, product_ref, quantity, unit_price_cents, amount_cents,
               CAST(order_timestamp AS VARCHAR) AS order_timestamp FROM sent"""),
    "rule_verdict": sql("SELECT topic, order_id, error_code FROM checked"),
    "rejects_by_reason": sql("SELECT error_code, count(*) AS events FROM rejects GROUP BY 1"),
    "parse_error_quarantine": sql("""
        SELECT event_id, payload, CASE
            WHEN NOT good THEN 'bad_json'
            WHEN amount_text IS NULL THEN 'missing_amount_eur'
            WHEN amount IS NULL THEN 'amount_type'
            WHEN quantity_type = 'VARCHAR' THEN 'quantity_type'
            WHEN quantity <= 0 THEN 'quantity'
            WHEN price <= 0 OR amount <= 0 THEN 'price'
            WHEN abs(round(quantity * price, 2) - amount) > 0.05 THEN 'amount'
            WHEN quantity <> floor(quantity) THEN 'quantity_integer'
            WHEN ts IS NULL THEN 'timestamp' END AS error_code
        FROM fields""", FAULTY),
    "landed_orders": sql("""
        SELECT md5(order_id) AS event_id, order_id, topic AS source_topic, channel, store_code, customer_email, product_ref,
               quantity, unit_price_cents, amount_cents, CAST(order_timestamp AS VARCHAR) AS order_timestamp FROM landed"""),
    "batch_counters": sql("""
        SELECT count(*) AS messages_read, count(error_code) AS events_failed,
               (SELECT count(*) FROM landed) AS events_consumed,
               count(*) - count(error_code) - (SELECT count(*) FROM landed) AS events_duplicate FROM checked"""),
    "dead_letter_envelope": sql("SELECT order_id, error_reason AS error FROM rejects"),
    "failed_events": sql("""
        SELECT topic AS source_topic, order_id, error_code, error_reason, CAST(order_timestamp AS VARCHAR) AS failed_at
        FROM rejects"""),
    "customers_unified": sql("""
        SELECT source_id, source_system, email_normalized, email, first_name, last_name, phone, consent_marketing,
               CAST(consent_date AS VARCHAR) AS consent_date, CAST(CAST(last_activity AS DATE) AS VARCHAR) AS last_activity,
               store_code, source_priority FROM cleaned"""),
    "products_unified": sql("SELECT * FROM products"),
    "customers_golden": sql("""
        SELECT * REPLACE (CAST(consent_date AS VARCHAR) AS consent_date,
                          CAST(CAST(last_activity AS DATE) AS VARCHAR) AS last_activity) FROM golden"""),
    "products_golden": sql("SELECT * FROM golden_products"),
    "dim_date": sql("SELECT * REPLACE (CAST(full_date AS VARCHAR) AS full_date) FROM dim_date"),
    "dim_date_extension": sql("""
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS VARCHAR) AS full_date,
               CAST(dayofweek(d) AS INTEGER) AS day_of_week, rpad(dayname(d), 9, ' ') AS day_name,
               CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(month(d) AS INTEGER) AS month_num,
               rpad(monthname(d), 9, ' ') AS month_name, CAST(quarter(d) AS INTEGER) AS quarter_num,
               CAST(year(d) AS INTEGER) AS year_num
        FROM (SELECT CAST(unnest(generate_series(today - 30, today + 30, INTERVAL 1 DAY)) AS DATE) AS d FROM as_of)
        WHERE d NOT IN (SELECT full_date FROM days
                        WHERE full_date <= (SELECT max(CAST(l_shipdate AS DATE)) - 100 FROM lineitem))"""),
    "dim_channel": sql("""
        SELECT channel_key, channel_code, channel_name, orders FROM dim_channel LEFT JOIN
          (SELECT channel AS channel_code, count(*) AS orders FROM landed GROUP BY 1) USING (channel_code)"""),
    "dim_store_upsert": sql("""
        SELECT CASE WHEN s_acctbal > 0 THEN 0 ELSE (SELECT count(*) FROM store_members WHERE s_acctbal > 0) END
                 + row_number() OVER (PARTITION BY s_acctbal > 0 ORDER BY md5(store_code)) AS store_key,
               store_code, CASE WHEN s_acctbal > 5000 THEN 'Copy of ' ELSE '' END || store_name AS store_name, city, region
        FROM store_members"""),
    "dim_customer": sql("""
        SELECT customer_key, golden_id, email_normalized, email, first_name, last_name, phone, consent_marketing,
               CAST(consent_date AS VARCHAR) AS consent_date, CAST(CAST(last_activity AS DATE) AS VARCHAR) AS last_activity,
               is_active_12m, email_valid, CAST(CAST(today AS TIMESTAMP) AS VARCHAR) AS valid_from
        FROM dim_customer, as_of"""),
    "dim_product": sql("""
        SELECT product_key, product_ref, product_name, category, price_cents, stock_qty, image_object_key,
               'http://localhost:9000/product-images/' || image_object_key AS image_url FROM dim_product"""),
    "golden_enriched": sql("""
        SELECT email_normalized, CAST(CAST(last_activity AS DATE) AS VARCHAR) AS last_activity,
               CAST(last_order_at AS VARCHAR) AS last_order_at, coalesce(order_count, 0) AS order_count,
               CAST(greatest(CAST(last_activity AS DATE), CAST(last_order_at AS DATE)) AS VARCHAR) AS last_seen
        FROM golden LEFT JOIN (
          SELECT lower(trim(customer_email)) AS email_normalized, max(order_timestamp) AS last_order_at,
                 count(*) AS order_count FROM landed GROUP BY 1) USING (email_normalized)"""),
    "price_reconcile": sql("""
        SELECT product_ref, CASE WHEN e.price_cents IS NULL THEN 'web_only' WHEN web_rows IS NULL THEN 'erp_only'
                 WHEN web_min_cents <> e.price_cents OR web_max_cents <> erp_max THEN 'price_differs'
                 ELSE 'same' END AS finding,
               e.price_cents AS erp_price_cents, web_min_cents, web_max_cents, coalesce(web_rows, 0) AS web_rows
        FROM (SELECT product_ref, min(price_cents) AS price_cents, max(price_cents) AS erp_max FROM erp GROUP BY 1) e
             FULL JOIN (SELECT product_ref, count(*) AS web_rows, min(price_cents) AS web_min_cents,
                                     max(price_cents) AS web_max_cents FROM shop GROUP BY 1) USING (product_ref)"""),
    "price_variance": sql("""
        SELECT product_ref, p.price_cents, count(*) AS orders,
               count(*) FILTER (WHERE unit_price_cents <> p.price_cents) AS orders_off_price,
               min(unit_price_cents) AS lowest_price_cents, max(unit_price_cents) AS highest_price_cents
        FROM landed JOIN golden_products p USING (product_ref) GROUP BY ALL"""),
    "stg_orders_pending": sql("""
        SELECT order_id, customer_email, channel, store_code, product_ref, quantity, unit_price_cents, amount_cents,
               CAST(order_timestamp AS VARCHAR) AS order_timestamp
        FROM landed WHERE order_id NOT IN (SELECT order_id FROM loaded_before)"""),
    "stg_customers": sql("""
        SELECT lower(trim(customer_email)) AS email_normalized, customer_email AS email,
               CAST(max(order_timestamp) AS VARCHAR) AS last_order_at FROM landed GROUP BY 1, 2"""),
    "fact_sales_full": sql(f"SELECT {FACT_ROW} FROM fact"),
    "fact_sales_incremental": sql(f"""
        SELECT {FACT_ROW} FROM fact WHERE order_id NOT IN (SELECT order_id FROM loaded_before)"""),
    "mark_processed": sql("""
        SELECT count(*) AS newly_processed FROM fact WHERE order_id NOT IN (SELECT order_id FROM loaded_before)"""),
    "processed_backlog": sql("""
        SELECT count(*) FILTER (WHERE order_id NOT IN (SELECT order_id FROM fact)) AS pending, count(*) AS total
        FROM landed"""),
    "unresolved_orders": sql("""
        SELECT * FROM (SELECT order_id, customer_email, product_ref,
            CASE WHEN date_key IS NULL THEN 'date' WHEN customer_key IS NULL THEN 'customer'
                 WHEN product_key IS NULL THEN 'product' WHEN channel_key IS NULL THEN 'channel'
                 WHEN store_key IS NULL THEN 'store' END AS missing FROM resolved) WHERE missing IS NOT NULL"""),
    "orders_unified": sql(f"""
        SELECT order_id, customer_email, CASE WHEN topic = 'orders.pos' THEN 'store' ELSE channel END AS channel,
               CASE WHEN topic = 'orders.pos' THEN store_code END AS store_code, product_ref, quantity,
               unit_price_cents, amount_cents, CAST(order_timestamp AS VARCHAR) AS order_date
        FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {ARRIVAL}) AS nth FROM sent) WHERE nth = 1"""),
    "dq_metrics": sql(f"""
        SELECT *, CASE WHEN metric_value IS NULL THEN 'ALERT' WHEN metric_value <= target_value THEN 'OK'
                       ELSE 'ALERT' END AS status
        FROM (
          SELECT 'streaming_null_order_rate_pct' AS metric_name,
                 {rounded_percent("count(*) FILTER (WHERE order_id IS NULL OR amount_cents IS NULL)", "count(*)")}
                   AS metric_value, 0.0::DOUBLE AS target_value
          FROM landed WHERE order_timestamp >= (SELECT max(order_timestamp) FROM landed) - INTERVAL 1 DAY
          UNION ALL
          SELECT 'streaming_duplicate_order_rate_pct',
                 {rounded_percent("count(*) - count(DISTINCT order_id)", "count(*)")}, 0.0 FROM landed
          UNION ALL
          SELECT 'fact_sales_orphan_product_rate_pct',
                 {rounded_percent("count(*) FILTER (WHERE p.product_key IS NULL)", "count(*)")}, 0.0
          FROM fact LEFT JOIN dim_product p ON p.product_key = fact.product_key
          UNION ALL
          SELECT 'failed_events_count_24h', CAST(count(*) AS DOUBLE), 5.0
          FROM rejects WHERE order_timestamp >= (SELECT max(order_timestamp) FROM landed) - INTERVAL 1 DAY)"""),
    "dq_metrics_raw_events": sql(f"""
        SELECT *, CASE WHEN metric_value IS NULL THEN 'ALERT' WHEN metric_value <= target_value THEN 'OK'
                       ELSE 'ALERT' END AS status
        FROM (
          SELECT 'streaming_null_order_rate_pct' AS metric_name,
                 {rounded_percent("count(*) FILTER (WHERE order_id IS NULL OR amount_cents IS NULL)", "count(*)")}
                   AS metric_value, 0.0::DOUBLE AS target_value
          FROM sent WHERE order_timestamp >= (SELECT max(order_timestamp) FROM sent) - INTERVAL 1 DAY
          UNION ALL
          SELECT 'streaming_duplicate_order_rate_pct',
                 {rounded_percent("count(*) - count(DISTINCT order_id)", "count(*)")}, 0.0 FROM sent
          UNION ALL
          SELECT 'fact_sales_orphan_product_rate_pct',
                 {rounded_percent("count(*) FILTER (WHERE e.product_ref IS NULL)", "count(*)")}, 0.0
          FROM fact LEFT JOIN (SELECT DISTINCT product_ref FROM erp) e ON e.product_ref = fact.product_ref)"""),
    "dq_status": sql("""
        SELECT CASE WHEN count(*) > 5 THEN 'ALERT' ELSE 'OK' END AS dq_status,
               CASE WHEN count(*) > 5 THEN 'ALERT' ELSE 'OK' END AS run_status
        FROM rejects WHERE order_timestamp >= (SELECT max(order_timestamp) FROM landed) - INTERVAL 1 DAY"""),
    "column_tests": sql(failures([
        not_null("stg_orders", "order_id", "landed"), not_null("stg_orders", "amount_eur", "landed", "amount_cents"),
        not_null("stg_orders", "customer_email", "landed"), unique("stg_orders", "order_id", "landed"),
        not_null("fact_sales", "order_id", "fact"), not_null("fact_sales", "amount_eur", "fact", "amount_cents"),
        not_null("fact_sales", "product_key", "fact"), not_null("fact_sales", "customer_key", "fact"),
        unique("fact_sales", "order_id", "fact"), relation("fact_sales", "product_key", "fact", "dim_product"),
        relation("fact_sales", "customer_key", "fact", "dim_customer")])),
    "column_tests_raw_events": sql(failures([
        not_null("stg_orders", "order_id", "sent"), not_null("stg_orders", "amount_eur", "sent", "amount_cents"),
        not_null("stg_orders", "customer_email", "sent"), unique("stg_orders", "order_id", "sent")])),
    "constraint_tests": sql(failures([
        unique("streaming_orders", "event_id", "(SELECT md5(order_id) AS event_id FROM landed)"),
        not_null("streaming_orders", "event_id", "(SELECT md5(order_id) AS event_id FROM landed)"),
        unique("streaming_orders", "order_id", "landed"), not_null("streaming_orders", "order_id", "landed"),
        not_null("streaming_orders", "order_timestamp", "landed"),
        unique("customers_golden", "email_normalized", "golden"), unique("products_golden", "product_ref", "golden_products"),
        unique("dim_date", "date_key", "dim_date"), unique("dim_date", "full_date", "dim_date"),
        not_null("dim_date", "full_date", "dim_date"),
        unique("dim_channel", "channel_code", "dim_channel"), not_null("dim_channel", "channel_code", "dim_channel"),
        unique("dim_store", "store_code", "dim_store"), not_null("dim_store", "store_code", "dim_store"),
        unique("dim_customer", "customer_key", "dim_customer"), unique("dim_customer", "golden_id", "dim_customer"),
        unique("dim_product", "product_key", "dim_product"), unique("dim_product", "product_ref", "dim_product"),
        not_null("dim_product", "product_ref", "dim_product"),
        not_null("fact_sales", "quantity", "fact"), not_null("fact_sales", "order_timestamp", "fact"),
        relation("fact_sales", "date_key", "fact", "dim_date"), relation("fact_sales", "store_key", "fact", "dim_store"),
        relation("fact_sales", "channel_key", "fact", "dim_channel")])),
    "dim_customer_masked": sql("""
        SELECT customer_key, golden_id, '***@' || split_part(email, '@', 2) AS email_masked,
               left(first_name, 1) || '***' AS first_name_masked, left(last_name, 1) || '***' AS last_name_masked,
               consent_marketing, CAST(consent_date AS VARCHAR) AS consent_date,
               CAST(CAST(last_activity AS DATE) AS VARCHAR) AS last_activity, is_active_12m, email_valid FROM dim_customer"""),
    "sales_analytics": sql("""
        SELECT f.order_id, CAST(d.full_date AS VARCHAR) AS full_date, d.month_name, d.year_num,
               '***@' || split_part(c.email, '@', 2) AS email_masked, c.is_active_12m, c.consent_marketing,
               p.product_ref, p.product_name, p.category, s.store_name, h.channel_name, f.quantity, f.amount_cents
        FROM fact f JOIN dim_date d USING (date_key) JOIN dim_customer c USING (customer_key)
        JOIN dim_product p USING (product_key) JOIN dim_store s USING (store_key) JOIN dim_channel h USING (channel_key)"""),
    "export_subjects": sql("""
        SELECT source_system, email, first_name, last_name, consent_marketing,
               CAST(CAST(last_activity AS DATE) AS VARCHAR) AS last_activity
        FROM cleaned WHERE lower(trim(email)) IN (SELECT subject FROM asked)"""),
    "table_counts": sql("""
        SELECT 'streaming_orders' AS "table", count(*) AS rows FROM landed
        UNION ALL SELECT 'fact_sales', count(*) FROM fact UNION ALL SELECT 'dim_customer', count(*) FROM dim_customer
        UNION ALL SELECT 'failed_events', count(*) FROM rejects"""),
    "subject_facts": sql("""
        SELECT count(*) AS rows FROM fact WHERE customer_email = (
          SELECT customer_email FROM landed GROUP BY 1 ORDER BY count(*) DESC, customer_email DESC LIMIT 1)"""),
    "run_history": sql("""
        SELECT run_id, dag_id, started_at, events_produced, events_consumed, events_failed, dq_status, notes
        FROM run_state"""),
    "consumed_series": sql('SELECT started_at AS "time", events_consumed AS "value" FROM run_state ORDER BY 1'),
    "latest_runs": sql("""
        SELECT run_id, dag_id, events_produced, events_consumed, events_failed, dq_status, started_at
        FROM run_state ORDER BY month DESC LIMIT 20"""),
    "latest_metrics": sql("""
        SELECT 'reject_rate_pct' AS metric_name, reject_pct AS metric_value, 17.5::DOUBLE AS target_value,
               dq_status AS status, started_at AS measured_at FROM run_state ORDER BY month DESC LIMIT 10"""),
    "alert_runs": sql("SELECT run_id, events_failed, dq_status AS status FROM run_state WHERE dq_status = 'ALERT'"),
    "latest_landed": sql("""
        SELECT order_id, channel, amount_cents, CAST(order_timestamp AS VARCHAR) AS consumed_at FROM landed
        ORDER BY landed.order_timestamp DESC, order_id DESC LIMIT 5"""),
    "latest_sales": sql("""
        SELECT f.order_id, p.product_ref, p.category, f.amount_cents, h.channel_name,
               CAST(f.order_timestamp AS VARCHAR) AS order_timestamp
        FROM fact f JOIN dim_product p USING (product_key) JOIN dim_channel h USING (channel_key)
        ORDER BY f.order_timestamp DESC, f.order_id DESC LIMIT 5"""),
    "event_rate_5m": """
        SELECT event_type, slot + step AS window_end, CAST(sum(n) AS BIGINT) AS events,
               CAST(sum(n) AS BIGINT) / 300.0::DOUBLE AS per_second
        FROM (SELECT event_type, CAST(epoch_us(ts) // 1000000 // 15 * 15 AS BIGINT) AS slot, count(*) AS n
              FROM events GROUP BY 1, 2),
             (SELECT unnest(generate_series(15, 300, 15)) AS step)
        GROUP BY 1, 2""",
    "counter_rate_5m": """
        WITH readings AS (
          SELECT event_type, ts, event_id, epoch_us(ts) // 1000000 // 15 * 15 AS slot,
                 CAST(round(value * 100) AS BIGINT) AS v FROM events WHERE value IS NOT NULL),
        scraped AS (
          SELECT event_type, slot, v FROM (
            SELECT *, row_number() OVER (PARTITION BY event_type, slot ORDER BY ts DESC, event_id DESC) AS nth
            FROM readings) WHERE nth = 1),
        steps AS (SELECT *, lag(v) OVER w AS b, lag(slot) OVER w AS since
                  FROM scraped WINDOW w AS (PARTITION BY event_type ORDER BY slot)),
        windows AS (
          SELECT event_type, CAST(slot + step AS BIGINT) AS window_end,
                 CASE WHEN slot + step <= since + 300 THEN CASE WHEN v >= b THEN v - b ELSE v END ELSE 0 END AS rise
          FROM steps, (SELECT unnest(generate_series(15, 300, 15)) AS step))
        SELECT event_type, window_end, count(*) AS samples, CAST(sum(rise) AS BIGINT) AS increase,
               CAST(sum(rise) AS BIGINT) / 300.0::DOUBLE AS per_second
        FROM windows GROUP BY 1, 2""",
    "gauge_bands": """
        SELECT user_id, v AS last_value,
               CASE WHEN v >= 6000 THEN 'red' WHEN v >= 2000 THEN 'yellow' ELSE 'green' END AS band
        FROM (SELECT user_id, CAST(round(value * 100) AS BIGINT) AS v,
                     row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS nth
              FROM events WHERE event_type <> 'error' AND value IS NOT NULL) WHERE nth = 1""",
    "revenue_by_channel": sql("""
        SELECT channel_code, channel_name, count(*) AS orders, CAST(sum(quantity) AS BIGINT) AS units,
               CAST(sum(amount_cents) AS BIGINT) AS revenue_cents
        FROM fact JOIN dim_channel USING (channel_key) GROUP BY 1, 2"""),
    "revenue_rollup": sql("""
        SELECT region, s.store_code, channel_code, count(*) AS orders, CAST(sum(amount_cents) AS BIGINT) AS revenue_cents,
               CAST(grouping(region, s.store_code, channel_code) AS INTEGER) AS level
        FROM fact JOIN dim_store s USING (store_key) JOIN dim_channel USING (channel_key)
        GROUP BY ROLLUP (region, s.store_code, channel_code)"""),
    "revenue_window": sql("""
        SELECT CAST(make_timestamp(w * 604800000000) AS VARCHAR) AS window_start,
               CAST(make_timestamp((w + 1) * 604800000000) AS VARCHAR) AS window_end, channel, count(*) AS orders,
               CAST(sum(amount_cents) AS BIGINT) AS revenue_cents
        FROM (SELECT *, CAST(epoch_us(order_timestamp) // 604800000000 AS BIGINT) AS w FROM landed)
        GROUP BY w, channel"""),
}

ORACLE["fact_from_history"] = sql(f"""
    SELECT o.order_id, d.date_key, c.customer_key, p.product_key, coalesce(s.store_key, online.store_key) AS store_key,
           h.channel_key, o.quantity, o.unit_price_cents, o.amount_cents,
           CAST(o.order_timestamp AS VARCHAR) AS order_timestamp
    FROM (SELECT * REPLACE (CASE WHEN topic = 'orders.pos' THEN 'store' ELSE channel END AS channel,
                            CASE WHEN topic = 'orders.pos' THEN store_code END AS store_code),
                 row_number() OVER (PARTITION BY order_id ORDER BY {ARRIVAL}) AS nth FROM sent) o
    JOIN dim_date d ON d.full_date = CAST(o.order_timestamp AS DATE)
    JOIN dim_customer c ON lower(trim(o.customer_email)) = lower(trim(c.email))
    JOIN dim_product p ON p.product_ref = o.product_ref
    LEFT JOIN dim_store s ON s.store_code = o.store_code
    JOIN dim_store online ON online.store_code = 'ONLINE'
    JOIN dim_channel h ON h.channel_code = o.channel
    WHERE nth = 1""")
ORACLE["stream_deduplicated"] = sql("SELECT order_id FROM landed")
ORACLE["stream_landed"] = sql("""
    SELECT md5(order_id) AS event_id, order_id, topic AS source_topic, channel, store_code, customer_email, product_ref,
           quantity, unit_price_cents, amount_cents, CAST(order_timestamp AS VARCHAR) AS order_timestamp,
           order_id AS sent_order_id, CAST(quantity AS VARCHAR) AS sent_quantity FROM landed""")
ORACLE["stream_failed"] = sql("SELECT topic AS source_topic, order_id, error_code, error_reason FROM rejects")
ORACLE["seed_customers"] = sql("""
    SELECT source_id, nullif(email, '') AS email, first_name, last_name, phone, consent_marketing,
           CAST(consent_date AS VARCHAR) AS consent_date, CAST(CAST(last_activity AS DATE) AS VARCHAR) AS last_activity,
           store_code, source_system FROM unified WHERE source_system = 'pos'""")

CYCLES = """
cycles AS (
  SELECT 0 AS batch_id, count(*) AS sent, count(error_code) AS failed FROM checked
  UNION ALL SELECT 1, count(*), count(error_code) FROM checked WHERE l_partkey % 10 = 0),
cycle_failures AS (SELECT batch_id, sent, failed, sum(failed) OVER (ORDER BY batch_id) AS so_far FROM cycles)"""
ORACLE["pipeline_metrics"] = sql(f"""
    SELECT batch_id, metric_name, CAST(metric_value AS DOUBLE) AS metric_value, target_value,
           CASE WHEN metric_value <= target_value THEN 'OK' ELSE 'ALERT' END AS status
    FROM (
      SELECT batch_id, 'streaming_null_order_rate_pct' AS metric_name, (SELECT
             {rounded_percent("count(*) FILTER (WHERE order_id IS NULL OR amount_cents IS NULL)", "count(*)")} FROM landed)
               AS metric_value, 0.0::DOUBLE AS target_value FROM cycles
      UNION ALL SELECT batch_id, 'streaming_duplicate_order_rate_pct', (SELECT
             {rounded_percent("count(*) - count(DISTINCT order_id)", "count(*)")} FROM landed), 0.0 FROM cycles
      UNION ALL SELECT batch_id, 'fact_sales_orphan_product_rate_pct', (SELECT
             {rounded_percent("count(*) FILTER (WHERE p.product_key IS NULL)", "count(*)")}
             FROM fact LEFT JOIN dim_product p ON p.product_key = fact.product_key), 0.0 FROM cycles
      UNION ALL SELECT batch_id, 'failed_events_count_24h', so_far, 5.0 FROM cycle_failures)""", CYCLES)
ORACLE["pipeline_tests"] = (
    f"WITH found AS ({ORACLE['column_tests']}) SELECT found.*, batch_id FROM found, (VALUES (0), (1)) AS t(batch_id)")
ORACLE["pipeline_log"] = sql("""
    SELECT batch_id AS run_id, 'order_pipeline' AS dag_id, sent AS events_produced,
           CASE batch_id WHEN 0 THEN (SELECT count(*) FROM landed) ELSE 0 END AS events_consumed, failed AS events_failed,
           sent - failed - CASE batch_id WHEN 0 THEN (SELECT count(*) FROM landed) ELSE 0 END AS events_duplicate,
           CASE WHEN so_far > 5 THEN 'ALERT' ELSE 'OK' END AS dq_status
    FROM cycle_failures""", CYCLES)
ORACLE["backlog_resolved"] = sql("""
        SELECT order_id, CASE WHEN product_ref IN (SELECT product_ref FROM erp WHERE product_ref IS NOT NULL)
          AND CAST(order_timestamp AS DATE) <= (SELECT max(full_date) - 365 FROM days) THEN 0 ELSE 1 END AS load_id
        FROM fact""")
ORACLE["fact_rebuilt"] = ORACLE["fact_sales_full"]
ORACLE["pipeline_run"] = ORACLE["fact_sales_full"]
ORACLE["fact_sales_skewed"] = ORACLE["fact_sales_full"]

ERASED = """
erased_rows AS (
  SELECT subject, 'fact_sales' AS t FROM fact JOIN dim_customer USING (customer_key)
    JOIN (SELECT DISTINCT subject FROM asked) ON lower(trim(email)) = subject
  UNION ALL SELECT subject, 'streaming_orders' FROM landed
    JOIN (SELECT DISTINCT subject FROM asked) ON lower(trim(customer_email)) = subject
  UNION ALL SELECT subject, 'customers_golden' FROM golden
    JOIN (SELECT DISTINCT subject FROM asked) ON email_normalized = subject
  UNION ALL SELECT subject, 'dim_customer' FROM dim_customer
    JOIN (SELECT DISTINCT subject FROM asked) ON lower(trim(email)) = subject),
erased_counts AS (
  SELECT a.subject AS email_normalized, count(*) FILTER (WHERE t = 'fact_sales') AS fact_sales,
         count(*) FILTER (WHERE t = 'streaming_orders') AS streaming_orders,
         count(*) FILTER (WHERE t = 'customers_golden') AS customers_golden,
         count(*) FILTER (WHERE t = 'dim_customer') AS dim_customer
  FROM (SELECT DISTINCT subject FROM asked) a LEFT JOIN erased_rows e ON a.subject = e.subject GROUP BY 1),
requested AS (
  SELECT customer_email, subject, row_number() OVER (ORDER BY md5(customer_email), customer_email) AS n FROM asked),
trail AS (
  SELECT n AS request_id, 'access' AS request_type, customer_email, subject, CAST(NULL AS VARCHAR) AS processed_at,
         CAST(NULL AS VARCHAR) AS notes FROM requested
  UNION ALL
  SELECT n + (SELECT count(*) FROM requested), 'erasure', customer_email, subject,
         CAST(CAST(today AS TIMESTAMP) AS VARCHAR),
         'Supprime staging=' || customers_golden || ', dwh=' || dim_customer || ', raw=' || streaming_orders
           || ', fact_sales=' || fact_sales
  FROM requested JOIN erased_counts ON subject = email_normalized, as_of)"""

ORACLE["erase_counts"] = sql("SELECT * FROM erased_counts", ERASED)
ORACLE["erase_effect"] = sql("""
    SELECT "table", rows_before, rows_before - rows_deleted AS rows_after, rows_deleted FROM (
      SELECT 'fact_sales' AS "table", (SELECT count(*) FROM fact) AS rows_before,
             (SELECT count(*) FROM erased_rows WHERE t = 'fact_sales') AS rows_deleted
      UNION ALL SELECT 'streaming_orders', (SELECT count(*) FROM landed),
             (SELECT count(*) FROM erased_rows WHERE t = 'streaming_orders')
      UNION ALL SELECT 'customers_golden', (SELECT count(*) FROM golden),
             (SELECT count(*) FROM erased_rows WHERE t = 'customers_golden')
      UNION ALL SELECT 'dim_customer', (SELECT count(*) FROM dim_customer),
             (SELECT count(*) FROM erased_rows WHERE t = 'dim_customer'))""", ERASED)
ORACLE["erase_full_effect"] = sql("""
    SELECT "table", count(t.subject) AS rows_deleted FROM (
      SELECT t AS "table", subject FROM erased_rows
      UNION ALL SELECT unnest(['failed_events', 'dead_letters']), a.subject FROM rejects
        JOIN (SELECT DISTINCT subject FROM asked) a ON lower(trim(customer_email)) = a.subject
      UNION ALL SELECT unnest(['customers_unified', 'customers_' || source_system]), a.subject FROM unified
        JOIN (SELECT DISTINCT subject FROM asked) a ON lower(trim(email)) = a.subject) t
    GROUP BY 1""", ERASED)
ORACLE["fact_after_erasure"] = sql(f"""
    SELECT {FACT_ROW} FROM fact WHERE customer_key NOT IN (
      SELECT customer_key FROM dim_customer WHERE lower(trim(email)) IN (SELECT subject FROM asked))""")
ORACLE["audit_trail"] = sql("""
    SELECT request_id, request_type, customer_email, CAST(CAST(today AS TIMESTAMP) AS VARCHAR) AS requested_at,
           processed_at, 'completed' AS status, notes FROM trail, as_of""", ERASED)
ORACLE["latest_audit"] = sql("""
    SELECT request_id, request_type, 'completed' AS status, notes FROM trail
    WHERE subject = (SELECT max(subject) FROM trail) ORDER BY request_id DESC LIMIT 2""", ERASED)

ORACLE["customer_history"] = sql("""
    SELECT email_normalized, golden_id, email, first_name, last_name, phone, consent_marketing,
           CAST(consent_date AS VARCHAR) AS consent_date, CAST(CAST(last_activity AS DATE) AS VARCHAR) AS last_activity,
           is_active_12m, email_valid, valid_from, valid_to
    FROM (
      SELECT f.* EXCLUDE (duplicate_count), '1995-01-01 00:00:00' AS valid_from,
             CASE WHEN same THEN NULL ELSE CAST(CAST(today AS TIMESTAMP) AS VARCHAR) END AS valid_to
      FROM first_golden f JOIN compared USING (email_normalized), as_of
      UNION ALL
      SELECT g.* EXCLUDE (duplicate_count), CAST(CAST(today AS TIMESTAMP) AS VARCHAR), NULL
      FROM golden g LEFT JOIN compared USING (email_normalized), as_of WHERE same IS NULL OR NOT same)""", """
first_golden AS (
  SELECT md5(email_normalized) AS golden_id, email_normalized, email, first_name, last_name, phone, consent_marketing,
         consent_date, last_activity, last_activity >= today - 365 - INTERVAL 12 MONTH AS is_active_12m,
         regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$', 'i') AS email_valid,
         CAST(1 AS BIGINT) AS duplicate_count
  FROM (SELECT *, row_number() OVER (PARTITION BY email_normalized
                                     ORDER BY source_priority, last_activity DESC NULLS LAST, source_id) AS nth
        FROM cleaned WHERE source_system <> 'crm' AND email_normalized IS NOT NULL AND email_normalized <> ''), as_of
  WHERE nth = 1),
compared AS (
  SELECT f.email_normalized,
         (f.email IS NOT DISTINCT FROM g.email AND f.last_activity IS NOT DISTINCT FROM g.last_activity
          AND f.is_active_12m IS NOT DISTINCT FROM g.is_active_12m
          AND f.email_valid IS NOT DISTINCT FROM g.email_valid) AS same
  FROM first_golden f JOIN golden g USING (email_normalized))""")
