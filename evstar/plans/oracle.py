"""Reference SQL (DuckDB dialect) for every registered query.

Each statement recomputes, from the same parquet tables, what the Spark
query returns, written independently of the Spark code: the stand-in
messages as plain string building, dedup as QUALIFY, the checks as
GROUP BY / NOT IN. Column names match the Spark output.
"""

from __future__ import annotations

from .build import CHECKS, Check

# Stand-in topic messages, one row per message, with the expected routing
# error (NULL for a valid event).
_MESSAGES = """
e AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
), b AS (
  SELECT *,
    CASE WHEN event_type = 'purchase' THEN 'order' ELSE event_type END AS etype,
    CASE WHEN event_type = 'error' THEN NULL
         WHEN event_type = 'purchase' AND k = 13 THEN 'G' || CAST(user_id AS VARCHAR)
         WHEN k = 17 THEN ''
         ELSE CAST(user_id AS VARCHAR) END AS cid,
    CASE WHEN k <> 61 THEN CAST(event_id AS VARCHAR) END AS eid,
    CASE WHEN event_type = 'purchase' THEN NULL
         WHEN k = 23 THEN '"hello"' WHEN k = 29 THEN '"123"' WHEN k = 31 THEN '42'
         WHEN k = 37 THEN '[1, 2]' WHEN k = 41 THEN 'null' WHEN k = 43 THEN '"null"' END AS scalar,
    CAST(k AS VARCHAR) AS pid,
    CAST(k % 3 + 1 AS INTEGER) AS qty,
    CAST(value AS DECIMAL(10,2)) AS price,
    (['card', 'upi', 'paypal', 'cash_on_delivery'])[user_id % 4 + 1] AS pay,
    CASE WHEN k % 20 = 0 THEN 'cancelled' ELSE 'completed' END AS status,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS ts_text
  FROM e
), c AS (
  SELECT *,
    CAST(price * qty + CASE WHEN pay = 'cash_on_delivery' AND qty > 1 THEN 0.02 ELSE 0.00 END
         AS DECIMAL(12,2)) AS total
  FROM b
), p AS (
  SELECT *,
    CASE WHEN etype = 'order' THEN
      '{"order_id": "O' || CAST(event_id AS VARCHAR) || '", "customer_id": "' || cid
      || '", "product_id": "' || pid || '", "quantity": ' || CAST(qty AS VARCHAR)
      || ', "unit_price": ' || CAST(price AS VARCHAR) || ', "total_amount": ' || CAST(total AS VARCHAR)
      || ', "payment_method": "' || pay || '", "order_status": "' || status || '"}'
    WHEN scalar IS NOT NULL THEN scalar
    WHEN cid IS NULL THEN '{"product_id": "' || pid || '"}'
    ELSE '{"customer_id": "' || cid || '", "product_id": "' || pid || '"}' END AS payload_text,
    '{"event_id": ' || COALESCE('"' || eid || '"', 'null') || ', "event_type": "' || etype
      || '", "event_timestamp": "' || ts_text || '"' AS head
  FROM c
), copies AS (
  SELECT *, 0 AS copy FROM p
  UNION ALL
  SELECT * REPLACE ('cancelled' AS status, replace(payload_text, '"completed"', '"cancelled"') AS payload_text), 1 AS copy
  FROM p WHERE k = 42
), m AS (
  SELECT *,
    CAST(user_id % 3 AS INTEGER) AS partition,
    CAST(event_id * 2 + copy AS BIGINT) AS "offset",
    COALESCE(NULLIF(cid, ''), pid) AS key,
    ts + CASE WHEN copy = 0 THEN INTERVAL 30 SECOND WHEN event_id % 2 = 0 THEN INTERVAL 10 SECOND
              ELSE INTERVAL 90 SECOND END AS ingested,
    -- as kept: compact, numbers through a double
    replace(replace(replace(replace(payload_text, '": ', '":'), ', "', ',"'), ', 2]', ',2]'),
      ',"unit_price":' || CAST(price AS VARCHAR) || ',"total_amount":' || CAST(total AS VARCHAR),
      ',"unit_price":' || CAST(CAST(price AS DOUBLE) AS VARCHAR) || ',"total_amount":' || CAST(CAST(total AS DOUBLE) AS VARCHAR)
    ) AS payload,
    CASE WHEN k = 79 THEN NULL
         WHEN k = 97 THEN substring(head || ', "payload": ' || payload_text || '}', 1, 40)
         WHEN k = 83 THEN '[' || head || ', "payload": ' || payload_text || '}]'
         WHEN k = 89 THEN head || '}'
         WHEN k = 71 THEN head || ', "payload": ' || payload_text || '}'
           || CASE WHEN event_id % 2 = 0 THEN ' x' ELSE head || ', "payload": ' || payload_text || '}' END
         ELSE head || ', "payload": ' || payload_text || '}' END AS msg,
    CASE WHEN k = 79 THEN 'empty message'
         WHEN k IN (71, 97) THEN 'invalid JSON'
         WHEN k = 83 THEN 'message is not a JSON object'
         WHEN k = 89 THEN 'missing fields: [''payload'']' END AS error
  FROM copies
)"""

_STG_ORDERS = """
stg_orders AS (
  SELECT eid AS event_id,
         'O' || CAST(event_id AS VARCHAR) AS order_id,
         cid AS customer_id, pid AS product_id, qty AS quantity, price AS unit_price,
         CAST(total AS DECIMAL(10,2)) AS total_amount, pay AS payment_method,
         status AS order_status, ts AS ordered_at, ingested AS ingested_at
  FROM m
  WHERE error IS NULL AND etype = 'order'
  QUALIFY row_number() OVER (PARTITION BY m.eid ORDER BY ingested, "offset") = 1
)"""

# Through the whole chain all messages are ingested together: the offset decides.
_STG_ORDERS_TOGETHER = _STG_ORDERS.replace("ORDER BY ingested, ", "ORDER BY ")

_STG_PRODUCTS = """
product_snapshots AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price, DATE '2024-01-01' AS snapshot_date
  FROM part
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), p_name, p_type,
         CAST(CAST(p_retailprice AS DECIMAL(10,2)) + 1 AS DECIMAL(10,2)), DATE '2023-12-01'
  FROM part
), stg_products AS (
  SELECT * FROM product_snapshots
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY snapshot_date DESC NULLS FIRST) = 1
)"""

_STG_CUSTOMERS = """
stg_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS full_name,
         lower(replace(c_name, '#', '.')) || '@example.com' AS email,
         CASE WHEN day = DATE '2023-12-01' THEN 'Old ' ELSE '' END || 'City ' || CAST(c_custkey % 50 AS VARCHAR) AS city,
         n_name AS country, DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS signup_date, day AS snapshot_date
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  JOIN (VALUES (DATE '2023-12-01'), (DATE '2024-01-01')) AS snapshots(day)
    ON day = DATE '2023-12-01' OR c_custkey % 10 <> 0
  QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY day DESC) = 1
)"""

_DIMS = """
dim_customers AS (
  SELECT md5(customer_id) AS customer_key, customer_id, full_name, email, city, country, signup_date
  FROM stg_customers
), dim_products AS (
  SELECT md5(product_id) AS product_key, product_id, product_name, category, unit_price AS list_price
  FROM stg_products
), fact_orders AS (
  SELECT o.order_id, c.customer_key, p.product_key,
         CAST(strftime(CAST(o.ordered_at AS DATE), '%Y%m%d') AS INTEGER) AS order_date_key,
         o.ordered_at, o.quantity, o.unit_price, o.total_amount, o.payment_method, o.order_status
  FROM stg_orders o
  LEFT JOIN dim_customers c ON o.customer_id = c.customer_id
  LEFT JOIN dim_products p ON o.product_id = p.product_id
)"""


def _calendar(source: str, column: str) -> str:
    return f"""
bounds AS (SELECT CAST(min({column}) AS DATE) AS lo, CAST(max({column}) AS DATE) AS hi FROM {source}),
spine AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_day FROM bounds),
dim_date AS (
  SELECT CAST(strftime(date_day, '%Y%m%d') AS INTEGER) AS date_key,
         date_day AS calendar_date,
         CAST(year(date_day) AS INTEGER) AS calendar_year,
         CAST(quarter(date_day) AS INTEGER) AS calendar_quarter,
         CAST(month(date_day) AS INTEGER) AS calendar_month,
         strftime(date_day, '%b') AS month_name,
         CAST(day(date_day) AS INTEGER) AS day_of_month,
         CAST(isodow(date_day) AS INTEGER) AS day_of_week,
         strftime(date_day, '%a') AS day_name,
         isodow(date_day) IN (6, 7) AS is_weekend
  FROM spine
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


_MODELS = _with(_MESSAGES, _STG_ORDERS, _STG_PRODUCTS, _STG_CUSTOMERS, _DIMS)

_ROUTE = """
SELECT partition, "offset",
       CASE WHEN error IS NULL THEN 'accepted' ELSE 'quarantined' END AS status,
       error,
       CASE WHEN error IS NULL THEN eid END AS event_id,
       CASE WHEN error IS NULL THEN etype END AS event_type,
       CASE WHEN error IS NULL THEN ts_text END AS event_timestamp,
       CASE WHEN error IS NULL THEN payload END AS payload,
       CASE WHEN error IS NOT NULL THEN msg END AS raw_value
FROM m"""


def _check_sql(check: Check) -> str:
    """Failure count of one declared check as a one-row SELECT."""
    t, col = check.model, check.column
    if check.test == "unique":
        body = f"SELECT count(*) AS n FROM (SELECT {col} FROM {t} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)"
    elif check.test == "not_null":
        body = f"SELECT count(*) AS n FROM {t} WHERE {col} IS NULL"
    elif check.test == "relationships":
        to, field = check.args["to"], check.args["field"]
        body = (
            f"SELECT count(*) AS n FROM {t} WHERE {col} IS NOT NULL "
            f"AND {col} NOT IN (SELECT {field} FROM {to} WHERE {field} IS NOT NULL)"
        )
    elif check.test == "accepted_values":
        listed = ", ".join(f"'{v}'" for v in check.args["values"])
        body = f"SELECT count(*) AS n FROM (SELECT {col} FROM {t} GROUP BY {col} HAVING {col} NOT IN ({listed}))"
    elif check.test == "accepted_range":
        op = ">=" if check.args.get("inclusive", True) else ">"
        body = f"SELECT count(*) AS n FROM {t} WHERE NOT ({col} {op} {check.args['min_value']})"
    elif check.test == "total_matches":
        body = f"SELECT count(*) AS n FROM {t} WHERE abs(total_amount - quantity * unit_price) > 0.01"
    else:
        raise ValueError(check.test)
    return f"SELECT '{check.name}' AS \"check\", CAST(n AS BIGINT) AS failures FROM ({body})"


ORACLE_SQL: dict[str, str] = {
    "stg_orders": _with(_MESSAGES, _STG_ORDERS) + "SELECT * FROM stg_orders",
    "dedup_keep_first": _with(_MESSAGES)
    + """SELECT eid AS event_id, etype AS event_type, partition AS kafka_partition,
       "offset" AS kafka_offset, ingested AS ingested_at
FROM m WHERE error IS NULL
QUALIFY row_number() OVER (PARTITION BY m.eid ORDER BY ingested, "offset") = 1""",
    "latest_snapshot": """SELECT * FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) = 1""",
    "stg_products": _with(_STG_PRODUCTS) + "SELECT * FROM stg_products",
    "stg_customers": _with(_STG_CUSTOMERS) + "SELECT * FROM stg_customers",
    "parse_and_route": _with(_MESSAGES) + _ROUTE,
    "message_key": _with(_MESSAGES) + 'SELECT partition, "offset", key FROM m',
    "dim_customers": _MODELS + "SELECT * FROM dim_customers",
    "dim_products": _MODELS + "SELECT * FROM dim_products",
    "dim_date": _with(_calendar("orders", "o_orderdate")) + "SELECT * FROM dim_date",
    "fact_orders": _MODELS + "SELECT * FROM fact_orders",
    "revenue_by_date_nation": _MODELS
    + """SELECT CAST(f.ordered_at AS DATE) AS order_date, c.country,
       count(*) AS n_orders, CAST(sum(f.total_amount) AS DECIMAL(18,2)) AS revenue
FROM fact_orders f LEFT JOIN dim_customers c ON f.customer_key = c.customer_key
WHERE f.order_status = 'completed'
GROUP BY 1, 2""",
    "dq_unique_lineitem": """SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dq_not_null_customer_key": _MODELS + "SELECT * FROM fact_orders WHERE customer_key IS NULL",
    "dq_relationships_customer": _MODELS
    + """SELECT customer_id, count(*) AS n_records FROM stg_orders
WHERE customer_id IS NOT NULL
  AND customer_id NOT IN (SELECT customer_id FROM stg_customers WHERE customer_id IS NOT NULL)
GROUP BY customer_id""",
    "dq_relationships_lineitem_part": """SELECT l_partkey, count(*) AS n_records FROM lineitem
WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey IS NOT NULL)
GROUP BY l_partkey""",
    "dq_relationships_orders_lineitem": """SELECT o_orderkey, count(*) AS n_records FROM orders
WHERE o_orderkey IS NOT NULL AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL)
GROUP BY o_orderkey""",
    "dq_accepted_values_orderstatus": """SELECT o_orderstatus, count(*) AS n_records FROM orders
GROUP BY o_orderstatus HAVING o_orderstatus NOT IN ('F', 'O')""",
    "dq_accepted_range_tax": "SELECT l_orderkey, l_linenumber, l_partkey, l_tax FROM lineitem WHERE NOT (l_tax > 0)",
    "dq_total_matches": _with(_MESSAGES, _STG_ORDERS)
    + """SELECT order_id, quantity, unit_price, total_amount FROM stg_orders
WHERE abs(total_amount - quantity * unit_price) > 0.01""",
    "dq_summary": _with(_MESSAGES, _STG_ORDERS, _STG_PRODUCTS, _STG_CUSTOMERS, _DIMS, _calendar("stg_orders", "ordered_at"))
    + "\nUNION ALL\n".join(_check_sql(c) for c in CHECKS),
    "pipeline_roundtrip": _with(
        _MESSAGES, _STG_ORDERS_TOGETHER, _STG_PRODUCTS, _STG_CUSTOMERS, _DIMS, _calendar("stg_orders", "ordered_at")
    )
    + "\nUNION ALL\n".join(_check_sql(c) for c in CHECKS),
    "profile_lake": _with(_MESSAGES)
    + """SELECT count(*) AS total_rows, count(DISTINCT COALESCE(eid, 'none')) AS distinct_event_ids,
       count(*) - count(DISTINCT COALESCE(eid, 'none')) AS duplicate_rows
FROM m WHERE error IS NULL""",
    "profile_lake_by_type": _with(_MESSAGES)
    + "SELECT etype AS event_type, count(eid) AS n_events FROM m WHERE error IS NULL GROUP BY etype",
    "topic_partition_counts": _with(_MESSAGES) + "SELECT partition, count(*) AS n_messages FROM m GROUP BY partition",
    "topic_key_summary": _with(_MESSAGES)
    + """SELECT count(*) FILTER (WHERE key IS NULL) AS messages_without_key,
       count(DISTINCT key) AS distinct_keys FROM m""",
    "topic_key_affinity": _with(_MESSAGES)
    + """SELECT key, CAST(list_sort(list(DISTINCT partition)) AS VARCHAR) AS partitions
FROM m WHERE key IS NOT NULL GROUP BY key HAVING count(DISTINCT partition) > 1""",
    "ingest_roundtrip": _with(_MESSAGES) + _ROUTE,
    "raw_load_roundtrip": _with(_MESSAGES)
    + """SELECT eid AS event_id, etype AS event_type, ts AS event_timestamp,
       partition AS kafka_partition, "offset" AS kafka_offset,
       CASE WHEN scalar IS NULL THEN cid END AS customer_id, CASE WHEN scalar IS NULL THEN pid END AS product_id,
       CASE WHEN scalar IS NULL THEN 'OBJECT' WHEN scalar LIKE '"%' THEN 'STRING' WHEN scalar LIKE '[%' THEN 'ARRAY'
            WHEN scalar = 'null' THEN 'VOID' ELSE 'BIGINT' END AS payload_type,
       true AS has_source_file
FROM m WHERE error IS NULL""",
    "catalog_snapshot": _with(_STG_PRODUCTS) + "SELECT * FROM stg_products",
    "staged_orders_roundtrip": _with(_MESSAGES, _STG_ORDERS)
    + "SELECT * FROM stg_orders",
    "legacy_load_roundtrip": """WITH v1 AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    CASE WHEN event_type IN ('view', 'click') THEN 'page_view' WHEN event_type <> 'purchase' THEN 'inventory_update'
         WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) = 53 THEN 'refund' ELSE 'purchase' END AS v1_type
  FROM events
)
SELECT CASE v1_type WHEN 'page_view' THEN 'page_view_events' WHEN 'purchase' THEN 'purchase_events'
            WHEN 'inventory_update' THEN 'inventory_events' ELSE 'lake only' END AS table_name,
       CAST(event_id AS VARCHAR) AS event_id, v1_type AS event_type, CAST(k AS VARCHAR) AS product_id,
       v1_type <> 'refund' AS has_loaded_at, CAST(NULL AS VARCHAR) AS error
FROM v1 WHERE k NOT IN (59, 67)
UNION ALL
SELECT 'quarantine', CAST(event_id AS VARCHAR), NULL, NULL, false,
       CASE WHEN k = 59 THEN 'message without an event type' ELSE 'invalid JSON' END
FROM v1 WHERE k IN (59, 67)""",
    "lake_files": _with(_MESSAGES)
    + """SELECT count(*) AS total_rows, true AS has_files, true AS sizes_known, CAST(1 AS BIGINT) AS sizes_per_file,
       count(*) AS loaded_rows, true AS last_files_are_last
FROM m WHERE error IS NULL""",
    "publish_frame": """SELECT
  CASE WHEN event_type = 'error' THEN json_extract_string(props, '$.k') ELSE CAST(user_id AS VARCHAR) END AS key,
  '{"event_id":"' || CAST(event_id AS VARCHAR) || '","event_type":"' || event_type
    || '","event_timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') || '","payload":{'
    || CASE WHEN event_type = 'error' THEN '' ELSE '"customer_id":"' || CAST(user_id AS VARCHAR) || '",' END
    || '"product_id":"' || json_extract_string(props, '$.k') || '"}}' AS value
FROM events""",
    "legacy_publish_frame": """SELECT event_type AS key,
  '{"event_id":"' || CAST(event_id AS VARCHAR) || '","event_type":"' || event_type
    || '","product_id":"' || json_extract_string(props, '$.k') || '"}' AS value
FROM events""",
    "date_spine_orders": """SELECT d.date_day, count(o_orderkey) AS n_orders
FROM (SELECT CAST(unnest(generate_series(DATE '1996-01-01', DATE '1998-12-30', INTERVAL 1 DAY)) AS DATE) AS date_day) d
LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d.date_day GROUP BY d.date_day""",
    "catalog_refresh": _with(_STG_PRODUCTS.replace("FROM part\n  UNION ALL", "FROM part WHERE p_partkey % 10 <> 0\n  UNION ALL"))
    + "SELECT * FROM stg_products",
    "ledger_roundtrip": _with(_MESSAGES)
    + """, dense AS (
  SELECT *, CASE WHEN "offset" % 2 = 1 THEN 3 ELSE ("offset" // 2 // 1000) % 3 END AS p,
    CASE WHEN "offset" % 2 = 1 THEN "offset" // 2 ELSE ("offset" // 2 // 3000) * 1000 + ("offset" // 2) % 1000 END AS o
  FROM m WHERE error IS NULL
)
SELECT eid AS event_id, etype AS event_type, CAST(p AS INTEGER) AS kafka_partition, CAST(o AS BIGINT) AS kafka_offset,
       CASE WHEN scalar IS NULL THEN 'OBJECT' WHEN scalar LIKE '"%' THEN 'STRING' WHEN scalar LIKE '[%' THEN 'ARRAY'
            WHEN scalar = 'null' THEN 'VOID' ELSE 'BIGINT' END AS payload_type,
       true AS has_source_file, CASE WHEN (o // 100) % 7 = 3 THEN 'backfill' ELSE 'first' END AS load
FROM dense""",
    "incremental_fact": _MODELS + "SELECT * FROM fact_orders",
    "legacy_buffered": """WITH v1 AS (
  SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    CASE WHEN event_type IN ('view', 'click') THEN 'page_view' WHEN event_type <> 'purchase' THEN 'inventory_update'
         WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) = 53 THEN 'refund' ELSE 'purchase' END AS v1_type
  FROM events
)
SELECT v1_type AS event_type, count(*) AS n_messages, CAST(0 AS BIGINT) AS files_over_limit FROM v1 WHERE k NOT IN (59, 67) GROUP BY v1_type
UNION ALL
SELECT 'quarantine', count(*), 0 FROM v1 WHERE k IN (59, 67)""",
    "order_ids": """WITH hashed AS (
  SELECT *, md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)) AS h FROM lineitem
)
SELECT l_orderkey, l_linenumber,
       substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS line_id,
       CAST(round(CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(1 - CAST(l_discount AS DECIMAL(18,4)) AS DECIMAL(18,4)), 2) AS DECIMAL(18,2)) AS net
FROM hashed""",
    "lake_schema": _with(_MESSAGES)
    + """SELECT column_name, data_type, CASE WHEN column_name = 'event_id' THEN ids ELSE n END AS n_values
FROM (SELECT count(eid) AS ids, count(*) AS n FROM m WHERE error IS NULL),
  (VALUES ('event_id', 'string'), ('event_type', 'string'), ('event_timestamp', 'string'), ('payload', 'string'), ('kafka_partition', 'int'),
    ('kafka_offset', 'bigint'), ('ingested_at', 'string'), ('ingest_date', 'string'), ('ingest_hour', 'string')) AS c(column_name, data_type)""",
    "incremental_profile": _with(_MESSAGES)
    + """SELECT 'all' AS event_type, count(*) AS total_rows, count(DISTINCT COALESCE(eid, 'none')) AS distinct_event_ids,
       count(*) - count(DISTINCT COALESCE(eid, 'none')) AS duplicate_rows
FROM m WHERE error IS NULL
UNION ALL
SELECT etype, count(eid), NULL, NULL FROM m WHERE error IS NULL GROUP BY etype""",
}
