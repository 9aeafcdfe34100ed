"""The checking SQL: each registered query in the dialect of the checking engine.

Statements are put together from named parts; ``WITH`` brings in the inputs and
every table a statement builds on.
"""

from __future__ import annotations

import re

STATUS_FAMILY = """CASE WHEN status LIKE '%deliv%' THEN 'delivered'
                    WHEN status LIKE '%cancel%' THEN 'cancelled'
                    WHEN status LIKE '%process%' THEN 'processing'
                    WHEN status LIKE '%pending%' THEN 'pending'
                    WHEN status LIKE '%ship%' THEN 'shipped'
                    ELSE status END AS status"""

DAILY_ORDERS = """
        SELECT order_date, count(*) AS order_count FROM orders_fact
        GROUP BY order_date ORDER BY order_date DESC LIMIT 10"""

VOLUME = """
        SELECT warehouse, name, count(*) AS volume FROM orders_fact
        GROUP BY name, warehouse ORDER BY warehouse NULLS LAST, count(*) DESC"""

PARTS = {
    "orders_source": """
        SELECT l_orderkey AS order_id, o_custkey AS user_id, CAST(l_partkey AS INTEGER) AS item_id,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
               o_orderdate AS order_ts, o_orderstatus AS status
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "order_lines": """
        SELECT *, unnest(CASE WHEN l_orderkey % 37 = 0 THEN [0, 1] ELSE [0] END) AS copy
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "orders_raw": """
        SELECT l_orderkey AS order_id,
               CASE WHEN l_orderkey % 101 <> 0 THEN o_custkey END AS user_id,
               CAST(CASE WHEN l_orderkey % 97 = 0 THEN -1 - l_partkey ELSE l_partkey END
                    AS INTEGER) AS item_id,
               CASE WHEN l_orderkey % 103 <> 0 THEN CAST(l_quantity AS INTEGER) END AS quantity,
               CASE WHEN l_orderkey % 109 <> 0
                    THEN CAST(CASE WHEN l_orderkey % 113 = 0 THEN 99999999.99
                                   ELSE l_extendedprice END AS DECIMAL(10,2)) END AS price,
               o_orderdate AS order_ts,
               CASE WHEN l_orderkey % 107 = 0 THEN NULL
                    WHEN l_orderkey % 53 = 0 THEN ' Test '
                    WHEN o_orderstatus = 'P' THEN ' Pending '
                    WHEN o_orderstatus = 'O' AND l_orderkey % 2 = 0 THEN 'Processing'
                    WHEN o_orderstatus = 'O' THEN 'SHIPPING'
                    WHEN o_orderstatus = 'F' AND l_orderkey % 3 = 0 THEN 'Canceled by user'
                    WHEN o_orderstatus = 'F' AND l_orderkey % 5 = 0 THEN 'Returned'
                    WHEN copy = 1 AND l_orderkey % 74 = 0 THEN 'Deliv.'
                    ELSE ' Delivered' END AS status
        FROM order_lines""",
    "orders_complete": """
        SELECT * FROM orders_raw
        WHERE order_id IS NOT NULL AND user_id IS NOT NULL AND item_id IS NOT NULL
          AND quantity IS NOT NULL AND price IS NOT NULL AND order_ts IS NOT NULL
          AND status IS NOT NULL""",
    "orders_standard": """
        SELECT * REPLACE (lower(trim(status)) AS status) FROM orders_complete""",
    "orders_distinct": "SELECT DISTINCT * FROM orders_standard",
    "orders_dim": f"""
        SELECT order_id, user_id, item_id, quantity, price, order_ts,
               {STATUS_FAMILY},
               CAST(round(quantity * price, 2) AS DECIMAL(22,2)) AS total_order_value,
               CAST(order_ts AS DATE) AS order_date
        FROM orders_distinct WHERE status <> 'test'""",
    "inventory_named": """
        SELECT *, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name)
                       ELSE ' ' || p_name || ' ' END AS base_name FROM part""",
    "inventory_listed": """
        SELECT *, unnest([base_name]
                         || CASE WHEN p_partkey % 31 = 0 THEN [upper(base_name)] ELSE [] END
                         || CASE WHEN p_partkey % 89 = 0
                                 THEN [trim(base_name) || ' XL'] ELSE [] END) AS listed_name
        FROM inventory_named""",
    "inventory_raw": """
        SELECT CAST(p_partkey AS VARCHAR) AS item_id, listed_name AS name,
               CASE WHEN p_partkey % 67 <> 0 THEN p_type END AS category,
               CASE WHEN p_partkey % 71 <> 0 THEN p_brand END AS Warehouse,
               CASE WHEN p_partkey % 43 = 0 THEN NULL
                    WHEN p_partkey % 41 = 0 THEN 'n/a'
                    WHEN p_partkey % 23 = 0 THEN '0'
                    ELSE CAST(p_size - 3 AS VARCHAR) END AS stock_level,
               '2025-07-01 08:00:00' AS last_update
        FROM inventory_listed""",
    "inventory_complete": """
        SELECT * FROM inventory_raw
        WHERE item_id IS NOT NULL AND name IS NOT NULL AND category IS NOT NULL
          AND Warehouse IS NOT NULL AND stock_level IS NOT NULL AND last_update IS NOT NULL""",
    "inventory_typed": """
        SELECT TRY_CAST(item_id AS INTEGER) AS item_id, name, category, Warehouse,
               TRY_CAST(stock_level AS INTEGER) AS stock_level,
               TRY_CAST(last_update AS TIMESTAMP) AS last_update
        FROM inventory_complete""",
    "inventory_standard": """
        SELECT item_id, lower(trim(name)) AS name, lower(trim(category)) AS category,
               lower(trim(Warehouse)) AS warehouse, stock_level, last_update
        FROM inventory_typed""",
    "inventory_distinct": "SELECT DISTINCT * FROM inventory_standard",
    "inventory_dim": """
        SELECT *, CASE WHEN stock_level = 0 THEN 'Out of stock'
                       WHEN stock_level < 20 THEN 'Low stock'
                       ELSE 'In stock' END AS stock_flag
        FROM inventory_distinct""",
    "orders_fact": """
        SELECT o.order_id, o.item_id, i.name, i.warehouse, o.total_order_value,
               o.order_date, i.stock_flag
        FROM orders_dim o LEFT JOIN inventory_dim i ON o.item_id = i.item_id""",
    "gps_raw": """
        SELECT 'C' || lpad(CAST(user_id AS VARCHAR),
                           CAST(greatest(3, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0')
                   AS courier_id,
               CASE WHEN event_id % 61 = 0 THEN 'bad'
                    WHEN event_id % 59 = 0 THEN NULL
                    ELSE CAST(event_id % 180 - 90 AS VARCHAR) END AS lat,
               CAST(event_id % 360 - 180 AS VARCHAR) AS lon,
               CAST((1704067200 + event_id * 259)
                    * CASE WHEN event_id % 173 = 0 THEN 1000 ELSE 1 END AS VARCHAR) AS ts
        FROM events""",
    "status_raw": """
        SELECT CASE WHEN event_id % 67 = 0 THEN 'x'
                    ELSE CAST(event_id % 1000 AS VARCHAR) END AS order_id,
               'C' || lpad(CAST(user_id AS VARCHAR),
                           CAST(greatest(3, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0')
                   AS courier_id,
               upper(event_type) AS status,
               CAST(1704067200 + event_id * 259 AS VARCHAR) AS ts
        FROM events""",
    "gps_dim": """
        SELECT lower(courier_id) AS courier_id, TRY_CAST(lat AS DOUBLE) AS lat,
               TRY_CAST(lon AS DOUBLE) AS lon,
               CASE WHEN CAST(ts AS BIGINT) < 253402300800
                    THEN make_timestamp(CAST(ts AS BIGINT) * 1000000) END AS gps_ts
        FROM gps_raw
        WHERE TRY_CAST(lat AS DOUBLE) IS NOT NULL AND TRY_CAST(lon AS DOUBLE) IS NOT NULL""",
    "status_dim": """
        SELECT TRY_CAST(order_id AS INTEGER) AS order_id, lower(courier_id) AS courier_id,
               lower(status) AS status,
               make_timestamp(CAST(ts AS BIGINT) * 1000000) AS status_ts
        FROM status_raw""",
    "courier_tracking": """
        SELECT g.courier_id, s.order_id, g.lat, g.lon, g.gps_ts, s.status, s.status_ts
        FROM gps_dim g JOIN status_dim s ON g.courier_id = s.courier_id""",
    "tracking_within": """
        SELECT g.courier_id, s.order_id, g.lat, g.lon, g.gps_ts, s.status, s.status_ts
        FROM gps_dim g JOIN status_dim s ON g.courier_id = s.courier_id
         AND g.gps_ts BETWEEN s.status_ts - INTERVAL 43200 SECOND
                          AND s.status_ts + INTERVAL 43200 SECOND""",
}



def _odd(column: str, key: str) -> str:
    """The text with blanks, quotes, separators, line breaks, or empty."""
    number = f"CAST({key} AS BIGINT) % 7"
    return f"""CASE WHEN {number} = 0 THEN '  ' || {column} || ' '
                    WHEN {number} = 1 THEN 'the "' || {column} || '" one'
                    WHEN {number} = 2 THEN ''
                    WHEN {number} = 3 THEN {column} || ',' || chr(10) || {column}
                    WHEN {number} = 4
                    THEN {column} || chr(10) || '9,9,9,9,9.00,2025-01-01T00:00:00Z,x'
                    ELSE {column} END AS {column}"""


STATEMENTS = {
    # Missing values
    "orders_null_rows": """
        SELECT * FROM orders_raw
        WHERE order_id IS NULL OR user_id IS NULL OR item_id IS NULL OR quantity IS NULL
           OR price IS NULL OR order_ts IS NULL OR status IS NULL""",
    "inventory_null_rows": """
        SELECT * FROM inventory_raw
        WHERE item_id IS NULL OR name IS NULL OR category IS NULL OR Warehouse IS NULL
           OR stock_level IS NULL OR last_update IS NULL""",
    "orders_dropna": "SELECT * FROM orders_complete",
    "inventory_dropna": "SELECT * FROM inventory_complete",
    "orders_fillna": """
        SELECT * REPLACE (coalesce(quantity, 0) AS quantity,
                          CAST(coalesce(price, 0) AS DECIMAL(10,2)) AS price,
                          coalesce(status, 'unknown') AS status) FROM orders_raw""",
    "inventory_fillna": """
        SELECT * REPLACE (coalesce(category, 'unknown') AS category,
                          coalesce(Warehouse, 'unknown') AS Warehouse,
                          coalesce(stock_level, '0') AS stock_level) FROM inventory_raw""",
    # Columns
    "inventory_select": "SELECT * FROM inventory_raw",
    "inventory_cast": "SELECT * FROM inventory_typed",
    "orders_standardize": "SELECT * FROM orders_standard",
    "inventory_standardize": "SELECT * FROM inventory_standard",
    "snake_case_columns": """
        SELECT order_id, order_ts AS orderts, status AS order_status FROM orders_raw""",
    "orders_total_value": """
        SELECT order_id, quantity, price,
               CAST(round(quantity * price, 2) AS DECIMAL(22,2)) AS total_order_value
        FROM orders_complete""",
    "orders_status_norm": f"""
        SELECT order_id, status AS raw_status,
               {STATUS_FAMILY}
        FROM orders_standard""",
    "orders_order_date": """
        SELECT order_id, order_ts, CAST(order_ts AS DATE) AS order_date FROM orders_raw""",
    "inventory_stock_flag": """
        SELECT item_id, stock_level,
               CASE WHEN stock_level = 0 THEN 'Out of stock'
                    WHEN stock_level < 20 THEN 'Low stock'
                    ELSE 'In stock' END AS stock_flag
        FROM inventory_typed""",
    # Rows
    "orders_dedup": "SELECT * FROM orders_distinct",
    "inventory_dedup": "SELECT * FROM inventory_distinct",
    "orders_drop_test": "SELECT * FROM orders_standard WHERE status <> 'test'",
    # Dimensions and facts
    "orders_dim": "SELECT * FROM orders_dim",
    "orders_dim_filled": f"""
        SELECT order_id, user_id, item_id, quantity, price, order_ts,
               {STATUS_FAMILY},
               CAST(round(quantity * price, 2) AS DECIMAL(22,2)) AS total_order_value,
               CAST(order_ts AS DATE) AS order_date
        FROM (SELECT DISTINCT order_id, user_id, item_id, coalesce(quantity, 0) AS quantity,
                     CAST(coalesce(price, 0) AS DECIMAL(10,2)) AS price, order_ts,
                     lower(trim(coalesce(status, 'unknown'))) AS status
              FROM orders_raw WHERE user_id IS NOT NULL)
        WHERE status <> 'test'""",
    "inventory_dim": "SELECT * FROM inventory_dim",
    "gps_clean": "SELECT * FROM gps_dim",
    "status_clean": "SELECT * FROM status_dim",
    "orders_fact": "SELECT * FROM orders_fact",
    "courier_tracking": "SELECT * FROM courier_tracking",
    "courier_tracking_within": "SELECT * FROM tracking_within",
    # Figures
    "fact_count": "SELECT count(*) AS row_count FROM orders_fact",
    "daily_orders_top10": DAILY_ORDERS,
    "avg_cart_value": """
        SELECT round(CAST(sum(total_order_value) AS DOUBLE) / count(total_order_value), 4)
                   AS avg_cart_value FROM orders_fact""",
    "volume_by_warehouse_item": VOLUME,
    "stock_alerts": """
        SELECT * FROM inventory_dim WHERE stock_flag IN ('Out of stock', 'Low stock')""",
    "stock_alert_counts": """
        SELECT count(*) FILTER (stock_flag <> 'In stock') AS alerts,
               count(*) FILTER (stock_flag = 'Out of stock') AS out_of_stock,
               count(*) FILTER (stock_flag = 'Low stock') AS low_stock
        FROM inventory_dim""",
    "quality_counts": """
        SELECT 'orders_dim' AS table_name, 'total_order_value' AS column_name,
               count(*) AS row_count, count(*) - count(total_order_value) AS unusable_rows
        FROM orders_dim
        UNION ALL SELECT 'inventory_dim', 'item_id', count(*), count(*) - count(item_id)
                  FROM inventory_dim
        UNION ALL SELECT 'inventory_dim', 'stock_level', count(*),
                         count(*) - count(stock_level) FROM inventory_dim
        UNION ALL SELECT 'inventory_dim', 'last_update', count(*),
                         count(*) - count(last_update) FROM inventory_dim
        UNION ALL SELECT 'gps_dim', 'gps_ts', count(*), count(*) - count(gps_ts) FROM gps_dim
        UNION ALL SELECT 'status_dim', 'order_id', count(*), count(*) - count(order_id)
                  FROM status_dim
        UNION ALL SELECT 'status_dim', 'status_ts', count(*), count(*) - count(status_ts)
                  FROM status_dim""",
    "source_row_counts": """
        SELECT 'orders' AS table_name, count(*) AS row_count FROM orders_raw
        UNION ALL SELECT 'inventory', count(*) FROM inventory_raw""",
    # Inspection
    "describe_orders": """
        SELECT 1 AS position, 'order_id' AS column_name, 'bigint' AS data_type,
               false AS is_nested, count(*) - count(order_id) AS null_rows FROM orders_raw
        UNION ALL SELECT 2, 'user_id', 'bigint', false, count(*) - count(user_id) FROM orders_raw
        UNION ALL SELECT 3, 'item_id', 'int', false, count(*) - count(item_id) FROM orders_raw
        UNION ALL SELECT 4, 'quantity', 'int', false, count(*) - count(quantity) FROM orders_raw
        UNION ALL SELECT 5, 'price', 'decimal(10,2)', false, count(*) - count(price)
                  FROM orders_raw
        UNION ALL SELECT 6, 'order_ts', 'timestamp_ntz', false, count(*) - count(order_ts)
                  FROM orders_raw
        UNION ALL SELECT 7, 'status', 'string', false, count(*) - count(status)
                  FROM orders_raw""",
    "orders_sample_check": """
        SELECT 'sample' AS table_name, least(10, count(*)) AS row_count FROM orders_raw
        UNION ALL SELECT 'no_orders', 0""",
    "describe_table": """
        SELECT 'order_id' AS col_name, 'bigint' AS data_type,
               count(*) - count(order_id) AS null_rows FROM orders_dim
        UNION ALL SELECT 'user_id', 'bigint', count(*) - count(user_id) FROM orders_dim
        UNION ALL SELECT 'item_id', 'int', count(*) - count(item_id) FROM orders_dim
        UNION ALL SELECT 'quantity', 'int', count(*) - count(quantity) FROM orders_dim
        UNION ALL SELECT 'price', 'decimal(10,2)', count(*) - count(price) FROM orders_dim
        UNION ALL SELECT 'order_ts', 'timestamp_ntz', count(*) - count(order_ts) FROM orders_dim
        UNION ALL SELECT 'status', 'string', count(*) - count(status) FROM orders_dim
        UNION ALL SELECT 'total_order_value', 'decimal(22,2)',
                         count(*) - count(total_order_value) FROM orders_dim
        UNION ALL SELECT 'order_date', 'date', count(*) - count(order_date) FROM orders_dim""",
    "schema_is_flat": """
        SELECT 'item_id' AS column_name, false AS is_nested,
               count(*) - count(item_id) AS null_rows FROM inventory_raw
        UNION ALL SELECT 'name', false, count(*) - count(name) FROM inventory_raw
        UNION ALL SELECT 'category', false, count(*) - count(category) FROM inventory_raw
        UNION ALL SELECT 'Warehouse', false, count(*) - count(Warehouse) FROM inventory_raw
        UNION ALL SELECT 'stock_level', false, count(*) - count(stock_level) FROM inventory_raw
        UNION ALL SELECT 'last_update', false, count(*) - count(last_update)
                  FROM inventory_raw""",
    # Loading and round trips
    "csv_orders_ingest": f"""
        SELECT * REPLACE ({_odd("status", "order_id")}) FROM orders_source""",
    "orders_accepted": """
        SELECT * FROM orders_source
        WHERE order_id % 41 <> 0 AND order_id % 43 <> 0 AND order_id % 47 <> 0""",
    "orders_quarantine": """
        SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS user_id,
               CAST(item_id AS VARCHAR) AS item_id,
               CASE WHEN order_id % 41 = 0 THEN 'many'
                    ELSE CAST(quantity AS VARCHAR) END AS quantity,
               CASE WHEN order_id % 43 = 0 THEN 'n/a' ELSE CAST(price AS VARCHAR) END AS price,
               CASE WHEN order_id % 47 = 0 THEN 'yesterday'
                    ELSE strftime(order_ts, '%Y-%m-%dT%H:%M:%SZ') END AS order_ts,
               status,
               concat_ws(',', CASE WHEN order_id % 41 = 0 THEN 'quantity' END,
                              CASE WHEN order_id % 43 = 0 THEN 'price' END,
                              CASE WHEN order_id % 47 = 0 THEN 'order_ts' END) AS bad_fields
        FROM orders_source
        WHERE order_id % 41 = 0 OR order_id % 43 = 0 OR order_id % 47 = 0""",
    "orders_load_new_keys": """
        SELECT * FROM orders_source
        WHERE order_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "orders_load_conflicts": """
        SELECT order_id, count(*) AS incoming_rows,
               CASE WHEN order_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
                    THEN 'loaded before' ELSE 'repeated' END AS reason
        FROM orders_source GROUP BY order_id
        HAVING count(*) > 1
            OR order_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "orders_table_roundtrip": "SELECT * FROM orders_source",
    "json_inventory_ingest": "SELECT * FROM inventory_raw",
    "json_inventory_whole": "SELECT * FROM inventory_raw",
    "json_inventory_array": "SELECT * FROM inventory_raw",
    "csv_events_roundtrip": f"""
        SELECT 'gps' AS feed, {_odd("courier_id", "ts")}, lat, lon, ts, NULL AS order_id,
               NULL AS status
        FROM gps_raw
        UNION ALL SELECT 'status', courier_id, NULL, NULL, ts, order_id, {_odd("status", "ts")}
                  FROM status_raw""",
    "csv_event_dimensions": """
        SELECT courier_id, lat, lon, gps_ts, NULL AS order_id, NULL AS status,
               CAST(NULL AS TIMESTAMP) AS status_ts FROM gps_dim
        UNION ALL SELECT courier_id, NULL, NULL, NULL, order_id, status, status_ts
                  FROM status_dim""",
    "orders_load_job": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id,
               CAST(o_orderkey AS INTEGER) AS item_id, 1 AS quantity,
               CAST(2.50 AS DECIMAL(10,2)) AS price, o_orderdate AS order_ts, 'new' AS status
        FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
    "events_to_json": """
        SELECT '{"courier_id":"' || courier_id || '",'
               || CASE WHEN lat IS NULL THEN '' ELSE '"lat":"' || lat || '",' END
               || '"lon":"' || lon || '","ts":"' || ts || '"}' AS value
        FROM gps_raw""",
    "sink_overwrite_idempotent": """
        SELECT order_id, user_id, item_id, quantity, price, order_ts, status, total_order_value,
               order_date, NULL AS name, NULL AS category, NULL AS warehouse,
               NULL AS stock_level, CAST(NULL AS TIMESTAMP) AS last_update, NULL AS stock_flag
        FROM orders_dim
        UNION ALL SELECT NULL, NULL, item_id, NULL, NULL, NULL, NULL, NULL, NULL, name, category,
                         warehouse, stock_level, last_update, stock_flag FROM inventory_dim""",
    "sink_partitioned_by_warehouse": """
        SELECT * REPLACE (CASE WHEN item_id % 5 = 0 THEN '' WHEN item_id % 5 = 1 THEN '007'
                               ELSE warehouse END AS warehouse) FROM orders_fact""",
    "sink_run_append": """
        SELECT *, '001' AS run_id FROM orders_fact
        UNION ALL SELECT *, '002' FROM orders_fact""",
    "stored_tracking_within": "SELECT * FROM tracking_within",
    "fact_append_twice": """
        SELECT 2 * count(*) AS row_count,
               round(CAST(sum(total_order_value) AS DOUBLE) / count(total_order_value), 4)
                   AS avg_cart_value
        FROM orders_fact""",
    "fact_replace_days": "SELECT * FROM orders_fact",
    "table_statistics": """
        SELECT 'orders_dim' AS table_name, 'item_id' AS column_name,
               CAST(min(item_id) AS VARCHAR) AS least, CAST(max(item_id) AS VARCHAR) AS greatest,
               count(*) - count(item_id) AS null_rows
        FROM orders_dim
        UNION ALL
        SELECT 'orders_dim', 'order_date', CAST(min(order_date) AS VARCHAR),
               CAST(max(order_date) AS VARCHAR), count(*) - count(order_date)
        FROM orders_dim
        UNION ALL
        SELECT 'inventory_dim', 'item_id', CAST(min(item_id) AS VARCHAR),
               CAST(max(item_id) AS VARCHAR), count(*) - count(item_id)
        FROM inventory_dim
        UNION ALL
        SELECT 'inventory_dim', 'warehouse', NULL, NULL, count(*) - count(warehouse)
        FROM inventory_dim""",
    "totals_summary": """
        SELECT count(*) AS row_count,
               round(CAST(sum(total_order_value) AS DOUBLE) / count(total_order_value), 4)
                   AS avg_cart_value
        FROM orders_fact""",
    "totals_daily_orders": DAILY_ORDERS,
    "load_counts": """
        SELECT 'orders_dim' AS table_name, unnest(['rows_read', 'incomplete_read', 'rows_written',
                 'no_value_written']) AS counted,
               unnest([(SELECT count(*) FROM orders_raw),
                       (SELECT count(*) FROM orders_raw) - (SELECT count(*) FROM orders_complete),
                       (SELECT count(*) FROM orders_dim),
                       (SELECT count(*) FROM orders_dim WHERE total_order_value IS NULL)]) AS n
        UNION ALL
        SELECT 'inventory_dim', unnest(['rows_read', 'incomplete_read', 'rows_written',
                 'alerts_written', 'out_of_stock_written', 'low_stock_written']),
               unnest([(SELECT count(*) FROM inventory_raw),
                       (SELECT count(*) FROM inventory_raw)
                         - (SELECT count(*) FROM inventory_complete),
                       (SELECT count(*) FROM inventory_dim),
                       (SELECT count(*) FROM inventory_dim
                        WHERE stock_flag IN ('Out of stock', 'Low stock')),
                       (SELECT count(*) FROM inventory_dim WHERE stock_flag = 'Out of stock'),
                       (SELECT count(*) FROM inventory_dim WHERE stock_flag = 'Low stock')])""",
    "daily_orders_by_day": DAILY_ORDERS,
    "sql_orders_fact": "SELECT * FROM orders_fact",
    "sql_daily_orders": DAILY_ORDERS,
    "stored_volume_by_warehouse_item": VOLUME,
    "show_tables": """
        SELECT 'courier_tracking' AS table_name, count(*) AS row_count FROM courier_tracking
        UNION ALL SELECT 'gps_dim', count(*) FROM gps_dim
        UNION ALL SELECT 'inventory_dim', count(*) FROM inventory_dim
        UNION ALL SELECT 'order_totals', count(*)
        FROM (SELECT order_date FROM orders_fact GROUP BY order_date)
        UNION ALL SELECT 'orders', count(*) FROM orders_source
        UNION ALL SELECT 'orders_dim', count(*) FROM orders_dim
        UNION ALL SELECT 'orders_fact', count(*) FROM orders_fact
        UNION ALL SELECT 'status_dim', count(*) FROM status_dim""",
    # Streams
    "stream_gps_clean": "SELECT * FROM gps_dim",
    "stream_status_clean": "SELECT * FROM status_dim",
    "stream_status_from_csv": "SELECT * FROM status_dim",
    "stream_courier_tracking": "SELECT * FROM tracking_within",
    "stream_status_counts": """
        SELECT status, count(*) AS event_count FROM status_dim GROUP BY status""",
    "stream_dedup_watermark": "SELECT DISTINCT * FROM status_dim",
}


def _needed(body: str) -> list[str]:
    """Names of the parts a text builds on, inputs before what uses them."""
    names: list[str] = []
    for word in re.findall(r"[a-z_]+", body):
        if word in PARTS and word not in names:
            names += [name for name in _needed(PARTS[word]) if name not in names]
            names.append(word)
    return names


def oracle_statements() -> dict[str, str]:
    """Complete statements, each over the test tables alone."""
    statements = {}
    for name, body in STATEMENTS.items():
        parts = ",\n".join(f"{part} AS ({PARTS[part]}\n)" for part in _needed(body))
        statements[name] = f"WITH {parts}\n{body}" if parts else body
    return statements
