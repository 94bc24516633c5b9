"""SQL counterparts of the registered queries, for an independent engine over the same tables."""

from __future__ import annotations

K = "CAST(json_extract_string(props, '$.k') AS INT)"

# The input shapes F-1 .. F-7 as common table expressions.
SHAPES = {
    "users": """
        SELECT c_custkey AS id, split_part(c_name, '#', 1) AS first_name,
          CASE WHEN c_custkey % 19 = 3 THEN NULL ELSE split_part(c_name, '#', 2) END AS last_name,
          CASE WHEN c_custkey % 10 = 7 THEN NULL
               WHEN c_custkey % 13 = 5 THEN concat('bad-address-', c_custkey)
               ELSE concat('user', c_custkey, '@example.com') END AS email,
          TIMESTAMP '2024-01-01 00:00:00' + c_custkey * INTERVAL '1' MINUTE AS created_at,
          TIMESTAMP '2024-01-01 00:00:00' + c_custkey * INTERVAL '1' MINUTE AS updated_at
        FROM customer""",
    "silver_users": r"""
        SELECT *, regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$')
            AS valid_email,
          concat_ws(' ', first_name, last_name) AS full_name
        FROM users""",
    "items": """
        SELECT p_partkey AS id, p_name AS name, lower(p_type) AS category,
          CAST(CASE WHEN p_partkey % 17 = 0 THEN -1.0 WHEN p_partkey % 23 = 4 THEN NULL
               ELSE p_retailprice END AS DECIMAL(7,2)) AS price,
          p_size * 100 AS inventory,
          TIMESTAMP '2024-01-01 00:00:00' + p_partkey * INTERVAL '1' MINUTE AS created_at,
          TIMESTAMP '2024-01-01 00:00:00' + p_partkey * INTERVAL '1' MINUTE AS updated_at
        FROM part""",
    "silver_items": """
        SELECT id, name, upper(category) AS category,
          CASE WHEN price < 0 THEN 0 ELSE price END AS price, inventory, created_at, updated_at
        FROM items""",
    "purchases": """
        SELECT ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS id,
          o_custkey AS user_id, l_partkey AS item_id, CAST(l_quantity AS INT) AS quantity,
          CAST(l_extendedprice AS DECIMAL(12,2)) AS purchase_price,
          o_orderdate AS created_at, o_orderdate AS updated_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "purchase_events": f"""
        SELECT event_id AS id, user_id, CAST({K} % 20 AS BIGINT) AS item_id,
          CAST(1 + event_id % 5 AS INT) AS quantity,
          CAST(value AS DECIMAL(12,2)) AS purchase_price, ts AS created_at, ts AS updated_at
        FROM events WHERE event_type = 'purchase'""",
    "enriched": """
        SELECT p.id, p.user_id, p.item_id, p.quantity, p.purchase_price,
          p.quantity * p.purchase_price AS total_price, u.email AS user_email,
          i.name AS item_name, i.category AS item_category,
          CAST(p.created_at AS DATE) AS purchase_date, hour(p.created_at) AS purchase_hour,
          p.created_at, p.updated_at
        FROM purchases p LEFT JOIN users u ON p.user_id = u.id
          LEFT JOIN items i ON p.item_id = i.id""",
    "enriched_events": """
        SELECT p.id, p.user_id, p.item_id, p.quantity * p.purchase_price AS total_price,
          i.name AS item_name, i.category AS item_category,
          CAST(p.created_at AS DATE) AS purchase_date, hour(p.created_at) AS purchase_hour
        FROM purchase_events p LEFT JOIN users u ON p.user_id = u.id
          LEFT JOIN items i ON p.item_id = i.id""",
    "pageviews": f"""
        SELECT user_id,
          CASE event_id % 11 WHEN 0 THEN '/home'
            WHEN 1 THEN concat('http://example.com/products/', {K} % 20)
            ELSE concat('/products/', {K} % 20) END AS url,
          CASE event_id % 5 WHEN 0 THEN 'organic search' WHEN 1 THEN 'paid search'
            WHEN 2 THEN 'referral' WHEN 3 THEN 'social' ELSE 'display' END AS channel,
          date_trunc('second', ts) AS received_at
        FROM events WHERE event_type IN ('view', 'click')""",
    "item_views": r"""
        SELECT v.user_id, v.item_id, v.page, i.name AS item_name, i.category AS item_category,
          v.channel, v.received_at
        FROM (SELECT *, regexp_extract(url, '^/([^/]+)/\d+$', 1) AS page,
                TRY_CAST(regexp_extract(url, '/(\d+)$', 1) AS BIGINT) AS item_id
              FROM pageviews) v
          LEFT JOIN items i ON v.item_id = i.id
        WHERE v.item_id IS NOT NULL""",
    "segment_views": """
        SELECT user_id, 'products' AS page, ts AS received_at FROM events
        WHERE event_id % 10 <= user_id % 10
          AND (user_id % 4 <> 0 OR ts < TIMESTAMP '2024-01-20 00:00:00')""",
    "segments": """
        SELECT u.id AS user_id, u.email, u.full_name, count(v.page) AS total_pageviews,
          count(DISTINCT CAST(v.received_at AS DATE)) AS active_days,
          max(CAST(v.received_at AS DATE)) AS last_day,
          date_diff('day', max(CAST(v.received_at AS DATE)), DATE '2024-01-31') AS idle
        FROM silver_users u LEFT JOIN segment_views v ON u.id = v.user_id
        WHERE u.valid_email GROUP BY u.id, u.email, u.full_name""",
    "labelled": """
        SELECT user_id, email, full_name, total_pageviews, active_days,
          CAST(last_day AS VARCHAR) AS last_active_date, idle AS days_since_last_active,
          CASE WHEN total_pageviews >= 50 AND idle <= 3 THEN 'high_engagement'
               WHEN total_pageviews BETWEEN 10 AND 49 AND idle <= 7 THEN 'medium_engagement'
               ELSE 'low_engagement' END AS engagement_segment
        FROM segments""",
    "changes": f"""
        SELECT event_id AS id, CASE WHEN event_id % 20 = 5 THEN NULL ELSE user_id END AS user_id,
          CAST({K} % 20 AS BIGINT) AS item_id,
          CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'FLASH2025' END AS campaign_id,
          CASE WHEN event_id % 6 = 1 THEN NULL ELSE 1 END AS status,
          CAST(1 + event_id % 5 AS INT) AS quantity, value AS purchase_price, false AS deleted,
          ts AS created_at, ts AS updated_at,
          CASE WHEN event_id % 50 = 7 THEN 'decode error' ELSE '' END AS _error,
          CASE WHEN event_id % 50 = 7 THEN concat('message ', event_id) ELSE '' END
            AS _raw_message
        FROM events WHERE event_type = 'purchase'
        UNION ALL
        SELECT event_id, CASE WHEN event_id % 20 = 5 THEN NULL ELSE user_id END,
          CAST({K} % 20 AS BIGINT), 'BOGO23', 2, CAST(2 + event_id % 5 AS INT), value,
          event_id % 9 = 0, ts, ts + INTERVAL '1' HOUR, '', ''
        FROM events WHERE event_type = 'purchase' AND event_id % 3 = 0""",
    "latest": """
        SELECT * FROM (
          SELECT id, coalesce(user_id, 0) AS user_id, coalesce(item_id, 0) AS item_id,
            coalesce(campaign_id, '') AS campaign_id, coalesce(status, 1) AS status,
            coalesce(quantity, 0) AS quantity,
            CAST(coalesce(purchase_price, 0) AS DECIMAL(12,2)) AS purchase_price,
            coalesce(deleted, false) AS deleted,
            date_trunc('millisecond', created_at) AS created_at,
            date_trunc('millisecond', updated_at) AS updated_at,
            row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) AS place
          FROM changes WHERE _error = '')
        WHERE place = 1""",
    "item_rows": """
        SELECT p_partkey AS id, p_name AS name, lower(p_type) AS category,
          CAST(p_retailprice AS DECIMAL(10,2)) AS price, p_size * 100 AS inventory,
          'r' AS __op, 'items' AS __table, 1000 AS __source_ts_ms, false AS __deleted FROM part
        UNION ALL
        SELECT p_partkey, concat(p_name, ' v2'), lower(p_type),
          CAST(p_retailprice AS DECIMAL(10,2)), p_size * 100, 'u', 'items', 2000, false
        FROM part WHERE p_partkey % 5 = 0
        UNION ALL
        SELECT p_partkey, p_name, lower(p_type),
          CAST(p_retailprice AS DECIMAL(10,2)), p_size * 100, 'd', 'items', 3000, true
        FROM part WHERE p_partkey % 10 = 0""",
    "documents_latest": """
        SELECT * FROM (SELECT *, row_number() OVER (
            PARTITION BY id ORDER BY __source_ts_ms DESC) AS place FROM item_rows)
        WHERE place = 1""",
    "geo": """
        SELECT * FROM (VALUES ('192.168.1', 'UK', 'London'), ('203.0.113', 'US', 'New York'),
          ('10.0.0', 'DE', 'Berlin')) AS g(ip_prefix, country, city)""",
    "logins": f"""
        SELECT event_id, concat('user_', user_id) AS user_id,
          date_trunc('millisecond', ts) AS timestamp,
          concat(CASE {K} % 5 WHEN 0 THEN '192.168.1.' WHEN 1 THEN '203.0.113.'
            WHEN 2 THEN '10.0.0.' WHEN 3 THEN '198.51.100.' ELSE '8.8.8.' END, event_id % 200)
            AS ip,
          CASE event_id % 4 WHEN 0 THEN 'iPhone 15' WHEN 1 THEN 'Samsung Galaxy'
            WHEN 2 THEN 'MacBook Pro' ELSE 'Windows Laptop' END AS device,
          CASE event_id % 3 WHEN 0 THEN 'ios' WHEN 1 THEN 'android' ELSE 'web' END AS platform
        FROM events""",
    "logins_geo": """
        SELECT event_id, user_id, timestamp, ip, platform,
          CASE WHEN lower(device) LIKE '%iphone%' OR lower(device) LIKE '%android%'
            THEN 'mobile' ELSE 'desktop' END AS device_type, country, city
        FROM logins LEFT JOIN geo ON ip LIKE concat(ip_prefix, '%')""",
    "texts": """
        SELECT doc_id AS review_id, text FROM documents
        UNION ALL SELECT -1, 'the support team answered quickly and solved my problem'""",
    "grams": """
        SELECT review_id, unnest(list_concat(regexp_extract_all(h, '.{6}'),
            regexp_extract_all(substr(h, 3), '.{6}'), regexp_extract_all(substr(h, 5), '.{6}')))
            AS gram
        FROM (SELECT review_id, hex(encode(concat(' ', lower(text), ' '))) AS h FROM texts)""",
    "slots": """
        SELECT review_id, (mixed // 2) % 384 AS slot,
          sum(CASE WHEN mixed % 2 = 1 THEN 1 ELSE -1 END) AS weight
        FROM (SELECT review_id, CAST((CAST(concat('0x', gram) AS HUGEINT)
                * CAST('11400714819323198485' AS HUGEINT)
                % CAST('18446744073709551616' AS HUGEINT)) // 4294967296 AS BIGINT) AS mixed
              FROM grams)
        GROUP BY 1, 2""",
    "text_values": """
        SELECT review_id, place, CAST(coalesce(weight / nullif(norm, 0), 0) AS FLOAT) AS x
        FROM (SELECT t.review_id, t.place, s.weight,
                sqrt(sum(s.weight * s.weight) OVER (PARTITION BY t.review_id)) AS norm
              FROM (SELECT review_id, unnest(range(384)) AS place FROM texts) t
                LEFT JOIN slots s ON s.review_id = t.review_id AND s.slot = t.place)""",
    "text_vectors": """
        SELECT review_id, list(x ORDER BY place) AS vector FROM text_values GROUP BY review_id""",
    "user_versions": """
        SELECT * FROM users
        UNION ALL
        SELECT id, first_name, last_name, concat('new', id, '@example.com'), created_at,
          updated_at + INTERVAL '1' DAY FROM users WHERE id % 3 = 0""",
}

def _needs(sql: str, known: set[str]) -> list[str]:
    """Shapes a statement refers to, in declaration order, with what they need themselves."""
    words = set(sql.replace("(", " ").replace(")", " ").replace(",", " ").split())
    found: list[str] = []
    for name in SHAPES:
        if name in words and name not in known:
            found += _needs(SHAPES[name], known | {name})
            found.append(name)
    return found


def _with_shapes(sql: str) -> str:
    names = list(dict.fromkeys(_needs(sql, set())))
    clauses = ",\n".join(f"{n} AS ({SHAPES[n]})" for n in names)
    return f"WITH {clauses}\n{sql.strip()}" if names else sql.strip()


_ANOMALY = """
    SELECT e.user_id, e.timestamp, 'Login from new country' AS reason, e.country
    FROM logins_geo e WHERE NOT EXISTS (
      SELECT 1 FROM logins_geo r WHERE r.user_id = e.user_id AND r.country = e.country
        AND r.timestamp BETWEEN e.timestamp - INTERVAL '7' DAY AND e.timestamp - INTERVAL '1' SECOND)
"""
_LATEST = """
    SELECT id, user_id, item_id, campaign_id, status, quantity,
      CAST(purchase_price AS DOUBLE) AS purchase_price, deleted, created_at, updated_at
    FROM latest
"""
_DOCUMENTS = """
    SELECT id, name, category, CAST(price AS DOUBLE) AS price, inventory, __op, __table,
      __source_ts_ms, __deleted FROM documents_latest
"""
_ERRORS = "SELECT _error, _raw_message FROM changes WHERE _error <> ''"
_CONVERTING = """
    SELECT v.item_id, v.item_name, v.item_category, {viewers} AS unique_pageview_users,
      {buyers} AS unique_purchase_users, count(p.id) AS total_purchases,
      count(v.user_id) AS total_pageviews,
      CASE WHEN count(v.user_id) = 0 THEN 0.0
        ELSE CAST(count(p.id) AS DOUBLE) / count(v.user_id) END AS conversion_rate
    FROM item_views v LEFT JOIN enriched_events p ON v.item_id = p.item_id
      AND v.user_id = p.user_id AND CAST(v.received_at AS DATE) = p.purchase_date
    GROUP BY v.item_id, v.item_name, v.item_category
"""
_SELLING = """
    SELECT item_id, item_name, item_category, CAST(sum(total_price) AS DOUBLE) AS total_revenue
    FROM enriched GROUP BY item_id, item_name, item_category
"""
_SEGMENT_COLUMNS = """
    SELECT user_id, email, full_name, total_pageviews, active_days, last_active_date,
      CAST(days_since_last_active AS VARCHAR) AS days_since_last_active, engagement_segment
    FROM labelled
"""

_EMBEDDED = """
    SELECT review_id, string_agg(CAST(CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT)
        AS VARCHAR), ',' ORDER BY place) AS embedding
    FROM text_values WHERE review_id >= 0 GROUP BY review_id
"""

STATEMENTS = {
    "silver_users": """
        SELECT * REPLACE (CAST(valid_email AS VARCHAR) AS valid_email) FROM silver_users""",
    "silver_items": """
        SELECT id, name, category, CAST(price AS DOUBLE) AS price, inventory, created_at, updated_at
        FROM silver_items""",
    "silver_purchases_enriched": """
        SELECT id, user_id, item_id, quantity, CAST(purchase_price AS DOUBLE) AS purchase_price,
          CAST(total_price AS DOUBLE) AS total_price, user_email, item_name, item_category,
          CAST(purchase_date AS VARCHAR) AS purchase_date, purchase_hour, created_at, updated_at
        FROM enriched""",
    "silver_pageviews_by_items": "SELECT * FROM item_views",
    "silver_refreshed_pageviews": "SELECT * FROM item_views",
    "silver_refreshed_purchases": """
        SELECT p.id, p.user_id, p.item_id, p.quantity, CAST(p.purchase_price AS DOUBLE) AS purchase_price,
          CAST(CAST(p.quantity * p.purchase_price AS DECIMAL(14,2)) AS DOUBLE) AS total_price, u.email AS user_email,
          i.name AS item_name, i.category AS item_category,
          CAST(CAST(p.created_at AS DATE) AS VARCHAR) AS purchase_date,
          CAST(hour(p.created_at) AS INT) AS purchase_hour, p.created_at, p.updated_at
        FROM purchase_events p LEFT JOIN users u ON p.user_id = u.id LEFT JOIN items i ON p.item_id = i.id""",
    "top_selling_items": _SELLING,
    "top_selling_items_top10": f"""
        SELECT * FROM ({_SELLING})
        ORDER BY total_revenue DESC, item_id, item_name, item_category LIMIT 10""",
    "sales_by_hour": """
        SELECT purchase_hour, CAST(sum(total_price) AS DOUBLE) AS total_revenue
        FROM enriched_events GROUP BY purchase_hour""",
    "pageviews_by_channel": """
        SELECT channel, count(*) AS total_pageviews FROM item_views GROUP BY channel""",
    "top_converting_items": _CONVERTING.format(viewers="count(*)", buyers="count(*)"),
    "top_converting_items_distinct": _CONVERTING.format(
        viewers="count(DISTINCT v.user_id)", buyers="count(DISTINCT p.user_id)"
    ),
    "user_engagement_segments": """
        SELECT * REPLACE (CAST(days_since_last_active AS VARCHAR) AS days_since_last_active),
          '2024-01-31' AS segment_date FROM labelled""",
    "segments_from_days": """
        SELECT * REPLACE (CAST(days_since_last_active AS VARCHAR) AS days_since_last_active),
          '2024-01-31' AS segment_date FROM labelled""",
    "segments_export": _SEGMENT_COLUMNS,
    "rt_purchases_latest": _LATEST,
    "rt_purchases_stream": _LATEST,
    "rt_purchase_errors": _ERRORS,
    "rt_purchase_errors_stream": _ERRORS,
    "hourly_sales_24h": """
        SELECT date_trunc('hour', created_at) AS hour, CAST(sum(quantity) AS BIGINT) AS total_sales,
          CAST(sum(quantity * purchase_price) AS DOUBLE) AS total_revenue
        FROM latest WHERE NOT deleted
          AND created_at >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL '24' HOUR
        GROUP BY 1 ORDER BY 1""",
    "hourly_sales_within_hour": """
        SELECT date_trunc('hour', created_at) AS hour, CAST(sum(quantity) AS BIGINT) AS total_sales,
          CAST(sum(quantity * purchase_price) AS DOUBLE) AS total_revenue
        FROM latest WHERE NOT deleted
          AND created_at >= TIMESTAMP '2024-01-31 00:30:00' - INTERVAL '24' HOUR
        GROUP BY 1 ORDER BY 1""",
    "top_products": """
        SELECT item_id, CAST(sum(quantity) AS BIGINT) AS total_quantity,
          CAST(sum(quantity * purchase_price) AS DOUBLE) AS total_revenue
        FROM latest WHERE NOT deleted GROUP BY item_id
        ORDER BY total_revenue DESC, item_id LIMIT 10""",
    "kpis": """
        SELECT CAST(sum(quantity) AS BIGINT) AS total_items_sold,
          CAST(sum(quantity * purchase_price) AS DOUBLE) AS total_revenue,
          count(*) AS total_transactions
        FROM latest WHERE NOT deleted""",
    "item_documents": _DOCUMENTS,
    "item_documents_stream": _DOCUMENTS,
    "item_document_count": """
        SELECT count(*) AS documents, count(*) FILTER (NOT __deleted) AS live_documents
        FROM documents_latest""",
    "logins_enriched": "SELECT * FROM logins_geo",
    "login_anomalies": _ANOMALY,
    "login_anomalies_stream": _ANOMALY,
    "login_anomalies_joined_stream": _ANOMALY,
    "login_late_stream": """
        SELECT user_id, timestamp, ip, platform, device_type, country, city FROM logins_geo late
        WHERE event_id % 5 = 0 AND country IS NOT NULL
          AND date_trunc('second', timestamp) + INTERVAL '1' SECOND <= (
            SELECT max(timestamp) - INTERVAL '5' SECOND FROM logins_geo
            WHERE event_id % 5 <> 0 AND country IS NOT NULL)
          AND NOT EXISTS (SELECT 1 FROM logins_geo early WHERE early.event_id % 5 <> 0
            AND early.user_id = late.user_id AND early.country = late.country
            AND early.timestamp = late.timestamp)""",
    "login_log_once_stream": "SELECT DISTINCT user_id, timestamp FROM logins_geo",
    "logins_enriched_many_prefixes": """
        SELECT event_id, user_id, timestamp, ip, platform,
          CASE WHEN lower(device) LIKE '%iphone%' OR lower(device) LIKE '%android%'
            THEN 'mobile' ELSE 'desktop' END AS device_type,
          concat('c', length(ip_prefix)) AS country, ip_prefix AS city
        FROM logins JOIN (SELECT ip AS ip_prefix FROM logins
            UNION SELECT substr(ip, 1, 7) FROM logins) AS p ON starts_with(ip, ip_prefix)""",
    "login_log_upserted": "SELECT DISTINCT user_id, timestamp FROM logins_geo",
    "login_errors_stream": """
        SELECT 'unreadable time' AS _error, concat('{"user_id":"', user_id,
            '","timestamp":"no time ', event_id, '","ip":"', ip, '","device":"', device,
            '","platform":"', platform, '"}') AS _raw_message,
          (SELECT count(*) FROM logins WHERE event_id % 100 <> 7) AS good
        FROM logins WHERE event_id % 100 = 7""",
    "load_bounds": """
        SELECT 'users' AS table_name, count(*) AS rows, min(id) AS low, max(id) AS high FROM users
        UNION ALL SELECT 'items', count(*), min(id), max(id) FROM items
        UNION ALL SELECT 'purchases', count(*), min(id), max(id) FROM purchases""",
    "quality_report": """
        SELECT 'users' AS table_name, 'id_not_null' AS rule,
          count(*) FILTER (id IS NULL) AS failed, count(*) AS total FROM silver_users
        UNION ALL SELECT 'users', 'valid_email',
          count(*) FILTER (NOT coalesce(valid_email, false)), count(*) FROM silver_users
        UNION ALL SELECT 'items', 'id_not_null', count(*) FILTER (id IS NULL), count(*)
          FROM silver_items
        UNION ALL SELECT 'items', 'price_positive',
          count(*) FILTER (NOT coalesce(price > 0, false)), count(*) FROM silver_items
        UNION ALL SELECT 'purchases', 'id_not_null', count(*) FILTER (id IS NULL), count(*)
          FROM purchases
        UNION ALL SELECT 'purchases', 'user_id_not_null', count(*) FILTER (user_id IS NULL),
          count(*) FROM purchases
        UNION ALL SELECT 'purchases', 'item_id_not_null', count(*) FILTER (item_id IS NULL),
          count(*) FROM purchases
        UNION ALL SELECT 'purchases', 'price_positive',
          count(*) FILTER (NOT coalesce(purchase_price > 0, false)), count(*) FROM purchases""",
    "full_run_quality": """
        SELECT 'users' AS table_name, 'id_not_null' AS rule,
          count(*) FILTER (id IS NULL) AS failed, count(*) AS total FROM silver_users
        UNION ALL SELECT 'users', 'valid_email',
          count(*) FILTER (NOT coalesce(valid_email, false)), count(*) FROM silver_users
        UNION ALL SELECT 'items', 'id_not_null', count(*) FILTER (id IS NULL), count(*)
          FROM silver_items
        UNION ALL SELECT 'items', 'price_positive',
          count(*) FILTER (NOT coalesce(price > 0, false)), count(*) FROM silver_items
        UNION ALL SELECT 'purchases', 'id_not_null', count(*) FILTER (id IS NULL), count(*)
          FROM purchase_events
        UNION ALL SELECT 'purchases', 'user_id_not_null', count(*) FILTER (user_id IS NULL),
          count(*) FROM purchase_events
        UNION ALL SELECT 'purchases', 'item_id_not_null', count(*) FILTER (item_id IS NULL),
          count(*) FROM purchase_events
        UNION ALL SELECT 'purchases', 'price_positive',
          count(*) FILTER (NOT coalesce(purchase_price > 0, false)), count(*) FROM purchase_events""",
    "latest_by_key": """
        SELECT id, first_name, last_name, email, created_at, updated_at FROM (
          SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) AS place
          FROM user_versions) WHERE place = 1""",
    "incremental_ingest": """
        SELECT 'purchases' AS table_name, id, created_at, updated_at FROM purchase_events
        WHERE id % 50 <> 9
        UNION ALL SELECT 'users', id, created_at, updated_at FROM users
        UNION ALL SELECT 'items', id, created_at, updated_at FROM items""",
    "rejected_rows": """
        SELECT 'bronze.purchases' AS table_name, id FROM purchase_events WHERE id % 50 = 9""",
    "full_run_gold": _CONVERTING.format(viewers="count(*)", buyers="count(*)"),
    "segments_job": """
        SELECT engagement_segment, count(*) AS users, CAST(sum(total_pageviews) AS BIGINT) AS pageviews FROM (
          SELECT CASE WHEN n >= 50 AND idle <= 3 THEN 'high_engagement'
               WHEN n BETWEEN 10 AND 49 AND idle <= 7 THEN 'medium_engagement'
               ELSE 'low_engagement' END AS engagement_segment, n AS total_pageviews
          FROM (SELECT u.id, count(v.page) AS n,
              date_diff('day', max(CAST(v.received_at AS DATE)), DATE '2024-01-31') AS idle
            FROM silver_users u LEFT JOIN item_views v ON u.id = v.user_id
            WHERE u.valid_email GROUP BY u.id))
        GROUP BY engagement_segment""",
    "pageviews_source_files": """
        SELECT count(*) AS pageviews, count(*) AS with_file, count(*) AS with_time FROM pageviews""",
    "purchases_kept_newest": _LATEST,
    "purchases_equal_times": """
        SELECT id, 1 AS quantity FROM changes WHERE _error = ''
          AND campaign_id IS DISTINCT FROM 'BOGO23'""",
    "item_documents_equal_times": """
        SELECT id, concat('a ', name) AS name FROM item_rows WHERE __op = 'r'""",
    "item_errors_stream": """
        SELECT 'decode error' AS _error, concat('{"op":"u","after":{"id":', id) AS _raw_message,
          (SELECT count(*) FROM item_rows) AS good
        FROM item_rows WHERE id % 100 = 3""",
    "logins_enriched_geo_csv": "SELECT * FROM logins_geo",
    "anomaly_messages": f"""
        SELECT concat('{{"user_id":"', user_id, '","timestamp":"', shown, '"}}') AS key,
          concat('{{"user_id":"', user_id, '","timestamp":"', shown, '","reason":"', reason,
            '","country":"', country, '"}}') AS value
        FROM (SELECT *, strftime(timestamp, '%Y-%m-%d %H:%M:%S.%g') AS shown FROM ({_ANOMALY}))
        WHERE country IS NOT NULL""",
    "pageviews_ingest_stream": "SELECT * FROM pageviews",
    "pageviews_dlq": """
        SELECT CASE event_type
            WHEN 'error' THEN concat('{"user_id":', user_id, ',"url":"/broken/', event_id)
            ELSE concat('{"user_id":"u', user_id, '","url":"/signup/', event_id, '"}') END
            AS raw_record,
          CAST(NULL AS BIGINT) AS user_id,
          CASE event_type WHEN 'signup' THEN concat('/signup/', event_id) END AS url
        FROM events WHERE event_type IN ('error', 'signup')""",
    "review_embeddings": _EMBEDDED,
    "embedding_write_back": f"""
        SELECT e.review_id, d.text AS review, e.embedding
        FROM ({_EMBEDDED}) e JOIN documents d ON d.doc_id = e.review_id""",
    "similar_reviews_top5": """
        SELECT review_id, customer_name, review, round(distance, 4) AS similarity FROM (
          SELECT v.review_id, d.source AS customer_name, d.text AS review,
            round(list_cosine_distance(CAST(v.vector AS DOUBLE[]),
              (SELECT CAST(vector AS DOUBLE[]) FROM text_vectors WHERE review_id = -1)), 12)
              AS distance
          FROM text_vectors v JOIN documents d ON d.doc_id = v.review_id)
        ORDER BY distance, review_id LIMIT 5""",
    "similar_vectors_top5": """
        SELECT vec_id AS review_id, label, round(distance, 4) AS similarity FROM (
          SELECT vec_id, label, list_cosine_distance(CAST(embedding AS DOUBLE[]),
            (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings ORDER BY vec_id LIMIT 1))
            AS distance
          FROM embeddings)
        ORDER BY distance, vec_id LIMIT 5""",
}


def statements() -> dict[str, str]:
    """Complete SQL text per query name."""
    return {name: _with_shapes(sql) for name, sql in STATEMENTS.items()}
