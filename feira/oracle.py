"""The queries of ``feira.queries`` once more, in SQL for another engine.

Written against the definitions of the tables, not against the Spark plans: facts join
item by item and remove copies at the end. Only the parts a query needs are put in
front of it.
"""

import re

from feira.functions.text import ACCENTED, PLAIN
from feira.queries import CENTRES, FIRST_DAY, LAST_DAY


def _clean(column: str) -> str:
    folded = f"translate(lower({column}), '{ACCENTED}', '{PLAIN}')"
    return f"trim(regexp_replace({folded}, '[0-9]', '', 'g'))"


def _first_per_key(table: str, key: str, *rest: str) -> str:
    order = ", ".join(f"{column} ASC NULLS FIRST" for column in rest)
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {key} ORDER BY {order}) AS rn FROM {table}) WHERE rn = 1"
    )


def _as_double(*names: str) -> str:
    return ", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in names)


_MEASURES = [
    "product_name_length",
    "product_description_length",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
]
_MEASURES_VALID = " AND ".join(f"({m} >= 0 OR {m} IS NULL)" for m in _MEASURES)
_CHRONOLOGY = """
    (order_purchase_timestamp <= order_approved_at OR order_approved_at IS NULL)
    AND (order_approved_at <= order_delivered_carrier_date
         OR order_delivered_carrier_date IS NULL)
    AND (order_delivered_carrier_date <= order_delivered_customer_date
         OR order_delivered_customer_date IS NULL)"""

def _with_copies(table: str, key: str, *copies: tuple[int, int, str]) -> str:
    """All rows and, of those whose key has a remainder, copies with some columns replaced."""
    return f"SELECT * FROM {table} " + " ".join(
        f"UNION ALL SELECT * {f'REPLACE ({changes})' if changes else ''} FROM {table} "
        f"WHERE CAST({key} AS BIGINT) % {divisor} = {rest}"
        for divisor, rest, changes in copies
    )


def _zip_copies(role: str, table: str) -> str:
    key, prefix = f"{role}_id", f"{role}_zip_code_prefix"
    return _with_copies(
        table,
        key,
        (11, 3, f"CAST(-1 AS INTEGER) AS {prefix}, '12' AS {role}_city"),
        (13, 4, f"CAST({prefix} + 1000 AS INTEGER) AS {prefix}"),
        (17, 5, f"CAST(NULL AS VARCHAR) AS {key}"),
    )


# Named parts, each using only those above it.
_PARTS = {
    "base_customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
               CAST(c_custkey // 2 AS VARCHAR) AS customer_unique_id,
               c_nationkey AS customer_zip_code_prefix,
               CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % 89 = 0 THEN ' 12 '
                    ELSE 'São ' || c_mktsegment || ' ' || n_name END AS customer_city,
               n_name AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "base_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
               CAST(o_custkey AS VARCHAR) AS customer_id,
               o_orderstatus AS order_status,
               CAST(o_orderdate AS TIMESTAMP) AS order_purchase_timestamp,
               CASE WHEN o_orderstatus <> 'P'
                    THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 DAY END AS order_approved_at,
               CAST(first_ship AS TIMESTAMP) AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus <> 'O'
                    THEN CAST(last_ship AS TIMESTAMP) END AS order_delivered_customer_date,
               CAST(o_orderdate AS TIMESTAMP) + INTERVAL 60 DAY AS order_estimated_delivery_date
        FROM orders LEFT JOIN (
            SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
            FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
    "base_items": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               CAST(l_shipdate AS TIMESTAMP) AS shipping_limit_date,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
               CAST(CAST(l_tax AS DECIMAL(4,2)) * 100 - 1 AS DECIMAL(18,2)) AS freight_value
        FROM lineitem""",
    "base_payments": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS payment_sequential,
               CASE l_returnflag WHEN 'R' THEN 'voucher' WHEN 'A' THEN 'credit_card' END
                   AS payment_type,
               CAST(l_quantity AS INTEGER) % 12 AS payment_installments,
               CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                   AS payment_value
        FROM lineitem""",
    "base_products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               CAST(trunc(length(p_name) + 0.5) AS INTEGER) AS product_name_length,
               CAST(p_size * 10 AS INTEGER) AS product_description_length,
               CAST(p_size % 6 AS INTEGER) AS product_photos_qty,
               CASE WHEN p_partkey % 50 <> 0
                    THEN CAST(p_size AS DOUBLE) - 5 END AS product_weight_g,
               CAST(p_size AS DOUBLE) * 1.5 AS product_length_cm,
               CAST(p_size AS DOUBLE) / 2 AS product_height_cm,
               CAST(p_size AS DOUBLE) + 0.25 AS product_width_cm,
               CASE WHEN p_partkey % 41 <> 0 THEN p_type END AS category
        FROM part""",
    "translation": """
        SELECT DISTINCT p_type AS category, 'english ' || lower(p_type) AS english
        FROM part WHERE p_type <> 'STANDARD'""",
    "base_sellers": """
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, s_nationkey AS seller_zip_code_prefix,
               'Córdoba ' || s_suppkey AS seller_city, 'R' || n_regionkey AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "base_reviews": """
        SELECT CAST(event_id AS VARCHAR) AS review_id,
               CAST(event_id // 2 AS VARCHAR) AS order_id,
               CAST(event_id % 7 AS INTEGER) AS review_score,
               CAST(NULL AS VARCHAR) AS review_comment_title,
               CASE WHEN event_type <> 'error' THEN props END AS review_comment_message,
               CAST(ts AS TIMESTAMP) AS review_creation_date,
               CAST(ts AS TIMESTAMP) + to_days(CAST(event_id % 10 AS INTEGER))
                   AS review_answer_timestamp
        FROM events""",
    "raw_geolocation": """
        SELECT label AS geolocation_zip_code_prefix,
               CAST(embedding[1] AS DOUBLE) * 300 AS lat,
               CAST(embedding[2] AS DOUBLE) * 600 AS lng,
               CASE WHEN label = 9 THEN '99' ELSE 'São Cidade ' || (vec_id % 5) END AS city,
               'S' || (vec_id % 3) AS state
        FROM embeddings""",
    "raw_customers": _zip_copies("customer", "base_customers"),
    "raw_sellers": _zip_copies("seller", "base_sellers"),
    "raw_orders": _with_copies(
        "base_orders",
        "order_id",
        (
            11,
            3,
            "'0' AS customer_id, "
            "order_purchase_timestamp - INTERVAL 1 DAY AS order_approved_at",
        ),
        (13, 4, "customer_id || '9' AS customer_id"),
        (17, 5, "CAST(NULL AS VARCHAR) AS order_id"),
    ),
    "raw_items": _with_copies("base_items", "order_id", (7, 2, "")),
    "raw_payments": _with_copies("base_payments", "order_id", (7, 3, "")),
    "raw_reviews": _with_copies("base_reviews", "review_id", (7, 1, "")),
    "raw_products": _with_copies(
        "base_products",
        "product_id",
        (11, 3, "'A' AS category, CAST(-1 AS DOUBLE) AS product_weight_g"),
        (13, 4, "'zzz' AS category"),
        (17, 5, "CAST(NULL AS VARCHAR) AS product_id"),
    ),
    "s_customers": f"""
        SELECT * FROM (SELECT * REPLACE ({_clean("customer_city")} AS customer_city) FROM ({
            _first_per_key(
                "raw_customers",
                "customer_id",
                "customer_unique_id",
                "customer_zip_code_prefix",
                "customer_city",
                "customer_state",
            )
        }) WHERE customer_id IS NOT NULL) WHERE customer_city <> ''""",
    "valid_orders": f"SELECT * FROM raw_orders WHERE {_CHRONOLOGY}",
    "s_orders": _first_per_key(
        "valid_orders",
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    + " AND order_id IS NOT NULL",
    "s_products": f"""
        SELECT p.* EXCLUDE (category), coalesce(t.english, p.category) AS product_category_name
        FROM ({_first_per_key("raw_products", "product_id", "category", *_MEASURES)}) p
        LEFT JOIN translation t ON p.category = t.category
        WHERE {_MEASURES_VALID}""",
    "s_sellers": f"""
        SELECT * REPLACE ({_clean("seller_city")} AS seller_city) FROM ({
            _first_per_key(
                "raw_sellers", "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"
            )
        })""",
    "s_items": "SELECT * FROM raw_items WHERE price >= 0 AND freight_value >= 0",
    "s_reviews": "SELECT * FROM raw_reviews WHERE review_score >= 1 AND review_score <= 5",
    "s_payments": "SELECT DISTINCT * FROM raw_payments",
    "on_globe": """
        SELECT * FROM raw_geolocation
        WHERE lat >= -90 AND lat <= 90 AND lng >= -180 AND lng <= 180""",
    "s_geolocation": f"""
        SELECT * FROM (
            SELECT m.geolocation_zip_code_prefix, geo_lat, geo_lng,
                   {_clean("city")} AS geolocation_city, state AS geolocation_state
            FROM (SELECT geolocation_zip_code_prefix, avg(lat) AS geo_lat, avg(lng) AS geo_lng
                  FROM on_globe GROUP BY geolocation_zip_code_prefix) m
            JOIN ({_first_per_key("on_globe", "geolocation_zip_code_prefix", "city", "state")}) p
              ON m.geolocation_zip_code_prefix = p.geolocation_zip_code_prefix)
        WHERE geolocation_city <> ''""",
    "d_customers": f"""
        SELECT customer_key, customer_unique_id, customer_zip_code_prefix, customer_city,
               customer_state
        FROM ({
            _first_per_key(
                "(SELECT sha256(concat_ws('||', customer_unique_id)) AS customer_key, * "
                "FROM s_customers)",
                "customer_key",
                "customer_unique_id",
                "customer_zip_code_prefix",
                "customer_city",
                "customer_state",
            )
        })""",
    "d_products": """
        SELECT sha256(concat_ws('||', product_id)) AS product_key, product_id,
               product_category_name AS category_name_english, product_weight_g,
               product_length_cm, product_height_cm, product_width_cm
        FROM s_products""",
    "d_sellers": """
        SELECT sha256(concat_ws('||', seller_id)) AS seller_key, seller_id,
               seller_zip_code_prefix, seller_city, seller_state
        FROM s_sellers""",
    "paid": """
        SELECT order_id, sum(payment_value) AS payment_value,
               max(payment_installments) AS payment_installments,
               max(CASE WHEN payment_type = 'voucher' THEN 1 ELSE 0 END) AS is_voucher
        FROM s_payments GROUP BY order_id""",
    "sold": """
        SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.price, i.freight_value,
               o.order_purchase_timestamp AS purchased,
               o.order_delivered_customer_date AS delivered,
               o.order_estimated_delivery_date AS estimated,
               dc.customer_key, dp.product_key, ds.seller_key
        FROM s_items i
        JOIN s_orders o ON i.order_id = o.order_id
        LEFT JOIN s_customers c ON o.customer_id = c.customer_id
        LEFT JOIN d_customers dc ON c.customer_unique_id = dc.customer_unique_id
        LEFT JOIN d_products dp ON i.product_id = dp.product_id
        LEFT JOIN d_sellers ds ON i.seller_id = ds.seller_id""",
    "f_sales": """
        SELECT DISTINCT sha256(concat_ws('||', sold.order_id, order_item_id)) AS sale_key,
               customer_key, product_key, seller_key,
               strftime(purchased, '%Y%m%d') AS date_key, price, freight_value,
               payment_value, payment_installments, is_voucher
        FROM sold LEFT JOIN paid ON sold.order_id = paid.order_id""",
    "f_shipping": """
        SELECT DISTINCT
               sha256(concat_ws('||', order_id, order_item_id, seller_id)) AS shipping_key,
               customer_key, product_key, seller_key,
               strftime(purchased, '%Y%m%d') AS date_key,
               CAST(date_diff('day', purchased, delivered) AS INTEGER) AS delivery_lead_time,
               CAST(date_diff('day', estimated, delivered) AS INTEGER)
                   AS estimated_delivery_error,
               CASE WHEN delivered > estimated THEN true ELSE false END AS is_late
        FROM sold WHERE date_diff('day', purchased, delivered) IS NOT NULL""",
    "days": f"""
        SELECT strftime(d, '%Y%m%d') AS date_key, CAST(d AS DATE) AS full_date
        FROM generate_series(TIMESTAMP '{FIRST_DAY}', TIMESTAMP '{LAST_DAY}', INTERVAL 1 DAY) g(d)
        """,
    "dated": """
        SELECT customer_unique_id, customer_city, customer_state, full_date, sale_key,
               payment_value
        FROM f_sales JOIN days USING (date_key) JOIN d_customers USING (customer_key)""",
    "rfm": """
        SELECT customer_unique_id, customer_city, customer_state,
               CAST(date_diff('day', max(full_date),
                              (SELECT max(full_date) + 1 FROM dated)) AS INTEGER) AS "Recency",
               CAST(count(sale_key) AS BIGINT) AS "Frequency",
               CAST(coalesce(sum(payment_value), 0) AS DOUBLE) AS "Monetary"
        FROM dated GROUP BY customer_unique_id, customer_city, customer_state""",
    "z": """
        SELECT customer_unique_id, customer_city, customer_state,
               ("Recency" - avg("Recency") OVER ()) / stddev_samp("Recency") OVER ()
                   AS "Recency_z",
               ("Frequency" - avg("Frequency") OVER ()) / stddev_samp("Frequency") OVER ()
                   AS "Frequency_z",
               ("Monetary" - avg("Monetary") OVER ()) / stddev_samp("Monetary") OVER ()
                   AS "Monetary_z"
        FROM rfm""",
}


def _nearest_centre() -> str:
    distances = [
        f"""(pow("Recency_z" - ({r}), 2) + pow("Frequency_z" - ({f}), 2)
             + pow("Monetary_z" - ({m}), 2))"""
        for r, f, m in CENTRES
    ]
    least = f"least({', '.join(distances)})"
    whens = " ".join(f"WHEN {d} = {least} THEN {i}" for i, d in enumerate(distances))
    return f"""SELECT customer_unique_id, customer_city, customer_state,
        CAST(CASE {whens} END AS INTEGER) AS "Cluster" FROM z"""


def _audit() -> str:
    pairs = [
        ("customers", "raw_customers", "s_customers"),
        ("orders", "raw_orders", "s_orders"),
        ("products", "raw_products", "s_products"),
        ("sellers", "raw_sellers", "s_sellers"),
        ("order_items", "raw_items", "s_items"),
        ("order_reviews", "raw_reviews", "s_reviews"),
        ("order_payments", "raw_payments", "s_payments"),
        ("geolocation", "raw_geolocation", "s_geolocation"),
    ]
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, rows_in, rows_out, rows_in - rows_out AS rows_dropped
        FROM (SELECT (SELECT count(*) FROM {before}) AS rows_in,
                     (SELECT count(*) FROM {after}) AS rows_out)"""
        for name, before, after in pairs
    )


def _orphans() -> str:
    links = [
        ("orders", "s_orders", "customers", "s_customers", "customer_id"),
        ("order_items", "s_items", "orders", "s_orders", "order_id"),
        ("order_items", "s_items", "products", "s_products", "product_id"),
        ("order_items", "s_items", "sellers", "s_sellers", "seller_id"),
        ("order_payments", "s_payments", "orders", "s_orders", "order_id"),
        ("order_reviews", "s_reviews", "orders", "s_orders", "order_id"),
    ]
    return " UNION ALL ".join(
        f"""SELECT '{child}' AS child_table, '{parent}' AS parent_table, '{key}' AS key_column,
               CAST(count(*) AS BIGINT) AS orphan_rows,
               CAST(count(DISTINCT {key}) AS BIGINT) AS orphan_keys
        FROM {child_part} c
        WHERE NOT EXISTS (SELECT 1 FROM {parent_part} p WHERE p.{key} = c.{key})"""
        for child, child_part, parent, parent_part, key in links
    )


def _audit_rules() -> str:
    """Each rule on its own, in the order in which rows meet them."""
    first_customers = _first_per_key(
        "(SELECT * FROM raw_customers WHERE customer_id IS NOT NULL)",
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
    )
    first_products = _first_per_key("raw_products", "product_id", "category", *_MEASURES)
    first_places = _first_per_key("on_globe", "geolocation_zip_code_prefix", "city", "state")
    keyed = "(SELECT * FROM valid_orders WHERE order_id IS NOT NULL)"
    copies = "count(*) - count(DISTINCT coalesce({0}, '(none)')) FROM {1}"
    rules = [
        ("customers", "no_key", "count(*) FROM raw_customers WHERE customer_id IS NULL"),
        ("customers", "copy", "count(customer_id) - count(DISTINCT customer_id) FROM raw_customers"),
        ("customers", "empty_city",
         f"count(*) FROM ({first_customers}) WHERE coalesce({_clean('customer_city')}, '') = ''"),
        ("orders", "stages_out_of_order",
         f"count(*) FROM raw_orders WHERE NOT coalesce({_CHRONOLOGY}, false)"),
        ("orders", "no_key", "count(*) FROM valid_orders WHERE order_id IS NULL"),
        ("orders", "copy", f"count(*) - count(DISTINCT order_id) FROM {keyed}"),
        ("products", "copy", copies.format("product_id", "raw_products")),
        ("products", "negative_measure", f"count(*) FROM ({first_products}) WHERE NOT ({_MEASURES_VALID})"),
        ("sellers", "copy", copies.format("seller_id", "raw_sellers")),
        ("order_items", "negative_amount",
         "count(*) FROM raw_items WHERE NOT coalesce(price >= 0 AND freight_value >= 0, false)"),
        ("order_reviews", "score_out_of_range",
         "count(*) FROM raw_reviews WHERE NOT coalesce(review_score >= 1 AND review_score <= 5, false)"),
        ("order_payments", "copy", "(SELECT count(*) FROM raw_payments) - (SELECT count(*) FROM s_payments)"),
        ("geolocation", "off_the_globe",
         "(SELECT count(*) FROM raw_geolocation) - (SELECT count(*) FROM on_globe)"),
        ("geolocation", "copy", "count(*) - count(DISTINCT geolocation_zip_code_prefix) FROM on_globe"),
        ("geolocation", "empty_city",
         f"count(*) FROM ({first_places}) WHERE coalesce({_clean('city')}, '') = ''"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, CAST(n AS BIGINT) AS rows_dropped "
        f"FROM (SELECT {count.replace(' FROM', ' AS n FROM', 1) if not count.startswith('(') else f'{count} AS n'})"
        for table, rule, count in rules
    )


_SHIPPING_COLUMNS = """shipping_key, f.customer_key, product_key, f.seller_key, date_key,
    delivery_lead_time, estimated_delivery_error, is_late"""
_LINE_COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_shipdate"
_FIRST_LINES = _first_per_key(
    f"(SELECT {_LINE_COLUMNS} FROM lineitem)",
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_returnflag",
    "l_shipdate",
)
_SALES_COLUMNS = f"""sale_key, customer_key, product_key, seller_key, date_key,
    {_as_double("price", "freight_value", "payment_value")}, payment_installments"""

_QUERIES = {
    "silver_customers": "SELECT * FROM s_customers",
    "silver_orders": "SELECT * FROM s_orders",
    "silver_products": "SELECT * FROM s_products",
    "silver_sellers": "SELECT * FROM s_sellers",
    "silver_order_items": f"""
        SELECT * EXCLUDE (price, freight_value), {_as_double("price", "freight_value")}
        FROM s_items""",
    "silver_order_reviews": "SELECT * FROM s_reviews",
    "silver_payments": f"""
        SELECT * EXCLUDE (payment_value), {_as_double("payment_value")} FROM s_payments""",
    "silver_geolocation": """
        SELECT * REPLACE (round(geo_lat, 6) AS geo_lat, round(geo_lng, 6) AS geo_lng)
        FROM s_geolocation""",
    "filter_chronology": f"""
        SELECT order_id, coalesce({_CHRONOLOGY}, false) AS kept FROM raw_orders""",
    "filter_measures": f"SELECT product_id, {_MEASURES_VALID} AS kept FROM raw_products",
    "cast_text_dates": """
        SELECT o_orderkey, placed, try_cast(placed AS TIMESTAMP) AS placed_at
        FROM (SELECT o_orderkey,
                     CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
                          WHEN 'O' THEN '' ELSE 'soon' END AS placed FROM orders)""",
    "cast_text_ints": """
        SELECT p_partkey, size_text,
               CAST(trunc(try_cast(size_text AS DOUBLE)) AS INTEGER) AS size
        FROM (SELECT p_partkey,
                     CASE WHEN p_partkey % 7 = 0 THEN p_name
                          ELSE '-' || p_size || '.7' END AS size_text FROM part)""",
    "clean_text": f"SELECT doc_id, {_clean('text')} AS cleaned FROM documents",
    "surrogate_keys": """
        SELECT p_partkey, sha256(concat_ws('||', p_brand, kind, p_size)) AS wide_key,
               sha256(concat_ws('||', kind)) AS kind_key
        FROM (SELECT *, CASE WHEN p_partkey % 41 <> 0 THEN p_type END AS kind FROM part)""",
    "dedup_by_key": _FIRST_LINES,
    "dedup_then_filter": f"SELECT * FROM ({_FIRST_LINES}) WHERE l_returnflag = 'R'",
    "distinct_lines": "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem",
    "dim_customers": "SELECT * FROM d_customers",
    "dim_products": "SELECT * FROM d_products",
    "dim_sellers": "SELECT * FROM d_sellers",
    "dim_date": """
        SELECT strftime(d, '%Y%m%d') AS date_key, CAST(d AS TIMESTAMP) AS full_date,
               dayname(d) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend,
               CAST(month(d) AS INTEGER) AS month, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(year(d) AS INTEGER) AS year, false AS is_holiday
        FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS TIMESTAMP)),
                                            max(CAST(o_orderdate AS TIMESTAMP)),
                                            INTERVAL 1 DAY)) AS d FROM orders)""",
    "payments_per_order": f"""
        SELECT order_id, {_as_double("payment_value")}, payment_installments, is_voucher
        FROM paid""",
    "fact_sales": f"SELECT DISTINCT {_SALES_COLUMNS} FROM f_sales",
    "sales_with_voucher": f"SELECT {_SALES_COLUMNS}, is_voucher FROM f_sales",
    "fact_reviews": """
        SELECT DISTINCT
               sha256(concat_ws('||', r.review_id, s.product_id, s.seller_id)) AS review_key,
               customer_key, strftime(review_creation_date, '%Y%m%d') AS date_key,
               r.order_id, review_score,
               CAST(length(coalesce(review_comment_message, '')) AS INTEGER) AS comment_length,
               review_answer_timestamp AS response_time
        FROM s_reviews r JOIN sold s ON r.order_id = s.order_id""",
    "fact_shipping": "SELECT * FROM f_shipping",
    "shipping_distance": f"""
        SELECT {_SHIPPING_COLUMNS},
               round(2 * 6371.0 * asin(sqrt(least(1.0,
                   pow(sin(radians(sg.geo_lat - cg.geo_lat) / 2), 2)
                   + cos(radians(cg.geo_lat)) * cos(radians(sg.geo_lat))
                     * pow(sin(radians(sg.geo_lng - cg.geo_lng) / 2), 2)))), 4)
                   * CASE WHEN cg.geo_lat IS NULL OR sg.geo_lat IS NULL THEN NULL ELSE 1 END
                   AS shipping_distance_km
        FROM f_shipping f
        LEFT JOIN d_customers c ON f.customer_key = c.customer_key
        LEFT JOIN d_sellers s ON f.seller_key = s.seller_key
        LEFT JOIN s_geolocation cg
               ON c.customer_zip_code_prefix = cg.geolocation_zip_code_prefix
        LEFT JOIN s_geolocation sg
               ON s.seller_zip_code_prefix = sg.geolocation_zip_code_prefix""",
    "review_response_days": """
        SELECT review_id, order_id,
               CAST(date_diff('day', review_creation_date, review_answer_timestamp) AS INTEGER)
                   AS response_days
        FROM s_reviews""",
    "rfm_features": "SELECT * FROM rfm",
    "rfm_scaled": """
        SELECT customer_unique_id, customer_city, customer_state,
               round("Recency_z", 6) AS "Recency_z", round("Frequency_z", 6) AS "Frequency_z",
               round("Monetary_z", 6) AS "Monetary_z" FROM z""",
    "rfm_assign_fixed": _nearest_centre(),
    "rfm_segments": """
        SELECT *, true AS in_range, true AS is_nearest, true AS centres_in_order FROM rfm""",
    "audit_counts": _audit(),
    "orphan_audit": _orphans(),
    "audit_rules": _audit_rules(),
}


def _with_parts(sql: str) -> str:
    needed: set[str] = set()
    pending = [sql]
    while pending:
        text = pending.pop()
        for name in _PARTS:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                pending.append(_PARTS[name])
    parts = ", ".join(f"{name} AS ({body})" for name, body in _PARTS.items() if name in needed)
    return f"WITH {parts} {sql}" if parts else sql


def oracle_sql() -> dict[str, str]:
    return {name: _with_parts(sql) for name, sql in _QUERIES.items()}
