"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each query is ``WITH <role mapping>, <silver>, <gold> SELECT ...`` over the
driver's pre-registered views.  The role mapping mirrors
``vantage/sources/tpch.py``; the silver and gold parts are written from the rule
table (SURVEY 2.13): first rows by DISTINCT ON, one grouped join per window.

Output canonicalisation shared with the Spark side (``vantage.plans.compare``):
DATE -> 'YYYY-MM-DD' text, TIMESTAMP -> 'YYYY-MM-DD HH:MM:SS' text, DOUBLE ->
round(x + 1e-9, 6), integers -> BIGINT.
"""

from __future__ import annotations

RAW = """
raw_orders AS (
    SELECT o_orderkey AS order_id,
           o_custkey AS customer_id,
           CASE o_orderstatus WHEN 'F' THEN 'canceled' WHEN 'O' THEN 'delivered' WHEN 'P' THEN 'processing' END
               AS order_status,
           o_orderdate + to_hours(CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_orderkey % 24 END AS INTEGER))
               + to_days(copy * 2) AS order_purchase_timestamp,
           CASE WHEN copy = 0 AND o_orderpriority <> '5-LOW' THEN o_orderdate + INTERVAL 1 DAY END AS order_approved_at,
           CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 3 DAY END AS order_delivered_carrier_date,
           CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 7 DAY END AS order_delivered_customer_date,
           o_orderdate + INTERVAL 14 DAY AS order_estimated_delivery_date
    FROM orders JOIN (VALUES (0), (1)) twice(copy) ON copy = 0 OR o_orderkey % 50 = 0
),
raw_customers AS (
    SELECT c_custkey AS customer_id,
           (c_custkey + 1) // 2 AS customer_unique_id,
           lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
           c_mktsegment AS customer_city,
           lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS customer_state
    FROM customer
),
raw_order_items AS (
    SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
           l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
           l_extendedprice AS price, l_extendedprice * l_tax AS freight_value
    FROM lineitem
),
raw_order_payments AS (
    SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
           CASE WHEN l_returnflag = 'A' THEN 'credit_card'
                WHEN l_returnflag = 'N' THEN 'boleto'
                WHEN l_returnflag = 'R' THEN 'voucher' END AS payment_type,
           l_linenumber AS payment_installments, l_extendedprice AS payment_value
    FROM lineitem
),
raw_order_reviews AS (
    SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS review_id,
           CASE WHEN l_orderkey % 97 = 0 THEN -l_orderkey ELSE l_orderkey END AS order_id,
           CAST(1 + (l_orderkey + l_linenumber) % 5 AS INTEGER) AS review_score,
           CAST(NULL AS VARCHAR) AS review_comment_title,
           l_linestatus AS review_comment_message,
           CAST(l_shipdate AS DATE) AS review_creation_date,
           l_shipdate + INTERVAL 1 DAY AS review_answer_timestamp
    FROM lineitem
    WHERE l_orderkey % 7 <> 0
),
raw_sellers AS (
    SELECT s_suppkey AS seller_id,
           lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
           s_name AS seller_city,
           lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS seller_state
    FROM supplier
),
raw_geolocation AS (
    SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
           c_nationkey * 2.5::DOUBLE - 30 + CAST((c_custkey % 11) - 5 AS DOUBLE) * 0.01::DOUBLE AS geolocation_lat,
           c_nationkey * 7.0::DOUBLE - 84 + CAST((c_custkey % 7) - 3 AS DOUBLE) * 0.01::DOUBLE AS geolocation_lng,
           c_mktsegment AS geolocation_city,
           lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS geolocation_state
    FROM customer
    UNION ALL
    SELECT lpad(CAST(s_nationkey AS VARCHAR), 5, '0'),
           s_nationkey * 2.5::DOUBLE - 30 + CAST((s_suppkey % 11) - 5 AS DOUBLE) * 0.01::DOUBLE,
           s_nationkey * 7.0::DOUBLE - 84 + CAST((s_suppkey % 7) - 3 AS DOUBLE) * 0.01::DOUBLE,
           s_name,
           lpad(CAST(s_nationkey AS VARCHAR), 2, '0')
    FROM supplier
),
raw_products AS (
    SELECT p_partkey AS product_id, p_type AS product_category_name
    FROM part
),
raw_category_translation AS (
    SELECT DISTINCT p_type AS product_category_name,
           CASE WHEN p_type = 'ECONOMY' THEN 'housewares'
                WHEN p_type = 'LARGE' THEN 'furniture_decor'
                WHEN p_type = 'MEDIUM' THEN 'sports_leisure'
                WHEN p_type = 'PROMO' THEN 'toys'
                WHEN p_type = 'SMALL' THEN 'electronics'
                WHEN p_type = 'STANDARD' THEN 'no_known_prior' END AS product_category_name_english
    FROM part
)"""

SILVER = """
stg_orders AS (
    SELECT picked.order_id, who.customer_unique_id, picked.customer_id, who.customer_state,
           who.customer_zip_code_prefix, picked.order_status,
           picked.order_purchase_timestamp AS order_purchase_ts,
           picked.order_approved_at AS order_approved_ts,
           picked.order_delivered_customer_date AS order_delivered_ts,
           (picked.order_status = 'canceled' AND picked.order_approved_at IS NOT NULL) IS TRUE
               AS is_cancelled_post_approval
    FROM (SELECT DISTINCT ON (order_id) * FROM raw_orders
          ORDER BY order_id, order_purchase_timestamp NULLS LAST, order_approved_at NULLS LAST,
                   order_status NULLS LAST) AS picked
         LEFT JOIN raw_customers AS who USING (customer_id)
),
stg_customers AS (
    WITH last_seen AS (
        SELECT customer_id, max(order_purchase_timestamp) AS seen FROM raw_orders GROUP BY customer_id),
    ranked AS (
        SELECT customer_unique_id,
               max({'seen': coalesce(seen, TIMESTAMP '0001-01-01'), 'state': customer_state,
                    'zip': customer_zip_code_prefix}) AS newest
        FROM raw_customers LEFT JOIN last_seen USING (customer_id)
        GROUP BY customer_unique_id)
    SELECT customer_unique_id, newest.state AS customer_state, newest.zip AS customer_zip_code_prefix FROM ranked
),
stg_order_items AS (
    SELECT order_id, order_item_id::INTEGER AS order_item_id, product_id, seller_id,
           price::DOUBLE AS price, freight_value::DOUBLE AS freight_value
    FROM raw_order_items
),
stg_order_payments AS (
    SELECT order_id, payment_sequential::INTEGER AS payment_sequential, payment_type,
           payment_installments::INTEGER AS payment_installments, payment_value::DOUBLE AS payment_value
    FROM raw_order_payments
),
stg_order_reviews AS (
    SELECT DISTINCT ON (order_id) review_id, order_id, review_score, review_creation_date
    FROM raw_order_reviews
    ORDER BY order_id, review_creation_date DESC NULLS LAST, review_id DESC NULLS LAST,
             review_score DESC NULLS LAST
),
stg_geolocation AS (
    SELECT geolocation_zip_code_prefix AS zip_code_prefix, avg(geolocation_lat) AS lat, avg(geolocation_lng) AS lng
    FROM raw_geolocation GROUP BY ALL
)"""

GOLD = """
paid AS (
    SELECT order_id, sum(payment_value) AS order_value, max(payment_installments) AS max_installments,
           count(*) AS payment_slices,
           (list(payment_type ORDER BY payment_value DESC, payment_type DESC)
                FILTER (payment_type IS NOT NULL AND payment_value IS NOT NULL))[1] AS primary_payment_type
    FROM stg_order_payments GROUP BY order_id
),
sold AS (
    SELECT order_id,
           (list(seller_id ORDER BY order_item_id, seller_id)
                FILTER (seller_id IS NOT NULL AND order_item_id IS NOT NULL))[1] AS primary_seller_id
    FROM stg_order_items GROUP BY order_id
),
ends AS (
    SELECT o.order_id, radians(shop.lat) AS lat1, radians(home.lat) AS lat2,
           radians((shop.lat - home.lat) / 2) AS half_lat, radians((shop.lng - home.lng) / 2) AS half_lng
    FROM stg_orders AS o
         JOIN sold USING (order_id)
         JOIN stg_customers AS c USING (customer_unique_id)
         JOIN raw_sellers AS s ON s.seller_id = sold.primary_seller_id
         JOIN stg_geolocation AS home ON home.zip_code_prefix = c.customer_zip_code_prefix
         JOIN stg_geolocation AS shop ON shop.zip_code_prefix = s.seller_zip_code_prefix
),
apart AS (
    SELECT order_id, 12742 * asin(sqrt(least(1.0, hav))) AS customer_seller_distance_km
    FROM (SELECT order_id, pow(sin(half_lat), 2) + cos(lat2) * cos(lat1) * pow(sin(half_lng), 2) AS hav FROM ends)
    WHERE hav IS NOT NULL
),
int_orders_enriched AS (
    SELECT order_id, customer_unique_id, customer_state, order_status, order_purchase_ts, order_approved_ts,
           order_delivered_ts, is_cancelled_post_approval, ifnull(order_value, 0) AS order_value,
           primary_payment_type, max_installments, primary_seller_id, review_score,
           (order_status = 'delivered' AND review_score <= 2) IS TRUE AS is_low_review_delivered,
           (order_status = 'delivered' AND review_score IS NULL) IS TRUE AS is_no_review_delivered,
           customer_seller_distance_km
    FROM stg_orders
         LEFT JOIN paid USING (order_id)
         LEFT JOIN sold USING (order_id)
         LEFT JOIN apart USING (order_id)
         LEFT JOIN (SELECT order_id, review_score FROM stg_order_reviews) AS reviewed USING (order_id)
)"""


def _panel(lead: str) -> str:
    """Snapshots of every customer: those from its first order less ``lead`` on."""
    return f"""
spine AS (
    SELECT unnest(range(lo, hi + INTERVAL 1 DAY, INTERVAL 1 MONTH)) AS d
    FROM (SELECT date_trunc('month', min(order_purchase_ts))::TIMESTAMP AS lo,
                 date_trunc('month', max(order_purchase_ts))::TIMESTAMP AS hi FROM stg_orders)
),
panel AS (
    SELECT customer_unique_id, d
    FROM (SELECT customer_unique_id, min(order_purchase_ts) AS since FROM int_orders_enriched GROUP BY ALL) AS born
         JOIN spine ON d + INTERVAL '{lead}' >= since
    WHERE customer_unique_id IS NOT NULL
)"""


def _fct(lead: str = "1 month") -> str:
    """The feature table, one grouped join per window: an order is within n days of
    a snapshot if the snapshot lies between its time and n days later."""
    return _panel(lead) + """,
so_far AS (
    SELECT customer_unique_id, d, max(customer_state) AS customer_state, min(order_purchase_ts) AS first_ts,
           count(*) AS orders, countif(is_cancelled_post_approval) AS cancelled,
           countif(order_status = 'delivered') AS delivered, countif(is_low_review_delivered) AS low_reviews,
           avg(review_score) AS avg_review_score, avg(customer_seller_distance_km) AS avg_km
    FROM int_orders_enriched JOIN spine ON order_purchase_ts <= d GROUP BY ALL
),
month_back AS (
    SELECT customer_unique_id, d, count(*) AS orders, sum(order_value) AS spent,
           countif(is_cancelled_post_approval) AS cancelled, count(DISTINCT customer_state) AS states
    FROM int_orders_enriched JOIN spine ON d BETWEEN order_purchase_ts AND order_purchase_ts + INTERVAL 30 DAY
    GROUP BY customer_unique_id, d
),
week_back AS (
    SELECT customer_unique_id, d, count(*) AS orders, count(DISTINCT primary_seller_id) AS sellers
    FROM int_orders_enriched JOIN spine ON d BETWEEN order_purchase_ts AND order_purchase_ts + INTERVAL 7 DAY
    GROUP BY customer_unique_id, d
),
fct AS (
    SELECT customer_unique_id, d::DATE AS snapshot_date, s.customer_state,
           date_diff('day', s.first_ts::DATE, d::DATE) AS days_since_first_order,
           ifnull(s.orders, 0) AS total_orders_lifetime,
           ifnull(m.orders, 0) AS orders_last_30d,
           ifnull(w.orders, 0) AS orders_last_7d,
           ifnull(w.sellers, 0) AS distinct_sellers_last_7d,
           ifnull(m.spent, 0) AS total_spent_last_30d,
           CASE WHEN s.orders > 0 THEN s.cancelled / s.orders ELSE 0 END AS cancel_rate_lifetime,
           ifnull(m.cancelled, 0) AS cancel_post_approval_count_30d,
           s.avg_review_score,
           CASE WHEN s.delivered > 0 THEN s.low_reviews / s.delivered ELSE 0 END AS low_review_on_delivered_rate,
           s.avg_km AS avg_customer_seller_distance_km,
           ifnull(m.states, 0) AS distinct_shipping_states_30d
    FROM panel
         LEFT JOIN so_far AS s USING (customer_unique_id, d)
         LEFT JOIN month_back AS m USING (customer_unique_id, d)
         LEFT JOIN week_back AS w USING (customer_unique_id, d)
)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n"


# ------------------------------------------------------------------ helpers

def canon(*cols: str) -> str:
    """Canonical projection.  Each item is ``name:kind`` with kind
    s (as is), l (BIGINT), d (round 6), n (nullable integer -> DOUBLE),
    date, ts."""
    out = []
    for item in cols:
        name, kind = item.split(":") if ":" in item else (item, "s")
        expr = {
            "s": name,
            "l": f"CAST({name} AS BIGINT)",
            "d": f"(round(CAST({name} AS DOUBLE) + 1e-9, 6) + 0.0)",
            "n": f"CAST({name} AS DOUBLE)",
            "date": f"strftime(CAST({name} AS DATE), '%Y-%m-%d')",
            "ts": f"strftime(CAST({name} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')",
        }[kind]
        out.append(f"{expr} AS {name}")
    return "SELECT " + ", ".join(out)


def rhu(x: str, digits: int) -> str:
    return f"round({x}, {digits})"


def pct(num: str, den: str, digits: int = 2) -> str:
    return rhu(f"100.0::DOUBLE * {num} / NULLIF({den}, 0)", digits)


def _values(rows) -> str:
    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(float(v)) if isinstance(v, float) else str(v)
    return "VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def seeds_cte() -> str:
    from vantage.functions.fixed import CATEGORY_RISK_PRIORS, PAYMENT_METHOD_RISK, RISK_TIERS
    return f"""
payment_method_risk AS (
    SELECT * FROM ({_values(PAYMENT_METHOD_RISK)}) t(payment_type, base_risk_score, rationale)
),
risk_thresholds AS (
    SELECT * FROM ({_values(RISK_TIERS)}) t(tier, lower_bound_inclusive, upper_bound_exclusive, action)
),
category_risk_priors AS (
    SELECT * FROM ({_values(CATEGORY_RISK_PRIORS)}) t(product_category_name_english, fraud_prior, evidence)
)"""


FCT_COLS = ("customer_unique_id", "snapshot_date:date", "customer_state", "days_since_first_order:n",
            "total_orders_lifetime:l", "orders_last_30d:l", "orders_last_7d:l", "distinct_sellers_last_7d:l",
            "total_spent_last_30d:d", "cancel_rate_lifetime:d", "cancel_post_approval_count_30d:l",
            "avg_review_score:d", "low_review_on_delivered_rate:d", "avg_customer_seller_distance_km:d",
            "distinct_shipping_states_30d:l")

VELOCITY = """
timed AS (
    SELECT order_id, date_diff('microsecond', lag(order_purchase_ts) OVER by_customer, order_purchase_ts) / 3.6e9
               AS hours_since_prev_order
    FROM int_orders_enriched
    WHERE customer_unique_id IS NOT NULL AND order_purchase_ts IS NOT NULL
    WINDOW by_customer AS (PARTITION BY customer_unique_id ORDER BY order_purchase_ts, order_id)
),
velocity_orders AS (
    SELECT e.*, hours_since_prev_order,
           CASE WHEN hours_since_prev_order <> 0 THEN customer_seller_distance_km / hours_since_prev_order END
               AS velocity_kmh,
           date_diff('microsecond', order_purchase_ts, order_approved_ts) / 3.6e9 AS hours_to_approval
    FROM timed JOIN int_orders_enriched AS e USING (order_id)
)"""

EXTENDED = """
so_far_ext AS (
    SELECT customer_unique_id, d, max(order_purchase_ts) AS last_ts, countif(order_status = 'delivered') AS delivered,
           countif(is_no_review_delivered) AS unreviewed, max(velocity_kmh) AS fastest,
           countif(velocity_kmh > 800) AS implausible, avg(hours_to_approval) AS approval
    FROM velocity_orders JOIN spine ON order_purchase_ts <= d GROUP BY ALL
),
hours_back AS (
    SELECT customer_unique_id, d,
           countif(d <= order_purchase_ts + INTERVAL 1 HOUR) AS h1,
           countif(d <= order_purchase_ts + INTERVAL 24 HOUR) AS h24, count(*) AS h168
    FROM velocity_orders JOIN spine ON d BETWEEN order_purchase_ts AND order_purchase_ts + INTERVAL 168 HOUR
    GROUP BY customer_unique_id, d
),
fct_ext AS (
    SELECT customer_unique_id, d::DATE AS snapshot_date,
           ifnull(h.h1, 0) AS orders_last_1h, ifnull(h.h24, 0) AS orders_last_24h, ifnull(h.h168, 0) AS orders_last_168h,
           date_diff('day', s.last_ts::DATE, d::DATE) AS days_since_last_order,
           CASE WHEN s.delivered > 0 THEN s.unreviewed / s.delivered ELSE 0 END AS no_review_on_delivered_rate,
           s.fastest AS max_geographic_velocity_kmh,
           ifnull(s.implausible, 0) AS implausible_velocity_orders,
           s.approval AS avg_hours_purchase_to_approval
    FROM panel
         LEFT JOIN so_far_ext AS s USING (customer_unique_id, d)
         LEFT JOIN hours_back AS h USING (customer_unique_id, d)
)"""

EVENTS = """
e_spine AS (
    SELECT unnest(range(min(ts)::DATE::TIMESTAMP, max(ts)::DATE + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM events
),
e_panel AS (
    SELECT user_id, d FROM (SELECT user_id, min(ts) AS since FROM events GROUP BY ALL) JOIN e_spine
        ON d + INTERVAL 1 DAY >= since
    WHERE user_id IS NOT NULL
),
e_so_far AS (
    SELECT user_id, d, count(*) AS n, countif(event_type = 'purchase') AS purchases, countif(event_type = 'error') AS errors,
           avg(value) AS avg_value, min(ts) AS first_ts, max(ts) AS last_ts
    FROM events JOIN e_spine ON ts <= d GROUP BY ALL
),
e_back AS (
    SELECT user_id, d, countif(d <= ts + INTERVAL 24 HOUR) AS n_24h, countif(d <= ts + INTERVAL 7 DAY) AS n_7d,
           sum(value) FILTER (d <= ts + INTERVAL 7 DAY) AS value_7d,
           count(DISTINCT event_type) FILTER (d <= ts + INTERVAL 7 DAY) AS types_7d, max(value) AS max_30d
    FROM events JOIN e_spine ON d BETWEEN ts AND ts + INTERVAL 30 DAY GROUP BY user_id, d
),
e_fct AS (
    SELECT user_id, d::DATE AS snapshot_date, ifnull(s.n, 0) AS events_lifetime, ifnull(b.n_24h, 0) AS events_last_24h,
           ifnull(b.n_7d, 0) AS events_last_7d, ifnull(b.value_7d, 0) AS value_last_7d,
           ifnull(b.types_7d, 0) AS distinct_event_types_7d, ifnull(s.purchases, 0) AS purchases_lifetime,
           CASE WHEN s.n > 0 THEN s.errors / s.n ELSE 0 END AS error_rate_lifetime,
           s.avg_value AS avg_value_lifetime, b.max_30d AS max_value_30d,
           date_diff('day', s.first_ts::DATE, d::DATE) AS days_since_first_event,
           date_diff('day', s.last_ts::DATE, d::DATE) AS days_since_last_event
    FROM e_panel LEFT JOIN e_so_far AS s USING (user_id, d) LEFT JOIN e_back AS b USING (user_id, d)
)"""


def _dq_sql(check, table_sql) -> str:
    t = table_sql[check.table]
    if check.kind == "not_null":
        body = f"SELECT count(*) FROM {t} WHERE {check.column} IS NULL"
    elif check.kind == "accepted_values":
        vals = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in check.values)
        body = f"SELECT count(*) FROM {t} WHERE {check.column} IS NOT NULL AND {check.column} NOT IN ({vals})"
    elif check.kind == "expression_is_true":
        body = f"SELECT count(*) FROM {t} WHERE NOT ({check.column} {check.expression})"
    elif check.kind == "unique":
        body = (f"SELECT count(*) FROM (SELECT {check.column} FROM {t} WHERE {check.column} IS NOT NULL "
                f"GROUP BY {check.column} HAVING count(*) > 1) g")
    elif check.kind == "unique_combination":
        cols = ", ".join(check.columns)
        body = f"SELECT count(*) FROM (SELECT {cols} FROM {t} GROUP BY {cols} HAVING count(*) > 1) g"
    elif check.kind == "relationships":
        p = table_sql[check.parent]
        body = (f"SELECT count(*) FROM {t} c WHERE c.{check.column} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {p} p WHERE p.{check.parent_field} = c.{check.column})")
    else:
        raise ValueError(check.kind)
    return (f"SELECT '{check.check_name}' AS check_name, '{check.table}' AS table_name, "
            f"'{check.kind}' AS kind, '{check.severity}' AS severity, CAST(({body}) AS BIGINT) AS failures")


LAYER_TABLES = {
    "bronze": {n: f"raw_{n}" for n in ("orders", "customers", "order_items", "order_payments",
                                       "order_reviews", "sellers", "geolocation", "products",
                                       "category_translation")},
    "silver": {n: n for n in ("stg_orders", "stg_customers", "stg_order_items", "stg_order_payments",
                              "stg_order_reviews", "stg_geolocation")},
    "gold": {"int_orders_enriched": "int_orders_enriched", "fct_customer_return_risk_features": "fct"},
    "seeds": {n: n for n in ("payment_method_risk", "risk_thresholds", "category_risk_priors")},
}


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    base = with_ctes(RAW, SILVER, GOLD)
    with_fct = with_ctes(RAW, SILVER, GOLD, _fct("1 month"))
    q["pit_customer_features"] = with_fct + canon(*FCT_COLS) + " FROM fct"
    q["pit_customer_features_strict"] = with_ctes(RAW, SILVER, GOLD, _fct("0 days")) + canon(*FCT_COLS) + " FROM fct"

    q["pit_customer_features_review_dated"] = with_ctes(RAW, SILVER, GOLD, _fct("1 month"), """
written AS (
    SELECT customer_unique_id, d, avg(e.review_score) AS avg_review_score, countif(is_low_review_delivered) AS low_reviews
    FROM int_orders_enriched AS e
         JOIN stg_order_reviews AS r USING (order_id)
         JOIN spine ON d >= greatest(order_purchase_ts, review_creation_date::TIMESTAMP)
    GROUP BY ALL
),
dated AS (
    SELECT f.* REPLACE (
               w.avg_review_score AS avg_review_score,
               CASE WHEN s.delivered > 0 THEN ifnull(w.low_reviews, 0) / s.delivered ELSE 0 END
                   AS low_review_on_delivered_rate)
    FROM fct AS f
         LEFT JOIN so_far AS s ON s.customer_unique_id = f.customer_unique_id AND s.d = f.snapshot_date
         LEFT JOIN written AS w ON w.customer_unique_id = f.customer_unique_id AND w.d = f.snapshot_date
)""") + canon(*FCT_COLS) + " FROM dated"

    q["month_spine"] = with_fct + canon("snapshot_date:date") + " FROM (SELECT d AS snapshot_date FROM spine)"
    q["eligible_customer_months"] = with_fct + canon("customer_unique_id", "snapshot_date:date") + " FROM (SELECT customer_unique_id, d AS snapshot_date FROM panel)"

    q["stg_orders"] = base + canon("order_id:l", "customer_unique_id:l", "customer_id:l", "customer_state",
                                   "customer_zip_code_prefix", "order_status", "order_purchase_ts:ts",
                                   "order_approved_ts:ts", "order_delivered_ts:ts",
                                   "is_cancelled_post_approval") + " FROM stg_orders"
    q["customer_current_row"] = base + canon("customer_unique_id:l", "customer_state",
                                             "customer_zip_code_prefix") + " FROM stg_customers"
    q["stg_order_reviews"] = base + canon("review_id", "order_id:l", "review_score:l",
                                          "review_creation_date:date") + " FROM stg_order_reviews"
    q["stg_order_items"] = base + canon("order_id:l", "order_item_id:l", "product_id:l", "seller_id:l",
                                        "price:d", "freight_value:d") + " FROM stg_order_items"
    q["stg_order_payments"] = base + canon("order_id:l", "payment_sequential:l", "payment_type",
                                           "payment_installments:l", "payment_value:d") + " FROM stg_order_payments"
    q["region_centroid"] = base + canon("zip_code_prefix", "lat:d", "lng:d") + " FROM stg_geolocation"
    q["items_keep_first"] = base + "SELECT DISTINCT ON (order_id, order_item_id) " + canon(
        "order_id:l", "order_item_id:l", "product_id:l", "seller_id:l", "shipping_limit_date:ts", "price:d",
        "freight_value:d").removeprefix("SELECT ") + """
        FROM raw_order_items AS i
        ORDER BY i.order_id, i.order_item_id, i.shipping_limit_date NULLS LAST, i.seller_id NULLS LAST,
                 i.product_id NULLS LAST, i.price NULLS LAST, i.freight_value NULLS LAST"""
    q["latest_event_per_user"] = "SELECT DISTINCT ON (user_id) " + canon(
        "user_id:l", "event_id:l", "ts:ts", "event_type", "value:d").removeprefix("SELECT ") + """
        FROM events AS e ORDER BY e.user_id, e.ts DESC NULLS LAST, e.event_id DESC NULLS LAST"""
    q["payments_per_order"] = base + canon("order_id:l", "order_value:d", "max_installments:l",
                                           "payment_slices:l", "primary_payment_type") + " FROM paid"
    q["primary_seller"] = base + canon("order_id:l", "primary_seller_id:l") + " FROM sold"
    q["orders_enriched"] = base + canon(
        "order_id:l", "customer_unique_id:l", "customer_state", "order_status", "order_purchase_ts:ts",
        "order_approved_ts:ts", "order_delivered_ts:ts", "is_cancelled_post_approval", "order_value:d",
        "primary_payment_type", "max_installments:n", "primary_seller_id:n", "review_score:n",
        "is_low_review_delivered", "is_no_review_delivered", "customer_seller_distance_km:d"
    ) + " FROM int_orders_enriched"
    q["customer_seller_distance"] = base + canon("order_id:l", "customer_unique_id:l", "primary_seller_id:n",
                                                 "customer_seller_distance_km:d") + " FROM int_orders_enriched"

    vel = with_ctes(RAW, SILVER, GOLD, VELOCITY)
    q["order_velocity"] = vel + canon("order_id:l", "customer_unique_id:l", "order_purchase_ts:ts",
                                      "hours_since_prev_order:d", "velocity_kmh:d") + " FROM velocity_orders"
    q["pit_customer_features_extended"] = with_ctes(RAW, SILVER, GOLD, _fct("1 month"), VELOCITY, EXTENDED) + canon(
        "customer_unique_id:l", "snapshot_date:date", "orders_last_1h:l", "orders_last_24h:l", "orders_last_168h:l",
        "days_since_last_order:n",
        "no_review_on_delivered_rate:d", "max_geographic_velocity_kmh:d", "implausible_velocity_orders:l",
        "avg_hours_purchase_to_approval:d") + " FROM fct_ext"
    q["pit_event_features"] = with_ctes(EVENTS) + canon(
        "user_id:l", "snapshot_date:date", "events_lifetime:l", "events_last_24h:l", "events_last_7d:l",
        "value_last_7d:d", "distinct_event_types_7d:l", "purchases_lifetime:l", "error_rate_lifetime:d",
        "avg_value_lifetime:d", "max_value_30d:d", "days_since_first_event:n",
        "days_since_last_event:n") + " FROM e_fct"

    with_seeds = with_ctes(RAW, SILVER, GOLD, seeds_cte())
    q["payment_risk"] = with_seeds + canon("primary_payment_type", "order_id:l",
                                           "payment_method_risk_score:d") + """
        FROM (SELECT order_id, primary_payment_type,
                     (SELECT base_risk_score FROM payment_method_risk WHERE payment_type = primary_payment_type)
                         AS payment_method_risk_score
              FROM int_orders_enriched)"""
    q["payment_risk_from_file"] = with_seeds + canon("primary_payment_type", "order_id:l",
                                                     "payment_method_risk_score:d") + """
        FROM (SELECT order_id, primary_payment_type,
                     (SELECT base_risk_score + 0.05 FROM payment_method_risk
                      WHERE payment_type = primary_payment_type AND payment_type <> 'boleto') AS payment_method_risk_score
              FROM int_orders_enriched)"""
    q["category_prior"] = with_seeds + canon("order_id:l", "items:l", "items_with_prior:l",
                                             "max_category_prior:d", "avg_category_prior:d") + """
        FROM (SELECT order_id, count(*) AS items, count(fraud_prior) AS items_with_prior,
                     max(fraud_prior) AS max_category_prior, avg(fraud_prior) AS avg_category_prior
              FROM stg_order_items
                   LEFT JOIN raw_products USING (product_id)
                   LEFT JOIN raw_category_translation USING (product_category_name)
                   LEFT JOIN category_risk_priors USING (product_category_name_english)
              GROUP BY order_id)"""
    q["score_tier"] = with_ctes(seeds_cte()) + canon("s_suppkey:l", "risk_score:d", "tier", "action",
                                                      "tier_label") + """
        FROM (SELECT s.s_suppkey, s.risk_score, t.tier, t.action,
                     CASE WHEN s.risk_score IS NULL THEN NULL
                          WHEN s.risk_score < 0.30 THEN 'low'
                          WHEN s.risk_score < 0.60 THEN 'medium'
                          WHEN s.risk_score < 0.85 THEN 'high'
                          ELSE 'critical' END AS tier_label
              FROM (SELECT s_suppkey, (s_acctbal + 1000.0) / 11000.0 AS risk_score FROM supplier) s
              LEFT JOIN risk_thresholds t
                     ON s.risk_score >= t.lower_bound_inclusive AND s.risk_score < t.upper_bound_exclusive) x"""

    q["price_bands"] = canon("band:l", "items:l", "orders:l", "top_price:d") + """
        FROM (SELECT coalesce(p_partkey, -1) AS band, count(*) AS items, count(DISTINCT l_orderkey) AS orders,
                     max(price) AS top_price
              FROM (SELECT l_orderkey, CASE WHEN l_orderkey % 3 = 0 THEN 5000.0 + l_discount ELSE l_extendedprice END AS price
                    FROM lineitem) i
              LEFT JOIN (SELECT p_partkey, 1000.0 + p_partkey % 2000 * 50 + p_partkey % 7 AS low, p_size FROM part) b
                     ON price >= low AND price < low + p_size
              GROUP BY 1) x"""

    owm = """
owm AS (
    SELECT raw_orders.*, ifnull(seller::VARCHAR, 'unknown_merchant') AS merchant_id,
           strftime(order_purchase_timestamp, '%Y-%m') AS partition_month
    FROM raw_orders LEFT JOIN (
        SELECT DISTINCT ON (order_id) order_id, seller_id AS seller FROM raw_order_items
        ORDER BY order_id, order_item_id NULLS LAST, seller_id NULLS LAST) AS opening USING (order_id)
)"""
    q["orders_with_merchant"] = with_ctes(RAW, owm) + canon(
        "order_id:l", "customer_id:l", "order_status", "order_purchase_timestamp:ts", "order_approved_at:ts",
        "order_delivered_carrier_date:ts", "order_delivered_customer_date:ts",
        "order_estimated_delivery_date:ts", "merchant_id", "partition_month") + " FROM owm"
    q["partitioned_roundtrip"] = with_ctes(RAW, owm) + canon("partition_month", "row_count:l", "merchants:l") + """
        FROM (SELECT partition_month, count(*) AS row_count, count(DISTINCT merchant_id) AS merchants
              FROM owm GROUP BY 1) x"""

    q["cancel_rate_by_state"] = with_ctes(RAW) + canon("customer_state", "total_orders:l", "canceled:l",
                                                       "cancel_rate_pct:d") + f"""
        FROM (SELECT *, {pct('canceled', 'total_orders')} AS cancel_rate_pct
              FROM (SELECT customer_state, count(*) AS total_orders, countif(order_status = 'canceled') AS canceled
                    FROM raw_customers JOIN raw_orders USING (customer_id) GROUP BY ALL)
              QUALIFY row_number() OVER (ORDER BY cancel_rate_pct DESC NULLS LAST, customer_state NULLS LAST) <= 20)"""
    q["low_review_on_delivered"] = with_ctes(RAW) + canon("delivered_orders:l", "low_review:l",
                                                          "inr_proxy_rate_pct:d") + f"""
        FROM (SELECT *, {pct('low_review', 'delivered_orders')} AS inr_proxy_rate_pct
              FROM (SELECT count(*) AS delivered_orders, countif(review_score <= 2) AS low_review
                    FROM raw_order_reviews JOIN raw_orders USING (order_id) WHERE order_status = 'delivered'))"""

    newest = "(SELECT * FROM fct QUALIFY snapshot_date = max(snapshot_date) OVER ())"
    q["top_risky_customers"] = with_fct + canon(
        "customer_unique_id:l", "customer_state", "total_orders_lifetime:l", "orders_last_30d:l",
        "cancel_rate:d", "cancel_30d:l", "avg_review:d", "low_review_rate:d", "avg_dist_km:d",
        "states_30d:l") + f"""
        FROM (SELECT *, {rhu('cancel_rate_lifetime', 3)} AS cancel_rate, cancel_post_approval_count_30d AS cancel_30d,
                     {rhu('avg_review_score', 2)} AS avg_review,
                     {rhu('low_review_on_delivered_rate', 3)} AS low_review_rate,
                     {rhu('avg_customer_seller_distance_km', 0)} AS avg_dist_km,
                     distinct_shipping_states_30d AS states_30d
              FROM {newest} WHERE total_orders_lifetime > 1
              QUALIFY row_number() OVER (
                  ORDER BY cancel_rate_lifetime + low_review_on_delivered_rate DESC NULLS LAST,
                           total_orders_lifetime DESC, customer_unique_id) <= 50)"""
    q["risk_distribution"] = with_fct + canon("cancel_rate_lifetime:d", "low_review_on_delivered_rate:d",
                                              "total_orders_lifetime:l") + f"""
        FROM {newest} WHERE total_orders_lifetime > 0"""
    q["feature_store_summary"] = with_fct + canon(
        "total_rows:l", "unique_customers:l", "snapshots:l", "first_snapshot:date", "last_snapshot:date",
        "avg_cancel_rate:d", "avg_low_review_rate:d") + f"""
        FROM (SELECT count(*) AS total_rows, count(DISTINCT customer_unique_id) AS unique_customers,
                     count(DISTINCT snapshot_date) AS snapshots, min(snapshot_date) AS first_snapshot,
                     max(snapshot_date) AS last_snapshot,
                     {rhu('avg(cancel_rate_lifetime)', 4)} AS avg_cancel_rate,
                     {rhu('avg(low_review_on_delivered_rate)', 4)} AS avg_low_review_rate
              FROM fct)"""
    q["orders_overview"] = base + canon("total_orders:l", "unique_customers:l", "cancel_post_approval:l",
                                        "pct_cancel_post_approval:d", "first_order_ts:ts",
                                        "last_order_ts:ts") + f"""
        FROM (SELECT count(*) AS total_orders, count(DISTINCT customer_unique_id) AS unique_customers,
                     countif(is_cancelled_post_approval) AS cancel_post_approval,
                     {pct('countif(is_cancelled_post_approval)', 'count(*)')} AS pct_cancel_post_approval,
                     min(order_purchase_ts) AS first_order_ts, max(order_purchase_ts) AS last_order_ts
              FROM stg_orders)"""

    everything = with_ctes(RAW, SILVER, GOLD, _fct("1 month"), seeds_cte())
    counts = " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, (SELECT count(*) FROM {cte}) AS row_count"
        for layer, tables in LAYER_TABLES.items() for name, cte in tables.items())
    q["layer_row_counts"] = everything + canon("layer", "table_name", "row_count:l") + f" FROM ({counts}) x"
    raw_counts = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {cte}) AS row_count"
        for name, cte in LAYER_TABLES["bronze"].items())
    q["load_audit"] = with_ctes(RAW) + canon("table_name", "row_count:l") + f" FROM ({raw_counts}) x"

    q["dq_not_null"] = base + canon("order_id:l", "customer_unique_id:l", "customer_id:l", "customer_state",
                                    "customer_zip_code_prefix", "order_status", "order_purchase_ts:ts",
                                    "order_approved_ts:ts", "order_delivered_ts:ts",
                                    "is_cancelled_post_approval") + " FROM stg_orders WHERE order_approved_ts IS NULL"
    q["dq_store_failures"] = q["dq_not_null"]
    q["dq_unique"] = with_ctes(RAW) + canon("order_id:l", "n:l") + """
        FROM (SELECT order_id, count(*) AS n FROM raw_order_reviews WHERE order_id IS NOT NULL
              GROUP BY order_id HAVING count(*) > 1) x"""
    q["dq_accepted_values"] = with_ctes(RAW) + canon("order_id:l", "payment_sequential:l", "payment_type",
                                                     "payment_installments:l", "payment_value:d") + """
        FROM raw_order_payments
        WHERE payment_type IS NOT NULL AND payment_type NOT IN ('credit_card', 'debit_card', 'boleto')"""
    q["dq_relationships"] = with_ctes(RAW) + canon("review_id", "order_id:l", "review_score:l",
                                                   "review_comment_title", "review_comment_message",
                                                   "review_creation_date:date", "review_answer_timestamp:ts") + """
        FROM raw_order_reviews c
        WHERE c.order_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM raw_orders p WHERE p.order_id = c.order_id)"""
    q["dq_expression"] = base + canon("order_id:l", "customer_seller_distance_km:d") + """
        FROM int_orders_enriched WHERE NOT (customer_seller_distance_km < 5000)"""
    q["dq_unique_combination"] = with_ctes(RAW) + canon("order_id:l", "order_item_id:l", "n:l") + """
        FROM (SELECT order_id, order_item_id, count(*) AS n FROM raw_order_items
              GROUP BY order_id, order_item_id HAVING count(*) > 1) x"""

    from vantage.plans.suites import bronze_suite, gold_suite, seed_suite, silver_suite
    table_sql = {n: cte for tables in LAYER_TABLES.values() for n, cte in tables.items()}
    parts = " UNION ALL ".join(_dq_sql(c, table_sql)
                               for c in bronze_suite() + silver_suite() + gold_suite() + seed_suite())
    q["dq_report"] = everything + canon("check_name", "table_name", "kind", "severity", "failures:l",
                                        "status", "message", "timed") + f"""
        FROM (SELECT *, true AS timed, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'error' THEN 'error'
                             ELSE 'warn' END AS status,
                     CASE WHEN failures > 0 THEN 'got ' || failures || ' failing rows' END AS message
              FROM ({parts}) r) x"""

    silver_checks = " UNION ALL ".join(_dq_sql(c, table_sql) for c in bronze_suite() + silver_suite())
    q["gate_verdict"] = base + f"""
        SELECT check_name, table_name, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'error' THEN 'error'
                                            ELSE 'warn' END AS status,
               CASE WHEN failures > 0 THEN 'got ' || failures || ' failing rows' ELSE '' END AS message,
               true AS timed, failures > 0 AS stops
        FROM ({silver_checks})"""
    q["partition_audit"] = with_ctes(RAW, owm) + """
        SELECT partition_month, count(*) AS row_count, true AS has_files FROM owm
        WHERE partition_month <> '1995-03' OR order_status = 'canceled' GROUP BY ALL"""
    stamp = "'2026-01-01T00:00:00+00:00' AS _loaded_at, 'part' AS _source_file"
    text = lambda c: f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"
    q["csv_load"] = with_ctes(RAW) + f"""
        SELECT order_id::VARCHAR AS order_id, customer_id::VARCHAR AS customer_id, order_status,
               {text('order_purchase_timestamp')}, {text('order_approved_at')}, {text('order_delivered_carrier_date')},
               {text('order_delivered_customer_date')}, {text('order_estimated_delivery_date')}, {stamp}
        FROM raw_orders"""
    q["table_replaced"] = with_ctes(RAW) + canon("reader", "order_status", "orders:l", "customers:l") + """
        FROM (SELECT 'early' AS reader, order_status, count(*) AS orders, sum(customer_id) AS customers
              FROM raw_orders WHERE order_status <> 'delivered' GROUP BY ALL
              UNION ALL
              SELECT 'now', order_status, count(*), sum(customer_id) FROM raw_orders WHERE order_id % 3 <> 0 GROUP BY ALL) x"""
    q["landed_orders"] = with_ctes(RAW) + f"""
        SELECT order_id::VARCHAR AS order_id, customer_id::VARCHAR AS customer_id, order_status,
               {text('order_purchase_timestamp')}, {text('order_approved_at')}, {text('order_delivered_carrier_date')},
               {text('order_delivered_customer_date')}, {text('order_estimated_delivery_date')}, 'orders' AS event_type,
               '2026-01-01T00:00:00+00:00' AS _loaded_at, 'part' AS _source_file
        FROM raw_orders"""
    q["partitions_synced"] = with_ctes(RAW, owm) + """
        SELECT partition_month, CASE partition_month WHEN '1996-02' THEN 'removed' WHEN '1997-01' THEN 'added' ELSE 'kept' END AS change,
               CASE WHEN partition_month = '1996-02' THEN 0 ELSE count(*) END AS row_count
        FROM owm GROUP BY partition_month"""
    q["catalog_schemas"] = with_ctes(RAW) + """
        SELECT order_status AS table_schema, count(*) AS orders FROM raw_orders GROUP BY 1"""
    q["csv_load_reviews"] = with_ctes(RAW) + f"""
        SELECT review_id, order_id::VARCHAR AS order_id, review_score::BIGINT AS review_score, review_comment_title,
               review_comment_message || chr(10) || '"' || review_id || '", again' AS review_comment_message,
               strftime(review_creation_date, '%Y-%m-%d') AS review_creation_date, {text('review_answer_timestamp')}, {stamp}
        FROM raw_order_reviews"""

    q["typed_try_cast"] = canon("event_id:l", "ts_second:ts", "props_k:n", "event_type_as_int:n",
                                "value_as_int:n", "event_date:date") + """
        FROM (SELECT event_id,
                     TRY_CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS ts_second,
                     TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS props_k,
                     TRY_CAST(event_type AS INTEGER) AS event_type_as_int,
                     CAST(round_even(value, 0) AS INTEGER) AS value_as_int,
                     TRY_CAST(strftime(ts, '%Y-%m-%d') AS DATE) AS event_date
              FROM events) x"""
    q["nested_results"] = canon("test_name", "status", "execution_time:d", "message") + """
        FROM (SELECT string_split(unique_id, '.')[-1] AS test_name,
                     coalesce(status, 'unknown') AS status,
                     round(coalesce(execution_time, 0.0), 3) AS execution_time,
                     substring(coalesce(message, ''), 1, 200) AS message
              FROM (SELECT (CASE WHEN event_type IN ('error', 'click') THEN 'test.' ELSE 'model.' END)
                               || 'vantage.' || event_type || '_' || CAST(event_id AS VARCHAR) AS unique_id,
                           CASE WHEN event_type = 'error' THEN 'fail' ELSE 'pass' END AS status,
                           value AS execution_time,
                           CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 <> 0
                                THEN 'k=' || json_extract_string(props, '$.k') END AS message
                    FROM events) f
              WHERE starts_with(unique_id, 'test.')) x"""
    q["incremental_ingest"] = with_ctes(RAW) + canon(
        "order_id:l", "customer_id:l", "order_status", "order_purchase_timestamp:ts", "order_approved_at:ts",
        "order_delivered_carrier_date:ts", "order_delivered_customer_date:ts",
        "order_estimated_delivery_date:ts") + " FROM raw_orders"
    q["ingest_upsert"] = with_ctes(RAW) + canon(
        "order_id:l", "customer_id:l", "order_status", "order_purchase_timestamp:ts", "order_approved_at:ts",
        "order_delivered_carrier_date:ts", "order_delivered_customer_date:ts",
        "order_estimated_delivery_date:ts", "_source_file") + """
        FROM (SELECT * REPLACE (CASE WHEN order_id % 4 = 1 AND order_status = 'processing' THEN 'shipped'
                                     ELSE order_status END AS order_status),
                     'orders-' || order_id % 4 || '.csv' AS _source_file
              FROM raw_orders WHERE order_id % 4 > 1 OR (order_id % 4 = 1 AND order_status <> 'canceled')) x"""
    return q
