"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark code.  The fixture CTEs
derive the analytic inputs from the driver tables exactly as FIXTURES.md
describes.
"""
from __future__ import annotations

SQL: dict[str, str] = {}

USER_EVENTS = """user_events AS (
  SELECT event_id, user_id, ts,
         CASE WHEN event_id % 10 = 0 THEN 'smart_tv'
              WHEN event_id % 10 <= 2 THEN 'tablet'
              WHEN event_id % 10 <= 5 THEN 'desktop'
              ELSE 'mobile' END AS device_type,
         event_type AS action_type,
         value AS session_duration_minutes
  FROM events)"""

STAR = """app_customers AS (
  SELECT c_custkey AS customer_id,
         lower(c_name) || '@example.com' AS email,
         DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS registration_date,
         n_name AS country, c_mktsegment AS tier
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
app_products AS (
  SELECT p_partkey AS product_id, p_name AS name, p_type AS category,
         p_retailprice AS price, p_size AS stock_quantity FROM part),
app_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
         o_orderstatus AS status, o_totalprice AS total_amount FROM orders),
app_order_items AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS line_number,
         CAST(l_quantity AS INTEGER) AS quantity,
         l_extendedprice / nullif(l_quantity, 0) AS price FROM lineitem)"""

RETAIL = """retail_lines AS (
  SELECT CASE WHEN l_returnflag = 'R' AND l_linenumber % 2 = 0 THEN 'C' ELSE '' END
           || CASE WHEN length(CAST(o_orderkey AS VARCHAR)) >= 6 THEN CAST(o_orderkey AS VARCHAR)
                   ELSE lpad(CAST(o_orderkey AS VARCHAR), 6, '0') END AS invoice,
         CASE WHEN p_size = 1 THEN 'POST'
              ELSE lpad(CAST(p_partkey % 100000 AS VARCHAR), 5, '0')
                   || CASE WHEN p_size % 5 = 0 THEN 'A' ELSE '' END END AS stock_code,
         p_name AS description,
         CASE WHEN l_returnflag = 'R' AND l_linenumber % 2 = 0 THEN -CAST(l_quantity AS INTEGER)
              ELSE CAST(l_quantity AS INTEGER) END AS quantity,
         o_orderdate AS invoice_date,
         CASE WHEN l_linenumber = 7 AND l_discount = 0 THEN 0.0 ELSE p_retailprice END AS price,
         CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_custkey END AS customer_id,
         n_name AS country
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN part ON l_partkey = p_partkey
       JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey)"""

AB_UNITS = """ab_units AS (
  SELECT o_orderpriority AS experiment_id, o_orderkey AS row_id, o_custkey AS user_id,
         o_orderdate AS ts,
         CASE WHEN o_custkey % 2 = 0 THEN 'control' ELSE 'treatment' END AS grp,
         CASE WHEN (o_custkey % 2 = 0) <> (o_orderkey % 50 = 0) THEN 'old_page' ELSE 'new_page' END
           AS landing_page,
         CAST(o_orderstatus = 'F' AS INTEGER) AS converted
  FROM orders)"""

CAMPAIGN = """campaign_daily AS (
  SELECT CASE WHEN user_id % 2 = 0 THEN 'control' ELSE 'test' END AS arm,
         CAST(ts AS DATE) AS date,
         sum(value) AS spend, count(*) AS impressions,
         count(*) FILTER (WHERE event_type IN ('click', 'purchase')) AS clicks,
         count(*) FILTER (WHERE event_type = 'view') AS view_content,
         count(*) FILTER (WHERE event_type = 'signup') AS add_to_cart,
         count(*) FILTER (WHERE event_type = 'purchase') AS purchases
  FROM events GROUP BY 1, 2)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def sql(name: str):
    def deco(fn):
        SQL[name] = fn()
        return fn
    return deco


# ---------------------------------------------------------------- customers --

_MART = """per_customer AS (
  SELECT customer_id, count(DISTINCT order_id) AS n_orders, sum(total_amount) AS spent, avg(total_amount) AS mean_order,
         min(order_date) AS first_day, max(order_date) AS last_day
  FROM {orders} GROUP BY customer_id),
spend AS (
  SELECT customer_id, category, sum(quantity * app_order_items.price) AS amount
  FROM {orders} JOIN app_order_items USING (order_id) JOIN app_products USING (product_id)
  GROUP BY ALL),
favourite AS (
  SELECT customer_id, first(category ORDER BY amount DESC NULLS LAST, category) AS category FROM spend GROUP BY customer_id)
SELECT customer_id, email, tier, country, CAST(registration_date AS TIMESTAMP) AS registration_date,
       coalesce(n_orders, 0) AS total_orders, round(coalesce(spent, 0), 2) AS lifetime_value,
       CAST(first_day AS TIMESTAMP) AS first_order_date, CAST(last_day AS TIMESTAMP) AS last_order_date,
       round(mean_order, 6) AS avg_order_value, f.category AS favorite_category,
       DATE '2002-01-01' - registration_date AS days_since_registration,
       CAST(last_day - first_day AS DOUBLE) AS customer_lifespan_days,
       CASE WHEN n_orders IS NULL OR n_orders = 0 THEN 'inactive' WHEN n_orders < 5 THEN 'occasional'
            WHEN n_orders < 15 THEN 'regular' ELSE 'vip' END AS customer_segment
FROM app_customers LEFT JOIN per_customer USING (customer_id) LEFT JOIN favourite f USING (customer_id)"""


@sql("customer_analytics")
def _():
    return with_(STAR, _MART.format(orders="app_orders"))


@sql("customer_analytics_since_2000")
def _():
    recent = "recent_orders AS (SELECT * FROM app_orders WHERE order_date >= DATE '2000-01-01')"
    return with_(STAR, recent, _MART.format(orders="recent_orders"))


@sql("revenue_by_customer")
def _():
    return with_(STAR) + """
SELECT c.customer_id, c.country, c.tier, count(o.order_id) AS order_count,
       round(sum(o.total_amount), 2) AS revenue
FROM app_customers c JOIN app_orders o ON c.customer_id = o.customer_id
GROUP BY c.customer_id, c.country, c.tier
ORDER BY sum(o.total_amount) DESC, c.customer_id
LIMIT 20"""


@sql("favorite_category")
def _():
    return with_(STAR) + """,
spend AS (
  SELECT o.customer_id, p.category, sum(oi.quantity * oi.price) AS s
  FROM app_order_items oi JOIN app_orders o ON oi.order_id = o.order_id
       JOIN app_products p ON oi.product_id = p.product_id
  GROUP BY 1, 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY s DESC NULLS LAST, category) AS rk,
         max(s) OVER (PARTITION BY customer_id) AS mx
  FROM spend)
SELECT customer_id, category AS favorite_category, round(mx, 2) AS favorite_category_spend
FROM ranked WHERE rk = 1"""


# ------------------------------------------------------------------- events --

@sql("hourly_metrics")
def _():
    return with_(USER_EVENTS) + """,
per_device AS (
  SELECT date_trunc('hour', ts) AS hour, device_type, count(*) AS n
  FROM user_events GROUP BY 1, 2),
modal AS (
  SELECT hour, device_type FROM (
    SELECT *, row_number() OVER (PARTITION BY hour ORDER BY n DESC, device_type) AS rk FROM per_device)
  WHERE rk = 1)
SELECT date_trunc('hour', e.ts) AS hour, count(*) AS session_count,
       count(DISTINCT e.user_id) AS unique_users,
       round(avg(e.session_duration_minutes), 6) AS avg_session_duration,
       any_value(m.device_type) AS most_popular_device
FROM user_events e JOIN modal m ON date_trunc('hour', e.ts) = m.hour
GROUP BY 1"""


_RANK = """
SELECT event_id, user_id, device_type, round(session_duration_minutes, 6) AS session_duration_minutes,
       row_number() OVER longest AS session_rank
FROM user_events WHERE action_type = 'view'
WINDOW longest AS (PARTITION BY device_type ORDER BY session_duration_minutes DESC, event_id {frame})
QUALIFY session_rank <= 10"""


@sql("pipeline_summary")
def _():
    return """
SELECT count(*) AS rows_in, count(DISTINCT date_trunc('hour', ts)) AS rows_out, min(ts) AS first_event, max(ts) AS last_event
FROM events"""


@sql("session_rank_ansi")
def _():
    return with_(USER_EVENTS) + _RANK.format(frame="")


@sql("session_rank_rows_frame")
def _():
    return with_(USER_EVENTS) + _RANK.format(frame="ROWS UNBOUNDED PRECEDING")


@sql("session_rank_full")
def _():
    return with_(USER_EVENTS) + """
SELECT event_id, user_id, device_type, round(session_duration_minutes, 6) AS session_duration_minutes,
       row_number() OVER (PARTITION BY device_type ORDER BY session_duration_minutes DESC, event_id)
         AS row_number,
       rank() OVER (PARTITION BY device_type ORDER BY session_duration_minutes DESC) AS rank,
       dense_rank() OVER (PARTITION BY device_type ORDER BY session_duration_minutes DESC) AS dense_rank
FROM user_events WHERE action_type = 'view'"""


@sql("hourly_metrics_stream")
def _():
    """The hours whose end the watermark (one hour behind the newest event) has reached."""
    return with_(USER_EVENTS) + """,
counts AS (
  SELECT date_trunc('hour', ts) AS hour, device_type, count(*) AS n FROM user_events GROUP BY 1, 2),
modal AS (SELECT hour, device_type FROM counts QUALIFY row_number() OVER (PARTITION BY hour ORDER BY n DESC, device_type) = 1)
SELECT m.hour, count(*) AS session_count, count(DISTINCT e.user_id) AS unique_users,
       round(avg(e.session_duration_minutes), 6) AS avg_session_duration, any_value(m.device_type) AS most_popular_device
FROM user_events e JOIN modal m ON date_trunc('hour', e.ts) = m.hour
WHERE m.hour + INTERVAL 2 HOUR <= (SELECT date_trunc('millisecond', max(ts)) FROM user_events)
GROUP BY m.hour"""


@sql("hourly_metrics_export")
def _():
    return with_(USER_EVENTS) + """,
per_device AS (
  SELECT date_trunc('hour', ts) AS hour, device_type, count(*) AS n FROM user_events GROUP BY 1, 2),
modal AS (
  SELECT hour, device_type FROM (
    SELECT *, row_number() OVER (PARTITION BY hour ORDER BY n DESC, device_type) AS rk FROM per_device)
  WHERE rk = 1)
SELECT date_trunc('hour', e.ts) AS hour, CAST(count(*) AS INTEGER) AS session_count,
       CAST(count(DISTINCT e.user_id) AS INTEGER) AS unique_users,
       CAST(avg(e.session_duration_minutes) AS FLOAT) AS avg_session_duration,
       any_value(m.device_type) AS most_popular_device
FROM user_events e JOIN modal m ON date_trunc('hour', e.ts) = m.hour
GROUP BY 1"""


def load_all() -> dict[str, str]:
    """Import the SQL modules (their decorators fill SQL) and return the oracle map."""
    from bazaar.plans import o_cohorts, o_experiments, o_more, o_quality, o_segments, o_sources  # noqa: F401
    return dict(SQL)
