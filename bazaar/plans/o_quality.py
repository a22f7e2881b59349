"""Oracle SQL for the cleaning, profile and data-quality queries."""
from bazaar.plans.oracle import RETAIL, STAR, USER_EVENTS, sql, with_

STD = r"'^\d{5}[A-Za-z]?$'"


@sql("cleaning_funnel")
def _():
    return with_(RETAIL) + f""",
c AS (
  SELECT count(*) AS s0,
         count(*) FILTER (WHERE NOT starts_with(invoice, 'C')) AS s1,
         count(*) FILTER (WHERE NOT starts_with(invoice, 'C') AND regexp_matches(stock_code, {STD})) AS s2,
         count(*) FILTER (WHERE NOT starts_with(invoice, 'C') AND regexp_matches(stock_code, {STD})
                          AND customer_id IS NOT NULL) AS s3,
         count(*) FILTER (WHERE NOT starts_with(invoice, 'C') AND regexp_matches(stock_code, {STD})
                          AND customer_id IS NOT NULL AND price > 0) AS s4
  FROM retail_lines),
steps AS (
  SELECT 0 AS step_no, 'original' AS step, s0 AS rows FROM c
  UNION ALL SELECT 1, 'after_remove_cancelled', s1 FROM c
  UNION ALL SELECT 2, 'after_remove_nonstandard_stockcode', s2 FROM c
  UNION ALL SELECT 3, 'after_remove_null_customerid', s3 FROM c
  UNION ALL SELECT 4, 'after_remove_nonpositive_price', s4 FROM c)
SELECT CAST(step_no AS BIGINT) AS step_no, step, rows,
       CAST(lag(rows) OVER (ORDER BY step_no) - rows AS DOUBLE) AS dropped
FROM steps"""


@sql("pattern_profile")
def _():
    return with_(RETAIL) + r"""
SELECT CASE WHEN regexp_matches(invoice, '^C\d{6}$') THEN 'cancellation'
            WHEN regexp_matches(invoice, '^\d{6}$') THEN 'plain'
            ELSE 'unexpected' END AS pattern,
       count(*) AS rows
FROM retail_lines WHERE invoice IS NOT NULL GROUP BY 1"""


@sql("stock_code_strays")
def _():
    return with_(RETAIL) + f"""
SELECT stock_code AS value, count(*) AS rows FROM retail_lines
WHERE stock_code IS NOT NULL AND NOT regexp_matches(stock_code, {STD})
GROUP BY 1"""


@sql("customer_id_format")
def _():
    return with_(RETAIL) + r"""
SELECT CASE WHEN customer_id IS NULL THEN NULL
            WHEN regexp_matches(CAST(customer_id AS VARCHAR), '^\d{5}$') THEN 'five_digit'
            ELSE 'unexpected' END AS pattern,
       count(*) AS rows
FROM retail_lines GROUP BY 1"""


@sql("consistency_check")
def _():
    return with_(RETAIL) + """
SELECT count(*) FILTER (WHERE quantity < 0) AS negative_qty_rows,
       count(*) FILTER (WHERE starts_with(invoice, 'C')) AS cancelled_rows,
       count(*) FILTER (WHERE quantity < 0 AND NOT starts_with(invoice, 'C')) AS negative_qty_not_cancelled,
       count(*) FILTER (WHERE starts_with(invoice, 'C') AND NOT quantity < 0) AS cancelled_not_negative_qty,
       bool_and(NOT quantity < 0 OR starts_with(invoice, 'C')) AS all_negative_qty_are_cancelled,
       bool_and(NOT starts_with(invoice, 'C') OR quantity < 0) AS all_cancelled_are_negative_qty
FROM retail_lines"""


@sql("code_catalog")
def _():
    return with_(RETAIL) + """,
counts AS (SELECT stock_code, count(description) AS description_count FROM retail_lines GROUP BY 1),
firsts AS (
  SELECT stock_code, description AS first_description FROM (
    SELECT stock_code, description,
           row_number() OVER (PARTITION BY stock_code ORDER BY invoice_date, invoice, description) AS rn
    FROM retail_lines WHERE description IS NOT NULL)
  WHERE rn = 1)
SELECT c.stock_code, c.description_count, f.first_description
FROM counts c LEFT JOIN firsts f ON c.stock_code = f.stock_code"""


@sql("value_sets")
def _():
    return with_(RETAIL) + f"""
SELECT stock_code, description, count(*) AS rows FROM retail_lines
WHERE regexp_matches(stock_code, {STD}) AND description IS NOT NULL
GROUP BY 1, 2"""


@sql("value_counts")
def _():
    return with_(RETAIL) + """
SELECT country AS value, count(*) AS rows FROM retail_lines WHERE country IS NOT NULL GROUP BY 1"""


_RETAIL_TYPES = [("invoice", "string"), ("stock_code", "string"), ("description", "string"),
                 ("quantity", "int"), ("invoice_date", "timestamp_ntz"), ("price", "double"),
                 ("customer_id", "bigint"), ("country", "string")]


@sql("column_profile")
def _():
    parts = [f"""SELECT '{c}' AS column_name, '{t}' AS dtype, count({c}) AS non_null,
       count(*) - count({c}) AS nulls,
       round(round_even(CAST(count(*) - count({c}) AS DOUBLE) * 100.0 / count(*), 2), 6) AS null_pct,
       count(DISTINCT {c}) AS "distinct"
FROM retail_lines""" for c, t in _RETAIL_TYPES]
    return with_(RETAIL) + "\nUNION ALL\n".join(parts)


@sql("describe_numeric")
def _():
    parts = [f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS min,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75,
       round(CAST(max({c}) AS DOUBLE), 6) AS max
FROM retail_lines""" for c in ("quantity", "price")]
    return with_(RETAIL) + "\nUNION ALL\n".join(parts)


@sql("describe_categorical")
def _():
    body = "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
       max(n) AS freq,
       (SELECT value FROM (SELECT {c} AS value, count(*) AS n FROM retail_lines WHERE {c} IS NOT NULL
                            GROUP BY 1) ORDER BY n DESC, value LIMIT 1) AS top
FROM (SELECT {c} AS value, count(*) AS n FROM retail_lines WHERE {c} IS NOT NULL GROUP BY 1)"""
        for c in ("invoice", "stock_code", "description", "country"))
    return with_(RETAIL) + body


def _null_sql(name: str, cols: list[str]) -> str:
    parts = [f"""SELECT '{name}' AS table_name, '{c}' AS column_name,
       count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS total_rows,
       round(round(CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) * 100.0 / count(*), 1), 6)
         AS null_pct,
       round(CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) * 100.0 / count(*), 1) > 5 AS flagged
FROM {name}""" for c in cols]
    return "\nUNION ALL\n".join(parts)


_STAR_COLS = {
    "customers": ["customer_id", "email", "registration_date", "country", "tier"],
    "products": ["product_id", "name", "category", "price", "stock_quantity"],
    "orders": ["order_id", "customer_id", "order_date", "status", "total_amount"],
    "order_items": ["order_id", "product_id", "line_number", "quantity", "price"],
}
_RETAIL_COLS = [c for c, _ in _RETAIL_TYPES]

_STAR_NULL_EMAIL = STAR.replace(
    "lower(c_name) || '@example.com' AS email",
    "CASE WHEN c_custkey % 12 = 0 THEN NULL ELSE lower(c_name) || '@example.com' END AS email")


def _star_views(star_sql: str) -> str:
    return star_sql.replace("app_customers AS", "customers AS").replace(
        "app_products AS", "products AS").replace("app_orders AS", "orders_ AS").replace(
        "app_order_items AS", "order_items AS")


@sql("null_rates")
def _():
    ctes = _star_views(_STAR_NULL_EMAIL)
    body = "\nUNION ALL\n".join(
        [_null_sql(t if t != "orders" else "orders_", cols).replace("'orders_'", "'orders'")
         for t, cols in _STAR_COLS.items()] + [_null_sql("retail_lines", _RETAIL_COLS)])
    return with_(ctes, RETAIL) + body


_DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                  "embeddings pages benchmark labels conversations").split()


# sizes of the files behind the views: those that a view's text names, or else the tables of the oracle run
_SIZES = """sizes AS (
  SELECT regexp_extract(f.filename, '([^/]+)[.]parquet$', 1) AS table_name, parse_filename(f.filename) AS file_name, f.size AS bytes
  FROM read_blob('/root/testdata/sf*/*.parquet') f
  WHERE CASE WHEN (SELECT count(*) FROM duckdb_views() WHERE sql LIKE '%/root/testdata/sf%') > 0
             THEN EXISTS (SELECT 1 FROM duckdb_views() v WHERE contains(v.sql, f.filename))
             ELSE starts_with(f.filename, '/root/testdata/sf0.01/') END)"""


@sql("table_profile")
def _():
    return f"WITH {_SIZES},\nt AS (" + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows, "
        f"(SELECT CAST(count(*) AS BIGINT) FROM (DESCRIBE {t})) AS columns FROM {t}"
        for t in _DRIVER_TABLES) + """)
SELECT t.table_name, rows, columns, CAST(count(*) AS BIGINT) AS files, CAST(sum(bytes) AS BIGINT) AS bytes
FROM t JOIN sizes s ON s.table_name = t.table_name GROUP BY 1, 2, 3"""


@sql("file_inventory")
def _():
    return f"WITH {_SIZES},\nt AS (" + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in _DRIVER_TABLES) + """)
SELECT t.table_name, file_name, CAST(bytes AS BIGINT) AS file_bytes, rows FROM t JOIN sizes s ON s.table_name = t.table_name"""


_FK = """
SELECT '{child}' AS child_table, '{fk}' AS fk_column, '{parent}' AS parent_table,
       CAST(count(*) AS BIGINT) AS child_rows,
       CAST(count(*) FILTER (WHERE c.{fk} IS NULL) AS BIGINT) AS null_keys,
       CAST(count(*) FILTER (WHERE c.{fk} IS NOT NULL AND p.{pk} IS NULL) AS BIGINT) AS orphan_rows,
       CAST(count(DISTINCT c.{fk}) FILTER (WHERE c.{fk} IS NOT NULL AND p.{pk} IS NULL) AS BIGINT)
         AS orphan_keys,
       (SELECT CAST(max(n) AS BIGINT) FROM (SELECT count(*) AS n FROM {child_v} WHERE {fk} IS NOT NULL
                                            GROUP BY {fk})) AS max_fanout
FROM {child_v} c LEFT JOIN (SELECT DISTINCT {pk} FROM {parent_v}) p ON c.{fk} = p.{pk}"""

_EDGES = [("orders", "customer_id", "customers", "customer_id", "app_orders", "app_customers"),
          ("order_items", "order_id", "orders", "order_id", "app_order_items", "app_orders"),
          ("order_items", "product_id", "products", "product_id", "app_order_items", "app_products")]


def _fk_sql() -> str:
    return "\nUNION ALL\n".join(
        _FK.format(child=c, fk=fk, parent=p, pk=pk, child_v=cv, parent_v=pv)
        for c, fk, p, pk, cv, pv in _EDGES)


@sql("fk_audit")
def _():
    return with_(STAR) + _fk_sql()


@sql("selectivity_profile")
def _():
    parts = [f"""SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS rows,
       round(count(*) * 100.0 / (SELECT count(*) FROM app_orders), 6) AS share_pct,
       CASE WHEN count(*) * 100.0 / (SELECT count(*) FROM app_orders) < 1 THEN 'very_high'
            WHEN count(*) * 100.0 / (SELECT count(*) FROM app_orders) <= 10 THEN 'medium'
            ELSE 'low' END AS selectivity
FROM app_orders GROUP BY 1, 2""" for c in ("status", "customer_id")]
    return with_(STAR) + "\nUNION ALL\n".join(parts)


@sql("expectations")
def _():
    from bazaar.plans.oracle import _MART
    mart = "mart AS (WITH " + _MART.format(orders="app_orders") + ")"
    return with_(STAR, mart) + """
SELECT 0 AS check_no, 'not_null' AS "check", 'customer_id' AS column_name,
       count(*) FILTER (WHERE customer_id IS NULL) AS failures, 'customer_analytics' AS model FROM mart
UNION ALL SELECT 1, 'unique', 'customer_id',
       (SELECT count(*) FROM (SELECT customer_id FROM mart GROUP BY 1 HAVING count(*) > 1)),
       'customer_analytics'
UNION ALL SELECT 2, 'not_null', 'email', count(*) FILTER (WHERE email IS NULL), 'customer_analytics' FROM mart
UNION ALL SELECT 3, 'not_null', 'lifetime_value', count(*) FILTER (WHERE lifetime_value IS NULL),
       'customer_analytics' FROM mart
UNION ALL SELECT 4, 'not_null', 'customer_segment', count(*) FILTER (WHERE customer_segment IS NULL),
       'customer_analytics' FROM mart
UNION ALL SELECT 5, 'accepted_values', 'customer_segment',
       count(*) FILTER (WHERE customer_segment IS NOT NULL
                        AND customer_segment NOT IN ('inactive', 'occasional', 'regular', 'vip')),
       'customer_analytics' FROM mart
UNION ALL SELECT 6, 'not_null', 'total_orders', count(*) FILTER (WHERE total_orders IS NULL),
       'customer_analytics' FROM mart
UNION ALL SELECT 0, 'unique', 'order_id,line_number',
       (SELECT count(*) FROM (SELECT order_id, line_number FROM app_order_items GROUP BY 1, 2
                              HAVING count(*) > 1)), 'order_items'
"""


from bazaar.plans.oracle import SQL as _SQL  # noqa: E402

_SQL["expectations"] = f"SELECT *, failures = 0 AS passed FROM ({_SQL['expectations']})"


@sql("findings")
def _():
    ctes = _STAR_NULL_EMAIL
    nulls = "\nUNION ALL\n".join(
        _null_sql(v, _STAR_COLS[t]).replace(f"'{v}' AS table_name", f"'{t}' AS table_name")
        for t, v in (("customers", "app_customers"), ("products", "app_products"),
                     ("orders", "app_orders"), ("order_items", "app_order_items")))
    return with_(ctes) + f""",
nulls AS ({nulls}),
fk AS ({_fk_sql()}),
dups AS (
  SELECT 'order_items' AS table_name, 'order_id,line_number' AS key,
         (SELECT count(*) FROM (SELECT 1 FROM app_order_items GROUP BY order_id, line_number
                                HAVING count(*) > 1)) AS duplicate_keys
  UNION ALL
  SELECT 'customers', 'customer_id',
         (SELECT count(*) FROM (SELECT 1 FROM app_customers GROUP BY customer_id HAVING count(*) > 1))),
detail AS (
  SELECT 1 AS section, child_table || '.' || fk_column AS sort_key,
         printf('Orphan keys: %s.%s (%d rows without a %s row)', child_table, fk_column, orphan_rows,
                parent_table) AS issue,
         'Rows lost on inner joins' AS impact, 'HIGH' AS priority
  FROM fk WHERE orphan_rows > 0
  UNION ALL
  SELECT 2, table_name || '.' || column_name,
         printf('%s.%s has %s%% nulls', table_name, column_name, CAST(null_pct AS VARCHAR)),
         'Possible data quality issue', 'MEDIUM'
  FROM nulls WHERE flagged
  UNION ALL
  SELECT 3, table_name || '.' || key,
         printf('%s: %d duplicate key values on (%s)', table_name, duplicate_keys, key),
         'Double counting in aggregates', 'MEDIUM'
  FROM dups WHERE duplicate_keys > 0)
SELECT section, sort_key, issue, impact, priority FROM detail
UNION ALL SELECT 1, '', 'All foreign keys resolve', 'Joins keep every row', 'OK'
  WHERE NOT EXISTS (SELECT 1 FROM detail WHERE section = 1)
UNION ALL SELECT 2, '', 'No high-null columns (> 5%)', 'Data completeness is healthy', 'OK'
  WHERE NOT EXISTS (SELECT 1 FROM detail WHERE section = 2)
UNION ALL SELECT 3, '', 'No duplicate keys', 'Keys identify rows', 'OK'
  WHERE NOT EXISTS (SELECT 1 FROM detail WHERE section = 3)"""


@sql("duplicate_rows")
def _():
    return with_(STAR) + """
SELECT i.order_id, i.product_id, i.line_number, i.quantity, round(i.quantity * i.price, 2) AS line_amount,
       d.dup_count
FROM app_order_items i
JOIN (SELECT order_id, line_number, count(*) AS dup_count FROM app_order_items
      GROUP BY 1, 2 HAVING count(*) > 1) d
  ON i.order_id = d.order_id AND i.line_number = d.line_number"""


@sql("duplicate_summary")
def _():
    return with_(RETAIL) + """
SELECT count(*) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (invoice) FROM retail_lines))
         AS distinct_rows,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (invoice) FROM retail_lines)) AS duplicate_rows
FROM retail_lines"""


@sql("date_range")
def _():
    return with_(RETAIL) + "SELECT min(invoice_date) AS min_value, max(invoice_date) AS max_value FROM retail_lines"


@sql("histogram")
def _():
    return with_(USER_EVENTS) + """,
s AS (SELECT device_type, min(session_duration_minutes) AS lo, max(session_duration_minutes) AS hi
      FROM user_events WHERE session_duration_minutes IS NOT NULL GROUP BY 1),
b AS (
  SELECT e.device_type,
         CASE WHEN s.hi = s.lo THEN 1
              ELSE least(floor((e.session_duration_minutes - s.lo) / (s.hi - s.lo) * 20) + 1, 20) END AS bin
  FROM user_events e JOIN s ON e.device_type = s.device_type
  WHERE e.session_duration_minutes IS NOT NULL),
c AS (SELECT device_type, bin, count(*) AS n FROM b GROUP BY 1, 2),
frame AS (SELECT s.device_type, s.lo, s.hi, g.bin FROM s, (SELECT CAST(range AS BIGINT) AS bin FROM range(1, 21)) g)
SELECT f.device_type, f.bin, round(f.lo + (f.bin - 1) * ((f.hi - f.lo) / 20), 6) AS lower,
       round(f.lo + f.bin * ((f.hi - f.lo) / 20), 6) AS upper, CAST(coalesce(c.n, 0) AS BIGINT) AS rows
FROM frame f LEFT JOIN c ON f.device_type = c.device_type AND f.bin = c.bin"""


@sql("density")
def _():
    return with_(USER_EVENTS) + """,
s AS (SELECT device_type, count(*) AS n, stddev_samp(session_duration_minutes) AS sd,
             min(session_duration_minutes) AS lo, max(session_duration_minutes) AS hi
      FROM user_events WHERE session_duration_minutes IS NOT NULL GROUP BY 1),
p AS (SELECT *, sd * pow(n, -0.2) AS h FROM s),
g AS (SELECT *, lo - 3.0 * h AS g0, (hi - lo + 2 * 3.0 * h) / 63 AS step FROM p),
k AS (
  SELECT g.device_type, r.range AS grid_index, g.g0, g.step, g.n, g.h,
         sum(exp(-0.5 * pow((g.g0 + r.range * g.step - e.session_duration_minutes) / nullif(g.h, 0), 2))) AS ks
  FROM user_events e JOIN g ON e.device_type = g.device_type
  CROSS JOIN range(0, 64) r
  WHERE e.session_duration_minutes IS NOT NULL
  GROUP BY 1, 2, 3, 4, 5, 6)
SELECT device_type, CAST(grid_index AS BIGINT) AS grid_index, round(g0 + grid_index * step, 6) AS x,
       round(ks / nullif(n * h * sqrt(2 * pi()), 0), 6) AS density
FROM k"""


@sql("active_orders")
def _():
    return with_(STAR) + """
SELECT status, count(*) AS orders, round(sum(total_amount), 2) AS amount
FROM app_orders WHERE status IN ('O', 'P') GROUP BY 1"""
