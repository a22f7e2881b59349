"""Oracle SQL for the cohort-retention queries (row-level, the reference's shape)."""
from bazaar.plans.oracle import RETAIL, sql, with_

RET = """ret AS (
  SELECT min(invoice) AS invoice, stock_code, description, quantity, invoice_date, price, customer_id, country
  FROM retail_lines
  WHERE customer_id IS NOT NULL AND customer_id <> 0 AND quantity > 0 AND price > 0
  GROUP BY ALL),
assigned0 AS (
  SELECT r.*, year(invoice_date) AS year, month(invoice_date) AS month, day(invoice_date) AS day,
         quantity * price AS revenue,
         min(invoice_date) OVER (PARTITION BY customer_id) AS first_purchase_date
  FROM ret r),
assigned AS (
  SELECT *, CAST(date_trunc('month', first_purchase_date) AS DATE) AS cohort_date,
         year(first_purchase_date) AS cohort_year, month(first_purchase_date) AS cohort_month,
         day(first_purchase_date) AS cohort_day,
         (year - year(first_purchase_date)) * 12 + (month - month(first_purchase_date)) + 1 AS cohort_index
  FROM assigned0),
activity AS (
  SELECT cohort_date, cohort_index, count(DISTINCT customer_id) AS active_customers
  FROM assigned GROUP BY 1, 2),
pct AS (
  SELECT cohort_date, cohort_index, active_customers,
         max(active_customers) FILTER (WHERE cohort_index = 1) OVER (PARTITION BY cohort_date) AS cohort_size
  FROM activity)"""


def base() -> str:
    return with_(RETAIL, RET)


@sql("retention_cleaning")
def _():
    return base() + "SELECT count(*) AS rows, count(DISTINCT customer_id) AS customers FROM ret"


@sql("cohort_assignment")
def _():
    return base() + """
SELECT invoice, stock_code, description, quantity, invoice_date, round(price, 6) AS price, customer_id,
       country, year, month, day, round(revenue, 2) AS revenue, first_purchase_date,
       CAST(cohort_date AS TIMESTAMP) AS cohort_date, cohort_year, cohort_month, cohort_day, cohort_index
FROM assigned"""


@sql("customer_month")
def _():
    return base() + """
SELECT customer_id, year, month, round(sum(revenue), 2) AS revenue, max(cohort_index) AS cohort_index,
       max(first_purchase_date) AS first_purchase_date, CAST(max(cohort_date) AS TIMESTAMP) AS cohort_date
FROM assigned GROUP BY 1, 2, 3"""


@sql("cohort_activity")
def _():
    return base() + "SELECT CAST(cohort_date AS TIMESTAMP) AS cohort_date, cohort_index, active_customers FROM activity"


@sql("retention_triangle")
def _():
    months = ", ".join(map(str, range(1, 81)))
    return base() + f"""
SELECT * FROM (
  PIVOT (SELECT CAST(cohort_date AS TIMESTAMP) AS cohort_date, cohort_index,
                CAST(active_customers AS DOUBLE) AS v FROM activity)
  ON cohort_index IN ({months}) USING first(v) GROUP BY cohort_date)"""


@sql("retention_pct")
def _():
    return base() + """
SELECT CAST(cohort_date AS TIMESTAMP) AS cohort_date, cohort_index, active_customers, cohort_size,
       round(CAST(active_customers AS DOUBLE) / CAST(cohort_size AS DOUBLE) * 100, 6) AS retention_pct
FROM pct"""


@sql("retention_cells")
def _():
    return base() + """
SELECT CAST(cohort_date AS TIMESTAMP) AS cohort_date, cohort_index,
       strftime(cohort_date, '%Y-%m-%d') AS cohort_label,
       CAST(CAST(round_even(CAST(active_customers AS DOUBLE) / CAST(cohort_size AS DOUBLE) * 100, 0) AS BIGINT)
            AS VARCHAR) || '%' AS retention_label,
       CAST(active_customers AS VARCHAR) || ' (' ||
         CAST(CAST(round_even(CAST(active_customers AS DOUBLE) / CAST(cohort_size AS DOUBLE) * 100, 0) AS BIGINT)
              AS VARCHAR) || '%)' AS cell,
       CAST(active_customers AS VARCHAR) || chr(10) || '(' ||
         CAST(CAST(round_even(CAST(active_customers AS DOUBLE) / CAST(cohort_size AS DOUBLE) * 100, 0) AS BIGINT)
              AS VARCHAR) || '%)' AS cell_multiline
FROM pct"""


@sql("rolling_retention")
def _():
    days = (1, 7, 30, 90)
    flags = ",\n         ".join(f"bool_or(off = {n}) AS on_{n}" for n in days)
    counts = ",\n         ".join(
        f"count(*) FILTER (WHERE on_{n}) AS a_{n}, count(*) FILTER (WHERE max_offset >= {n}) AS r_{n}"
        for n in days)
    rows = "\nUNION ALL\n".join(
        f"""SELECT CAST(cohort_date AS TIMESTAMP) AS cohort_date, CAST({n} AS BIGINT) AS day_n, cohort_size,
       a_{n} AS active_on_day, r_{n} AS active_on_or_after,
       round(CAST(a_{n} AS DOUBLE) / CAST(cohort_size AS DOUBLE) * 100, 6) AS day_retention_pct,
       round(CAST(r_{n} AS DOUBLE) / CAST(cohort_size AS DOUBLE) * 100, 6) AS rolling_retention_pct
FROM agg""" for n in days)
    return base() + f""",
pdays AS (SELECT DISTINCT customer_id, CAST(invoice_date AS DATE) AS d FROM ret),
offs AS (
  SELECT customer_id, d, min(d) OVER (PARTITION BY customer_id) AS first_day FROM pdays),
per_cust AS (
  SELECT customer_id, first_day, max(date_diff('day', first_day, d)) AS max_offset,
         {flags.replace('off =', "date_diff('day', first_day, d) =")}
  FROM offs GROUP BY 1, 2),
agg AS (
  SELECT CAST(date_trunc('month', first_day) AS DATE) AS cohort_date, count(*) AS cohort_size,
         {counts}
  FROM per_cust GROUP BY 1)
{rows}"""


@sql("retention_curve")
def _():
    """Distinct purchase days joined with the windows."""
    return base() + """,
pdays AS (SELECT DISTINCT customer_id, CAST(invoice_date AS DATE) AS d FROM ret),
offs AS (SELECT customer_id, min(d) OVER (PARTITION BY customer_id) AS first_day, d FROM pdays),
spans AS (SELECT n AS lo, n + w AS hi FROM range(1, 61) a(n), (VALUES (0), (6), (NULL)) b(w)),
sizes AS (SELECT date_trunc('month', first_day) AS cohort_date, count(DISTINCT customer_id) AS cohort_size FROM offs GROUP BY 1),
hits AS (
  SELECT date_trunc('month', first_day) AS cohort_date, lo, hi, count(DISTINCT customer_id) AS n
  FROM offs JOIN spans ON d - first_day >= lo AND (hi IS NULL OR d - first_day <= hi) GROUP BY 1, 2, 3)
SELECT CAST(s.cohort_date AS TIMESTAMP) AS cohort_date, CAST(p.lo AS BIGINT) AS from_day, CAST(p.hi AS DOUBLE) AS to_day,
       s.cohort_size, coalesce(h.n, 0) AS active_customers
FROM sizes s CROSS JOIN spans p
LEFT JOIN hits h ON h.cohort_date = s.cohort_date AND h.lo = p.lo AND h.hi IS NOT DISTINCT FROM p.hi"""


@sql("segment_retention")
def _():
    return base() + """,
seg_act AS (
  SELECT country, cohort_date, cohort_index, count(DISTINCT customer_id) AS active_customers
  FROM assigned GROUP BY 1, 2, 3),
seg_pct AS (
  SELECT *, max(active_customers) FILTER (WHERE cohort_index = 1)
              OVER (PARTITION BY country, cohort_date) AS cohort_size
  FROM seg_act)
SELECT country, CAST(cohort_date AS TIMESTAMP) AS cohort_date, cohort_index, active_customers, cohort_size,
       round(CAST(active_customers AS DOUBLE) / CAST(cohort_size AS DOUBLE) * 100, 6) AS retention_pct
FROM seg_pct"""
