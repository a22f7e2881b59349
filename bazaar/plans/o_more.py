"""Oracle SQL of the single-operator queries and the segment follow-ups."""
from bazaar.plans import o_cohorts, o_segments
from bazaar.plans.oracle import AB_UNITS, RETAIL, SQL, USER_EVENTS, sql, with_


@sql("device_classes")
def _():
    return with_(USER_EVENTS) + """
SELECT CASE device_type WHEN 'smart_tv' THEN 'large' WHEN 'desktop' THEN 'large' WHEN 'tablet' THEN 'small' END
         AS device_class, count(*) AS sessions
FROM user_events GROUP BY 1"""


@sql("countries_by_revenue")
def _():
    return with_(RETAIL) + """
SELECT country, count(*) AS lines FROM retail_lines GROUP BY 1 ORDER BY sum(quantity * price) DESC, country"""


@sql("valid_assignments")
def _():
    return with_(AB_UNITS) + """
SELECT experiment_id, grp, count(*) AS rows FROM ab_units
WHERE (grp, landing_page) IN (('control', 'old_page'), ('treatment', 'new_page')) GROUP BY 1, 2"""


@sql("users_by_device")
def _():
    return with_(USER_EVENTS) + "SELECT device_type, count(DISTINCT user_id) AS distinct_user_id FROM user_events GROUP BY 1"


@sql("events_in_order")
def _():
    return with_(USER_EVENTS) + "SELECT event_id, user_id, ts, device_type, action_type FROM user_events ORDER BY ts, event_id"


@sql("events_preview")
def _():
    return with_(USER_EVENTS) + "SELECT event_id, user_id, ts, action_type FROM user_events ORDER BY ts, event_id LIMIT 5"


@sql("distinct_actions")
def _():
    return with_(USER_EVENTS) + "SELECT DISTINCT action_type FROM user_events"


@sql("session_rank_sql")
def _():
    return SQL["session_rank_ansi"]


@sql("cluster_retention")
def _():
    return o_cohorts.base().rstrip() + f""",
labels AS (SELECT customer_id, segment FROM ({o_segments.base()} SELECT * FROM all_seg)),
act AS (
  SELECT segment, cohort_date, cohort_index, count(DISTINCT a.customer_id) AS active_customers
  FROM assigned a JOIN labels USING (customer_id) GROUP BY 1, 2, 3),
sized AS (
  SELECT *, max(active_customers) FILTER (WHERE cohort_index = 1) OVER (PARTITION BY segment, cohort_date) AS cohort_size
  FROM act)
SELECT segment, CAST(cohort_date AS TIMESTAMP) AS cohort_date, cohort_index, active_customers, cohort_size,
       round(CAST(active_customers AS DOUBLE) / CAST(cohort_size AS DOUBLE) * 100, 6) AS retention_pct
FROM sized"""


@sql("segment_splits")
def _():
    return o_cohorts.base().rstrip() + f""",
started AS (SELECT customer_id, min(invoice_date) AS first_day FROM ret GROUP BY 1),
labels AS (SELECT customer_id, frequency, segment FROM ({o_segments.base()} SELECT * FROM all_seg))
SELECT CASE WHEN segment = 'Lost/Dormant' AND frequency > 1 THEN segment || ': previously active'
            WHEN segment = 'Lost/Dormant' THEN segment || ': one and done'
            WHEN segment = 'Occasional/New Customers'
                 AND date_diff('day', CAST(first_day AS DATE), DATE '2002-01-01') <= 2000 THEN segment || ': new'
            WHEN segment = 'Occasional/New Customers' THEN segment || ': occasional'
            ELSE segment END AS segment, count(*) AS customers
FROM labels LEFT JOIN started USING (customer_id) GROUP BY 1"""
