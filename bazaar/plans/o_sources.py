"""Oracle SQL of the scans."""
from bazaar.plans.oracle import sql


@sql("csv_quarantine")
def _():
    """The rule by which lines are spoilt, counted on the table itself."""
    return """WITH o AS (
  SELECT o_orderpriority AS arm, o_totalprice,
         o_orderkey % 89 = 5 OR o_orderkey % 71 = 3 AS miscounted, o_orderkey % 97 = 0 OR o_orderkey % 83 = 7 AS unreadable
  FROM orders)
SELECT arm, count(*) AS lines, count(*) FILTER (WHERE NOT miscounted AND NOT unreadable) AS sound,
       count(*) FILTER (WHERE miscounted OR unreadable) AS rejected, count(*) FILTER (WHERE miscounted) AS rejected_fields,
       count(*) FILTER (WHERE unreadable AND NOT miscounted) AS rejected_values,
       round(sum(o_totalprice) FILTER (WHERE NOT miscounted AND NOT unreadable), 2) AS amount
FROM o GROUP BY arm"""


@sql("incremental_export")
def _():
    return """WITH d AS (
  SELECT CAST(ts AS DATE) AS day, count(DISTINCT date_trunc('hour', ts)) AS hours FROM events WHERE ts IS NOT NULL GROUP BY 1)
SELECT count(*) AS days, CAST(1 AS BIGINT) AS days_written, count(*) - 1 AS days_kept, CAST(0 AS BIGINT) AS days_removed,
       max_by(hours, day) AS hours_written FROM d"""


@sql("merged_profile")
def _():
    """Exact values; the estimates' checks must hold."""
    parts = []
    for c, number in (("o_custkey", True), ("o_totalprice", True), ("o_orderpriority", False)):
        x = f"CAST({c} AS DOUBLE)" if number else "CAST(NULL AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS column_name, count(*) AS total, count(*) - count({c}) AS nulls, count({c}) AS count,
       round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std, round(min({x}), 6) AS min, round(max({x}), 6) AS max,
       TRUE AS distinct_within_error, TRUE AS quantiles_within_error FROM orders""")
    return "\nUNION ALL\n".join(parts)
