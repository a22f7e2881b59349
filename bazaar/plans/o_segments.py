"""Oracle SQL for the RFM / segmentation queries."""
from bazaar.plans.oracle import RETAIL, sql, with_

STD = r"'^\d{5}[A-Za-z]?$'"

RFM = f"""clean AS (
  SELECT * FROM retail_lines
  WHERE NOT starts_with(invoice, 'C') AND regexp_matches(stock_code, {STD})
        AND customer_id IS NOT NULL AND price > 0),
per AS (
  SELECT customer_id, sum(quantity * price) AS monetary_value, count(DISTINCT invoice) AS frequency,
         max(invoice_date) AS max_date
  FROM clean GROUP BY 1),
rfm AS (
  SELECT customer_id, monetary_value, frequency,
         date_sub('day', max_date, (SELECT max(max_date) FROM per) + INTERVAL 1 DAY) AS recency
  FROM per),
fence AS (
  SELECT quantile_cont(monetary_value, 0.25) AS mq1, quantile_cont(monetary_value, 0.75) AS mq3,
         quantile_cont(CAST(frequency AS DOUBLE), 0.25) AS fq1,
         quantile_cont(CAST(frequency AS DOUBLE), 0.75) AS fq3
  FROM rfm),
fences AS (
  SELECT mq1 - 1.5 * (mq3 - mq1) AS mv_lower, mq3 + 1.5 * (mq3 - mq1) AS mv_upper,
         fq1 - 1.5 * (fq3 - fq1) AS f_lower, fq3 + 1.5 * (fq3 - fq1) AS f_upper FROM fence),
split AS (
  SELECT r.*, CASE WHEN r.monetary_value > f.mv_upper OR r.frequency > f.f_upper THEN 'whale'
                   WHEN r.monetary_value < f.mv_lower OR r.frequency < f.f_lower THEN 'low_value'
                   ELSE 'main' END AS segment
  FROM rfm r, fences f),
logged AS (
  SELECT customer_id, monetary_value, frequency, recency,
         ln(1 + monetary_value) AS monetary_value_log, ln(1 + frequency) AS frequency_log,
         ln(1 + recency) AS recency_log
  FROM split WHERE segment = 'main'),
scaled AS (
  SELECT l.*,
         (monetary_value_log - avg(monetary_value_log) OVER ()) / stddev_pop(monetary_value_log) OVER ()
           AS monetary_value_scaled,
         (frequency_log - avg(frequency_log) OVER ()) / stddev_pop(frequency_log) OVER () AS frequency_scaled,
         (recency_log - avg(recency_log) OVER ()) / stddev_pop(recency_log) OVER () AS recency_scaled
  FROM logged l),
bq AS (
  SELECT quantile_cont(monetary_value_scaled, 0.25) AS q1, quantile_cont(monetary_value_scaled, 0.5) AS q2,
         quantile_cont(monetary_value_scaled, 0.75) AS q3 FROM scaled),
cents AS (
  SELECT CASE WHEN s.monetary_value_scaled > bq.q3 THEN 0 WHEN s.monetary_value_scaled > bq.q2 THEN 1
              WHEN s.monetary_value_scaled > bq.q1 THEN 2 ELSE 3 END AS cluster,
         avg(monetary_value_scaled) AS cm, avg(frequency_scaled) AS cf, avg(recency_scaled) AS cr
  FROM scaled s, bq GROUP BY 1),
dists AS (
  SELECT s.*, c.cluster,
         pow(s.monetary_value_scaled - c.cm, 2) + pow(s.frequency_scaled - c.cf, 2)
           + pow(s.recency_scaled - c.cr, 2) AS sq_distance,
         row_number() OVER (PARTITION BY s.customer_id
                            ORDER BY pow(s.monetary_value_scaled - c.cm, 2) + pow(s.frequency_scaled - c.cf, 2)
                                     + pow(s.recency_scaled - c.cr, 2), c.cluster) AS rk
  FROM scaled s, cents c),
assigned AS (SELECT * EXCLUDE (rk) FROM dists WHERE rk = 1),
profile AS (
  SELECT cluster, avg(monetary_value) AS monetary_value, avg(frequency) AS frequency,
         avg(recency) AS recency, count(*) AS count, sum(monetary_value) AS total_revenue
  FROM assigned GROUP BY 1),
named AS (
  SELECT cluster,
         CASE WHEN m = 1 THEN 'Champions' WHEN r = 1 THEN 'Lost/Dormant'
              WHEN g = 1 THEN 'Growth/Potential Loyalists' WHEN g = 2 THEN 'Occasional/New Customers'
              ELSE 'Cluster ' || CAST(cluster AS VARCHAR) END AS cluster_name
  FROM (
    SELECT *, CASE WHEN m > 1 AND r > 1 THEN row_number() OVER (
                     ORDER BY CASE WHEN m > 1 AND r > 1 THEN monetary_value END DESC NULLS LAST, cluster) END AS g
    FROM (
      SELECT *, CASE WHEN m > 1 THEN row_number() OVER (
                       ORDER BY CASE WHEN m > 1 THEN recency END DESC NULLS LAST, cluster) END AS r
      FROM (SELECT *, row_number() OVER (ORDER BY monetary_value DESC, cluster) AS m FROM profile)))),
whales AS (
  SELECT r.customer_id, r.monetary_value, r.frequency, r.recency,
         CASE WHEN r.monetary_value > f.mv_upper AND r.frequency > f.f_upper THEN 'overlap_cluster'
              WHEN r.monetary_value > f.mv_upper THEN 'only_high_mv_cluster'
              ELSE 'only_high_freq_cluster' END AS whale_segment
  FROM rfm r, fences f
  WHERE r.monetary_value > f.mv_upper OR r.frequency > f.f_upper),
all_seg AS (
  SELECT a.customer_id, a.monetary_value, a.frequency, a.recency, n.cluster_name AS segment
  FROM assigned a LEFT JOIN named n ON a.cluster = n.cluster
  UNION ALL
  SELECT customer_id, monetary_value, frequency, recency, whale_segment FROM whales)"""


def base() -> str:
    return with_(RETAIL, RFM)


@sql("rfm")
def _():
    return base() + "SELECT customer_id, round(monetary_value, 2) AS monetary_value, frequency, recency FROM rfm"


@sql("iqr_bounds")
def _():
    parts = [f"""SELECT '{c}' AS column_name, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
       round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper
FROM (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3
      FROM rfm)""" for c in ("monetary_value", "frequency", "recency")]
    return base() + "\nUNION ALL\n".join(parts)


@sql("boxplot_summary")
def _():
    bands = ["outlier_low", "whisker_low_to_Q1", "IQR_box (25-75%)", "Q3_to_whisker_high", "outlier_high"]
    labels = " UNION ALL ".join(f"SELECT {i + 1} AS band_order, '{b}' AS band" for i, b in enumerate(bands))
    parts = []
    for c in ("monetary_value", "frequency", "recency"):
        parts.append(f"""SELECT '{c}' AS column_name, l.band_order, l.band, CAST(count(v.b) AS BIGINT) AS rows
FROM ({labels}) l LEFT JOIN (
  SELECT CASE WHEN x < lo THEN 'outlier_low' WHEN x >= lo AND x < q1 THEN 'whisker_low_to_Q1'
              WHEN x >= q1 AND x <= q3 THEN 'IQR_box (25-75%)' WHEN x > q3 AND x <= hi THEN 'Q3_to_whisker_high'
              WHEN x > hi THEN 'outlier_high' ELSE 'unknown' END AS b
  FROM (SELECT CAST({c} AS DOUBLE) AS x FROM rfm) r,
       (SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
          (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3
           FROM rfm)) q) v ON v.b = l.band
GROUP BY 1, 2, 3""")
    return base() + "\nUNION ALL\n".join(parts)


@sql("iqr_split")
def _():
    return base() + "SELECT customer_id, round(monetary_value, 2) AS monetary_value, frequency, recency, segment FROM split"


@sql("whale_segments")
def _():
    return base() + """SELECT customer_id, round(monetary_value, 2) AS monetary_value, frequency, recency,
       whale_segment FROM whales"""


@sql("log_scaled_features")
def _():
    return base() + """SELECT customer_id, round(monetary_value, 2) AS monetary_value, frequency, recency,
       round(monetary_value_log, 6) AS monetary_value_log, round(frequency_log, 6) AS frequency_log,
       round(recency_log, 6) AS recency_log, round(monetary_value_scaled, 6) AS monetary_value_scaled,
       round(frequency_scaled, 6) AS frequency_scaled, round(recency_scaled, 6) AS recency_scaled
FROM scaled"""


@sql("band_centroids")
def _():
    return base() + """SELECT cluster, round(cm, 6) AS monetary_value_scaled, round(cf, 6) AS frequency_scaled,
       round(cr, 6) AS recency_scaled FROM cents"""


@sql("nearest_centroid")
def _():
    return base() + "SELECT customer_id, cluster, round(sq_distance, 6) AS sq_distance FROM assigned"


@sql("wcss")
def _():
    return base() + """
SELECT CAST(cluster AS VARCHAR) AS cluster, count(*) AS points, round(sum(sq_distance), 6) AS wcss
FROM assigned GROUP BY 1
UNION ALL SELECT 'total', count(*), round(sum(sq_distance), 6) FROM assigned"""


@sql("silhouette_fixed")
def _():
    return base() + """,
pts AS (
  SELECT cluster AS lab, monetary_value_scaled AS x0, frequency_scaled AS x1, recency_scaled AS x2,
         pow(monetary_value_scaled, 2) + pow(frequency_scaled, 2) + pow(recency_scaled, 2) AS sq
  FROM assigned),
st AS (SELECT lab, count(*) AS n, sum(sq) AS sqsum, sum(x0) AS s0, sum(x1) AS s1, sum(x2) AS s2
       FROM pts GROUP BY 1),
pd AS (
  SELECT p.*, s.lab AS tlab, s.n AS tn,
         p.sq + s.sqsum / s.n - 2 * (p.x0 * s.s0 + p.x1 * s.s1 + p.x2 * s.s2) / s.n AS d
  FROM pts p, st s),
ab AS (
  SELECT lab, x0, x1, x2,
         max(CASE WHEN tlab = lab THEN tn END) AS own_n,
         max(CASE WHEN tlab = lab THEN d * tn / (tn - 1) END) AS a,
         min(CASE WHEN tlab <> lab THEN d END) AS b
  FROM pd GROUP BY lab, x0, x1, x2, sq)
SELECT round(avg(CASE WHEN own_n = 1 THEN 0.0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0.0 END), 6)
         AS silhouette,
       count(*) AS points
FROM ab"""


@sql("cluster_profile")
def _():
    return base() + """
SELECT cluster, round(monetary_value, 6) AS monetary_value, round(frequency, 6) AS frequency,
       round(recency, 6) AS recency, count, round(total_revenue, 2) AS total_revenue,
       round(sum(total_revenue) OVER (), 2) AS overall_total_revenue,
       round(round_even(total_revenue / sum(total_revenue) OVER () * 100 * 10, 0) / 10, 6) AS revenue_share_pct
FROM profile"""


@sql("profile_with_total")
def _():
    return base() + """
SELECT CASE WHEN grouping(cluster) = 1 THEN 'All' ELSE CAST(cluster AS VARCHAR) END AS cluster_group,
       round(avg(monetary_value), 6) AS monetary_value, round(avg(frequency), 6) AS frequency,
       round(avg(recency), 6) AS recency, count(*) AS n
FROM assigned GROUP BY GROUPING SETS ((cluster), ())"""


@sql("name_clusters")
def _():
    return base() + "SELECT cluster, cluster_name FROM named"


@sql("all_segments")
def _():
    return base() + """SELECT customer_id, round(monetary_value, 2) AS monetary_value, frequency, recency, segment
FROM all_seg"""


@sql("segment_summary")
def _():
    return base() + """
SELECT segment, count(DISTINCT customer_id) AS customers, round(avg(monetary_value), 6) AS monetary_value,
       round(avg(frequency), 6) AS frequency, round(avg(recency), 6) AS recency
FROM all_seg GROUP BY 1"""


def _split_sql(name: str, where: str, ref: str) -> str:
    return f"""{name}_per AS (
  SELECT customer_id, sum(quantity * price) AS monetary_value, count(DISTINCT invoice) AS frequency,
         max(invoice_date) AS max_date
  FROM clean {where} GROUP BY 1),
{name}_rfm AS (
  SELECT customer_id, monetary_value, frequency, date_sub('day', max_date, {ref}) AS recency FROM {name}_per),
{name}_f AS (
  SELECT quantile_cont(monetary_value, 0.25) AS mq1, quantile_cont(monetary_value, 0.75) AS mq3,
         quantile_cont(CAST(frequency AS DOUBLE), 0.25) AS fq1,
         quantile_cont(CAST(frequency AS DOUBLE), 0.75) AS fq3 FROM {name}_rfm),
{name} AS (
  SELECT r.customer_id,
         CASE WHEN r.monetary_value > f.mq3 + 1.5 * (f.mq3 - f.mq1) OR r.frequency > f.fq3 + 1.5 * (f.fq3 - f.fq1)
              THEN 'whale'
              WHEN r.monetary_value < f.mq1 - 1.5 * (f.mq3 - f.mq1) OR r.frequency < f.fq1 - 1.5 * (f.fq3 - f.fq1)
              THEN 'low_value' ELSE 'main' END AS segment
  FROM {name}_rfm r, {name}_f f)"""


@sql("segment_migration")
def _():
    before = _split_sql("snap0", "WHERE invoice_date < TIMESTAMP '2000-01-01'", "TIMESTAMP '2000-01-01'")
    after = _split_sql("snap1", "", "(SELECT max(max_date) FROM snap1_per) + INTERVAL 1 DAY")
    return base() + f""",
{before},
{after}
SELECT coalesce(b.segment, '(new)') AS from_segment, coalesce(a.segment, '(gone)') AS to_segment,
       count(*) AS customers
FROM snap0 b FULL OUTER JOIN snap1 a ON b.customer_id = a.customer_id
GROUP BY 1, 2"""


@sql("non_whale_customers")
def _():
    return base() + """
SELECT customer_id, round(monetary_value, 2) AS monetary_value, frequency, recency FROM rfm
WHERE customer_id NOT IN (SELECT customer_id FROM whales)"""



@sql("segment_drift")
def _():
    before = _split_sql("snap0", "WHERE invoice_date < TIMESTAMP '2000-01-01'", "TIMESTAMP '2000-01-01'")
    after = _split_sql("snap1", "", "(SELECT max(max_date) FROM snap1_per) + INTERVAL 1 DAY")
    return base() + f""",
{before},
{after}
SELECT b.segment AS from_segment, count(*) AS customers,
       round(avg(r1.monetary_value - r0.monetary_value), 6) AS monetary_value_change,
       round(avg(r1.frequency - r0.frequency), 6) AS frequency_change,
       round(avg(r1.recency - r0.recency), 6) AS recency_change,
       round(avg(CAST(b.segment <> a.segment AS DOUBLE)), 6) AS moved_share
FROM snap0 b JOIN snap0_rfm r0 ON b.customer_id = r0.customer_id
JOIN snap1 a ON b.customer_id = a.customer_id JOIN snap1_rfm r1 ON a.customer_id = r1.customer_id
GROUP BY 1"""


def _lloyd(ks) -> str:
    """The same K-means in SQL: bands of each feature as starts, one recursion for the steps of all runs, the best start per K."""
    cols = ("monetary_value_scaled", "frequency_scaled", "recency_scaled")
    bands = []
    for k in ks:
        for i, c in enumerate(cols):
            below = " + ".join(f"CAST({c} <= (SELECT quantile_cont({c}, CAST({j / k!r} AS DOUBLE)) FROM scaled) AS INTEGER)" for j in range(1, k)) or "0"
            bands.append(f"SELECT {k * 100 + i} AS run, {below} AS cluster, {', '.join(cols)} FROM scaled")
    union = "\n  UNION ALL ".join(bands)
    return f""",
pts AS MATERIALIZED (SELECT customer_id, {cols[0]} AS x, {cols[1]} AS y, {cols[2]} AS z FROM scaled),
bands AS (
  {union}),
means AS (SELECT run, cluster, avg({cols[0]}) AS x, avg({cols[1]}) AS y, avg({cols[2]}) AS z FROM bands GROUP BY 1, 2),
starts AS (SELECT run, list({{'cluster': cluster, 'x': x, 'y': y, 'z': z}} ORDER BY cluster) AS cents FROM means GROUP BY run),
walk AS (
  SELECT run, 0 AS step, cents, CAST('inf' AS DOUBLE) AS moved FROM starts
  UNION ALL
  SELECT run, step + 1, list({{'cluster': cluster, 'x': x, 'y': y, 'z': z}} ORDER BY cluster),
         sum((x - ox) * (x - ox) + (y - oy) * (y - oy) + (z - oz) * (z - oz))
  FROM (
    SELECT o.run AS run, o.step AS step, o.c.cluster AS cluster, coalesce(n.x, o.c.x) AS x, coalesce(n.y, o.c.y) AS y, coalesce(n.z, o.c.z) AS z,
           o.c.x AS ox, o.c.y AS oy, o.c.z AS oz
    FROM (SELECT run, step, unnest(cents) AS c FROM walk WHERE moved > 1e-4) o
    LEFT JOIN (
      SELECT run, cluster, avg(x) AS x, avg(y) AS y, avg(z) AS z
      FROM (SELECT w.run, p.x, p.y, p.z,
                   list_min([{{'d': (p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y) + (p.z - c.z) * (p.z - c.z),
                               'cluster': c.cluster}} FOR c IN w.cents]).cluster AS cluster
            FROM walk w, pts p WHERE w.moved > 1e-4)
      GROUP BY run, cluster) n ON n.run = o.run AND n.cluster = o.c.cluster)
  GROUP BY run, step),
ends AS (SELECT run, step, cents FROM walk QUALIFY row_number() OVER (PARTITION BY run ORDER BY step DESC) = 1),
near AS (
  SELECT run, customer_id, x, y, z,
         list_min([{{'d': (x - c.x) * (x - c.x) + (y - c.y) * (y - c.y) + (z - c.z) * (z - c.z), 'cluster': c.cluster}} FOR c IN cents]) AS best
  FROM ends, pts),
inertias AS (SELECT run, CAST(floor(run / 100) AS BIGINT) AS k, sum(best.d) AS inertia FROM near GROUP BY run),
best_run AS (SELECT run, k, inertia FROM inertias QUALIFY row_number() OVER (PARTITION BY k ORDER BY round(inertia, 9), run) = 1),
renamed AS (
  SELECT run, c.cluster AS cluster, row_number() OVER (PARTITION BY run ORDER BY c.x DESC, c.y DESC, c.z DESC) - 1 AS number
  FROM (SELECT run, unnest(cents) AS c FROM ends)),
labelled AS MATERIALIZED (
  SELECT b.k, n.customer_id, n.x, n.y, n.z, r.number AS cluster, n.best.d AS d
  FROM near n JOIN best_run b ON b.run = n.run JOIN renamed r ON r.run = n.run AND r.cluster = n.best.cluster)"""


@sql("kmeans_segments")
def _():
    return base().replace("WITH ", "WITH RECURSIVE ", 1) + _lloyd([4]) + """
SELECT customer_id, CAST(cluster AS INTEGER) AS cluster, round(d, 6) AS sq_distance FROM labelled"""


@sql("kmeans_sweep")
def _():
    return base().replace("WITH ", "WITH RECURSIVE ", 1) + _lloyd(range(2, 11)) + """,
groups AS (SELECT k, cluster, count(*) AS n, avg(x) AS mx, avg(y) AS my, avg(z) AS mz,
                  avg(x * x + y * y + z * z) AS mq FROM labelled GROUP BY 1, 2),
apart AS (
  SELECT l.k, l.customer_id,
         max(CASE WHEN g.cluster = l.cluster THEN g.n END) AS own,
         max(CASE WHEN g.cluster = l.cluster THEN (x * x + y * y + z * z + mq - 2 * (x * mx + y * my + z * mz)) * g.n / nullif(g.n - 1, 0) END) AS a,
         min(CASE WHEN g.cluster <> l.cluster THEN x * x + y * y + z * z + mq - 2 * (x * mx + y * my + z * mz) END) AS b
  FROM labelled l JOIN groups g ON g.k = l.k GROUP BY 1, 2),
sil AS (SELECT k, avg(CASE WHEN own = 1 OR a = b THEN 0 WHEN a < b THEN 1 - a / b ELSE b / a - 1 END) AS s FROM apart GROUP BY k)
SELECT k, round(inertia, 6) AS inertia, round(s, 6) AS silhouette,
       round(lag(inertia) OVER (ORDER BY k) - inertia, 6) AS inertia_drop,
       s > coalesce(lag(s) OVER (ORDER BY k), '-inf'::DOUBLE) AND s > coalesce(lead(s) OVER (ORDER BY k), '-inf'::DOUBLE) AS silhouette_peak
FROM best_run JOIN sil USING (k)"""
