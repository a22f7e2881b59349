"""Oracle SQL for the experimentation queries (statistics via the shared SQL formulas)."""
from bazaar.functions.stats import sql_cohens_h, sql_norm_ppf, sql_norm_sf, sql_t_sf
from bazaar.plans.oracle import AB_UNITS, CAMPAIGN, sql, with_

PREP = """cons AS (
  SELECT * FROM ab_units
  WHERE (grp = 'control' AND landing_page = 'old_page') OR (grp = 'treatment' AND landing_page = 'new_page')),
prepared AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY experiment_id, user_id ORDER BY ts, row_id) AS rn FROM cons)
  WHERE rn = 1),
summary AS (
  SELECT experiment_id, grp, count(*) AS users, CAST(sum(converted) AS BIGINT) AS conversions,
         CAST(sum(converted) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS rate,
         count(*) - CAST(sum(converted) AS BIGINT) AS non_converted
  FROM prepared GROUP BY 1, 2),
traffic AS (
  SELECT experiment_id, min(ts) AS first_ts, max(ts) AS last_ts, date_sub('day', min(ts), max(ts)) AS experiment_days,
         count(*) AS users,
         CAST(count(*) AS DOUBLE) / CAST(nullif(date_sub('day', min(ts), max(ts)), 0) AS DOUBLE) AS users_per_day
  FROM prepared GROUP BY 1),
arms AS (
  SELECT experiment_id,
         CAST(sum(CASE WHEN grp = 'control' THEN users END) AS BIGINT) AS n_c,
         CAST(sum(CASE WHEN grp = 'control' THEN conversions END) AS BIGINT) AS x_c,
         CAST(sum(CASE WHEN grp = 'treatment' THEN users END) AS BIGINT) AS n_t,
         CAST(sum(CASE WHEN grp = 'treatment' THEN conversions END) AS BIGINT) AS x_t
  FROM summary GROUP BY 1)"""


def _tested_cte(source: str = "arms", alternative: str = "two-sided", name: str = "tested") -> str:
    pval = {"two-sided": f"2 * {sql_norm_sf('abs(z)')}", "larger": sql_norm_sf("z"),
            "smaller": sql_norm_sf("-z")}[alternative]
    zc = sql_norm_ppf(repr(1 - 0.05 / 2))
    return f"""{name}0 AS (
  SELECT *, CAST(x_c AS DOUBLE) / nullif(CAST(n_c AS DOUBLE), 0) AS p_c, CAST(x_t AS DOUBLE) / nullif(CAST(n_t AS DOUBLE), 0) AS p_t,
         CAST(x_c + x_t AS DOUBLE) / nullif(CAST(n_c + n_t AS DOUBLE), 0) AS p_pool
  FROM {source}),
{name}1 AS (
  SELECT *, sqrt(p_pool * (1 - p_pool) * (1.0 / nullif(n_c, 0) + 1.0 / nullif(n_t, 0))) AS se_pooled FROM {name}0),
{name}2 AS (SELECT *, (p_t - p_c) / nullif(se_pooled, 0) AS z FROM {name}1),
{name}3 AS (
  SELECT *, {pval} AS p_value, p_t - p_c AS lift_abs, (p_t - p_c) / nullif(p_c, 0) AS lift_rel,
         '{alternative}' AS alternative
  FROM {name}2),
{name}4 AS (
  SELECT *, p_value < 0.05 AS reject_h0,
         sqrt(p_c * (1 - p_c) / nullif(n_c, 0) + p_t * (1 - p_t) / nullif(n_t, 0)) AS se_unpooled, {zc} AS z_crit
  FROM {name}3),
{name} AS (
  SELECT *, (p_t - p_c) - z_crit * se_unpooled AS ci_lower, (p_t - p_c) + z_crit * se_unpooled AS ci_upper,
         z - z_crit AS z_ci_lower, z + z_crit AS z_ci_upper
  FROM {name}4)"""


def _sizes_cte(mde: float = 0.1) -> str:
    return f"""designs AS (
  SELECT s.experiment_id, s.rate AS p1, s.rate * (1 + CAST({mde!r} AS DOUBLE)) AS p2, 0.05 AS alpha,
         0.8 AS power, t.users_per_day AS daily_traffic
  FROM summary s JOIN traffic t ON s.experiment_id = t.experiment_id WHERE s.grp = 'control'),
sizes0 AS (
  SELECT *, p2 - p1 AS abs_mde, {sql_norm_ppf('1 - CAST(0.05 AS DOUBLE) / 2')} AS z_alpha,
         {sql_norm_ppf('CAST(0.8 AS DOUBLE)')} AS z_beta, {sql_cohens_h('p1', 'p2')} AS cohens_h
  FROM designs),
sizes AS (
  SELECT *,
         CAST(trunc(pow(z_alpha + z_beta, 2) * (p1 * (1 - p1) + p2 * (1 - p2)) / nullif(pow(p2 - p1, 2), 0)) AS BIGINT) + 1
           AS n_formula,
         CAST(trunc(2 * pow((z_alpha + z_beta) / nullif(cohens_h, 0), 2)) AS BIGINT) + 1 AS n_cohen
  FROM sizes0)"""


RESULTS = """results AS (
  SELECT t.*, s.abs_mde, s.n_formula AS n_required FROM tested t JOIN sizes s ON t.experiment_id = s.experiment_id)"""


def base() -> str:
    return with_(AB_UNITS, PREP, _tested_cte(), _sizes_cte(), RESULTS)


def r6(c: str) -> str:
    return f"round({c}, 6) AS {c}"


@sql("ab_prepared")
def _():
    return base() + "SELECT experiment_id, user_id, row_id, ts, grp, landing_page, converted FROM prepared"


@sql("assignment_summary")
def _():
    return with_(AB_UNITS) + """
SELECT experiment_id, grp, landing_page, count(DISTINCT user_id) AS users, count(*) AS rows,
       CAST(sum(converted) AS BIGINT) AS conversions
FROM ab_units GROUP BY 1, 2, 3"""


@sql("conversion_summary")
def _():
    return base() + f"SELECT experiment_id, grp, users, conversions, {r6('rate')}, non_converted FROM summary"


def _sampled() -> str:
    """The md5-ordered sample, cut at each experiment's own required n."""
    return _sizes_cte(0.35) + """,
sampled AS (
  SELECT p.*, md5(CAST(user_id AS VARCHAR) || '|' || 'ab-sample') AS sample_key
  FROM prepared p JOIN sizes z USING (experiment_id)
  QUALIFY row_number() OVER (PARTITION BY experiment_id, grp ORDER BY sample_key, user_id) <= coalesce(z.n_formula, 9e18))"""


@sql("stratified_sample")
def _():
    return with_(AB_UNITS, PREP, _sampled()) + """
SELECT experiment_id, user_id, row_id, ts, grp, landing_page, converted, sample_key FROM sampled"""


@sql("traffic_summary")
def _():
    return base() + f"SELECT experiment_id, first_ts, last_ts, experiment_days, users, {r6('users_per_day')} FROM traffic"


@sql("sample_size")
def _():
    return base() + f"""
SELECT experiment_id, {r6('p1')}, {r6('p2')}, {r6('abs_mde')}, {r6('z_alpha')}, {r6('z_beta')}, {r6('cohens_h')},
       n_formula, n_cohen, 2 * n_formula AS total_n, {r6('daily_traffic')},
       round(CAST(2 * n_formula AS DOUBLE) / daily_traffic, 6) AS days_needed_exact,
       CAST(ceil(CAST(2 * n_formula AS DOUBLE) / daily_traffic) AS BIGINT) AS days_needed
FROM sizes"""


@sql("success_failure")
def _():
    return base() + f"""
SELECT experiment_id, grp, users, conversions, {r6('rate')}, non_converted,
       round(users * rate, 6) AS n_p, round(users * (1 - rate), 6) AS n_q,
       users * rate > 10 AND users * (1 - rate) > 10 AS success_failure_ok, users >= 30 AS n_at_least_30
FROM summary"""


@sql("two_proportion_z")
def _():
    cols = ", ".join(r6(c) for c in ("p_c", "p_t", "p_pool", "se_pooled", "z", "p_value", "lift_abs", "lift_rel"))
    return base() + f"SELECT experiment_id, n_c, x_c, n_t, x_t, {cols}, reject_h0 FROM tested"


@sql("two_proportion_z_larger")
def _():
    return with_(AB_UNITS, PREP, _tested_cte("arms", "larger", "tl")) + \
        f"SELECT experiment_id, {r6('z')}, {r6('p_value')}, reject_h0 FROM tl"


@sql("wald_ci")
def _():
    cols = ", ".join(r6(c) for c in ("se_unpooled", "z_crit", "ci_lower", "ci_upper", "z_ci_lower", "z_ci_upper"))
    return base() + f"SELECT experiment_id, {cols} FROM tested"


_LADDER = """
SELECT experiment_id, CASE WHEN ship THEN 'SHIP' ELSE 'DO NOT SHIP' END AS decision,
  CASE WHEN sig THEN 'Result is statistically significant (p = ' || printf('%.4f', p_value) || ' < α = 0.05).'
       ELSE 'Not statistically significant — p = ' || printf('%.4f', p_value) || ' is well above α = 0.05.' END
    AS reason_1,
  CASE WHEN ship THEN 'Treatment lifted conversion by ' || printf('%+.2f', lift_abs * 100) || ' pp ('
                      || printf('%+.2f%%', lift_rel * 100) || ' relative) in the right direction.'
       WHEN neg THEN 'But the treatment performed worse — lift is ' || printf('%+.2f', lift_abs * 100) || ' pp ('
                      || printf('%+.2f%%', lift_rel * 100) || ' relative).'
       WHEN small THEN 'But the effect is too small — lift is only ' || printf('%+.2f', lift_abs * 100)
                      || ' pp vs MDE of +' || printf('%.0f', abs_mde * 100) || ' pp.'
       WHEN powered THEN 'The test was adequately powered (' || format('{:,}', n_required) || ' per group needed, '
                      || format('{:,}', min_n) || ' collected).'
       ELSE 'The test was underpowered (' || format('{:,}', n_required) || ' per group needed, '
                      || format('{:,}', min_n) || ' collected).' END AS reason_2,
  CASE WHEN ship THEN 'CI upper bound (' || printf('%.4f', ci_upper)
                      || ') reaches the MDE — the effect is large enough to matter.'
       WHEN neg THEN 'Shipping would harm conversion. Roll back.'
       WHEN small THEN 'Even the optimistic end of the CI (' || printf('%.4f', ci_upper)
                      || ') falls short of the MDE. Not worth shipping.'
       WHEN powered THEN 'This is a genuine null, not a power problem. The new page shows no real effect.'
       ELSE 'Collect more data before drawing a conclusion.' END AS reason_3
FROM (
  SELECT *, p_value < 0.05 AS sig,
         p_value < 0.05 AND lift_abs > 0 AND NOT (ci_upper < abs_mde) AS ship,
         p_value < 0.05 AND lift_abs <= 0 AS neg,
         p_value < 0.05 AND ci_upper < abs_mde AS small,
         least(n_c, n_t) AS min_n, least(n_c, n_t) >= n_required AS powered
  FROM results)"""


@sql("decision_ladder")
def _():
    return base() + _LADDER


def _checklist(src: str, guard: str) -> str:
    return f"""
SELECT experiment_id, p_below_alpha, right_direction, lift_at_least_mde, ci_excludes_zero,
       ci_lower_at_least_mde, guardrail_ok,
       CASE WHEN coalesce(p_below_alpha AND right_direction AND lift_at_least_mde AND ci_excludes_zero
                          AND ci_lower_at_least_mde AND guardrail_ok, false) THEN 'SHIP'
            WHEN NOT coalesce(p_below_alpha, true) OR NOT coalesce(right_direction, true)
                 OR NOT coalesce(lift_at_least_mde, true) OR NOT coalesce(ci_excludes_zero, true)
                 OR NOT coalesce(ci_lower_at_least_mde, true) OR NOT coalesce(guardrail_ok, true)
            THEN 'DO NOT SHIP' ELSE 'PENDING' END AS verdict,
       CASE WHEN p_below_alpha = false THEN 'p_below_alpha' WHEN right_direction = false THEN 'right_direction'
            WHEN lift_at_least_mde = false THEN 'lift_at_least_mde'
            WHEN ci_excludes_zero = false THEN 'ci_excludes_zero'
            WHEN ci_lower_at_least_mde = false THEN 'ci_lower_at_least_mde'
            WHEN guardrail_ok = false THEN 'guardrail_ok' END AS first_failed_check
FROM (
  SELECT experiment_id, p_value < 0.05 AS p_below_alpha,
         CASE WHEN alternative = 'smaller' THEN lift_abs < 0 ELSE lift_abs > 0 END AS right_direction,
         abs(lift_abs) >= abs_mde AS lift_at_least_mde, ci_lower > 0 OR ci_upper < 0 AS ci_excludes_zero,
         ci_lower >= abs_mde AS ci_lower_at_least_mde, {guard} AS guardrail_ok
  FROM {src})"""


@sql("ship_checklist")
def _():
    return base() + _checklist("results", "CAST(NULL AS BOOLEAN)")


@sql("ci_reading")
def _():
    return base() + f"""
SELECT experiment_id, {r6('ci_lower')}, {r6('ci_upper')}, {r6('abs_mde')},
       CASE WHEN ci_upper < 0 THEN 'entirely below zero' WHEN ci_lower <= 0 THEN 'straddles zero'
            WHEN ci_upper < abs_mde THEN 'above zero, below MDE' WHEN ci_lower < abs_mde THEN 'straddles MDE'
            ELSE 'entirely above MDE' END AS ci_reading
FROM results"""


@sql("experiment_report")
def _():
    cols = ", ".join(r6(c) for c in ("p_c", "p_t", "z", "p_value", "lift_abs", "lift_rel", "ci_lower", "ci_upper",
                                     "abs_mde"))
    return base() + f""",
ladder AS ({_LADDER}),
checks AS ({_checklist('results', 'CAST(NULL AS BOOLEAN)')})
SELECT r.experiment_id, n_c, x_c, n_t, x_t, {cols}, n_required, l.decision, c.verdict, c.first_failed_check,
       CASE WHEN ci_upper < 0 THEN 'entirely below zero' WHEN ci_lower <= 0 THEN 'straddles zero'
            WHEN ci_upper < abs_mde THEN 'above zero, below MDE' WHEN ci_lower < abs_mde THEN 'straddles MDE'
            ELSE 'entirely above MDE' END AS ci_reading
FROM results r JOIN ladder l ON r.experiment_id = l.experiment_id JOIN checks c ON r.experiment_id = c.experiment_id"""


@sql("novelty_by_week")
def _():
    return with_(AB_UNITS, PREP) + f""",
wk AS (SELECT *, date_trunc('week', ts) AS week_start FROM prepared),
ws AS (SELECT experiment_id, week_start, grp, count(*) AS users, sum(converted) AS conversions FROM wk GROUP BY 1, 2, 3),
warms AS (
  SELECT experiment_id, week_start,
         CAST(sum(CASE WHEN grp = 'control' THEN users END) AS BIGINT) AS n_c,
         CAST(sum(CASE WHEN grp = 'control' THEN conversions END) AS BIGINT) AS x_c,
         CAST(sum(CASE WHEN grp = 'treatment' THEN users END) AS BIGINT) AS n_t,
         CAST(sum(CASE WHEN grp = 'treatment' THEN conversions END) AS BIGINT) AS x_t
  FROM ws GROUP BY 1, 2),
{_tested_cte('warms', 'two-sided', 'wt')},
wn AS (SELECT *, CASE WHEN lift_abs IS NOT NULL THEN date_diff('day', DATE '1970-01-05', CAST(week_start AS DATE)) / 7.0 END
         AS wkno FROM wt)
SELECT experiment_id, week_start, CAST(n_c AS DOUBLE) AS n_c, CAST(x_c AS DOUBLE) AS x_c, CAST(n_t AS DOUBLE) AS n_t,
       CAST(x_t AS DOUBLE) AS x_t, {r6('lift_abs')}, {r6('z')}, {r6('p_value')},
       round(covar_pop(lift_abs, wkno) OVER (PARTITION BY experiment_id)
             / nullif(var_pop(wkno) OVER (PARTITION BY experiment_id), 0), 6) AS lift_trend_per_week
FROM wn"""


@sql("degenerate_experiments")
def _():
    spoil = """summary_all AS (SELECT * FROM summary),
spoiled AS (
  SELECT experiment_id, grp,
         CASE WHEN experiment_id = '2-HIGH' AND grp = 'treatment' THEN 0 ELSE users END AS users,
         CASE WHEN experiment_id = '1-URGENT' AND grp = 'control' THEN 0
              WHEN experiment_id = '2-HIGH' AND grp = 'treatment' THEN 0 ELSE conversions END AS conversions
  FROM summary WHERE NOT (experiment_id = '3-MEDIUM' AND grp = 'treatment')),
sparms AS (
  SELECT experiment_id, CAST(sum(users) FILTER (WHERE grp = 'control') AS BIGINT) AS n_c,
         CAST(sum(conversions) FILTER (WHERE grp = 'control') AS BIGINT) AS x_c,
         CAST(sum(users) FILTER (WHERE grp = 'treatment') AS BIGINT) AS n_t,
         CAST(sum(conversions) FILTER (WHERE grp = 'treatment') AS BIGINT) AS x_t
  FROM spoiled GROUP BY 1)"""
    prep = PREP.replace("summary AS (", "raw_summary AS (").replace("FROM summary GROUP BY 1)", "FROM raw_summary GROUP BY 1)")
    spoil = spoil.replace("summary_all AS (SELECT * FROM summary),\n", "").replace("FROM summary WHERE", "FROM raw_summary WHERE")
    rates = """summary AS (
  SELECT experiment_id, grp, CAST(conversions AS DOUBLE) / nullif(CAST(users AS DOUBLE), 0) AS rate FROM spoiled)"""
    doubles = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in ("n_c", "x_c", "n_t", "x_t", "n_formula", "n_cohen"))
    return with_(AB_UNITS, prep, spoil, rates, _tested_cte("sparms", "two-sided", "dg"), _sizes_cte()) + f"""
SELECT d.experiment_id, {doubles}, {r6('z')}, {r6('p_value')}, {r6('ci_lower')}, {r6('ci_upper')}
FROM dg d JOIN sizes USING (experiment_id)"""


# ---- campaign ----

_RATES = """rates AS (
  SELECT *, CAST(clicks AS DOUBLE) / nullif(CAST(impressions AS DOUBLE), 0) AS ctr,
         CAST(purchases AS DOUBLE) / nullif(CAST(clicks AS DOUBLE), 0) AS conversion_rate,
         spend / nullif(CAST(clicks AS DOUBLE), 0) AS cost_per_click,
         spend / nullif(CAST(purchases AS DOUBLE), 0) AS cost_per_purchase,
         CAST(add_to_cart AS DOUBLE) / nullif(CAST(view_content AS DOUBLE), 0) AS add_to_cart_rate
  FROM campaign_daily),
totals AS (
  SELECT arm, CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(clicks) AS BIGINT) AS clicks,
         sum(spend) AS spend, CAST(sum(purchases) AS BIGINT) AS purchases, count(impressions) AS days,
         CAST(sum(clicks) AS DOUBLE) / nullif(CAST(sum(impressions) AS DOUBLE), 0) AS pooled_ctr,
         sum(spend) / nullif(CAST(sum(clicks) AS DOUBLE), 0) AS cost_per_click
  FROM campaign_daily GROUP BY 1),
guard AS (
  SELECT max(CASE WHEN arm = 'control' THEN cost_per_click END) AS cpc_control,
         max(CASE WHEN arm = 'test' THEN cost_per_click END) AS cpc_variant
  FROM totals)"""


def cbase() -> str:
    return with_(CAMPAIGN, _RATES)


@sql("daily_rates")
def _():
    cols = ", ".join(r6(c) for c in ("spend", "ctr", "conversion_rate", "cost_per_click", "cost_per_purchase",
                                     "add_to_cart_rate"))
    return cbase() + f"""SELECT arm, CAST(date AS TIMESTAMP) AS date, impressions, clicks, view_content, add_to_cart,
       purchases, {cols} FROM rates"""


@sql("campaign_totals")
def _():
    return cbase() + f"""SELECT arm, impressions, clicks, {r6('spend')}, purchases, days, {r6('pooled_ctr')},
       {r6('cost_per_click')} FROM totals"""


@sql("guardrail_cpc")
def _():
    return cbase() + f"SELECT {r6('cpc_control')}, {r6('cpc_variant')}, cpc_variant <= cpc_control * (1 + 0.0) AS guardrail_ok FROM guard"


@sql("welch_t")
def _():
    return cbase() + f""",
w0 AS (
  SELECT avg(CASE WHEN arm = 'test' THEN ctr END) AS mean_t, avg(CASE WHEN arm = 'control' THEN ctr END) AS mean_c,
         var_samp(CASE WHEN arm = 'test' THEN ctr END) AS var_t, var_samp(CASE WHEN arm = 'control' THEN ctr END) AS var_c,
         count(CASE WHEN arm = 'test' THEN ctr END) AS n_t, count(CASE WHEN arm = 'control' THEN ctr END) AS n_c
  FROM rates WHERE ctr IS NOT NULL),
w1 AS (
  SELECT *, var_t / n_t + var_c / n_c AS st FROM w0),
w2 AS (
  SELECT *, CASE WHEN st > 0 THEN (mean_t - mean_c) / sqrt(st) END AS t_stat,
         CASE WHEN st > 0 THEN pow(st, 2) / (pow(var_t / n_t, 2) / (n_t - 1) + pow(var_c / n_c, 2) / (n_c - 1)) END AS df
  FROM w1),
w3 AS (SELECT *, 2 * {sql_t_sf('abs(t_stat)', 'df')} AS p_two_sided FROM w2)
SELECT {r6('mean_t')}, {r6('mean_c')}, {r6('var_t')}, {r6('var_c')}, n_t, n_c, {r6('t_stat')}, {r6('df')},
       {r6('p_two_sided')},
       round(CASE WHEN t_stat > 0 THEN p_two_sided / 2 ELSE 1 - p_two_sided / 2 END, 6) AS p_one_sided
FROM w3"""


@sql("qq_points")
def _():
    return cbase() + f""",
v AS (SELECT arm, ctr AS value FROM rates WHERE ctr IS NOT NULL),
r AS (SELECT arm, value, row_number() OVER (PARTITION BY arm ORDER BY value) AS i,
             count(*) OVER (PARTITION BY arm) AS n FROM v),
p AS (
  SELECT *, CASE WHEN i = n THEN pow(0.5, 1.0 / n) WHEN i = 1 THEN 1 - pow(0.5, 1.0 / n)
                 ELSE (i - 0.3175) / (n + 0.365) END AS position FROM r),
q AS (SELECT *, {sql_norm_ppf('position')} AS theoretical FROM p),
fit AS (SELECT arm, regr_slope(value, theoretical) AS slope, regr_intercept(value, theoretical) AS intercept,
               corr(value, theoretical) AS r FROM q GROUP BY 1)
SELECT q.arm, q.i, q.n, round(q.value, 6) AS value, round(q.position, 6) AS position,
       round(q.theoretical, 6) AS theoretical, round(f.slope, 6) AS slope, round(f.intercept, 6) AS intercept,
       round(f.r, 6) AS r
FROM q JOIN fit f ON q.arm = f.arm"""


@sql("campaign_checklist")
def _():
    arms = """carms AS (
  SELECT 'campaign' AS experiment_id,
         CAST(sum(CASE WHEN arm = 'control' THEN impressions END) AS BIGINT) AS n_c,
         CAST(sum(CASE WHEN arm = 'control' THEN clicks END) AS BIGINT) AS x_c,
         CAST(sum(CASE WHEN arm = 'test' THEN impressions END) AS BIGINT) AS n_t,
         CAST(sum(CASE WHEN arm = 'test' THEN clicks END) AS BIGINT) AS x_t
  FROM totals)"""
    res = """cres AS (
  SELECT c.*, c.p_c * 0.1 AS abs_mde, g.cpc_variant <= g.cpc_control * (1 + 0.0) AS gok FROM ct c, guard g)"""
    return with_(CAMPAIGN, _RATES, arms, _tested_cte("carms", "larger", "ct"), res) + _checklist("cres", "gok")


@sql("multi_arm_anova")
def _():
    from bazaar.functions.stats import sql_f_sf
    return f"""WITH g0 AS (
  SELECT o_orderpriority AS experiment_id,
         CASE o_custkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS arm,
         count(o_totalprice) AS n, avg(ln(1 + o_totalprice)) AS m, var_samp(ln(1 + o_totalprice)) AS s2
  FROM orders GROUP BY 1, 2),
g1 AS (SELECT * , n / s2 AS w FROM g0 WHERE n > 1 AND s2 > 0),
g2 AS (SELECT *, sum(w) OVER (PARTITION BY experiment_id) AS wsum,
              sum(w * m) OVER (PARTITION BY experiment_id) / sum(w) OVER (PARTITION BY experiment_id) AS mw
       FROM g1),
t AS (
  SELECT experiment_id, count(*) AS arms, sum(w * pow(m - mw, 2)) AS a, sum(pow(1 - w / wsum, 2) / (n - 1)) AS lam
  FROM g2 GROUP BY 1),
t2 AS (
  SELECT *, (a / (arms - 1)) / (1 + 2 * (arms - 2) * lam / (arms * arms - 1)) AS f_stat,
         CAST(arms - 1 AS DOUBLE) AS df1, (arms * arms - 1) / (3 * lam) AS df2
  FROM t WHERE arms >= 2)
SELECT e.experiment_id, coalesce(t.arms, 0) AS arms, {r6('f_stat')}, {r6('df1')}, {r6('df2')},
       round({sql_f_sf('f_stat', 'df1', 'df2')}, 6) AS p_value,
       CASE WHEN t2.arms IS NULL THEN 'fewer than two arms with spread' END AS reason
FROM (SELECT DISTINCT experiment_id FROM g0) e LEFT JOIN t ON e.experiment_id = t.experiment_id
     LEFT JOIN t2 ON e.experiment_id = t2.experiment_id"""


@sql("pilot_sample_size")
def _():
    """The same hash weights, joined as rows; quantiles of the sizes by quantile_cont."""
    import math
    steps = ", ".join(str(int(2 ** 32 * sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)))) for k in range(12))
    return f"""WITH spend AS (
  SELECT o_orderpriority AS experiment_id, o_custkey, sum(o_totalprice) AS x FROM orders GROUP BY 1, 2),
draws AS (
  SELECT experiment_id, x, 4 * b + i AS replicate,
         CAST('0x' || substr(md5(CAST(o_custkey AS VARCHAR) || '|pilot|' || CAST(b AS VARCHAR)), CAST(8 * i + 1 AS INTEGER), 8) AS BIGINT) AS u
  FROM spend, range(16) bs(b), range(4) ws(i)),
weighted AS (
  SELECT experiment_id, -1 AS replicate, x, 1.0::DOUBLE AS w FROM spend
  UNION ALL SELECT experiment_id, replicate, x, CAST(len(list_filter([{steps}], lambda t: u >= t)) AS DOUBLE) FROM draws),
both_scales AS (
  SELECT experiment_id, replicate, 'raw' AS scale, x AS v, w FROM weighted WHERE w > 0
  UNION ALL SELECT experiment_id, replicate, 'log1p', ln(1 + x), w FROM weighted WHERE w > 0),
moments AS (
  SELECT experiment_id, replicate, scale, count(*) AS n, sum(w * v) / sum(w) AS mean,
         sqrt((sum(w * v * v) - sum(w * v) * sum(w * v) / sum(w)) / (sum(w) - 1)) AS sd
  FROM both_scales GROUP BY 1, 2, 3),
sized AS (
  SELECT *, 2 * pow(({sql_norm_ppf('CAST(0.975 AS DOUBLE)')} + {sql_norm_ppf('CAST(0.8 AS DOUBLE)')}) * sd
                    / CASE scale WHEN 'raw' THEN abs(mean) * 0.05::DOUBLE ELSE ln(1.05::DOUBLE) END, 2) AS size
  FROM moments)
SELECT s.experiment_id, s.scale, s.n AS pilot_units, round(s.mean, 6) AS mean, round(s.sd, 6) AS sd,
       trunc(s.size) + 1 AS n_required, trunc(r.low) + 1 AS n_low, trunc(r.high) + 1 AS n_high, r.replicates
FROM sized s JOIN (
  SELECT experiment_id, scale, quantile_cont(size, 0.05) AS low, quantile_cont(size, 0.95) AS high, count(size) AS replicates
  FROM sized WHERE replicate >= 0 GROUP BY 1, 2) r ON r.experiment_id = s.experiment_id AND r.scale = s.scale
WHERE s.replicate = -1"""


@sql("fisher_exact")
def _():
    from bazaar.functions.stats import sql_log_factorial as lf

    def logp(x):
        return (f"({lf('(x_c + x_t)')} + {lf('(n_c + n_t - x_c - x_t)')} - {lf('(n_c + n_t)')} + {lf('n_t')} "
                f"+ {lf('n_c')} - {lf(x)} - {lf(f'(x_c + x_t - {x})')} - {lf(f'(n_t - {x})')} "
                f"- {lf(f'(n_c - x_c - x_t + {x})')})")
    rng = "range(greatest(0, x_c + x_t - n_c), least(x_c + x_t, n_t) + 1)"
    two = (f"list_reduce(list_transform({rng}, lambda x: CASE WHEN {logp('x')} <= lobs + {__import__('math').log1p(1e-7)!r} "
           f"THEN exp({logp('x')}) ELSE 0.0 END), lambda p, q: p + q)")
    greater = (f"list_reduce(list_transform({rng}, lambda x: CASE WHEN x >= x_t THEN exp({logp('x')}) ELSE 0.0 END), "
               f"lambda p, q: p + q)")
    return base() + f""",
fe AS (SELECT *, {logp('x_t')} AS lobs FROM arms)
SELECT experiment_id, n_c, x_c, n_t, x_t, round(least(1.0, {two}), 6) AS p_two_sided,
       round(least(1.0, {greater}), 6) AS p_greater
FROM fe"""


@sql("dedup_first")
def _():
    return with_(AB_UNITS) + """
SELECT experiment_id, user_id, row_id, ts, grp, landing_page, converted FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment_id, user_id ORDER BY ts, row_id) AS rn FROM ab_units)
WHERE rn = 1"""


@sql("adequacy")
def _():
    return base() + """
SELECT s.experiment_id, s.grp, s.users, z.n_formula AS n_required, s.users >= z.n_formula AS adequate
FROM summary s JOIN sizes z ON s.experiment_id = z.experiment_id"""


@sql("sampled_z_test")
def _():
    sample = """ssum AS (
  SELECT experiment_id, grp, count(*) AS users, CAST(sum(converted) AS BIGINT) AS conversions,
         CAST(sum(converted) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS rate
  FROM sampled GROUP BY 1, 2),
sok AS (
  SELECT experiment_id, bool_and(users * rate > 10 AND users * (1 - rate) > 10) AS normal_approx_ok
  FROM ssum GROUP BY 1),
sarms AS (
  SELECT experiment_id,
         CAST(sum(CASE WHEN grp = 'control' THEN users END) AS BIGINT) AS n_c,
         CAST(sum(CASE WHEN grp = 'control' THEN conversions END) AS BIGINT) AS x_c,
         CAST(sum(CASE WHEN grp = 'treatment' THEN users END) AS BIGINT) AS n_t,
         CAST(sum(CASE WHEN grp = 'treatment' THEN conversions END) AS BIGINT) AS x_t
  FROM ssum GROUP BY 1)"""
    cols = ", ".join(r6(c) for c in ("z", "p_value", "lift_abs", "ci_lower", "ci_upper"))
    return with_(AB_UNITS, PREP, _sampled(), sample, _tested_cte("sarms", "two-sided", "st")) + f"""
SELECT t.experiment_id, n_c, x_c, n_t, x_t, {cols}, reject_h0, o.normal_approx_ok
FROM st t JOIN sok o ON t.experiment_id = o.experiment_id"""


@sql("campaign_z_test")
def _():
    arms = """zarms AS (
  SELECT 'campaign' AS experiment_id,
         CAST(sum(CASE WHEN arm = 'control' THEN impressions END) AS BIGINT) AS n_c,
         CAST(sum(CASE WHEN arm = 'control' THEN clicks END) AS BIGINT) AS x_c,
         CAST(sum(CASE WHEN arm = 'test' THEN impressions END) AS BIGINT) AS n_t,
         CAST(sum(CASE WHEN arm = 'test' THEN clicks END) AS BIGINT) AS x_t
  FROM totals),
zok AS (
  SELECT 'campaign' AS experiment_id,
         bool_and(impressions * pooled_ctr > 10 AND impressions * (1 - pooled_ctr) > 10) AS success_failure_ok,
         bool_and(impressions >= 30) AS n_at_least_30
  FROM totals)"""
    cols = ", ".join(r6(c) for c in ("p_c", "p_t", "p_pool", "z", "p_value"))
    return with_(CAMPAIGN, _RATES, arms, _tested_cte("zarms", "larger", "zt")) + f"""
SELECT t.experiment_id, n_c, x_c, n_t, x_t, {cols}, p_value < 0.10 AS reject_h0, o.success_failure_ok,
       o.n_at_least_30
FROM zt t JOIN zok o ON t.experiment_id = o.experiment_id"""
