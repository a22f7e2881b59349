"""A/B-test design, testing and verdicts (survey 2.K with 2.D2, 2.D3, 2.D27, 2.D30, 2.E9).

Every operator works on a table keyed by ``experiment_id``: one pass
aggregates the unit rows per (experiment, arm); the statistics after that
are column expressions over one row per experiment (see
:mod:`bazaar.functions.stats`), so many experiments are tested at once.
Sign convention: every difference is treatment - control (N10).
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.functions import stats as ST
from bazaar.functions.columns import fill, ratio, week_start
from bazaar.operators.cleaning import consistent_assignment
from bazaar.operators.profile import attach
from bazaar.operators.ranking import dedup_first, row_number_within

EXP = "experiment_id"
# The valid (arm, landing page) pairs of the page test.
VALID_PAIRS = (("control", "old_page"), ("treatment", "new_page"))
# The conclusion report's verdict texts, in report order
# ({p} p-value .4f, {pp} lift in points +.2f, {rel} relative lift +.2%,
# {mde} MDE in points .0f, {ci} CI upper bound .4f, {need}/{got} sample sizes).
REASON_SIG = "Result is statistically significant (p = {p} < α = {alpha})."
REASON_NOT_SIG = "Not statistically significant — p = {p} is well above α = {alpha}."
REASON_LIFT = "Treatment lifted conversion by {pp} pp ({rel} relative) in the right direction."
REASON_CI_MDE = "CI upper bound ({ci}) reaches the MDE — the effect is large enough to matter."
REASON_WORSE = "But the treatment performed worse — lift is {pp} pp ({rel} relative)."
REASON_ROLL_BACK = "Shipping would harm conversion. Roll back."
REASON_SMALL = "But the effect is too small — lift is only {pp} pp vs MDE of +{mde} pp."
REASON_SHORT = "Even the optimistic end of the CI ({ci}) falls short of the MDE. Not worth shipping."
REASON_POWERED = "The test was adequately powered ({need} per group needed, {got} collected)."
REASON_NULL = "This is a genuine null, not a power problem. The new page shows no real effect."
# Not in the reference (its null text assumes enough data): the underpowered case.
REASON_UNDERPOWERED = "The test was underpowered ({need} per group needed, {got} collected)."
REASON_MORE_DATA = "Collect more data before drawing a conclusion."
# Filliben's plotting positions (i - a) / (n + b) of the Q-Q plot.
FILLIBEN_A, FILLIBEN_B = 0.3175, 0.365
# The six ship checks, in order.
SHIP_CHECKS = ("p_below_alpha", "right_direction", "lift_at_least_mde", "ci_excludes_zero",
               "ci_lower_at_least_mde", "guardrail_ok")


# ---------------------------------------------------------------- design --

def mde_columns(designs: DataFrame) -> DataFrame:
    """K1: p2 from a relative MDE when missing; absolute and relative MDE."""
    p2 = F.coalesce(F.col("p2"), F.col("p1") * (1 + F.col("relative_mde")))
    return (designs.withColumn("p2", p2)
                   .withColumn("abs_mde", F.col("p2") - F.col("p1"))
                   .withColumn("relative_mde", ratio(F.col("p2") - F.col("p1"), F.col("p1"))))


def _z_alpha(alpha: Column, alternative: Column) -> Column:
    return F.when(alternative == "two-sided", ST.norm_ppf(1 - alpha / 2)).otherwise(ST.norm_ppf(1 - alpha))


def sample_size(designs: DataFrame) -> DataFrame:
    """K2/K3/K4: per-arm n by the variance formula and by Cohen's h, and duration.

    n = int(x) + 1 (N12).  Cohen's h uses the closed form 2((z_a+z_b)/h)^2
    of the power equation (the opposite tail is negligible).  A baseline that
    leaves no difference to detect (p1 = p2) has NULL sizes.
    """
    d = mde_columns(designs)
    za = _z_alpha(F.col("alpha"), F.col("alternative"))
    zb = ST.norm_ppf(F.col("power"))
    d = d.withColumn("z_alpha", za).withColumn("z_beta", zb)
    var = F.col("p1") * (1 - F.col("p1")) + F.col("p2") * (1 - F.col("p2"))
    n_formula = ratio(F.pow(F.col("z_alpha") + F.col("z_beta"), 2) * var, F.pow(F.col("p2") - F.col("p1"), 2))
    h = ST.cohens_h(F.col("p1"), F.col("p2"))
    n_cohen = 2 * F.pow(ratio(F.col("z_alpha") + F.col("z_beta"), h), 2)
    d = (d.withColumn("cohens_h", h)
          .withColumn("n_formula", n_formula.cast("long") + 1)
          .withColumn("n_cohen", n_cohen.cast("long") + 1))
    return (d.withColumn("total_n", 2 * F.col("n_formula"))
             .withColumn("days_needed_exact", ratio(F.col("total_n"), F.col("daily_traffic")))
             .withColumn("days_needed", F.ceil(F.col("days_needed_exact")).cast("long")))


# ------------------------------------------------------------ unit rows --

def prepare_ab(units: DataFrame, pairs: Sequence[tuple[str, str]] = VALID_PAIRS,
               key: Sequence[str] = (EXP, "user_id"), order: Sequence[str] = ("ts", "row_id")) -> DataFrame:
    """K6: consistent (arm, page) rows, then the first row per user."""
    return dedup_first(consistent_assignment(units, pairs), list(key), list(order))


def assignment_summary(units: DataFrame) -> DataFrame:
    """Users, rows and conversions per experiment x arm x page (raw rows)."""
    return units.groupBy(EXP, "grp", "landing_page").agg(
        F.count_distinct("user_id").alias("users"), F.count(F.lit(1)).alias("rows"),
        F.sum("converted").cast("long").alias("conversions"))


def arm_stats(prepared: DataFrame, arm: str = "grp", ts: str = "ts") -> DataFrame:
    """One aggregate per experiment x arm: units, conversions, first and last timestamp.

    Everything after the unit rows (summary, traffic, designs, tests) derives
    from this small table, so the unit rows are read once.
    """
    return prepared.groupBy(EXP, arm).agg(F.count(F.lit(1)).alias("users"),
                                          F.sum("converted").cast("long").alias("conversions"),
                                          F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def summary_from_stats(stats: DataFrame, arm: str = "grp") -> DataFrame:
    return stats.select(EXP, arm, "users", "conversions",
                        ratio(F.col("conversions"), F.col("users")).alias("rate"),
                        (F.col("users") - F.col("conversions")).alias("non_converted"))


def traffic_from_stats(stats: DataFrame) -> DataFrame:
    t = stats.groupBy(EXP).agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
                               F.sum("users").alias("users"))
    days = F.timestamp_diff("DAY", F.col("first_ts"), F.col("last_ts"))
    return t.select(EXP, "first_ts", "last_ts", days.alias("experiment_days"), "users",
                    ratio(F.col("users"), days).alias("users_per_day"))


def conversion_summary(prepared: DataFrame, arm: str = "grp") -> DataFrame:
    """D3: users, conversions, rate and non-converted per experiment x arm."""
    return summary_from_stats(arm_stats(prepared, arm), arm)


def stratified_sample(prepared: DataFrame, sizes: DataFrame, salt: str, by: Sequence[str] = (EXP, "grp"),
                      unit: str = "user_id", required: str = "n_required") -> DataFrame:
    """The required n units per stratum, ranked by md5(unit || '|' || salt).

    ``sizes`` holds the required n per experiment (column ``required``); a
    smaller arm is kept whole, as is one without a required n.  Strata are
    numbered by range partitions, so a large n is not ranked in one task.
    """
    h = F.md5(F.concat(F.col(unit).cast("string"), F.lit("|"), F.lit(salt)))
    ranked = row_number_within(prepared.withColumn("sample_key", h), list(by),
                               [F.col("sample_key"), F.col(unit)], "__rn")
    return (ranked.join(sizes.select(EXP, F.col(required).alias("__n")), EXP, "left")
            .where(F.col("__n").isNull() | (F.col("__rn") <= F.col("__n"))).drop("__rn", "__n"))


def traffic_summary(prepared: DataFrame, ts: str = "ts", arm: str = "grp") -> DataFrame:
    """Experiment span in whole days, users and users per day."""
    return traffic_from_stats(arm_stats(prepared, arm, ts))


def designs_from_data(summary: DataFrame, traffic: DataFrame, relative_mde: float = 0.10,
                      alpha: float = 0.05, power: float = 0.8, alternative: str = "two-sided",
                      control: str = "control", arm: str = "grp") -> DataFrame:
    """One design row per experiment: baseline = observed control rate, traffic = users/day.

    An experiment without a control arm keeps its row, with a NULL baseline.
    """
    base = summary.groupBy(EXP).agg(F.max(F.when(F.col(arm) == control, F.col("rate"))).alias("p1"))
    return base.join(traffic.select(EXP, F.col("users_per_day").alias("daily_traffic")), EXP).select(
        EXP, "p1", F.lit(None).cast("double").alias("p2"), F.lit(relative_mde).alias("relative_mde"),
        F.lit(alpha).alias("alpha"), F.lit(power).alias("power"), F.lit(alternative).alias("alternative"),
        "daily_traffic")


# --------------------------------------------------------------- testing --

def success_failure(summary: DataFrame, min_count: float = 10, min_n: int = 30) -> DataFrame:
    """K8/K9: n*p and n*(1-p) above ``min_count`` (strict), n >= ``min_n``."""
    npos = F.col("users") * F.col("rate")
    nneg = F.col("users") * (1 - F.col("rate"))
    return summary.select(*summary.columns, npos.alias("n_p"), nneg.alias("n_q"),
                          ((npos > min_count) & (nneg > min_count)).alias("success_failure_ok"),
                          (F.col("users") >= min_n).alias("n_at_least_30"))


def arms(summary: DataFrame, control: str = "control", treatment: str = "treatment",
         arm: str = "grp", n: str = "users", x: str = "conversions") -> DataFrame:
    """One row per experiment: n_c, x_c, n_t, x_t (conditional aggregation)."""
    def pick(a, c):
        return F.sum(F.when(F.col(arm) == a, F.col(c)))
    return summary.groupBy(EXP).agg(pick(control, n).cast("long").alias("n_c"),
                                    pick(control, x).cast("long").alias("x_c"),
                                    pick(treatment, n).cast("long").alias("n_t"),
                                    pick(treatment, x).cast("long").alias("x_t"))


def two_proportion_z(a: DataFrame, alternative: str = "two-sided", alpha: float = 0.05) -> DataFrame:
    """Pooled z-test (N11), lift, reject flag.

    ``larger``: treatment above control; ``smaller``: below.  An empty or
    missing arm, or a pooled rate of 0 or 1, gives NULL for that row only.
    """
    p_c, p_t = ratio(F.col("x_c"), F.col("n_c")), ratio(F.col("x_t"), F.col("n_t"))
    pool = ratio(F.col("x_c") + F.col("x_t"), F.col("n_c") + F.col("n_t"))
    d = a.withColumn("p_c", p_c).withColumn("p_t", p_t).withColumn("p_pool", pool)
    se = F.sqrt(F.col("p_pool") * (1 - F.col("p_pool")) * (ratio(F.lit(1.0), F.col("n_c")) + ratio(F.lit(1.0), F.col("n_t"))))
    d = d.withColumn("se_pooled", se).withColumn("z", F.try_divide(F.col("p_t") - F.col("p_c"), F.col("se_pooled")))
    if alternative == "two-sided":
        p = 2 * ST.norm_sf(F.abs(F.col("z")))
    elif alternative == "larger":
        p = ST.norm_sf(F.col("z"))
    elif alternative == "smaller":
        p = ST.norm_sf(-F.col("z"))
    else:
        raise ValueError(alternative)
    d = d.withColumn("p_value", p).withColumn("alternative", F.lit(alternative))
    return (d.withColumn("lift_abs", F.col("p_t") - F.col("p_c"))
             .withColumn("lift_rel", ratio(F.col("p_t") - F.col("p_c"), F.col("p_c")))
             .withColumn("alpha", F.lit(alpha))
             .withColumn("reject_h0", F.col("p_value") < F.lit(alpha)))


def wald_ci(tested: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Unpooled Wald CI on p_t - p_c, and the CI in z space."""
    se = F.sqrt(ratio(F.col("p_c") * (1 - F.col("p_c")), F.col("n_c")) + ratio(F.col("p_t") * (1 - F.col("p_t")), F.col("n_t")))
    zc = ST.norm_ppf(F.lit(1 - alpha / 2))
    d = tested.withColumn("se_unpooled", se).withColumn("z_crit", zc)
    diff = F.col("p_t") - F.col("p_c")
    return (d.withColumn("ci_lower", diff - F.col("z_crit") * F.col("se_unpooled"))
             .withColumn("ci_upper", diff + F.col("z_crit") * F.col("se_unpooled"))
             .withColumn("z_ci_lower", F.col("z") - F.col("z_crit"))
             .withColumn("z_ci_upper", F.col("z") + F.col("z_crit")))


# ------------------------------------------------------------- decisions --

def _pct(x: Column) -> Column:       # {:+.2%}
    return F.format_string("%+.2f%%", x * 100)


def ladder_columns(alpha: float = 0.05) -> dict[str, Column]:
    """The ladder's decision and its three reasons as columns over one row per experiment."""
    a = F.lit(str(alpha))
    sig = F.col("p_value") < alpha
    excl_mde = F.col("ci_upper") < F.col("abs_mde")
    fields = dict(p=F.format_string("%.4f", F.col("p_value")), alpha=a,
                  pp=F.format_string("%+.2f", F.col("lift_abs") * 100), rel=_pct(F.col("lift_rel")),
                  mde=F.format_string("%.0f", F.col("abs_mde") * 100),
                  ci=F.format_string("%.4f", F.col("ci_upper")),
                  need=F.format_number(F.col("n_required"), 0),
                  got=F.format_number(F.least(F.col("n_c"), F.col("n_t")), 0))
    powered = F.least(F.col("n_c"), F.col("n_t")) >= F.col("n_required")
    ship = sig & (F.col("lift_abs") > 0) & ~excl_mde
    neg = sig & (F.col("lift_abs") <= 0)
    small = sig & excl_mde
    decision = F.when(ship, "SHIP").otherwise("DO NOT SHIP")
    r1 = F.when(sig, fill(REASON_SIG, **fields)).otherwise(fill(REASON_NOT_SIG, **fields))
    r2 = (F.when(ship, fill(REASON_LIFT, **fields)).when(neg, fill(REASON_WORSE, **fields))
           .when(small, fill(REASON_SMALL, **fields)).when(powered, fill(REASON_POWERED, **fields))
           .otherwise(fill(REASON_UNDERPOWERED, **fields)))
    r3 = (F.when(ship, fill(REASON_CI_MDE, **fields)).when(neg, F.lit(REASON_ROLL_BACK))
           .when(small, fill(REASON_SHORT, **fields)).when(powered, F.lit(REASON_NULL))
           .otherwise(F.lit(REASON_MORE_DATA)))
    return {"decision": decision, "reason_1": r1, "reason_2": r2, "reason_3": r3}


def decide_ladder(results: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Significance -> direction -> CI vs MDE, with three reasons.

    Needs p_value, lift_abs, lift_rel, ci_upper, abs_mde, n_required, n_c, n_t.
    The null-result text depends on whether the test reached its sample size.
    """
    return results.select(EXP, *[c.alias(n) for n, c in ladder_columns(alpha).items()])


def with_checklist(results: DataFrame, alpha: float = 0.05, guardrail: str | None = "guardrail_ok") -> DataFrame:
    """``results`` with the six ship checks, the verdict and the first failed check."""
    direction = F.when(F.col("alternative") == "smaller", F.col("lift_abs") < 0).otherwise(F.col("lift_abs") > 0)
    g = F.col(guardrail) if guardrail and guardrail in results.columns else F.lit(None).cast("boolean")
    checks = [F.col("p_value") < alpha, direction, F.abs(F.col("lift_abs")) >= F.col("abs_mde"),
              (F.col("ci_lower") > 0) | (F.col("ci_upper") < 0), F.col("ci_lower") >= F.col("abs_mde"), g]
    d = results.withColumns(dict(zip(SHIP_CHECKS, checks)))
    any_false = F.lit(False)
    all_true = F.lit(True)
    first = F.lit(None).cast("string")
    for n in reversed(SHIP_CHECKS):
        first = F.when(F.col(n) == F.lit(False), F.lit(n)).otherwise(first)
    for n in SHIP_CHECKS:
        any_false = any_false | F.coalesce(~F.col(n), F.lit(False))
        all_true = all_true & F.coalesce(F.col(n), F.lit(False))
    verdict = F.when(all_true, "SHIP").when(any_false, "DO NOT SHIP").otherwise("PENDING")
    return d.withColumns({"verdict": verdict, "first_failed_check": first})


def ship_checklist(results: DataFrame, alpha: float = 0.05, guardrail: str | None = "guardrail_ok") -> DataFrame:
    """The six ship checks, the verdict and the first failed check.

    A missing guardrail is an open check (NULL): the verdict is then
    ``PENDING`` unless another check fails.
    """
    return with_checklist(results, alpha, guardrail).select(EXP, *SHIP_CHECKS, "verdict", "first_failed_check")


def _reading() -> Column:
    lo, hi, m = F.col("ci_lower"), F.col("ci_upper"), F.col("abs_mde")
    return (F.when(hi < 0, "entirely below zero").when(lo <= 0, "straddles zero")
             .when(hi < m, "above zero, below MDE").when(lo < m, "straddles MDE")
             .otherwise("entirely above MDE"))


def ci_reading(results: DataFrame) -> DataFrame:
    """Where the CI sits relative to 0 and the MDE."""
    return results.select(EXP, "ci_lower", "ci_upper", "abs_mde", _reading().alias("ci_reading"))


# -------------------------------------------------------------- campaign --

def add_campaign_metrics(daily: DataFrame) -> DataFrame:
    """CTR, conversion rate, CPC, cost per purchase, add-to-cart rate (NULL on /0)."""
    return daily.select(
        "*", ratio(F.col("clicks"), F.col("impressions")).alias("ctr"),
        ratio(F.col("purchases"), F.col("clicks")).alias("conversion_rate"),
        ratio(F.col("spend"), F.col("clicks")).alias("cost_per_click"),
        ratio(F.col("spend"), F.col("purchases")).alias("cost_per_purchase"),
        ratio(F.col("add_to_cart"), F.col("view_content")).alias("add_to_cart_rate"))


def campaign_totals(daily: DataFrame, arm: str = "arm") -> DataFrame:
    """Totals per arm and the pooled CTR (sums skip missing days, N4)."""
    t = daily.groupBy(arm).agg(F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
                               F.sum("spend").alias("spend"), F.sum("purchases").alias("purchases"),
                               F.count("impressions").alias("days"))
    return t.select("*", ratio(F.col("clicks"), F.col("impressions")).alias("pooled_ctr"),
                    ratio(F.col("spend"), F.col("clicks")).alias("cost_per_click"))


def guardrail_cpc(daily: DataFrame, tolerance: float = 0.0, control: str = "control", variant: str = "test",
                  arm: str = "arm") -> DataFrame:
    """Variant CPC must not exceed control CPC x (1 + tolerance)."""
    t = campaign_totals(daily, arm)
    cpc = lambda a: F.max(F.when(F.col(arm) == a, F.col("cost_per_click")))
    g = t.agg(cpc(control).alias("cpc_control"), cpc(variant).alias("cpc_variant"))
    return g.select("*", (F.col("cpc_variant") <= F.col("cpc_control") * (1 + tolerance)).alias("guardrail_ok"))


def welch_t(df: DataFrame, value: str, arm: str = "arm", treatment: str = "test", control: str = "control",
            by: Sequence[str] = ()) -> DataFrame:
    """Welch t on per-unit values (NULLs dropped), two-sided and right-tail p.

    Arms with one value or zero variance give a NULL statistic.
    """
    by = list(by)
    v = df.where(F.col(value).isNotNull())

    def m(a, f):
        return f(F.when(F.col(arm) == a, F.col(value)))
    g = v.groupBy(*by).agg(m(treatment, F.avg).alias("mean_t"), m(control, F.avg).alias("mean_c"),
                           m(treatment, F.var_samp).alias("var_t"), m(control, F.var_samp).alias("var_c"),
                           m(treatment, F.count).alias("n_t"), m(control, F.count).alias("n_c"))
    st = ratio(F.col("var_t"), F.col("n_t")) + ratio(F.col("var_c"), F.col("n_c"))
    t = F.try_divide(F.col("mean_t") - F.col("mean_c"), F.sqrt(st))
    dfree = F.try_divide(F.pow(st, 2), ratio(F.pow(ratio(F.col("var_t"), F.col("n_t")), 2), F.col("n_t") - 1)
                         + ratio(F.pow(ratio(F.col("var_c"), F.col("n_c")), 2), F.col("n_c") - 1))
    g = g.withColumn("t_stat", F.when(st > 0, t)).withColumn("df", F.when(st > 0, dfree))
    two = 2 * ST.t_sf(F.abs(F.col("t_stat")), F.col("df"))
    g = g.withColumn("p_two_sided", two)
    return g.withColumn("p_one_sided", F.when(F.col("t_stat") > 0, F.col("p_two_sided") / 2)
                        .otherwise(1 - F.col("p_two_sided") / 2))


def qq_points(df: DataFrame, value: str, by: Sequence[str] = ("arm",)) -> DataFrame:
    """Ordered values against normal quantiles at Filliben's positions, with the
    least-squares line per group.  The order statistic comes from the distributed
    row number, so a large group is not sorted in one task.
    """
    by = list(by)
    v = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("value"))
    ranked = row_number_within(v, by, [F.col("value")], "i")
    n = v.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    j = ranked.join(n, by) if by else attach(ranked, n)
    i, nn = F.col("i").cast("double"), F.col("n").cast("double")
    last = F.pow(F.lit(0.5), 1.0 / nn)
    pos = (F.when(F.col("i") == F.col("n"), last).when(F.col("i") == 1, 1 - last)
            .otherwise((i - FILLIBEN_A) / (nn + FILLIBEN_B)))
    pts = j.withColumn("position", pos).withColumn("theoretical", ST.norm_ppf(F.col("position")))
    fit = pts.groupBy(*by).agg(F.regr_slope("value", "theoretical").alias("slope"),
                               F.regr_intercept("value", "theoretical").alias("intercept"),
                               F.corr("value", "theoretical").alias("r"))
    return (pts.join(fit, by) if by else attach(pts, fit)).select(
        *by, "i", "n", "value", "position", "theoretical", "slope", "intercept", "r")


def experiment_report(tested: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row per experiment with counts, rates, test, CI, sample size and verdicts."""
    r = with_checklist(tested.join(sizes.select(EXP, "abs_mde", F.col("n_formula").alias("n_required")), EXP))
    return (r.withColumns({"decision": ladder_columns()["decision"], "ci_reading": _reading()})
             .select(EXP, "n_c", "x_c", "n_t", "x_t", "p_c", "p_t", "z", "p_value", "lift_abs", "lift_rel",
                     "ci_lower", "ci_upper", "abs_mde", "n_required", "decision", "verdict",
                     "first_failed_check", "ci_reading"))


def novelty_by_week(prepared: DataFrame, ts: str = "ts", alpha: float = 0.05) -> DataFrame:
    """K23 (novelty): the z-test per experiment and calendar week of first exposure,
    plus each experiment's lift trend over weeks (least-squares slope).  A week
    that one arm did not reach stays, with NULL statistics."""
    wk = prepared.withColumn("week_start", week_start(F.col(ts)))
    s = wk.groupBy(EXP, "week_start", "grp").agg(F.count(F.lit(1)).alias("users"),
                                                   F.sum("converted").cast("long").alias("conversions"))
    a = s.groupBy(EXP, "week_start").agg(
        *[F.sum(F.when(F.col("grp") == g, F.col(c))).cast("long").alias(o)
          for g, c, o in (("control", "users", "n_c"), ("control", "conversions", "x_c"),
                          ("treatment", "users", "n_t"), ("treatment", "conversions", "x_t"))])
    t = two_proportion_z(a, "two-sided", alpha)
    w = Window.partitionBy(EXP)      # one experiment's weeks
    week_no = F.datediff(F.to_date("week_start"), F.lit("1970-01-05").cast("date")) / 7.0
    t = t.withColumn("__wk", F.when(F.col("lift_abs").isNotNull(), week_no))
    slope = F.try_divide(F.covar_pop("lift_abs", "__wk").over(w), F.var_pop("__wk").over(w))
    return t.select(EXP, "week_start", "n_c", "x_c", "n_t", "x_t", "lift_abs", "z", "p_value",
                    slope.alias("lift_trend_per_week"))


def multi_arm_anova(df: DataFrame, value: str, arm: str, by: Sequence[str] = (EXP,),
                    log1p: bool = True) -> DataFrame:
    """Welch's ANOVA across arms (unequal variances), on log1p(value) by default.

    Per-arm moments come from one aggregate; the test itself runs over one
    row per arm (a window over an experiment's arms only).  Arms with fewer
    than two values or zero variance have no weight; an experiment with fewer
    than two weighted arms keeps its row with NULL statistics and a reason.
    """
    by = list(by)
    y = F.log1p(F.col(value)) if log1p else F.col(value).cast("double")
    g = (df.groupBy(*by, arm).agg(F.count(F.col(value)).alias("n"), F.avg(y).alias("m"), F.var_samp(y).alias("s2"))
           .withColumn("w", F.when((F.col("n") > 1) & (F.col("s2") > 0), F.col("n") / F.col("s2"))))
    e = Window.partitionBy(*by)
    g = (g.withColumn("wsum", F.sum("w").over(e))
          .withColumn("mw", ratio(F.sum(F.col("w") * F.col("m")).over(e), F.col("wsum"))))
    t = g.groupBy(*by).agg(
        F.count("w").alias("arms"),
        F.sum(F.col("w") * F.pow(F.col("m") - F.col("mw"), 2)).alias("__a"),
        F.sum(F.when(F.col("w").isNotNull(), F.pow(1 - ratio(F.col("w"), F.col("wsum")), 2)
                     / F.greatest(F.col("n") - 1, F.lit(1)))).alias("__lam"))
    k = F.col("arms").cast("double")
    enough = F.col("arms") >= 2
    f_stat = ratio(ratio(F.col("__a"), k - 1), 1 + ratio(2 * (k - 2) * F.col("__lam"), k * k - 1))
    df2 = ratio(k * k - 1, 3 * F.col("__lam"))
    t = (t.withColumn("f_stat", F.when(enough, f_stat)).withColumn("df1", F.when(enough, k - 1))
          .withColumn("df2", F.when(enough, df2)))
    return t.select(*by, "arms", "f_stat", "df1", "df2",
                    F.when(enough, ST.f_sf(F.col("f_stat"), F.col("df1"), F.col("df2"))).alias("p_value"),
                    F.when(~enough, F.lit("fewer than two arms with spread")).alias("reason"))


# Poisson(1) cumulative probabilities 0..11 in units of 2^-32: a 32-bit hash at or above the k-th counts one more
POISSON_STEPS = tuple(int(2 ** 32 * sum(math.exp(-1) / math.factorial(j) for j in range(k + 1))) for k in range(12))


def poisson_weights(unit: Column, salt: str, replicates: int) -> Column:
    """Array of (replicate, w): Poisson(1) weights from md5(unit | salt | block), four replicates to a digest.

    The weight of a unit depends on its id alone: any task, order or rerun
    gives the same replicates, and replicates of parts of the data add up.
    """
    def words(d):
        return F.array(*[F.struct((4 * d["b"] + i).cast("int").alias("replicate"), F.substring(d["hex"], 8 * i + 1, 8).alias("hex"))
                         for i in range(4)])

    def weight(word):
        # eight hex digits sort as the number they write, so the steps below a word need no conversion
        w = F.when(word["hex"] < f"{POISSON_STEPS[0]:08x}", 0)
        for k, t in enumerate(POISSON_STEPS[1:], 1):
            w = w.when(word["hex"] < f"{t:08x}", k)
        return F.struct(word["replicate"].alias("replicate"), w.otherwise(len(POISSON_STEPS)).alias("w"))

    # each lambda binds the digest or word found before, so that it is computed once
    blocks = F.transform(F.sequence(F.lit(0), F.lit(-(-replicates // 4) - 1)), lambda b: F.struct(
        b.alias("b"), F.md5(F.concat_ws("|", unit.cast("string"), F.lit(salt), b.cast("string"))).alias("hex")))
    return F.transform(F.filter(F.flatten(F.transform(blocks, words)), lambda x: x["replicate"] < replicates), weight)


def pilot_sample_size(pilot: DataFrame, value: str, unit: str, by: Sequence[str] = (EXP,), relative_mde: float = 0.05,
                      alpha: float = 0.05, power: float = 0.8, replicates: int = 64, coverage: float = 0.9,
                      salt: str = "pilot") -> DataFrame:
    """K23 (pilot variance): units per arm for a skewed metric whose variance a pilot estimates.

    n = 2 ((z_a + z_b) sd / effect)^2, rounded as N12, on two scales: ``raw``
    (effect = relative MDE times the mean) and ``log1p`` (effect = ln(1 +
    relative MDE); defined for values above -1).  The variance of a skewed
    metric is itself uncertain, so n comes with a bootstrap range
    (``coverage`` of the replicates, interpolated): Poisson(1) weights per unit
    and replicate, all replicates in one aggregate whose sums are added up
    before the shuffle, so they never meet the driver or one task, and sums of
    two pilots merge.  Rows of one unit share its weights.

    NULL values take no part; a NULL unit is the unit ''.  Fewer than two
    values, no spread or a zero mean give NULL sizes; replicates without two
    units' weight or with a zero mean are left out of the range.
    """
    by = list(by)
    rows = pilot.where(F.col(value).isNotNull()).select(
        *by, F.col(value).cast("double").alias("__x"), F.coalesce(F.col(unit).cast("string"), F.lit("")).alias("__u"))
    rows = rows.withColumn("__l", F.when(F.col("__x") > -1, F.log1p("__x")))
    whole = F.array(F.struct(F.lit(-1).alias("replicate"), F.lit(1).alias("w")))
    each = F.explode(F.concat(whole, poisson_weights(F.col("__u"), salt, replicates)))
    one = rows.select(*by, "__x", "__l", each.alias("__e")).where(F.col("__e.w") > 0)
    w = F.col("__e.w").cast("double")

    def scale(name, x):
        c, there = F.col(x), F.col(x).isNotNull()
        return F.struct(F.lit(name).alias("scale"), F.coalesce(F.sum(F.when(there, w)), F.lit(0.0)).alias("w"), F.sum(w * c).alias("s"),
                        F.sum(w * c * c).alias("q"), F.count_if(there).alias("n"))

    sums = one.groupBy(*by, F.col("__e.replicate").alias("replicate")).agg(F.array(scale("raw", "__x"), scale("log1p", "__l")).alias("__s"))
    sums = sums.select(*by, "replicate", F.explode("__s").alias("__s")).select(*by, "replicate", "__s.*")
    mean = F.try_divide(F.col("s"), F.col("w"))
    var = F.when(F.col("w") > 1, F.greatest(F.col("q") - F.col("s") * F.try_divide(F.col("s"), F.col("w")), F.lit(0.0)) / (F.col("w") - 1))
    effect = F.when(F.col("scale") == "raw", F.abs(F.col("mean")) * relative_mde).otherwise(F.lit(math.log1p(relative_mde)))
    z = ST.norm_ppf(F.lit(1 - alpha / 2)) + ST.norm_ppf(F.lit(power))
    sums = (sums.withColumn("mean", mean).withColumn("sd", F.sqrt(var)).withColumn("__z", z)
            .withColumn("size", F.when(F.col("sd") > 0, 2 * F.pow(F.try_divide(F.col("__z") * F.col("sd"), effect), F.lit(2.0)))))
    low, high = (1 - coverage) / 2, (1 + coverage) / 2
    own, drawn = F.col("replicate") == -1, F.when(F.col("replicate") >= 0, F.col("size"))
    out = sums.groupBy(*by, "scale").agg(
        F.max(F.when(own, F.col("n"))).alias("pilot_units"), F.max(F.when(own, F.col("mean"))).alias("mean"),
        F.max(F.when(own, F.col("sd"))).alias("sd"), F.max(F.when(own, F.col("size"))).alias("size"),
        F.percentile(drawn, F.array(F.lit(low), F.lit(high))).alias("__r"), F.count(drawn).alias("replicates"))
    return out.select(*by, "scale", "pilot_units", "mean", "sd", (F.col("size").cast("long") + 1).alias("n_required"),
                      (F.col("__r")[0].cast("long") + 1).alias("n_low"), (F.col("__r")[1].cast("long") + 1).alias("n_high"), "replicates")


FISHER_CHUNK = 4096


def fisher_exact(a: DataFrame) -> DataFrame:
    """Fisher's exact test on each experiment's 2x2 table (n_c, x_c, n_t, x_t).

    Sums hypergeometric probabilities over all tables with the observed
    margins.  The support is cut into chunks of ``FISHER_CHUNK`` tables, one
    row each; a chunk starts from one log probability and goes on by the ratio
    of neighbouring terms, and the chunks are added up, so the margins may be
    any size.  The log probability is a sum of deviances (saddle-point form),
    which keeps its digits for counts of billions.  Two-sided: tables no more
    likely than the observed one (relative tolerance 1e-7); ``p_greater``:
    treatment successes at least as high.  A missing arm gives NULL.
    """
    d = (a.withColumn("__K", F.col("x_c") + F.col("x_t"))
          .withColumn("__lo", F.greatest(F.lit(0).cast("long"), F.col("__K") - F.col("n_c")))
          .withColumn("__hi", F.least("__K", "n_t")))

    def logp(x):
        return ST.log_hypergeometric(x, F.col("n_t"), F.col("n_c"), F.col("__K"))

    d = d.withColumn("__lobs", logp(F.col("x_t")))
    whole = F.col("n_c").isNotNull() & F.col("n_t").isNotNull() & F.col("__K").isNotNull()
    starts = F.when(whole, F.sequence("__lo", "__hi", F.lit(FISHER_CHUNK).cast("long")))
    rows = d.withColumn("__from", F.explode_outer(starts))
    upto = F.least(F.col("__from") + FISHER_CHUNK - 1, F.col("__hi"))
    limit = F.col("__lobs") + math.log1p(1e-7)

    def step(acc, x):
        # acc: log probability of x, sums so far; term(x+1)/term(x) = (K-x)(n_t-x) / ((x+1)(n_c-K+x+1))
        xd = x.cast("double")
        p = F.exp(acc["lp"])
        more = ((F.col("__K") - xd) * (F.col("n_t") - xd)) / ((xd + 1) * F.greatest(F.col("n_c") - F.col("__K") + xd + 1, F.lit(1.0)))
        return F.struct((acc["lp"] + F.log(F.greatest(more, F.lit(1e-300)))).alias("lp"),
                        (acc["two"] + F.when(acc["lp"] <= limit, p).otherwise(0.0)).alias("two"),
                        (acc["gt"] + F.when(x >= F.col("x_t"), p).otherwise(0.0)).alias("gt"))

    zero = F.struct(logp(F.col("__from")).alias("lp"), F.lit(0.0).alias("two"), F.lit(0.0).alias("gt"))
    rows = rows.withColumn("__s", F.aggregate(F.sequence("__from", upto), zero, step))
    return rows.groupBy(EXP, "n_c", "x_c", "n_t", "x_t").agg(
        F.least(F.lit(1.0), F.sum("__s.two")).alias("p_two_sided"),
        F.least(F.lit(1.0), F.sum("__s.gt")).alias("p_greater"))


def adequacy(summary: DataFrame, sizes: DataFrame, arm: str = "grp") -> DataFrame:
    """K5: observed units per arm against the required per-arm sample size."""
    req = sizes.select(EXP, F.col("n_formula").alias("n_required"))
    return summary.join(req, EXP).select(EXP, arm, "users", "n_required",
                                         (F.col("users") >= F.col("n_required")).alias("adequate"))
