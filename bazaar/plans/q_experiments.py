"""Registered experimentation queries: page test (ab_units) and campaign test (campaign_daily)."""
from pyspark.sql import functions as F

from bazaar.operators import experiments as E
from bazaar.operators.profile import attach
from bazaar.plans.registry import finish, query
from bazaar.session import materialize
from bazaar.sources import fixtures as X
from bazaar.sources.tables import table

SAMPLE_SALT = "ab-sample"
SAMPLE_MDE = 0.35        # relative MDE of the sampled test: some arms are larger than its n, some smaller
RELATIVE_MDE = 0.10


def _prepared(spark, sf):
    return E.prepare_ab(X.ab_units(spark, sf))


def _stats(spark, sf):
    # the only pass over the unit rows; a few rows per experiment, reused below
    return materialize(E.arm_stats(_prepared(spark, sf)))


def _summary(spark, sf, stats=None):
    return E.summary_from_stats(stats if stats is not None else _stats(spark, sf))


def _sizes(spark, sf, stats=None, relative_mde=RELATIVE_MDE):
    stats = stats if stats is not None else _stats(spark, sf)
    designs = E.designs_from_data(E.summary_from_stats(stats), E.traffic_from_stats(stats),
                                  relative_mde=relative_mde)
    return E.sample_size(designs)


def _sampled(spark, sf):
    required = _sizes(spark, sf, relative_mde=SAMPLE_MDE).select(E.EXP, F.col("n_formula").alias("n_required"))
    return E.stratified_sample(_prepared(spark, sf), required, SAMPLE_SALT)


def _tested(spark, sf, stats=None):
    return E.wald_ci(E.two_proportion_z(E.arms(_summary(spark, sf, stats))))


def _results(spark, sf):
    stats = _stats(spark, sf)
    sizes = _sizes(spark, sf, stats).select(E.EXP, "abs_mde", F.col("n_formula").alias("n_required"))
    return _tested(spark, sf, stats).join(sizes, E.EXP)


@query("ab_prepared")
def ab_prepared(spark, sf):
    return _prepared(spark, sf)


@query("assignment_summary")
def assignment_summary(spark, sf):
    return E.assignment_summary(X.ab_units(spark, sf))


@query("conversion_summary")
def conversion_summary(spark, sf):
    return finish(_summary(spark, sf))


@query("stratified_sample")
def stratified_sample(spark, sf):
    return _sampled(spark, sf)


@query("traffic_summary")
def traffic_summary(spark, sf):
    return finish(E.traffic_from_stats(_stats(spark, sf)))


@query("sample_size")
def sample_size(spark, sf):
    return finish(_sizes(spark, sf).select(
        E.EXP, "p1", "p2", "abs_mde", "z_alpha", "z_beta", "cohens_h", "n_formula", "n_cohen",
        "total_n", "daily_traffic", "days_needed_exact", "days_needed"))


@query("success_failure")
def success_failure(spark, sf):
    return finish(E.success_failure(_summary(spark, sf)))


@query("two_proportion_z")
def two_proportion_z(spark, sf):
    t = E.two_proportion_z(E.arms(_summary(spark, sf)))
    return finish(t.select(E.EXP, "n_c", "x_c", "n_t", "x_t", "p_c", "p_t", "p_pool", "se_pooled", "z",
                           "p_value", "lift_abs", "lift_rel", "reject_h0"))


@query("two_proportion_z_larger")
def two_proportion_z_larger(spark, sf):
    t = E.two_proportion_z(E.arms(_summary(spark, sf)), alternative="larger")
    return finish(t.select(E.EXP, "z", "p_value", "reject_h0"))


@query("wald_ci")
def wald_ci(spark, sf):
    return finish(_tested(spark, sf).select(E.EXP, "se_unpooled", "z_crit", "ci_lower", "ci_upper",
                                            "z_ci_lower", "z_ci_upper"))


@query("decision_ladder")
def decision_ladder(spark, sf):
    return E.decide_ladder(_results(spark, sf))


@query("ship_checklist")
def ship_checklist(spark, sf):
    return E.ship_checklist(_results(spark, sf))


@query("ci_reading")
def ci_reading(spark, sf):
    return finish(E.ci_reading(_results(spark, sf)))


@query("experiment_report")
def experiment_report(spark, sf):
    stats = _stats(spark, sf)
    return finish(E.experiment_report(_tested(spark, sf, stats), _sizes(spark, sf, stats)))


@query("novelty_by_week")
def novelty_by_week(spark, sf):
    return finish(E.novelty_by_week(_prepared(spark, sf)), nullable_ints=("n_c", "x_c", "n_t", "x_t"))


@query("degenerate_experiments")
def degenerate_experiments(spark, sf):
    """Experiments with a control that never converts, an empty arm and a missing arm, beside sound ones."""
    stats = _stats(spark, sf)
    spoiled = (stats.where(~((F.col(E.EXP) == "3-MEDIUM") & (F.col("grp") == "treatment")))
               .withColumn("conversions", F.when((F.col(E.EXP) == "1-URGENT") & (F.col("grp") == "control"), 0)
                           .when(F.col(E.EXP) == "2-HIGH", F.when(F.col("grp") == "treatment", 0).otherwise(F.col("conversions")))
                           .otherwise(F.col("conversions")))
               .withColumn("users", F.when((F.col(E.EXP) == "2-HIGH") & (F.col("grp") == "treatment"), 0).otherwise(F.col("users"))))
    summary = E.summary_from_stats(spoiled)
    sizes = E.sample_size(E.designs_from_data(summary, E.traffic_from_stats(spoiled), relative_mde=RELATIVE_MDE))
    tested = E.wald_ci(E.two_proportion_z(E.arms(summary)))
    out = tested.join(sizes.select(E.EXP, "n_formula", "n_cohen"), E.EXP).select(
        E.EXP, "n_c", "x_c", "n_t", "x_t", "z", "p_value", "ci_lower", "ci_upper", "n_formula", "n_cohen")
    return finish(out, nullable_ints=("n_c", "x_c", "n_t", "x_t", "n_formula", "n_cohen"))


# ---- campaign (daily rows per arm) ----

@query("daily_rates")
def daily_rates(spark, sf):
    return finish(E.add_campaign_metrics(X.campaign_daily(spark, sf)))


@query("campaign_totals")
def campaign_totals(spark, sf):
    return finish(E.campaign_totals(X.campaign_daily(spark, sf)))


@query("guardrail_cpc")
def guardrail_cpc(spark, sf):
    return finish(E.guardrail_cpc(X.campaign_daily(spark, sf)))


@query("welch_t")
def welch_t(spark, sf):
    rates = E.add_campaign_metrics(X.campaign_daily(spark, sf))
    return finish(E.welch_t(rates, "ctr"))


@query("qq_points")
def qq_points(spark, sf):
    rates = E.add_campaign_metrics(X.campaign_daily(spark, sf))
    return finish(E.qq_points(rates, "ctr", by=["arm"]))


@query("campaign_checklist")
def campaign_checklist(spark, sf):
    daily = X.campaign_daily(spark, sf)
    totals = E.campaign_totals(daily).withColumn(E.EXP, F.lit("campaign"))
    a = E.arms(totals, control="control", treatment="test", arm="arm", n="impressions", x="clicks")
    tested = E.wald_ci(E.two_proportion_z(a, alternative="larger"))
    mde = tested.select(E.EXP, (F.col("p_c") * RELATIVE_MDE).alias("abs_mde"))
    guard = E.guardrail_cpc(daily).select("guardrail_ok")
    res = attach(tested.join(mde, E.EXP), guard)        # guard: one row
    return E.ship_checklist(res)


def _three_arm_orders(spark, sf):
    """3-arm test on a skewed money metric: arm by customer key mod 3 (an assignment rule)."""
    o = table(spark, sf, "orders")
    arm = F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")), (F.col("o_custkey") % 3 + 1).cast("int"))
    return o.select(F.col("o_orderpriority").alias(E.EXP), arm.alias("arm"),
                    F.col("o_totalprice").alias("order_value"))


@query("multi_arm_anova")
def multi_arm_anova(spark, sf):
    return finish(E.multi_arm_anova(_three_arm_orders(spark, sf), "order_value", "arm"))


@query("pilot_sample_size")
def pilot_sample_size(spark, sf):
    """Users per arm to see 5 % more spend per user, from the spend so far as the pilot."""
    o = table(spark, sf, "orders")
    spend = o.groupBy(F.col("o_orderpriority").alias(E.EXP), "o_custkey").agg(F.sum("o_totalprice").alias("spend"))
    return finish(E.pilot_sample_size(spend, "spend", "o_custkey"), nullable_ints=("n_required", "n_low", "n_high"))


@query("fisher_exact")
def fisher_exact(spark, sf):
    return finish(E.fisher_exact(E.arms(_summary(spark, sf))))


@query("dedup_first")
def dedup_first(spark, sf):
    from bazaar.operators.ranking import dedup_first as keep_first
    return keep_first(X.ab_units(spark, sf), [E.EXP, "user_id"], ["ts", "row_id"])


@query("adequacy")
def adequacy(spark, sf):
    stats = _stats(spark, sf)
    return E.adequacy(_summary(spark, sf, stats), _sizes(spark, sf, stats))


@query("sampled_z_test")
def sampled_z_test(spark, sf):
    """The reference's flow: design-sized sample per arm -> summary -> success-failure -> z-test -> CI."""
    sample = _sampled(spark, sf)
    summary = E.conversion_summary(sample)
    ok = E.success_failure(summary).groupBy(E.EXP).agg(F.bool_and("success_failure_ok").alias("normal_approx_ok"))
    tested = E.wald_ci(E.two_proportion_z(E.arms(summary)))
    return finish(tested.join(ok, E.EXP).select(E.EXP, "n_c", "x_c", "n_t", "x_t", "z", "p_value", "lift_abs",
                                                "ci_lower", "ci_upper", "reject_h0", "normal_approx_ok"))


@query("campaign_z_test")
def campaign_z_test(spark, sf):
    """Campaign CTR test: n = impressions, right-tailed at alpha 0.10, with the n >= 30
    and success-failure checks on the per-arm totals."""
    totals = E.campaign_totals(X.campaign_daily(spark, sf)).withColumn(E.EXP, F.lit("campaign"))
    a = E.arms(totals, control="control", treatment="test", arm="arm", n="impressions", x="clicks")
    tested = E.two_proportion_z(a, alternative="larger", alpha=0.10)
    checks = E.success_failure(totals.select(E.EXP, "arm", F.col("impressions").alias("users"),
                                             F.col("pooled_ctr").alias("rate")))
    ok = checks.groupBy(E.EXP).agg(F.bool_and("success_failure_ok").alias("success_failure_ok"),
                                   F.bool_and("n_at_least_30").alias("n_at_least_30"))
    return finish(tested.join(ok, E.EXP).select(E.EXP, "n_c", "x_c", "n_t", "x_t", "p_c", "p_t", "p_pool",
                                                "z", "p_value", "reject_h0", "success_failure_ok",
                                                "n_at_least_30"))
