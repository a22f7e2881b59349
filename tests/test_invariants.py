"""Invariants from the survey's test strategy, on the smallest driver tables."""
import pytest
from pyspark.sql import functions as F

from bazaar.operators import cleaning as CL
from bazaar.operators import cohorts as CO
from bazaar.operators import experiments as E
from bazaar.operators import segments as S
from bazaar.sources import fixtures as X

from tests.paths import SF_SMALL


@pytest.fixture(scope="module")
def rfm(spark):
    return S.rfm(CL.clean_rfm(X.retail_lines(spark, SF_SMALL))).cache()


def test_segment_split_is_disjoint_and_complete(rfm):
    split = S.iqr_split(rfm)
    assert split.count() == rfm.count() == split.select("customer_id").distinct().count()
    assert {r.segment for r in split.select("segment").distinct().collect()} <= {"whale", "low_value", "main"}


def test_all_segments_cover_main_and_whales_once(rfm):
    feats = S.scaled_features(rfm)
    assigned = S.assign_nearest(feats, S.band_centroids(feats))
    segs = S.all_segments(assigned, S.name_clusters(S.cluster_profile(assigned)), S.whale_segments(rfm))
    n_main = S.iqr_split(rfm).where("segment = 'main'").count()
    n_whale = S.iqr_split(rfm).where("segment = 'whale'").count()
    assert segs.count() == n_main + n_whale == segs.select("customer_id").distinct().count()


def test_triangle_first_column_is_cohort_size_and_retention_at_most_100(spark):
    lines = CL.clean_retention(X.retail_lines(spark, SF_SMALL))
    act = CO.cohort_activity(lines)
    pct = CO.retention_pct(act)
    assert pct.where("retention_pct > 100 OR retention_pct < 0").count() == 0
    assert pct.where("cohort_index = 1 AND retention_pct <> 100").count() == 0
    tri = {r.cohort_date: r["1"] for r in CO.retention_triangle(act).collect()}
    sizes = {r.cohort_date: r.n for r in CO.first_purchase(lines).groupBy(
        F.trunc("first_purchase_date", "MM").alias("cohort_date")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert tri == sizes


def test_shares_sum_to_100_and_wcss_below_one_cluster(rfm):
    feats = S.scaled_features(rfm)
    assigned = S.assign_nearest(feats, S.band_centroids(feats))
    shares = [r.revenue_share_pct for r in S.cluster_profile(assigned).collect()]
    assert sum(shares) == pytest.approx(100.0, abs=0.05 * len(shares))
    total = S.wcss(assigned).where("cluster = 'total'").first().wcss
    # one cluster at the mean of standardised features: WCSS = sum of squared norms = n * 3
    one = feats.agg(F.sum(sum(F.pow(F.col(c), 2) for c in S.SCALED_COLS)).alias("w")).first().w
    assert total <= one + 1e-9


def test_two_sided_p_is_twice_the_smaller_tail(spark):
    a = E.arms(E.conversion_summary(E.prepare_ab(X.ab_units(spark, SF_SMALL))))
    two = {r.experiment_id: r.p_value for r in E.two_proportion_z(a).collect()}
    up = {r.experiment_id: r.p_value for r in E.two_proportion_z(a, "larger").collect()}
    down = {r.experiment_id: r.p_value for r in E.two_proportion_z(a, "smaller").collect()}
    for k in two:
        assert two[k] == pytest.approx(2 * min(up[k], down[k]), abs=1e-12)
        assert up[k] + down[k] == pytest.approx(1.0, abs=1e-12)
