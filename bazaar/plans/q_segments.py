"""Registered RFM / segmentation queries."""
from pyspark.sql import functions as F

from bazaar.operators import cleaning as CL
from bazaar.operators import profile as P
from bazaar.operators import segments as S
from bazaar.plans.registry import finish, query
from bazaar.session import materialize
from bazaar.sources import fixtures as X

MONEY = {"monetary_value": 2}


def _rfm(spark, sf):
    # one row per customer, reused by every downstream step: cut lineage here
    return materialize(S.rfm(CL.clean_rfm(X.retail_lines(spark, sf))))


def _fences(r):
    # one row, shared by the scaled features and the whale labels (two jobs)
    return materialize(S.fences(r, ["monetary_value", "frequency"]))


def _assigned(spark, sf, r=None, f=None):
    r = r if r is not None else _rfm(spark, sf)
    feats = materialize(S.scaled_features(r, f))
    return materialize(S.assign_nearest(feats, S.band_centroids(feats)))


@query("rfm")
def rfm(spark, sf):
    return finish(_rfm(spark, sf), money=MONEY)


@query("iqr_bounds")
def iqr_bounds(spark, sf):
    return finish(P.iqr_bounds(_rfm(spark, sf), list(S.RFM_COLS)))


@query("boxplot_summary")
def boxplot_summary(spark, sf):
    return P.boxplot_summary(_rfm(spark, sf), list(S.RFM_COLS))


@query("iqr_split")
def iqr_split(spark, sf):
    return finish(S.iqr_split(_rfm(spark, sf)), money=MONEY)


@query("whale_segments")
def whale_segments(spark, sf):
    return finish(S.whale_segments(_rfm(spark, sf)), money=MONEY)


@query("log_scaled_features")
def log_scaled_features(spark, sf):
    return finish(S.scaled_features(_rfm(spark, sf)), money=MONEY)


@query("band_centroids")
def band_centroids(spark, sf):
    return finish(S.band_centroids(S.scaled_features(_rfm(spark, sf))))


@query("nearest_centroid")
def nearest_centroid(spark, sf):
    a = _assigned(spark, sf)
    return finish(a.select("customer_id", "cluster", "sq_distance"))


@query("wcss")
def wcss(spark, sf):
    return finish(S.wcss(_assigned(spark, sf)))


@query("silhouette_fixed")
def silhouette_fixed(spark, sf):
    return finish(S.silhouette_sq(_assigned(spark, sf)))


@query("cluster_profile")
def cluster_profile(spark, sf):
    return finish(S.cluster_profile(_assigned(spark, sf)),
                  money={"total_revenue": 2, "overall_total_revenue": 2})


@query("profile_with_total")
def profile_with_total(spark, sf):
    return finish(S.profile_with_total(_assigned(spark, sf)))


@query("name_clusters")
def name_clusters(spark, sf):
    return S.name_clusters(S.cluster_profile(_assigned(spark, sf)))


def _all_segments(spark, sf):
    r = _rfm(spark, sf)
    f = _fences(r)
    assigned = _assigned(spark, sf, r, f)
    names = S.name_clusters(S.cluster_profile(assigned))
    return S.all_segments(assigned, names, S.whale_segments(r, fence_row=f))


@query("all_segments")
def all_segments(spark, sf):
    return finish(_all_segments(spark, sf), money=MONEY)


@query("segment_summary")
def segment_summary(spark, sf):
    return finish(S.segment_summary(_all_segments(spark, sf)))


def _snapshots(spark, sf, cut="2000-01-01"):
    lines = CL.clean_rfm(X.retail_lines(spark, sf))
    before = S.iqr_split(S.rfm(lines.where(F.col("invoice_date") < F.lit(cut).cast("timestamp_ntz")),
                               as_of=cut))
    return before, S.iqr_split(S.rfm(lines))


@query("segment_migration")
def segment_migration(spark, sf):
    return S.segment_migration(*_snapshots(spark, sf))


@query("segment_drift")
def segment_drift(spark, sf):
    return finish(S.segment_drift(*_snapshots(spark, sf)))


@query("kmeans_segments")
def kmeans_segments(spark, sf):
    seg = S.kmeans_segments(S.scaled_features(_rfm(spark, sf)), k=4)
    return finish(seg.select("customer_id", "cluster", "sq_distance"))


@query("kmeans_sweep")
def kmeans_sweep(spark, sf):
    return finish(S.k_selection(S.kmeans_sweep(S.scaled_features(_rfm(spark, sf)))))


@query("non_whale_customers")
def non_whale_customers(spark, sf):
    r = _rfm(spark, sf)
    return finish(CL.exclude_keys(r, S.whale_segments(r), "customer_id"), money=MONEY)
