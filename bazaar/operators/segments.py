"""RFM segmentation (survey 2.J with 2.C10, 2.D4, 2.D11, 2.D12, 2.D23-D24, 2.D31, 2.G5-G6).

Global scalars (the reference date, IQR fences, scaler moments, centroids)
are one-row aggregates attached to the rows as a scalar subquery (computed
once, a constant in the row projection) - no join, no unpartitioned window
over the data.  Centroids travel as one row holding an array of k structs, so
nearest-centroid assignment is a per-row expression (no k-way join).
K-means itself is in :mod:`bazaar.operators.clustering`.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaar.operators import clustering
from bazaar.operators.profile import attach, iqr_bounds
from bazaar.operators.ranking import exact_quantiles

RFM_COLS = ("monetary_value", "frequency", "recency")
SCALED_COLS = ("monetary_value_scaled", "frequency_scaled", "recency_scaled")

# Whale segment labels and the four cluster names.
WHALE_LABELS = ("overlap_cluster", "only_high_mv_cluster", "only_high_freq_cluster")
CLUSTER_NAMES = ("Champions", "Lost/Dormant", "Growth/Potential Loyalists", "Occasional/New Customers")


def rfm(lines: DataFrame, as_of=None, user: str = "customer_id") -> DataFrame:
    """Monetary (sum of spend), frequency (distinct invoices), recency in days.

    Recency counts whole 24 h periods to the reference date, which is the
    last purchase overall plus one day unless ``as_of`` is given (N2, N13).
    """
    per = lines.groupBy(user).agg(
        F.sum(F.col("quantity") * F.col("price")).alias("monetary_value"),
        F.count_distinct("invoice").alias("frequency"),
        F.max("invoice_date").alias("max_date"))
    if as_of is None:
        ref = per.agg((F.max("max_date") + F.expr("INTERVAL 1 DAY")).alias("__ref"))
    else:
        ref = per.sparkSession.range(1).select(F.lit(str(as_of)).cast("timestamp_ntz").alias("__ref"))
    return attach(per, ref).select(
        user, "monetary_value", "frequency",
        F.timestamp_diff("DAY", F.col("max_date"), F.col("__ref")).alias("recency"))


def fences(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """One row: ``<col>_lower`` / ``<col>_upper`` for each column."""
    b = iqr_bounds(df, cols, k)
    return b.agg(*[F.max(F.when(F.col("column_name") == c, F.col(side))).alias(f"{c}_{side}")
                   for c in cols for side in ("lower", "upper")])


def iqr_split(df: DataFrame, cols: Sequence[str] = ("monetary_value", "frequency"),
              k: float = 1.5, fence_row: DataFrame | None = None) -> DataFrame:
    """Whale (above any upper fence) > low_value (below any lower) > main.

    ``fence_row`` (from :func:`fences`) lets several steps share one computation.
    """
    f = fence_row if fence_row is not None else fences(df, cols, k)
    whale = F.lit(False)
    low = F.lit(False)
    for c in cols:
        whale = whale | (F.col(c) > F.col(f"{c}_upper"))
        low = low | (F.col(c) < F.col(f"{c}_lower"))
    seg = F.when(whale, "whale").when(low, "low_value").otherwise("main")
    return attach(df, f).select(*df.columns, seg.alias("segment"))


def whale_segments(df: DataFrame, k: float = 1.5, fence_row: DataFrame | None = None) -> DataFrame:
    """Whales labelled by which fences they exceed (overlap = both)."""
    f = fence_row if fence_row is not None else fences(df, ["monetary_value", "frequency"], k)
    hm = F.col("monetary_value") > F.col("monetary_value_upper")
    hf = F.col("frequency") > F.col("frequency_upper")
    label = (F.when(hm & hf, WHALE_LABELS[0]).when(hm, WHALE_LABELS[1]).when(hf, WHALE_LABELS[2]))
    return attach(df, f).where(hm | hf).select(*df.columns, label.alias("whale_segment"))


def log_features(df: DataFrame, cols: Sequence[str] = RFM_COLS) -> DataFrame:
    """log1p of each feature as ``<col>_log``."""
    return df.select("*", *[F.log1p(F.col(c)).alias(f"{c}_log") for c in cols])


def standardise(df: DataFrame, cols: Sequence[str], out: Sequence[str]) -> DataFrame:
    """(x - mean) / population std from a one-row aggregate."""
    mom = df.agg(*[F.avg(c).alias(f"__m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(c).alias(f"__s{i}") for i, c in enumerate(cols)])
    return attach(df, mom).select(*df.columns, *[
        F.try_divide(F.col(c) - F.col(f"__m{i}"), F.col(f"__s{i}")).alias(o)
        for i, (c, o) in enumerate(zip(cols, out))])


def scaled_features(rfm_df: DataFrame, fence_row: DataFrame | None = None) -> DataFrame:
    """The main (non-outlier) customers with log + standardised RFM features."""
    main = iqr_split(rfm_df, fence_row=fence_row).where(F.col("segment") == "main").drop("segment")
    logged = log_features(main)
    return standardise(logged, [f"{c}_log" for c in RFM_COLS], SCALED_COLS)


def band_centroids(features: DataFrame, cols: Sequence[str] = SCALED_COLS,
                   band_col: str = "monetary_value_scaled") -> DataFrame:
    """Deterministic centroids from the data: feature means per quartile band of ``band_col``.

    Used as fixed starting centroids (and for SQL-checkable assignment);
    band 0 holds the highest values.
    """
    q = exact_quantiles(features, band_col, [0.25, 0.5, 0.75])
    qrow = q.agg(*[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n)
                   for p, n in ((0.25, "__q1"), (0.5, "__q2"), (0.75, "__q3"))])
    v = F.col(band_col)
    band = (F.when(v > F.col("__q3"), 0).when(v > F.col("__q2"), 1).when(v > F.col("__q1"), 2).otherwise(3))
    banded = attach(features, qrow).withColumn("cluster", band)
    return banded.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in cols])


def _centroid_row(centroids: DataFrame, cols: Sequence[str]) -> DataFrame:
    """k centroid rows -> one row with an array of k structs (size bounded by k)."""
    return centroids.agg(F.sort_array(F.collect_list(F.struct(
        F.col("cluster").cast("int").alias("cluster"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])
    )).alias("__cents"))


def assign_nearest(df: DataFrame, centroids: DataFrame, cols: Sequence[str] = SCALED_COLS) -> DataFrame:
    """Nearest centroid (squared Euclidean; ties -> lower id) per row."""
    cents = _centroid_row(centroids, cols)

    def dist(c):
        d = None
        for i, name in enumerate(cols):
            t = F.pow(F.col(name) - c[f"c{i}"], 2)
            d = t if d is None else d + t
        return d

    scored = F.transform(F.col("__cents"), lambda c: F.struct(dist(c).alias("d"), c["cluster"].alias("cluster")))
    best = F.array_min(scored)
    return attach(df, cents).select(*df.columns, best["cluster"].alias("cluster"),
                                    best["d"].alias("sq_distance"))


def wcss(assigned: DataFrame) -> DataFrame:
    """Within-cluster sum of squares per cluster plus the total (GROUPING SETS)."""
    return (assigned.rollup("cluster")
                    .agg(F.count(F.lit(1)).alias("points"), F.sum("sq_distance").alias("wcss"))
                    .select(F.coalesce(F.col("cluster").cast("string"), F.lit("total")).alias("cluster"),
                            "points", "wcss"))


def silhouette_sq(assigned: DataFrame, cols: Sequence[str] = SCALED_COLS,
                  label: str = "cluster") -> DataFrame:
    """Mean silhouette with squared Euclidean distance (exact, O(n k)).

    Per-cluster sums (count, feature sums, squared-norm sum) give every
    point's mean distance to each cluster without pairing points; the
    own-cluster mean excludes the point itself.  Same definition as
    ``ClusteringEvaluator(distanceMeasure='squaredEuclidean')``.
    """
    sq = None
    for c in cols:
        t = F.pow(F.col(c), 2)
        sq = t if sq is None else sq + t
    pts = assigned.select(F.col(label).alias("__lab"), *cols, sq.alias("__sq"))
    stats = pts.groupBy("__lab").agg(F.count(F.lit(1)).alias("n"), F.sum("__sq").alias("sqsum"),
                                     *[F.sum(c).alias(f"s{i}") for i, c in enumerate(cols)])
    srow = stats.agg(F.collect_list(F.struct("__lab", "n", "sqsum", *[f"s{i}" for i in range(len(cols))]))
                     .alias("__st"))

    def mean_d(s):
        dot = None
        for i, c in enumerate(cols):
            t = F.col(c) * s[f"s{i}"]
            dot = t if dot is None else dot + t
        return F.col("__sq") + s["sqsum"] / s["n"] - 2 * dot / s["n"]

    j = attach(pts, srow)
    own = F.filter(F.col("__st"), lambda s: s["__lab"] == F.col("__lab"))[0]
    others = F.transform(F.filter(F.col("__st"), lambda s: s["__lab"] != F.col("__lab")), mean_d)
    a = mean_d(own) * own["n"] / (own["n"] - 1)
    b = F.array_min(others)
    s = (F.when(own["n"] == 1, F.lit(0.0))
          .when(a < b, 1 - a / b).when(a > b, b / a - 1).otherwise(F.lit(0.0)))
    return j.agg(F.avg(s).alias("silhouette"), F.count(F.lit(1)).alias("points"))


def kmeans_segments(features: DataFrame, k: int = 4, cols: Sequence[str] = SCALED_COLS, **options) -> DataFrame:
    """Clusters of :func:`bazaar.operators.clustering.kmeans_segments` over the scaled features."""
    return clustering.kmeans_segments(features, k, cols, **options)


def kmeans_sweep(features: DataFrame, ks: Sequence[int] = range(2, 11), cols: Sequence[str] = SCALED_COLS, **options) -> DataFrame:
    """Inertia and silhouette per K (:func:`bazaar.operators.clustering.kmeans_sweep`)."""
    return clustering.kmeans_sweep(features, ks, cols, **options)


def k_selection(sweep: DataFrame) -> DataFrame:
    """Inertia drop per K and local silhouette peaks (over the K-row sweep)."""
    w = Window.orderBy("k")    # one row per K
    prev_s, next_s = F.lag("silhouette").over(w), F.lead("silhouette").over(w)
    return sweep.select("k", "inertia", "silhouette",
                        (F.lag("inertia").over(w) - F.col("inertia")).alias("inertia_drop"),
                        ((F.col("silhouette") > F.coalesce(prev_s, F.lit(float("-inf"))))
                         & (F.col("silhouette") > F.coalesce(next_s, F.lit(float("-inf")))))
                        .alias("silhouette_peak"))


def cluster_profile(assigned: DataFrame, label: str = "cluster") -> DataFrame:
    """Mean RFM, size, revenue and revenue share (1 decimal, half-even)."""
    prof = assigned.groupBy(label).agg(
        *[F.avg(c).alias(c) for c in RFM_COLS], F.count(F.lit(1)).alias("count"),
        F.sum("monetary_value").alias("total_revenue"))
    total = prof.agg(F.sum("total_revenue").alias("overall_total_revenue"))
    share = F.rint(F.try_divide(F.col("total_revenue"), F.col("overall_total_revenue")) * 100 * 10) / 10
    return attach(prof, total).withColumn("revenue_share_pct", share)


def profile_with_total(assigned: DataFrame, label: str = "cluster") -> DataFrame:
    """Per-cluster means and sizes plus an ``All`` row, in one GROUPING SETS pass."""
    g = assigned.rollup(label).agg(*[F.avg(c).alias(c) for c in RFM_COLS],
                                   F.count(F.lit(1)).alias("n"), F.grouping(label).alias("__g"))
    return g.select(F.when(F.col("__g") == 1, F.lit("All")).otherwise(F.col(label).cast("string"))
                    .alias("cluster_group"), *RFM_COLS, "n")


def name_clusters(profile: DataFrame, label: str = "cluster") -> DataFrame:
    """Names from the profile: top monetary -> Champions; of the rest the
    highest recency -> Lost/Dormant; then the higher monetary -> Growth/Potential
    Loyalists; the last -> Occasional/New Customers.  Works on the k-row profile.
    """
    w_all = Window.orderBy(F.col("monetary_value").desc(), F.col(label))
    p = profile.withColumn("__m", F.row_number().over(w_all))
    rest = F.col("__m") > 1
    w_rec = Window.orderBy(F.when(rest, F.col("recency")).desc_nulls_last(), F.col(label))
    p = p.withColumn("__r", F.when(rest, F.row_number().over(w_rec)))
    rest2 = rest & (F.col("__r") > 1)
    w_m2 = Window.orderBy(F.when(rest2, F.col("monetary_value")).desc_nulls_last(), F.col(label))
    p = p.withColumn("__g", F.when(rest2, F.row_number().over(w_m2)))
    name = (F.when(F.col("__m") == 1, CLUSTER_NAMES[0]).when(F.col("__r") == 1, CLUSTER_NAMES[1])
             .when(F.col("__g") == 1, CLUSTER_NAMES[2]).when(F.col("__g") == 2, CLUSTER_NAMES[3])
             .otherwise(F.concat(F.lit("Cluster "), F.col(label).cast("string"))))
    return p.select(label, name.alias("cluster_name"))


LOW_VALUE = "Low value"


def all_segments(assigned: DataFrame, names: DataFrame, whales: DataFrame,
                 user: str = "customer_id", include_low: DataFrame | None = None) -> DataFrame:
    """J12 (+B18): main customers with their cluster name, unioned with the whales.

    ``include_low``: the customers below the fences, added as ``LOW_VALUE``.
    """
    main = assigned.join(F.broadcast(names), "cluster", "left").select(  # k-row name table
        user, *RFM_COLS, F.col("cluster_name").alias("segment"))
    wh = whales.select(user, *RFM_COLS, F.col("whale_segment").alias("segment"))
    out = main.unionByName(wh)
    if include_low is not None:
        out = out.unionByName(include_low.select(user, *RFM_COLS, F.lit(LOW_VALUE).alias("segment")))
    return out


def split_dormant(segments: DataFrame, label: str = CLUSTER_NAMES[1]) -> DataFrame:
    """The lost customers by history: previously active (over one order) or one and done."""
    kind = F.when(F.col("frequency") > 1, "previously active").otherwise("one and done")
    return segments.withColumn("segment", F.when(
        F.col("segment") == label, F.concat_ws(": ", F.col("segment"), kind)).otherwise(F.col("segment")))


def split_by_account_age(segments: DataFrame, first_purchases: DataFrame, as_of: str, days: int = 365,
                         label: str = CLUSTER_NAMES[3], user: str = "customer_id") -> DataFrame:
    """The occasional customers by account age: new (first purchase within ``days``) or occasional."""
    age = F.date_diff(F.lit(as_of).cast("date"), F.to_date("first_purchase_date"))
    kind = F.when(age <= days, "new").otherwise("occasional")
    dated = segments.join(first_purchases.select(user, "first_purchase_date"), user, "left")
    return dated.withColumn("segment", F.when(
        F.col("segment") == label, F.concat_ws(": ", F.col("segment"), kind)).otherwise(F.col("segment"))
    ).drop("first_purchase_date")


def segment_summary(segments: DataFrame, user: str = "customer_id") -> DataFrame:
    """Distinct customers and mean RFM per segment, largest first."""
    return (segments.groupBy("segment")
            .agg(F.count_distinct(user).alias("customers"), *[F.avg(c).alias(c) for c in RFM_COLS])
            .orderBy(F.col("customers").desc(), F.col("segment")))


def segment_migration(before: DataFrame, after: DataFrame, user: str = "customer_id") -> DataFrame:
    """Transition counts between two segment snapshots (full outer join on customer)."""
    b = before.select(user, F.col("segment").alias("from_segment"))
    a = after.select(user, F.col("segment").alias("to_segment"))
    j = b.join(a, user, "full_outer")
    return (j.groupBy(F.coalesce("from_segment", F.lit("(new)")).alias("from_segment"),
                      F.coalesce("to_segment", F.lit("(gone)")).alias("to_segment"))
             .agg(F.count(F.lit(1)).alias("customers")))


def segment_drift(before: DataFrame, after: DataFrame, user: str = "customer_id") -> DataFrame:
    """J15 (drift): per starting segment, how the RFM values of customers present in
    both snapshots moved (mean change of each measure, share that changed segment)."""
    b = before.select(user, F.col("segment").alias("from_segment"),
                      *[F.col(c).alias(f"{c}_0") for c in RFM_COLS])
    a = after.select(user, F.col("segment").alias("to_segment"), *[F.col(c).alias(f"{c}_1") for c in RFM_COLS])
    j = b.join(a, user)
    return j.groupBy("from_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        *[F.avg(F.col(f"{c}_1") - F.col(f"{c}_0")).alias(f"{c}_change") for c in RFM_COLS],
        F.avg((F.col("from_segment") != F.col("to_segment")).cast("double")).alias("moved_share"))
