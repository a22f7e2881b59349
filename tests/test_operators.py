import datetime as dt

import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from bazaar.functions.columns import order_count_segment
from bazaar.operators import cleaning as CL
from bazaar.operators import cohorts as CO
from bazaar.operators import profile as P
from bazaar.operators import segments as S


def test_segment_boundaries(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 4, 5, 14, 15)], "n long")
    got = [r.s for r in df.orderBy("n").select(order_count_segment(F.col("n")).alias("s")).collect()]
    assert got == ["inactive", "occasional", "occasional", "regular", "regular", "vip"]


def test_stock_code_pattern(spark):
    df = spark.createDataFrame([("85123",), ("85123A",), ("85123AB",), ("POST",), (None,)], "stock_code string")
    kept = [r.stock_code for r in CL.clean(df, match={"stock_code": CL.STANDARD_STOCK_CODE}).collect()]
    assert sorted(kept) == ["85123", "85123A"]


def test_cohort_index_worked_example(spark):
    lines = spark.createDataFrame(
        [(1, dt.datetime(2010, 3, 5), 1, 1.0), (1, dt.datetime(2015, 6, 1), 1, 1.0)],
        "customer_id long, invoice_date timestamp_ntz, quantity int, price double")
    idx = sorted(r.cohort_index for r in CO.assign_cohort(lines).collect())
    assert idx == [1, 64]


def test_retention_half_even_labels(spark):
    pct = spark.createDataFrame([(dt.date(2020, 1, 1), 2, 1, 2.5), (dt.date(2020, 1, 1), 3, 1, 3.5)],
                                "cohort_date date, cohort_index int, active_customers long, retention_pct double")
    cells = sorted(r.cell for r in CO.retention_cells(pct).collect())
    assert cells == ["1 (2%)", "1 (4%)"]


def test_triangle_null_inside(spark):
    lines = spark.createDataFrame(
        [(1, dt.datetime(2020, 1, 3), 1, 1.0), (1, dt.datetime(2020, 3, 3), 1, 1.0)],
        "customer_id long, invoice_date timestamp_ntz, quantity int, price double")
    tri = CO.retention_triangle(CO.cohort_activity(lines), months=3).first()
    assert (tri["1"], tri["2"], tri["3"]) == (1, None, 1)


def test_recency_counts_whole_days(spark):
    lines = spark.createDataFrame(
        [("100001", 1, dt.datetime(2020, 1, 1, 18, 0), 1, 2.0)],
        "invoice string, customer_id long, invoice_date timestamp_ntz, quantity int, price double")
    r = S.rfm(lines, as_of="2020-01-03 06:00:00").first()
    assert r.recency == 1


def test_box_bands_edges_and_zero_fill(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 5, 6, 7, 8, 100)], "v double")
    b = {r.band: r.rows for r in P.boxplot_summary(df, ["v"]).collect()}
    # q1 = 3, q3 = 7, fences -3 and 13
    assert b == {"outlier_low": 0, "whisker_low_to_Q1": 2, "IQR_box (25-75%)": 5,
                 "Q3_to_whisker_high": 1, "outlier_high": 1}


def test_whale_precedence_over_low_value(spark):
    rows = [(i, 100.0 + i, 5, 10) for i in range(20)] + [(99, 1e6, 0, 10)]
    df = spark.createDataFrame(rows, "customer_id long, monetary_value double, frequency long, recency long")
    seg = {r.customer_id: r.segment for r in S.iqr_split(df).collect()}
    assert seg[99] == "whale"     # high monetary, low frequency: whale wins


def test_unknown_label_is_null(spark):
    df = spark.createDataFrame([(0,), (7,)], "cluster int")
    got = {r.cluster: r.name for r in CL.map_labels(df, "cluster", {0: "Champions"}, "name").collect()}
    assert got == {0: "Champions", 7: None}


def test_silhouette_matches_spark_evaluator(spark):
    import random
    rnd = random.Random(3)
    pts = [(i, rnd.gauss(c, 0.5), rnd.gauss(-c, 0.7), rnd.gauss(0, 1), k)
           for i in range(300) for k, c in [(i % 3, (i % 3) * 2.0)]]
    df = spark.createDataFrame(pts, "id long, a double, b double, c double, cluster int")
    ours = S.silhouette_sq(df, ["a", "b", "c"]).first().silhouette
    vec = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="cluster",
                             distanceMeasure="squaredEuclidean").evaluate(vec.withColumn("cluster", F.col("cluster").cast("double")))
    assert ours == pytest.approx(ev, abs=1e-9)


def test_nearest_centroid_tie_goes_to_lower_id(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, 0.0)], "customer_id long, x double, y double, z double")
    cents = spark.createDataFrame([(1, 1.0, 0.0, 0.0), (0, -1.0, 0.0, 0.0)], "cluster int, x double, y double, z double")
    r = S.assign_nearest(df, cents, ["x", "y", "z"]).first()
    assert r.cluster == 0 and r.sq_distance == 1.0


def test_name_clusters_rule(spark):
    prof = spark.createDataFrame([(0, 10.0, 50.0), (1, 100.0, 20.0), (2, 30.0, 300.0), (3, 50.0, 40.0)],
                                 "cluster int, monetary_value double, recency double")
    names = {r.cluster: r.cluster_name for r in S.name_clusters(prof).collect()}
    assert names == {1: "Champions", 2: "Lost/Dormant", 3: "Growth/Potential Loyalists",
                     0: "Occasional/New Customers"}


def test_funnel_counts_and_drops(spark):
    df = spark.createDataFrame([("C1", 1), ("2", 1), ("3", None), ("4", 2)], "invoice string, customer_id long")
    steps = [("no_cancel", ~F.col("invoice").startswith("C")), ("has_customer", F.col("customer_id").isNotNull())]
    got = [(r.step, r.rows, r.dropped) for r in CL.cleaning_funnel(df, steps).orderBy("step_no").collect()]
    assert got == [("original", 4, None), ("no_cancel", 3, 1), ("has_customer", 2, 1)]


def test_zero_ratio_is_null(spark):
    from bazaar.operators.experiments import add_campaign_metrics
    df = spark.createDataFrame([(0, 0, 1.0, 0, 0, 0)],
                               "impressions long, clicks long, spend double, purchases long, add_to_cart long, view_content long")
    r = add_campaign_metrics(df).first()
    assert r.ctr is None and r.cost_per_click is None
