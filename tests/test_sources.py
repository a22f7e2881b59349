import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from bazaar.operators import cleaning as CL
from bazaar.sources import tables as T

from tests.paths import SF_SMALL

HEADER = ("Campaign Name;Date;Spend [USD];# of Impressions;Reach;# of Website Clicks;# of Searches;"
          "# of View Content;# of Add to Cart;# of Purchase")


def test_read_campaign_arms_renames_and_parses_dates(spark):
    d = tempfile.mkdtemp(prefix="bazaar-csv-")
    paths = {}
    for arm, rows in (("control", ["Control Campaign;1.08.2019;2280;82702;56930;7016;2290;2159;1819;618",
                                   "Control Campaign;5.08.2019;1835;;;;;;;"]),
                      ("test", ["Test Campaign;1.08.2019;3008;39550;35820;3038;1946;1069;894;255"])):
        p = os.path.join(d, f"{arm}.csv")
        with open(p, "w") as f:
            f.write(HEADER + "\n" + "\n".join(rows) + "\n")
        paths[arm] = p
    df = T.read_campaign_arms(spark, paths)
    assert {"spend", "impressions", "clicks", "purchases", "arm", "date"} <= set(df.columns)
    rows = {(r.arm, r.date): r for r in df.collect()}
    assert rows[("control", dt.date(2019, 8, 1))].clicks == 7016
    assert rows[("control", dt.date(2019, 8, 5))].impressions is None      # the missing day
    assert rows[("test", dt.date(2019, 8, 1))].spend == 3008.0


def test_file_inventory_counts_rows(spark):
    inv = T.table_files(spark, SF_SMALL, ["orders", "nation"]).collect()
    by = {r.table_name: r for r in inv}
    assert by["nation"].rows == 25 and by["orders"].rows == spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    assert all(r.file_bytes > 0 for r in inv)


def test_publish_view_and_export(spark):
    df = spark.range(5).withColumn("d", F.lit("x"))
    T.publish_view(df, "bazaar_v")
    assert spark.sql("SELECT count(*) AS n FROM bazaar_v").first().n == 5
    out = os.path.join(tempfile.mkdtemp(prefix="bazaar-out-"), "t")
    T.publish_view(df, "bazaar_m", materialize_path=out)
    assert spark.table("bazaar_m").count() == 5 and os.path.isdir(out)


def test_exclude_zero_fill_order_like(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    keys = spark.createDataFrame([(2,)], "k long")
    assert sorted(r.k for r in CL.exclude_keys(df, keys, "k").collect()) == [1, 3]
    counts = spark.createDataFrame([("a", 4)], "label string, n long")
    labels = spark.createDataFrame([("a",), ("b",)], "label string")
    assert {r.label: r.n for r in CL.zero_fill(counts, labels, "label", "n").collect()} == {"a": 4, "b": 0}
    rank = spark.createDataFrame([(1, 5), (2, 9), (3, 1)], "k long, size long")
    assert [r.k for r in CL.order_like(df, rank, "k", "size").collect()] == [2, 1, 3]


def test_distinct_by_exact_and_approx(spark):
    from bazaar.operators import profile as P
    df = spark.createDataFrame([(g, i % 50) for g in ("a", "b") for i in range(500)], "g string, u long")
    ex = {r.g: r.distinct_u for r in P.distinct_by(df, ["g"], "u").collect()}
    ap = {r.g: r.distinct_u for r in P.distinct_by(df, ["g"], "u", approx=True).collect()}
    assert ex == {"a": 50, "b": 50} and all(abs(ap[k] - 50) <= 2 for k in ap)
    assert P.union_all(df, df, df).count() == 3000


def test_reference_shaped_inputs(spark):
    from bazaar.operators import cleaning as CL
    from bazaar.operators import experiments as E
    d = tempfile.mkdtemp(prefix="bazaar-ref-")
    retail = os.path.join(d, "retail.csv")
    with open(retail, "w") as f:
        f.write("Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
                "489434,85048,LED LIGHT,12,2009-12-01 07:45:00,6.95,13085.0,United Kingdom\n"
                "C489449,22087,PAPER BUNTING,-12,2009-12-01 10:33:00,2.95,16321.0,Australia\n"
                "489436,POST,POSTAGE,1,2009-12-01 09:06:00,18.0,,United Kingdom\n")
    lines = T.read_retail_lines(spark, retail)
    rows = {r.invoice: r for r in lines.collect()}
    assert rows["489434"].customer_id == 13085 and rows["489436"].customer_id is None
    assert rows["C489449"].invoice_date == dt.datetime(2009, 12, 1, 10, 33)
    assert [r.invoice for r in CL.clean_rfm(lines).collect()] == ["489434"]
    ab = os.path.join(d, "ab.csv")
    with open(ab, "w") as f:
        f.write("user_id,timestamp,group,landing_page,converted\n"
                "851104,2017-01-21 22:11:48.556739,control,old_page,0\n"
                "804228,2017-01-12 08:01:45.159739,control,new_page,0\n"
                "661590,2017-01-11 16:55:06.154213,treatment,new_page,1\n"
                "661590,2017-01-12 16:55:06.154213,treatment,new_page,0\n")
    units = T.read_ab_units(spark, ab)
    prepared = E.prepare_ab(units)
    assert sorted((r.user_id, r.converted) for r in prepared.collect()) == [(661590, 1), (851104, 0)]


def test_read_user_events_feeds_hourly_metrics(spark):
    from bazaar.operators import events as EV
    d = os.path.join(tempfile.mkdtemp(prefix="bazaar-ev-"), "ev")
    spark.createDataFrame(
        [(1001, dt.datetime(2024, 5, 1, 10, 1), "mobile", "view", 12.5),
         (1002, dt.datetime(2024, 5, 1, 10, 40), "desktop", "click", 3.0),
         (1001, dt.datetime(2024, 5, 1, 11, 5), "mobile", "purchase", 8.0)],
        "user_id long, timestamp timestamp_ntz, device_type string, action_type string, "
        "session_duration_minutes double").write.parquet(d)
    ev = T.read_user_events(spark, d)
    got = {r.hour: (r.session_count, r.unique_users) for r in EV.hourly_metrics(ev).collect()}
    assert got == {dt.datetime(2024, 5, 1, 10): (2, 2), dt.datetime(2024, 5, 1, 11): (1, 1)}


def _lines(text, name="f.csv"):
    d = tempfile.mkdtemp(prefix="bazaar-csv-")
    with open(os.path.join(d, name), "w") as f:
        f.write(text)
    return d


def test_malformed_lines_are_set_aside(spark):
    from pyspark.sql import types as TY
    schema = TY.StructType([TY.StructField("id", TY.LongType()), TY.StructField("_corrupt_record", TY.StringType()),
                            TY.StructField("x", TY.DoubleType()), TY.StructField("d", TY.DateType())])
    d = _lines('id,n,x,d\n1,a,2.5,2020-01-02\n2,"b,c",,2020-01-03\nthree,a,1,2020-01-04\n4,a,1\n5,a,1,2020-01-05,more\n'
               '\n6,"q,r",bad,2020-01-06\n7,a,1,2020-02-31\n,,,\n')
    rows, rejects = T.read_checked(spark, d, schema, date_format="yyyy-MM-dd")
    good = {r.id: r for r in rows.collect()}
    assert set(good) == {1, 2, None} and good[2]["_corrupt_record"] == "b,c" and good[2].x is None
    bad = {r.record: r.reason for r in rejects.collect()}
    assert bad == {"three,a,1,2020-01-04": "value", "4,a,1": "fields", "5,a,1,2020-01-05,more": "fields",
                   '6,"q,r",bad,2020-01-06': "value", "7,a,1,2020-02-31": "value"}
    assert rows.select("id").count() == 3 and rows.count() == 3 and rejects.count() == 5   # pruned reads reject the same lines
    assert rejects.first().file.endswith("f.csv")
    report = T.rejects_by(rows.withColumn("all", F.lit(1)), rejects.withColumn("all", F.lit(1)), ["all"]).first()
    assert (report.lines, report.sound, report.rejected, report.rejected_fields, report.rejected_values) == (8, 3, 5, 2, 3)


def test_checked_readers(spark):
    d = _lines("user_id,timestamp,group,landing_page,converted\n1,2017-01-02 03:04:05,control,old_page,0\nx,2017-01-02 03:04:05,control,old_page,1\n")
    rows, rejects = T.read_ab_units(spark, d, checked=True)
    assert [r.user_id for r in rows.collect()] == [1] and rejects.count() == 1
    p = {a: _lines(HEADER + f"\nC;1.08.2019;2280;82702;56930;{v};2290;2159;1819;618\n") for a, v in (("control", "7016"), ("test", "many"))}
    rows, rejects = T.read_campaign_arms(spark, p, checked=True)
    assert [r.clicks for r in rows.collect()] == [7016]
    assert [(r.arm, r.reason) for r in rejects.collect()] == [("test", "value")]


def test_files_without_rows_and_folders(spark):
    d = tempfile.mkdtemp(prefix="bazaar-files-")
    spark.range(10).repartition(2).write.parquet(f"{d}/t.parquet")
    spark.range(0).write.mode("append").parquet(f"{d}/t.parquet")
    inv = T.file_inventory(spark, f"{d}/t.parquet").collect()
    sizes = {f: os.path.getsize(f"{d}/t.parquet/{f}") for f in os.listdir(f"{d}/t.parquet") if f.endswith(".parquet")}
    assert {r.file_name: r.file_bytes for r in inv} == sizes
    assert sum(r.rows for r in inv) == 10 and min(r.rows for r in inv) == 0
    from bazaar.operators.profile import table_profile
    r = table_profile(spark, d, ["t"]).first()
    assert (r.rows, r.columns, r.files, r.bytes) == (10, 1, len(sizes), sum(sizes.values()))
