"""Scans and sinks (survey 2.A).

All readers take an explicit schema; nothing is inferred.  Parquet scans
rely on Catalyst for column pruning and predicate pushdown, so callers
just ``select``/``filter`` the returned DataFrame.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as a lazy Parquet scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """One driver table as a stream of its files (the schema is the table's)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return reader.parquet(path)
    # a table of one file: a stream's source must be a folder, so its folder, and that file alone
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def read_table(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv",
               sep: str = ",", header: bool = True, date_format: str | None = None,
               timestamp_format: str | None = None) -> DataFrame:
    """Delimited / Parquet scan with a fixed schema (A1, A3)."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
        if date_format:
            reader = reader.option("dateFormat", date_format)
        if timestamp_format:
            reader = reader.option("timestampFormat", timestamp_format)
    return reader.format(fmt).load(path)


CORRUPT = "_corrupt_record"


def read_checked(spark: SparkSession, path, schema: StructType, sep: str = ",", header: bool = True,
                 date_format: str | None = None, timestamp_format: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of delimited files with a fixed schema: malformed lines are set aside, not read as nulls.

    A line is malformed when it has another number of fields than the schema
    or a value that its type cannot hold.  ``rejects`` keeps the whole line in
    ``record``, its ``file`` and the ``reason`` (``fields`` or ``value``);
    empty values are nulls and sound, empty lines are no lines.  Every line
    but those and the headers is in exactly one of the two.  Partition columns
    of the path stay in both.  Fields are parsed whole even if a caller selects
    few columns, so the same lines are rejected whatever is read later.
    """
    taken = {f.name.lower() for f in schema.fields}
    corrupt = next(n for n in (CORRUPT, *(f"{CORRUPT}_{i}" for i in range(len(taken) + 1))) if n.lower() not in taken)
    full = StructType([*schema.fields, StructField(corrupt, StringType())])
    reader = (spark.read.schema(full).option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", corrupt).option("columnPruning", False)
              .option("enforceSchema", True))
    if date_format:
        reader = reader.option("dateFormat", date_format)
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    raw = reader.csv(path)
    bad = F.col(f"`{corrupt}`")
    # separators outside quotes count the fields of a rejected line
    bare = F.regexp_replace(bad, '"[^"]*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1
    reason = F.when(fields == len(schema.fields), F.lit("value")).otherwise(F.lit("fields"))
    kept = [c for c in raw.columns if c != corrupt]
    # always true; it makes the scan parse every field, and Spark refuses to read the lines alone
    parsed = F.xxhash64(*[F.col(f"`{f.name}`") for f in schema.fields]) % 1 == 0
    found = [c for c in kept if c.lower() not in taken]
    rejects = (raw.withColumn("__file", F.col("_metadata.file_path")).where(bad.isNotNull() & parsed)
               .select(F.col("__file").alias("file"), bad.alias("record"), reason.alias("reason"), *[F.col(f"`{c}`") for c in found]))
    return raw.where(bad.isNull() & parsed).select(*[F.col(f"`{c}`") for c in kept]), rejects


def rejects_by(rows: DataFrame, rejects: DataFrame, by: list[str]) -> DataFrame:
    """Lines read, sound and rejected (by reason) per ``by``, also where all or none are rejected."""
    flags = rows.select(*by, F.lit(None).cast("string").alias("reason")).unionByName(rejects.select(*by, "reason"))
    return flags.groupBy(*by).agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.col("reason").isNull()).alias("sound"),
        F.count("reason").alias("rejected"), F.count_if(F.col("reason") == "fields").alias("rejected_fields"),
        F.count_if(F.col("reason") == "value").alias("rejected_values"))


def read_arms(spark: SparkSession, paths: dict[str, str], schema: StructType,
              sep: str = ";", arm_col: str = "arm", **kw) -> DataFrame:
    """One file per experiment arm -> one tagged DataFrame (A2)."""
    frames = [read_table(spark, p, schema, sep=sep, **kw).withColumn(arm_col, F.lit(arm))
              for arm, p in paths.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def read_jdbc(spark: SparkSession, url: str, table_name: str, partition_col: str | None = None,
              lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None, properties: dict | None = None) -> DataFrame:
    """Database table scan, split into parallel range reads on ``partition_col`` (A4)."""
    props = dict(properties or {})
    if partition_col is not None:
        return spark.read.jdbc(url, table_name, column=partition_col, lowerBound=lower,
                               upperBound=upper, numPartitions=num_partitions or 8,
                               properties=props)
    return spark.read.jdbc(url, table_name, properties=props)


def register(df: DataFrame, name: str) -> DataFrame:
    """Register a DataFrame as a SQL view, replacing an older one (A5)."""
    df.createOrReplaceTempView(name)
    return df


def publish_view(df: DataFrame, name: str, materialize_path: str | None = None) -> DataFrame:
    """Publish a model as a view; optionally materialise it as Parquet first."""
    if materialize_path:
        export_parquet(df, materialize_path)
        df = df.sparkSession.read.parquet(materialize_path)
    return register(df, name)


def export_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                   mode: str = "overwrite") -> str:
    """Write a result as Parquet (A8, A9); partition columns allow pruning later."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def _plain_path(c: str) -> Column:
    """A file path with one slash after the scheme, as the several sources write it differently."""
    return F.regexp_replace(c, "^([A-Za-z0-9]+):/+", "$1:/")


def file_metadata(spark: SparkSession, paths) -> DataFrame:
    """(path, file_name, file_bytes, modified) of all files below ``paths``: a listing, no file is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return listed.select(_plain_path("path").alias("path"), F.element_at(F.split("path", "/"), -1).alias("file_name"),
                         F.col("length").alias("file_bytes"), F.col("modificationTime").alias("modified"))


def file_inventory(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Files of a dataset with their sizes and row counts (A10); a file without rows has 0.

    Sizes come from the listing, rows from one scan grouped by the hidden
    ``_metadata`` path (no data column is read).
    """
    rows = (spark.read.format(fmt).load(path).groupBy(_plain_path("_metadata.file_path").alias("path"))
            .agg(F.count(F.lit(1)).alias("rows")))
    return (file_metadata(spark, path).join(rows, "path", "left")
            .select("file_name", "file_bytes", F.coalesce("rows", F.lit(0)).alias("rows")))


def table_files(spark: SparkSession, sf_dir: str, names) -> DataFrame:
    """A10 over several tables: one row per (table, file) with bytes and rows."""
    out = None
    for n in names:
        part = file_inventory(spark, f"{sf_dir.rstrip('/')}/{n}.parquet").select(
            F.lit(n).alias("table_name"), "file_name", "file_bytes", "rows")
        out = part if out is None else out.unionByName(part)
    return out


# The campaign export's column headers and their snake_case names.
CAMPAIGN_RENAMES = {
    "Campaign Name": "campaign_name", "Date": "date", "Spend [USD]": "spend",
    "# of Impressions": "impressions", "Reach": "reach", "# of Website Clicks": "clicks",
    "# of Searches": "searches", "# of View Content": "view_content", "# of Add to Cart": "add_to_cart",
    "# of Purchase": "purchases",
}


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by a map (columns not in the frame are ignored)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def read_campaign_arms(spark: SparkSession, paths: dict[str, str], checked: bool = False):
    """A2 + B11 + B21: ';'-separated daily campaign files (one per arm),
    dates as d.M.yyyy, renamed to snake_case, tagged with the arm.

    With ``checked`` also the rejected lines: (rows, rejects).
    """
    from pyspark.sql import types as T
    fields = [T.StructField("Campaign Name", T.StringType()), T.StructField("Date", T.StringType()),
              T.StructField("Spend [USD]", T.DoubleType()), T.StructField("# of Impressions", T.LongType()),
              T.StructField("Reach", T.LongType()), T.StructField("# of Website Clicks", T.LongType()),
              T.StructField("# of Searches", T.LongType()), T.StructField("# of View Content", T.LongType()),
              T.StructField("# of Add to Cart", T.LongType()), T.StructField("# of Purchase", T.LongType())]
    def tidy(raw):
        return rename_columns(raw, CAMPAIGN_RENAMES).withColumn("date", F.to_date("date", "d.M.yyyy"))

    if not checked:
        return tidy(read_arms(spark, paths, T.StructType(fields), sep=";"))
    pairs = [[part.withColumn("arm", F.lit(arm)) for part in read_checked(spark, p, T.StructType(fields), sep=";")]
             for arm, p in paths.items()]
    rows, rejects = pairs[0]
    for more, bad in pairs[1:]:
        rows, rejects = rows.unionByName(more), rejects.unionByName(bad)
    return tidy(rows), rejects


# Column headers of the reference's input files and the names used here.
RETAIL_RENAMES = {
    "Invoice": "invoice", "StockCode": "stock_code", "Description": "description", "Quantity": "quantity",
    "InvoiceDate": "invoice_date", "Price": "price", "Customer ID": "customer_id", "Country": "country",
}
AB_RENAMES = {"user_id": "user_id", "timestamp": "ts", "group": "grp", "landing_page": "landing_page",
              "converted": "converted"}


def read_retail_lines(spark: SparkSession, path: str, fmt: str = "csv",
                      timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """A3: invoice lines (exported from the workbook) with a fixed schema.

    Codes stay strings (no numeric inference), the customer id is a nullable
    long (never a float), timestamps are timestamp_ntz.
    """
    from pyspark.sql import types as T
    schema = T.StructType([
        T.StructField("Invoice", T.StringType()), T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()), T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.StringType()), T.StructField("Price", T.DoubleType()),
        T.StructField("Customer ID", T.DoubleType()), T.StructField("Country", T.StringType())])
    raw = read_table(spark, path, schema, fmt=fmt)
    df = rename_columns(raw, RETAIL_RENAMES)
    return df.select("invoice", "stock_code", "description", "quantity",
                     F.to_timestamp_ntz(F.col("invoice_date"), F.lit(timestamp_format)).alias("invoice_date"),
                     "price", F.col("customer_id").cast("long").alias("customer_id"), "country")


def read_ab_units(spark: SparkSession, path: str, experiment_id: str = "ab", checked: bool = False):
    """A1: the unit-level A/B file (user, timestamp, group, page, converted) with a fixed
    schema, tagged with an experiment id and a row number in file order as tie-break.

    With ``checked`` also the rejected lines: (rows, rejects).
    """
    from pyspark.sql import types as T
    schema = T.StructType([
        T.StructField("user_id", T.LongType()), T.StructField("timestamp", T.StringType()),
        T.StructField("group", T.StringType()), T.StructField("landing_page", T.StringType()),
        T.StructField("converted", T.IntegerType())])
    raw, rejects = read_checked(spark, path, schema) if checked else (read_table(spark, path, schema), None)
    rows = rename_columns(raw, AB_RENAMES).select(F.lit(experiment_id).alias("experiment_id"),
                      F.monotonically_increasing_id().alias("row_id"), "user_id",
                      F.to_timestamp_ntz(F.col("ts")).alias("ts"), "grp", "landing_page", "converted")
    return (rows, rejects) if checked else rows


def read_user_events(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The event log layout (user_id, timestamp, device_type, action_type,
    session_duration_minutes) with an event id in file order as tie-break."""
    from pyspark.sql import types as T
    schema = T.StructType([
        T.StructField("user_id", T.LongType()), T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("device_type", T.StringType()), T.StructField("action_type", T.StringType()),
        T.StructField("session_duration_minutes", T.DoubleType())])
    raw = read_table(spark, path, schema, fmt=fmt)
    return raw.select(F.monotonically_increasing_id().alias("event_id"), "user_id",
                      F.col("timestamp").alias("ts"), "device_type", "action_type", "session_duration_minutes")
