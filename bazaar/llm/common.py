"""Helpers shared by the operators: shared scratch tables, text columns, blocked row numbers."""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaar.session import ensure_checkpoint_dir, ship_code


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Read one input table with Spark's own reader (any file system Spark knows)."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the package shipped to Python workers and a checkpoint folder set."""
    ship_code(spark)
    ensure_checkpoint_dir(spark)
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark)}/bazaar-{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage with files that every executor sees, so a lost executor
    costs a re-read only; later readers prune columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def dropped(*tables: DataFrame | None) -> None:
    """Delete the files of tables that :func:`saved` wrote.

    Only for tables whose last reader has been saved itself: a frame that still
    depends on one could no longer be recomputed.
    """
    for df in tables:
        path = getattr(df, "_scratch", None)
        if path:
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def sized(df: DataFrame, rows: int, per_task: int = 50_000) -> DataFrame:
    """``df`` in no more tasks than ``rows`` short rows need (never in more than it has).

    For small derived tables on their way through many shuffles, where AQE
    may not merge partitions; large tables keep all their partitions.
    """
    return df.coalesce(max(6, -(-rows // per_task)))


def text_of(col: str = "text") -> Column:
    """The text column with null read as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def replace_columns(df: DataFrame, taken: list[str]) -> DataFrame:
    """Drop input columns whose names (any case) the operator writes itself."""
    low = {c.lower() for c in taken}
    return df.drop(*[c for c in df.columns if c.lower() in low])


def numbered(df: DataFrame, group: list[str], order: list[str], block: Column, name: str) -> DataFrame:
    """Add ``name``: 0-based position in ``group`` by ``order``, without a task per group.

    ``block`` cuts a group into runs (any partition of its rows); rows are
    numbered in their run and each run starts after the runs with smaller
    block values.  Only the small (group, block, count) table is windowed per
    group, so a hot group spreads over its blocks.
    """
    df = df.withColumn("__block", block)
    counts = df.groupBy(*group, "__block").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*group, "__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*group, "__block").orderBy(*order)
    rows = df.withColumn("__at", F.row_number().over(inside) - 1)
    return (rows.join(starts, [*group, "__block"])
            .withColumn(name, (F.col("__start") + F.col("__at")).cast("long"))
            .drop("__block", "__start", "__at"))
