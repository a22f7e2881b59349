"""Column and table profiles (survey 2.D13-D33).

Profiles of many columns are built by unpivoting to (column_name, value)
and aggregating once, so the number of passes does not grow with the
number of columns.  Quantiles are exact and distributed
(:func:`bazaar.operators.ranking.exact_quantiles`); ``approx=True`` swaps
in ``percentile_approx`` for a single bounded-memory pass.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.operators.ranking import exact_quantiles
from bazaar.sources.tables import file_metadata, table

# Box-plot band labels, in plot order.
BOX_BANDS = ("outlier_low", "whisker_low_to_Q1", "IQR_box (25-75%)", "Q3_to_whisker_high", "outlier_high")
# Selectivity classes (share of rows matching one value).
SELECTIVITY_CLASSES = (("very_high", 1.0), ("medium", 10.0), ("low", None))


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row.

    The aggregate becomes one scalar subquery returning a struct: it runs
    once and its value is a constant in the row-level projection, so there
    is no join (and no row pairing) at all.
    """
    packed = one_row.select(F.struct(*one_row.columns)).scalar()
    return df.withColumn("__attached", packed).select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[F.col("__attached").getField(c).alias(c) for c in one_row.columns])


def unpivot(df: DataFrame, cols: Sequence[str], value_type: str = "string",
            keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column_name, value) rows for the given columns (``DataFrame.unpivot``)."""
    cast = df.select(*keep, *[F.col(c).cast(value_type).alias(c) for c in cols])
    return cast.unpivot(list(keep), list(cols), "column_name", "value")


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """Rows per value (the null bucket kept when ``dropna`` is False)."""
    src = df.where(F.col(col).isNotNull()) if dropna else df
    return src.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def column_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Dtype, non-null, null, null %, distinct per column (one shuffle)."""
    cols = list(cols or df.columns)
    dtypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    per_value = (unpivot(df, cols).groupBy("column_name", "value")
                 .agg(F.count(F.lit(1)).alias("n")))
    prof = per_value.groupBy("column_name").agg(
        F.sum("n").alias("total"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("distinct"))
    dtype_map = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(dtypes[c]))])
    return prof.select(
        "column_name", dtype_map[F.col("column_name")].alias("dtype"),
        (F.col("total") - F.col("nulls")).alias("non_null"), F.col("nulls").cast("long").alias("nulls"),
        F.bround(F.col("nulls") * 100.0 / F.col("total"), 2).alias("null_pct"),
        F.col("distinct").cast("long").alias("distinct"))


def describe_numeric(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Count, mean, std (sample), min, quartiles, max per column (long form)."""
    long = unpivot(df, cols, "double").where(F.col("value").isNotNull())
    moments = long.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    probs = [0.25, 0.5, 0.75]
    if approx:
        q = long.groupBy("column_name").agg(F.percentile_approx("value", probs, 10000).alias("q"))
        qs = q.select("column_name", *[F.col("q")[i].alias(n) for i, n in enumerate(["q25", "q50", "q75"])])
    else:
        qs = (exact_quantiles(long, "value", probs, by=["column_name"])
              .groupBy("column_name").pivot("prob", probs).agg(F.first("quantile")))
        qs = qs.select("column_name", *[F.col(f"`{p}`").alias(n) for p, n in zip(probs, ["q25", "q50", "q75"])])
    return moments.join(qs, "column_name").select(
        "column_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, unique, top (ties -> smallest value), freq per column."""
    per_value = (unpivot(df, cols).where(F.col("value").isNotNull())
                 .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))
    return per_value.groupBy("column_name").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"))


def null_rates(df: DataFrame, table_name: str, threshold: float = 5.0) -> DataFrame:
    """Percent NULL per column (1 decimal, half-up), flagged above ``threshold``.

    One aggregate pass per table, whatever the number of columns.
    """
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"__null_{i}") for i, c in enumerate(cols)])
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__null_{i}").alias("null_count"))
                    for i, c in enumerate(cols)])
    long = agg.select("__n", F.inline(arr))
    pct = F.round(F.try_divide(F.col("null_count") * 100.0, F.col("__n")), 1)
    return long.select(F.lit(table_name).alias("table_name"), "column_name", "null_count",
                       F.col("__n").alias("total_rows"), pct.alias("null_pct"),
                       (pct > threshold).alias("flagged"))


def date_range(df: DataFrame, col: str) -> DataFrame:
    """First and last value."""
    return df.agg(F.min(col).alias("min_value"), F.max(col).alias("max_value"))


def duplicate_summary(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Total rows vs distinct rows (one grouping of the compared columns)."""
    g = df.groupBy(*[c for c in df.columns if c not in ignore]).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.sum("n").alias("total_rows"), F.count(F.lit(1)).alias("distinct_rows"),
                 (F.sum("n") - F.count(F.lit(1))).alias("duplicate_rows"))


def iqr_bounds(df: DataFrame, cols: Sequence[str], k: float = 1.5, approx: bool = False) -> DataFrame:
    """q1, q3, IQR and the fences q1 - k*IQR, q3 + k*IQR per column."""
    long = unpivot(df, cols, "double").where(F.col("value").isNotNull())
    if approx:
        q = long.groupBy("column_name").agg(F.percentile_approx("value", [0.25, 0.75], 10000).alias("q"))
        q = q.select("column_name", F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))
    else:
        q = (exact_quantiles(long, "value", [0.25, 0.75], by=["column_name"])
             .groupBy("column_name").agg(F.max(F.when(F.col("prob") == 0.25, F.col("quantile"))).alias("q1"),
                                         F.max(F.when(F.col("prob") == 0.75, F.col("quantile"))).alias("q3")))
    iqr = F.col("q3") - F.col("q1")
    return q.select("column_name", "q1", "q3", iqr.alias("iqr"),
                    (F.col("q1") - k * iqr).alias("lower"), (F.col("q3") + k * iqr).alias("upper"))


def box_band(v, q1, q3, lower, upper):
    """The box-plot band of a value (``unknown`` for NULL)."""
    return (F.when(v < lower, F.lit(BOX_BANDS[0]))
             .when((v >= lower) & (v < q1), F.lit(BOX_BANDS[1]))
             .when((v >= q1) & (v <= q3), F.lit(BOX_BANDS[2]))
             .when((v > q3) & (v <= upper), F.lit(BOX_BANDS[3]))
             .when(v > upper, F.lit(BOX_BANDS[4]))
             .otherwise(F.lit("unknown")))


def boxplot_summary(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """D24 (+B17, C7): rows per box-plot band and column, empty bands as 0.

    The fences have one row per column, so joining them is a bounded
    broadcast; the band list is zero-filled from the fences themselves.
    """
    bounds = iqr_bounds(df, cols, k)
    long = unpivot(df, cols, "double")
    banded = long.join(F.broadcast(bounds), "column_name").select(
        "column_name", box_band(F.col("value"), F.col("q1"), F.col("q3"),
                                F.col("lower"), F.col("upper")).alias("band"))
    counts = banded.groupBy("column_name", "band").agg(F.count(F.lit(1)).alias("rows"))
    labels = F.array(*[F.struct(F.lit(i + 1).alias("band_order"), F.lit(b).alias("band"))
                       for i, b in enumerate(BOX_BANDS)])
    frame = bounds.select("column_name", F.inline(labels))
    return (frame.join(counts, ["column_name", "band"], "left")
                 .select("column_name", "band_order", "band",
                         F.coalesce(F.col("rows"), F.lit(0)).cast("long").alias("rows")))


def selectivity_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per value, share of the table and the selectivity class."""
    per_value = (unpivot(df, cols).groupBy("column_name", "value")
                 .agg(F.count(F.lit(1)).alias("rows")))
    total = df.agg(F.count(F.lit(1)).alias("__total"))
    share = F.col("rows") * 100.0 / F.col("__total")
    cls = (F.when(share < SELECTIVITY_CLASSES[0][1], F.lit(SELECTIVITY_CLASSES[0][0]))
            .when(share <= SELECTIVITY_CLASSES[1][1], F.lit(SELECTIVITY_CLASSES[1][0]))
            .otherwise(F.lit(SELECTIVITY_CLASSES[2][0])))
    return attach(per_value, total).select("column_name", "value", "rows",
                                           share.alias("share_pct"), cls.alias("selectivity"))


def table_profile(spark: SparkSession, sf_dir: str, names: Sequence[str]) -> DataFrame:
    """Rows, columns, files and bytes per table (one count per table; sizes from one listing of all)."""
    base = sf_dir.rstrip("/")
    parts = []
    for n in names:
        t = table(spark, sf_dir, n)
        parts.append(t.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(n).alias("table_name"), "rows", F.lit(len(t.columns)).cast("long").alias("columns")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    sizes = (file_metadata(spark, [f"{base}/{n}.parquet" for n in names])
             .groupBy(F.regexp_extract("path", r"/([^/]+)\.parquet(/[^/]*)*$", 1).alias("table_name"))
             .agg(F.count(F.lit(1)).alias("files"), F.sum("file_bytes").alias("bytes")))
    return out.join(sizes, "table_name", "left").select(
        "table_name", "rows", "columns", F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("bytes", F.lit(0)).alias("bytes"))


def histogram(df: DataFrame, col: str, bins: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over [min, max] per group, empty bins as 0."""
    by = list(by)
    v = F.col(col).cast("double")
    src = df.select(*by, v.alias("__v")).where(F.col("__v").isNotNull())
    stats = src.groupBy(*by).agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    width = (F.col("__hi") - F.col("__lo")) / bins
    bin_no = F.when(F.col("__hi") == F.col("__lo"), F.lit(1)).otherwise(
        F.least(F.floor((F.col("__v") - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * bins) + 1,
                F.lit(bins))).cast("long")
    joined = src.join(stats, by) if by else attach(src, stats)  # per-group stats: size-checked join
    counts = joined.groupBy(*by, bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
    frame = stats.select(*by, "__lo", "__hi", F.explode(F.sequence(F.lit(1).cast("long"),
                                                                   F.lit(bins).cast("long"))).alias("bin"))
    return (frame.join(counts, by + ["bin"], "left")
                 .select(*by, "bin", (F.col("__lo") + (F.col("bin") - 1) * width).alias("lower"),
                         (F.col("__lo") + F.col("bin") * width).alias("upper"),
                         F.coalesce(F.col("rows"), F.lit(0)).cast("long").alias("rows")))


def density(df: DataFrame, col: str, grid: int = 64, by: Sequence[str] = (), cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density (Scott bandwidth) on an evenly spaced grid.

    Every distinct value adds its kernel (times its count) to the ``grid``
    points; the sums combine map-side, so the last shuffle holds one row per
    group and task.  A group of one value has NULL densities.
    """
    by = list(by)
    v = F.col(col).cast("double")
    src = df.select(*by, v.alias("__v")).where(F.col("__v").isNotNull())
    stats = src.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"), F.stddev_samp("__v").alias("__sd"),
                                 F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    stats = stats.withColumn("__h", F.col("__sd") * F.pow(F.col("__n"), F.lit(-0.2)))
    stats = (stats.withColumn("__g0", F.col("__lo") - cut * F.col("__h"))
                  .withColumn("__step", (F.col("__hi") - F.col("__lo") + 2 * cut * F.col("__h")) / (grid - 1)))
    # identical values share one kernel evaluation, weighted by how often they occur
    distinct_v = src.groupBy(*by, "__v").agg(F.count(F.lit(1)).alias("__w"))
    joined = distinct_v.join(stats, by) if by else attach(distinct_v, stats)  # size-checked join
    def kernel(j):
        u = F.try_divide(F.col("__g0") + j * F.col("__step") - F.col("__v"), F.col("__h"))
        return F.sum(F.col("__w") * F.exp(-0.5 * F.pow(u, 2)))
    # one sum per grid point, combined map-side; rows are never multiplied by the grid
    sums = joined.groupBy(*by, "__n", "__h", "__g0", "__step").agg(F.array(*[kernel(j) for j in range(grid)]).alias("__s"))
    points = sums.select(*by, "__n", "__h", "__g0", "__step", F.posexplode("__s").alias("grid_index", "__k"))
    return points.select(*by, F.col("grid_index").cast("long").alias("grid_index"),
                         (F.col("__g0") + F.col("grid_index") * F.col("__step")).alias("x"),
                         F.try_divide(F.col("__k"), F.col("__n") * F.col("__h") * F.lit((2 * 3.141592653589793) ** 0.5))
                         .alias("density"))


def distinct_by(df: DataFrame, by: Sequence[str], col: str, approx: bool = False,
                rsd: float = 0.01) -> DataFrame:
    """Distinct values of ``col`` per group; ``approx`` uses HyperLogLog++ (bounded state)."""
    f = F.approx_count_distinct(col, rsd) if approx else F.count_distinct(col)
    return df.groupBy(*by).agg(f.alias(f"distinct_{col}"))


def union_all(*dfs: DataFrame) -> DataFrame:
    """G1: UNION ALL by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out
