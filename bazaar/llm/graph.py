"""Connected components by alternating large-star and small-star steps, as joins and aggregates."""
from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from bazaar.llm.common import dropped, saved, sized

SALTS = 8


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of ``edges`` (a, b) with the smallest node it is connected to.

    Large-star links each node's larger neighbours to the smallest of its
    neighbourhood, small-star its smaller ones; the edges become stars around
    the smallest nodes after a logarithmic number of rounds.  A node with very
    many neighbours is dealt over salts in the one join that meets it.  Each
    round is written to the shared folder and replaces the one before; only a
    count and a checksum come to the driver.  No side is broadcast, as all grow
    with the data.  The result is written too.
    """
    def put(df: DataFrame, rows: int) -> tuple[DataFrame, tuple]:
        """Save the edges; the same job counts and sums them."""
        seen = Observation()
        out = saved(sized(df.distinct(), rows).observe(seen, F.count(F.lit(1)).alias("n"),
                                          F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")), "edges")
        return out, (seen.get["n"], seen.get["sum"])

    e, now = put(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")),
                 edges.count())
    before = None
    while now != before and now[0]:
        before = now
        n = 2 * now[0]
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = (sized(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), n)
                 .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
        large = (both.where(F.col("v") > F.col("u")).withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
                 .join(least.hint("merge"), ["u", "salt"]).select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = sized(sized(large, n).distinct(), n)
        small = sized(large.groupBy("u").agg(F.min("v").alias("m")), n)
        rest = (large.join(small.hint("merge"), "u").where(F.col("v") != F.col("m"))
                .select(F.col("v").alias("u"), F.col("m").alias("v")))
        old = e
        e, now = put(sized(rest, n).union(small.select("u", F.col("m").alias("v"))), n)
        dropped(old)
    out = saved(e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "components")
    dropped(e)
    return out
