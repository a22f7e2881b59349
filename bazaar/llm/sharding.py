"""Two-pass external shuffle: seeded scatter into memory-sized buckets, Fisher-Yates in each, write."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.common import replace_columns


def record_size(text_col: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 8).cast("long")


def shuffle_shards(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_shards: int = 24,
                   seed: int = 17, bucket_bytes: int = 16 << 20) -> DataFrame:
    """Deal all rows into ``n_shards`` shards in a seeded random order; adds size, shard and slot.

    Pass 1 scatters whole records with a seeded hash of (id, text) into
    ceil(total size / bucket_bytes) buckets, one partition each.  Rows of one
    (id, text) that hold over a quarter of ``bucket_bytes`` are hashed by all
    their columns and a copy number: equal ones are counted and dealt out
    again, so they spread over the buckets.  Pass 2 brings
    a bucket into a fixed order and applies Spark's seeded ``shuffle`` (a
    Fisher-Yates over the bucket's array, seeded by seed + bucket).  The
    buckets end to end are one random permutation of the table, cut into
    shards whose row counts differ by at most one (law ``rows``); ``slot`` is
    the 0-based place in the shard.

    A task holds one bucket.  The only broadcasts are one (bucket, first row)
    pair per bucket, that is 16 bytes for every ``bucket_bytes`` of input, and
    the hashes of repeated rows that are dealt out (fewer than four per bucket).
    The order depends on the data and the seed alone, so a recomputed task
    writes the same rows.  Null ids and texts are hashed like any value;
    repeated rows stay, each in a slot of its own; an empty table gives none.
    Input columns named size, shard or slot are replaced.
    """
    df = replace_columns(df, ["size", "shard", "slot", "__bucket", "__hash", "__first", "__at", "__rec", "__place"])
    rows = df.withColumn("size", record_size(text_col)).withColumn(
        "__hash", F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)))
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    n_buckets = max(1, -(-total // bucket_bytes))
    if n_buckets > 1:
        rows = _dealt_copies(rows, df.columns, seed, bucket_bytes // 4)
    rows = rows.withColumn("__bucket", F.pmod("__hash", F.lit(n_buckets)).cast("int"))
    counts = rows.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))

    names = [c for c in rows.columns if c not in ("__bucket", "__hash")]
    bucketed = (rows.repartitionById(n_buckets, F.col("__bucket"))
                .sortWithinPartitions("__bucket", id_col, "__hash")
                .groupBy("__bucket").agg(F.collect_list(F.struct(*names)).alias("__recs")))
    dealt = bucketed.select("__bucket", F.posexplode(F.shuffle("__recs", F.lit(seed))).alias("__at", "__rec"))
    placed = (dealt.join(F.broadcast(firsts), "__bucket")
              .select("__rec.*", (F.col("__first") + F.col("__at")).cast("long").alias("__place")))
    base, more = divmod(count, n_shards)
    wide = more * (base + 1)                      # rows in the shards that hold one more
    place = F.col("__place")
    in_wide = place < wide
    rest = place - wide
    shard = F.when(in_wide, F.floor(place / F.lit(base + 1))).otherwise(more + F.floor(rest / F.lit(max(base, 1))))
    slot = F.when(in_wide, place % (base + 1)).otherwise(rest % max(base, 1))
    return (placed.withColumn("shard", shard.cast("int")).withColumn("slot", slot.cast("long"))
            .drop("__place"))


def _dealt_copies(rows: DataFrame, names: list[str], seed: int, most: int) -> DataFrame:
    """``rows`` with a new ``__hash`` where several rows of one hash hold over ``most`` bytes: another one for each."""
    heavy = (rows.groupBy("__hash").agg(F.count(F.lit(1)).alias("__n"), F.sum("size").alias("__bytes"))
             .where((F.col("__n") > 1) & (F.col("__bytes") > most)).select("__hash"))
    if not heavy.take(1):
        return rows
    heavy = F.broadcast(heavy)
    cols = [F.col(f"`{c}`") for c in names]
    # equal rows cannot be told apart, so their number is all that has to be kept
    copies = rows.join(heavy, "__hash", "left_semi").groupBy(*cols, "size").agg(F.count(F.lit(1)).alias("__n"))
    copies = (copies.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
              .withColumn("__hash", F.xxhash64(F.lit(seed), *cols, "__copy")))
    return rows.join(heavy, "__hash", "left_anti").unionByName(copies.select(*rows.columns))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write the shuffled records, one folder per shard; ``slot`` keeps the order within it.

    Every bucket holds one run of places, so a task adds to few folders.
    """
    sharded.write.partitionBy("shard").parquet(path)
