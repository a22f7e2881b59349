"""Chat formatting: collapse cumulative snapshots of logged conversations, then render the maximal ones."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.common import numbered

BLOCK_TURNS = 1024      # turns per window block and per rendered chunk


def render_turn(role: Column, text: Column) -> Column:
    """One turn as ``<|role|>``, a line break, the text and a line break."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n"))


def turn_prefixes(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """(conv_key, conv_id, pos, role, text, h1, h2): each turn with the rolling hash of its prefix.

    The hash is the running XOR of two seeded 64-bit hashes of (position,
    role, text), so equal prefixes of equal length agree and order matters.
    It runs inside blocks of ``block_turns`` turns; a second, small window
    carries the XOR of earlier blocks, so a conversation with very many turns
    is spread over its blocks.
    """
    t = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    t = t.withColumn("conv_key", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))
    t = numbered(t, ["conv_key"], ["turn", "role", "text"],
                 F.coalesce(F.floor(F.col("turn") / block_turns), F.lit(-(2 ** 62))), "pos")
    t = (t.withColumn("pos", F.col("pos") + 1)
         .withColumn("block", F.floor((F.col("pos") - 1) / block_turns))
         .withColumn("x1", F.xxhash64(F.lit(1), "pos", "role", "text"))
         .withColumn("x2", F.xxhash64(F.lit(2), "pos", "role", "text")))
    blocks = t.groupBy("conv_key", "block").agg(F.bit_xor("x1").alias("b1"), F.bit_xor("x2").alias("b2"))
    before = Window.partitionBy("conv_key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = blocks.select("conv_key", "block", *[F.coalesce(F.bit_xor(f"b{i}").over(before), F.lit(0)).alias(f"c{i}")
                                                 for i in (1, 2)])
    run = Window.partitionBy("conv_key", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("r1", F.bit_xor("x1").over(run)).withColumn("r2", F.bit_xor("x2").over(run))
    return (t.join(carry, ["conv_key", "block"])
            .select("conv_key", "conv_id", "pos", "role", "text",
                    F.col("r1").bitwiseXOR(F.col("c1")).alias("h1"), F.col("r2").bitwiseXOR(F.col("c2")).alias("h2")))


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """(conv_key, n_turns, copies): conversations that no longer one begins with; equal ones once.

    Equal conversations are grouped first (smallest id stays), so the
    anti-join against the distinct strict prefixes meets each key once.
    """
    full = prefixes.groupBy("conv_key").agg(
        F.max("pos").alias("n_turns"), F.min("conv_id").alias("conv_id"),
        F.max_by(F.struct("h1", "h2"), "pos").alias("h"))
    whole = full.groupBy("n_turns", "h").agg(
        F.min_by("conv_key", F.struct("conv_id", "conv_key")).alias("conv_key"), F.count(F.lit(1)).alias("copies"))
    lengths = full.select("conv_key", "n_turns")
    strict = (prefixes.select("conv_key", "pos", F.struct("h1", "h2").alias("h")).join(lengths, "conv_key")
              .where(F.col("pos") < F.col("n_turns"))
              .select(F.col("pos").alias("n_turns"), "h").distinct())
    return whole.join(strict, ["n_turns", "h"], "left_anti").select("conv_key", "n_turns", "copies")


def format_chats(conversations: DataFrame, chunk_turns: int = BLOCK_TURNS) -> DataFrame:
    """Render every maximal conversation once.

    Returns conv_id, chunk (0-based; a conversation of over ``chunk_turns``
    turns continues in further rows, whole and in order), n_turns and copies
    of the conversation, and ``rendered``.  Turns are ordered by (turn, role,
    text); exactly repeated turn rows count once; null roles and texts are
    empty; rows with a null conv_id form one conversation with a null id; no
    rows give no rows.  Columns beyond conv_id, turn, role, text are ignored.
    """
    t = turn_prefixes(conversations)
    keep = maximal_conversations(t)
    kept = t.join(keep, "conv_key").withColumn("chunk", F.floor((F.col("pos") - 1) / chunk_turns).cast("long"))
    parts = kept.groupBy("conv_key", "chunk").agg(
        F.min("conv_id").alias("conv_id"), F.max("n_turns").alias("n_turns"), F.max("copies").alias("copies"),
        F.sort_array(F.collect_list(F.struct("pos", render_turn(F.col("role"), F.col("text")).alias("s")))).alias("p"))
    return parts.select("conv_id", "chunk", "n_turns", "copies", F.array_join(F.col("p.s"), "").alias("rendered"))
