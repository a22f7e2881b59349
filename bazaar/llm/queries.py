"""Registered queries ``opN_<name>`` of the operators, over their whole tables."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.llm.common import prepared, read, text_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepared(spark), sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


@query
def op2_sharding(spark, sf_dir):
    """All documents in 24 shards by the two-pass external shuffle, counts at most one apart."""
    from bazaar.llm.sharding import shuffle_shards
    out = shuffle_shards(read(spark, sf_dir, "documents"), n_shards=24)
    return out.select("doc_id", "size", F.crc32(text_of().cast("binary")).alias("text_crc32"),
                      F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op4_chat_formatting(spark, sf_dir):
    """Maximal logged conversations, rendered."""
    from bazaar.llm.chat import format_chats
    return format_chats(read(spark, sf_dir, "conversations"))


@query
def op8_topk_search(spark, sf_dir):
    """The 5 best integer inner products of every 50th vector over all others."""
    from bazaar.llm.topk import exact_top_k
    return exact_top_k(read(spark, sf_dir, "embeddings"), is_query=F.col("id") % 50 == 0, k=5)


@query
def op1_secret_scan(spark, sf_dir):
    """Secrets of every document by the base patterns and the inferred formats."""
    from bazaar.llm.secrets import find_secrets
    return find_secrets(read(spark, sf_dir, "documents"))


@query
def op10_packing(spark, sf_dir):
    """All documents in sequences of at most 4096 tokens by best-fit decreasing."""
    from bazaar.llm.packing import pack_documents
    return pack_documents(read(spark, sf_dir, "documents"))


@query
def op3_license_scan(spark, sf_dir):
    """Licence phrases and licence texts of every document."""
    from bazaar.llm.licenses import scan_licenses
    return scan_licenses(read(spark, sf_dir, "documents"))


@query
def op5_quality_classifier(spark, sf_dir):
    """Quality score of every document by the compiled rule ensemble."""
    from bazaar.llm.quality import score_quality
    return score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op6_near_duplicates(spark, sf_dir):
    """Near-duplicate class of every document by Order MinHash and banded alignment."""
    from bazaar.llm.neardup import near_duplicates
    return near_duplicates(read(spark, sf_dir, "documents"))


@query
def op9_embedding_duplicates(spark, sf_dir):
    """Near-duplicate embeddings of one label by NN-descent."""
    from bazaar.llm.neighbours import embedding_duplicates
    return embedding_duplicates(read(spark, sf_dir, "embeddings"))


@query
def op7_sentencepiece(spark, sf_dir):
    """SentencePiece ids of every document, and the CRC-32 of the text decoded from them."""
    from bazaar.llm.pieces import decode_pieces, encode_pieces
    out = decode_pieces(encode_pieces(read(spark, sf_dir, "documents")))
    return out.select("doc_id", "n_tokens", "ids_crc32", F.crc32(F.col("text").cast("binary")).alias("text_crc32"))


@query
def op11_hard_negatives(spark, sf_dir):
    """Three hard negatives per positive of every 50th vector; the label of every seventh row is moved on by one."""
    from bazaar.llm.negatives import mine_hard_negatives
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(read(spark, sf_dir, "embeddings").withColumn("label", moved), is_anchor=F.col("id") % 50 == 0)


@query
def op12_language_id(spark, sf_dir):
    """Language of every document by averaged hashed subword embeddings."""
    from bazaar.llm.language import identify_language
    return identify_language(read(spark, sf_dir, "documents"))


@query
def op13_spelling_variants(spark, sf_dir):
    """Words of all documents, thinned by checksum, with their near words, form and root."""
    from bazaar.llm.spelling import count_words, group_variants
    return group_variants(count_words(read(spark, sf_dir, "documents")))
