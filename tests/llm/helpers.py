"""Shared by the tests of the llm operators."""
import zlib

DOC_COLS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, extra: dict | None = None):
    """A documents table of (doc_id, text) pairs, or texts numbered from 0; ``extra`` adds constant columns."""
    from pyspark.sql import functions as F
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOC_COLS)
    for name, value in (extra or {}).items():
        df = df.withColumn(name, F.lit(value))
    return df


def crc(text):
    return zlib.crc32((text or "").encode())
