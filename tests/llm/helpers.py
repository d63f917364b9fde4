import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
SEPARATORS = " \t\n\x0b\x0c\r"


def documents(spark, texts, sources=None):
    """A documents table from texts or (doc_id, text) pairs."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "en", (sources or ["a", "b"])[k % len(sources or "ab")], len(t or "")) for k, (i, t) in enumerate(rows)], DOCS)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
