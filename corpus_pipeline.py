"""The corpus pipeline: quality rules, near-duplicate removal, PII surrogates, mixing, BPE encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. Every stage but the last
returns the columns of documents; the last adds the token ids and the position in the mixed order. SQL cannot express the near-duplicate search,
the surrogates and the encoding, so the pipeline is tested against brute force instead.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotstream.llm import bpe, mixing, ngram_join, pii, quality_rules
from slotstream.llm.common import bounded, materialize
from slotstream.llm.queries import PII_KEY, VOCABULARY


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality rules reject; words are judged from 50 on, the fewest that pass the base rules."""
    return quality_rules.keep_good(docs, quality_rules.Limits(judged_words=50))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the one with the smallest doc_id, of each component of near copies; rows without doc_id stay."""
    found = ngram_join.near_duplicates(docs, size=5, percent=75)
    gone = materialize(found.where("component_id <> doc_id").select("doc_id").distinct(), "gone")
    return docs.join(bounded(gone), "doc_id", "left_anti").select(*docs.columns)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data and secrets; n_chars follows the new text."""
    done = pii.replace_entities(docs, PII_KEY, count="_replaced").drop("_replaced")
    return done.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else done


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of the mixing schedule, as the order of the written files' rows."""
    return mixing.mix(docs, alpha=0.5).orderBy("position").select(*docs.columns)


def placed(docs: DataFrame) -> DataFrame:
    """``docs``, read from a table written in order, with each row's position in it: scans return files in any order.

    Part files are told apart by number; the offsets are one row per file.
    """
    rows = docs.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    number = F.regexp_extract("_file", "^part-(\\d+)", 1).cast("long")
    sizes = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy(number, "_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = materialize(sizes.select("_file", before.alias("_before")), "offsets")
    found = rows.join(bounded(offsets), "_file").withColumn("position", F.col("_before") + F.col("_index"))
    return found.select(*[c for c in docs.columns if c != "position"], "position")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their position in the mixed order, token ids and number of tokens."""
    return bpe.encode(placed(docs), public_tokenizers.path(VOCABULARY)).withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [("quality_rules", quality), ("ngram_join", near_duplicates), ("pii", surrogates), ("mixing", mixed), ("bpe", encoded)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
