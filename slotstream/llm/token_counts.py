"""Token counts from an exact histogram of encoded lengths.

Documents are aggregated by their encoded length once; suffix sums over the lengths then answer totals,
quantiles and totals after truncation for every context limit, without another pass over the texts.

Null texts count as length 0; a null length is left out. An empty table gives an empty histogram.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Lengths per block of the two-level suffix sums.
BLOCK = 1024


def length_histogram(df: DataFrame, length: str) -> DataFrame:
    """One row per length: n_tokens, n_docs. Map-side partial sums; the shuffle carries lengths, not documents."""
    return df.where(F.col(length).isNotNull()).groupBy(F.col(length).cast("long").alias("n_tokens")).agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Add, per length L taken as context limit, what lies at or beyond it.

    docs_from, tokens_from: documents and tokens in documents of at least L tokens.
    total_docs, total_tokens: over the corpus. tokens_truncated: tokens kept if every document is cut to L.
    quantile: share of documents with at most L tokens.

    The sums run in two levels, within blocks of lengths and over the block totals, so that no task
    holds more than one block or one row per block.
    """
    h = histogram.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    after = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    blocks = blocks.select("block", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"), F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"), F.sum("d").over(everything).alias("total_docs"), F.sum("t").over(everything).alias("total_tokens"))
    within = Window.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, 0)
    out = h.join(blocks, "block").withColumn("docs_from", F.sum("n_docs").over(within) + F.col("d_after")).withColumn("tokens_from", F.sum("tokens").over(within) + F.col("t_after"))
    shorter_docs = F.col("total_docs") - F.col("docs_from")
    return out.select(
        "n_tokens", "n_docs", "docs_from", "tokens_from", "total_docs", "total_tokens",
        (F.col("total_tokens") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")).alias("tokens_truncated"),
        ((shorter_docs + F.col("n_docs")) / F.col("total_docs")).alias("quantile"),
    )


def truncated_total(sums: DataFrame, limit: int) -> DataFrame:
    """One row: tokens kept if every document is cut to ``limit``, for any limit, from ``suffix_sums``."""
    over = F.col("n_tokens") > limit
    kept = F.sum(F.when(over, F.lit(limit) * F.col("n_docs")).otherwise(F.col("n_tokens") * F.col("n_docs")))
    return sums.agg(F.coalesce(kept, F.lit(0)).cast("long").alias("tokens_kept"), F.coalesce(F.sum(F.when(over, F.col("n_docs"))), F.lit(0)).cast("long").alias("docs_cut"))


def quantile_length(sums: DataFrame, q: float) -> DataFrame:
    """One row: the smallest length that at least the share ``q`` of documents does not exceed."""
    return sums.where(F.col("quantile") >= q).agg(F.min("n_tokens").alias("n_tokens"))
