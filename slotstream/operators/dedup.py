"""Removal of repeated updates, statuses and loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotstream.functions.filters import at_least

KEYED = ("account", "transaction", "transaction_status", "entry")


def update_key(signature: str = "txn_signature") -> Column:
    """What identifies an update in its shard: account by (pubkey, signature), transaction and status by index, entry by index."""
    group = F.when(F.col("kind").isin("transaction", "transaction_status"), "transaction").otherwise(F.col("kind"))
    account = F.col("kind") == "account"
    return F.struct(group.alias("group"), F.when(account, F.col("pubkey")).otherwise(F.col("idx")).alias("first"), F.when(account, F.col(signature)).alias("second"))


def dedup_updates(updates: DataFrame, signature: str = "txn_signature") -> DataFrame:
    """First arrival of each key in its (slot, shard); kinds without a key are left out.

    The planner turns the rank into a limit of one row per key before the shuffle, so repeats leave early; a minimum over
    whole rows would be a sort aggregate, which takes longer where most keys are distinct.
    """
    first = Window.partitionBy("slot", "shard_idx", update_key(signature)).orderBy("arrival")
    return updates.where(F.col("kind").isin(*KEYED)).withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def before_finish(updates: DataFrame, finish: DataFrame, late: bool = False) -> DataFrame:
    """Updates that arrived before their shard finished, or the late ones; rows of unfinished shards are not late."""
    joined = updates.join(finish, ["slot", "shard_idx"], "left")
    after = F.coalesce(F.col("arrival") > F.col("finish_arrival"), F.lit(False))
    return joined.where(after if late else ~after).select(*updates.columns)


def dedup_status(history: DataFrame) -> DataFrame:
    """All statuses with is_first: whether it is the first one of its slot and commitment in the log.

    Repeats stay in the table, because they count as processed for the commit offset.
    """
    order = Window.partitionBy("slot", "commitment").orderBy("log_offset")
    return history.withColumn("is_first", F.row_number().over(order) == 1)


def first_statuses(history: DataFrame) -> DataFrame:
    """The first offset of each (slot, commitment), by aggregation alone."""
    return history.groupBy("slot", "commitment").agg(F.min("log_offset").alias("log_offset"))


def slot_worklist(history: DataFrame, commitment: str = "processed", payload: str = "num_shards") -> DataFrame:
    """One load per slot: what the earliest status at the commitment or above says about the slot."""
    return at_least(history, commitment).groupBy("slot").agg(F.min("log_offset").alias("log_offset"), F.min_by(payload, "log_offset").alias(payload))


def distinct_accounts(accounts: DataFrame) -> DataFrame:
    """Distinct (pubkey, signature) pairs per slot; updates outside transactions are not counted."""
    pairs = accounts.where(F.col("txn_signature").isNotNull())
    return pairs.groupBy("slot").agg(F.countDistinct("pubkey", "txn_signature").alias("account_updates"))
