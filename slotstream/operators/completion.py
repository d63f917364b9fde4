"""Completion of slots and what waits for it: statuses, block metadata, slot ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotstream.functions.project import COMMITMENTS


def shard_progress(finish: DataFrame, shards: DataFrame) -> DataFrame:
    """slot, num_shards, done, complete, complete_arrival for every slot of ``shards``; a shard index counts modulo num_shards.

    The finish of the last missing shard completes a slot.
    """
    seen = finish.join(shards, "slot").groupBy("slot", F.pmod("shard_idx", "num_shards").alias("shard")).agg(F.min("finish_arrival").alias("at"))
    done = seen.groupBy("slot").agg(F.count(F.lit(1)).alias("done"), F.max("at").alias("last"))
    out = shards.join(done, "slot", "left").withColumn("done", F.coalesce("done", F.lit(0)))
    complete = F.col("done") == F.col("num_shards")
    return out.select("slot", "num_shards", "done", complete.alias("complete"), F.when(complete, F.col("last")).alias("complete_arrival"))


def complete_slots(progress: DataFrame) -> DataFrame:
    """Slots all of whose shards finished."""
    return progress.where("complete").select("slot", "complete_arrival")


def incomplete_slots(progress: DataFrame) -> DataFrame:
    """Slots with missing shards, and the share that is filled."""
    return progress.where("NOT complete").select("slot", "done", "num_shards", (F.col("done") / F.col("num_shards")).alias("filled"))


def gate_statuses(statuses: DataFrame, complete: DataFrame, commitment: str = "processed") -> DataFrame:
    """Statuses with released and release_arrival: once the slot is complete, or at once below the commitment asked for."""
    below = F.col("commitment") < COMMITMENTS[commitment]
    joined = statuses.join(complete, "slot", "left")
    release = F.when(below, F.col("log_offset")).when(F.col("complete_arrival").isNotNull(), F.greatest("log_offset", "complete_arrival"))
    return joined.withColumn("release_arrival", release).withColumn("released", F.col("release_arrival").isNotNull()).drop("complete_arrival")


def blocked_statuses(gated: DataFrame) -> DataFrame:
    """Statuses that still wait for their slot."""
    return gated.where("NOT released").drop("released", "release_arrival")


def slot_end_order(updates: DataFrame, meta: DataFrame, complete: DataFrame) -> DataFrame:
    """slot, rank, arrival, event of complete slots: payload (0), then block metadata if any (1), then the end (2)."""
    payload = updates.join(complete.select("slot"), "slot", "left_semi").select("slot", F.lit(0).alias("rank"), "arrival", F.col("kind").alias("event"))
    metas = release_meta(meta, complete).select("slot", F.lit(1).alias("rank"), F.col("complete_arrival").alias("arrival"), F.lit("block_meta").alias("event"))
    ends = complete.select("slot", F.lit(2).alias("rank"), F.col("complete_arrival").alias("arrival"), F.lit("ended").alias("event"))
    return payload.unionByName(metas).unionByName(ends)


def release_meta(meta: DataFrame, complete: DataFrame) -> DataFrame:
    """Block metadata of complete slots, once per slot; of several rows the least one, column by column, stays."""
    rest = [c for c in meta.columns if c != "slot"]
    once = meta.groupBy("slot").agg(F.min(F.struct(*rest)).alias("_m")).select("slot", *[F.col("_m")[c].alias(c) for c in rest])
    return once.join(complete, "slot")


def missing_slots(history: DataFrame, updates: DataFrame) -> DataFrame:
    """Slots of the log without any payload; they count as empty and finished."""
    return history.select("slot").distinct().join(updates.select("slot"), "slot", "left_anti")


def retained_slots(slots: DataFrame, keep: int = 10_000) -> DataFrame:
    """The newest ``keep`` slots. The cut is found with a top-n, not by ranking all slots in one task."""
    distinct = slots.select("slot").distinct()
    oldest = distinct.orderBy(F.col("slot").desc()).limit(keep).agg(F.min("slot").alias("oldest"))
    return distinct.join(F.broadcast(oldest), F.col("slot") >= F.col("oldest")).drop("oldest")  # one row


def running_max(df: DataFrame, order: str, value: str, width: int, out: str) -> DataFrame:
    """Add ``out``: the largest ``value`` of all rows with a smaller ``order``, null if one of these is null, and is_first.

    Two levels: a running maximum over buckets of ``width``, then one inside each bucket; no task sees all rows.
    """
    top = (1 << 63) - 1  # stands for a value that never comes
    df = df.withColumn("_b", F.floor(F.col(order) / width)).withColumn("_v", F.coalesce(F.col(value), F.lit(top)))
    buckets = df.groupBy("_b").agg(F.max("_v").alias("_m"))
    buckets = buckets.withColumn("_before", F.max("_m").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))).drop("_m")
    inside = F.max("_v").over(Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    joined = df.withColumn("_in", inside).join(buckets, "_b").withColumn("_max", F.greatest("_in", "_before"))
    return joined.withColumn("is_first", F.col("_max").isNull()).withColumn(out, F.when(F.col("_max") < top, F.col("_max"))).drop("_b", "_v", "_in", "_before", "_max")
