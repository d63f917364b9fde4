"""Regrouping of the event stream: slot-sequential order, blocks, plain updates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotstream.operators.completion import running_max

PASS_THROUGH = ("slot_status", "block_meta")
#: Arrivals per bucket of the running maximum over slots.
WIDTH = 100_000


def slot_sequential(arrivals: DataFrame, width: int = WIDTH) -> DataFrame:
    """``arrivals`` with emit and first_seen: slots contiguous, in the order in which they were first seen.

    Sort by (emit, first_seen, arrival) for the stream. A slot opens when all slots seen before it have ended;
    statuses and block metadata pass at once (first_seen 0). Events behind a slot that never ends have no emit.
    Windows run on one row per slot, and in buckets of arrivals.
    """
    passes = (F.col("event") == "data") & F.col("kind").isin(*PASS_THROUGH)
    held = arrivals.where(~passes | passes.isNull())
    slots = held.groupBy("slot").agg(F.min("arrival").alias("first_seen"), F.min(F.when(F.col("event") == "ended", F.col("arrival"))).alias("end"))
    opened = running_max(slots, "first_seen", "end", width, "open").select("slot", "first_seen", "open", "is_first")
    emit = F.when(F.col("is_first"), F.col("arrival")).when(F.col("open").isNotNull(), F.greatest("arrival", "open"))
    grouped = held.join(opened, "slot").select(*arrivals.columns, emit.alias("emit"), "first_seen")
    return grouped.unionByName(arrivals.where(passes).select("*", F.col("arrival").alias("emit"), F.lit(0).cast("long").alias("first_seen")))


def block_stream(arrivals: DataFrame) -> DataFrame:
    """slot, end_arrival and the ordered updates of each ended slot, with all their columns; block metadata is part of a block, statuses are not.

    A block is one array; blocks too large for that are rows in ``block_rows``.
    """
    ends = arrivals.where("event = 'ended'").groupBy("slot").agg(F.min("arrival").alias("end_arrival"))
    rows = arrivals.where("event = 'data' AND (kind IS NULL OR kind <> 'slot_status')")
    payload = [c for c in arrivals.columns if c not in ("slot", "event", "arrival")]
    blocks = rows.groupBy("slot").agg(F.array_sort(F.collect_list(F.struct("arrival", *payload)), lambda a, b: F.when(a["arrival"] < b["arrival"], -1).when(a["arrival"] > b["arrival"], 1).otherwise(0)).alias("updates"))
    return ends.join(blocks, "slot", "left").withColumn("updates", F.coalesce("updates", F.array().cast(blocks.schema["updates"].dataType)))


def block_rows(arrivals: DataFrame) -> DataFrame:
    """The same as flat rows, for blocks too large for one array."""
    ends = arrivals.where("event = 'ended'").groupBy("slot").agg(F.min("arrival").alias("end_arrival"))
    return arrivals.where("event = 'data' AND (kind IS NULL OR kind <> 'slot_status')").join(ends, "slot")


def plain_updates(arrivals: DataFrame) -> DataFrame:
    """Updates alone, without slot ends."""
    return arrivals.where("event = 'data'")
