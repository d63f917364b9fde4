"""Commit offsets of consumer groups: the longest processed prefix of the log without a gap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_gaps(session: DataFrame) -> DataFrame:
    """consumer, gap: the first offset that a group has not processed (null: none). Offsets order a group's session.

    Every event has one row; ``settled`` makes it so where acknowledgements are rows of their own.

    An event of which it is not known whether it was processed (null) was not.
    """
    return session.groupBy("consumer").agg(F.min(F.when(~F.coalesce("processed", F.lit(False)), F.col("log_offset"))).alias("gap"))


def settled(session: DataFrame) -> DataFrame:
    """A session whose rows repeat offsets, as one row for each event: processed if any of its rows says so."""
    return session.groupBy("consumer", "log_offset").agg(F.coalesce(F.bool_or("processed"), F.lit(False)).alias("processed"))


def _by_gap(session: DataFrame) -> DataFrame:
    """``session`` with its group's first gap. The gaps, one row a group, are the hashed side: the session is neither sorted nor held."""
    return session.join(first_gaps(session).hint("shuffle_hash"), "consumer")


def _committable(rows: DataFrame) -> DataFrame:
    """consumer, last (before the first gap), max_slot where there are slots, and blocked: one aggregation over ``_by_gap``."""
    prefix = F.col("gap").isNull() | (F.col("log_offset") < F.col("gap"))
    waiting = F.coalesce("processed", F.lit(False)) & (F.col("log_offset") > F.col("gap"))
    slots = [F.max("slot").alias("max_slot")] if "slot" in rows.columns else []
    return rows.groupBy("consumer").agg(F.max(F.when(prefix, F.col("log_offset"))).alias("last"), F.count_if(waiting).alias("blocked"), *slots)


def committable_offsets(session: DataFrame, committed: DataFrame | None = None) -> DataFrame:
    """consumer, committable: the last offset before the first gap, or what was committed before (column committed).

    Two aggregations by group instead of a sequence number per row: no sort, and partial sums before the shuffle.
    """
    groups = first_gaps(session).select("consumer")  # rows without a group have no offset
    out = groups.join(_committable(_by_gap(session)), "consumer", "left").select("consumer", "last")
    if committed is None:
        return out.select("consumer", F.col("last").alias("committable"))
    return out.join(committed, "consumer", "left").select("consumer", _best().alias("committable"))


def _best() -> Column:
    return F.coalesce(F.greatest("last", "committed"), "committed")


def blocked_acks(session: DataFrame) -> DataFrame:
    """Processed events that wait behind a gap, per group."""
    return _committable(_by_gap(session)).select("consumer", "blocked")


def apply_commits(committed: DataFrame, proposed: DataFrame) -> DataFrame:
    """consumer, committed, written: new offsets replace older ones, never the reverse."""
    best = proposed.groupBy("consumer").agg(F.max("committable").alias("new"))
    joined = committed.join(best, "consumer", "full_outer")
    newer = F.coalesce(F.col("new") > F.coalesce("committed", F.lit(-1)), F.lit(False))
    return joined.select("consumer", F.when(newer, F.col("new")).otherwise(F.col("committed")).alias("committed"), newer.alias("written"))


def session_stats(session: DataFrame, committed: DataFrame) -> DataFrame:
    """One row per group: committed, committable, largest slot seen and number of blocked acknowledgements."""
    return committed.join(_committable(_by_gap(session)), "consumer").select("consumer", "committed", _best().alias("committable"), "max_slot", "blocked")
