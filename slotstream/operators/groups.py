"""Consumer groups as tables: creation, look-up, staleness, deletion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def initial_offset(history: DataFrame, from_slot: int | None = None) -> DataFrame:
    """One row: the tip, or the smallest offset at ``from_slot`` or later (the tip if there is none)."""
    tip = F.max("log_offset")
    if from_slot is None:
        return history.agg(tip.alias("initial_offset"))
    return history.agg(F.coalesce(F.min(F.when(F.col("slot") >= from_slot, F.col("log_offset"))), tip).alias("initial_offset"))


def create(groups: DataFrame, history: DataFrame, name: str, from_slot: int | None = None) -> DataFrame:
    """``groups`` with a new one; ValueError if the name is taken."""
    if not groups.where(F.col("name") == name).isEmpty():
        raise ValueError(f"group {name!r} exists")
    row = initial_offset(history, from_slot).select(F.sha2(F.lit(name), 256).alias("id"), F.lit(name).alias("name"), F.col("initial_offset").alias("committed_offset"))
    return groups.unionByName(row)


def info(groups: DataFrame, name: str) -> DataFrame:
    """The group of a name; no row if there is none."""
    return groups.where(F.col("name") == name)


def stale(groups: DataFrame, oldest: int) -> DataFrame:
    """Groups with is_stale: their committed offset is no longer in the log."""
    return groups.withColumn("is_stale", F.col("committed_offset") < oldest)


def listing(groups: DataFrame) -> DataFrame:
    """Uid, name and staleness of all groups."""
    return groups.select(F.col("id").alias("uid"), "name", F.col("is_stale").alias("stale"))


def delete(groups: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """``groups`` without those named, or without any. Unknown names change nothing."""
    return groups.limit(0) if names is None else groups.join(names.select("name"), "name", "left_anti").select(*groups.columns)
