"""Reading the log and its payload."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

POLL_LIMIT = 100


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table with a declared schema; nothing is inferred."""
    return spark.read.schema(schema).parquet(path)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` in a declared schema: its columns by name, cast, and nulls for what it lacks."""
    known = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def poll(history: DataFrame, start: int | None = None, limit: int = POLL_LIMIT) -> DataFrame:
    """The next events of the log from an offset on, in order."""
    rows = history if start is None else history.where(F.col("log_offset") >= start)
    return rows.orderBy("log_offset").limit(limit)


def resume(history: DataFrame, committed: int) -> DataFrame:
    """Events that a consumer has not committed; the committed one itself is replayed."""
    return history.where(F.col("log_offset") >= committed)


def load_slots(updates: DataFrame, worklist: DataFrame) -> DataFrame:
    """The payload of the slots in a work-list; the join strategy follows the list's size."""
    return updates.join(worklist.select("slot"), "slot", "left_semi")


def write_slot_ranges(updates: DataFrame, path: str, width: int) -> None:
    """The payload in one folder for each range of ``width`` slots; a range is written by as many tasks as its rows need."""
    ranged = updates.withColumn("slot_range", F.expr(f"slot DIV {width}"))
    ranged.hint("rebalance", "slot_range").write.mode("overwrite").partitionBy("slot_range").parquet(path)


def load_slot_ranges(spark: SparkSession, path: str, schema: StructType, worklist: DataFrame, width: int) -> DataFrame:
    """The payload of the slots in a work-list, from a table that ``write_slot_ranges`` wrote with the same width.

    The ranges are a join key beside the slot, so the scan is pruned at run time to the folders that the list names, where
    Spark broadcasts the list; a list too large for that names most ranges anyway.
    """
    known = StructType([f for f in schema.fields if f.name != "slot_range"]).add("slot_range", LongType())
    wanted = worklist.select("slot", F.expr(f"slot DIV {width}").alias("slot_range"))
    return spark.read.schema(known).parquet(path).join(wanted, ["slot_range", "slot"], "left_semi").select(*[f.name for f in schema.fields])


def stream_table(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 100, pattern: str | None = None) -> DataFrame:
    """A table read continuously, some files at a time."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).parquet(path)
