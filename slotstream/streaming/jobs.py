"""Structured Streaming jobs; they reuse the batch functions and agree with them on the same input."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from slotstream.functions.filters import with_versions
from slotstream.sources import versions

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that the stateful jobs need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def dedup_statuses(history: DataFrame, delay: str = "1 hour") -> DataFrame:
    """The first status of each (slot, commitment) within the watermark's delay, which bounds the state."""
    return history.withWatermark("created_at", delay).dropDuplicatesWithinWatermark(["slot", "commitment"])


def block_rates(blocks: DataFrame, tick: str = "1 second", delay: str = "10 seconds") -> DataFrame:
    """Blocks per tumbling tick."""
    counts = blocks.withWatermark("created_at", delay).groupBy(F.window("created_at", tick)).agg(F.count(F.lit(1)).alias("blocks"))
    return counts.select(F.unix_timestamp("window.start").alias("tick"), "blocks")


class SlotTracker(StatefulProcessor):
    """State of a range of slots, a row for each: finished shards, statuses that wait for the rest, commitments already sent.

    Input rows: slot, event (status or finish), log_offset, commitment, shard_idx, num_shards. Statuses leave when all
    shards have finished, or at once below ``minimum``; each commitment leaves once. A slot's state expires.
    """

    STATE = "slot bigint, num_shards int, changed bigint, shards array<int>, sent array<int>, waiting array<int>, offsets array<bigint>"

    def __init__(self, minimum: int = 0, ttl_ms: int | None = None):
        self.minimum, self.ttl_ms = minimum, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.slots = handle.getListState("slots", self.STATE, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = 0 if self.ttl_ms is None else timerValues.getCurrentProcessingTimeInMs()
        known = {}
        for slot, wanted, changed, shards, sent, waiting, offsets in self.slots.get():
            if self.ttl_ms is None or changed + self.ttl_ms > now:
                known[slot] = [wanted, changed, set(shards), set(sent), dict(zip(waiting, offsets, strict=True))]
        out: list[tuple[int, int, int | None]] = []
        batch = pd.concat(list(rows)).sort_values("log_offset", kind="stable")
        columns = (batch[c].tolist() for c in ("slot", "event", "log_offset", "commitment", "shard_idx", "num_shards"))
        for slot, event, offset, commitment, shard, wanted in zip(*columns, strict=True):
            state = known.setdefault(slot, [None, now, set(), set(), {}])
            shards, sent, waiting = state[2:]
            state[1] = now
            if event == "finish":
                state[0] = int(wanted)
                shards.add(int(shard) % state[0])
                if len(shards) == state[0]:
                    out += [(slot, c, o) for c, o in waiting.items() if c not in sent]
                    sent.update(waiting)
                    waiting.clear()
            elif (commitment := int(commitment)) not in sent:
                if commitment < self.minimum or len(shards) == state[0]:
                    sent.add(commitment)
                    out.append((slot, commitment, offset))
                else:
                    waiting[commitment] = min(offset, waiting.get(commitment, offset))
        self.slots.put([(slot, n, at, list(shards), list(sent), list(w), list(w.values())) for slot, (n, at, shards, sent, w) in known.items()])
        yield pd.DataFrame(out, columns=["slot", "commitment", "log_offset"]).astype({"slot": "int64", "commitment": "int32", "log_offset": "int64"})

    def close(self) -> None:
        pass


def track_slots(events: DataFrame, minimum: int = 0, ttl_ms: int | None = None, width: int = 256) -> DataFrame:
    """slot, commitment, log_offset of the statuses as they are released. A slot's state expires ``ttl_ms`` after its last change.

    ``width`` slots share a key, so that a batch calls on Python and the state store once for each range. Rows without a
    slot are left out; a finish needs no offset and comes behind its batch's statuses then.
    """
    mode = "none" if ttl_ms is None else "processingTime"
    offset = F.when(F.col("event") == "finish", F.coalesce("log_offset", F.lit(2**63 - 1))).otherwise(F.col("log_offset"))
    keyed = events.where("slot IS NOT NULL").withColumn("log_offset", offset).withColumn("slots", F.expr(f"slot DIV {width}")).groupBy("slots")
    return keyed.transformWithStateInPandas(SlotTracker(minimum, ttl_ms), "slot bigint, commitment int, log_offset bigint", "append", mode)


def retention_batches(path: str, keep: int = 10_000) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that keeps the newest ``keep`` slots seen so far, whatever the clock says.

    State is a versioned table of ``keep`` rows at most; a batch adds its own distinct slots and cuts with a top-n. A
    repeated batch starts from the version before it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        slots = batch.select("slot").where("slot IS NOT NULL").distinct()
        known = versions.read(batch.sparkSession, path, slots.schema, before=batch_id)
        versions.write(known.unionByName(slots).distinct().orderBy(F.col("slot").desc()).limit(keep), path, version=batch_id)

    return write


#: How a consumer's progress is kept: by the engine, by itself after each batch, or not at all.
COMMIT_MODES = ("auto", "manual", "none")


def last_commit(spark: SparkSession, commits: str) -> int | None:
    """The largest offset that was committed in a folder; None if there was no commit yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(commits)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema("committed bigint").option("recursiveFileLookup", "true").parquet(commits).agg(F.max("committed")).first()[0]


def consume(history: DataFrame, path: str, mode: str, run: int) -> None:
    """One run of a consumer over all that is there, from where its earlier runs in ``path`` left off under ``mode``.

    auto: the checkpoint goes on, every event comes once. manual: the largest offset of each batch is committed once
    it is written; a later run starts there, and the committed event itself comes again. none: a run starts anew.
    """
    if mode not in COMMIT_MODES:
        raise ValueError(f"unknown commit mode {mode!r}")
    spark, commits = history.sparkSession, f"{path}/commits"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("run", F.lit(run)).write.mode("overwrite").parquet(f"{path}/delivered/part={run}-{batch_id}")
        if mode == "manual":
            batch.agg(F.max("log_offset").alias("committed")).where("committed IS NOT NULL").write.mode("overwrite").parquet(f"{commits}/part={run}-{batch_id}")

    if mode == "manual" and (committed := last_commit(spark, commits)) is not None:
        history = history.where(F.col("log_offset") >= committed)
    checkpoint = f"{path}/checkpoint" if mode == "auto" else f"{path}/checkpoint-{run}"
    history.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(write).start().awaitTermination()


def filter_batches(versions: str, path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that tags rows with the filter version in force at their slot.

    The table of versions is read again for each batch, so a change takes effect for what is loaded after it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        known = batch.sparkSession.read.parquet(versions)
        tagged = with_versions(batch, known).where(F.col("commitment") >= F.col("minimum"))
        tagged.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write
