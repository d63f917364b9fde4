"""Live counters of a running job: observed with its batches, written as one row for each."""

from __future__ import annotations

import threading
from uuid import UUID

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from slotstream.sources import sinks

#: What is counted of the rows of a batch, and of the slots that are new with it.
ROW_COUNTERS: dict[str, str] = {
    "events": "count(1)",
    "processed": "count_if(processed)",
    "skipped": "count_if(NOT processed)",
    "processed_statuses": "count_if(commitment = 0)",
    "confirmed_statuses": "count_if(commitment = 1)",
    "finalized_statuses": "count_if(commitment = 2)",
}
NAMES = (*ROW_COUNTERS, "slots", "polls", "full")
SCHEMA = ", ".join(f"{n} bigint" for n in NAMES)


def count_session(rows: DataFrame, delay: str = "1 hour", file: str | None = None) -> DataFrame:
    """The work-list of a session, each slot with its first row, with counters on the way.

    ``rows``: slot, commitment, processed, created_at. All rows count as events, nulls in no other counter. A slot is
    new once within ``delay``, which bounds the state; rows without slot or time and rows behind the watermark name no
    slot. With ``file``, the column of the file that a row was read from, the files of a batch are counted too, at most
    as many as the source takes at a time.
    """
    files = F.size(F.collect_set(file)) if file else F.count_if(F.lit(False))
    seen = rows.observe("rows", *[F.expr(e).alias(n) for n, e in ROW_COUNTERS.items()], files.alias("files"))
    known = seen.where("slot IS NOT NULL AND created_at IS NOT NULL")
    fresh = known.withWatermark("created_at", delay).dropDuplicatesWithinWatermark(["slot"])
    return fresh.observe("slots", F.count(F.lit(1)).alias("slots"))


class CounterWriter(StreamingQueryListener):
    """Writes the counters of every batch of one job to ``path``, a batch that is run again in place of its first run.

    ``polls`` is 1 for a batch with rows, ``full`` is 1 if it had as many files as ``limit`` allows. Use it as a context
    around start and end of the job; leaving it waits until the job's last batch is written, and raises what went wrong.
    """

    def __init__(self, spark: SparkSession, job: str, path: str, limit: int | None = None):
        self.spark, self.job, self.path, self.limit = spark, job, path, limit
        self.ended = threading.Event()
        self.run: UUID | None = None
        self.failure: Exception | None = None

    def onQueryStarted(self, event) -> None:
        if event.name == self.job:
            self.run = event.runId

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.runId != self.run or "rows" not in progress.observedMetrics:
            return
        try:
            rows = progress.observedMetrics["rows"].asDict()
            files = rows.pop("files")
            slots = progress.observedMetrics["slots"]["slots"] if "slots" in progress.observedMetrics else 0
            full = self.limit is not None and files >= self.limit
            values = tuple(int(rows[n]) for n in ROW_COUNTERS) + (int(slots), int(progress.numInputRows > 0), int(full))
            sinks.idempotent_parquet(self.path)(self.spark.createDataFrame([values], SCHEMA).coalesce(1), progress.batchId)
        except Exception as e:  # a listener's errors are only logged: keep it for the caller
            self.failure = e

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run:
            self.ended.set()

    def __enter__(self) -> CounterWriter:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, kind, *_) -> None:
        try:
            if kind is None and not self.ended.wait(60):
                raise TimeoutError(f"no end of {self.job}")
        finally:
            self.spark.streams.removeListener(self)
        if self.failure is not None:
            raise self.failure


def totals(spark: SparkSession, path: str) -> DataFrame:
    """One row: the sums of all batches written so far."""
    return spark.read.parquet(path).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in NAMES])
