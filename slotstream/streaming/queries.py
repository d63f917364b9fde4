"""Streaming jobs as queries: each reads the log as a stream until its end and returns what was written."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.sources import sinks, tables, versions
from slotstream.sources import testdata as td
from slotstream.streaming import counters, jobs, stateful


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the shared one, or, on one machine, a local one where none is set."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return f"{shared.rstrip('/')}/stream-{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix="spark-")


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream, whether it is one file or a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    folder = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory()
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return tables.stream_table(spark, f"{sf_dir}/events.parquet" if folder else sf_dir, schema, pattern=None if folder else "events.parquet")


def history_rows(events: DataFrame) -> DataFrame:
    """A stream of events as history, with event time that a watermark accepts."""
    return events.selectExpr(*td.HISTORY_COLUMNS).withColumn("created_at", F.col("created_at").cast("timestamp"))


def _finish(stream: DataFrame, mode: str = "append", each: Callable[[DataFrame, int], None] | None = None) -> DataFrame | None:
    spark = stream.sparkSession
    out = shared_folder(spark)
    writer = stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", f"{out}/checkpoint")
    (writer.foreachBatch(each) if each else writer.format("parquet").option("path", f"{out}/data")).start().awaitTermination()
    return None if each else spark.read.schema(stream.schema).parquet(f"{out}/data")


def history_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _finish(history_rows(_stream(spark, sf_dir)).drop("created_at"))


def stream_dedup_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _finish(jobs.dedup_statuses(history_rows(_stream(spark, sf_dir)), "31 days")).select("slot", "commitment")


def stream_block_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last state of every tick; ticks are hours here."""
    out = f"{shared_folder(spark)}/rates"
    rates = jobs.block_rates(history_rows(_stream(spark, sf_dir)), "1 hour", "0 seconds")
    _finish(rates, "update", sinks.idempotent_parquet(out))
    return spark.read.parquet(out).groupBy("tick").agg(F.max_by("blocks", "batch_id").alias("blocks"))


def _in_parts(spark: SparkSession, parts: list[DataFrame], job: Callable[[DataFrame], DataFrame], each: Callable[[DataFrame, int], None] | None = None, files: int = 100) -> DataFrame:
    """What a stateful job makes of a log that grows part by part, stopped and started again in between; ``files`` make a batch."""
    jobs.use_rocksdb(spark)
    out = shared_folder(spark)
    schemas = []

    def run(stream: DataFrame, i: int) -> None:
        made = job(stream)
        schemas.append(made.schema)
        writer = made.writeStream.outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{out}/checkpoint")
        (writer.foreachBatch(each) if each else writer.format("parquet").option("path", f"{out}/data")).start().awaitTermination()

    _runs(spark, f"{out}/log", parts, run, files)
    return spark.read.schema(schemas[0]).parquet(f"{out}/data") if each is None else spark.createDataFrame([], schemas[0])


def _thirds(table: DataFrame, order: str) -> list[DataFrame]:
    """A log cut in three by ``order``."""
    low, high = table.selectExpr(f"min({order})", f"max({order})").first()
    cuts = [low + (high - low) * k // 3 for k in (1, 2)] if low is not None else [0, 0]
    return [table.where(F.col(order) <= cuts[0]), table.where((F.col(order) > cuts[0]) & (F.col(order) <= cuts[1])), table.where(F.col(order) > cuts[1])]


def stream_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs.use_rocksdb(spark)
    session = _stream(spark, sf_dir).selectExpr("user_id AS consumer", td.HISTORY_COLUMNS[0], td.HISTORY_COLUMNS[1], "event_type <> 'error' AS processed")
    return _finish(stateful.track_commits(session)).groupBy("consumer").agg(F.max("committable").alias("committable"))


def stream_commit_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit offsets where a third of the gaps are acknowledged in a later run, out of order: each joins the stretch behind it."""
    columns = ["consumer", "log_offset", "processed"]
    parts = [td.session(spark, sf_dir).select(columns), td.late_acknowledgements(spark, sf_dir).select(columns)]
    return _in_parts(spark, parts, stateful.track_commits).groupBy("consumer").agg(F.max("committable").alias("committable"))


def stream_late_after_finish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates that came after their shard had finished; what is late comes in a second run. Ship dates span years, so the watermark is far behind."""
    log = td.shard_events(spark, sf_dir)
    finish = td.shard_finish(spark, sf_dir)
    late = (F.col("event") == "data") & (F.col("arrival") > F.coalesce("finish_arrival", F.col("arrival")))
    log.join(finish, ["slot", "shard_idx"], "left").withColumn("later", late).drop("finish_arrival").write.parquet(marked := f"{shared_folder(spark)}/marked")
    marked = spark.read.schema(log.schema.add("later", "boolean")).parquet(marked)  # made once, for both parts
    parts = [marked.where("NOT later").drop("later"), marked.where("later").drop("later")]
    found = _in_parts(spark, parts, lambda rows: stateful.mark_late(rows, delay="10000 days", keep_ms=10**12))
    return found.where("late").select("slot", F.col("shard_idx").cast("int").alias("shard_idx"), "kind", "arrival")


def stream_slot_sequential(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot-sequential order of one lane, while the log grows. Every slot ends: behind one that does not, a lane stands still.

    A part is one batch, however many files it has: its files are not in order of arrival, batches have to be.
    """
    parts = _thirds(td.arrivals(spark, sf_dir, all_end=True).withColumn("lane", F.lit(0)), "arrival")
    return _in_parts(spark, parts, lambda rows: stateful.order_slots(rows, "lane"), files=(1 << 31) - 1)


def stream_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks as they end, while the log grows."""
    blocks = _in_parts(spark, _thirds(td.arrivals(spark, sf_dir), "arrival"), stateful.stream_blocks)
    return blocks.select("slot", "end_arrival", F.size("updates").cast("long").alias("updates"), F.get("updates", F.lit(0))["arrival"].alias("first_arrival"))


def stream_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 500 slots of the log, kept batch by batch."""
    out = f"{shared_folder(spark)}/slots"
    parts = _thirds(td.history(spark, sf_dir).select("log_offset", "slot"), "log_offset")
    _in_parts(spark, parts, lambda rows: rows.select("slot"), jobs.retention_batches(out, 500))
    return versions.read(spark, out, parts[0].select("slot").schema)


def stream_slot_tracker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the log is a status, and the finish of the shard that its offset falls on.

    No time to live here: it runs by the clock, and a run over what is there would wait for it. A lasting job sets it.
    """
    jobs.use_rocksdb(spark)
    history = history_rows(_stream(spark, sf_dir))
    events = history.select("slot", F.explode(F.array(F.lit("status"), F.lit("finish"))).alias("event"), "log_offset", "commitment", (F.col("log_offset") % 4).cast("int").alias("shard_idx"), "num_shards")
    return _finish(jobs.track_slots(events))


def stream_block_rate_sma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed ticks of each commitment with their moving average, empty ones included, while the log grows; ticks are hours here."""
    parts = _thirds(history_rows(spark.read.parquet(f"{sf_dir}/events.parquet")).withColumn("second", F.unix_timestamp("created_at")), "second")
    return _in_parts(spark, parts, lambda rows: stateful.average_rates(rows, "commitment", 3600, "0 seconds"))


def stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live counters of a session, summed over the batches of three runs; the test log spans years, so slots are kept that long."""
    jobs.use_rocksdb(spark)
    out = shared_folder(spark)
    columns = ["log_offset", "slot", "commitment", "CAST(created_at AS TIMESTAMP) AS created_at", "dead_error", "processed"]
    session = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(*td.HISTORY_COLUMNS, "event_type <> 'error' AS processed").selectExpr(*columns)

    def run(stream: DataFrame, i: int) -> None:
        job = f"{out}/{i}"
        work = counters.count_session(stream, "10000 days").select("log_offset", "slot")
        writer = work.writeStream.queryName(job).trigger(availableNow=True).option("checkpointLocation", f"{out}/checkpoint")
        with counters.CounterWriter(spark, job, f"{out}/counters"):
            writer.format("parquet").option("path", f"{out}/slots").start().awaitTermination()

    _runs(spark, f"{out}/log", _thirds(session, "log_offset"), run)
    return counters.totals(spark, f"{out}/counters").drop("polls", "full")


def _growing(spark: SparkSession, sf_dir: str, early: str) -> tuple[str, list[DataFrame]]:
    """An empty folder for the log, and the history cut in two: the rows that fit ``early``, and the others."""
    history = history_rows(spark.read.parquet(f"{sf_dir}/events.parquet"))
    return f"{shared_folder(spark)}/log", [history.where(early), history.where(f"NOT ({early})")]


def _runs(spark: SparkSession, log: str, parts: list[DataFrame], run: Callable[[DataFrame, int], None], files: int = 100) -> None:
    """Append a part to the log, start the job, let it stop, and the same again with the next part."""
    for i, part in enumerate(parts):
        part.write.mode("append").parquet(log)
        run(tables.stream_table(spark, log, part.schema, files), i)


def stream_commit_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries of a consumer that is stopped and started again, by commit mode."""
    middle = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("min(event_id) + (max(event_id) - min(event_id)) DIV 2").first()[0]
    log, parts = _growing(spark, sf_dir, f"log_offset <= {middle}")
    out = shared_folder(spark)
    _runs(spark, log, parts, lambda stream, i: [jobs.consume(stream, f"{out}/{mode}", mode, i) for mode in jobs.COMMIT_MODES])
    counts = [spark.read.parquet(f"{out}/{mode}/delivered").groupBy("log_offset").agg(F.count(F.lit(1)).alias("deliveries")).select(F.lit(mode).alias("mode"), "log_offset", "deliveries") for mode in jobs.COMMIT_MODES]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def stream_filter_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filter changes between two parts of the log: from the cut on, only confirmed or later statuses pass."""
    cut = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(td.HISTORY_COLUMNS[1]).selectExpr("max(slot) DIV 2").first()[0]
    log, parts = _growing(spark, sf_dir, f"slot < {cut}")
    out = shared_folder(spark)
    versions = [[("first", 0, None, 0)], [("first", 0, cut, 0), ("second", cut, None, 1)]]

    def run(stream: DataFrame, i: int) -> None:
        spark.createDataFrame(versions[i], "version string, effective_from bigint, effective_to bigint, minimum int").write.mode("overwrite").parquet(f"{out}/versions")
        job = stream.drop("created_at").writeStream.trigger(availableNow=True).option("checkpointLocation", f"{out}/checkpoint")
        job.foreachBatch(jobs.filter_batches(f"{out}/versions", f"{out}/tagged")).start().awaitTermination()

    _runs(spark, log, parts, run)
    return spark.read.parquet(f"{out}/tagged").select("log_offset", "slot", "version")


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by hour where the earlier half of the log comes last: it is behind the watermark and is dropped."""
    ends = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("CAST(ts AS TIMESTAMP) AS t").selectExpr("unix_timestamp(min(t))", "unix_timestamp(max(t))").first()
    middle = (ends[0] + ends[1]) // 2 // 3600 * 3600
    log, parts = _growing(spark, sf_dir, f"unix_timestamp(created_at) >= {middle}")
    out = shared_folder(spark)

    def run(stream: DataFrame, i: int) -> None:
        job = jobs.block_rates(stream, "1 hour", "0 seconds").writeStream.outputMode("update").trigger(availableNow=True).option("checkpointLocation", f"{out}/checkpoint")
        job.foreachBatch(sinks.idempotent_parquet(f"{out}/rates")).start().awaitTermination()

    _runs(spark, log, parts, run)
    return spark.read.parquet(f"{out}/rates").groupBy("tick").agg(F.max_by("blocks", "batch_id").alias("blocks"))


def multicast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One read of the stream for two consumers: all rows, and dead slots."""
    out = shared_folder(spark)
    dead = lambda batch, i: sinks.idempotent_parquet(f"{out}/dead")(batch.where("dead_error IS NOT NULL"), i)
    _finish(history_rows(_stream(spark, sf_dir)), each=sinks.fan_out([sinks.idempotent_parquet(f"{out}/all"), dead]))
    counts = [spark.read.parquet(f"{out}/{name}").groupBy().agg(F.count(F.lit(1)).alias("events")).select(F.lit(name).alias("consumer"), "events") for name in ("all", "dead")]
    return counts[0].unionByName(counts[1])


QUERIES = {f.__name__: f for f in (history_stream, stream_dedup_status, stream_block_rate, stream_commit, stream_commit_late, stream_late_after_finish, stream_slot_sequential, stream_blocks, stream_retention, stream_slot_tracker, stream_block_rate_sma, stream_counters, stream_commit_modes, stream_filter_change, stream_late_rows, multicast)}
SQL = {
    "history_stream": "SELECT log_offset, slot, commitment, dead_error, num_shards FROM history",
    "stream_dedup_status": "SELECT DISTINCT slot, commitment FROM history",
    "stream_block_rate": "SELECT CAST(floor(epoch(created_at) / 3600) AS BIGINT) * 3600 AS tick, count(*) AS blocks FROM history GROUP BY 1",
    "stream_commit": "SELECT consumer, committable FROM committable WHERE committable IS NOT NULL",
    "stream_commit_late": "SELECT consumer, max(log_offset) AS committable FROM (SELECT s.*, min(log_offset) FILTER (NOT done) OVER (PARTITION BY consumer) AS gap FROM (SELECT *, processed OR log_offset % 3 = 0 AS done FROM session) s) WHERE gap IS NULL OR log_offset < gap GROUP BY consumer",
    "stream_late_after_finish": "SELECT slot, CAST(shard_idx AS INTEGER) AS shard_idx, kind, arrival FROM updates JOIN finish USING (slot, shard_idx) WHERE arrival > finish_arrival",
    "stream_slot_sequential": """SELECT a.arrival, a.slot, a.event, a.kind, greatest(a.arrival, coalesce(s.open, a.arrival)) AS emit, s.first_seen
  FROM ended_arrivals a JOIN (
    SELECT slot, first_seen, row_number() OVER (ORDER BY first_seen) AS n, CASE WHEN bool_and("end" IS NOT NULL) OVER w THEN max("end") OVER w END AS open
    FROM (SELECT slot, min(arrival) AS first_seen, min(arrival) FILTER (event = 'ended') AS "end" FROM ended_arrivals WHERE event = 'ended' OR kind NOT IN ('slot_status', 'block_meta') GROUP BY slot)
    WINDOW w AS (ORDER BY first_seen ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) s USING (slot)
  WHERE (a.event = 'ended' OR a.kind NOT IN ('slot_status', 'block_meta')) AND (s.n = 1 OR s.open IS NOT NULL)
  UNION ALL SELECT arrival, slot, event, kind, arrival, 0 FROM ended_arrivals WHERE event = 'data' AND kind IN ('slot_status', 'block_meta')""",
    "stream_blocks": "SELECT e.slot, e.arrival AS end_arrival, count(d.arrival) AS updates, min(d.arrival) AS first_arrival FROM arrivals e LEFT JOIN arrivals d ON d.slot = e.slot AND d.event = 'data' AND d.kind <> 'slot_status' WHERE e.event = 'ended' GROUP BY e.slot, e.arrival",
    "stream_retention": "SELECT slot FROM history GROUP BY slot ORDER BY slot DESC LIMIT 500",
    "stream_slot_tracker": "SELECT slot, commitment, min(log_offset) AS log_offset FROM history WHERE slot IN (SELECT slot FROM history GROUP BY slot HAVING count(DISTINCT log_offset % 4) = 4) GROUP BY slot, commitment",
    "stream_block_rate_sma": """SELECT * FROM (WITH t AS (SELECT commitment, CAST(floor(epoch(created_at) / 3600) AS BIGINT) * 3600 AS tick FROM history),
    s AS (SELECT commitment, unnest(range(min(tick), (SELECT max(tick) FROM t), 3600)) AS tick FROM t GROUP BY commitment),
    r AS (SELECT commitment, tick, coalesce(n, 0) AS blocks FROM s LEFT JOIN (SELECT commitment, tick, count(*) AS n FROM t GROUP BY ALL) c USING (commitment, tick))
  SELECT commitment, tick, blocks, sum(blocks) OVER (PARTITION BY commitment ORDER BY tick ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) / 5 AS average FROM r)""",
    "stream_counters": "SELECT * FROM (SELECT count(*) AS events, count(*) FILTER (processed) AS processed, count(*) FILTER (NOT processed) AS skipped FROM session), (SELECT count(DISTINCT slot) AS slots, count(*) FILTER (commitment = 0) AS processed_statuses, count(*) FILTER (commitment = 1) AS confirmed_statuses, count(*) FILTER (commitment = 2) AS finalized_statuses FROM history)",
    "stream_commit_modes": "SELECT m.mode, log_offset, CASE WHEN log_offset <= middle AND m.mode = 'none' OR log_offset = middle AND m.mode = 'manual' THEN 2 ELSE 1 END AS deliveries FROM history, (SELECT min(log_offset) + (max(log_offset) - min(log_offset)) // 2 AS middle FROM history), (VALUES ('auto'), ('manual'), ('none')) m(mode)",
    "stream_filter_change": "SELECT log_offset, slot, CASE WHEN slot < cut THEN 'first' ELSE 'second' END AS version FROM history, (SELECT max(slot) // 2 AS cut FROM history) WHERE slot < cut OR commitment >= 1",
    "stream_late_rows": "SELECT CAST(floor(epoch(created_at) / 3600) AS BIGINT) * 3600 AS tick, count(*) AS blocks FROM history WHERE epoch(created_at) >= (SELECT (CAST(floor(epoch(min(created_at))) AS BIGINT) + CAST(floor(epoch(max(created_at))) AS BIGINT)) // 2 // 3600 * 3600 FROM history) GROUP BY 1",
    "multicast": "SELECT 'all' AS consumer, count(*) AS events FROM history UNION ALL SELECT 'dead', count(*) FROM history WHERE dead_error IS NOT NULL",
}
