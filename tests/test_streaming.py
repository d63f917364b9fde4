"""Streaming jobs against the batch functions, over the same rows."""

import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

from slotstream.operators import adapters, dedup, progress, stats
from slotstream.plans import queries
from slotstream.sources import sinks, tables
from slotstream.sources import testdata as td
from slotstream.streaming import jobs, stateful
from tests.compare import SF, same


@pytest.fixture(scope="module")
def log(spark):
    """The history in several files, and as a stream that takes one file at a time."""
    path = tempfile.mkdtemp(prefix="spark-") + "/log"
    history = td.history(spark, SF).withColumn("created_at", F.col("created_at").cast("timestamp"))
    history.orderBy("log_offset").coalesce(1).write.option("maxRecordsPerFile", 400).parquet(path)
    batch = spark.read.parquet(path)
    return batch, lambda: tables.stream_table(spark, path, batch.schema, 1)


def run(stream, **options):
    out = tempfile.mkdtemp(prefix="spark-")
    writer = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{out}/checkpoint")
    for k, v in options.items():
        writer = getattr(writer, k)(v)
    if "foreachBatch" not in options:
        writer = writer.format("parquet").option("path", f"{out}/data")
    writer.start().awaitTermination(120)
    return f"{out}/data"


def test_dedup_statuses(spark, log):
    batch, stream = log
    got = spark.read.parquet(run(jobs.dedup_statuses(stream(), "10000 days")))
    assert sorted((r.slot, r.commitment) for r in got.collect()) == sorted((r.slot, r.commitment) for r in dedup.first_statuses(batch).collect())


def test_block_rates(spark, log):
    batch, stream = log
    got = {r.tick: r.blocks for r in spark.read.parquet(run(jobs.block_rates(stream(), "1 hour", "0 seconds"))).collect()}
    wanted = {r.tick: r.blocks for r in stats.block_rate(batch, seconds=3600).collect() if r.blocks}
    assert got and all(wanted[t] == n for t, n in got.items() if t != max(wanted))


def test_slot_tracker(spark):
    jobs.use_rocksdb(spark)
    schema = "slot bigint, event string, log_offset bigint, commitment int, shard_idx int, num_shards int"
    batches = [
        [(1, "status", 1, 0, None, None), (2, "status", 2, 0, None, None), (1, "finish", 3, None, 0, 2)],
        [(1, "finish", 4, None, 3, 2), (1, "status", 5, 0, None, None), (1, "status", 6, 1, None, None), (3, "status", 7, 0, None, None)],
        [(3, "finish", 8, None, 0, 1), (2, "finish", 9, None, 0, 2)],
    ]
    path = tempfile.mkdtemp(prefix="spark-")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/part={i}")
    import os
    import time

    files = [f"{path}/part={i}/{n}" for i in range(3) for n in os.listdir(f"{path}/part={i}") if n.endswith("parquet")]
    flat = tempfile.mkdtemp(prefix="spark-")
    for i, f in enumerate(files):
        os.rename(f, f"{flat}/{i}.parquet")
        os.utime(f"{flat}/{i}.parquet", (time.time() + i, time.time() + i))
    stream = tables.stream_table(spark, flat, spark.read.parquet(f"{flat}/0.parquet").schema, 1)
    got = spark.read.parquet(run(jobs.track_slots(stream)))
    assert sorted(map(tuple, got.collect())) == [(1, 0, 1), (1, 1, 6), (3, 0, 7)]


def test_commits(spark):
    session = td.session(spark, SF)
    path = tempfile.mkdtemp(prefix="spark-")
    session.orderBy("log_offset").coalesce(1).write.option("maxRecordsPerFile", 400).parquet(f"{path}/in")
    jobs.use_rocksdb(spark)
    commits = run(stateful.track_commits(tables.stream_table(spark, f"{path}/in", session.schema, 1)))
    got = spark.read.parquet(commits).groupBy("consumer").agg(F.max("committable").alias("c"))
    wanted = progress.committable_offsets(session).where("committable IS NOT NULL")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.select("consumer", "committable").collect()))


def test_fan_out_and_callback(spark):
    """Each block is handed over once, whole, though its rows come in several batches."""
    arrivals = td.arrivals(spark, SF)
    path, seen = tempfile.mkdtemp(prefix="spark-"), []
    arrivals.orderBy("arrival").coalesce(1).write.option("maxRecordsPerFile", 300).parquet(f"{path}/in")
    collect = sinks.on_block(lambda blocks: seen.extend((r.slot, r.end_arrival, [(u.arrival, u.kind) for u in r.updates]) for r in blocks.collect()))
    jobs.use_rocksdb(spark)
    blocks = stateful.stream_blocks(tables.stream_table(spark, f"{path}/in", arrivals.schema, 4))
    run(blocks, foreachBatch=sinks.fan_out([sinks.idempotent_parquet(f"{path}/a"), collect]))
    assert spark.read.parquet(f"{path}/a").count() == len(seen)
    wanted = [(r.slot, r.end_arrival, [(u.arrival, u.kind) for u in r.updates]) for r in adapters.block_stream(arrivals).collect()]
    assert len(seen) > 10 and sorted(seen) == sorted(wanted)


def test_text_sinks(spark):
    path = tempfile.mkdtemp(prefix="spark-")
    sinks.write_lines(spark.createDataFrame([(1, "x")], "slot int, value string"), f"{path}/lines")
    sinks.write_signatures(spark.createDataFrame([(1, "s")], "slot int, signature string"), f"{path}/sigs")
    assert [r.value for r in spark.read.text(f"{path}/lines").collect() + spark.read.text(f"{path}/sigs").collect()] == ["x", "1,s"]


@pytest.mark.parametrize("files", [1, 120])
def test_slot_order_of_a_whole_log(spark, files):
    """Rows behind slot 1040 come out too, also where a part of the log has more files than a batch usually takes."""
    path = tempfile.mkdtemp(prefix="spark-")
    rows = [(9000 + 7 * i, (140 + 37 * i) % 150, "purchase" if i % 5 == 1 else "error" if i % 5 == 2 else "view", i % files) for i in range(400)]
    events = spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string, file int").selectExpr("*", "TIMESTAMP'2024-01-01' AS ts", "2.0D AS value")
    events.repartitionByRange(files, "file").drop("file").write.parquet(f"{path}/events.parquet")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, "4k" if files > 1 else before[k])
        got = queries.QUERIES["stream_slot_sequential"](spark, path)
        con = duckdb.connect()
        con.execute(f"CREATE VIEW events AS SELECT * FROM '{path}/events.parquet/*.parquet'")
        same(got, con, queries.ORACLE_SQL["stream_slot_sequential"])
        slots = {(150 * (r[0] // 1500)) + r[1] for r in rows}
        assert 1040 in slots and got.count() == len(rows) + len(slots)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
