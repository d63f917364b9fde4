"""Stateful streams against plain Python and the batch functions, in batches of any cut, and the size of their state."""

import datetime
import os
import random
import tempfile
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from slotstream.operators import adapters, completion, progress, stats
from slotstream.sources import sinks, tables, versions
from slotstream.streaming import counters, jobs, stateful

ARRIVALS = "arrival bigint, slot bigint, event string, kind string"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


class Log:
    """A log in a folder, one file for each batch; the job takes one at a time, and goes on where it stopped."""

    def __init__(self, spark, schema):
        self.spark, self.schema, self.path = spark, schema, tempfile.mkdtemp(prefix="spark-")
        self.start = time.time()
        jobs.use_rocksdb(spark)
        spark.conf.set("spark.sql.shuffle.partitions", 1)  # a state store for each

    def run(self, job, batches, each=None):
        os.makedirs(f"{self.path}/log", exist_ok=True)
        for rows in batches:
            n = len(os.listdir(f"{self.path}/log"))
            self.spark.createDataFrame(rows, self.schema).coalesce(1).write.parquet(f"{self.path}/{n}")
            (part,) = (x for x in os.listdir(f"{self.path}/{n}") if x.endswith(".parquet"))
            os.rename(f"{self.path}/{n}/{part}", f"{self.path}/log/{n:04}.parquet")
            os.utime(f"{self.path}/log/{n:04}.parquet", (self.start + n, self.start + n))
        made = job(tables.stream_table(self.spark, f"{self.path}/log", self.spark.createDataFrame([], self.schema).schema, 1))
        writer = made.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{self.path}/checkpoint")
        query = (writer.foreachBatch(each) if each else writer.format("parquet").option("path", f"{self.path}/out")).start()
        assert query.awaitTermination(120)
        self.progress = query.recentProgress
        return self.spark.read.schema(made.schema).parquet(f"{self.path}/out") if each is None else None

    def state_rows(self):
        return self.progress[-1]["stateOperators"][0]["numRowsTotal"]


def heap(batches):
    """Longest processed prefix per group after each batch, as a client with a heap of acknowledgements has it."""
    seen, done, out = {}, {}, []
    for rows in batches:
        for group, offset, ok in rows:
            seen.setdefault(group, set()).add(offset)
            if ok:
                done.setdefault(group, set()).add(offset)
        for group, offsets in seen.items():
            prefix = None
            for o in sorted(offsets):
                if o not in done.get(group, ()):
                    break
                prefix = o
            out.append((group, prefix))
    return {(g, p) for g, p in out if p is not None}


SESSION = "consumer bigint, log_offset bigint, processed boolean"


def test_gaps_that_are_filled_later(spark):
    batches = [[(7, 1, True), (7, 2, False), (7, 3, True)], [(7, 2, True), (7, 4, True)], [(7, 5, None), (7, 6, False), (7, 7, True)], [(7, 6, True)], [(7, 5, True), (7, 5, False)]]
    got = Log(spark, SESSION).run(stateful.track_commits, batches)
    assert sorted(map(tuple, got.collect())) == [(7, 1), (7, 4), (7, 7)]


def test_commits_agree_with_a_heap(spark):
    rng, offset, batches, open_ = random.Random(1), 0, [], []
    for _ in range(5):
        rows = []
        for _ in range(40):
            group, ok = rng.randrange(3), rng.random() < 0.5
            rows.append((group, offset, ok))
            open_ += [] if ok else [(group, offset)]
            offset += rng.randrange(1, 4)
        rng.shuffle(open_)
        late, open_ = open_[: len(open_) * 2 // 3], open_[len(open_) * 2 // 3 :]
        batches.append(rows)
        batches.append([(g, o, True) for g, o in late])
    log = Log(spark, SESSION)
    got = log.run(stateful.track_commits, batches)
    wanted = heap(batches)
    assert {tuple(r) for r in got.collect()} == wanted and len(wanted) > 8
    assert log.state_rows() <= 3 + len(open_)  # a row for each group and each gap
    every = spark.createDataFrame([r for b in batches for r in b], SESSION)
    last = {g: max(p for h, p in wanted if h == g) for g, _ in wanted}
    assert {r.consumer: r.committable for r in progress.committable_offsets(progress.settled(every)).collect()} == last


EVENTS = "slot bigint, shard_idx int, event string, kind string, arrival bigint, created_at timestamp"


def test_late_rows_and_their_state(spark):
    import datetime

    at = lambda s: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s)
    batches = [
        [(1, 0, "data", "entry", 1, at(0)), (1, 0, "finish", None, 2, at(1)), (1, 0, "data", "entry", 3, at(1)), (1, 1, "data", "entry", 4, at(2))],
        [(1, 0, "data", "entry", 5, at(3)), (1, 1, "data", "entry", 6, at(3)), (1, 1, "finish", None, 7, at(4)), (300, 0, "finish", None, 1, at(4))],
        [(1, 1, "data", "entry", 8, at(5)), (9, 1, "data", None, 1, at(5))],
        [(2, 0, "data", "entry", 1, at(1000))],
    ]
    log = Log(spark, EVENTS)
    job = lambda rows: stateful.mark_late(rows, delay="10 seconds", keep_ms=20_000)
    got = log.run(job, batches[:3])
    assert log.state_rows() > 0
    assert {(r.slot, r.shard_idx, r.arrival): r.late for r in got.collect()} == {(1, 0, 1): False, (1, 0, 3): True, (1, 1, 4): False, (1, 0, 5): True, (1, 1, 6): False, (1, 1, 8): True, (9, 1, 1): False}
    log.run(job, batches[3:])
    log.run(job, [[(1, 0, "data", "entry", 9, at(6))]])  # older than the watermark: dropped, though its finish is forgotten
    assert log.state_rows() == 0
    assert (1, 0, 9) not in {(r.slot, r.shard_idx, r.arrival) for r in spark.read.parquet(f"{log.path}/out").collect()}


def test_slot_tracker_takes_ranges_of_slots(spark):
    """Slots of one range and of several, in batches of any cut, as each slot would be tracked alone; state is by range."""
    rng, offset, rows = random.Random(8), 0, []
    for slot in [*range(40), 700, 701]:
        for _ in range(rng.randrange(1, 9)):
            rows.append((slot, "status", rng.randrange(3), None, None) if rng.random() < 0.6 else (slot, "finish", None, rng.randrange(9), 2 + slot % 2))
    rng.shuffle(rows)
    rows = [(slot, event, i, *rest) for i, (slot, event, *rest) in enumerate(rows)]
    batches = [rows[:50], rows[50:51], rows[51:120], [*rows[120:], (None, "status", 10**6, 0, None, None)]]
    log = Log(spark, "slot bigint, event string, log_offset bigint, commitment int, shard_idx int, num_shards int")
    got = log.run(lambda r: jobs.track_slots(r, minimum=1), batches)
    wanted, shards, sent, waiting = [], {}, set(), {}
    for slot, event, offset, commitment, shard, n in rows:
        if event == "finish":
            shards.setdefault(slot, set()).add(shard % n)
        elif (slot, commitment) not in sent:
            waiting.setdefault((slot, commitment), offset)
        for s, c in [k for k in waiting if k[0] == slot and (k[1] < 1 or len(shards.get(slot, ())) == 2 + slot % 2)]:
            sent.add((s, c))
            wanted.append((s, c, waiting.pop((s, c))))
    assert sorted(map(tuple, got.collect())) == sorted(wanted) and len(wanted) > 20
    assert log.state_rows() == 2  # slots 0 to 255, and 700 with 701


def test_finishes_of_a_range_are_one_value(spark):
    rows = [(s, 0, e, "entry" if e == "data" else None, a, datetime.datetime(2024, 1, 1)) for s in range(100) for e, a in (("finish", 2), ("data", 1 + s % 4))]
    log = Log(spark, EVENTS)
    got = log.run(lambda r: stateful.mark_late(r, keep_ms=10**9), [rows[:101], rows[101:]])
    assert {r.slot: r.late for r in got.collect()} == {s: 1 + s % 4 > 2 for s in range(100)}
    assert log.progress[-1]["stateOperators"][0]["customMetrics"]["numValueStateVars"] == 1


def trace(text):
    """Arrivals of a golden trace: d data, s status, m block metadata, e the end of a slot."""
    kinds = {"d": ("data", "entry"), "s": ("data", "slot_status"), "m": ("data", "block_meta"), "e": ("ended", None)}
    return [(i, int(x[1:]), *kinds[x[0]]) for i, x in enumerate(text.split(), 1)]


def letters(rows):
    name = {"entry": "d", "slot_status": "s", "block_meta": "m", None: "e"}
    return " ".join(f"{name[r.kind]}{r.slot}" for r in sorted(rows, key=lambda r: (r.emit, r.first_seen, r.arrival)))


# fixed values: traces and their order
TRACES = [("d2 d1 d2 e2 d1 e1", "d2 d2 e2 d1 d1 e1"), ("d2 d1 e1 e2", "d2 e2 d1 e1"), ("d2 d1 s99 m100 e2 e1", "d2 s99 m100 e2 d1 e1")]


@pytest.mark.parametrize(("arrivals", "order"), TRACES)
def test_slot_order_row_by_row(spark, arrivals, order):
    rows = trace(arrivals)
    got = Log(spark, ARRIVALS + ", lane int").run(lambda r: stateful.order_slots(r, "lane"), [[(*r, 0)] for r in rows]).collect()
    assert letters(got) == order
    batch = adapters.slot_sequential(spark.createDataFrame(rows, ARRIVALS)).collect()
    assert sorted(map(str, (r.asDict() for r in got))) == sorted(map(str, ({k: r[k] for k in got[0].asDict()} for r in batch)))


def random_arrivals(seed, slots=12, n=150):
    rng, rows, open_ = random.Random(seed), [], list(range(slots))
    while len(rows) < n and open_:
        slot = rng.choice(open_[:4])
        if rng.random() < 0.08:
            open_.remove(slot)
            rows.append((slot, "ended", None))
        else:
            rows.append((slot, "data", rng.choice(["entry", "account", "slot_status", "block_meta"])) )
    return [(i, *r) for i, r in enumerate(rows, 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_slot_order_and_blocks_of_random_logs(spark, seed):
    rng, rows = random.Random(seed), random_arrivals(seed)
    cuts = sorted(rng.sample(range(len(rows)), 4))
    batches = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
    table = spark.createDataFrame(rows, ARRIVALS)
    got = Log(spark, ARRIVALS + ", lane int").run(lambda r: stateful.order_slots(r, "lane"), [[(*r, 0) for r in b] for b in batches])
    columns = ["arrival", "slot", "event", "kind", "emit", "first_seen"]
    ended = {r[1] for r in rows if r[2] == "ended"}
    batch = adapters.slot_sequential(table).where("emit IS NOT NULL").select(columns).collect()
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, batch))
    log, blocks = Log(spark, ARRIVALS), []
    log.run(stateful.stream_blocks, batches, each=sinks.on_block(lambda b: blocks.extend(b.collect())))
    wanted = adapters.block_stream(table).collect()
    key = lambda r: (r.slot, r.end_arrival, [(u.arrival, u.kind) for u in r.updates])
    assert sorted(map(key, blocks)) == sorted(map(key, wanted)) and {r.slot for r in blocks} == ended
    waiting = {r[1] for r in rows if r[2] == "data" and r[3] != "slot_status"} - ended
    assert log.state_rows() == len(waiting)  # a list for each slot that has not ended


def test_blocks_that_never_end_leave(spark):
    import datetime

    at = lambda s: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s)
    log = Log(spark, ARRIVALS + ", created_at timestamp")
    job = lambda r: stateful.stream_blocks(r, "created_at", "5 seconds", 10_000)
    log.run(job, [[(1, 1, "data", "entry", at(0)), (2, 2, "data", "entry", at(1))], [(3, 2, "ended", None, at(2)), (4, 4, "ended", None, at(2))]])
    assert log.state_rows() > 0
    got = log.run(job, [[(5, 3, "data", "slot_status", at(1000))], [(6, 3, "data", "slot_status", at(1001))]])
    assert log.state_rows() == 0
    assert sorted((r.slot, r.end_arrival, len(r.updates)) for r in got.collect()) == [(2, 3, 1), (4, 4, 0)]


def test_rows_of_a_lane_wait_by_ranges_of_slots(spark):
    """A lane's key has its queue alone; rows behind a slot that has not ended are under other keys, and come back when it ends."""
    rows = [(1, 0, "data", "entry", 0), *[(2 + i, 100 * i + 100, "data", "entry", 0) for i in range(8)], *[(10 + i, 100 * i + 100, "ended", None, 0) for i in range(8)]]
    log = Log(spark, ARRIVALS + ", lane int")
    job = lambda r: stateful.order_slots(r, "lane", width=100)
    log.run(job, [rows[:5], rows[5:]])
    states = sorted(x["numRowsTotal"] for x in log.progress[-1]["stateOperators"])
    assert len(states) == 2 and states[1] >= 8  # a list for each range
    got = log.run(job, [[(18, 0, "ended", None, 0)]]).collect()
    batch = adapters.slot_sequential(spark.createDataFrame([r[:4] for r in [*rows, (18, 0, "ended", None)]], ARRIVALS)).collect()
    columns = ["arrival", "slot", "event", "kind", "emit", "first_seen"]
    assert sorted(str([r[c] for c in columns]) for r in got) == sorted(str([r[c] for c in columns]) for r in batch) and len(got) == 18


def test_blocks_of_ranges_of_slots(spark):
    """Slots under one key: parts of blocks come in several batches, large blocks in several results, and each slot leaves by itself."""
    rows = [(i, i % 3, "data", "entry") for i in range(24_000)]
    batches = [rows[:5], [*rows[5:], (30_000, 1, "ended", None)], [(30_001, 2, "ended", None)]]
    log = Log(spark, ARRIVALS)
    got = log.run(lambda r: stateful.stream_blocks(r, width=1000), batches).collect()
    assert {r.slot: (r.end_arrival, [u.arrival for u in r.updates]) for r in got} == {s: (29_999 + s, list(range(s, 24_000, 3))) for s in (1, 2)}
    assert log.state_rows() == 1  # slot 0


def test_retention_by_number_of_slots(spark):
    rng = random.Random(2)
    batches = [[(rng.randrange(200),) for _ in range(60)] for _ in range(4)] + [[(None,)]]
    log = Log(spark, "slot bigint")
    write = jobs.retention_batches(f"{log.path}/slots", 25)
    log.run(lambda r: r, batches, each=write)
    schema = StructType().add("slot", LongType())
    every = spark.createDataFrame([r for b in batches for r in b if r[0] is not None], "slot bigint")
    wanted = sorted(r.slot for r in completion.retained_slots(every, 25).collect())
    assert sorted(r.slot for r in versions.read(spark, f"{log.path}/slots", schema).collect()) == wanted and len(wanted) == 25
    before = versions.versions(spark, f"{log.path}/slots")
    write(spark.createDataFrame(batches[0], "slot bigint"), before[-1])  # a repeated batch starts from the version before
    assert versions.versions(spark, f"{log.path}/slots") == before and len(before) == 2


def test_versions(spark):
    path, schema = tempfile.mkdtemp(prefix="spark-") + "/t", spark.createDataFrame([(1,)], "x bigint").schema
    read = lambda: sorted(r.x for r in versions.read(spark, path, schema).collect())
    assert read() == []
    versions.write(spark.createDataFrame([(1,), (2,)], schema), path)
    held = versions.read(spark, path, schema)
    fails = spark.createDataFrame([(3,)], schema).select(F.raise_error(F.lit("stop")).cast("bigint").alias("x"))
    with pytest.raises(Exception, match="stop"):
        versions.write(fails, path)
    assert read() == [1, 2]  # a failed write leaves the version before in force
    with pytest.raises(Exception, match="(?i)exist"):
        versions.write(spark.createDataFrame([(4,)], schema), path)  # another writer has begun this version
    versions.write(spark.createDataFrame([(5,)], schema), path, version=2)
    assert read() == [5] and sorted(r.x for r in held.collect()) == [1, 2]
    versions.write(spark.createDataFrame([(6,)], schema), path)
    assert read() == [6] and versions.versions(spark, path) == [2, 3]


def test_slot_ranges_are_pruned(spark):
    """A file that is no Parquet lies in a range that the work-list does not name."""
    path = tempfile.mkdtemp(prefix="spark-") + "/payload"
    updates = spark.range(1000).selectExpr("id AS slot", "id % 7 AS idx")
    tables.write_slot_ranges(updates, path, 100)
    with open(f"{path}/slot_range=9/part-broken.parquet", "w") as broken:
        broken.write("no table")
    spark.createDataFrame([(5, 1), (120, 2), (121, 2), (950, 0)], "slot bigint, commitment int").write.parquet(f"{path}-history")
    history = spark.read.parquet(f"{path}-history")
    got = tables.load_slot_ranges(spark, path, updates.schema, history.where("commitment >= 1"), 100)
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect())) == [(5, 5), (120, 1), (121, 2)]
    with pytest.raises(Exception, match="(?i)part-broken"):
        tables.load_slot_ranges(spark, path, updates.schema, history, 100).collect()


def test_manual_consumer_without_earlier_commits(spark):
    """A first run that finds no rows commits nothing; the next one starts at the beginning."""
    path = tempfile.mkdtemp(prefix="spark-")
    schema = "log_offset bigint, slot bigint"
    for i, rows in enumerate([[], [(1, 1), (2, 1)], [(3, 2)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/log")
        jobs.consume(tables.stream_table(spark, f"{path}/log", spark.createDataFrame([], schema).schema), f"{path}/c", "manual", i)
    got = spark.read.parquet(f"{path}/c/delivered").groupBy("log_offset").count().collect()
    assert {r.log_offset: r["count"] for r in got} == {1: 1, 2: 2, 3: 1}


def test_average_rates(spark):
    """Each key ticks on, with zeros, as far as the watermark goes; runs that stop and start again change nothing."""
    rng = random.Random(4)
    at = lambda second: datetime.datetime.fromtimestamp(second, datetime.UTC).replace(tzinfo=None)
    seconds = sorted(rng.choice((rng.randrange(1000, 1060), rng.randrange(1100, 1200))) for _ in range(90))
    rows = [(rng.choice("ab") if s < 1100 else "a", at(s + 0.5)) for s in seconds] + [(None, at(1150.2)), ("a", at(1210.0))]
    rows.sort(key=lambda r: r[1])
    batches = [rows[:20], rows[20:21], rows[21:70], rows[70:], [("b", None), ("b", at(1001.0))]]  # the last one: no time, behind the watermark
    log = Log(spark, "k string, created_at timestamp")
    job = lambda r: stateful.average_rates(r, "k", 1, "0 seconds")
    log.run(job, batches[:2])
    got = log.run(job, batches[2:]).collect()
    times = {k: [r[1].replace(tzinfo=datetime.UTC).timestamp() for r in rows if r[0] == k] for k in ("a", "b", None)}
    wanted = []
    for k, ts in times.items():
        n = [sum(int(t) == s for t in ts) for s in range(int(min(ts)), 1210)]
        wanted += [(k, int(min(ts)) + i, c, sum(n[max(0, i - 4) : i + 1]) / 5) for i, c in enumerate(n)]
    key = lambda r: (str(r[0]), r[1])
    assert sorted(map(tuple, got), key=key) == sorted(wanted, key=key)
    batch = stats.block_rate_average(stats.block_rate(spark.createDataFrame([r for r in rows if r[0] == "a"], log.schema)), 5, 1)
    assert sorted(map(tuple, batch.select("tick", "blocks", "average").where("tick < 1210").collect())) == sorted(w[1:] for w in wanted if w[0] == "a")


def test_long_silence_comes_in_slices(spark):
    """Ticks without blocks are not made all at once."""
    rows = [("a", datetime.datetime(2024, 1, 1)), ("a", datetime.datetime(2024, 1, 8))]
    got = Log(spark, "k string, created_at timestamp").run(lambda r: stateful.average_rates(r, "k", 1, "0 seconds"), [rows])
    assert got.agg(F.count("tick"), F.countDistinct("tick"), F.sum("blocks"), F.sum("average")).first() == (7 * 86400, 7 * 86400, 1, 1.0)


def test_live_counters(spark):
    """Every batch writes its counters: sums equal those of the rows; a batch with as many files as allowed is full."""
    start = datetime.datetime(2024, 1, 1)
    rng = random.Random(6)
    rows = [(i, rng.choice((None, *range(30))), rng.choice((0, 1, 2, None)), rng.choice((True, False, None)), start + datetime.timedelta(seconds=i)) for i in range(200)]
    path, schema = tempfile.mkdtemp(prefix="spark-"), "log_offset bigint, slot bigint, commitment int, processed boolean, created_at timestamp"
    jobs.use_rocksdb(spark)
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    batch = spark.createDataFrame(rows, schema)
    for i in range(3):
        batch.where(f"log_offset % 3 = {i}").coalesce(1).write.mode("append").parquet(f"{path}/log")
    for i in range(2):  # the second run finds nothing new
        stream = tables.stream_table(spark, f"{path}/log", batch.schema, 2).select("*", F.col("_metadata.file_path").alias("file"))
        with counters.CounterWriter(spark, f"live-{i}", f"{path}/counters", limit=2):
            work = counters.count_session(stream, "1 day", "file")
            work.writeStream.queryName(f"live-{i}").trigger(availableNow=True).option("checkpointLocation", f"{path}/c").format("noop").start().awaitTermination()
    got = counters.totals(spark, f"{path}/counters").first().asDict()
    assert (got.pop("polls"), got.pop("full")) == (2, 1)
    wanted = stats.session_counters(batch, batch).first().asDict()
    assert got == wanted


def test_a_counter_that_cannot_be_written_is_an_error(spark):
    path = tempfile.mkdtemp(prefix="spark-")
    spark.createDataFrame([(1, 1, 0, True, datetime.datetime(2024, 1, 1))], "log_offset bigint, slot bigint, commitment int, processed boolean, created_at timestamp").write.parquet(f"{path}/log")
    open(f"{path}/counters", "w").close()
    stream = tables.stream_table(spark, f"{path}/log", spark.read.parquet(f"{path}/log").schema)
    with pytest.raises(Exception, match="counters"), counters.CounterWriter(spark, "broken", f"{path}/counters"):
        work = counters.count_session(stream)
        work.writeStream.queryName("broken").trigger(availableNow=True).option("checkpointLocation", f"{path}/c").format("noop").start().awaitTermination()
