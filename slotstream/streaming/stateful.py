"""Stateful stream operators: commit progress, late rows, slot order, blocks, rates.

State lives with its key (group, shard, lane or slot) in the state store; a batch reads and writes the keys it has rows
of, and nothing else. Event-time timers remove what no longer changes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, IntegralType, LongType, StructField, StructType

from slotstream.operators.adapters import PASS_THROUGH


def _frame(schema: StructType, columns: dict[str, object]) -> pd.DataFrame:
    """A result with the integer types of ``schema``; nulls are left out of the casts."""
    out = pd.DataFrame(columns)
    kinds = {LongType: "Int64", IntegerType: "Int32"}
    return out.astype({f.name: kinds[type(f.dataType)] for f in schema.fields if type(f.dataType) in kinds})


# ---------------------------------------------------------------- commit progress
class CommitTracker(StatefulProcessor):
    """Progress of one group: how far all is processed, and behind that the gaps, each with the stretch that follows it.

    A stretch of processed events between two gaps is kept as its last offset alone. When a gap is processed, its
    stretch joins the one before; when the first gap is, progress moves to the end of its stretch. State has a row for
    each event that is not acknowledged yet, whatever lies between.
    """

    def __init__(self, schema: StructType):
        self.schema = schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ends = handle.getValueState("ends", "frontier bigint, seen bigint")
        self.gaps = handle.getListState("gaps", "gap bigint, last bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat([r[["log_offset", "processed"]] for r in rows])
        offsets = batch["log_offset"].to_numpy(np.int64)
        done = np.unique(offsets[batch["processed"].fillna(False).to_numpy(bool)])
        before, seen = self.ends.get() if self.ends.exists() else (None, None)
        known = list(self.gaps.get())
        fresh = np.unique(offsets if seen is None else offsets[offsets > seen])
        gaps = np.array([g for g, _ in known], np.int64)
        ends = np.array([e for _, e in known if e is not None], np.int64)
        offset = np.concatenate([gaps, fresh, ends])
        ok = np.concatenate([np.isin(gaps, done), np.isin(fresh, done), np.ones(len(ends), bool)])
        order = np.argsort(offset)
        offset, ok = offset[order], ok[order]
        open_ = np.flatnonzero(~ok)
        first = open_[0] if len(open_) else len(offset)
        frontier = int(offset[first - 1]) if first else before
        until = np.append(open_[1:], len(offset)) - 1  # the last event before the next gap
        left = [(int(offset[g]), int(offset[u]) if u > g else None) for g, u in zip(open_, until, strict=True)] if len(open_) else []
        self.ends.update((frontier, int(max([*fresh[-1:], *([] if seen is None else [seen])]))))
        if left:
            self.gaps.put(left)
        elif known:
            self.gaps.clear()
        if frontier is not None and frontier != before:
            yield _frame(self.schema, {"consumer": [key[0]], "committable": [frontier]})

    def close(self) -> None:
        pass


def track_commits(session: DataFrame) -> DataFrame:
    """consumer, committable: a row whenever the longest processed prefix of a group's session grows.

    ``session``: consumer, log_offset, processed. Events are first seen in the order of the log; whether they were
    processed may come later, in any order, as a row with the same offset. An event is processed once a row says so;
    null is not processed. Rows without an offset are left out.
    """
    schema = StructType([session.schema["consumer"], StructField("committable", LongType())])
    rows = session.where("log_offset IS NOT NULL").select("consumer", F.col("log_offset").cast("bigint"), "processed")
    return rows.groupBy("consumer").transformWithStateInPandas(CommitTracker(schema), schema, "append", "none")


def _pack(rows: pd.DataFrame) -> bytes:
    """Rows as one value of state: an Arrow stream."""
    batch = pa.RecordBatch.from_pandas(rows, preserve_index=False)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def _unpack(packed: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(packed).read_pandas()


# ---------------------------------------------------------------- late rows
class ShardFinish(StatefulProcessor):
    """When the shards of a range of slots finished; each is forgotten ``keep_ms`` of event time after that, by a timer."""

    COLUMNS = ["slot", "shard_idx", "finished", "until"]

    def __init__(self, schema: StructType, keep_ms: int):
        self.schema, self.keep_ms = schema, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.finishes = handle.getValueState("finishes", "packed binary")

    def _known(self) -> pd.DataFrame:
        found = self.finishes.get()
        return pd.DataFrame(columns=self.COLUMNS, dtype="int64") if found is None else _unpack(found[0])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch, table = pd.concat(list(rows)), self._known()
        ends = batch[batch["event"] == "finish"]
        if len(ends):
            new = pd.DataFrame({"slot": ends["slot"], "shard_idx": ends["shard_idx"], "finished": ends["arrival"], "until": ends["millis"] + self.keep_ms}, dtype="int64")
            first = not len(table)
            table = pd.concat([table, new]).groupby(["slot", "shard_idx"], as_index=False).min()
            self.finishes.update((_pack(table),))
            if first:
                self.handle.registerTimer(int(table["until"].min()))
        data = batch[batch["event"] == "data"]
        if len(data):
            finished = data.merge(table, "left", ["slot", "shard_idx"])["finished"].to_numpy()
            yield _frame(self.schema, {c: data[c] for c in self.schema.names[:-1]} | {"late": data["arrival"].to_numpy() > finished})  # unknown: not late

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        table = self._known()
        left = table[table["until"] > timerValues.getCurrentWatermarkInMs()]
        if len(left):
            self.finishes.update((_pack(left),))
            self.handle.registerTimer(int(left["until"].min()))
        else:
            self.finishes.clear()
        return iter([])

    def close(self) -> None:
        pass


def mark_late(rows: DataFrame, time: str = "created_at", delay: str = "1 hour", keep_ms: int = 3_600_000, width: int = 256) -> DataFrame:
    """The data rows with late: whether their shard had finished when they arrived.

    ``rows``: slot, shard_idx, event (data or finish), arrival, a time, and more, in order of arrival from batch to
    batch. Only finished shards have state, ``width`` slots under a key, and for ``keep_ms`` after the finish; what is
    older than the watermark is dropped by the engine, so a finish that was forgotten lets no late row through.
    """
    schema = StructType([f for f in rows.schema.fields if f.name != "event"] + StructType().add("late", "boolean").fields)
    keyed = rows.withColumn("millis", F.unix_millis(time)).withColumn("slots", F.expr(f"slot DIV {width}")).withWatermark(time, delay).groupBy("slots")
    return keyed.transformWithStateInPandas(ShardFinish(schema, keep_ms), schema, "append", "eventTime")


# ---------------------------------------------------------------- slot order
class SlotQueue(StatefulProcessor):
    """One lane: the slots that have not been passed, in the order in which they were first seen. Rows: one a slot and batch."""

    def __init__(self, schema: StructType):
        self.schema = schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.queue = handle.getListState("queue", "packed binary")
        self.passed = handle.getValueState("passed", "open bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = [_unpack(packed) for (packed,) in self.queue.get()]
        batch = pd.concat([r[["slot", "first_seen", "ended_at"]] for r in rows])
        batch = batch.groupby("slot", as_index=False).min().assign(opened=False).sort_values("first_seen", kind="stable")
        queue = pd.concat([*known, batch])
        # a slot keeps the place and the time of its first row
        ended = queue.groupby("slot")["ended_at"].min()
        queue = queue.drop_duplicates("slot")
        queue = queue.assign(ended_at=ended.loc[queue["slot"]].to_numpy()).sort_values("first_seen", kind="stable")
        open_ = np.flatnonzero(queue["ended_at"].to_numpy() == NEVER)
        passed = int(open_[0]) if len(open_) else len(queue)
        free = queue.iloc[: passed + 1]
        before = self.passed.get()
        # -1: nothing was passed before
        after = np.maximum.accumulate(np.concatenate([[-1 if before is None else before[0]], free["ended_at"].to_numpy()]))
        new = ~free["opened"].to_numpy(bool)
        if passed:
            self.passed.update((int(after[passed]),))
        rest = queue.iloc[passed:]
        if len(rest):
            rest = rest.assign(opened=np.arange(len(rest)) == 0)
            self.queue.put([(_pack(rest.iloc[i : i + SLOTS]),) for i in range(0, len(rest), SLOTS)])
        elif known:
            self.queue.clear()
        if new.any():
            yield _frame(self.schema, {self.schema.names[0]: [key[0]] * int(new.sum()), "slot": free["slot"][new], "first_seen": free["first_seen"][new], "after": after[: len(free)][new]})

    def close(self) -> None:
        pass


class SlotRows(StatefulProcessor):
    """A range of slots of one lane: the rows of slots that are not open yet, and which slots are."""

    def __init__(self, schema: StructType, payload: StructType):
        self.schema, self.payload = schema, payload

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = handle.getListState("waiting", "packed binary")
        self.open = handle.getListState("open", "slot bigint, first_seen bigint, after bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch, names = pd.concat(list(rows)), self.payload.names
        opens, pending = batch[batch["opens"]], batch.loc[~batch["opens"], names]
        known = {s: (f, a) for s, f, a in self.open.get()}
        opened = known | {int(s): (int(f), int(a)) for s, f, a in opens[["slot", "first_seen", "after"]].itertuples(index=False)}
        waiting = [_unpack(packed) for (packed,) in self.waiting.get()] if len(opens) else []
        pending = pd.concat([*waiting, pending])
        free = pending["slot"].isin(opened)
        ready, rest = pending[free], pending[~free]
        if waiting:
            self.waiting.clear()
        if len(rest):
            self.waiting.appendValue((_pack(rest),))
        ended = set(ready.loc[ready["event"] == "ended", "slot"].tolist())
        left = {s: v for s, v in opened.items() if s not in ended}
        if left:
            self.open.put([(s, *v) for s, v in left.items()])
        elif known:
            self.open.clear()
        if len(ready):
            first, after = (ready["slot"].map({s: v[i] for s, v in opened.items()}) for i in (0, 1))
            yield _frame(self.schema, {c: ready[c] for c in names} | {"emit": np.maximum(ready["arrival"], after), "first_seen": first})

    def close(self) -> None:
        pass


#: Stands for an end that has not come, behind all arrivals.
NEVER = (1 << 63) - 1
#: Slots in one value of a lane's queue.
SLOTS = 100_000


def _slots_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each lane and slot of a partition, with its first arrival and its end."""
    found = pd.DataFrame()
    for frame in frames:
        found = pd.concat([found, frame]).groupby(list(frame.columns[:2]), as_index=False, dropna=False).min()
    yield found


def order_slots(arrivals: DataFrame, lane: str, width: int = 256) -> DataFrame:
    """``arrivals`` with emit and first_seen as in ``adapters.slot_sequential``, each row once its slot is open.

    Rows of one ``lane`` have one order, and come in order of arrival from batch to batch. A lane's key sees one row for
    each slot of a batch, says which slots are open, and has the slots that are not passed as state, packed. Rows
    behind a slot that has not ended wait under keys of ``width`` slots, and are read again when one of them opens. No
    row of a slot comes after its end. Rows without a slot are left out.
    """
    payload = StructType([f for f in arrivals.schema.fields if f.name != lane])
    schema = StructType([*payload.fields, StructField("emit", LongType()), StructField("first_seen", LongType())])
    through = F.coalesce((F.col("event") == "data") & F.col("kind").isin(*PASS_THROUGH), F.lit(False))
    held = arrivals.where(~through & F.col("slot").isNotNull())
    key = arrivals.schema[lane]
    ends = held.select(lane, "slot", F.col("arrival").alias("first_seen"), F.when(F.col("event") == "ended", F.col("arrival")).otherwise(F.lit(NEVER)).alias("ended_at"))
    slots = ends.repartition(lane, "slot").mapInPandas(_slots_of, ends.schema)
    found = StructType([key, arrivals.schema["slot"], StructField("first_seen", LongType()), StructField("after", LongType())])
    opens = slots.groupBy(lane).transformWithStateInPandas(SlotQueue(found), found, "append", "none")
    # no nulls in whole numbers: pandas would make them floats
    blank = {f.name: F.lit(0 if isinstance(f.dataType, IntegralType) else None).cast(f.dataType) for f in payload.fields if f.name != "slot"}
    nothing = F.lit(0).cast("long")
    rows = held.withColumns({"opens": F.lit(False), "first_seen": nothing, "after": nothing}).unionByName(opens.withColumns({"opens": F.lit(True), **blank}))
    ready = rows.withColumn("slots", F.expr(f"slot DIV {width}")).groupBy(lane, "slots").transformWithStateInPandas(SlotRows(schema, payload), schema, "append", "none")
    passed = arrivals.where(through).select(*payload.names, F.col("arrival").cast("long").alias("emit"), F.lit(0).cast("long").alias("first_seen"))
    return ready.unionByName(passed)


# ---------------------------------------------------------------- blocks
class BlockBuilder(StatefulProcessor):
    """The updates of a range of slots, each until it ends; those of a slot that never does leave ``keep_ms`` of event time after its first."""

    SLICE = 10_000  # updates of one result batch, unless a block has more

    def __init__(self, schema: StructType, payload: StructType, keep_ms: int | None):
        self.schema, self.payload, self.keep_ms = schema, payload, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.updates = handle.getMapState("updates", "slot bigint", "packed binary, until bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows))
        ends = batch[batch["event"] == "ended"].groupby("slot")["arrival"].min()
        data = batch.loc[(batch["event"] == "data") & (batch["kind"] != "slot_status"), ["slot", *self.payload.names]]
        known = {slot: value for (slot,), value in self.updates.iterator()}
        over = data["slot"].isin(ends.index)
        self._keep(known, data[~over], batch)
        parts = [data[over]]
        for slot in [s for s in known if s in ends.index]:
            parts.append(_unpack(known[slot][0]))
            self.updates.removeKey((slot,))
        yield from self._blocks(ends, pd.concat(parts).sort_values(["slot", "arrival"], kind="stable"))

    def _keep(self, known: dict, data: pd.DataFrame, batch: pd.DataFrame) -> None:
        for slot, rows in data.groupby("slot"):
            slot, until = int(slot), 0
            if slot in known:
                rows, until = pd.concat([_unpack(known[slot][0]), rows]), known[slot][1]
            elif self.keep_ms is not None:
                until = int(batch.loc[batch["slot"] == slot, "millis"].min()) + self.keep_ms
                self.handle.registerTimer(until)
            self.updates.updateValue((slot,), (_pack(rows), until))

    def _blocks(self, ends: pd.Series, data: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """The blocks of the slots in ``ends``, some at a time; ``data`` is in their order."""
        names = self.payload.names
        at = [np.searchsorted(data["slot"].to_numpy(), ends.index.to_numpy(), side) for side in ("left", "right")]
        slots, columns = [], (ends.index.tolist(), ends.tolist(), *at)
        for slot, end, low, high in zip(*columns, strict=True):
            slots.append((slot, end, low, high))
            if high - slots[0][2] >= self.SLICE or slot == ends.index[-1]:
                part = data.iloc[slots[0][2] : high][names].astype(object)
                updates = part.where(part.notna(), None).to_dict("records")
                yield _frame(self.schema, {"slot": [x[0] for x in slots], "end_arrival": [x[1] for x in slots], "updates": [updates[a - slots[0][2] : b - slots[0][2]] for _, _, a, b in slots]})
                slots = []

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        for slot in [slot for (slot,), (_, until) in self.updates.iterator() if until <= now]:
            self.updates.removeKey((slot,))
        return iter([])

    def close(self) -> None:
        pass


def stream_blocks(arrivals: DataFrame, time: str | None = None, delay: str = "1 hour", keep_ms: int = 3_600_000, width: int = 64) -> DataFrame:
    """slot, end_arrival and the ordered updates of each slot as it ends, as in ``adapters.block_stream``.

    With a ``time`` column, slots that do not end are forgotten ``keep_ms`` after their first update; without one they
    wait for ever. Rows that come after their slot's end begin a new block. ``width`` slots share a key; only those that
    have not ended have state. Rows without a slot are left out.
    """
    payload = StructType([f for f in arrivals.schema.fields if f.name not in ("slot", "event", time)])
    schema = StructType([arrivals.schema["slot"], StructField("end_arrival", LongType()), StructField("updates", ArrayType(payload))])
    keyed = arrivals.where("slot IS NOT NULL").withColumn("slots", F.expr(f"slot DIV {width}"))
    if time is None:
        return keyed.groupBy("slots").transformWithStateInPandas(BlockBuilder(schema, payload, None), schema, "append", "none")
    timed = keyed.withColumn("millis", F.unix_millis(time)).withWatermark(time, delay)
    return timed.groupBy("slots").transformWithStateInPandas(BlockBuilder(schema, payload, keep_ms), schema, "append", "eventTime")


# ---------------------------------------------------------------- rates
class RateAverage(StatefulProcessor):
    """One key's ticks in order, those without blocks included, and the average over the last ``n``; zeros come before the first.

    The rows of a batch are the ticks with blocks that the watermark has just closed. A timer closes the empty ticks
    after them, so a key without blocks goes on ticking as long as the watermark moves. State: the next tick and the
    last ``n - 1`` counts.
    """

    SLICE = 100_000  # ticks of one result batch

    def __init__(self, schema: StructType, seconds: int, n: int):
        self.schema, self.seconds, self.n = schema, seconds, n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.next = handle.getValueState("next", "tick bigint")
        self.counts = handle.getValueState("counts", "last array<bigint>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat([r[["tick", "blocks"]] for r in rows]).groupby("tick")["blocks"].sum()
        if not self.next.exists():
            self.next.update((int(batch.index[0]),))
            self.handle.registerTimer(self._closed_at(int(batch.index[0])))
        yield from self._ticks(key, int(batch.index[-1]) + self.seconds, batch)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() // 1000
        yield from self._ticks(key, now // self.seconds * self.seconds, None)
        self.handle.registerTimer(self._closed_at(self.next.get()[0]))

    def _closed_at(self, tick: int) -> int:
        return (tick + self.seconds) * 1000

    def _ticks(self, key, end: int, blocks: pd.Series | None) -> Iterator[pd.DataFrame]:
        """Results for the ticks from the next one to before ``end``."""
        start = self.next.get()[0]
        last = np.array(self.counts.get()[0] if self.counts.exists() else [0] * (self.n - 1), np.int64)
        for low in range(start, end, self.SLICE * self.seconds):
            ticks = np.arange(low, min(end, low + self.SLICE * self.seconds), self.seconds, dtype=np.int64)
            counts = np.zeros(len(ticks), np.int64) if blocks is None else blocks.reindex(ticks, fill_value=0).to_numpy(np.int64)
            sums = np.cumsum(np.concatenate([[0], last, counts]))
            last = np.concatenate([last, counts])[len(counts) :]
            yield _frame(self.schema, {self.schema.names[0]: [key[0]] * len(ticks), "tick": ticks, "blocks": counts, "average": (sums[self.n :] - sums[: -self.n]) / self.n})
        if end > start:
            self.next.update((end,))
            self.counts.update((last.tolist(),))

    def close(self) -> None:
        pass


def average_rates(blocks: DataFrame, key: str, seconds: int = 1, delay: str = "10 seconds", n: int = 5) -> DataFrame:
    """key, tick (epoch seconds), blocks and average: each closed tick of each key once, as in ``stats.block_rate_average``.

    ``blocks``: the key and created_at; rows without a time are left out, a null key is a key of its own. Blocks are
    counted by tick first, so that one row for each tick with blocks goes to its key, however many blocks it has. A
    key's ticks begin with its first block and end where the watermark is; blocks behind the watermark are dropped.
    """
    timed = blocks.where("created_at IS NOT NULL").withWatermark("created_at", delay)
    counts = timed.groupBy(key, F.window("created_at", f"{seconds} seconds")).agg(F.count(F.lit(1)).alias("blocks"))
    ticks = counts.select(key, F.window_time("window").alias("closed"), F.unix_timestamp("window.start").alias("tick"), "blocks")
    schema = StructType([blocks.schema[key], StructField("tick", LongType()), StructField("blocks", LongType()), StructField("average", DoubleType())])
    return ticks.groupBy(key).transformWithStateInPandas(RateAverage(schema, seconds, n), schema, "append", "eventTime")
