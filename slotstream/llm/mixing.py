"""Mixing sources to target weights by Pfair scheduling.

Every source's rows are cut into blocks. Block k (from 0) of a source with share w of the slots is released at
slot floor(k / w) and due before slot ceil((k + 1) / w); taking the released block with the earliest deadline
fills every slot and keeps each source within less than one block of its target at any time.

With whole weights the schedule repeats after as many slots as the weights sum to, a round. A source with weight w
has its block b in round b // w, at place b % w; its last round may hold fewer. So the rounds of all sources are
alike but where one runs out: a phase is a run of like rounds. One round of each phase is scheduled, and each block
finds its slot by (phase, round, place in the round). No row is dropped or repeated. DataFrame functions only.

The plan is a set of tables: a row per source, a row per phase (at most two per source), a row per slot of a
phase's round. Scheduling a round takes (slots x sources) steps in the task that holds the phase.

A null source is a source of its own. Weights apply to the sources present; a source without a weight gets
weight 1, and weights below 1 count as 1. Weights may be of any size and number: a round has as many slots as they
sum to. An empty table gives an empty result. Repeated rows are placed each by itself, in an order fixed by the
digest of the key (of the whole row, where the key is null), then the hash of the whole row; equal rows are
interchangeable. Ties of deadlines go to the smaller name of a source, null first. Texts are not read but for that
hash, of any length. Existing columns with the name of an output are replaced.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotstream.llm.common import bounded, materialize

#: Rows per bucket of the two-level numbering of a source's rows.
BUCKET_ROWS = 2_000
#: Slots of the smallest source in a round of default weights, unless the caller wants finer ones; rounding changes a share by at most 1 in twice as many.
FINEST = 8


def _weights(spark: SparkSession, sizes: DataFrame, weights: Mapping[str | None, int] | None, alpha: float, finest: int) -> DataFrame:
    """``sizes`` (source, rows) with the whole weight of each source: as given, or in proportion to rows ** alpha."""
    if weights is None:
        least = sizes.agg(F.min("rows").alias("least"))  # one row
        ratio = F.pow(F.col("rows") / F.col("least"), F.lit(float(alpha)))
        return sizes.crossJoin(F.broadcast(least)).select("source", "rows", F.greatest(F.lit(1), F.round(finest * ratio)).cast("long").alias("weight"))
    given = json.dumps([{"source": "" if s is None else f"={s}", "given": int(w)} for s, w in weights.items()])
    table = spark.range(1).select(F.inline(F.from_json(F.lit(given), "array<struct<source string, given bigint>>")))
    return sizes.join(table, "source", "left").select("source", "rows", F.greatest(F.lit(1), F.coalesce("given", F.lit(1))).cast("long").alias("weight"))


def _earliest_deadline_first(blocks: Column, slots: Column) -> Column:
    """The place (in ``blocks``, the number of blocks of each source) of the source of every slot of a round, by a fold.

    The state holds each source's number of blocks placed. A block is released at floor(k * slots / w) and due at
    ceil((k + 1) * slots / w); among the released ones the earliest deadline wins, ties go to the smaller place. The
    slots are folded in stretches of the square root of their number, as every step copies what its list holds.
    """

    def due(placed: Column, t: Column) -> Column:
        at = lambda w, s: F.struct(F.ceil((F.get(placed, s) + 1) * slots / w).alias("d"), s.alias("s"))
        open_at = lambda w, s: (F.get(placed, s) < w) & (F.floor(F.get(placed, s) * slots / w) <= t)
        return F.array_min(F.transform(blocks, lambda w, s: F.when(open_at(w, s), at(w, s))))["s"]

    def step(state: Column, t: Column) -> Column:
        placed = lambda d: F.transform(state["placed"], lambda k, s: F.when(s == d, k + 1).otherwise(k))
        after = lambda d: F.struct(placed(d).alias("placed"), F.concat(state["order"], F.array(d)).alias("order"))
        return F.get(F.transform(F.array(due(state["placed"], t)), after), F.lit(0))  # a variable, so that it is found once a slot

    length = F.ceil(F.sqrt(slots))
    empty = F.array().cast("array<int>").alias("order")

    def stretch(state: Column, first: Column) -> Column:
        last = F.least(first + length, slots) - 1
        done = lambda s: F.struct(s["placed"].alias("placed"), F.concat(state["lists"], F.array(s["order"])).alias("lists"))
        return F.aggregate(F.sequence(first, last), F.struct(state["placed"].alias("placed"), empty), step, done)

    start = F.struct(F.transform(blocks, lambda w: w * 0).alias("placed"), F.array().cast("array<array<int>>").alias("lists"))
    return F.aggregate(F.sequence(F.lit(0).cast("long"), slots - 1, length), start, stretch, lambda state: F.flatten(state["lists"]))


def rounds(sources: DataFrame) -> DataFrame:
    """phase, first_round, slots, first_slot, names and blocks of every phase. ``sources``: source, weight, full, rest.

    ``full`` is a source's number of whole rounds, ``rest`` what is left for one more.
    """
    end = F.max(F.col("full") + (F.col("rest") > 0).cast("long")).alias("end")
    changes = sources.agg(F.array_sort(F.collect_set("full")).alias("full"), end)  # at most one number per source
    firsts = F.array_sort(F.array_union(F.array(F.lit(0).cast("long")), F.array_union("full", F.transform("full", lambda q: q + 1))))
    changes = changes.select(F.filter(firsts, lambda r: r < F.col("end")).alias("firsts"), "end")
    active = sources.crossJoin(F.broadcast(changes)).select("source", "weight", "full", "rest", F.posexplode(F.filter("firsts", lambda r: (r < F.col("full")) | ((r == F.col("full")) & (F.col("rest") > 0)))).alias("_", "first_round")).drop("_")
    blocks = F.when(F.col("first_round") < F.col("full"), F.col("weight")).otherwise(F.col("rest"))
    listed = F.sort_array(F.collect_list(F.struct("source", blocks.alias("blocks"))))
    phases = active.groupBy("first_round").agg(listed.alias("l"), F.sum(blocks).alias("slots"))
    following = F.lead("first_round").over(Window.orderBy("first_round"))  # windows over phases, at most two per source
    phases = phases.crossJoin(F.broadcast(changes.select("end"))).withColumn("rounds", F.coalesce(following, F.col("end")) - F.col("first_round"))
    before = F.sum(F.col("slots") * F.col("rounds")).over(Window.orderBy("first_round").rowsBetween(Window.unboundedPreceding, -1))
    number = (F.row_number().over(Window.orderBy("first_round")) - 1).cast("long")
    return phases.select(number.alias("phase"), "first_round", "slots", F.coalesce(before, F.lit(0)).alias("first_slot"), F.col("l.source").alias("names"), F.col("l.blocks").alias("blocks"))


def schedule(phases: DataFrame) -> DataFrame:
    """phase, source, nth and slot: one row per slot of a round of each phase."""
    order = _earliest_deadline_first(F.col("blocks"), F.col("slots"))
    placed = phases.repartition(64, "phase").select("phase", "names", F.posexplode(order).alias("slot", "place")).select("phase", F.get("names", "place").alias("source"), "slot")
    nth = F.row_number().over(Window.partitionBy("phase", "source").orderBy("slot")) - 1
    return placed.select("phase", "source", nth.cast("long").alias("nth"), F.col("slot").cast("long").alias("slot"))


def _numbered(df: DataFrame, total: int) -> DataFrame:
    """Add _row, the place of each row among its source's rows from 0, in two levels: ranges of digests, then rows in a range.

    ``df``: _s, _order, whose first field is a digest. A hot source is spread over its ranges, whose number follows
    the table's size.
    """
    ranges = max(1, -(-total // BUCKET_ROWS))
    part = F.conv(F.substring("_order.m", 1, 8), 16, 10).cast("long")
    df = df.withColumn("_range", F.floor(part * F.lit(ranges) / F.lit(1 << 32)))
    sizes = df.groupBy("_s", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_s").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_s", "_range", before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_s", "_range").orderBy("_order"))
    return df.withColumn("_inside", inside).join(offsets, ["_s", "_range"]).withColumn("_row", F.col("_before") + F.col("_inside") - 1).drop("_range", "_inside", "_before")


def _phase_of(firsts: Column, r: Column, count: Column) -> Column:
    """The place of the last of the ascending ``firsts`` that is not above ``r``, by halving."""
    steps = F.transform(F.sequence(F.lit(20), F.lit(0), F.lit(-1)), lambda b: F.call_function("shiftleft", F.lit(1), b))
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when((at + s < count) & (F.get(firsts, at + s) <= r), at + s).otherwise(at))


def mix(df: DataFrame, weights: Mapping[str | None, int] | None = None, source: str = "source", key: str = "doc_id", block_rows: int = 1, alpha: float = 0.5, finest: int = FINEST) -> DataFrame:
    """``df`` with phase, block, slot and position in the mixed order (positions skip only what a last, partial block lacks).

    ``weights``: whole target weights by source, in blocks per round; without them, sizes tempered by ``alpha``
    and rounded to whole slots, ``finest`` for the smallest source: a weight is then off by one in 2 * ``finest`` at most,
    and a round has the more slots.
    """
    spark = df.sparkSession
    names = [f"c{i}" for i in range(len(df.columns))]
    at = dict(zip(df.columns, names, strict=True))
    plain = df.toDF(*names).withColumn("_s", F.coalesce(F.concat(F.lit("="), F.col(at[source]).cast("string")), F.lit("")))
    sizes = materialize(plain.groupBy(F.col("_s").alias("source")).agg(F.count(F.lit(1)).alias("rows")), "sizes")
    blocks = F.ceil(F.col("rows") / block_rows)
    weighed = _weights(spark, sizes, weights, alpha, finest).select("source", "weight", F.floor(blocks / F.col("weight")).alias("full"), (blocks % F.col("weight")).alias("rest"))
    sources = materialize(weighed, "sources")
    phases = materialize(rounds(sources), "phases")
    places = materialize(schedule(phases), "schedule")
    total = sizes.agg(F.sum("rows")).first()[0] or 0
    whole = F.xxhash64(*names)
    digest = F.md5(F.coalesce(F.col(at[key]).cast("string"), whole.cast("string")).cast("binary"))
    order = F.struct(digest.alias("m"), F.col(at[key]).alias("k"), whole.alias("h"))
    rows = _numbered(plain.withColumn("_order", order), total).drop("_order")
    rows = rows.join(bounded(sources.select(F.col("source").alias("_s"), "weight")), "_s").withColumn("_block", F.floor(F.col("_row") / block_rows))
    rows = rows.withColumns({"_round": F.floor(F.col("_block") / F.col("weight")), "_nth": F.col("_block") % F.col("weight")})
    firsts = phases.agg(F.array_sort(F.collect_list("first_round")).alias("_firsts"))  # one row of at most two numbers per source
    rows = rows.crossJoin(F.broadcast(firsts)).withColumn("_phase", _phase_of(F.col("_firsts"), F.col("_round"), F.size("_firsts")).cast("long")).drop("_firsts")
    rows = rows.join(bounded(phases.select(F.col("phase").alias("_phase"), "first_round", "slots", "first_slot")), "_phase")
    rows = rows.join(bounded(places.select(F.col("phase").alias("_phase"), F.col("source").alias("_s"), F.col("nth").alias("_nth"), F.col("slot").alias("_slot"))), ["_phase", "_s", "_nth"])
    slot = F.col("first_slot") + (F.col("_round") - F.col("first_round")) * F.col("slots") + F.col("_slot")
    rows = rows.withColumns({"_slot": slot, "_position": slot * block_rows + F.col("_row") % block_rows})
    out = [F.col(f"_{c}").cast("long").alias(c) for c in ("phase", "block", "slot", "position")]
    return rows.select(*[F.col(n).alias(c) for n, c in zip(names, df.columns, strict=True) if c not in ("phase", "block", "slot", "position")], *out)
