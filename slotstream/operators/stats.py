"""Statistics: blocks, integrity, tips, lags, histograms, rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TRANSACTIONS = ("transaction", "transaction_status")
# fixed values: bounds of the duration histograms, in milliseconds
SLOT_BUCKETS = (320, 340, 360, 380, 400, 420, 440, 460, 480, 500, 1000)
SHARD_BUCKETS = (20, 50, 100, 200, 400, 1000, 2000, 4000)


def block_stats(updates: DataFrame, meta: DataFrame) -> DataFrame:
    """Counts per block against those of its metadata. One shuffle of partial counts; the metadata joins on slot."""
    tx = F.col("kind").isin(*TRANSACTIONS)
    counts = updates.groupBy("slot").agg(
        F.count_if(tx & ~F.col("failed")).alias("good_tx"),
        F.count_if(tx & F.col("failed")).alias("failed_tx"),
        F.count_if(tx).alias("total_tx"),
        F.count_if(F.col("kind") == "entry").alias("entries"),
        F.count_if(F.col("kind") == "account").alias("account_updates"),
    )
    wanted = meta.select("slot", F.col("executed_transaction_count").alias("expected_tx"), F.col("entries_count").alias("expected_entries"))
    return counts.join(wanted, "slot")


def block_stats_distinct(transactions: DataFrame, accounts: DataFrame, entries: DataFrame, opened: DataFrame, meta: DataFrame) -> DataFrame:
    """Counts of distinct signatures and (account, signature) pairs of the blocks that were opened and have metadata."""
    ok = F.when(F.col("err").isNull(), F.col("signature"))
    bad = F.when(F.col("err").isNotNull(), F.col("signature"))
    slots = opened.select("slot").distinct().join(meta.select("slot", "executed_transaction_count", "entries_count"), "slot")
    tx = transactions.groupBy("slot").agg(F.countDistinct(ok).alias("good_tx"), F.countDistinct(bad).alias("failed_tx"))
    from slotstream.operators.dedup import distinct_accounts

    counted = slots.join(tx, "slot", "left").join(distinct_accounts(accounts), "slot", "left").join(entries.groupBy("slot").agg(F.count(F.lit(1)).alias("entries")), "slot", "left")
    return counted.na.fill(0, ["good_tx", "failed_tx", "account_updates", "entries"]).select("slot", "good_tx", "failed_tx", "entries", "account_updates", "executed_transaction_count", "entries_count")


def block_stats_between(updates: DataFrame, spans: DataFrame, meta: DataFrame) -> DataFrame:
    """Counts of distinct signatures and (account, signature) pairs, and of entries, while a block was open.

    ``updates``: slot, kind, arrival, signature, err, pubkey, txn_signature. ``spans``: slot, opened_at (first shred or
    created bank; null: never opened), closed_at (block metadata). Rows before a block opens or once its metadata is there do
    not count; blocks that were never opened or have no metadata have no row.
    """
    tx = F.col("kind").isin(*TRANSACTIONS)
    account = (F.col("kind") == "account") & F.col("txn_signature").isNotNull()
    blocks = spans.where("opened_at IS NOT NULL AND closed_at IS NOT NULL AND opened_at < closed_at").join(meta.select("slot", "executed_transaction_count", "entries_count"), "slot")
    inside = updates.join(blocks.select("slot", "opened_at", "closed_at"), "slot").where("arrival >= opened_at AND arrival < closed_at")
    counts = inside.groupBy("slot").agg(
        F.countDistinct(F.when(tx & F.col("err").isNull(), F.col("signature"))).alias("good_tx"),
        F.countDistinct(F.when(tx & F.col("err").isNotNull(), F.col("signature"))).alias("failed_tx"),
        F.count_if(F.col("kind") == "entry").alias("entries"),
        F.countDistinct(F.when(account, F.struct("pubkey", "txn_signature"))).alias("account_updates"),
    )
    counted = blocks.join(counts, "slot", "left").na.fill(0, ["good_tx", "failed_tx", "entries", "account_updates"])
    return counted.select("slot", "good_tx", "failed_tx", "entries", "account_updates", "executed_transaction_count", "entries_count")


def block_integrity(stats: DataFrame) -> DataFrame:
    """Whether the counts of a block are those of its metadata."""
    tx, entries = F.col("total_tx") == F.col("expected_tx"), F.col("entries") == F.col("expected_entries")
    return stats.select("slot", tx.alias("tx_ok"), entries.alias("entries_ok"), (tx & entries).alias("intact"))


def chain_tip(history: DataFrame, shard: str = "blockchain_shard_id") -> DataFrame:
    """Largest offset per history shard as a map, and the tip, which is the largest of all."""
    per_shard = history.groupBy(F.col(shard).alias("shard")).agg(F.max("log_offset").alias("offset"))
    return per_shard.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("shard", "offset")))).alias("offsets"), F.max("offset").alias("tip"))


def slot_range(history: DataFrame) -> DataFrame:
    """First and last slot of the log."""
    return history.agg(F.min("slot").alias("min_slot"), F.max("slot").alias("max_slot"))


def slot_elapsed(updates: DataFrame) -> DataFrame:
    """Rows per slot and the seconds from its first to its last row."""
    seconds = F.unix_timestamp(F.max("created_at")) - F.unix_timestamp(F.min("created_at"))
    return updates.withColumn("created_at", F.col("created_at").cast("timestamp")).groupBy("slot").agg(F.count(F.lit(1)).alias("updates"), seconds.alias("seconds"))


def offset_lag(groups: DataFrame, tip: DataFrame) -> DataFrame:
    """How far each group is behind the tip, at least 0. ``tip``: one row."""
    return groups.crossJoin(F.broadcast(tip.select("tip"))).select("name", F.greatest(F.lit(0), F.col("tip") - F.col("committed_offset")).alias("lag"))


def session_counters(session: DataFrame, history: DataFrame) -> DataFrame:
    """Counters of a session: events, distinct slots, processed and skipped events, and statuses by commitment."""
    a = session.agg(F.count(F.lit(1)).alias("events"), F.count_if("processed").alias("processed"), F.count_if(~F.col("processed")).alias("skipped"))
    b = history.agg(F.countDistinct("slot").alias("slots"), *[F.count_if(F.col("commitment") == r).alias(n) for n, r in (("processed_statuses", 0), ("confirmed_statuses", 1), ("finalized_statuses", 2))])
    return a.crossJoin(F.broadcast(b))  # one row each


def commit_counters(applied: DataFrame, session: DataFrame, page: int = 100) -> DataFrame:
    """One row: commits written, commits skipped because nothing was new, polls of ``page`` events, and failed attempts.

    ``applied``: consumer, written. An event that its group did not process counts as a failed attempt.
    """
    commits = applied.agg(F.count_if("written").alias("commits"), F.count_if(~F.col("written")).alias("skipped_commits"))
    per_group = session.groupBy("consumer").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.coalesce("processed", F.lit(False))).alias("failed"))
    polls = per_group.agg(F.coalesce(F.sum(F.ceil(F.col("n") / page)), F.lit(0)).alias("polls"), F.coalesce(F.sum("failed"), F.lit(0)).alias("failed_attempts"))
    return commits.crossJoin(F.broadcast(polls))  # one row each


def duration_histogram(durations: DataFrame, column: str, buckets: tuple[int, ...]) -> DataFrame:
    """Cumulative counts of durations in milliseconds up to each bound; the last bound is infinite (null).

    Every duration is counted once, in its own bucket; the sums run over the buckets alone.
    """
    bounds = F.array(*map(F.lit, buckets))
    own = F.size(F.filter(bounds, lambda b: F.col(column) > b)).alias("bucket")
    counts = durations.where(F.col(column).isNotNull()).groupBy(own).agg(F.count(F.lit(1)).alias("n"))
    spine = durations.sparkSession.range(1).select(F.posexplode(F.concat(bounds, F.array(F.lit(None).cast("int")))).alias("bucket", "le"))
    joined = spine.join(counts, "bucket", "left").na.fill(0, ["n"])
    return joined.select("le", F.sum("n").over(Window.orderBy("bucket")).alias("count"))  # as many rows as bounds


def in_flight(starts: DataFrame, ends: DataFrame) -> DataFrame:
    """Loads that started and have not ended."""
    s, e = starts.agg(F.count(F.lit(1)).alias("started")), ends.agg(F.count(F.lit(1)).alias("ended"))
    return s.crossJoin(F.broadcast(e)).select("started", "ended", (F.col("started") - F.col("ended")).alias("in_flight"))  # one row each


def kind_counts(updates: DataFrame) -> DataFrame:
    """Updates per kind."""
    return updates.groupBy("kind").agg(F.count(F.lit(1)).alias("updates"))


def filter_counts(tagged: DataFrame) -> DataFrame:
    """Updates per matched filter name."""
    return tagged.select(F.explode("filters").alias("filter")).groupBy("filter").agg(F.count(F.lit(1)).alias("updates"))


def lane_load(updates: DataFrame, lanes: int = 4) -> DataFrame:
    """Updates and slots per shard lane."""
    lane = F.pmod("shard_idx", F.lit(lanes)).cast("int").alias("lane")
    return updates.groupBy(lane).agg(F.count(F.lit(1)).alias("updates"), F.countDistinct("slot").alias("slots"))


def block_rate(blocks: DataFrame, time: str = "created_at", seconds: int = 1) -> DataFrame:
    """Blocks per tick of ``seconds``, ticks without blocks included. ``tick`` is in epoch seconds."""
    tick = (F.floor(F.unix_timestamp(F.col(time).cast("timestamp")) / seconds) * seconds).alias("tick")
    counts = blocks.groupBy(tick).agg(F.count(F.lit(1)).alias("blocks"))
    ends = counts.agg(F.min("tick").alias("a"), F.max("tick").alias("b")).where("a IS NOT NULL")
    spine = ends.select(F.explode(F.sequence("a", "b", F.lit(seconds).cast("long"))).alias("tick"))
    return spine.join(counts, "tick", "left").na.fill(0, ["blocks"])


def block_rate_average(rates: DataFrame, ticks: int = 5, seconds: int = 1, chunk: int = 3600) -> DataFrame:
    """Average over the last ``ticks`` ticks, always divided by ``ticks``; missing ticks before the first are 0.

    Time is cut into chunks; each chunk also gets the last ticks of the one before, so the window has partitions.
    """
    size = chunk * seconds
    own = F.floor(F.col("tick") / size)
    lent = F.floor((F.col("tick") + (ticks - 1) * seconds) / size)
    parts = rates.withColumn("_chunk", F.explode(F.sequence(own, lent)))
    window = Window.partitionBy("_chunk").orderBy("tick").rowsBetween(-(ticks - 1), 0)
    return parts.withColumn("average", F.sum("blocks").over(window) / ticks).where(F.col("_chunk") == own).drop("_chunk")


def account_transactions(accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Account updates with the transaction that made them, by slot and signature."""
    tx = transactions.select("slot", F.col("signature").alias("txn_signature"), F.col("idx").alias("tx_index"), "err")
    return accounts.where("txn_signature IS NOT NULL").join(tx, ["slot", "txn_signature"])
