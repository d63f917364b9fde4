"""The log's tables as views of the test tables: history, updates and what goes with them, for queries and benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HISTORY_COLUMNS = (
    "event_id AS log_offset",
    "CAST(150 * floor(event_id / 1500.0) AS BIGINT) + user_id % 150 AS slot",
    "CASE event_type WHEN 'purchase' THEN 1 WHEN 'error' THEN 2 ELSE 0 END AS commitment",
    "CASE WHEN event_type = 'error' AND value < 1.0 THEN 'slot marked dead' END AS dead_error",
    "CAST(4 AS INT) AS num_shards",
    "ts AS created_at",
)
UPDATE_COLUMNS = (
    "l_orderkey AS slot",
    "l_linenumber % 4 AS shard_idx",
    "CASE WHEN l_linenumber <= 3 THEN 'transaction' WHEN l_linenumber = 4 THEN 'transaction_status' WHEN l_linenumber <= 6 THEN 'account' ELSE 'entry' END AS kind",
    "l_linenumber AS idx",
    "l_partkey AS pubkey",
    "l_suppkey AS owner",
    "CAST(l_quantity * 1000 AS BIGINT) AS lamports",
    "l_discount < 0.03 AS is_vote",
    "l_returnflag = 'R' AS failed",
    "l_shipdate AS created_at",
)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (slot, commitment) observation, in log order, from events."""
    return _read(spark, sf_dir, "events").selectExpr(*HISTORY_COLUMNS)


def sharded_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History with the shard of the log that holds each offset; the test tables have four."""
    return history(spark, sf_dir).withColumn("blockchain_shard_id", F.expr("CAST(pmod(log_offset, 4) AS INT)"))


def session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History as consumer groups processed it: consumer, log_offset, slot, processed."""
    return _read(spark, sf_dir, "events").selectExpr("user_id AS consumer", HISTORY_COLUMNS[0], HISTORY_COLUMNS[1], "event_type <> 'error' AS processed")


def updates(spark: SparkSession, sf_dir: str, arrival: bool = False) -> DataFrame:
    """The payload, one row per update, from lineitem; with its arrival within the slot if asked for."""
    lines = _read(spark, sf_dir, "lineitem")
    if not arrival:
        return lines.selectExpr(*UPDATE_COLUMNS)
    order = Window.partitionBy("l_orderkey").orderBy("l_shipdate", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return lines.withColumn("arrival", F.row_number().over(order)).selectExpr(*UPDATE_COLUMNS, "arrival")


def block_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block metadata with expected counts, from orders."""
    return _read(spark, sf_dir, "orders").selectExpr("o_orderkey AS slot", "o_orderkey % 4 AS executed_transaction_count", "o_orderkey % 2 AS entries_count", "o_orderdate AS block_time", "o_orderstatus AS status")


def shard_finish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each shard of a slot finished; some slots lack a shard, some shards finish before their last row."""
    shards = updates(spark, sf_dir, True).groupBy("slot", "shard_idx").agg(F.max("arrival").alias("last"))
    return shards.where("NOT (slot % 17 = 0 AND shard_idx = 3)").selectExpr("slot", "shard_idx", "last - CASE WHEN slot % 11 = 0 THEN 1 ELSE 0 END AS finish_arrival")


def slot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of shards of each slot that has a payload."""
    return updates(spark, sf_dir).groupBy("slot").agg(F.countDistinct("shard_idx").alias("num_shards"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with keys and token balances."""
    return updates(spark, sf_dir).where("kind IN ('transaction', 'transaction_status')").selectExpr(
        "slot", "idx", "kind", "concat(slot, '-', idx, '-', pubkey) AS signature", "is_vote", "CASE WHEN failed THEN 'InstructionError' END AS err",
        "array(pubkey, owner) AS static_keys", "array(pubkey % 50) AS writable_keys", "array(owner % 10) AS readonly_keys",
        "array(named_struct('account_index', 0, 'owner', pubkey % 20, 'amount', lamports), named_struct('account_index', 1, 'owner', 100 + owner % 20, 'amount', CAST(500 AS BIGINT))) AS pre_token_balances",
        "CASE WHEN pubkey % 3 = 0 THEN array(named_struct('account_index', 0, 'owner', pubkey % 20, 'amount', lamports + idx % 2)) ELSE "
        "array(named_struct('account_index', 0, 'owner', pubkey % 20, 'amount', lamports + idx % 2), named_struct('account_index', 1, 'owner', 100 + owner % 20, 'amount', CAST(500 AS BIGINT))) END AS post_token_balances",
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account updates with binary data and an optional transaction signature."""
    return updates(spark, sf_dir).where("kind = 'account'").selectExpr(
        "slot", "pubkey", "owner", "lamports", "CASE WHEN idx = 5 THEN concat(slot, '-', 3, '-', pubkey) END AS txn_signature",
        "CAST(concat('acct-', pubkey % 7, '-', owner % 5, repeat('x', CAST(pubkey % 300 AS INT))) AS BINARY) AS data",
    )


def block_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All updates with their arrival, signatures and errors."""
    return updates(spark, sf_dir, True).selectExpr(
        "slot", "kind", "arrival", "pubkey", "CASE WHEN kind IN ('transaction', 'transaction_status') THEN concat(slot, '-', idx, '-', pubkey) END AS signature",
        "CASE WHEN failed THEN 'InstructionError' END AS err", "CASE WHEN idx = 5 THEN concat(slot, '-', 3, '-', pubkey) END AS txn_signature",
    )


def block_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When blocks opened and when their metadata came, in arrivals of the slot: some late, some before the last row, some not at all."""
    return updates(spark, sf_dir, True).groupBy("slot").agg(F.max("arrival").alias("last")).selectExpr("slot", "CASE WHEN slot % 7 > 0 THEN 1 + slot % 2 END AS opened_at", "last + 1 - slot % 3 AS closed_at")


def shard_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates and the finishes of their shards as one log; a finish has the time of its shard's last row."""
    rows = updates(spark, sf_dir, True).selectExpr("slot", "shard_idx", "'data' AS event", "kind", "CAST(arrival AS BIGINT) AS arrival", "CAST(created_at AS TIMESTAMP) AS created_at")
    times = rows.groupBy("slot", "shard_idx").agg(F.max("created_at").alias("created_at"))
    ends = shard_finish(spark, sf_dir).join(times, ["slot", "shard_idx"]).selectExpr("slot", "shard_idx", "'finish' AS event", "CAST(NULL AS STRING) AS kind", "CAST(finish_arrival AS BIGINT) AS arrival", "created_at")
    return rows.unionByName(ends)


def late_acknowledgements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second row for a third of the events that were not processed: they are, later."""
    return session(spark, sf_dir).where("NOT processed AND log_offset % 3 = 0").withColumn("processed", F.lit(True))


def arrivals(spark: SparkSession, sf_dir: str, all_end: bool = False) -> DataFrame:
    """Runtime events in order of arrival: data of slots, statuses, block metadata, and one end per slot; unless ``all_end``, one slot in 1,050 has none."""
    rows = history(spark, sf_dir).selectExpr("log_offset * 2 AS arrival", "slot", "'data' AS event", "CASE commitment WHEN 2 THEN 'slot_status' WHEN 1 THEN 'block_meta' ELSE 'entry' END AS kind")
    ends = rows.groupBy("slot").agg((F.max("arrival") + 1).alias("arrival")).where("true" if all_end else "slot % 1050 <> 1040").selectExpr("arrival", "slot", "'ended' AS event", "CAST(NULL AS STRING) AS kind")
    return rows.unionByName(ends)


def consumer_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consumer groups with committed offsets, from customer."""
    return _read(spark, sf_dir, "customer").selectExpr("CAST(c_custkey AS STRING) AS id", "c_name AS name", "(c_custkey * 7) % 10000 AS committed_offset")
