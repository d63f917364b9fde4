"""The registered queries over the test tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream import schemas
from slotstream.functions import filters as fl
from slotstream.functions import project
from slotstream.operators import adapters, completion, dedup, groups, progress, stats
from slotstream.sources import sinks, tables, versions
from slotstream.sources import testdata as td
from slotstream.streaming import queries as stream_queries

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

# ------------------------------------------------------------------ tables, in SQL
_U = """SELECT l_orderkey AS slot, l_linenumber % 4 AS shard_idx,
  CASE WHEN l_linenumber <= 3 THEN 'transaction' WHEN l_linenumber = 4 THEN 'transaction_status' WHEN l_linenumber <= 6 THEN 'account' ELSE 'entry' END AS kind,
  l_linenumber AS idx, l_partkey AS pubkey, l_suppkey AS owner, CAST(l_quantity * 1000 AS BIGINT) AS lamports, l_discount < 0.03 AS is_vote,
  l_returnflag = 'R' AS failed, l_shipdate AS created_at,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax) AS arrival
  FROM lineitem"""
_TABLES = {
    "history": "SELECT event_id AS log_offset, CAST(150 * floor(event_id / 1500.0) AS BIGINT) + user_id % 150 AS slot, CASE event_type WHEN 'purchase' THEN 1 WHEN 'error' THEN 2 ELSE 0 END AS commitment, CASE WHEN event_type = 'error' AND value < 1.0 THEN 'slot marked dead' END AS dead_error, CAST(4 AS INT) AS num_shards, ts AS created_at FROM events",
    "session": "SELECT user_id AS consumer, event_id AS log_offset, CAST(150 * floor(event_id / 1500.0) AS BIGINT) + user_id % 150 AS slot, event_type <> 'error' AS processed FROM events",
    "updates": _U,
    "meta": "SELECT o_orderkey AS slot, o_orderkey % 4 AS executed_transaction_count, o_orderkey % 2 AS entries_count, o_orderdate AS block_time, o_orderstatus AS status FROM orders",
    "finish": "SELECT slot, shard_idx, max(arrival) - CASE WHEN slot % 11 = 0 THEN 1 ELSE 0 END AS finish_arrival FROM updates WHERE NOT (slot % 17 = 0 AND shard_idx = 3) GROUP BY slot, shard_idx",
    "shards": "SELECT slot, count(DISTINCT shard_idx) AS num_shards FROM updates GROUP BY slot",
    "tx": "SELECT slot, idx, kind, slot || '-' || idx || '-' || pubkey AS signature, is_vote, CASE WHEN failed THEN 'InstructionError' END AS err, pubkey, owner, lamports, [pubkey, owner, pubkey % 50, owner % 10] AS keys FROM updates WHERE kind IN ('transaction', 'transaction_status')",
    "acct": "SELECT slot, pubkey, owner, lamports, CASE WHEN idx = 5 THEN slot || '-' || 3 || '-' || pubkey END AS txn_signature, 'acct-' || pubkey % 7 || '-' || owner % 5 || repeat('x', CAST(pubkey % 300 AS INT)) AS data FROM updates WHERE kind = 'account'",
    "grp": "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, (c_custkey * 7) % 10000 AS committed_offset FROM customer",
    "progress": "SELECT s.slot, s.num_shards, coalesce(d.done, 0) AS done, coalesce(d.done, 0) = s.num_shards AS complete, CASE WHEN coalesce(d.done, 0) = s.num_shards THEN d.last END AS complete_arrival FROM shards s LEFT JOIN (SELECT slot, count(*) AS done, max(a) AS last FROM (SELECT slot, shard_idx % num_shards AS shard, min(finish_arrival) AS a FROM finish JOIN shards USING (slot) GROUP BY 1, 2) GROUP BY slot) d USING (slot)",
    "complete": "SELECT slot, complete_arrival FROM progress WHERE complete",
    "raw_arrivals": "SELECT log_offset * 2 AS arrival, slot, 'data' AS event, CASE commitment WHEN 2 THEN 'slot_status' WHEN 1 THEN 'block_meta' ELSE 'entry' END AS kind FROM history",
    "arrivals": "SELECT * FROM raw_arrivals UNION ALL SELECT max(arrival) + 1, slot, 'ended', NULL FROM raw_arrivals WHERE slot % 1050 <> 1040 GROUP BY slot",
    "ended_arrivals": "SELECT * FROM raw_arrivals UNION ALL SELECT max(arrival) + 1, slot, 'ended', NULL FROM raw_arrivals GROUP BY slot",
    "gaps": "SELECT consumer, min(log_offset) FILTER (NOT processed) AS gap FROM session GROUP BY consumer",
    "committable": "SELECT g.consumer, max(s.log_offset) AS committable FROM gaps g LEFT JOIN session s ON s.consumer = g.consumer AND (g.gap IS NULL OR s.log_offset < g.gap) GROUP BY g.consumer",
}
_NEEDS = {
    "finish": ["updates"], "shards": ["updates"], "tx": ["updates"], "acct": ["updates"], "progress": ["updates", "finish", "shards"], "complete": ["updates", "finish", "shards", "progress"],
    "raw_arrivals": ["history"], "arrivals": ["history", "raw_arrivals"], "ended_arrivals": ["history", "raw_arrivals"], "gaps": ["session"], "committable": ["session", "gaps"],
}


def _sql(body: str) -> str:
    """``body`` with the tables it names as common table expressions."""
    import re

    used: list[str] = []
    for name in _TABLES:
        if re.search(rf"\b{name}\b", body):
            used += [n for n in [*_NEEDS.get(name, []), name] if n not in used]
    order = [n for n in _TABLES if n in used]
    return ("WITH " + ",\n".join(f"{n} AS ({_TABLES[n]})" for n in order) + "\n" if order else "") + body


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = _sql(sql)
        return f

    return register


# ------------------------------------------------------------------ A sources and sinks
@query("SELECT * FROM history WHERE log_offset >= 500 ORDER BY log_offset LIMIT 100")
def history_poll(spark, d):
    return tables.poll(td.history(spark, d), 500)


@query("SELECT * FROM history WHERE log_offset >= 500")
def history_resume(spark, d):
    return tables.resume(td.history(spark, d), 500)


@query("SELECT slot, idx, kind, pubkey FROM updates WHERE slot IN (SELECT slot FROM history WHERE commitment >= 1)")
def load_slots(spark, d):
    return tables.load_slots(td.updates(spark, d), dedup.slot_worklist(td.history(spark, d), "confirmed")).select("slot", "idx", "kind", "pubkey")


@query("SELECT slot, idx, kind, pubkey FROM updates WHERE slot IN (SELECT slot FROM history WHERE commitment >= 1)")
def load_slot_ranges(spark, d):
    """The payload laid out by slot range, then read for a work-list: the scan is pruned to the ranges of its slots."""
    path = f"{stream_queries.shared_folder(spark)}/payload"
    payload = td.updates(spark, d).select("slot", "idx", "kind", "pubkey")
    tables.write_slot_ranges(payload, path, 1000)
    return tables.load_slot_ranges(spark, path, payload.schema, dedup.slot_worklist(td.history(spark, d), "confirmed"), 1000)


_ACCOUNT_LINE = "'account,' || slot || ',pk=' || pubkey || ',owner=' || owner || ',tx=' || coalesce(txn_signature, 'None')"
_STATUS = "CASE commitment WHEN 0 THEN 'processed' WHEN 1 THEN 'confirmed' WHEN 2 THEN 'finalized' END"
_SLOT_LINE = f"'slot=' || slot || ', parent=' || coalesce(CAST(CASE WHEN slot > 0 THEN slot - 1 END AS VARCHAR), 'None') || ', status=' || {_STATUS}"
_META_LINE = "'block=' || slot || ', tx_count=' || executed_transaction_count || ', entry_count=' || entries_count"


def _statuses(spark, d):
    return td.history(spark, d).withColumn("parent_slot", F.expr("CASE WHEN slot > 0 THEN slot - 1 END"))


@query(f"SELECT slot, {_ACCOUNT_LINE} AS value FROM acct UNION ALL SELECT slot, 'tx,' || slot || ',' || signature FROM tx UNION ALL SELECT slot, {_SLOT_LINE} FROM history UNION ALL SELECT slot, {_META_LINE} FROM meta")
def update_lines(spark, d):
    return sinks.update_lines(td.accounts(spark, d), td.transactions(spark, d), _statuses(spark, d), td.block_meta(spark, d))


@query("SELECT slot, signature FROM tx WHERE kind = 'transaction' AND slot IN (SELECT slot FROM complete)")
def tx_signatures(spark, d):
    return sinks.transaction_signatures(td.transactions(spark, d), _complete(spark, d))


@query("SELECT slot, slot || ' -- ' || signature || ', ' || CASE WHEN is_vote THEN 'all,votes' ELSE 'all' END || ' ' || pubkey || ',' || owner AS line FROM tx WHERE err IS NULL")
def tx_lines(spark, d):
    tagged = fl.tag(td.transactions(spark, d).where("err IS NULL"), {"all": None, "votes": F.col("is_vote")})
    return tagged.select("slot", project.rich_transaction_line().alias("line"))


@query("""SELECT '{"log_offset":"' || log_offset || '","slot":"' || slot || '","commitment":' || commitment || '}' AS json FROM history""")
def updates_json(spark, d):
    history = td.history(spark, d)
    return history.select(sinks.as_json(history, ["log_offset", "slot", "commitment"]).alias("json"))


@query("SELECT log_offset, slot, commitment, num_shards, CAST(log_offset % 4 AS INTEGER) AS blockchain_shard_id, dead_error, slot - 1 AS parent_slot FROM history WHERE slot > 0")
def declared_scan(spark, d):
    """The log written and read in its declared schema; columns and filter reach the scan."""
    path = f"{stream_queries.shared_folder(spark)}/history"
    log = td.sharded_history(spark, d).withColumn("parent_slot", F.expr("CASE WHEN slot > 0 THEN slot - 1 END"))
    tables.conform(log, schemas.HISTORY).write.parquet(path)
    read = tables.read_table(spark, path, schemas.HISTORY)
    return read.where("slot > 0").select("log_offset", "slot", "commitment", "num_shards", "blockchain_shard_id", "dead_error", "parent_slot")


# ------------------------------------------------------------------ B projections
def _envelope(spark, d):
    """Updates as one struct per kind."""
    u = td.updates(spark, d)
    of = lambda kinds, *columns: F.when(F.col("kind").isin(kinds), F.struct(*columns))
    return u.select("kind", of(["account"], "slot", "pubkey", "owner").alias("account"), of(["transaction"], "slot", "idx", "is_vote").alias("transaction"), of(["transaction_status"], "slot", "idx", "failed").alias("transaction_status"), of(["entry"], "slot", "idx").alias("entry"))


@query("SELECT slot, pubkey, owner FROM updates WHERE kind = 'account'")
def kind_split(spark, d):
    return project.split_kinds(_envelope(spark, d))["account"]


@query("SELECT kind, slot FROM updates")
def update_slot(spark, d):
    return _envelope(spark, d).select("kind", project.update_slot(["account", "transaction", "transaction_status", "entry"]).alias("slot"))


@query(f"SELECT slot, {_ACCOUNT_LINE} AS line FROM acct")
def account_lines(spark, d):
    return td.accounts(spark, d).select("slot", project.account_line().alias("line"))


@query("SELECT slot, 'tx,' || slot || ',' || signature AS line FROM tx")
def tx_lines_short(spark, d):
    return td.transactions(spark, d).select("slot", project.transaction_line().alias("line"))


@query(f"SELECT log_offset, {_SLOT_LINE} AS line FROM history")
def slot_lines(spark, d):
    return _statuses(spark, d).select("log_offset", project.slot_line().alias("line"))


@query(f"SELECT slot, {_META_LINE} AS line FROM meta")
def meta_lines(spark, d):
    return td.block_meta(spark, d).select("slot", project.meta_line().alias("line"))


@query(f"SELECT log_offset, {_STATUS} AS name, commitment >= 1 AS at_least_confirmed FROM history")
def commitment_rank(spark, d):
    return td.history(spark, d).select("log_offset", project.commitment_name(F.col("commitment")).alias("name"), (F.col("commitment") >= project.commitment_rank("confirmed")).alias("at_least_confirmed"))


@query("SELECT log_offset, ['processed', 'confirmed', 'finalized', 'first_shred_received', 'completed', 'created_bank', 'dead'][log_offset % 7 + 1] AS status FROM history")
def status_label(spark, d):
    return td.history(spark, d).select("log_offset", project.status_label(F.col("log_offset") % 7).alias("status"))


@query("SELECT slot, kind, idx FROM updates WHERE kind IN ('account', 'transaction_status', 'entry')")
def include_kinds(spark, d):
    return project.only_kinds(td.updates(spark, d), "account, txn-status, entry").select("slot", "kind", "idx")


@query("SELECT slot, pubkey, substr(data, 6, 1) || substr(data, 1, 4) || substr(data, 101, 8) AS slice FROM acct")
def data_slice(spark, d):
    return td.accounts(spark, d).select("slot", "pubkey", project.data_slice("data", [(5, 1), (0, 4), (100, 8)]).cast("string").alias("slice"))


@query("SELECT slot, signature, keys FROM tx")
def tx_keys(spark, d):
    return td.transactions(spark, d).select("slot", "signature", project.transaction_keys().alias("keys"))


@query("SELECT slot, signature, kind, err IS NULL AS success FROM tx")
def tx_success(spark, d):
    return td.transactions(spark, d).select("slot", "signature", "kind", project.transaction_success().alias("success"))


def _base58(x: str) -> str:
    """SQL of the base58 text of a number's eight bytes: a 1 for each leading zero byte, then the digits."""
    digits = " || ".join(f"substr('{project._ALPHABET}', ({x} // {58**k}) % 58 + 1, 1)" for k in range(10, -1, -1))
    return f"repeat('1', 8 - CASE WHEN {x} = 0 THEN 0 ELSE (length(hex({x})) + 1) // 2 END) || ltrim({digits}, '1')"


@query(f"SELECT slot, idx, {_base58('pubkey')} AS pubkey, {_base58('owner')} AS owner FROM updates")
def normalize_keys(spark, d):
    keys = td.updates(spark, d).select("slot", "idx", F.expr("unhex(lpad(hex(pubkey), 16, '0'))").alias("pubkey"), F.expr("unhex(lpad(hex(owner), 16, '0'))").alias("owner"))
    return project.normalize_keys(keys, ["pubkey", "owner"]).select("slot", "idx", "pubkey", "owner")


@query("SELECT slot, signature, is_vote, idx AS index, err FROM tx WHERE kind = 'transaction'")
def tx_to_status(spark, d):
    return project.transaction_status(td.transactions(spark, d).where("kind = 'transaction'"))


@query("SELECT slot, pubkey, NULL AS signature FROM acct UNION ALL SELECT slot, NULL, signature FROM tx")
def merge_kinds(spark, d):
    return project.merge_kinds(td.accounts(spark, d).select("slot", "pubkey"), td.transactions(spark, d).select("slot", "signature"))


# ------------------------------------------------------------------ C filters
def _account_filter(f: fl.AccountFilter, *columns: str):
    return lambda spark, d: td.accounts(spark, d).where(f.predicate()).select("slot", "pubkey", "owner", "lamports")


def _accounts(name: str, condition: str, f: fl.AccountFilter) -> None:
    QUERIES[name] = _account_filter(f)
    ORACLE_SQL[name] = _sql(f"SELECT slot, pubkey, owner, lamports FROM acct WHERE {condition}")


_accounts("acct_pubkey", "pubkey IN (1, 2, 3, 50)", fl.AccountFilter(pubkeys=(1, 2, 3, 50)))
_accounts("acct_owner", "owner IN (1, 2, 3)", fl.AccountFilter(owners=(1, 2, 3)))
_accounts("acct_memcmp", "starts_with(data, 'acct-3') AND substr(data, 5, 1) = '-'", fl.AccountFilter(memcmp=(fl.Memcmp(0, b"acct-3"), fl.Memcmp(4, base64="LQ=="))))
_accounts("acct_memcmp_base58", "starts_with(data, 'acct-2')", fl.AccountFilter(memcmp=(fl.Memcmp(0, base58="qVoDagY9"),)))  # acct-2
_accounts("acct_datasize", "strlen(data) = 20", fl.AccountFilter(datasize=20))
_accounts("acct_token_state", "strlen(data) >= 165", fl.AccountFilter(token_account_state=True))
_accounts("acct_lamports", "lamports > 10000 AND lamports < 40000 AND lamports <> 20000", fl.AccountFilter(lamports=(("gt", 10000), ("lt", 40000), ("ne", 20000))))
_accounts("acct_has_sig", "txn_signature IS NOT NULL", fl.AccountFilter(nonempty_txn_signature=True))


def _transactions(name: str, condition: str, f: fl.TransactionFilter) -> None:
    QUERIES[name] = lambda spark, d: td.transactions(spark, d).where(f.predicate()).select("slot", "idx", "signature")
    ORACLE_SQL[name] = _sql(f"SELECT slot, idx, signature FROM tx WHERE {condition}")


_transactions("tx_vote_failed", "NOT is_vote AND err IS NOT NULL", fl.TransactionFilter(vote=False, failed=True))
_transactions("tx_include", "list_has_any(keys, [1, 2, 77])", fl.TransactionFilter(account_include=(1, 2, 77)))
_transactions("tx_exclude", "NOT list_has_any(keys, [1, 2, 77])", fl.TransactionFilter(account_exclude=(1, 2, 77)))
_transactions("tx_required", "list_has_all(keys, [1, 2])", fl.TransactionFilter(account_required=(1, 2)))
_transactions("tx_expand_all", "list_has_any(list_concat(keys, [pubkey % 20, 100 + owner % 20]), [103, 7])", fl.TransactionFilter(account_include=(103, 7), token_accounts="all"))
_transactions("tx_expand_changed", "list_has_any(keys, [103, 7]) OR (idx % 2 = 1 AND pubkey % 20 = 7) OR (pubkey % 3 = 0 AND 100 + owner % 20 = 103)", fl.TransactionFilter(account_include=(103, 7), token_accounts="changed"))
_transactions("deshred_filter", "NOT is_vote AND list_has_any(keys, [1, 2, 3]) AND NOT list_has_any(keys, [9])", fl.TransactionFilter(vote=False, account_include=(1, 2, 3), account_exclude=(9,)))
QUERIES["deshred_filter"] = lambda spark, d: td.transactions(spark, d).where(fl.DeshredFilter(vote=False, account_include=(1, 2, 3), account_exclude=(9,)).predicate()).select("slot", "idx", "signature")


@query("SELECT slot, idx, signature FROM tx WHERE signature IN (SELECT min(signature) FROM tx)")
def tx_signature(spark, d):
    transactions = td.transactions(spark, d)
    wanted = transactions.agg(F.min("signature")).first()[0]
    return transactions.where(fl.TransactionFilter(signature=wanted).predicate()).select("slot", "idx", "signature")


@query("SELECT slot, idx, kind, list_filter([CASE WHEN kind = 'account' AND owner < 20 THEN 'owners' END, CASE WHEN kind = 'entry' THEN 'entries' END, CASE WHEN kind = 'transaction' AND NOT is_vote THEN 'calls' END, CASE WHEN kind = 'transaction' AND failed THEN 'failed' END], lambda x: x IS NOT NULL) AS filters FROM updates WHERE (kind = 'account' AND owner < 20) OR kind = 'entry' OR (kind = 'transaction' AND (NOT is_vote OR failed))")
def filter_tag(spark, d):
    return _tagged(spark, d).select("slot", "idx", "kind", "filters")


def _tagged(spark, d):
    kind = lambda k: F.col("kind") == k
    return fl.tag(td.updates(spark, d), {"owners": kind("account") & (F.col("owner") < 20), "entries": kind("entry"), "calls": kind("transaction") & ~F.col("is_vote"), "failed": kind("transaction") & F.col("failed")})


@query("SELECT slot, kind, idx FROM updates WHERE kind IN ('account', 'entry')")
def filter_kinds(spark, d):
    request = fl.Subscription(accounts={"all": fl.AccountFilter()}, entries={"all": None})
    return td.updates(spark, d).where(F.col("kind").isin(request.kinds())).select("slot", "kind", "idx")


@query("SELECT slot, pubkey, owner, list_filter([CASE WHEN pubkey IN (5, 6) OR pubkey = 7 THEN 'first' END, CASE WHEN pubkey = 8 THEN 'default' END], lambda x: x IS NOT NULL) AS filters FROM acct WHERE pubkey IN (5, 6, 7, 8)")
def acct_multi(spark, d):
    named = fl.merge_specs(["first:5", "first:6", "8", "first:7"])
    return fl.tag(td.accounts(spark, d), {n: fl.AccountFilter(pubkeys=[int(k) for k in keys]).predicate() for n, keys in named.items()}).select("slot", "pubkey", "owner", "filters")


@query("SELECT slot, pubkey, owner FROM acct WHERE pubkey IN (SELECT p_partkey FROM part WHERE p_partkey % 3 = 1)")
def acct_bigset(spark, d):
    keys = spark.read.parquet(f"{d}/part.parquet").where("p_partkey % 3 = 1").select(F.col("p_partkey").alias("key"))
    return fl.in_table(td.accounts(spark, d), "pubkey", keys).select("slot", "pubkey", "owner")


@query("SELECT slot, signature, is_vote, idx AS index, err FROM tx WHERE NOT is_vote AND list_has_any(keys, [1, 2, 3])")
def txstatus_filter(spark, d):
    wanted = fl.TransactionFilter(vote=False, account_include=(1, 2, 3))
    return project.transaction_status(td.transactions(spark, d).where(wanted.predicate()))


@query("SELECT log_offset, slot, commitment FROM history WHERE commitment = 1")
def slot_filter(spark, d):
    return td.history(spark, d).where(fl.SlotFilter(filter_by_commitment=True).predicate("confirmed")).select("log_offset", "slot", "commitment")


@query("SELECT log_offset, log_offset % 7 AS status FROM history WHERE log_offset % 7 <= 2")
def slot_interslot(spark, d):
    return td.history(spark, d).select("log_offset", (F.col("log_offset") % 7).alias("status")).where(fl.SlotFilter(interslot_updates=False).predicate(status="status"))


@query("SELECT b.slot, coalesce(t.n, 0) AS transactions, coalesce(a.n, 0) AS accounts FROM (SELECT DISTINCT slot FROM updates) b LEFT JOIN (SELECT slot, count(*) AS n FROM tx WHERE list_has_any(keys, [1, 2, 3]) GROUP BY slot) t USING (slot) LEFT JOIN (SELECT slot, count(*) AS n FROM acct WHERE pubkey IN (1, 2, 3) GROUP BY slot) a USING (slot)")
def block_filter(spark, d):
    tx = td.transactions(spark, d).select("slot", F.struct("signature", project.transaction_keys().alias("keys")).alias("t")).groupBy("slot").agg(F.collect_list("t").alias("transactions"))
    accounts = td.accounts(spark, d).select("slot", F.struct("pubkey", "owner").alias("a")).groupBy("slot").agg(F.collect_list("a").alias("accounts"))
    entries = td.updates(spark, d).groupBy("slot").agg(F.collect_list(F.when(F.col("kind") == "entry", F.struct("idx"))).alias("entries"))
    blocks = entries.join(tx, "slot", "left").join(accounts, "slot", "left")
    found = fl.BlockFilter(account_include=(1, 2, 3), include_accounts=True).apply(blocks)
    count = lambda c: F.coalesce(F.when(F.col(c).isNotNull(), F.size(c)), F.lit(0)).cast("long").alias(c)
    return found.select("slot", count("transactions"), count("accounts"))


@query("SELECT slot, 'block_meta' AS kind, ['metas'] AS filters FROM meta UNION ALL SELECT slot, kind, ['entries'] FROM updates WHERE kind = 'entry'")
def meta_entry_all(spark, d):
    metas = fl.tag(td.block_meta(spark, d).select("slot", F.lit("block_meta").alias("kind")), {"metas": None})
    return metas.unionByName(fl.tag(td.updates(spark, d).where("kind = 'entry'").select("slot", "kind"), {"entries": None}))


@query("SELECT log_offset, slot, commitment FROM history WHERE commitment >= 1")
def min_commitment(spark, d):
    return fl.at_least(td.history(spark, d), "confirmed").select("log_offset", "slot", "commitment")


@query("SELECT log_offset, slot FROM history WHERE slot >= 100")
def from_slot(spark, d):
    return fl.from_slot(td.history(spark, d), 100).select("log_offset", "slot")


@query("SELECT u.slot, u.idx, u.kind, s.s_suppkey AS version FROM updates u JOIN supplier s ON u.slot >= s.s_suppkey * 10 AND u.slot < s.s_suppkey * 10 + 10")
def filter_asof(spark, d):
    versions = spark.read.parquet(f"{d}/supplier.parquet").selectExpr("s_suppkey AS version", "s_suppkey * 10 AS effective_from", "s_suppkey * 10 + 10 AS effective_to")
    return fl.with_versions(td.updates(spark, d).select("slot", "idx", "kind"), versions)


@query("SELECT log_offset, slot, dead_error FROM history WHERE dead_error IS NOT NULL")
def dead_slots(spark, d):
    return fl.dead_slots(td.history(spark, d)).select("log_offset", "slot", "dead_error")


# ------------------------------------------------------------------ D dedup
_KEY = "CASE WHEN kind IN ('transaction', 'transaction_status') THEN 'transaction' ELSE kind END, CASE WHEN kind = 'account' THEN pubkey ELSE idx END, CASE WHEN kind = 'account' THEN idx END"


@query(f"SELECT slot, shard_idx, kind, idx, pubkey, arrival FROM (SELECT *, row_number() OVER (PARTITION BY slot, shard_idx, {_KEY} ORDER BY arrival) AS n FROM updates) WHERE n = 1")
def dedup_updates(spark, d):
    return dedup.dedup_updates(td.updates(spark, d, True), "idx").select("slot", "shard_idx", "kind", "idx", "pubkey", "arrival")


@query("SELECT slot, shard_idx, kind, arrival FROM updates JOIN finish USING (slot, shard_idx) WHERE arrival > finish_arrival")
def late_after_finish(spark, d):
    return dedup.before_finish(td.updates(spark, d, True), td.shard_finish(spark, d), late=True).select("slot", "shard_idx", "kind", "arrival")


@query("SELECT log_offset, slot, commitment, row_number() OVER (PARTITION BY slot, commitment ORDER BY log_offset) = 1 AS is_first FROM history")
def dedup_status(spark, d):
    return dedup.dedup_status(td.history(spark, d)).select("log_offset", "slot", "commitment", "is_first")


@query("SELECT slot, min(log_offset) AS log_offset, arg_min(num_shards, log_offset) AS num_shards FROM history WHERE commitment >= 1 GROUP BY slot")
def slot_worklist(spark, d):
    return dedup.slot_worklist(td.history(spark, d), "confirmed")


@query("SELECT slot, count(DISTINCT (pubkey, txn_signature)) AS account_updates FROM acct WHERE txn_signature IS NOT NULL GROUP BY slot")
def distinct_accounts(spark, d):
    return dedup.distinct_accounts(td.accounts(spark, d))


# ------------------------------------------------------------------ E completion
def _progress(spark, d):
    return completion.shard_progress(td.shard_finish(spark, d), td.slot_shards(spark, d))


def _complete(spark, d):
    return completion.complete_slots(_progress(spark, d))


@query("SELECT slot, num_shards, done, complete FROM progress")
def slot_complete(spark, d):
    return _progress(spark, d).select("slot", "num_shards", "done", "complete")


_GATED = "SELECT h.log_offset, h.slot, h.commitment, CASE WHEN h.commitment < 1 THEN h.log_offset WHEN c.complete_arrival IS NOT NULL THEN greatest(h.log_offset, c.complete_arrival) END AS release_arrival FROM history h LEFT JOIN complete c USING (slot)"


def _gated(spark, d):
    return completion.gate_statuses(td.history(spark, d), _complete(spark, d), "confirmed")


@query(f"SELECT *, release_arrival IS NOT NULL AS released FROM ({_GATED})")
def status_gated(spark, d):
    return _gated(spark, d).select("log_offset", "slot", "commitment", "release_arrival", "released")


@query("SELECT slot, 0 AS rank, arrival, kind AS event FROM updates WHERE slot IN (SELECT slot FROM complete) UNION ALL SELECT slot, 1, complete_arrival, 'block_meta' FROM meta JOIN complete USING (slot) UNION ALL SELECT slot, 2, complete_arrival, 'ended' FROM complete")
def slot_end_order(spark, d):
    return completion.slot_end_order(td.updates(spark, d, True), td.block_meta(spark, d), _complete(spark, d))


@query("SELECT slot, executed_transaction_count, entries_count FROM meta JOIN complete USING (slot)")
def meta_release(spark, d):
    return completion.release_meta(td.block_meta(spark, d), _complete(spark, d)).select("slot", "executed_transaction_count", "entries_count")


@query("SELECT slot FROM meta WHERE slot NOT IN (SELECT slot FROM updates)")
def missing_slots(spark, d):
    return completion.missing_slots(td.block_meta(spark, d), td.updates(spark, d))


@query("SELECT slot, done, num_shards, done / num_shards AS filled FROM progress WHERE NOT complete")
def incomplete_slots(spark, d):
    return completion.incomplete_slots(_progress(spark, d))


@query(f"SELECT log_offset, slot, commitment FROM ({_GATED}) WHERE release_arrival IS NULL")
def blocked_status(spark, d):
    return completion.blocked_statuses(_gated(spark, d)).select("log_offset", "slot", "commitment")


@query("SELECT slot FROM (SELECT slot, dense_rank() OVER (ORDER BY slot DESC) AS r FROM updates) WHERE r <= 500 GROUP BY slot")
def slot_retention(spark, d):
    return completion.retained_slots(td.updates(spark, d), 500)


# ------------------------------------------------------------------ F progress
_START = "SELECT consumer, min(log_offset) - 1 AS committed FROM session GROUP BY consumer"


def _start(spark, d):
    return td.session(spark, d).groupBy("consumer").agg((F.min("log_offset") - 1).alias("committed"))


@query(f"SELECT consumer, coalesce(greatest(committable, committed), committed) AS committable FROM committable JOIN ({_START}) USING (consumer)")
def committable_offset(spark, d):
    return progress.committable_offsets(td.session(spark, d), _start(spark, d))


@query("SELECT consumer, max(log_offset) AS committable FROM (SELECT s.*, min(log_offset) FILTER (NOT done) OVER (PARTITION BY consumer) AS gap FROM (SELECT *, processed OR log_offset % 3 = 0 AS done FROM session) s) WHERE gap IS NULL OR log_offset < gap GROUP BY consumer UNION ALL SELECT consumer, NULL FROM session GROUP BY consumer HAVING arg_min(processed OR log_offset % 3 = 0, log_offset) = false")
def committable_late(spark, d):
    """Commit offsets where acknowledgements of gaps are rows of their own."""
    columns = ["consumer", "log_offset", "processed"]
    rows = td.session(spark, d).select(columns).unionByName(td.late_acknowledgements(spark, d).select(columns))
    return progress.committable_offsets(progress.settled(rows))


@query("SELECT consumer, count(*) FILTER (processed AND log_offset > gap) AS blocked FROM session JOIN gaps USING (consumer) GROUP BY consumer")
def blocked_acks(spark, d):
    return progress.blocked_acks(td.session(spark, d))


@query(f"SELECT consumer, greatest(committed, coalesce(committable, committed)) AS committed, coalesce(committable > committed, false) AS written FROM committable JOIN ({_START}) USING (consumer)")
def commit_apply(spark, d):
    return progress.apply_commits(_start(spark, d), progress.committable_offsets(td.session(spark, d)))


@query(f"SELECT consumer, committed, coalesce(greatest(committable, committed), committed) AS committable, max_slot, blocked FROM ({_START}) JOIN committable USING (consumer) JOIN (SELECT consumer, max(slot) AS max_slot, count(*) FILTER (processed AND log_offset > gap) AS blocked FROM session JOIN gaps USING (consumer) GROUP BY consumer) USING (consumer)")
def session_stats(spark, d):
    return progress.session_stats(td.session(spark, d), _start(spark, d))


# ------------------------------------------------------------------ G regrouping
@query("""SELECT a.arrival, a.slot, a.event, a.kind, CASE WHEN s.n = 1 THEN a.arrival WHEN s.open IS NOT NULL THEN greatest(a.arrival, s.open) END AS emit, s.first_seen
  FROM arrivals a JOIN (
    SELECT slot, first_seen, row_number() OVER (ORDER BY first_seen) AS n,
      CASE WHEN bool_and("end" IS NOT NULL) OVER w THEN max("end") OVER w END AS open
    FROM (SELECT slot, min(arrival) AS first_seen, min(arrival) FILTER (event = 'ended') AS "end" FROM arrivals WHERE event = 'ended' OR kind NOT IN ('slot_status', 'block_meta') GROUP BY slot)
    WINDOW w AS (ORDER BY first_seen ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) s USING (slot)
  WHERE a.event = 'ended' OR a.kind NOT IN ('slot_status', 'block_meta')
  UNION ALL SELECT arrival, slot, event, kind, arrival, 0 FROM arrivals WHERE event = 'data' AND kind IN ('slot_status', 'block_meta')""")
def slot_sequential(spark, d):
    return adapters.slot_sequential(td.arrivals(spark, d), width=2000)


@query("SELECT e.slot, e.arrival AS end_arrival, count(d.arrival) AS updates, min(d.arrival) AS first_arrival FROM arrivals e LEFT JOIN arrivals d ON d.slot = e.slot AND d.event = 'data' AND d.kind <> 'slot_status' WHERE e.event = 'ended' GROUP BY e.slot, e.arrival")
def block_group(spark, d):
    return adapters.block_stream(td.arrivals(spark, d)).select("slot", "end_arrival", F.size("updates").cast("long").alias("updates"), F.get("updates", F.lit(0))["arrival"].alias("first_arrival"))


@query("SELECT arrival, slot, kind FROM arrivals WHERE event = 'data'")
def plain_updates(spark, d):
    return adapters.plain_updates(td.arrivals(spark, d)).select("arrival", "slot", "kind")


# ------------------------------------------------------------------ H statistics
_STATS = "SELECT slot, count(*) FILTER (kind IN ('transaction', 'transaction_status') AND NOT failed) AS good_tx, count(*) FILTER (kind IN ('transaction', 'transaction_status') AND failed) AS failed_tx, count(*) FILTER (kind IN ('transaction', 'transaction_status')) AS total_tx, count(*) FILTER (kind = 'entry') AS entries, count(*) FILTER (kind = 'account') AS account_updates, any_value(executed_transaction_count) AS expected_tx, any_value(entries_count) AS expected_entries FROM updates JOIN meta USING (slot) GROUP BY slot"


@query(_STATS)
def block_stats(spark, d):
    return stats.block_stats(td.updates(spark, d), td.block_meta(spark, d))


@query("""SELECT m.slot, coalesce(t.good_tx, 0) AS good_tx, coalesce(t.failed_tx, 0) AS failed_tx, coalesce(e.n, 0) AS entries, coalesce(a.n, 0) AS account_updates, m.executed_transaction_count, m.entries_count
  FROM meta m LEFT JOIN (SELECT slot, count(DISTINCT signature) FILTER (err IS NULL) AS good_tx, count(DISTINCT signature) FILTER (err IS NOT NULL) AS failed_tx FROM tx GROUP BY slot) t USING (slot)
  LEFT JOIN (SELECT slot, count(*) AS n FROM updates WHERE kind = 'entry' GROUP BY slot) e USING (slot)
  LEFT JOIN (SELECT slot, count(DISTINCT (pubkey, txn_signature)) AS n FROM acct WHERE txn_signature IS NOT NULL GROUP BY slot) a USING (slot)
  WHERE m.status IN ('F', 'P')""")
def block_stats_distinct(spark, d):
    meta = td.block_meta(spark, d)
    return stats.block_stats_distinct(td.transactions(spark, d), td.accounts(spark, d), td.updates(spark, d).where("kind = 'entry'"), meta.where("status IN ('F', 'P')"), meta)


@query("""SELECT * FROM (WITH spans AS (SELECT slot, CASE WHEN slot % 7 > 0 THEN 1 + slot % 2 END AS opened_at, max(arrival) + 1 - slot % 3 AS closed_at FROM updates GROUP BY slot),
  inside AS (SELECT *, slot || '-' || idx || '-' || pubkey AS signature FROM updates JOIN spans USING (slot) WHERE arrival >= opened_at AND arrival < closed_at)
  SELECT m.slot, count(DISTINCT signature) FILTER (kind IN ('transaction', 'transaction_status') AND NOT failed) AS good_tx, count(DISTINCT signature) FILTER (kind IN ('transaction', 'transaction_status') AND failed) AS failed_tx,
    count(*) FILTER (kind = 'entry') AS entries, count(DISTINCT (pubkey, i.slot)) FILTER (kind = 'account' AND idx = 5) AS account_updates, m.executed_transaction_count, m.entries_count
  FROM meta m JOIN spans s ON s.slot = m.slot AND s.opened_at < s.closed_at LEFT JOIN inside i ON i.slot = m.slot GROUP BY m.slot, m.executed_transaction_count, m.entries_count)""")
def block_stats_opened(spark, d):
    """Only what arrived between the opening of a block and its metadata counts."""
    return stats.block_stats_between(td.block_updates(spark, d), td.block_spans(spark, d), td.block_meta(spark, d))


@query("SELECT map_from_entries(list((shard, o) ORDER BY shard)) AS offsets, max(o) AS tip FROM (SELECT CAST(log_offset % 4 AS INTEGER) AS shard, max(log_offset) AS o FROM history GROUP BY 1)")
def chain_tip(spark, d):
    return stats.chain_tip(td.sharded_history(spark, d))


@query("SELECT min(slot) AS min_slot, max(slot) AS max_slot FROM history")
def slot_range(spark, d):
    return stats.slot_range(td.history(spark, d))


@query(f"SELECT slot, total_tx = expected_tx AS tx_ok, entries = expected_entries AS entries_ok, total_tx = expected_tx AND entries = expected_entries AS intact FROM ({_STATS})")
def block_integrity(spark, d):
    return stats.block_integrity(block_stats(spark, d))


@query("SELECT slot, count(*) AS updates, CAST(epoch(max(created_at)) - epoch(min(created_at)) AS BIGINT) AS seconds FROM updates GROUP BY slot")
def slot_elapsed(spark, d):
    return stats.slot_elapsed(td.updates(spark, d))


@query("SELECT name, greatest(0, tip - committed_offset) AS lag FROM grp, (SELECT max(log_offset) AS tip FROM history)")
def offset_lag(spark, d):
    return stats.offset_lag(td.consumer_groups(spark, d), stats.chain_tip(td.sharded_history(spark, d)))


@query("SELECT * FROM (SELECT count(*) AS events, count(*) FILTER (processed) AS processed, count(*) FILTER (NOT processed) AS skipped FROM session), (SELECT count(DISTINCT slot) AS slots, count(*) FILTER (commitment = 0) AS processed_statuses, count(*) FILTER (commitment = 1) AS confirmed_statuses, count(*) FILTER (commitment = 2) AS finalized_statuses FROM history)")
def session_counters(spark, d):
    return stats.session_counters(td.session(spark, d), td.history(spark, d))


@query(f"SELECT * FROM (SELECT count(*) FILTER (written) AS commits, count(*) FILTER (NOT written) AS skipped_commits FROM (SELECT coalesce(committable > committed, false) AS written FROM committable JOIN ({_START}) USING (consumer))), (SELECT CAST(sum((n + 99) // 100) AS BIGINT) AS polls, CAST(sum(failed) AS BIGINT) AS failed_attempts FROM (SELECT count(*) AS n, count(*) FILTER (NOT processed) AS failed FROM session GROUP BY consumer))")
def commit_counters(spark, d):
    return stats.commit_counters(commit_apply(spark, d), td.session(spark, d))


_BOUNDS = ", ".join(f"({b})" for b in stats.SLOT_BUCKETS)


@query(f"SELECT le, count(*) FILTER (le IS NULL OR lamports <= le * 50) AS count FROM (VALUES {_BOUNDS}, (NULL)) b(le), updates GROUP BY le")
def duration_hist(spark, d):
    durations = td.updates(spark, d).select((F.col("lamports") / 50).alias("ms"))
    return stats.duration_histogram(durations, "ms", stats.SLOT_BUCKETS)


_SHARD_BOUNDS = ", ".join(f"({b})" for b in stats.SHARD_BUCKETS)


@query(f"SELECT le, count(*) FILTER (le IS NULL OR ms <= le) AS count FROM (VALUES {_SHARD_BOUNDS}, (NULL)) b(le), (SELECT sum(lamports) / 100 AS ms FROM updates GROUP BY slot, shard_idx) GROUP BY le")
def shard_duration_hist(spark, d):
    durations = td.updates(spark, d).groupBy("slot", "shard_idx").agg((F.sum("lamports") / 100).alias("ms"))
    return stats.duration_histogram(durations, "ms", stats.SHARD_BUCKETS)


@query("SELECT *, started - ended AS in_flight FROM (SELECT count(*) AS started FROM shards), (SELECT count(*) AS ended FROM complete)")
def inflight(spark, d):
    return stats.in_flight(td.slot_shards(spark, d), _complete(spark, d))


@query("SELECT kind, count(*) AS updates FROM updates GROUP BY kind")
def kind_counts(spark, d):
    return stats.kind_counts(td.updates(spark, d))


@query("SELECT filter, count(*) AS updates FROM (SELECT unnest(list_filter([CASE WHEN kind = 'account' AND owner < 20 THEN 'owners' END, CASE WHEN kind = 'entry' THEN 'entries' END, CASE WHEN kind = 'transaction' AND NOT is_vote THEN 'calls' END, CASE WHEN kind = 'transaction' AND failed THEN 'failed' END], lambda x: x IS NOT NULL)) AS filter FROM updates) GROUP BY filter")
def filter_counts(spark, d):
    return stats.filter_counts(_tagged(spark, d))


@query("SELECT CAST(shard_idx % 4 AS INTEGER) AS lane, count(*) AS updates, count(DISTINCT slot) AS slots FROM updates GROUP BY 1")
def lane_load(spark, d):
    return stats.lane_load(td.updates(spark, d))


# ------------------------------------------------------------------ I rates
_RATE = "SELECT tick, coalesce(n, 0) AS blocks FROM (SELECT unnest(range(CAST(min(CAST(floor(epoch(block_time) / 3600) AS BIGINT) * 3600) AS BIGINT), CAST(max(CAST(floor(epoch(block_time) / 3600) AS BIGINT) * 3600) AS BIGINT) + 1, 3600)) AS tick FROM meta) LEFT JOIN (SELECT CAST(floor(epoch(block_time) / 3600) AS BIGINT) * 3600 AS tick, count(*) AS n FROM meta GROUP BY 1) USING (tick)"


@query(_RATE)
def block_rate(spark, d):
    """Block times span years, so the ticks here are hours."""
    return stats.block_rate(td.block_meta(spark, d), "block_time", 3600)


@query(f"SELECT tick, blocks, sum(blocks) OVER (ORDER BY tick ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) / 5 AS average FROM ({_RATE})")
def block_rate_sma(spark, d):
    return stats.block_rate_average(block_rate(spark, d), 5, 3600)


# ------------------------------------------------------------------ J, N
@query("SELECT a.slot, a.txn_signature, a.pubkey, a.owner, t.idx AS tx_index, t.err FROM acct a JOIN tx t ON t.slot = a.slot AND t.signature = a.txn_signature")
def account_tx(spark, d):
    return stats.account_transactions(td.accounts(spark, d), td.transactions(spark, d)).select("slot", "txn_signature", "pubkey", "owner", "tx_index", "err")


@query("SELECT coalesce(min(log_offset) FILTER (slot >= 200), max(log_offset)) AS initial_offset FROM history")
def group_initial_offset(spark, d):
    return groups.initial_offset(td.history(spark, d), 200)


@query("SELECT max(log_offset) AS initial_offset FROM history")
def group_initial_latest(spark, d):
    return groups.initial_offset(td.history(spark, d))


@query("SELECT max(name) AS name, true AS refused FROM grp")
def group_duplicate(spark, d):
    """Creating a group under a name that is taken is refused."""
    table = td.consumer_groups(spark, d)
    taken = table.agg(F.max("name").alias("name"))
    try:
        groups.create(table, td.history(spark, d), taken.first()[0])
    except ValueError:
        return taken.withColumn("refused", F.lit(True))
    return taken.withColumn("refused", F.lit(False))


@query("SELECT * FROM grp WHERE name = (SELECT min(name) FROM grp)")
def group_info(spark, d):
    table = td.consumer_groups(spark, d)
    return groups.info(table, table.agg(F.min("name")).first()[0])


@query("SELECT id, name, committed_offset, committed_offset < 1000 AS is_stale FROM grp")
def group_stale(spark, d):
    return groups.stale(td.consumer_groups(spark, d), 1000)


@query("SELECT id AS uid, name, committed_offset < 1000 AS stale FROM grp")
def group_list(spark, d):
    return groups.listing(groups.stale(td.consumer_groups(spark, d), 1000))


@query("SELECT * FROM grp WHERE committed_offset >= 1000")
def group_delete(spark, d):
    table = td.consumer_groups(spark, d)
    return groups.delete(table, table.where("committed_offset < 1000"))


@query("SELECT * FROM grp WHERE committed_offset >= 1000")
def group_delete_version(spark, d):
    """Groups as a versioned table: deletion is a new version, and readers take the newest finished one."""
    path = f"{stream_queries.shared_folder(spark)}/groups"
    versions.write(td.consumer_groups(spark, d), path)
    table = versions.read(spark, path, td.consumer_groups(spark, d).schema)
    versions.write(groups.delete(table, table.where("committed_offset < 1000")), path)
    return versions.read(spark, path, table.schema)


# ------------------------------------------------------------------ M streams
QUERIES.update(stream_queries.QUERIES)
ORACLE_SQL.update({name: _sql(sql) for name, sql in stream_queries.SQL.items()})
