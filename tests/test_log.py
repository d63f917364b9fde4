"""Traces and small tables with known results."""

import pytest
from pyspark.sql import functions as F

from slotstream.functions import filters as fl
from slotstream.functions import project
from slotstream.operators import adapters, completion, dedup, groups, progress, stats
from slotstream.sources import sinks

ARRIVALS = "arrival bigint, slot bigint, event string, kind string"
KINDS = {"d": ("data", "entry"), "s": ("data", "slot_status"), "m": ("data", "block_meta"), "e": ("ended", None)}


def trace(spark, text):
    return spark.createDataFrame([(i, int(x[1:]), *KINDS[x[0]]) for i, x in enumerate(text.split(), 1)], ARRIVALS)


def text_of(row):
    return next(k for k, v in KINDS.items() if v == (row.event, row.kind)) + str(row.slot)


@pytest.mark.parametrize(
    ("arrivals", "expected"),
    [
        ("d2 d1 d2 e2 d1 e1", "d2 d2 e2 d1 d1 e1"),
        ("d2 d1 e1 e2", "d2 e2 d1 e1"),
        ("d2 d1 s99 m100 e2 e1", "d2 s99 m100 e2 d1 e1"),
        ("d1 d2 e2 d3 e3", "d1"),
        ("d1 e1", "d1 e1"),
    ],
)
@pytest.mark.parametrize("width", [1, 2, 1000])
def test_slot_sequential(spark, arrivals, expected, width):
    out = adapters.slot_sequential(trace(spark, arrivals), width).where("emit IS NOT NULL").orderBy("emit", "first_seen", "arrival").collect()
    assert " ".join(map(text_of, out)) == expected


def test_blocks(spark):
    rows = {r.slot: r for r in adapters.block_stream(trace(spark, "d2 s99 m2 d1 e2 d2 e3")).collect()}
    assert sorted(rows) == [2, 3]
    assert [(u.arrival, u.kind) for u in rows[2].updates] == [(1, "entry"), (3, "block_meta"), (6, "entry")]
    assert rows[3].updates == []
    assert adapters.block_rows(trace(spark, "d2 d1 e2")).count() == 1
    assert adapters.plain_updates(trace(spark, "d2 e2 s1")).count() == 2


UPDATE = "slot bigint, shard_idx int, kind string, idx bigint, pubkey bigint, arrival bigint"


def test_dedup_updates(spark):
    rows = [(42, 0, "entry", 7, None, 1), (42, 0, "entry", 7, None, 2), (42, 1, "entry", 7, None, 3), (42, 0, "transaction", 7, None, 4), (42, 0, "transaction_status", 7, None, 5), (42, 0, "slot_status", 1, None, 6), (42, 0, "account", 1, 5, 7), (42, 0, "account", 2, 5, 8)]
    assert sorted(r.arrival for r in dedup.dedup_updates(signature="idx", updates=spark.createDataFrame(rows, UPDATE)).collect()) == [1, 3, 4, 7, 8]


HISTORY = "log_offset bigint, slot bigint, commitment int, num_shards int"


def test_status_dedup_and_worklist(spark):
    history = spark.createDataFrame([(1, 1, 0, 4), (2, 1, 0, 4), (3, 1, 1, 4), (4, 2, 2, 4)], HISTORY)
    assert [r.is_first for r in dedup.dedup_status(history).orderBy("log_offset").collect()] == [True, False, True, True]
    assert [tuple(r) for r in dedup.slot_worklist(history, "confirmed").orderBy("slot").collect()] == [(1, 3, 4), (2, 4, 4)]
    assert dedup.first_statuses(history).count() == 3


def test_completion_and_gate(spark):
    shards = spark.createDataFrame([(1, 2), (2, 2), (3, 1)], "slot bigint, num_shards int")
    finish = spark.createDataFrame([(1, 0, 5), (1, 3, 9), (2, 0, 4), (2, 2, 6)], "slot bigint, shard_idx int, finish_arrival bigint")
    done = completion.shard_progress(finish, shards)
    assert {r.slot: (r.done, r.complete, r.complete_arrival) for r in done.collect()} == {1: (2, True, 9), 2: (1, False, None), 3: (0, False, None)}
    statuses = spark.createDataFrame([(1, 1, 1, 2), (10, 1, 2, 2), (2, 2, 1, 2), (3, 2, 0, 2)], HISTORY)
    gated = {(r.slot, r.commitment): r.release_arrival for r in completion.gate_statuses(statuses, completion.complete_slots(done), "confirmed").collect()}
    assert gated == {(1, 1): 9, (1, 2): 10, (2, 1): None, (2, 0): 3}
    assert {r.slot: r.filled for r in completion.incomplete_slots(done).collect()} == {2: 0.5, 3: 0.0}


@pytest.mark.parametrize(
    ("events", "committed", "expected", "blocked"),
    [([(1, True), (2, True)], 0, 2, 0), ([(1, False), (2, True)], 0, 0, 1), ([(1, True), (2, False), (3, True), (4, True)], 0, 1, 2), ([(5, False)], 7, 7, 0)],
)
def test_committable(spark, events, committed, expected, blocked):
    session = spark.createDataFrame([(1, o, 3, p) for o, p in events], "consumer bigint, log_offset bigint, slot bigint, processed boolean")
    start = spark.createDataFrame([(1, committed)], "consumer bigint, committed bigint")
    row = progress.session_stats(session, start).first()
    assert (row.committed, row.committable, row.max_slot, row.blocked) == (committed, expected, 3, blocked)


def test_sessions_are_joined_without_a_sort(spark):
    """The gaps are hashed, so that a task's memory follows the number of groups; a group that is null has a row and no offset."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        session = spark.createDataFrame([(1, 1, 3, True), (1, 2, 4, None), (1, 3, 5, True), (None, 4, 5, True)], "consumer bigint, log_offset bigint, slot bigint, processed boolean")
        acks = progress.blocked_acks(session)
        plan = acks._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "Sort" not in plan
        assert [tuple(r) for r in acks.collect()] == [(1, 1)]
        assert sorted(map(tuple, progress.committable_offsets(session).collect()), key=str) == [(1, 1), (None, None)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_commits_never_go_back(spark):
    old = spark.createDataFrame([(1, 5), (2, 5)], "consumer bigint, committed bigint")
    new = spark.createDataFrame([(1, 4), (2, 9), (3, 1)], "consumer bigint, committable bigint")
    assert sorted(map(tuple, progress.apply_commits(old, new).collect())) == [(1, 5, False), (2, 9, True), (3, 1, True)]


def test_names():
    assert project.commitment_rank("finalized") == 2
    assert project.include_kinds("all") == ["account", "block_meta", "entry", "slot_status", "transaction"]
    assert fl.merge_specs(["a:1", "2", "a:3"], "x") == {"a": ["1", "3"], "x": ["2"]}
    for wrong in (lambda: project.commitment_rank("rooted"), lambda: project.include_kinds("tx,txn-status"), lambda: project.include_kinds("foo"), lambda: fl.merge_specs(["a:b:c"]), lambda: fl.merge_specs([""])):
        with pytest.raises(ValueError):
            wrong()


def test_account_filters(spark):
    token = bytes(108) + b"\x01" + bytes(56)
    rows = [(1, 10, 100, b"abc", b"s"), (2, 20, 200, token, None), (3, 20, 300, bytes(165), b"")]
    accounts = spark.createDataFrame(rows, "pubkey bigint, owner bigint, lamports bigint, data binary, txn_signature binary")
    ids = lambda f: sorted(r.pubkey for r in accounts.where(f.predicate()).collect())
    assert ids(fl.AccountFilter()) == [1, 2, 3]
    assert ids(fl.AccountFilter(memcmp=(fl.Memcmp(1, b"bc"),))) == [1]
    assert ids(fl.AccountFilter(memcmp=(fl.Memcmp(0, base64="YWI="),))) == [1]
    assert ids(fl.AccountFilter(token_account_state=True)) == [2]
    assert ids(fl.AccountFilter(datasize=165)) == [2, 3]
    assert ids(fl.AccountFilter(owners=(20,), lamports=(("gt", 200),))) == [3]
    assert ids(fl.AccountFilter(nonempty_txn_signature=True)) == [1]
    assert ids(fl.AccountFilter(nonempty_txn_signature=False)) == [2, 3]
    assert accounts.select(project.data_slice("data", [(1, 1), (0, 1), (9, 5)]).alias("x")).first().x == b"ba"


BALANCE = "array<struct<account_index:int,owner:bigint,amount:string>>"


def test_token_owners(spark):
    pre = [(0, 7, "5"), (1, 8, "5"), (2, 9, "0")]
    post = [(0, 7, "6"), (1, 8, "5"), (3, 11, "0"), (4, 12, "1")]
    row = spark.createDataFrame([(pre, post)], f"pre_token_balances {BALANCE}, post_token_balances {BALANCE}").select(fl.all_owners().alias("a"), fl.changed_owners().alias("c")).first()
    assert sorted(set(row.a)) == [7, 8, 9, 11, 12]
    assert sorted(row.c) == [7, 9, 12]


def test_transaction_filters(spark):
    rows = [(1, True, None, [1, 2], [3], [4]), (2, False, "e", [5], None, None)]
    tx = spark.createDataFrame(rows, "id int, is_vote boolean, err string, static_keys array<bigint>, writable_keys array<bigint>, readonly_keys array<bigint>")
    ids = lambda **f: sorted(r.id for r in tx.where(fl.TransactionFilter(**f).predicate()).collect())
    assert ids() == [1, 2]
    assert ids(vote=True) == [1] and ids(failed=True) == [2] and ids(failed=False) == [1]
    assert ids(account_include=(4, 9)) == [1] and ids(account_exclude=(4,)) == [2]
    assert ids(account_required=(1, 3)) == [1] and ids(account_required=(1, 5)) == []
    tagged = fl.tag(tx, {"votes": F.col("is_vote"), "all": None}).orderBy("id").collect()
    assert [r.filters for r in tagged] == [["votes", "all"], ["all"]]


def test_filter_versions(spark):
    rows = spark.createDataFrame([(s,) for s in (1, 5, 9, 25)], "slot bigint")
    versions = spark.createDataFrame([("a", 0, 5), ("b", 5, None)], "version string, effective_from bigint, effective_to bigint")
    for width in (3, 1000):
        assert sorted((r.slot, r.version) for r in fl.with_versions(rows, versions, width).collect()) == [(1, "a"), (5, "b"), (9, "b"), (25, "b")]


def test_groups(spark):
    history = spark.createDataFrame([(1, 5, 0, 1), (2, 9, 0, 1)], HISTORY)
    table = spark.createDataFrame([("1", "a", 0)], "id string, name string, committed_offset bigint")
    assert [groups.initial_offset(history, s).first()[0] for s in (None, 5, 6, 99)] == [2, 1, 2, 2]
    assert groups.create(table, history, "b", 5).count() == 2
    with pytest.raises(ValueError):
        groups.create(table, history, "a")
    assert groups.info(table, "zz").isEmpty()
    assert groups.stale(table, 1).first().is_stale
    assert groups.delete(table, spark.createDataFrame([("a",), ("q",)], "name string")).isEmpty() and groups.delete(table).isEmpty()


def test_histogram_and_rates(spark):
    ms = spark.createDataFrame([(1.0,), (320.0,), (321.0,), (5000.0,), (None,)], "ms double")
    got = [(r.le, r["count"]) for r in stats.duration_histogram(ms, "ms", (320, 400)).collect()]
    assert sorted(got, key=str) == sorted([(320, 2), (400, 3), (None, 4)], key=str)
    times = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-01 00:00:03",), ("2024-01-01 00:00:03",)], "t string").select(F.to_timestamp("t").alias("created_at"))
    rates = stats.block_rate(times)
    assert [r.blocks for r in rates.orderBy("tick").collect()] == [1, 0, 0, 2]
    assert [r.average for r in stats.block_rate_average(rates, 5, chunk=2).orderBy("tick").collect()] == [0.2, 0.2, 0.2, 0.6]
    assert stats.block_rate(times.limit(0)).isEmpty()


def test_retention(spark):
    slots = spark.createDataFrame([(s,) for s in (1, 2, 2, 3)], "slot bigint")
    assert sorted(r.slot for r in completion.retained_slots(slots, 2).collect()) == [2, 3]


def test_events_of_unknown_result_are_gaps(spark):
    session = spark.createDataFrame([("a", 1, True), ("a", 2, None), ("a", 3, True), ("b", 5, True)], "consumer string, log_offset bigint, processed boolean")
    assert sorted(map(tuple, progress.committable_offsets(session).collect())) == [("a", 1), ("b", 5)]
    assert {r.consumer: r.blocked for r in progress.blocked_acks(session).collect()} == {"a": 1, "b": 0}


def test_blocks_carry_all_columns(spark):
    rows = [(2, 7, "data", "entry", b"x", {"a": 1}), (1, 7, "data", "account", None, None), (3, 7, "ended", None, None, None)]
    (block,) = adapters.block_stream(spark.createDataFrame(rows, "arrival bigint, slot bigint, event string, kind string, payload binary, extra map<string,int>")).collect()
    assert (block.slot, block.end_arrival, [(u.arrival, u.kind, u.payload and bytes(u.payload), u.extra) for u in block.updates]) == (7, 3, [(1, "account", None, None), (2, "entry", b"x", {"a": 1})])


def test_account_updates_differ_by_signature(spark):
    rows = [(1, 0, "account", 5, 9, b"s", 1), (1, 0, "account", 6, 9, b"s", 2), (1, 0, "account", 5, 9, b"t", 3), (1, 0, "entry", 5, None, None, 4), (1, 0, "entry", 5, 3, b"u", 5)]
    df = spark.createDataFrame(rows, "slot bigint, shard_idx int, kind string, idx int, pubkey bigint, txn_signature binary, arrival int")
    assert sorted(r.arrival for r in dedup.dedup_updates(df).collect()) == [1, 3, 4]


def test_changed_owners(spark):
    """Repeated indexes aside: changed, closed, new, new with nothing in it, closed with nothing in it, and unchanged."""
    balance = "array<struct<account_index:int,owner:string,amount:string>>"
    pre = [(0, "same", "5"), (1, "more", "5"), (2, "closed", "1"), (5, "closed empty", "0")]
    post = [(0, "same", "5"), (1, "more", "6"), (3, "new", "2"), (4, "new empty", "0")]
    df = spark.createDataFrame([(pre, post), ([], [])], f"pre_token_balances {balance}, post_token_balances {balance}")
    assert [sorted(r[0]) for r in df.select(fl.changed_owners()).collect()] == [["closed", "closed empty", "more", "new"], []]


def test_base58_constants(spark):
    import pytest

    for data in (b"", b"\0\0\1", b"hello", b"acct-2", bytes(range(40))):
        (text,) = spark.createDataFrame([(data,)], "k binary").select(project.base58("k")).first()
        assert project.base58_bytes(text) == data
    with pytest.raises(ValueError):
        project.base58_bytes("0OIl")


def test_declared_schemas(spark):
    from slotstream import schemas
    from slotstream.sources import tables

    got = tables.conform(spark.createDataFrame([(1, 7, "x")], "slot int, lamports bigint, other string"), schemas.ACCOUNT)
    assert got.schema.simpleString() == schemas.ACCOUNT.simpleString() and (got.first().slot, got.first().lamports, got.first().owner) == (1, 7, None)


def test_null_owners_name_no_account(spark):
    """An owner that is not known is none of the accounts of a filter, whether or not another owner is."""
    keys = "static_keys array<bigint>, writable_keys array<bigint>, readonly_keys array<bigint>"
    rows = [(1, [1], None, None, [], [(0, None, 5)]), (2, [1], None, None, [], [(0, None, 5), (1, 7, 5)]), (3, [1], None, None, [(1, 7, 5)], [(1, 7, 5)]), (4, [1], None, None, None, None), (5, [7], None, None, [], [])]
    balance = "array<struct<account_index: int, owner: bigint, amount: bigint>>"
    df = spark.createDataFrame(rows, f"id int, {keys}, pre_token_balances {balance}, post_token_balances {balance}")
    ids = lambda **f: sorted(r.id for r in df.where(fl.TransactionFilter(token_accounts="changed", **f).predicate()).collect())
    assert ids(account_include=[7]) == [2, 5]
    assert ids(account_exclude=[7]) == [1, 3, 4]
    assert ids(account_required=[1, 7]) == [2]


def test_json_longs_in_arrays_and_maps(spark):
    row = spark.createDataFrame([([1, None], {"a": 2}, [(3, 4)], None)], "a array<bigint>, m map<string, bigint>, s array<struct<x: bigint, y: int>>, n array<bigint>")
    assert row.select(sinks.as_json(row).alias("j")).first().j == '{"a":["1",null],"m":{"a":"2"},"s":[{"x":"3","y":4}]}'
