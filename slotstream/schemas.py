"""Declared schemas of the event log. Unsigned 64-bit values that use their full range are decimal(20,0)."""

from __future__ import annotations

from pyspark.sql import types as T

U64 = T.DecimalType(20, 0)


_TYPES = {"bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "binary": T.BinaryType(), "boolean": T.BooleanType(), "double": T.DoubleType(), "timestamp": T.TimestampType(), "decimal(20,0)": U64, "array<int>": T.ArrayType(T.IntegerType())}


def _struct(spec: str) -> T.StructType:
    """A schema from `name type` pairs; reading DDL would need a session at import."""
    pairs = [pair.rsplit(" ", 1) for pair in spec.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


HISTORY = _struct("log_offset bigint, blockchain_id binary, block_uid binary, num_shards int, slot bigint, parent_slot bigint, commitment int, blockchain_shard_id int, dead_error string, created_at timestamp")
ACCOUNT = _struct("slot bigint, is_startup boolean, pubkey binary, lamports decimal(20,0), owner binary, executable boolean, rent_epoch decimal(20,0), data binary, write_version bigint, txn_signature binary")
SLOT = _struct("slot bigint, parent bigint, status int, dead_error string, bank_id bigint")
INSTRUCTION = _struct("program_id_index int, accounts binary, data binary, stack_height int")
TOKEN_BALANCE = _struct("account_index int, mint string, ui_amount double, decimals int, amount string, owner string, program_id string")
META = T.StructType(
    [
        T.StructField("err", T.BinaryType()),
        T.StructField("fee", U64),
        T.StructField("pre_balances", T.ArrayType(U64)),
        T.StructField("post_balances", T.ArrayType(U64)),
        T.StructField("inner_instructions", T.ArrayType(T.StructType([T.StructField("index", T.IntegerType()), T.StructField("instructions", T.ArrayType(INSTRUCTION))]))),
        T.StructField("log_messages", T.ArrayType(T.StringType())),
        T.StructField("pre_token_balances", T.ArrayType(TOKEN_BALANCE)),
        T.StructField("post_token_balances", T.ArrayType(TOKEN_BALANCE)),
        T.StructField("rewards", T.ArrayType(_struct("pubkey string, lamports bigint, post_balance decimal(20,0), reward_type int, commission string"))),
        T.StructField("loaded_writable_addresses", T.ArrayType(T.BinaryType())),
        T.StructField("loaded_readonly_addresses", T.ArrayType(T.BinaryType())),
        T.StructField("compute_units_consumed", T.LongType()),
    ]
)
MESSAGE = T.StructType(
    [
        T.StructField("account_keys", T.ArrayType(T.BinaryType())),
        T.StructField("recent_blockhash", T.BinaryType()),
        T.StructField("instructions", T.ArrayType(INSTRUCTION)),
        T.StructField("versioned", T.BooleanType()),
    ]
)
TRANSACTION = T.StructType(
    [
        T.StructField("slot", T.LongType()),
        T.StructField("signature", T.BinaryType()),
        T.StructField("is_vote", T.BooleanType()),
        T.StructField("index", T.LongType()),
        T.StructField("signatures", T.ArrayType(T.BinaryType())),
        T.StructField("message", MESSAGE),
        T.StructField("meta", META),
    ]
)
TRANSACTION_STATUS = _struct("slot bigint, signature binary, is_vote boolean, index bigint, err binary")
BLOCK_META = _struct("slot bigint, blockhash string, parent_slot bigint, parent_blockhash string, block_time bigint, block_height bigint, executed_transaction_count bigint, entries_count bigint")
ENTRY = _struct("slot bigint, index bigint, num_hashes bigint, hash binary, executed_transaction_count bigint, starting_transaction_index bigint, bank_id bigint")
BLOCK = T.StructType([*BLOCK_META.fields, T.StructField("transactions", T.ArrayType(TRANSACTION)), T.StructField("accounts", T.ArrayType(ACCOUNT)), T.StructField("entries", T.ArrayType(ENTRY)), T.StructField("updated_account_count", T.LongType())])
DESHRED_TRANSACTION = T.StructType([T.StructField("slot", T.LongType()), T.StructField("signature", T.BinaryType()), T.StructField("is_vote", T.BooleanType()), T.StructField("message", MESSAGE), T.StructField("loaded_writable_addresses", T.ArrayType(T.BinaryType())), T.StructField("loaded_readonly_addresses", T.ArrayType(T.BinaryType()))])
SHARD_FINISH = _struct("block_uid binary, slot bigint, shard_indices array<int>")
CONSUMER_GROUPS = _struct("id string, name string, is_stale boolean, blockchain_id binary, committed_offset bigint")

#: The update envelope: the names of matched filters, one nullable struct per kind, and which one it is.
UPDATES = T.StructType(
    [
        T.StructField("filters", T.ArrayType(T.StringType())),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("kind", T.StringType()),
        *[T.StructField(name, schema) for name, schema in (("account", ACCOUNT), ("slot_status", SLOT), ("transaction", TRANSACTION), ("transaction_status", TRANSACTION_STATUS), ("block", BLOCK), ("block_meta", BLOCK_META), ("entry", ENTRY))],
    ]
)
