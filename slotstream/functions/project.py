"""Projections of updates: typed tables, slots, text lines, keys and data slices."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

COMMITMENTS = {"processed": 0, "confirmed": 1, "finalized": 2}
STATUS_LABELS = ("processed", "confirmed", "finalized", "first_shred_received", "completed", "created_bank", "dead")
KINDS = ("account", "slot_status", "transaction", "transaction_status", "block", "block_meta", "entry")
#: Names accepted in an include list.
INCLUDE_NAMES = {
    "account": ("account",),
    "tx": ("transaction",),
    "txn": ("transaction",),
    "tx-status": ("transaction_status",),
    "txn-status": ("transaction_status",),
    "meta": ("block_meta",),
    "slot": ("slot_status",),
    "entry": ("entry",),
    "all": ("account", "transaction", "slot_status", "block_meta", "entry"),
}


def commitment_rank(name: str) -> int:
    """0 to 2 for processed, confirmed and finalized; ValueError for any other name."""
    if name not in COMMITMENTS:
        raise ValueError(f"unknown commitment {name!r}")
    return COMMITMENTS[name]


def _label(values: Sequence[str], code: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), code.cast("int"))


def commitment_name(rank: Column) -> Column:
    """Name of a commitment rank, null outside 0 to 2."""
    return _label(list(COMMITMENTS), rank)


def status_label(code: Column) -> Column:
    """Name of a slot status code, null outside 0 to 6."""
    return _label(STATUS_LABELS, code)


def include_kinds(spec: str) -> list[str]:
    """Kinds of a comma-separated include list; ValueError for unknown names or transactions asked for in both forms."""
    kinds: set[str] = set()
    for name in (part.strip() for part in spec.split(",")):
        if name not in INCLUDE_NAMES:
            raise ValueError(f"unknown include type {name!r}")
        kinds.update(INCLUDE_NAMES[name])
    if {"transaction", "transaction_status"} <= kinds:
        raise ValueError("transactions and their statuses exclude each other")
    return sorted(kinds)


def only_kinds(updates: DataFrame, spec: str) -> DataFrame:
    """The updates of the kinds in an include list; the predicate reaches the scan."""
    return updates.where(F.col("kind").isin(include_kinds(spec)))


def split_kinds(updates: DataFrame, kinds: Sequence[str] = KINDS) -> dict[str, DataFrame]:
    """One typed table per kind of an envelope table; rows without a kind are in none."""
    return {kind: updates.where(F.col("kind") == kind).select(f"{kind}.*") for kind in kinds if kind in updates.columns}


def update_slot(kinds: Sequence[str]) -> Column:
    """Slot of an envelope row, whichever kind it has."""
    return F.coalesce(*[F.col(f"{kind}.slot") for kind in kinds])


def _text(value: Column | str) -> Column:
    return F.coalesce((F.col(value) if isinstance(value, str) else value).cast("string"), F.lit("None"))


def account_line(slot="slot", pubkey="pubkey", owner="owner", signature="txn_signature") -> Column:
    """`account,slot,pk=..,owner=..,tx=..`, with None for an absent signature."""
    return F.concat(F.lit("account,"), _text(slot), F.lit(",pk="), _text(pubkey), F.lit(",owner="), _text(owner), F.lit(",tx="), _text(signature))


def transaction_line(slot="slot", signature="signature") -> Column:
    """`tx,slot,signature`, for transactions and their statuses."""
    return F.concat_ws(",", F.lit("tx"), F.col(slot).cast("string"), F.col(signature).cast("string"))


def slot_line(slot="slot", parent="parent_slot", status="commitment") -> Column:
    """`slot=.., parent=.., status=..`."""
    return F.concat(F.lit("slot="), _text(slot), F.lit(", parent="), _text(parent), F.lit(", status="), _text(status_label(F.col(status))))


def meta_line(slot="slot", transactions="executed_transaction_count", entries="entries_count") -> Column:
    """`block=.., tx_count=.., entry_count=..`."""
    return F.concat(F.lit("block="), _text(slot), F.lit(", tx_count="), _text(transactions), F.lit(", entry_count="), _text(entries))


def rich_transaction_line(slot="slot", signature="signature", filters="filters", keys="static_keys") -> Column:
    """`slot -- signature, filters keys`, lists joined by commas."""
    joined = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    return F.concat(F.col(slot).cast("string"), F.lit(" -- "), F.col(signature).cast("string"), F.lit(", "), joined(filters), F.lit(" "), joined(keys))


def data_slice(data: Column | str, slices: Sequence[tuple[int, int]]) -> Column:
    """The (offset, length) parts of binary data in the order asked for; parts out of range are empty."""
    data = F.col(data) if isinstance(data, str) else data
    return F.concat(*[F.substring(data, offset + 1, length) for offset, length in slices]) if slices else data


def transaction_keys(static="static_keys", writable="writable_keys", readonly="readonly_keys") -> Column:
    """All account keys of a transaction: static, then loaded writable, then loaded read-only."""
    return F.concat(F.col(static), *[F.coalesce(F.col(c), F.slice(F.col(static), 1, 0)) for c in (writable, readonly)])


def transaction_success(err: str = "err") -> Column:
    """A transaction succeeded if it has no error."""
    return F.col(err).isNull()


def transaction_status(transactions: DataFrame) -> DataFrame:
    """Transactions reduced to their statuses."""
    return transactions.select("slot", "signature", "is_vote", F.col("idx").alias("index"), "err")


_ALPHABET = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"  # fixed value: base58


def base58_bytes(text: str) -> bytes:
    """The bytes of a base58 text; ValueError for other characters. For constants of a plan, not for columns."""
    n = 0
    for c in text:
        n = n * 58 + _ALPHABET.index(c)
    return b"\0" * (len(text) - len(text.lstrip("1"))) + n.to_bytes((n.bit_length() + 7) // 8, "big")


@F.arrow_udf(StringType())
def base58(keys: pa.Array) -> pa.Array:
    """Base58 text of binary keys."""

    def text(data: bytes | None) -> str | None:
        if data is None:
            return None
        n, out = int.from_bytes(data, "big"), []
        while n:
            n, digit = divmod(n, 58)
            out.append(_ALPHABET[digit])
        return "1" * (len(data) - len(data.lstrip(b"\0"))) + "".join(reversed(out))

    return pa.array([text(k.as_py()) for k in keys], pa.string())


def normalize_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace binary key columns by their text; every distinct key is encoded once."""
    distinct = reduce(DataFrame.unionByName, [df.select(F.col(c).alias("_key")) for c in columns]).where("_key IS NOT NULL").distinct()
    texts = distinct.withColumn("_text", base58("_key"))
    for c in columns:
        df = df.join(texts.select(F.col("_key").alias(c), F.col("_text").alias(f"_{c}")), c, "left").drop(c).withColumnRenamed(f"_{c}", c)
    return df


def merge_kinds(*tables: DataFrame) -> DataFrame:
    """One table of several kinds; columns that a kind lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
