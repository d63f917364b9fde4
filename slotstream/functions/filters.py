"""Named filters as predicates, and the tagging of rows with the names of all filters they match.

Within a filter, fields are joined by and, values of a list by or; an empty list or None is no constraint. Between
named filters any match is enough, and all matches are recorded.
"""

from __future__ import annotations

import base64
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotstream.functions.project import COMMITMENTS, base58_bytes, transaction_keys

#: Keys from which a list belongs in a table (``in_table``) rather than in the plan.
MAX_LIST = 1000
TOKEN_ACCOUNT_BYTES, TOKEN_STATE_AT = 165, 108  # fixed values of token account data


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(Column.__and__, conditions) if conditions else F.lit(True)


def _list(values: Sequence) -> list:
    if len(values) > MAX_LIST:
        raise ValueError(f"more than {MAX_LIST} values; filter with in_table")
    return list(values)


def in_table(df: DataFrame, column: str, keys: DataFrame, key: str = "key") -> DataFrame:
    """Rows whose key is in a table of any size: exact, the join strategy is left to the planner."""
    return df.join(keys.select(F.col(key).alias(column)), column, "left_semi")


@dataclass(frozen=True)
class Memcmp:
    """Bytes expected at an offset of the data, given as bytes, base64 or base58 text."""

    offset: int
    data: bytes = b""
    base64: str | None = None
    base58: str | None = None

    def predicate(self, data: Column) -> Column:
        wanted = base64.b64decode(self.base64) if self.base64 is not None else self.data if self.base58 is None else base58_bytes(self.base58)
        return F.substring(data, self.offset + 1, len(wanted)) == F.lit(wanted)


@dataclass(frozen=True)
class AccountFilter:
    """Filter of account updates. ``lamports``: (comparison eq/ne/lt/gt, value) pairs."""

    pubkeys: Sequence = ()
    owners: Sequence = ()
    memcmp: Sequence[Memcmp] = ()
    datasize: int | None = None
    token_account_state: bool = False
    lamports: Sequence[tuple[str, int]] = ()
    nonempty_txn_signature: bool | None = None

    def predicate(self) -> Column:
        out = []
        if self.pubkeys:
            out.append(F.col("pubkey").isin(_list(self.pubkeys)))
        if self.owners:
            out.append(F.col("owner").isin(_list(self.owners)))
        out += [m.predicate(F.col("data")) for m in self.memcmp]
        if self.datasize is not None:
            out.append(F.octet_length("data") == self.datasize)
        if self.token_account_state:
            out.append((F.octet_length("data") >= TOKEN_ACCOUNT_BYTES) & (F.substring("data", TOKEN_STATE_AT + 1, 1) != F.lit(b"\0")))
        compare = {"eq": Column.__eq__, "ne": Column.__ne__, "lt": Column.__lt__, "gt": Column.__gt__}
        out += [compare[op](F.col("lamports"), F.lit(value)) for op, value in self.lamports]
        if self.nonempty_txn_signature is not None:
            present = F.col("txn_signature").isNotNull() & (F.octet_length("txn_signature") > 0)
            out.append(present if self.nonempty_txn_signature else ~present)
        return _all(out)


def all_owners() -> Column:
    """Owners of any token balance before or after a transaction."""
    return F.transform(F.concat("pre_token_balances", "post_token_balances"), lambda b: b["owner"])


def changed_owners() -> Column:
    """Owners whose token balance changed in amount at an account index, or whose token account was closed.

    The balances of a transaction are compared within its row, without a shuffle. A missing balance counts as 0: what
    was there before and is not there alike afterwards has changed or was closed, what is new has changed unless it is 0.
    """
    pre, post = F.col("pre_token_balances"), F.col("post_token_balances")
    amounts = lambda side: F.transform(side, lambda b: F.struct(b["account_index"].alias("i"), F.coalesce(b["amount"].cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)")).alias("n")))
    new = F.filter(F.array_except(amounts(post), amounts(pre)), lambda b: b["n"] != 0)
    gone = F.array_except(amounts(pre), amounts(post))
    # a variable, so that the changes are found once a row
    return F.get(F.transform(F.array(F.transform(F.concat(gone, new), lambda b: b["i"])), _owners_at), F.lit(0))


def _owners_at(changed: Column) -> Column:
    """Owners of the balances, before or after, at the given account indexes."""
    pre, post = F.col("pre_token_balances"), F.col("post_token_balances")
    return F.array_distinct(F.transform(F.filter(F.concat(pre, post), lambda b: F.array_contains(changed, b["account_index"])), lambda b: b["owner"]))


@dataclass(frozen=True)
class TransactionFilter:
    """Filter of transactions and their statuses. ``token_accounts``: None, "all" or "changed" adds owners to the keys."""

    vote: bool | None = None
    failed: bool | None = None
    signature: str | None = None
    account_include: Sequence = ()
    account_exclude: Sequence = ()
    account_required: Sequence = ()
    token_accounts: str | None = None

    def keys(self) -> Column:
        keys = transaction_keys()
        if self.token_accounts is None:
            return keys
        return F.array_union(keys, F.array_compact({"all": all_owners, "changed": changed_owners}[self.token_accounts]()))

    def predicate(self) -> Column:
        out = []
        if self.vote is not None:
            out.append(F.col("is_vote") == self.vote)
        if self.failed is not None:
            out.append(F.col("err").isNotNull() == self.failed)
        if self.signature is not None:
            out.append(F.col("signature") == self.signature)
        values = lambda x: F.array(*map(F.lit, _list(x)))

        def fits(keys: Column) -> Column:
            parts = []
            if self.account_include:
                parts.append(F.arrays_overlap(keys, values(self.account_include)))
            if self.account_exclude:
                parts.append(~F.arrays_overlap(keys, values(self.account_exclude)))
            if self.account_required:
                parts.append(F.size(F.array_except(values(self.account_required), keys)) == 0)
            return _all(parts)

        wanted = {*self.account_include, *self.account_exclude, *self.account_required}
        if wanted:
            keys = self.keys()
            if self.token_accounts == "changed":  # balances are compared only where an owner matters at all
                matters = F.exists(all_owners(), lambda o: o.isin(list(wanted)))
                keys = F.when(matters, keys).otherwise(transaction_keys())
            out.append(F.get(F.transform(F.array(keys), fits), F.lit(0)))  # the keys are built once a row
        return _all(out)


@dataclass(frozen=True)
class DeshredFilter:
    """Filter of transactions seen before execution: no result, no balances."""

    vote: bool | None = None
    account_include: Sequence = ()
    account_exclude: Sequence = ()
    account_required: Sequence = ()

    def predicate(self) -> Column:
        return TransactionFilter(vote=self.vote, account_include=self.account_include, account_exclude=self.account_exclude, account_required=self.account_required).predicate()


@dataclass(frozen=True)
class SlotFilter:
    """Filter of slot statuses: only the requested commitment, and whether statuses in between pass."""

    filter_by_commitment: bool = False
    interslot_updates: bool = True

    def predicate(self, commitment: str = "processed", status: str = "commitment") -> Column:
        out = [F.col(status) == COMMITMENTS[commitment]] if self.filter_by_commitment else []
        if not self.interslot_updates:
            out.append(F.col(status) <= 2)
        return _all(out)


@dataclass(frozen=True)
class BlockFilter:
    """Filter of whole blocks: which keys their parts must touch, and which parts are wanted."""

    account_include: Sequence = ()
    include_transactions: bool = True
    include_accounts: bool = False
    include_entries: bool = False

    def apply(self, blocks: DataFrame) -> DataFrame:
        """Blocks (slot, transactions, accounts, entries arrays) with the parts that match; parts not asked for are null."""
        wanted = F.array(*map(F.lit, _list(self.account_include))) if self.account_include else None
        transactions, accounts = F.col("transactions"), F.col("accounts")
        if wanted is not None:
            transactions = F.filter(transactions, lambda t: F.arrays_overlap(t["keys"], wanted))
            accounts = F.filter(accounts, lambda a: F.array_contains(wanted, a["pubkey"]))
        none = lambda c: F.lit(None).cast(blocks.schema[c].dataType)
        return blocks.withColumns(
            {
                "transactions": transactions if self.include_transactions else none("transactions"),
                "accounts": accounts if self.include_accounts else none("accounts"),
                "entries": F.col("entries") if self.include_entries else none("entries"),
            }
        )


@dataclass(frozen=True)
class Subscription:
    """A request: named filters per kind. A kind is selected if it has filters; a filter of None matches all its rows."""

    accounts: Mapping[str, AccountFilter] = field(default_factory=dict)
    slots: Mapping[str, SlotFilter] = field(default_factory=dict)
    transactions: Mapping[str, TransactionFilter] = field(default_factory=dict)
    transactions_status: Mapping[str, TransactionFilter] = field(default_factory=dict)
    blocks_meta: Mapping[str, None] = field(default_factory=dict)
    entries: Mapping[str, None] = field(default_factory=dict)
    commitment: str = "processed"
    from_slot: int | None = None

    def kinds(self) -> list[str]:
        """The kinds that the request selects."""
        given = {"account": self.accounts, "slot_status": self.slots, "transaction": self.transactions, "transaction_status": self.transactions_status, "block_meta": self.blocks_meta, "entry": self.entries}
        return [kind for kind, filters in given.items() if filters]


def tag(df: DataFrame, named: Mapping[str, Column | None]) -> DataFrame:
    """``df`` with the names of the filters each row matches in ``filters``; rows that match none are dropped."""
    names = [F.when(F.lit(True) if p is None else p, F.lit(name)) for name, p in named.items()]
    return df.withColumn("filters", F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")).where(F.size("filters") > 0)


def merge_specs(specs: Sequence[str], default: str = "default") -> dict[str, list[str]]:
    """Keys per filter name from `[name:]key` texts; ValueError for an empty key or more than one colon."""
    out: dict[str, list[str]] = {}
    for spec in specs:
        parts = spec.split(":")
        if len(parts) > 2 or not parts[-1]:
            raise ValueError(f"not a [name:]key: {spec!r}")
        out.setdefault(parts[0] if len(parts) == 2 else default, []).append(parts[-1])
    return out


def at_least(df: DataFrame, commitment: str, column: str = "commitment") -> DataFrame:
    """Rows at a commitment or above."""
    return df.where(F.col(column) >= COMMITMENTS[commitment])


def from_slot(df: DataFrame, slot: int) -> DataFrame:
    """Rows of a slot or later ones."""
    return df.where(F.col("slot") >= slot)


def dead_slots(df: DataFrame) -> DataFrame:
    """Statuses that carry a dead error."""
    return df.where(F.col("dead_error").isNotNull())


def with_versions(df: DataFrame, versions: DataFrame, width: int = 10_000) -> DataFrame:
    """Rows with the filter version in force at their slot: effective_from <= slot < effective_to (null: open).

    The range join is an equi-join on buckets of ``width`` slots, so it needs no nested loop; a version is listed
    once for each bucket between the first and last slot that it covers.
    """
    ends = df.agg(F.min("slot").alias("_least"), F.max("slot").alias("_most"))
    v = versions.crossJoin(F.broadcast(ends)).withColumn("_to", F.coalesce("effective_to", F.col("_most") + 1))  # one row of ends
    first, last = F.greatest("effective_from", "_least"), F.least(F.col("_to") - 1, F.col("_most"))
    v = v.where(first <= last).withColumn("_bucket", F.explode(F.sequence(F.floor(first / width), F.floor(last / width)))).drop("_least", "_most", "effective_to")
    joined = df.withColumn("_bucket", F.floor(F.col("slot") / width)).join(v, "_bucket")
    return joined.where((F.col("slot") >= F.col("effective_from")) & (F.col("slot") < F.col("_to"))).drop("_bucket", "effective_from", "_to")
