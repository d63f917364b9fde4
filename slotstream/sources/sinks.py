"""Writing updates: text lines, signatures, JSON, several consumers, one callback per block."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, LongType, MapType, StructType

from slotstream.functions import project


def update_lines(accounts: DataFrame, transactions: DataFrame, statuses: DataFrame, meta: DataFrame) -> DataFrame:
    """slot and one summary line per update."""
    return (
        accounts.select("slot", project.account_line().alias("value"))
        .unionByName(transactions.select("slot", project.transaction_line().alias("value")))
        .unionByName(statuses.select("slot", project.slot_line().alias("value")))
        .unionByName(meta.select("slot", project.meta_line().alias("value")))
    )


def write_lines(lines: DataFrame, path: str) -> None:
    """Append the lines as text files."""
    lines.select("value").write.mode("append").text(path)


def transaction_signatures(transactions: DataFrame, complete: DataFrame) -> DataFrame:
    """slot and signature of the transactions in finished blocks."""
    return transactions.where("kind = 'transaction'").join(complete.select("slot"), "slot", "left_semi").select("slot", "signature")


def write_signatures(signatures: DataFrame, path: str) -> None:
    signatures.write.mode("append").csv(path)


def _long_as_text(column: Column, kind: DataType) -> Column:
    if isinstance(kind, LongType):
        return column.cast("string")
    if isinstance(kind, StructType):
        return F.when(column.isNotNull(), F.struct(*[_long_as_text(column[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    if isinstance(kind, ArrayType):
        return F.transform(column, lambda x: _long_as_text(x, kind.elementType))
    if isinstance(kind, MapType):  # keys are text in JSON anyway
        return F.transform_values(column, lambda _, v: _long_as_text(v, kind.valueType))
    return column


def as_json(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """A row as JSON; 64-bit whole numbers are strings, since readers in other languages lose digits."""
    names = columns or df.columns
    return F.to_json(F.struct(*[_long_as_text(F.col(c), df.schema[c].dataType).alias(c) for c in names]))


def fan_out(consumers: Sequence[Callable[[DataFrame, int], None]]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that hands each batch, read once, to several consumers."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for consumer in consumers:
                consumer(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def idempotent_parquet(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer that replaces what an earlier try of the same batch wrote."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def on_block(callback: Callable[[DataFrame], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that gives each batch's finished blocks, as ``stateful.stream_blocks`` emits them, to a callback.

    A block is handed over once it has ended, whole, whatever the number of batches that its rows came in; batches in
    which no block ended are left out.
    """

    def write(blocks: DataFrame, batch_id: int) -> None:
        if not blocks.isEmpty():
            callback(blocks)

    return write
