"""Helpers shared by the corpus operators: scratch tables, bounded broadcasts and word hashing."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six separators of the word rule `[^\x20\x09-\x0D]+`.
SEPARATORS = " \t\n\x0b\x0c\r"

#: Rows and bytes up to which a side may be broadcast; beyond either, joins shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 32 << 20
_WRITTEN: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir, or, on one machine, a new local one where it is unset."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, uri: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def forget(*tables: DataFrame) -> None:
    """Delete scratch tables made by ``materialize`` that no later plan reads."""
    for table in tables:
        for uri in {os.path.dirname(name) for name in table.inputFiles()}:
            _delete(table.sparkSession, uri)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all scratch tables that this driver wrote, once their results have been written elsewhere."""
    while _WRITTEN:
        _delete(spark, _WRITTEN.pop())


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to be within ``rows`` and BROADCAST_BYTES, otherwise unchanged (shuffle join)."""
    width = F.lit(8 * len(df.columns))
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            width += F.coalesce(F.octet_length(name), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            width += F.octet_length(F.to_json(F.struct(name)))
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and size <= BROADCAST_BYTES else df


# ---------------------------------------------------------------- hashing

_P = np.uint64(0x9E3779B97F4A7C55)
_Q = np.uint64(0xC2B2AE3D27D4EB4F)
_SEGMENT = 1 << 20  # bytes hashed at a time, so that memory does not follow the text's length
_IS_SEP = np.zeros(256, dtype=bool)
_IS_SEP[[ord(c) for c in SEPARATORS]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_POWERS = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        size = max(64, 1 << (n - 1).bit_length())
        known = np.full(size, base, dtype=np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        _POWERS[int(base)] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The public splitmix64 finalizer, element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word of a UTF-8 byte array."""
    word = np.zeros(len(data) + 2, dtype=np.int8)
    word[1:-1] = ~_IS_SEP[data]
    edge = np.diff(word)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lengths = ends - starts
    offsets = np.cumsum(lengths) - lengths
    index = np.arange(int(lengths.sum())) - np.repeat(offsets, lengths)
    letters = data[np.repeat(starts, lengths) + index].astype(np.uint64) + np.uint64(1)
    letters *= _powers(_P, int(lengths.max()))[index]
    return mix(np.add.reduceat(letters, offsets) + lengths.astype(np.uint64) * _Q)


def word_hashes(text: str | None, fold: bool = False) -> np.ndarray:
    """A 64-bit hash for each word of ``text`` (A-Z lower-cased first if ``fold``); empty for null or no words."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if fold:
        data = _FOLD[data]
    starts, ends = word_spans(data)
    if len(starts) == 0:
        return np.empty(0, dtype=np.uint64)
    if len(data) <= _SEGMENT:
        return _hash_words(data, starts, ends)
    cuts = [0, *np.flatnonzero(np.diff(starts // _SEGMENT)) + 1, len(starts)]
    return np.concatenate([_hash_words(data, starts[a:b], ends[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)])


def window_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every window of ``size`` consecutive word hashes; empty if there are fewer words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    base = np.uint64(int(_Q) + 2 * seed)
    if size <= 8:
        total = np.zeros(n, dtype=np.uint64)
        for k, power in enumerate(_powers(base, size)):
            total += words[k : k + n] * power
    else:  # doubling: a window of 2m is two windows of m
        sums, have, total, done = words, 1, np.zeros(n, dtype=np.uint64), 0
        left = size
        while left:
            if left & 1:
                total += sums[done : done + n] * _power(base, done)
                done += have
            left >>= 1
            if left:
                sums = sums[: len(sums) - have] + sums[have:] * _power(base, have)
                have *= 2
    return mix(total ^ np.uint64(size))


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))
