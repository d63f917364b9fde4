"""Removal of repeated passages by level-wise doubling of window lengths.

A window is a run of consecutive words. Windows that repeat at one length alone are extended to twice that
length, up to the wanted one; what does not repeat at a length drops out with all windows that contain it.

Below the wanted length a window is judged by its anchor: the smallest hash among the shorter windows inside
it. Equal windows have equal anchors, so none is lost, and the shuffle of a level carries about two anchors
for every wanted window's length of text. The wanted length itself decides with 128-bit hashes.

By default windows of 13, then 25, then 50 words are searched.

Copies of a whole text are told by a digest first: their windows all start in the copy with the smallest doc_id,
so they take no part in the search.

A word goes if a wanted window covers it whose word sequence also starts in a document with a smaller doc_id.
Null and empty texts have no words. Rows without a doc_id keep their text and are compared with nothing.
Nothing is removed between rows that share a doc_id. Extra columns of the input are not carried.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotstream.llm.common import bounded, materialize, window_hashes, word_hashes

ROWS_OUT = 200_000  # rows after which a task hands a batch on
KEY = ["doc_id", "row_key"]


def anchors(hashes: np.ndarray, reach: int) -> np.ndarray:
    """The smallest of every ``reach`` consecutive hashes, in a logarithmic number of steps."""
    if len(hashes) < reach:
        return hashes[:0]
    span, low = 1, hashes
    while span * 2 <= reach:
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    n = len(hashes) - reach + 1
    return np.minimum(low[:n], low[reach - span : reach - span + n])


def _levels(words: int, base: int) -> list[int]:
    """Lengths below the wanted one: its halves, down to ``base``."""
    out, n = [], -(-words // 2)
    while n >= max(base, 1) and n < words:
        out.insert(0, n)
        n = -(-n // 2) if n > 1 else 0
    return out


def _alive(hashed: np.ndarray, words: int, known: dict[int, np.ndarray]) -> np.ndarray:
    """Which wanted windows have repeated anchors at all lengths judged so far."""
    alive = np.ones(max(0, len(hashed) - words + 1), dtype=bool)
    for size, values in known.items():
        if alive.any():
            alive &= np.isin(anchors(window_hashes(hashed, size), words - size + 1), values)
    return alive


def _emit(rows, names: list[str]):
    """Record batches of at most about ROWS_OUT rows from (doc_id, row_key, arrays...) groups."""
    held, n = [], 0

    def batch():
        count = [len(r[2]) for r in held]
        keys = [np.repeat(np.array([r[k] for r in held], dtype=np.int64), count) for k in (0, 1)]
        rest = [np.concatenate([r[k] for r in held]).view(np.int64) for k in range(2, len(held[0]))]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in (*keys, *rest)], names=names)

    for row in rows:
        if len(row[2]):
            held.append(row)
            n += len(row[2])
        if n >= ROWS_OUT:
            yield batch()
            held, n = [], 0
    if held:
        yield batch()


def _repeated(windows: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that occur in more than one document, with the smallest of these.

    They are written before they are joined: the join then reads both sides from plain shuffles, in which the many
    windows of one key can be split over tasks.
    """
    found = windows.groupBy(*keys).agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
    return materialize(found.where("first_doc < last_doc").drop("last_doc"), "repeated")


def _with(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Documents that have rows in ``found``, with these; the texts of others are not shuffled while ids are few."""
    return docs.join(bounded(found.select(*KEY)), KEY, "left_semi").join(found, KEY)


def repeated_windows(docs: DataFrame, words: int = 50, base: int = 12) -> DataFrame:
    """doc_id, row_key, starts: where windows of ``words`` words start that an earlier document has too.

    ``docs``: doc_id, row_key, text.
    """
    docs, sizes, known = docs.where("doc_id is not null"), _levels(words, base), []

    for size in sizes:

        def level(batches, size=size, before=tuple(known)):
            def rows():
                for batch in batches:
                    columns = [batch.column(c) for c in ("doc_id", "row_key", "text", *(f"known{s}" for s in before))]
                    for i, key, text, *sets in zip(*columns, strict=True):
                        hashed = word_hashes(text.as_py())
                        alive = _alive(hashed, words, {s: np.asarray(x.values).view(np.uint64) for s, x in zip(before, sets, strict=True)})
                        yield i.as_py(), key.as_py(), np.unique(anchors(window_hashes(hashed, size), words - size + 1)[alive])

            return _emit(rows(), ["doc_id", "row_key", "h"])

        found = materialize(docs.mapInArrow(level, "doc_id long, row_key long, h long"), "anchors")
        again = found.join(_repeated(found, ["h"]).select("h"), "h")
        sets = materialize(again.groupBy(*KEY).agg(F.collect_set("h").alias(f"known{size}")), "known")
        docs = _with(docs, sets)
        known.append(size)

    def last(batches):
        def rows():
            for batch in batches:
                columns = [batch.column(c) for c in ("doc_id", "row_key", "text", *(f"known{s}" for s in known))]
                for i, key, text, *sets in zip(*columns, strict=True):
                    hashed = word_hashes(text.as_py())
                    at = np.flatnonzero(_alive(hashed, words, {s: np.asarray(x.values).view(np.uint64) for s, x in zip(known, sets, strict=True)}))
                    yield i.as_py(), key.as_py(), at, window_hashes(hashed, words, 1)[at], window_hashes(hashed, words, 2)[at]

        return _emit(rows(), ["doc_id", "row_key", "at", "ha", "hb"])

    windows = materialize(docs.mapInArrow(last, "doc_id long, row_key long, at long, ha long, hb long"), "windows")
    covered = windows.join(_repeated(windows, ["ha", "hb"]), ["ha", "hb"]).where("doc_id > first_doc")
    return covered.groupBy(*KEY).agg(F.collect_set("at").alias("starts"))


def whole_copies(docs: DataFrame) -> DataFrame:
    """doc_id, row_key of the rows whose whole text an earlier document has."""
    keyed = docs.where("doc_id is not null and text is not null").select(*KEY, F.md5(F.col("text").cast("binary")).alias("digest"))
    firsts = keyed.groupBy("digest").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")).where("first_doc < last_doc")
    return keyed.join(firsts, "digest").where("doc_id > first_doc").select(*KEY).distinct()


def remove_repeats(df: DataFrame, words: int = 50, base: int = 12, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text without the repeated passages (words joined by one space), n_words and n_removed of every row."""
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("row_key"), F.col(text).alias("text"))
    copies = materialize(whole_copies(docs), "copies")
    single = docs.join(bounded(copies), KEY, "left_anti")
    starts = repeated_windows(single, words, base)
    marks = materialize(starts.withColumn("whole", F.lit(False)).unionByName(copies.withColumn("whole", F.lit(True)), allowMissingColumns=True), "marks")
    ids = bounded(marks.select(*KEY))
    touched = docs.join(ids, KEY, "left_semi").join(marks, KEY)
    rest = docs.join(ids, KEY, "left_anti").withColumns({"starts": F.lit(None).cast("array<bigint>"), "whole": F.lit(False)})

    def cut(batches):
        for batch in batches:
            texts, n_words, n_removed = [], [], []
            for x, s, whole in zip(batch.column("text"), batch.column("starts"), batch.column("whole"), strict=True):
                kept = (x.as_py() or "").encode().split()  # bytes: exactly the six separators
                n_words.append(len(kept))
                if whole.as_py():
                    kept = kept if len(kept) < words else []
                elif s.is_valid:
                    edge = np.zeros(len(kept) + 1, dtype=np.int64)
                    at = np.asarray(s.values)
                    edge[at] += 1
                    edge[at + words] -= 1
                    kept = list(compress(kept, np.cumsum(edge[:-1]) == 0))
                texts.append(b" ".join(kept).decode())
                n_removed.append(n_words[-1] - len(kept))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())], names=["doc_id", "text", "n_words", "n_removed"])

    return touched.unionByName(rest).drop("row_key").mapInArrow(cut, "doc_id long, text string, n_words long, n_removed long")
