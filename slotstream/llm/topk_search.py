"""Exact top-k search by inner product over a bit-sliced index.

The index holds blocks of rows. Within a block every attribute is shifted to start at 0 and its most significant
bits are kept as bitmaps, one bit of each row per slice. For a block of queries, the slices of all attributes are
added with bitmap arithmetic (carry-save adders), each at the weights of the bits of the query's components;
negative components add the slices' complement. The top rows are then selected from the most significant slice of
the sum downward. What the dropped low bits could change is a known bound: rows within it of the k-th are the
boundary rows, and their scores are computed exactly. So recall is 1.

Query blocks and index blocks meet in a grid of groups, one task a cell, whose number follows the work; its shape
keeps the copies few. A task holds the k best of each of its queries so far, and passes over blocks that cannot
reach a query's k-th; so it sends k rows for a query, whatever the number of blocks.

Components are whole numbers floor(1024 * x). Vectors that are null, empty or hold null or non-finite components
take no part; vectors of another length than the query's are not compared with it. A component so large that a
score could pass 64 bits is an error, and the job ends with it. Repeated rows are rows of their own; only rows with
the query's own id are left out. Equal scores go to the smaller id. An empty table gives an empty result. Extra
columns are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotstream.llm.common import materialize

BLOCK_ROWS = 4096
QUERY_ROWS = 64
KEPT_BITS = 8
PAIRS_PER_TASK = 64  # of a query block and an index block
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def _blocks(df: DataFrame, rows: int) -> DataFrame:
    """vec_id lists and whole-number matrices of up to ``rows`` vectors of one length, as they come in a partition."""

    def run(batches):
        held: dict[int, list[tuple[int, np.ndarray]]] = {}

        def block(dim):
            part = held.pop(dim)
            ids, values = [i for i, _ in part], np.stack([v for _, v in part])
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([values.tobytes()], pa.binary())], names=["dim", "ids", "vectors"])

        for batch in batches:
            for i, v in zip(batch.column("vec_id"), batch.column("embedding"), strict=True):
                whole = np.floor(np.asarray(v.values.to_numpy(zero_copy_only=False), dtype=np.float64) * 1024)
                if len(whole) * np.abs(whole).max() ** 2 >= 2.0**62:
                    raise ValueError(f"components of vector {i.as_py()} are too large: scores would not fit 64 bits")
                x = whole.astype(np.int64)
                held.setdefault(len(x), []).append((i.as_py(), x))
                if len(held[len(x)]) == rows:
                    yield block(len(x))
        for dim in list(held):
            yield block(dim)

    return df.mapInArrow(run, "dim int, ids array<long>, vectors binary")


class Slices:
    """The bit slices of one block of rows."""

    def __init__(self, values: np.ndarray, kept: int = KEPT_BITS):
        self.n, self.dim = values.shape
        self.least = values.min(axis=0)
        rest = values - self.least
        self.shift = max(0, int(rest.max()).bit_length() - kept)
        self.bits = min(kept, max(1, int(rest.max()).bit_length()))
        words = -(-self.n // 64)
        top = rest >> self.shift
        padded = np.zeros((self.dim, self.bits, words * 64), dtype=np.uint8)
        for j in range(self.bits):
            padded[:, j, : self.n] = ((top >> j) & 1).T
        self.planes = np.packbits(padded, axis=-1, bitorder="little").view(np.uint64)
        valid = np.zeros(words * 64, dtype=np.uint8)
        valid[: self.n] = 1
        self.valid = np.packbits(valid, bitorder="little").view(np.uint64)

    def add(self, queries: np.ndarray) -> list[np.ndarray]:
        """The slices, least first, of sum over attributes of |q| * (slice value, complemented where q < 0)."""
        weight = np.abs(queries)
        negative = np.where(queries < 0, _ONES, np.uint64(0))
        levels: list[list[np.ndarray]] = [[] for _ in range(int(weight.max()).bit_length() + self.bits + self.dim.bit_length() + 2)]

        def push(level, plane):
            while True:
                bucket = levels[level]
                bucket.append(plane)
                if len(bucket) < 3:
                    return
                a, b, c = bucket
                either = a ^ b
                levels[level] = [either ^ c]
                level, plane = level + 1, (a & b) | (c & either)

        for d in range(self.dim):
            masks = [(i, np.where((weight[:, d] >> i) & 1, _ONES, np.uint64(0))[:, None]) for i in range(int(weight[:, d].max()).bit_length())]
            for j in range(self.bits):
                plane = self.planes[d, j][None, :] ^ negative[:, d, None]
                for i, mask in masks:
                    push(i + j, plane & mask)
        out = []
        for level in range(len(levels) - 1):
            bucket = levels[level]
            if len(bucket) == 2:
                levels[level] = [bucket[0] ^ bucket[1]]
                push(level + 1, bucket[0] & bucket[1])
            out.append(levels[level][0] if levels[level] else None)
        while out and out[-1] is None:
            out.pop()
        return [np.zeros((len(queries), len(self.valid)), dtype=np.uint64) if s is None else s for s in out]

    def boundary(self, sums: list[np.ndarray], k: int, slack: np.ndarray) -> np.ndarray:
        """Bitmaps of the rows whose sum is within ``slack`` of the k-th largest, per query."""
        m = len(slack)
        sure, open_rows = np.zeros((m, len(self.valid)), dtype=np.uint64), np.broadcast_to(self.valid, (m, len(self.valid))).copy()
        least = np.zeros(m, dtype=np.int64)
        for level in range(len(sums) - 1, -1, -1):
            ones = open_rows & sums[level]
            enough = np.bitwise_count(sure | ones).sum(axis=1) >= k
            least += enough.astype(np.int64) << level
            more = np.where(enough, _ONES, np.uint64(0))[:, None]
            sure |= ones & ~more
            open_rows = (ones & more) | (open_rows & ~sums[level] & ~more)
        least = np.maximum(least - slack, 0)
        above, equal = np.zeros_like(sure), np.broadcast_to(self.valid, sure.shape).copy()
        for level in range(len(sums) - 1, -1, -1):
            bit = np.where((least >> level) & 1, _ONES, np.uint64(0))[:, None]
            above |= equal & sums[level] & ~bit
            equal &= ~(sums[level] ^ bit)
        return above | equal


def reachable(values: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """What no row of a block can exceed as score, for each query."""
    return np.maximum(queries, 0) @ values.max(axis=0) + np.minimum(queries, 0) @ values.min(axis=0)


class Best:
    """The k best rows of each query of a block, ties to the smaller vec_id."""

    def __init__(self, queries: int, k: int):
        self.k, self.ids, self.scores = k, [np.empty(0, dtype=np.int64)] * queries, [np.empty(0, dtype=np.int64)] * queries

    def open(self, bounds: np.ndarray) -> np.ndarray:
        """The queries that a block with these bounds may still change."""
        return np.flatnonzero([len(s) < self.k or b >= s[-1] for s, b in zip(self.scores, bounds.tolist(), strict=True)])

    def add(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.ids[q], ids]), np.concatenate([self.scores[q], scores])
        best = np.lexsort((ids, -scores))[: self.k]
        self.ids[q], self.scores[q] = ids[best], scores[best]


def _grid(pairs: int, index: int, queries: int) -> tuple[int, int]:
    """Groups of index and of query blocks: a cell has about PAIRS_PER_TASK pairs, and copies are few on both sides."""
    cells = max(1, -(-pairs // PAIRS_PER_TASK))
    rows = min(max(1, index), max(1, round((cells * index / max(1, queries)) ** 0.5)))
    return rows, min(max(1, queries), -(-cells // rows))


def top_rows(slices: Slices, values: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int):
    """(query index, vec_id, score) of each query's k best rows of a block, ties to the smaller vec_id."""
    own = np.array([np.count_nonzero(ids == q) for q in query_ids])
    want = int(k + own.max(initial=0))
    # dropped bits change a sum by less than this, in units of the last kept slice
    slack = (np.abs(queries).sum(axis=1) * ((1 << slices.shift) - 1) >> slices.shift) + 1 if slices.shift else np.zeros(len(queries), dtype=np.int64)
    found = slices.boundary(slices.add(queries), want, slack)
    for q in range(len(queries)):
        rows = np.flatnonzero(np.unpackbits(found[q].view(np.uint8), bitorder="little"))
        rows = rows[ids[rows] != query_ids[q]]
        scores = values[rows] @ queries[q]
        best = np.lexsort((ids[rows], -scores))[:k]
        yield q, ids[rows[best]], scores[best]


def search(df: DataFrame, k: int = 10, every: int = 100, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for every row whose id is divisible by ``every``."""
    vectors = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    vectors = vectors.where("vec_id is not null and size(embedding) > 0").where(finite)
    index = materialize(_blocks(vectors, BLOCK_ROWS), "index")
    wanted = materialize(vectors.where(F.col("vec_id") % every == 0), "wanted")
    n_queries = -(-wanted.count() // QUERY_ROWS)
    blocks = _blocks(wanted.repartition(max(1, n_queries // 16), "vec_id"), QUERY_ROWS)
    asked = materialize(blocks.withColumn("q_block", F.monotonically_increasing_id()), "queries")  # ids may repeat, blocks are blocks of their own
    n_index = index.count()
    rows, columns = _grid(n_index * n_queries, n_index, n_queries)
    part = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = index.select("dim", "ids", "vectors", part("ids", rows).alias("g"), every_of(columns).alias("h"))
    right = asked.select("dim", "q_block", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), part("q_block", columns).alias("h"), every_of(rows).alias("g"))
    pairs = right.join(left.hint("shuffle_hash"), ["g", "h", "dim"])  # every query block meets every block of the index once

    def run(batches):
        cached: tuple[bytes, Slices] | None = None
        best: dict[tuple[int, int], tuple[np.ndarray, Best]] = {}
        for batch in batches:
            for dim, q_block, q_ids, q_vectors, ids, vectors in zip(*[batch.column(c) for c in ("dim", "q_block", "q_ids", "q_vectors", "ids", "vectors")], strict=True):
                data, d = vectors.as_py(), dim.as_py()
                values, asked_ids = np.frombuffer(data, dtype=np.int64).reshape(-1, d), np.asarray(q_ids.values)
                queries = np.frombuffer(q_vectors.as_py(), dtype=np.int64).reshape(-1, d)
                known = best.setdefault((q_block.as_py(), d), (asked_ids, Best(len(asked_ids), k)))[1]
                at = known.open(reachable(values, queries))
                if not len(at):
                    continue
                if cached is None or cached[0] != data:
                    cached = (data, Slices(values))
                for q, found, scores in top_rows(cached[1], values, np.asarray(ids.values), queries[at], asked_ids[at], k):
                    known.add(at[q], found, scores)
        for (q_block, _), (asked_ids, known) in best.items():
            n = [len(x) for x in known.ids]
            if sum(n):
                q = np.repeat(np.arange(len(n)), n)
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (np.full(len(q), q_block), q, asked_ids[q], np.concatenate(known.ids), np.concatenate(known.scores))], names=["q_block", "q", "query_id", "vec_id", "score"])

    local = pairs.mapInArrow(run, "q_block long, q long, query_id long, vec_id long, score long")
    ranked = local.withColumn("rank", F.row_number().over(Window.partitionBy("q_block", "q", "query_id").orderBy(F.col("score").desc(), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
