"""SimHash near duplicates by anchor-point covering.

The anchors are the words of a covering code: every fingerprint has a home, the nearest anchor, within the code's
covering radius R. Two fingerprints that differ in at most t bits have a point between them that is within t/2 bits
of either, so a fingerprint is replicated to every anchor within R + t/2 that is home to a point within t/2 bits of
it, and two linked fingerprints meet at an anchor at least. Fingerprints are compared anchor by anchor.

The code is a product of perfect codes on blocks of bits (two binary Golay codes of 23 bits with R = 3 each, and a
Hamming code of 15 bits with R = 1 for more than FINE_ABOVE fingerprints); bits outside the blocks are covered by the
one word 0 and do not move a home. Nothing depends on a bucket's size: anchors with more than ``limit`` fingerprints
are left to the finest code of all, in which every point is an anchor (R = 0). There all fingerprints of an anchor are
linked, so each of them is joined with the smallest only.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotstream.llm.common import bounded, materialize
from slotstream.llm.components import connected_components

BITS, SEED = 64, 42
#: Fingerprints of one anchor that are compared with each other.
LIMIT = 4096
#: Distinct fingerprints beyond which a third block makes the anchors finer.
FINE_ABOVE = 20_000_000
#: Shingles whose bits are counted at a time.
_SLICE = 1 << 16
# fixed values: (bits, generator polynomial, covering radius) of the binary Golay code and of a Hamming code
GOLAY, HAMMING = (23, 0b101011100011, 3), (15, 0b10011, 1)


# ---------------------------------------------------------------- fingerprints
def fingerprint(text: bytes | None, size: int = 4) -> int:
    """The signed 64-bit fingerprint of a text in UTF-8: a bit is 1 if set in over half of its shingles' hashes.

    Shingles are ``size`` consecutive words, repeats included; fewer words are one shingle, no word at all gives 0.
    """
    words = (text or b"").lower().split()  # bytes: lower-cases A-Z only, splits at the six ASCII separators only
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    n = max(1, len(words) - size + 1)
    first, last = (ends - lengths)[:n], ends[min(size, len(words)) - 1 :]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, _SLICE):
        spans = zip(first[at : at + _SLICE].tolist(), last[at : at + _SLICE].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(text: str, size: int = 4) -> Column:
    """The fingerprint of a text column."""
    return F.pandas_udf(lambda texts: texts.map(lambda t: fingerprint(t, size)).astype("int64"), "bigint")(F.coalesce(F.col(text).cast("binary"), F.lit(b"")))


# ---------------------------------------------------------------- anchors
def flips(bits: int, most: int) -> np.ndarray:
    """All masks of at most ``most`` of the lowest ``bits`` bits."""
    return np.array([sum(1 << i for i in chosen) for k in range(most + 1) for chosen in combinations(range(bits), k)], np.uint64)


class Block:
    """A perfect cyclic code on some bits: the syndrome of a word names the flips that lead to its code word."""

    def __init__(self, offset: int, bits: int, generator: int, radius: int):
        self.offset, self.bits = np.uint64(offset), bits
        degree = generator.bit_length() - 1
        self.of_bit = np.zeros(bits, np.uint16)
        rest = 1
        for i in range(bits):  # x**i modulo the generator
            self.of_bit[i] = rest
            rest <<= 1
            rest ^= generator if rest >> degree else 0
        leaders = flips(bits, radius)
        self.leaders = np.zeros(1 << degree, np.uint64)
        self.leaders[self._syndrome(leaders)] = leaders << self.offset

    def _syndrome(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(words.shape, np.uint16)
        for i in range(self.bits):
            out ^= ((words >> np.uint64(i)) & np.uint64(1)).astype(np.uint16) * self.of_bit[i]
        return out

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        return self._syndrome(words >> self.offset)


class Anchors:
    """The product code of ``blocks``, and where to send fingerprints for a threshold."""

    def __init__(self, threshold: int, *blocks: tuple[int, int, int]):
        self.blocks, offset = [], 0
        for block in blocks:
            self.blocks.append(Block(offset, *block))
            offset += block[0]
        self.coded = np.uint64((1 << offset) - 1)
        self.masks = flips(offset, (threshold + 1) // 2)
        self.mask_syndromes = [b.syndrome(self.masks) for b in self.blocks]

    def homes(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of a word and anchor, for every anchor that is home to a point within half the threshold."""
        points = (words & self.coded)[:, None] ^ self.masks[None, :]
        for block, of_mask in zip(self.blocks, self.mask_syndromes, strict=True):
            points ^= block.leaders[block.syndrome(words)[:, None] ^ of_mask[None, :]]
        points.sort(axis=1)
        new = np.ones(points.shape, bool)
        new[:, 1:] = points[:, 1:] != points[:, :-1]
        return np.nonzero(new)[0], points[new]


def _batches(columns: list[np.ndarray], names: list[str], rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), rows):
        yield pa.RecordBatch.from_arrays([pa.array(c[at : at + rows].view(np.int64)) for c in columns], names=names)


def replicate(words: DataFrame, threshold: int, *blocks: tuple[int, int, int]) -> DataFrame:
    """anchor, fp: the fingerprints of ``words`` (column fp) at each of their anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(threshold, *blocks)
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(values), 512):
                part = values[at : at + 512]
                index, homes = anchors.homes(part)
                yield from _batches([homes, part[index]], ["anchor", "fp"])

    return words.select("fp").mapInArrow(run, "anchor bigint, fp bigint")


# ---------------------------------------------------------------- comparison
def _find(parent: np.ndarray, i: np.ndarray) -> np.ndarray:
    root = parent[i]
    while not np.array_equal(up := parent[root], root):
        root = up
    return root


def _unite(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    while len(i):
        a, b = _find(parent, i), _find(parent, j)
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def local_edges(anchor: np.ndarray, fp: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints sorted by anchor: each with the first one that it reaches by links at its anchor, if another.

    Neighbours at distance 1, 2, 3 ... in the sorted rows are compared at once; links are merged as they are found, so
    what is kept is a row for each fingerprint, not a row for each link.
    """
    parent, i, lag = np.arange(len(fp)), np.arange(len(fp)), 1
    while True:
        i = i[i < len(fp) - lag]
        i = i[anchor[i] == anchor[i + lag]]
        if not len(i):
            break
        near = i[np.bitwise_count(fp[i] ^ fp[i + lag]) <= threshold]
        _unite(parent, near, near + lag)
        lag += 1
    root = _find(parent, np.arange(len(fp)))
    moved = root != np.arange(len(fp))
    return fp[moved], fp[root[moved]]


def compare(at_anchors: DataFrame, threshold: int) -> DataFrame:
    """a, b: links that connect what is connected at some anchor. Anchors hold a bounded number of fingerprints here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor = fp = np.empty(0, np.uint64)
        for batch in batches:
            anchor = np.concatenate([anchor, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)])
            fp = np.concatenate([fp, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            whole = int(np.flatnonzero(anchor != anchor[-1])[-1]) + 1 if len(anchor) and anchor[0] != anchor[-1] else 0  # the last anchor may go on
            yield from _batches([*local_edges(anchor[:whole], fp[:whole], threshold)], ["a", "b"])
            anchor, fp = anchor[whole:], fp[whole:]
        yield from _batches([*local_edges(anchor, fp, threshold)], ["a", "b"])

    return at_anchors.repartition("anchor").sortWithinPartitions("anchor", "fp").mapInArrow(run, "a bigint, b bigint")


def _meet_in_points(words: DataFrame, threshold: int) -> DataFrame:
    """a, b: the same for fingerprints of any number, with every point as an anchor: those at one point are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = flips(BITS, threshold // 2)
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(values), 64):
                part = values[at : at + 64]
                yield from _batches([(part[:, None] ^ masks).ravel(), np.repeat(part, len(masks))], ["point", "fp"])

    points = words.mapInArrow(run, "point bigint, fp bigint")
    first = points.groupBy("point").agg(F.min("fp").alias("b"), F.max("fp").alias("m")).where("b <> m").drop("m")
    return points.join(first, "point").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def links(words: DataFrame, threshold: int = 4, limit: int = LIMIT, fine: bool | None = None) -> DataFrame:
    """a, b: links of distinct fingerprints (column fp) that connect all that differ in ``threshold`` bits at most.

    Every row is a link or leads to a fingerprint that its anchor's links reach. ``threshold`` has to be even, as
    ``limit`` sends full anchors to points halfway. ``fine`` picks the finer code; by default the number of rows does.
    """
    if threshold % 2:
        raise ValueError("an even number of bits is needed")
    if fine is None:
        fine = words.count() > FINE_ABOVE
    at_anchors = materialize(replicate(words, threshold, *([GOLAY, GOLAY, HAMMING] if fine else [GOLAY, GOLAY])), "anchors")
    full = materialize(at_anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select("anchor"), "full")
    if full.isEmpty():
        return compare(at_anchors, threshold)
    full = bounded(full)
    hot = materialize(at_anchors.join(full, "anchor", "left_semi").select("fp").distinct(), "hot")
    return compare(at_anchors.join(full, "anchor", "left_anti"), threshold).unionByName(_meet_in_points(hot, threshold))


def near_duplicates(docs: DataFrame, threshold: int = 4, size: int = 4, limit: int = LIMIT) -> DataFrame:
    """doc_id, fp, class_id, component_id: classes of equal fingerprints, and components of fingerprints that are linked.

    Either id is the smallest doc_id. Texts that are null, empty or without words have the fingerprint 0, and link as
    any other. Repeated rows stay rows. A null doc_id is no id: it gets its class' and component's, and names none
    unless there is no other. Other columns are ignored. An empty table gives an empty result.
    """
    known = materialize(docs.select("doc_id", fingerprints("text", size).alias("fp")), "fingerprints")
    classes = materialize(known.groupBy("fp").agg(F.min("doc_id").alias("class_id")), "classes")
    parts = connected_components(links(classes, threshold, limit)).withColumnRenamed("node", "fp")
    labelled = materialize(classes.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "labelled")
    least = materialize(labelled.groupBy("component").agg(F.min("class_id").alias("component_id")), "least")
    labels = materialize(labelled.join(least, "component").select("fp", "class_id", "component_id"), "labels")
    return known.join(labels, "fp").select("doc_id", "fp", "class_id", "component_id")
