"""Phrase collocations by weighted acyclic automata.

An automaton reads phrases word by word and gives their counts. A state is the beginning of some phrases; the arcs are
kept level by level, in the order of their paths, with a label (a 64-bit hash of the word), a weight (occurrences of
the path as a phrase) and the number of arcs that go on from there. Each task builds one for every block of text from
the block's sorted n-grams, and cuts it by ranges of the first two words; the automata of a range from all blocks are
united and their weights summed, so that a frequent first word is spread over all ranges. Counts of the parts of
phrases are looked up by composition: the automaton of the parts asked for reads along with the one that has counts.

Counts are exact. Arcs of single words carry the spelling, so two words of one hash are noticed, and are an error.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotstream.llm.common import _FOLD, _hash_words, materialize, mix

PIECE_ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
WORDS = 3
#: Bytes of text in a block.
BLOCK = 4 << 20
#: Groups in which a language's phrases are ranked first, so that no task sorts them all.
SPREAD = 256
_ENDS = np.zeros(256, np.uint8)
_ENDS[list(PIECE_ENDS)] = 1
_BREAKS = _ENDS.astype(bool)
_BREAKS[list(BLANKS)] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)

Path = list[np.ndarray]  # a column of labels for each word


# ---------------------------------------------------------------- automata
def _summed(path: Path, *values: np.ndarray) -> tuple[Path, list[np.ndarray]]:
    """Sorted distinct paths, and the sums of each value."""
    if not len(path[0]):
        return path, list(values)
    order = np.lexsort(path[::-1])
    path = [p[order] for p in path]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([p[1:] != p[:-1] for p in path])
    first = np.flatnonzero(new)
    return [p[first] for p in path], [np.add.reduceat(v[order], first) for v in values]


class Automaton:
    """``labels``, ``weights`` and ``fanout`` by level, and the ``spelling`` of the words that have a weight of their own here."""

    def __init__(self, labels: Path, weights: Path, fanout: Path, spelling: list[bytes | None]):
        self.labels, self.weights, self.fanout, self.spelling = labels, weights, fanout, spelling

    @classmethod
    def build(cls, grams: list[tuple[Path, np.ndarray]], words: dict[int, bytes]) -> Automaton:
        """From phrases of one, two, ... words with their counts, in any order; equal phrases are summed."""
        labels, weights, fanout = [], [], []
        longer: Path | None = None
        for path, counts in reversed(grams):
            begun = [np.concatenate([p, q]) for p, q in zip(path, longer, strict=False)] if longer else path
            extra = len(begun[0]) - len(path[0])
            path, (w, n) = _summed(begun, np.concatenate([counts, np.zeros(extra, np.int64)]), np.concatenate([np.zeros(len(counts), np.int64), np.ones(extra, np.int64)]))
            labels.insert(0, path[-1])
            weights.insert(0, w)
            fanout.insert(0, n)
            longer = path[:-1]
        return cls(labels, weights, fanout, [words.get(x) for x in labels[0].tolist()])

    def paths(self) -> list[tuple[Path, np.ndarray]]:
        """All phrases by number of words, sorted, with their weights (0: only the beginning of others)."""
        out: list[tuple[Path, np.ndarray]] = []
        for level, label in enumerate(self.labels):
            before = [np.repeat(p, self.fanout[level - 1]) for p in out[-1][0]] if out else []
            out.append(([*before, label], self.weights[level]))
        return out

    def words(self) -> dict[int, bytes]:
        return {x: w for x, w in zip(self.labels[0].tolist(), self.spelling, strict=True) if w is not None}

    def pruned(self, least: int) -> Automaton:
        """Without phrases of a smaller weight; no phrase is more frequent than its parts, so all beginnings stay."""
        return Automaton.build([([p[w >= least] for p in path], w[w >= least]) for path, w in self.paths()], self.words())

    def compose(self, other: Automaton) -> list[tuple[Path, np.ndarray]]:
        """The phrases of this automaton that ``other`` has too, with the weights of the other one."""
        out = []
        mine, theirs = np.zeros(1, np.int64), np.zeros(1, np.int64)  # pairs of states, by their first arcs
        n_mine, n_theirs = np.array([len(self.labels[0])]), np.array([len(other.labels[0])])
        path: Path = []
        for level in range(len(self.labels)):
            if level == len(other.labels):
                break
            arc = _runs(mine, n_mine)
            pair = np.repeat(np.arange(len(mine)), n_mine)
            found = _within(other.labels[level], theirs[pair], n_theirs[pair], self.labels[level][arc])
            arc, pair, found = arc[found >= 0], pair[found >= 0], found[found >= 0]
            path = [*(p[pair] for p in path), self.labels[level][arc]]
            asked = self.weights[level][arc] > 0
            out.append(([p[asked] for p in path], other.weights[level][found[asked]]))
            mine, n_mine = _starts(self.fanout[level])[arc], self.fanout[level][arc]
            theirs, n_theirs = _starts(other.fanout[level])[found], other.fanout[level][found]
        return out

    def dump(self) -> bytes:
        alphabet, ids = np.unique(np.concatenate(self.labels), return_inverse=True)
        return pickle.dumps((alphabet, [len(x) for x in self.labels], *map(_small, (ids, *self.weights, *self.fanout)), self.spelling), 5)

    @classmethod
    def load(cls, data: bytes) -> Automaton:
        alphabet, lengths, ids, *rest, spelling = pickle.loads(data)  # what dump() wrote
        labels = np.split(alphabet[ids], np.cumsum(lengths)[:-1])
        numbers = [x.astype(np.int64) for x in rest]
        return cls(labels, numbers[: len(lengths)], numbers[len(lengths) :], spelling)


def _small(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max()))) if len(x) else x


def _starts(n: np.ndarray) -> np.ndarray:
    return np.cumsum(n) - n


def _runs(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for n numbers each."""
    return np.arange(int(n.sum())) + np.repeat(first - _starts(n), n)


def _within(labels: np.ndarray, first: np.ndarray, n: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where ``wanted`` is among the ``n`` sorted labels from ``first`` on, or -1: a binary search of all at once."""
    low, high = first.copy(), first + n
    for _ in range(int(n.max()).bit_length() if len(n) else 0):
        middle = (low + high) // 2
        right = (low < high) & (labels[np.minimum(middle, len(labels) - 1)] < wanted)
        low, high = np.where(right, middle + 1, low), np.where(right | (low >= high), high, middle)
    hit = low < first + n
    hit[hit] = labels[low[hit]] == wanted[hit]
    return np.where(hit, low, -1)


def unite(automata: list[Automaton]) -> Automaton:
    """The sum of all weights; ValueError if two words have one hash."""
    words: dict[int, bytes] = {}
    for automaton in automata:
        for x, w in automaton.words().items():
            if words.setdefault(x, w) != w:
                raise ValueError(f"the words {w!r} and {words[x]!r} have the same hash")
    every = [a.paths() for a in automata]
    levels = [[p[level] for p in every] for level in range(WORDS)]
    return Automaton.build([([np.concatenate([p[k] for p, _ in level]) for k in range(i + 1)], np.concatenate([w for _, w in level])) for i, level in enumerate(levels)], words)


def range_of(parts: int, first: np.ndarray, second: np.ndarray | None = None) -> np.ndarray:
    """The range, out of ``parts``, of a phrase that begins with one or two words."""
    key = mix(first * _ODD if second is None else mix(first * _ODD) ^ (second * _ODD))
    return ((key >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


# ---------------------------------------------------------------- blocks of text
def cut(text: bytes, block: int = BLOCK) -> Iterator[tuple[bytes, int]]:
    """A text in segments of about ``block`` bytes, cut between words, and the words of each that the one before has counted.

    Phrases across a cut begin in the last words of the segment before, which are repeated for them.
    """
    start, fresh, again = 0, 0, 0
    while fresh < len(text):
        end = min(fresh + block, len(text))
        while end < len(text) and not _BREAKS[text[end]]:
            end += 1
        yield text[start:end], again
        breaks = _BREAKS[np.frombuffer(text[start:end], np.uint8)]
        begins = np.flatnonzero(~breaks & np.concatenate([[True], breaks[:-1]]))
        again = min(WORDS - 1, len(begins))
        start, fresh = (start + int(begins[-again]) if again else end), end


def block_grams(data: bytes, again: int = 0) -> tuple[list[tuple[Path, np.ndarray]], dict[int, bytes]]:
    """Counts of the phrases of one to three words within the pieces of a text, and the spelling of its words."""
    letters = _FOLD[np.frombuffer(data, np.uint8)]
    word = np.zeros(len(letters) + 2, np.int8)
    word[1:-1] = ~_BREAKS[letters]
    edge = np.diff(word)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if len(starts) <= again:
        return [([np.empty(0, np.uint64)] * (i + 1), np.empty(0, np.int64)) for i in range(WORDS)], {}
    labels, at, ids = np.unique(_hash_words(letters, starts, ends), return_index=True, return_inverse=True)
    piece = np.cumsum(_ENDS[letters], dtype=np.int64)[starts]
    n, grams = len(labels), []
    for size in range(1, WORDS + 1):
        whole = piece[size - 1 :] == piece[: len(piece) - size + 1]
        whole[: max(0, again - size + 1)] = False
        key = np.zeros(int(whole.sum()), np.uint64)
        for k in range(size):
            key = key * np.uint64(n) + ids[k : len(ids) - size + 1 + k][whole].astype(np.uint64)
        keys, counts = np.unique(key, return_counts=True)
        path: Path = []
        for _ in range(size):
            path.insert(0, labels[(keys % np.uint64(n)).astype(np.int64)])
            keys //= np.uint64(n)
        grams.append((path, counts.astype(np.int64)))
    folded = letters.tobytes()
    return grams, {x: folded[starts[i] : ends[i]] for x, i in zip(labels.tolist(), at.tolist(), strict=True)}


def _ranges(grams: list[tuple[Path, np.ndarray]], words: dict[int, bytes], parts: int) -> Iterator[tuple[int, Automaton]]:
    """An automaton for each range that has phrases."""
    sorted_grams = []
    for path, counts in grams:
        part = range_of(parts, *path[:2]).astype(np.int64)
        order = np.argsort(part, kind="stable")
        sorted_grams.append(([p[order] for p in path], counts[order], np.searchsorted(part[order], np.arange(parts + 1))))
    for part in range(parts):
        cuts = [slice(bounds[part], bounds[part + 1]) for _, _, bounds in sorted_grams]
        if any(c.stop > c.start for c in cuts):
            own = [([p[c] for p in path], counts[c]) for (path, counts, _), c in zip(sorted_grams, cuts, strict=True)]
            yield part, Automaton.build(own, {x: words[x] for x in own[0][0][0].tolist()})


def shard_automata(docs: DataFrame, parts: int, block: int = BLOCK) -> DataFrame:
    """lang, part, automaton: the phrases of each block of text, by range."""

    def rows(lang: str, data: bytes, again: int = 0) -> Iterator[pa.RecordBatch]:
        for part, automaton in _ranges(*block_grams(data, again), parts):
            yield pa.RecordBatch.from_pydict({"lang": [lang], "part": pa.array([part], pa.int32()), "automaton": [automaton.dump()]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = text.as_py()
                if len(data) > block:
                    for segment, again in cut(data, block):
                        yield from rows(lang, segment, again)
                    continue
                if sizes and (sizes.get(lang, 0) + len(data) >= block or sum(sizes.values()) + len(data) >= 2 * block):
                    fullest = max(sizes, key=sizes.__getitem__)
                    sizes.pop(fullest)
                    yield from rows(fullest, b"\n".join(waiting.pop(fullest)))
                waiting.setdefault(lang, []).append(data)
                sizes[lang] = sizes.get(lang, 0) + len(data) + 1
        for lang, texts in waiting.items():
            yield from rows(lang, b"\n".join(texts))

    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    return texts.mapInArrow(run, "lang string, part int, automaton binary")


# ---------------------------------------------------------------- phrases
def count_phrases(docs: DataFrame, least: int, parts: int, block: int = BLOCK) -> DataFrame:
    """lang, part, automaton, n: one automaton for each range with the phrases of ``least`` occurrences or more, and the words that the range counts."""

    def run(table: pa.Table) -> pa.Table:
        total = unite([Automaton.load(x.as_py()) for x in table["automaton"]])
        n = int(total.weights[0].sum())
        first = table.slice(0, 1)
        return pa.table({"lang": first["lang"], "part": first["part"], "automaton": [total.pruned(least).dump()], "n": [n]})

    return shard_automata(docs, parts, block).groupBy("lang", "part").applyInArrow(run, "lang string, part int, automaton binary, n bigint")


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def candidates(counted: DataFrame) -> DataFrame:
    """lang, w1, w2, w3, a, f12: phrases of two words (w3 and f12 null) and of three, with f12 the count of their first two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                automaton = Automaton.load(data.as_py())
                _, (pair, n2), (triple, n3) = automaton.paths()
                f12 = np.repeat(n2, automaton.fanout[1])
                none = pa.nulls(len(n2), pa.int64())
                for columns in ([*map(_signed, pair), none, pa.array(n2), none], [*map(_signed, triple), pa.array(n3), pa.array(f12)]):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(columns[0]), pa.string()), *columns], names=["lang", "w1", "w2", "w3", "a", "f12"])

    return counted.select("lang", "automaton").mapInArrow(run, "lang string, w1 bigint, w2 bigint, w3 bigint, a bigint, f12 bigint")


def look_up(asked: DataFrame, counted: DataFrame, parts: int) -> DataFrame:
    """lang, w1, w2, n, word for the distinct phrases asked for (lang, w1, w2; w2 null: one word, which is spelt)."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            single = batch.column(2).is_null().to_numpy(zero_copy_only=False)
            first, second = (batch.column(i).fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64) for i in (1, 2))
            part = np.where(single, range_of(parts, first), range_of(parts, first, second)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part)], names=["lang", "w1", "w2", "part"])

    def run(questions: pa.Table, answers: pa.Table) -> pa.Table:
        columns: list[list] = [[], [], [], [], []]
        if len(questions) and len(answers):
            first, second = (questions[c].combine_chunks() for c in ("w1", "w2"))
            pair = second.is_valid().to_numpy(zero_copy_only=False)
            one, two = (x.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64) for x in (first, second))
            ones = [np.ones(int(k.sum()), np.int64) for k in (~pair, pair)]
            asked_for = Automaton.build([([one[~pair]], ones[0]), ([one[pair], two[pair]], ones[1])], {})
            counts = unite([Automaton.load(x.as_py()) for x in answers["automaton"]])
            spelling, lang = counts.words(), questions["lang"][0].as_py()
            for path, n in asked_for.compose(counts):
                words = [spelling.get(x) for x in path[0].tolist()] if len(path) == 1 else [None] * len(n)
                for k, values in enumerate(([lang] * len(n), _signed(path[0]).to_pylist(), _signed(path[1]).to_pylist() if len(path) > 1 else [None] * len(n), n.tolist(), words)):
                    columns[k] += values
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["lang", "w1", "w2", "n", "word"])

    placed = asked.select("lang", "w1", "w2").mapInArrow(place, "lang string, w1 bigint, w2 bigint, part int")
    met = placed.groupBy("lang", "part").cogroup(counted.select("lang", "part", "automaton").groupBy("lang", "part"))
    return met.applyInArrow(run, "lang string, w1 bigint, w2 bigint, n bigint, word binary")


def _score(a: str, left: str, right: str) -> str:
    wide = "CAST({} AS DECIMAL(19,0))".format
    return f"1000000 * {wide(a)} * {wide(a)} DIV ({wide(left)} * {wide(right)})"


def collocations(docs: DataFrame, least: int = 10, percent: int = 50, top: int = 2000, parts: int | None = None, block: int = BLOCK) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of two and three words of each language.

    a: occurrences; l, r: those of the two parts at the cut with the lowest score 1000000 a^2 / (l r), rounded down; n:
    words of the language. Phrases inside a longer candidate that has ``percent`` of their occurrences are left out.
    A null lang is ``und``; null and empty texts have no words; repeated rows count as often as they occur; ties are
    in order of the phrase; a doc_id or other columns are not looked at; an empty table gives an empty result. Counts
    up to 10^13 are exact in the scores. ``parts``: number of ranges, by default that of Spark's shuffle partitions.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = materialize(count_phrases(docs, least, parts, block), "phrases")
    found = materialize(candidates(counted), "candidates")
    pairs, triples = found.where("w3 IS NULL"), found.where("w3 IS NOT NULL")
    none = F.lit(None).cast("bigint").alias("w2")
    single = found.select("lang", F.explode(F.array_compact(F.array("w1", "w2", "w3"))).alias("w1")).select("lang", "w1", none)
    asked = single.unionByName(triples.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"))).distinct()
    answers = materialize(look_up(asked, counted, parts), "parts")
    word = answers.where("w2 IS NULL")
    of = lambda k: word.select("lang", F.col("w1").alias(f"w{k}"), F.col("n").alias(f"f{k}"), F.col("word").cast("string").alias(f"s{k}"))
    rest = answers.where("w2 IS NOT NULL").select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("n").alias("f23"))
    inside = triples.select("lang", "w1", "w2", "a").unionByName(triples.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    longer = inside.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
    alone = pairs.join(longer, ["lang", "w1", "w2"], "left").where(f"longer IS NULL OR 100 * longer < {percent} * a").drop("longer")
    spelt2 = alone.join(of(1), ["lang", "w1"]).join(of(2), ["lang", "w2"])
    two = spelt2.select("lang", "a", F.concat_ws(" ", "s1", "s2").alias("phrase"), F.col("f1").alias("l"), F.col("f2").alias("r"), F.expr(_score("a", "f1", "f2")).alias("score"))
    spelt3 = triples.join(rest, ["lang", "w2", "w3"]).join(of(1), ["lang", "w1"]).join(of(2), ["lang", "w2"]).join(of(3), ["lang", "w3"])
    cuts = spelt3.select("lang", "a", "f1", "f23", "f12", "f3", F.concat_ws(" ", "s1", "s2", "s3").alias("phrase"), F.expr(_score("a", "f1", "f23")).alias("x1"), F.expr(_score("a", "f12", "f3")).alias("x2"))
    three = cuts.selectExpr("lang", "a", "phrase", "if(x1 <= x2, f1, f12) AS l", "if(x1 <= x2, f23, f3) AS r", "least(x1, x2) AS score")
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    spread = two.unionByName(three).withColumn("_s", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD)))
    best = spread.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_s").orderBy(*order))).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(counted.groupBy("lang").agg(F.sum("n").alias("n")), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
