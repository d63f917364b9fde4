"""Spelling variants: words that differ by one code point, found by pivotal grams and grouped under their frequent form.

Bigrams are ordered by the number of words that hold them, then by letters and place. The prefix of a word is its first
three; one edit spoils two adjacent bigrams at most. The pivots are the two disjoint bigrams of the prefix with the
smallest sum of counts, found by dynamic programming; one edit leaves one of them whole. So of two near words, the one
whose prefix ends earlier has a pivot that is in the other's prefix.

Position limits: a single edit is on one side of a pivot that is left whole. On the other side the words are equal up
to their end, so the pivot is at the same distance from it in both; and in one half of the edited side they are equal
too. Pivots are looked up under both sides and both halves, by the text that has to be equal, so the words of one entry
share more than half of their letters, whatever the number of words. What meets is verified by edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from os.path import commonprefix

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotstream.llm.common import materialize

LETTERS = "A-Za-z\\u00C0-\\u00FF"
#: Letters up to which words are compared in the join already.
SHORT = 64
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def misspelt(doc_id: Column, run: Column, one_in: int = 31) -> Column:
    """``run`` without one code point, if the checksum of id and run is a multiple of ``one_in``; a null id counts as empty."""
    checksum = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(checksum, F.char_length(run).cast("long")).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(F.pmod(checksum, F.lit(one_in)) == 0, cut).otherwise(run)


def count_words(docs: DataFrame, least_length: int = 7, least_count: int = 2, one_in: int = 31) -> DataFrame:
    """word, n: the words of all texts that are long and frequent enough."""
    runs = F.expr(f"regexp_extract_all(text, '[{LETTERS}]{{{least_length},}}', 0)")  # shorter runs make no word
    run = docs.select("doc_id", F.explode(runs).alias("run")).select("doc_id", F.translate("run", _UPPER, _UPPER.lower()).alias("run"))
    words = run.select(misspelt(F.col("doc_id"), F.col("run"), one_in).alias("word")).where(F.char_length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def bigram_counts(words: DataFrame) -> dict[str, int]:
    """Number of words that hold each bigram: at most the square of the alphabet (90 letters), whatever the number of words."""
    letters = words.select(F.filter(F.split("word", ""), lambda x: x != "").alias("x"))
    pairs = F.zip_with("x", F.slice("x", 2, F.size("x")), lambda a, b: F.concat(a, b))  # null behind the last
    grams = letters.select(F.explode(F.array_distinct(F.array_compact(pairs))).alias("gram"))
    return {r.gram: r.n for r in grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()}


def prefix_places(word: str, counts: dict[str, int]) -> tuple[list[int], list[int]]:
    """Places of the three bigrams of ``word`` that come first, and those under which it has to be found.

    Bigrams come in order of count, letters and place. An edit can move a bigram by one place, so the place behind the
    last of the three is another one to be found under, if the same bigram is there.
    """
    order = sorted((counts.get(word[i : i + 2], 0), word[i : i + 2], i) for i in range(len(word) - 1))[:3]
    places, (_, gram, last) = [i for _, _, i in order], order[-1]
    return sorted(places), sorted({*places, last + 1} if word[last + 1 : last + 3] == gram else places)


def pivot_places(word: str, places: list[int], counts: dict[str, int], pivots: int = 2) -> list[int]:
    """The ``pivots`` places of disjoint bigrams with the smallest sum of counts (dynamic programming over places)."""
    best: list[list[tuple[int, tuple[int, ...]] | None]] = [[(0, ())] + [None] * pivots]  # by places seen, by number chosen
    for k, place in enumerate(places):
        free = sum(p <= place - 2 for p in places[:k])
        weight, row = counts.get(word[place : place + 2], 0), list(best[-1])
        for chosen in range(1, pivots + 1):
            if before := best[free][chosen - 1]:
                taken = (before[0] + weight, (*before[1], place))
                row[chosen] = min(filter(None, (row[chosen], taken)))
        best.append(row)
    return list(best[-1][pivots][1])


def _entry(side: int, text: str, place: int, rest: int, half: int) -> int:
    """Key of a bigram at ``place`` for words that go on for ``rest`` letters behind it: the letters that have to be equal."""
    cut = rest // 2
    equal = text[: place + 2 + cut] if half == 0 else text[: place + 2] + "|" + (text[-(rest - cut) :] if rest > cut else "")
    return xxhash.xxh64_intdigest(f"{side}{half}{place}.{rest}.{equal}") - (1 << 63)


def entries(word: str, places: list[int], shifts: tuple[int, ...]) -> list[int]:
    """Keys of the bigrams at ``places``, for partners that are longer by each of ``shifts``."""
    out = set()
    for side, text in ((0, word), (1, word[::-1])):
        for p in places:
            place = p if side == 0 else len(word) - p - 2
            own = len(word) - place - 2
            for rest in (own + s for s in shifts):
                if rest >= 0:
                    out |= {_entry(side, text, place, rest, half) for half in (0, 1) if half == 0 or rest - rest // 2 <= own}
    return sorted(out)


def one_edit(x: str, y: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes ``x`` into ``y``; time in proportion to their length."""
    k = len(commonprefix((x, y)))
    a, b = x[k:], y[k:]
    return a != b and (a[1:] == b[1:] and bool(a) == bool(b) or a[1:] == b or a == b[1:])


def near_pairs(words: DataFrame) -> DataFrame:
    """a, b (a < b): words that differ by exactly one inserted, deleted or replaced code point. ``words``: word, distinct, of four letters or more."""
    counts = bigram_counts(words)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pivots, prefixes = [], []
            for word in batch["word"]:
                places, reach = prefix_places(word, counts)
                pivots.append(entries(word, pivot_places(word, places, counts), (0,)))
                prefixes.append(entries(word, reach, (-1, 0, 1)))
            yield pd.DataFrame({"word": batch["word"], "pivots": pivots, "prefix": prefixes})

    keyed = materialize(words.select("word").mapInPandas(index, "word string, pivots array<bigint>, prefix array<bigint>"), "grams")
    pivots = keyed.select(F.col("word").alias("x"), F.explode("pivots").alias("key"))
    prefixes = keyed.select(F.col("word").alias("y"), F.explode("prefix").alias("key"))
    verified = F.pandas_udf(lambda x, y: pd.Series([one_edit(a, b) for a, b in zip(x, y, strict=True)], dtype=bool), "boolean")
    # most of what meets is told apart in the join; its edit distance takes time in proportion to the square of long words
    met = pivots.join(prefixes, "key").where("x <> y").where((F.char_length("x") > SHORT) | (F.levenshtein(F.col("x"), F.col("y"), 1) == 1))
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct().where(verified("a", "b"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of the way from a word over its form, that word's form, and so on.

    Each round doubles the ways. A form has at least ten times its word's count, so a way has fewer steps than the
    largest count has digits, and a handful of rounds ends all.
    """
    ways = materialize(forms.select("word", F.col("form").alias("root")), "ways")
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = materialize(ways.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "ways")
        ways = after.select("word", "root")
        if after.where("moved").isEmpty():
            return ways


def group(docs: DataFrame, least_length: int = 7, least_count: int = 2, ratio: int = 10, one_in: int = 31) -> DataFrame:
    """word, form, root, n, n_near, form_n for the words of all texts.

    A word's form is its most frequent near word (ties: the smallest), if that is ``ratio`` times as frequent as the
    word itself; its root is where its forms end, itself if it has none. Null and empty texts have no words; a null
    doc_id counts as empty; repeated rows count as often as they occur; other columns are ignored; an empty table gives
    an empty result.
    """
    words = materialize(count_words(docs, least_length, least_count, one_in), "words")
    pairs = materialize(near_pairs(words), "near")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).select(F.col("a").alias("word"), F.col("b").alias("other"))
    other = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    nearest = both.join(other, "other").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    fits = -F.col("best.less") >= ratio * F.col("n")
    joined = words.join(nearest, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("best.other")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")
    )
    found = materialize(joined, "forms")
    ends = roots(found.where("form IS NOT NULL"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
