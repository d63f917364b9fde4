"""Quality rules: base counts, and divergence of a document's histograms from its language's reference.

DataFrame functions only. Each document is reduced, in its own row and once, to base counts, a histogram of
character classes and a histogram of common words. The references are the sums of these histograms over all
documents of a language that pass the base rules and are long enough. A document is kept if its base counts pass and,
for both histograms, the Jensen-Shannon distance (base 2, square root of the divergence) to the reference of its own
language is within the limit. Histograms below a minimum length are not judged; it may be lower than the references'.

Null texts have no words. Documents of other or no language add to no reference, and their histograms pass, as there
is nothing to compare them with. Repeated rows are judged alike, each by itself; a distance equal to its limit passes.
A text is judged whole, within its row, so a row of the JVM holds the words of the longest text. ``judge`` carries the key alone, ``keep_good`` all columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotstream.llm.common import bounded, materialize

#: Character classes, after separators; what is left over is the class of all other characters.
CLASSES = ("[A-Z]+", "[0-9]+", "[.,;:!?'\"()-]+", "[#*$%&|<>]+", "[^\\x00-\\x7F]+")
SYMBOL_CLASS = 4  # place in the histogram, separators being 0
SEPARATOR = "[ \t\n\x0b\x0c\r]"
#: Frequent function words of the languages judged.
COMMON_WORDS = {
    "de": "der die das und in zu den mit von ist nicht ein eine auf im".split(),
    "en": "the of and to in is that it for with on by at from are was".split(),
    "es": "el la los las de en y un una que por con para se del".split(),
    "fr": "le la les de des du et un une que qui est dans pour par".split(),
}
WORD_BINS = sorted({w for words in COMMON_WORDS.values() for w in words})


@dataclass(frozen=True)
class Limits:
    """Parameters of the verdict: largest distances, and the lengths from which histograms are judged."""

    class_distance: float = 0.30
    word_distance: float = 0.29
    min_chars: int = 200
    min_words: int = 200
    judged_words: int | None = None  # words from which a word histogram is judged, where other than for the references


def words_of(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text, in order."""
    return F.array_remove(F.split(text, SEPARATOR), "")


def features(df: DataFrame, text: str = "text", lang: str = "lang", *keys: str) -> DataFrame:
    """The keys, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_chars, classes and common of every row."""
    df = df.select(*keys, F.col(lang).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    df = df.withColumn("_pieces", F.split("_text", SEPARATOR))
    df = df.withColumns({"_words": F.array_remove("_pieces", ""), "_chars": F.length("_text"), "_separators": F.size("_pieces") - 1}).drop("_pieces")
    counted = [F.col("_chars") - F.length(F.regexp_replace("_text", c, "")) for c in CLASSES]
    bins = F.array(*map(F.lit, WORD_BINS))
    hits = F.transform(F.filter("_words", lambda w: w.isin(WORD_BINS)), lambda w: F.array_position(bins, w))
    # with one sentinel per bin, a bin's count is the distance between the sentinels' places in sorted order
    sentinels = F.sequence(F.lit(1).cast("long"), F.lit(len(WORD_BINS) + 1).cast("long"))
    df = df.withColumns({"_classes": F.array("_separators", *counted), "_hits": F.sort_array(F.concat(hits, sentinels))})
    in_class = F.aggregate("_classes", F.lit(0), lambda a, x: a + x)
    found = F.transform(F.sequence(F.lit(1), F.lit(len(WORD_BINS))), lambda b: F.array_position(F.col("_hits"), b + 1) - F.array_position(F.col("_hits"), b) - 1)
    # positions take as many low bits as the number of words needs; the rest holds the window's hash
    high = F.call_function("shiftleft", F.lit(-1).cast("long"), F.length(F.bin(F.size("_words"))))
    df = df.withColumns({"_classes": F.concat("_classes", F.array(F.col("_chars") - in_class)), "_common": found, "_high": high})
    df = df.withColumn("_sorted", _sorted_windows())
    same = lambda x, y: x.bitwiseAND(F.col("_high")) == y.bitwiseAND(F.col("_high"))
    twice = F.filter("_sorted", lambda x, i: F.coalesce(same(x, F.get("_sorted", i + 1)), F.lit(False)) | F.coalesce(same(x, F.get("_sorted", i - 1)), F.lit(False)))
    # the shortened hashes only propose windows; the words decide
    at = lambda x, k: F.get("_words", (x.bitwiseAND(F.bitwise_not(F.col("_high"))) + k).cast("int"))
    df = df.withColumn("_twice", twice)
    proposed = F.transform("_twice", lambda x: F.struct(at(x, 0).alias("a"), at(x, 1).alias("b"), at(x, 2).alias("c"), x.bitwiseAND(F.bitwise_not(F.col("_high"))).alias("p")))
    df = df.withColumn("_proposed", F.sort_array(proposed))
    equal = lambda x, i: F.coalesce(F.struct(x["a"], x["b"], x["c"]) == F.struct(*[F.get("_proposed", i)[k] for k in "abc"]), F.lit(False))
    df = df.withColumn("_starts", F.sort_array(F.transform(F.filter("_proposed", lambda x, i: equal(x, i + 1) | equal(x, i - 1)), lambda x: x["p"])))
    start = F.struct(F.lit(-3).cast("long").alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate("_starts", start, lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3).cast("long"), p - a["last"])).alias("n")), lambda a: a["n"])
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda line: line.rlike("[^ \t\n\x0b\x0c\r]")))
    others = F.size("_words") - F.aggregate("_common", F.lit(0).cast("long"), lambda a, x: a + x)
    return df.select(
        *keys,
        "lang",
        F.size("_words").cast("long").alias("n_words"),
        (F.col("_chars") - F.col("_separators")).cast("long").alias("word_chars"),
        F.get("_classes", F.lit(SYMBOL_CLASS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.col("_chars").cast("long").alias("n_chars"),
        F.col("_classes").cast("array<bigint>").alias("classes"),
        F.concat("_common", F.array(others)).alias("common"),
    )


def _window_hash(*words: Column) -> Column:
    return F.xxhash64(*words)


def _sorted_windows() -> Column:
    """(hash, position) longs of the 3-word windows in order, where equal windows have equal hashes."""
    n = F.size("_words")
    window = F.transform(F.sequence(F.lit(0), n - 3), lambda i: _window_hash(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)).bitwiseAND(F.col("_high")).bitwiseOR(i.cast("long")))
    return F.when(n >= 4, F.sort_array(window)).otherwise(F.array().cast("array<bigint>"))


def _base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def references(counts: DataFrame, limits: Limits = Limits()) -> dict[str, tuple[list[float], list[float]]]:
    """Class and word shares per language, over all its documents that reach the minimum lengths. ``counts``: ``features``.

    The driver gets one number per language and bin, at most (languages) x (bins) of them.
    """
    counts = counts.where(~_base_failed() & F.col("lang").isin(list(COMMON_WORDS)) & (F.col("n_words") >= limits.min_words) & (F.col("n_chars") >= limits.min_chars))
    binned = counts.select("lang", F.posexplode(F.concat("classes", "common"))).where("col > 0").groupBy("lang", "pos").agg(F.sum("col").alias("n"))
    split = len(CLASSES) + 2
    sums: dict[str, list[int]] = {}
    for row in binned.collect():
        sums.setdefault(row["lang"], [0] * (split + len(WORD_BINS) + 1))[row["pos"]] = row["n"]
    return {name: tuple([x / max(1, sum(part)) for x in part] for part in (n[:split], n[split:])) for name, n in sorted(sums.items())}


def js_distance(counts: Column, total: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance, base 2, of an array of counts to shares; null for a total of 0."""

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    shares = F.transform(counts, lambda c: c / total)
    terms = F.zip_with(shares, F.array(*map(F.lit, reference)), lambda p, q: part(p, (p + q) / 2) + part(q, (p + q) / 2))
    return F.when(total > 0, F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2)))


def verdicts(counts: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``features`` with class_distance, word_distance, base_failed and kept, against the references from the same rows."""
    refs = references(counts, limits)
    out = counts.withColumns(
        {
            "class_distance": _to_own("classes", F.col("n_chars"), {name: r[0] for name, r in refs.items()}),
            "word_distance": _to_own("common", F.col("n_words"), {name: r[1] for name, r in refs.items()}),
        }
    )
    failed = _base_failed()
    judged_words = limits.min_words if limits.judged_words is None else limits.judged_words
    far = ((F.col("n_chars") >= limits.min_chars) & (F.coalesce("class_distance", F.lit(0.0)) > limits.class_distance)) | ((F.col("n_words") >= judged_words) & (F.coalesce("word_distance", F.lit(0.0)) > limits.word_distance))
    return out.withColumns({"base_failed": failed, "kept": ~failed & ~far}).drop("lang", "n_chars", "classes", "common")


def judge(df: DataFrame, limits: Limits = Limits(), text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """The key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, class_distance, word_distance, base_failed and kept of every row."""
    return verdicts(materialize(features(df, text, lang, key), "features"), limits)


def _to_own(counts: str, total: Column, shares: dict[str, list[float]]) -> Column:
    """The distance to the reference of the row's own language; null where that has none."""
    found = F.lit(None).cast("double")
    for name, reference in shares.items():
        found = F.when(F.col("lang") == name, js_distance(F.col(counts), total, reference)).otherwise(found)
    return found


def keep_good(df: DataFrame, limits: Limits = Limits(), text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``df`` that pass, with their own columns.

    The verdict depends on text and language alone, so a 128-bit digest of both is the key; rows that repeat both have
    one verdict, and a text under another language has its own. Null and empty count alike, as they do in the rules.
    """
    names = [f"c{i}" for i in range(len(df.columns))]  # the input may have columns of any name
    at = dict(zip(df.columns, names, strict=True))
    body, language = (F.coalesce(F.col(at[c]), F.lit("")) for c in (text, lang))
    plain = df.toDF(*names).withColumn("_key", F.md5(F.concat(F.char_length(language), F.lit(":"), language, body).cast("binary")))
    judged = verdicts(materialize(features(plain, at[text], at[lang], "_key"), "features"), limits)
    rejected = materialize(judged.where("NOT kept").select("_key").distinct(), "rejected")
    return plain.join(bounded(rejected), "_key", "left_anti").select(*names).toDF(*df.columns)
