"""Spelling variants, fingerprints and collocations against brute force."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from slotstream.llm import phrases, queries, simhash, variants
from tests.compare import SF
from tests.llm.helpers import DOCS, documents, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- variants
def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(docs, least_length=7, ratio=10):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= least_length and k >= 2}
    out = {}
    for w in n:
        others = [v for v in n if near(w, v)]
        best = min(others, key=lambda v: (-n[v], v), default=None)
        out[w] = (best if best and n[best] >= ratio * n[w] else None, n[w], len(others))
    def root(w):
        return root(out[w][0]) if out[w][0] else w
    return {(w, form, root(w), k, m, n.get(form)) for w, (form, k, m) in out.items()}


def misspelt_corpus(seed):
    rng = random.Random(seed)
    letters = "abcdeéÿ×" if seed % 2 else "ab"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(6, 11))) for _ in range(25)]
    docs = []
    for i in range(300):
        out = []
        for _ in range(40):
            w = base[min(int(rng.expovariate(0.25)), len(base) - 1)]
            for _ in range(int(rng.expovariate(1.2))):
                k = rng.randrange(len(w) + 1)
                w = rng.choice([w[:k] + rng.choice(letters) + w[k:], w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k + 1 :]])
            out.append(w.title() if rng.random() < 0.1 else w)
        docs.append((i, rng.choice([" ", " ", "1", ", "]).join(out)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_variants(spark, seed):
    docs = misspelt_corpus(seed)
    got = [tuple(r) for r in variants.group(documents(spark, docs)).collect()]
    wanted = brute_variants(docs)
    assert len(got) == len(set(got)) > 100 and set(got) == wanted
    assert sum(r[1] is not None for r in wanted) > 20 and any(r[1] and r[1] != r[2] for r in wanted)


def test_variants_of_odd_tables(spark):
    docs = [(None, "Straßenbahn straßenbahn"), (3, None), (4, ""), (5, "123 short"), (6, "repeated repeated"), (6, "repeated repeated"), (7, "x" * 100_000 + " " + "x" * 99_999), (8, "x" * 100_000 + " " + "x" * 99_999)]
    table = documents(spark, docs).withColumn("word", F.lit(1)).withColumn("n", F.lit("n"))
    assert {tuple(r) for r in variants.group(table).collect()} == brute_variants(docs)
    assert variants.group(documents(spark, [])).count() == 0
    assert variants.group(documents(spark, [(1, None)])).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_near_words_share_a_key(seed):
    """Whatever the order of the bigrams, one of two near words has a pivot that is found in the other's prefix."""
    rng = random.Random(seed)
    for _ in range(1500):
        w = "".join(rng.choice("abc") for _ in range(rng.randrange(7, 13)))
        k = rng.randrange(len(w) + 1)
        v = rng.choice([w[:k] + rng.choice("abc") + w[k:], w[:k] + w[k + 1 :], w[:k] + rng.choice("abc") + w[k + 1 :]])
        counts = {a + b: rng.randrange(1, 5) for a in "abc" for b in "abc"}
        if v != w and min(len(v), len(w)) >= 4:
            keys = []
            for x in (v, w):
                places, reach = variants.prefix_places(x, counts)
                pivots = variants.pivot_places(x, places, counts)
                assert pivots[1] - pivots[0] >= 2
                smallest = min(counts[x[i : i + 2]] + counts[x[j : j + 2]] for i in places for j in places if j - i >= 2)
                assert sum(counts[x[p : p + 2]] for p in pivots) == smallest
                keys.append((set(variants.entries(x, pivots, (0,))), set(variants.entries(x, reach, (-1, 0, 1)))))
            assert keys[0][0] & keys[1][1] or keys[1][0] & keys[0][1]


# ---------------------------------------------------------------- fingerprints
def brute_fingerprint(text):
    w = [x.translate(LOWER) for x in words(text)]
    if not w:
        return 0
    grams = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, most=4):
    label = list(range(len(prints)))
    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= most:
            a, b = sorted((find(i), find(j)))
            label[b] = a
    return [find(i) for i in range(len(prints))]


def test_fingerprints_are_the_engines_hash(spark):
    texts = ["one Two three\tfour five", "a b", None, "", " \n", "Ä é x\x1cy z  w", "w " * 30_000 + "v"]
    got = {r.i: r.f & (1 << 64) - 1 for r in spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", simhash.fingerprints("text").alias("f")).collect()}
    assert got == {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    assert spark.sql("SELECT xxhash64('a b')").first()[0] & (1 << 64) - 1 == got[1]


def test_codes_are_perfect():
    for block in (simhash.GOLAY, simhash.HAMMING):
        code = simhash.Block(0, *block)
        leaders = simhash.flips(block[0], block[2])
        assert len(leaders) == len(code.leaders) and set(leaders.tolist()) == set(code.leaders.tolist())
        some = np.random.default_rng(1).integers(0, 1 << block[0], 1000).astype(np.uint64)
        assert not code.syndrome(some ^ code.leaders[code.syndrome(some)]).any()


@pytest.mark.parametrize("blocks", [(simhash.GOLAY, simhash.GOLAY), (simhash.GOLAY, simhash.GOLAY, simhash.HAMMING)])
def test_linked_fingerprints_meet_at_an_anchor(blocks):
    anchors, rng = simhash.Anchors(4, *blocks), random.Random(3)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), 4):
            y ^= 1 << b
        index, homes = anchors.homes(np.array([x, y], np.uint64))
        assert set(homes[index == 0].tolist()) & set(homes[index == 1].tolist())


@pytest.mark.parametrize(("limit", "fine"), [(4096, None), (4096, True), (3, None)])
def test_simhash_links(spark, limit, fine):
    """Clusters and chains of fingerprints; with a small limit, full anchors meet in points."""
    rng = random.Random(5)
    prints = {0}
    for _ in range(30):
        x = rng.getrandbits(64)
        for _ in range(20):
            prints.add(x)
            for b in rng.sample(range(64), rng.randrange(1, 7)):
                x ^= 1 << b
    prints = sorted(prints)
    wanted = brute_components(prints)
    table = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in prints], "fp bigint")
    label = {x: x for x in prints}
    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for r in simhash.links(table, 4, limit, fine).collect():
        a, b = sorted((find(r.a & (1 << 64) - 1), find(r.b & (1 << 64) - 1)))
        label[b] = a
    assert len(set(wanted)) > 40 and [find(x) for x in prints] == [prints[i] for i in wanted]


def test_simhash_query(spark):
    """The registered query against brute force over its whole table."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    prints = [brute_fingerprint(r.text) for r in rows]
    wanted = {(r.doc_id, f"{f:016x}", rows[i].doc_id) for r, f, i in zip(rows, prints, brute_components(prints), strict=True)}
    got = queries.op12_simhash_dedup(spark, SF).collect()
    assert len(got) == len(rows) and {(r.doc_id, r.fingerprint, r.component_id) for r in got} == wanted


def test_simhash_of_odd_tables(spark):
    docs = [(9, None), (4, ""), (5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (7, "x y z"), (8, "w " * 200_000)]
    got = sorted((str(r.doc_id), r.component_id) for r in simhash.near_duplicates(documents(spark, docs).withColumn("fp", F.lit(1)).withColumn("component", F.lit(2))).collect())
    assert got == [("4", 4), ("5", 5), ("5", 5), ("7", 7), ("8", 8), ("9", 4), ("None", 5)]
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp bigint"), threshold=3)


# ---------------------------------------------------------------- collocations
def brute_counts(docs):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    return f, n


def brute_phrases(docs, least=10, percent=50, top=2000):
    f, n = brute_counts(docs)
    found = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    rows = []
    for (lang, *p), a in found.items():
        if any(len(q) > len(p) + 1 and q[0] == lang and tuple(p) in (q[1:3], q[2:4]) and 100 * b >= percent * a for q, b in found.items()):
            continue
        score, k = min((1000000 * a * a // (f[(lang, *p[:k])] * f[(lang, *p[k:])]), k) for k in range(1, len(p)))
        rows.append((lang, -score, -a, " ".join(p).encode(), f[(lang, *p[:k])], f[(lang, *p[k:])]))
    out, seen = set(), Counter()
    for lang, score, a, phrase, left, right in sorted(rows):
        seen[lang] += 1
        if seen[lang] <= top:
            out.add((lang, seen[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return out


def chatter(seed, n=400):
    rng = random.Random(seed)
    vocabulary = ["of", "the", "New", "york", "city", "été", "x\x1cy", "a", "b", "c"]
    ends = [" ", " ", " ", "  ", "\t", ". ", "\n", ", "]
    return [(rng.choice(["en", "de", None]), "".join(w + rng.choice(ends) for w in rng.choices(vocabulary, [9, 9, 3, 3, 3, 2, 2, 1, 1, 1], k=rng.randrange(30)))) for _ in range(n)]


def table(spark, docs):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, (lang, t) in enumerate(docs)], DOCS)


@pytest.mark.parametrize(("seed", "block", "parts"), [(1, 4 << 20, None), (2, 300, 7), (3, 64, 3)])
def test_collocations(spark, seed, block, parts):
    docs = chatter(seed)
    docs.append(("en", " ".join(t for _, t in docs)))  # longer than the small blocks
    got = [tuple(r) for r in phrases.collocations(table(spark, docs), block=block, parts=parts, top=40).collect()]
    wanted = brute_phrases(docs, top=40)
    assert len(got) == len(wanted) > 60 and set(got) == wanted


def test_cut_texts_count_every_phrase_once():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice(["a", "bb", "c" * 9, " ", " ", ".", "\t"]) for _ in range(rng.randrange(60))).encode()
        total = Counter()
        for segment, again in phrases.cut(text, rng.randrange(1, 12)):
            grams, words_ = phrases.block_grams(segment, again)
            for path, counts in grams:
                for *p, n in zip(*(x.tolist() for x in path), counts.tolist(), strict=True):
                    total[("en", *(words_[x].decode() for x in p))] += n
        assert total == brute_counts([("en", text.decode())])[0]


def test_automata():
    """Union sums weights; composition reads two automata at once."""
    rng = random.Random(8)
    def random_one():
        grams = Counter(tuple(rng.choices([3, 5, 8, 1 << 63], k=rng.randrange(1, 4))) for _ in range(25))
        paths = [[(p, n) for p, n in grams.items() if len(p) == k] for k in (1, 2, 3)]
        made = [([np.array([p[i] for p, _ in rows], np.uint64) for i in range(k + 1)], np.array([n for _, n in rows], np.int64)) for k, rows in enumerate(paths)]
        return phrases.Automaton.load(phrases.Automaton.build(made, {3: b"three"}).dump()), grams
    def read(paths):
        return Counter({tuple(x): n for path, w in paths for *x, n in zip(*(p.tolist() for p in path), w.tolist(), strict=True) if n})
    for _ in range(50):
        (a, x), (b, y) = random_one(), random_one()
        total = phrases.unite([a, b])
        assert read(total.paths()) == x + y
        assert read(a.compose(total)) == Counter({p: (x + y)[p] for p in x})
        assert read(a.compose(b)) == Counter({p: y[p] for p in x if p in y})
    other = phrases.Automaton.build([([np.array([3], np.uint64)], np.array([1]))], {3: b"drei"})
    with pytest.raises(ValueError):
        phrases.unite([other, phrases.Automaton.build([([np.array([3], np.uint64)], np.array([1]))], {3: b"three"})])


def test_collocations_of_odd_tables(spark):
    docs = [(None, "a b " * 12), ("en", None), ("en", ""), ("xx", "..! ,"), ("de", "y " * 300_000), ("de", "z" * 500_000)]
    got = phrases.collocations(table(spark, docs).withColumn("part", F.lit(1)).withColumn("n", F.lit(1)), block=100_000).collect()
    assert {tuple(r) for r in got} == brute_phrases(docs)
    assert phrases.collocations(table(spark, [])).count() == 0
    assert phrases.collocations(table(spark, [("en", None)])).count() == 0
