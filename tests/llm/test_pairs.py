"""N-gram join and substring dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest

from slotstream.llm import common, components, ngram_join, substring_dedup
from tests.llm.helpers import documents, prose, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(docs):
    sets = {i: shingles(t) for i, t in docs}
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copy_corpus(seed):
    rng = random.Random(seed)
    base = [prose(rng, rng.choice([3, 8, 30, 60, 200]), 3000) for _ in range(12)]
    passage = prose(rng, 60, 3000)
    docs = []
    for i in range(120):
        w = list(rng.choice(base)) if rng.random() < 0.7 else prose(rng, 80, 3000) + passage
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(50)}"
        text = rng.choice([" ", "\n", "  "]).join(w)
        docs.append((i * 7 % 1000, text.upper() if rng.random() < 0.1 else text))
    return docs + [(5001, None), (5002, ""), (5003, " \t "), (5004, "a\x1cb é"), (5005, "A\x1cb é"), (5006, "a b c d"), (5007, "A B C D")]


def brute_links(docs):
    """Number of other doc_ids linked with each, and the links between different sets."""
    sets = {i: shingles(t) for i, t in docs}
    linked = {(i, j) for i in sets for j in sets if i != j and sets[i] & sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    first = {i: min(j for j in sets if sets[j] == sets[i]) for i in sets if sets[i]}
    counts = {i: sum(x == i for x, _ in linked) for i in sets}
    return counts, {(first[i], first[j]) for i, j in linked if sets[i] != sets[j] and first[i] > first[j]}


@pytest.mark.parametrize("part", [3, 1000])
def test_links(spark, monkeypatch, part):
    """Every link between different texts is found, within components too, and the copies are counted."""
    monkeypatch.setattr(ngram_join, "LIST_PART", part)
    docs = near_copy_corpus(4)
    counts, pairs = brute_links(docs)
    found, _ = ngram_join.links(documents(spark, docs))
    got = [(r.a, r.b) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == pairs
    assert {r.doc_id: r.n_links for r in ngram_join.link_counts(documents(spark, docs)).collect()} == counts


def test_links_of_odd_tables(spark):
    assert ngram_join.link_counts(documents(spark, [(1, "x")]).limit(0)).isEmpty()
    rows = [(None, "a b c"), (None, None), (4, "a b c"), (4, "a b c"), (7, "A b c"), (8, ""), (9, None)]
    got = sorted(((r.doc_id or -1, r.n_links) for r in ngram_join.link_counts(documents(spark, rows)).collect() if r.doc_id))
    assert got == [(4, 1), (4, 1), (7, 1), (8, 0), (9, 0)]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates(spark, seed):
    docs = near_copy_corpus(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(documents(spark, docs)).collect()}
    assert got == brute_components(docs)


def test_near_duplicates_with_common_shingles_and_long_lists(spark, monkeypatch):
    """Counting common shingles apart from their documents and dealing lists into parts change no result."""
    monkeypatch.setattr(ngram_join, "COMMON", 2)
    monkeypatch.setattr(ngram_join, "LIST_PART", 4)
    docs = near_copy_corpus(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(documents(spark, docs).coalesce(2)).collect()}
    assert got == brute_components(docs)


def test_near_duplicates_of_odd_tables(spark):
    assert ngram_join.near_duplicates(documents(spark, [(1, "x")]).limit(0)).isEmpty()
    same = "one two three four five six seven"
    rows = [(None, same), (None, None), (3, same), (3, "other words are in here too now"), (9, "other words are in here too now"), (4, same), (4, same)]
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(documents(spark, rows)).collect() if r.doc_id)
    assert got == [(3, 3, 3), (3, 3, 3), (4, 3, 3), (4, 3, 3), (9, 3, 3)]


def test_large_group_of_near_copies(spark):
    """A group of m near copies must cost pairs in proportion to m."""
    rng = random.Random(5)
    base = prose(rng, 120, 5000)
    docs = []
    for i in range(300):
        w = list(base)
        w[rng.randrange(120)] = f"y{i}"
        docs.append((i, " ".join(w)))
    got = {r.component_id for r in ngram_join.near_duplicates(documents(spark, docs)).collect()}
    assert got == {0}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(20)] + [(200, 200 + i) for i in range(1, 30)]
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame([*edges, (None, 1), edges[0]], "a bigint, b bigint")).collect()}
    assert got == {n: c for n, c in label.items() if any(n in e and e[0] != e[1] for e in edges)}


def brute_removed(docs, size=50):
    first = {}
    for i, t in docs:
        w = words(t)
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, t in docs:
        w, gone = words(t), set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < i:
                gone.update(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize(("seed", "base"), [(1, 25), (2, 12), (3, 50)])
def test_remove_repeats(spark, seed, base):
    rng = random.Random(seed)
    passages = [prose(rng, n, 2000) for n in (49, 50, 51, 80, 200)]
    docs = []
    for i in range(80):
        w = prose(rng, rng.randrange(120), 2000)
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(w) + 1)
            w[at:at] = rng.choice(passages)
        docs.append((1000 - i, rng.choice([" ", "\n\n", "\t"]).join(w)))
    docs += [(2000, docs[0][1]), (2001, docs[0][1]), (2002, None), (2003, ""), (2004, "ab " * 130), (2005, "ab " * 70)]
    got = {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest()) for r in substring_dedup.remove_repeats(documents(spark, docs), 50, base).collect()}
    assert got == brute_removed(docs)


def test_remove_repeats_of_odd_tables(spark):
    assert substring_dedup.remove_repeats(documents(spark, [(1, "x")]).limit(0)).isEmpty()
    text = " ".join(f"v{i}" for i in range(60))
    rows = [(None, text), (1, text), (1, text), (1, text + " tail"), (2, "head " + text)]
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(documents(spark, rows)).collect())
    assert got == [(-1, 60, 0), (1, 60, 0), (1, 60, 0), (1, 61, 0), (2, 61, 60)]


def test_scratch_tables(spark):
    import os

    common.clear_scratch(spark)
    a, b = (common.materialize(spark.range(3), name) for name in "ab")
    paths = [os.path.dirname(t.inputFiles()[0].removeprefix("file:").replace("//", "/")) for t in (a, b)]
    common.forget(a)
    assert [os.path.exists(p) for p in paths] == [False, True] and b.count() == 3
    common.clear_scratch(spark)
    assert not os.path.exists(paths[1])
    assert "broadcast" in common.bounded(spark.range(3), 3)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in common.bounded(spark.range(4), 3)._jdf.queryExecution().analyzed().toString().lower()


def test_word_hashes_in_segments(monkeypatch):
    text = " ".join(f"wörd{i}\t\x0bX" for i in range(500))
    whole = common.word_hashes(text)
    monkeypatch.setattr(common, "_SEGMENT", 64)
    assert np.array_equal(whole, common.word_hashes(text)) and len(whole) == len(words(text))
    assert np.array_equal(common.word_hashes("Ab É"), common.word_hashes("Ab\nÉ")) and common.word_hashes("Ab", True)[0] == common.word_hashes("aB", True)[0] != common.word_hashes("aB")[0]
    hashes = common.window_hashes(whole, 50)
    assert len(hashes) == len(whole) - 49 and len(set(hashes.tolist())) == len(hashes)
