"""Mixing, top-k search and the pipeline."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest

from slotstream.llm import mixing, queries, topk_search
from tests.compare import SF, connect, same
from tests.llm.helpers import documents


@pytest.mark.parametrize(("weights", "block"), [(None, 1), ({"a": 5, "b": 3, "c": 1}, 1), ({"a": 1, "b": 7}, 3)])
def test_mixing(spark, weights, block):
    rng = random.Random(4)
    sources = [rng.choices(["a", "b", "c", None], [60, 20, 10, 5])[0] for _ in range(400)]
    docs = documents(spark, [(i, None) for i in range(400)]).selectExpr("doc_id", "text AS position")
    docs = docs.join(spark.createDataFrame(list(enumerate(sources)), "doc_id bigint, source string"), "doc_id")
    rows = mixing.mix(docs, weights, block_rows=block).orderBy("position").collect()
    assert sorted(r.doc_id for r in rows) == list(range(400)) and len({r.position for r in rows}) == 400
    slots = {}
    for r in rows:
        assert slots.setdefault(r.slot, (r.source, r.block, r.phase)) == (r.source, r.block, r.phase)
    assert sorted(slots) == list(range(len(slots)))
    for phase in {p for _, _, p in slots.values()}:
        order = [slots[s][0] for s in sorted(slots) if slots[s][2] == phase]
        shares, seen = collections.Counter(order), collections.Counter()
        for t, s in enumerate(order, 1):
            seen[s] += 1
            assert all(abs(seen[x] - n / len(order) * t) < 1 for x, n in shares.items())
    if weights:
        first = collections.Counter(s for s, _, p in slots.values() if p == 0)
        assert first["a"] * weights["b"] == first["b"] * weights["a"]


def test_mixing_of_odd_tables(spark):
    docs = documents(spark, [(None, "x"), (None, "x"), (1, "y")], [None])
    assert sorted(r.position for r in mixing.mix(docs).collect()) == [0, 1, 2]
    assert mixing.mix(docs.limit(0)).isEmpty() and mixing.mix(docs.limit(0)).columns == mixing.mix(docs).columns
    three = mixing.mix(documents(spark, [(i, "x" * (20_000 * (i == 3))) for i in range(9)], ["a", "b", "c"]).withColumnRenamed("lang", "slot"), block_rows=2)
    assert sorted(three.columns) == sorted(["doc_id", "text", "source", "n_chars", "phase", "block", "slot", "position"]) and three.count() == 9


def plain_mix(rows, weights, block):
    """Earliest deadline first, slot by slot: {(source, block): slot}."""
    sizes = collections.Counter(s for _, s in rows)
    name = lambda s: "" if s is None else f"={s}"
    blocks = {s: -(-n // block) for s, n in sizes.items()}
    chosen = {s: max(1, math.floor(mixing.FINEST * (n / min(sizes.values())) ** 0.5 + 0.5)) if weights is None else max(1, weights.get(s, 1)) for s, n in sizes.items()}
    used, slot, out = dict.fromkeys(blocks, 0), 0, {}
    while any(used[s] < n for s, n in blocks.items()):
        share = {s: min(chosen[s], n - used[s]) for s, n in blocks.items() if used[s] < n}
        slots, k = sum(share.values()), dict.fromkeys(share, 0)
        for t in range(slots):
            _, _, s = min((-(-(k[s] + 1) * slots // w), name(s), s) for s, w in share.items() if k[s] < w and k[s] * slots // w <= t)
            out[s, used[s] + k[s]] = slot + t
            k[s] += 1
        for s, n in share.items():
            used[s] += n
        slot += slots
    return out


@pytest.mark.parametrize(("seed", "weights", "block"), [(1, None, 1), (2, {"a": 300, "b": 7, "c": 1}, 1), (3, {"a": 3}, 4), (4, None, 1)])
def test_mixing_agrees_with_the_plain_schedule(spark, monkeypatch, seed, weights, block):
    """Also where a source is four hundred times another, and with ranges of few rows."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    rng = random.Random(seed)
    rows = [(i, rng.choices(["a", "b", None, "c"], [400, 60, 9, 1 + (seed < 4) * 90])[0]) for i in range(700)] + [(None, "a")] * 40 + [(1, "b")] * 5
    got = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, source string"), weights, block_rows=block).collect()
    assert {(r.source, r.block): r.slot for r in got} == plain_mix(rows, weights, block)
    assert len({r.position for r in got}) == len(got) == len(rows)
    order = lambda r: (hashlib.md5(str(r.doc_id).encode()).hexdigest(), r.doc_id)
    for s in {s for _, s in rows}:
        known = sorted((r for r in got if r.source == s and r.doc_id is not None), key=lambda r: r.position)
        assert [r.doc_id for r in known] == [r.doc_id for r in sorted(known, key=order)]


def test_mixing_of_many_sources(spark):
    """More sources than a list of literals could carry; the smallest share keeps its target."""
    rows = spark.range(1200).selectExpr("id AS doc_id", "CASE WHEN id < 420 THEN 'hot' ELSE concat('s', id % 200) END AS source")
    got = mixing.mix(rows, {"hot": 50}).collect()
    assert sorted(r.position for r in got) == list(range(1200))
    first = [r.source for r in sorted(got, key=lambda r: r.slot) if r.phase == 0]
    assert len(first) % 250 == 0 and all(abs(first[:n].count("hot") - n * 50 / 250) < 1 for n in range(1, len(first), 97))


def brute_top(rows, k=10):
    good = [(i, np.floor(np.array(v, dtype=np.float64) * 1024).astype(np.int64)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in good:
        if q % 100 == 0:
            scored = sorted((-int(v @ w), i) for i, w in good if i != q and len(v) == len(w))
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("kept", [2, 4, 8, 30])
def test_top_k(spark, monkeypatch, kept):
    rng = np.random.default_rng(kept)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(500)]
    rows += [(500 + i, rows[0][1]) for i in range(20)] + [(600, rows[1][1]), (600, rows[1][1]), (700, None), (800, []), (900, [1.0, None]), (1000, [float("nan")] * 8), (1001, [float("inf")] * 8), (1100, [0.0] * 8), (1200, [1.0, 2.0]), (1201, [1.0, -2.0]), (None, [1.0] * 8)]
    monkeypatch.setattr(topk_search, "KEPT_BITS", kept)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS score").repartition(3)
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in topk_search.search(df).collect()]
    assert sorted(got) == brute_top(rows)
    assert topk_search.search(df.limit(0)).isEmpty()


def test_top_k_in_a_grid_of_many_cells(spark, monkeypatch):
    """Small blocks and cells: running best rows, blocks passed over, and more cells than any fixed number of groups."""
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(size=6) * (1 + 5 * (i % 97 == 0))]) for i in range(2500)] + [(7, None)]
    for name, value in (("BLOCK_ROWS", 16), ("QUERY_ROWS", 4), ("PAIRS_PER_TASK", 2)):
        monkeypatch.setattr(topk_search, name, value)
    assert topk_search._grid(157 * 7, 157, 7) == (111, 5) and topk_search._grid(0, 0, 0) == (1, 1)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(2)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk_search.search(df).collect()) == brute_top(rows)
    huge = spark.createDataFrame([(0, [1e16, 1.0]), (1, [1.0, 1.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        topk_search.search(huge).collect()


def test_slices_keep_every_top_row():
    rng = np.random.default_rng(1)
    values, ids = rng.integers(-2000, 2000, (700, 6)), np.arange(700)
    for kept in (1, 3, 12):
        s = topk_search.Slices(values, kept)
        q = rng.integers(-1500, 1500, (5, 6))
        for i, found, scores in topk_search.top_rows(s, values, ids, q, np.full(5, -1), 7):
            best = np.lexsort((ids, -(values @ q[i])))[:7]
            assert found.tolist() == best.tolist() and scores.tolist() == (values @ q[i])[best].tolist()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_agrees_with_sql(spark, name):
    same(queries.QUERIES[name](spark, SF), connect(), queries.ORACLE_SQL[name])


def test_pipeline(spark):
    """Every stage against brute force on what the stage before it kept."""
    import corpus_pipeline
    from slotstream.llm import pii
    from tests.llm.test_pairs import brute_components
    from tests.llm.test_texts import base_counts, library_ids

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        kept = corpus_pipeline.materialize(stage(spark, kept, SF), name)
        seen[name] = [r.asDict() for r in kept.collect()]
        if name != "bpe":
            assert kept.columns == docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    after = {r["doc_id"]: r["text"] for r in seen["quality_rules"]}
    for i, text in before.items():
        n_words, _, _, _, repeats = base_counts(text)
        if n_words < 50 or 100 * repeats > 50 * n_words:
            assert i not in after
        assert after.get(i, text) == text
    groups = brute_components(sorted(after.items()))
    assert sorted(r["doc_id"] for r in seen["ngram_join"]) == sorted(i for i, (_, c) in groups.items() if i == c)
    for r in seen["pii"]:
        assert r["text"] is None or not any(after[r["doc_id"]][a:b] in r["text"] for _, a, b in pii.mentions(after[r["doc_id"]]))
    assert {r["doc_id"]: r["text"] for r in seen["mixing"]} == {r["doc_id"]: r["text"] for r in seen["pii"]}
    positions = {r.doc_id: r.position for r in mixing.mix(spark.createDataFrame([(r["doc_id"], r["source"]) for r in seen["pii"]], "doc_id bigint, source string")).collect()}
    order = [positions[r["doc_id"]] for r in seen["mixing"]]
    assert order == sorted(order)
    assert all(r["token_ids"] == library_ids(r["text"]) and r["n_tokens"] == len(r["token_ids"]) for r in seen["bpe"])
    assert corpus_pipeline.run(spark, SF).count() == len(seen["bpe"])


def test_pipeline_returns_the_mixed_order_of_many_files(spark):
    """Part files of unequal size come back in another order; the positions tell the schedule's."""
    import corpus_pipeline

    rng = random.Random(2)
    texts = ["word " * (rng.choice([1, 1, 400]) + 3 * i) for i in range(300)]
    docs = documents(spark, texts, ["a", "a", "a", "b", "c"])
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        written = corpus_pipeline.materialize(corpus_pipeline.mixed(spark, docs, SF), "many")
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(written.inputFiles()) > 8
    got = corpus_pipeline.encoded(spark, written, SF).select("doc_id", "position").collect()
    order = [r.doc_id for r in mixing.mix(docs).orderBy("position").collect()]
    assert sorted(r.position for r in got) == list(range(300))
    assert [r.doc_id for r in sorted(got, key=lambda r: r.position)] == order
    assert [r.doc_id for r in written.select("doc_id").collect()] != order  # what a scan returns


def test_pipeline_stages_of_odd_tables(spark):
    """Nulls in any column, empty tables, repeated rows, very long texts and clashing names: every stage has a defined result."""
    import corpus_pipeline

    rng = random.Random(6)
    good = " ".join(rng.choice(["the", "of", "and", "to", "in", "is"]) if rng.random() < 0.4 else w for w in (f"v{rng.randrange(500)}" for _ in range(120)))
    rows = [(1, good), (1, good), (None, good), (2, None), (3, ""), (4, "y" * 200_000), (5, "Mrs. Anna Weber wrote to anna@mail.example. " + good)]
    docs = documents(spark, rows, [None, "a"]).selectExpr("*", "'kept' AS class_id", "'kept' AS _order", "1 AS kept")
    wanted = {"quality_rules": 4, "ngram_join": 6, "pii": 7, "mixing": 7, "bpe": 7}
    for name, stage in corpus_pipeline.STAGES:
        source = corpus_pipeline.materialize(docs, "odd") if name == "bpe" else docs
        out = stage(spark, source, SF)
        assert out.columns[: len(docs.columns)] == docs.columns, name
        got = out.collect()
        assert len(got) == wanted[name], (name, len(got))
        assert all((r.class_id, r._order, r.kept) == ("kept", "kept", 1) for r in got)
        empty = corpus_pipeline.materialize(docs.limit(0), "none") if name == "bpe" else docs.limit(0)
        assert stage(spark, empty, SF).isEmpty(), name


@pytest.mark.parametrize("equal", [True, False])
def test_top_k_of_repeated_queries(spark, equal):
    """Rows that repeat a query's id are queries of their own, in whatever number."""
    rng = random.Random(7)
    vector = lambda: [rng.uniform(-1, 1) for _ in range(6)]
    one = vector()
    rows = [(0, one if equal else vector()) for _ in range(130)] + [(i, vector()) for i in range(1, 40)]
    found = topk_search.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), 10, 100).collect()
    scaled = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows]
    wanted = []
    for q, v in scaled[:130]:
        best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in scaled if i != q)[:10]
        wanted += [(q, rank, i, -score) for rank, (score, i) in enumerate(best, 1)]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == sorted(wanted) and len(wanted) == 1300


@pytest.mark.parametrize("finest", [mixing.FINEST, 1000])
def test_default_weights_are_off_by_half_a_slot_at_most(spark, finest):
    sizes = {"a": 1, "b": 7, "c": 12_345, None: 10**9}
    table = spark.createDataFrame(list(sizes.items()), "source string, rows bigint")
    found = {r.source: r.weight for r in mixing._weights(spark, table, None, 0.5, finest).collect()}
    assert all(abs(found[s] / (finest * n**0.5) - 1) <= 1 / (2 * finest) for s, n in sizes.items())
    docs = spark.createDataFrame([(i, "x" if i % 3 else "y") for i in range(30)], "doc_id bigint, source string")
    assert sorted(r.position for r in mixing.mix(docs, finest=finest).collect()) == list(range(30))
