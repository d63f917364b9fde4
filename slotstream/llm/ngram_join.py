"""N-gram Jaccard self-join with prefix filters under several global orders, and its connected components.

A document's set holds its distinct shingles of consecutive words, as 64-bit hashes; fewer words than a shingle
are one shingle, no words an empty set that is linked with nothing. Two documents are linked if
100 * |intersection| >= percent * |union|.

1. Equal sets are one class of copies, told by a 128-bit digest; only the smallest doc_id of a class goes on.
2. All shingles are counted exactly. A shingle of one document alone cannot be shared, so the unshared ones come
   first in every order used here, and only shared shingles are kept (as 48 bits). A document whose unshared
   shingles fill its prefix of n - ceil(percent * n / 100) + 1 can have no partner and leaves.
   A shingle of many documents in one stretch of the input is passed on as a count; its documents stay spread over
   all tasks and meet the total afterwards, so no task holds all documents of a common shingle.
3. Order 1 is (number of documents, hash), order 2 the ascending and order 3 the descending hash. Linked
   documents share a shingle of their prefixes under every one of them. Candidates share one under order 1 (the
   index); intersecting with orders 2 and 3 comes before the exact overlap.
4. In each list of the index documents stand in order of the mean count of their shingles, so that what most others
   were copied from comes first; long lists are dealt at random into parts of bounded length. Every document is
   first compared with the one before it in its part and with the first of the whole list. The links found join
   near copies into components. Then all pairs of a list that are in different components are candidates, unless
   lengths or positions rule them out; so a large group of near copies costs a number of pairs in proportion to
   its size, and no link between components is missed.

Null texts are empty. Rows without doc_id have no component; rows that share a doc_id are one node. Extra
columns of the input are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotstream.llm.common import bounded, forget, materialize, mix, window_hashes, word_hashes
from slotstream.llm.components import connected_components

TOKENS_PER_PARTITION = 1_000_000  # of the exact count; sets the number of partitions from the corpus
TOKENS_PER_ROW_GROUP = 500_000
COMMON = 32  # documents of one row group; shingles of so many are counted apart from their documents
LIST_PART = 1000  # documents that one window over a list orders, on average


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text, A-Z lower-cased."""
    words = word_hashes(text, fold=True)
    if len(words) == 0:
        return words
    return np.unique(window_hashes(words, min(size, len(words))))


def _prefix_length(n, percent: int):
    return n - F.floor((percent * n + 99) / 100) + 1


def _features(df: DataFrame, size: int) -> DataFrame:
    """doc_id, n and digest (d1, d2) of every row."""

    def run(batches):
        for batch in batches:
            n, d1, d2 = [], [], []
            for x in batch.column("text"):
                tokens = shingle_set(x.as_py(), size)
                n.append(len(tokens))
                d1.append(mix(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                d2.append(mix(tokens ^ np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), *[pa.array(np.array(d, dtype=np.uint64).view(np.int64)) for d in (d1, d2)]], names=["doc_id", "n", "d1", "d2"])

    return df.mapInArrow(run, "doc_id long, n long, d1 long, d2 long")


_48_BITS = np.uint64((1 << 48) - 1)


def _runs(sorted_values: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of every run of equal values."""
    edges = [0, *(np.flatnonzero(np.diff(sorted_values)) + 1).tolist(), len(sorted_values)]
    return [(a, b) for a, b in zip(edges, edges[1:], strict=False) if a < b]


def _binary(values) -> pa.Array:
    return pa.array(values, pa.binary())


def _shared_tokens(docs: DataFrame, size: int, partitions: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, tokens (shingles that more than one document has) and dfs (how many have each); and the scratch table behind them.

    The shuffle carries 6 bytes a shingle and each doc_id once per partition: bytes of many documents make a row.
    """

    def halves(tokens):
        return (tokens & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(), (tokens >> np.uint64(32)).astype(np.uint16).tobytes()

    def whole(low, high):
        return np.frombuffer(low, dtype=np.uint32) | (np.frombuffer(high, dtype=np.uint16).astype(np.uint64) << np.uint64(32))

    def deal(batches):
        """Rows of documents' shingles for a receiving partition, rows of one common shingle, and counts of those."""
        ids, sets, n = [], [], 0

        def rows():
            tokens = np.concatenate(sets) & _48_BITS
            docs_at = np.repeat(np.arange(len(ids)), [len(s) for s in sets])
            known = np.array(ids, dtype=np.int64)
            values, inverse, times = np.unique(tokens, return_inverse=True, return_counts=True)
            hot = np.flatnonzero(times >= COMMON)
            common = (times >= COMMON)[inverse]
            out = []
            places = np.flatnonzero(common)
            places = places[np.argsort(inverse[places], kind="stable")]
            for a, b in _runs(inverse[places]):
                token = tokens[places[a] : places[a] + 1]
                spread = int(mix(token ^ known[:1].view(np.uint64))[0] % np.uint64(partitions))
                out.append(("common", spread, known[docs_at[places[a:b]]].tobytes(), b"", *halves(token)))
            home = (values[hot] % np.uint64(partitions)).astype(np.int32)
            hot = hot[np.argsort(home, kind="stable")]
            home = np.sort(home)
            for a, b in _runs(home):
                out.append(("count", int(home[a]), b"", times[hot[a:b]].astype(np.uint32).tobytes(), *halves(values[hot[a:b]])))
            tokens, docs_at = tokens[~common], docs_at[~common]
            bucket = (tokens % np.uint64(partitions)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            tokens, docs_at, bucket = tokens[order], docs_at[order], bucket[order]
            for a, b in _runs(bucket):
                part = docs_at[a:b]
                first = np.flatnonzero(np.diff(part, prepend=-1))
                counts = np.diff(first, append=len(part)).astype(np.uint32)
                out.append(("own", int(bucket[a]), known[part[first]].tobytes(), counts.tobytes(), *halves(tokens[a:b])))
            columns = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1], pa.int32()), *[_binary(c) for c in columns[2:]]], names=["kind", "bucket", "ids", "counts", "low", "high"])

        for batch in batches:
            for i, x in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                tokens = shingle_set(x.as_py(), size)
                if len(tokens):
                    ids.append(i.as_py())
                    sets.append(tokens)
                    n += len(tokens)
                if n >= TOKENS_PER_ROW_GROUP:
                    yield rows()
                    ids, sets, n = [], [], 0
        if n:
            yield rows()

    def batch_of(kind, bucket, token, df, ids, tokens, dfs):
        return pa.RecordBatch.from_arrays([pa.array(kind, pa.string()), pa.array(bucket, pa.int32()), pa.array(token, pa.int64()), pa.array(df, pa.int64()), _binary(ids), _binary(tokens), _binary(dfs)], names=["kind", "bucket", "token", "df", "ids", "tokens", "dfs"])

    def count(batches):
        """Shared shingles with their numbers of documents, totals of common ones; rows of common ones pass through."""
        ids, tokens, sums, summed = [], [], [], []
        for batch in batches:
            passed = []
            for kind, i, c, low, high in zip(*[batch.column(k) for k in ("kind", "ids", "counts", "low", "high")], strict=True):
                values = whole(low.as_py(), high.as_py())
                if kind.as_py() == "common":
                    passed.append((int(values[0]), i.as_py()))
                elif kind.as_py() == "count":
                    summed.append(values)
                    sums.append(np.frombuffer(c.as_py(), dtype=np.uint32).astype(np.int64))
                else:
                    ids.append(np.repeat(np.frombuffer(i.as_py(), dtype=np.int64), np.frombuffer(c.as_py(), dtype=np.uint32)))
                    tokens.append(values)
            if passed:
                none, empty = [None] * len(passed), [b""] * len(passed)
                yield batch_of(["common"] * len(passed), none, [t for t, _ in passed], none, [i for _, i in passed], empty, empty)
        if not ids and not sums:
            return
        own = sum(len(x) for x in ids)
        tokens = np.concatenate([*tokens, *summed])
        weights = np.concatenate([np.ones(own, dtype=np.int64), *sums])
        ids = np.concatenate([*ids, np.zeros(len(tokens) - own, dtype=np.int64)])
        order = np.argsort(tokens, kind="stable")
        tokens, weights = tokens[order], weights[order]
        first = np.flatnonzero(np.diff(tokens, prepend=~tokens[:1]))
        lengths = np.diff(first, append=len(tokens))
        dfs = np.add.reduceat(weights, first)
        counted = order >= own
        totals = np.flatnonzero(np.logical_or.reduceat(counted, first))
        if len(totals):
            none, empty = [None] * len(totals), [b""] * len(totals)
            yield batch_of(["total"] * len(totals), none, tokens[first[totals]].view(np.int64), dfs[totals], empty, empty, empty)
        keep = np.repeat(dfs > 1, lengths) & ~counted
        if keep.any():
            yield packed(ids[order[keep]], tokens[keep].view(np.int64), np.repeat(dfs, lengths)[keep])

    def packed(ids, tokens, dfs):
        """The same bytes again, dealt by document: a row per receiving partition, not one per document."""
        bucket = (mix(ids.view(np.uint64)) % np.uint64(partitions)).astype(np.int32)
        order = np.lexsort((ids, bucket))
        ids, tokens, dfs, bucket = ids[order], tokens[order], dfs[order].astype(np.uint32), bucket[order]
        spans = _runs(bucket)
        none = [None] * len(spans)
        return batch_of(["own"] * len(spans), [int(bucket[a]) for a, _ in spans], none, none, *[[x[a:b].tobytes() for a, b in spans] for x in (ids, tokens, dfs)])

    def rejoin(batches):
        for batch in batches:
            ids = [np.frombuffer(x.as_py(), dtype=np.int64) for x in batch.column("ids")]
            lengths = [len(x) for x in ids]
            if sum(lengths):
                token, df = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("token", "df"))
                yield packed(np.concatenate(ids), np.repeat(token, lengths), np.repeat(df, lengths))

    def gather(batches):
        parts = [[np.frombuffer(x.as_py(), dtype=t) for x in batch.column(c)] for batch in batches for c, t in (("ids", np.int64), ("tokens", np.int64), ("dfs", np.uint32))]
        if not any(parts):
            return
        ids, tokens, dfs = (np.concatenate([x for part in parts[k::3] for x in part]) for k in range(3))
        order = np.argsort(ids, kind="stable")
        ids, tokens, dfs = ids[order], tokens[order], dfs[order].astype(np.int32)
        at = np.array([0, *(np.flatnonzero(np.diff(ids)) + 1), len(ids)])
        for a in range(0, len(at) - 1, 20_000):
            cut = at[a : a + 20_001]
            lists = [pa.ListArray.from_arrays(pa.array((cut - cut[0]).astype(np.int32)), pa.array(x[cut[0] : cut[-1]])) for x in (tokens, dfs)]
            yield pa.RecordBatch.from_arrays([pa.array(ids[cut[:-1]]), *lists], names=["doc_id", "tokens", "dfs"])

    dealt = docs.mapInArrow(deal, "kind string, bucket int, ids binary, counts binary, low binary, high binary").repartition(partitions, "bucket")
    columns = "kind string, bucket int, token long, df long, ids binary, tokens binary, dfs binary"
    counted = materialize(dealt.mapInArrow(count, columns), "counted")
    totals = counted.where("kind = 'total'").select("token", "df")
    common = counted.where("kind = 'common'").select("token", "ids").join(bounded(totals), "token").mapInArrow(rejoin, columns)
    back = counted.where("kind = 'own'").unionByName(common).select("bucket", "ids", "tokens", "dfs").repartition(partitions, "bucket")
    return back.mapInArrow(gather, "doc_id long, tokens array<long>, dfs array<int>"), counted


def _fit(na: Column, nb: Column, percent: int) -> Column:
    return 100 * F.least(na, nb) >= percent * F.greatest(na, nb)


def _reachable(percent: int) -> Column:
    """Whether entries x and y of one list may still be linked, by lengths and by what can be shared from their places on."""
    room = F.least(F.col("x_n") - F.col("x_at"), F.col("y_n") - F.col("y_at"))
    return _fit(F.col("x_n"), F.col("y_n"), percent) & ((100 + percent) * room >= percent * (F.col("x_n") + F.col("y_n")))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked: orders 2 and 3 first, then the exact overlap. ``sets``: doc_id, n, q, tokens in ascending order."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("q").alias("qa"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("q").alias("qb"), F.col("tokens").alias("tb"))
    both = pairs.join(right, "b").join(left, "a").where(_fit(F.col("na"), F.col("nb"), percent))
    low = F.arrays_overlap(F.slice("ta", F.lit(1), F.col("qa")), F.slice("tb", F.lit(1), F.col("qb")))
    high = F.arrays_overlap(F.slice("ta", -F.col("qa"), F.col("qa")), F.slice("tb", -F.col("qb"), F.col("qb")))
    shared = F.size(F.array_intersect("ta", "tb"))
    return both.where(low & high).where(100 * shared >= percent * (F.col("na") + F.col("nb") - shared)).select("a", "b")


def _classes(df: DataFrame, size: int, doc_id: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents, their features (doc_id, n, d1, d2) and the classes of equal sets (d1, d2, class_id, copies, n)."""
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    features = materialize(_features(docs, size), "features")
    named = features.where("doc_id is not null and n > 0")
    reps = named.groupBy("d1", "d2").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"))
    return docs, features, materialize(reps, "classes")


def _index(docs: DataFrame, features: DataFrame, reps: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of one document of each class: its set (doc_id, n, q, central, tokens, prefix), its entries in the lists of order 1 and the lists' lengths and firsts."""
    # of copies, only the one with the smallest doc_id is indexed
    named = features.where("doc_id is not null and n > 0")
    copied = named.join(reps.where("copies > 1").select("d1", "d2", "class_id"), ["d1", "d2"]).where("doc_id <> class_id").select("doc_id")
    copied = materialize(copied.join(reps.select(F.col("class_id").alias("doc_id")), "doc_id", "left_anti").distinct(), "copies")
    total = reps.agg(F.sum("n")).first()[0] or 0
    partitions = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TOKENS_PER_PARTITION))
    single = docs.where("doc_id is not null").join(bounded(copied), "doc_id", "left_anti")
    shared, counted = _shared_tokens(single, size, partitions)
    lengths = reps.groupBy(F.col("class_id").alias("doc_id")).agg(F.max("n").alias("n"))
    # the prefix holds the unshared shingles and then the first q shared ones
    q = F.size("tokens") + _prefix_length(F.col("n"), percent) - F.col("n")
    sets = shared.join(lengths, "doc_id").withColumn("q", q.cast("int")).where("q > 0")
    pairs = F.sort_array(F.arrays_zip(F.col("dfs"), F.col("tokens")))
    central = (F.aggregate("dfs", F.lit(0).cast("long"), lambda a, x: a + x) / F.col("n")).alias("central")
    sets = materialize(sets.select("doc_id", "n", "q", central, F.array_sort("tokens").alias("tokens"), F.transform(F.slice(pairs, F.lit(1), F.col("q")), lambda x: x["tokens"]).alias("prefix")), "sets")
    forget(counted)
    # places count from the first shared shingle; the unshared ones before it are added
    unshared = (F.col("n") - F.size("tokens")).alias("unshared")
    postings = sets.select("doc_id", "n", "central", unshared, F.posexplode("prefix").alias("at", "token")).withColumn("at", F.col("at") + F.col("unshared")).drop("unshared")
    # the first of a list by a partial aggregation, the one before within a part of it
    heads = postings.groupBy("token").agg(F.count(F.lit(1)).alias("length"), F.min(F.struct((-F.col("central")).alias("rank"), "doc_id", "n")).alias("head")).where("length > 1")
    heads = materialize(heads.select("token", F.ceil(F.col("length") / LIST_PART).alias("parts"), F.struct("head.doc_id", "head.n").alias("head")), "heads")
    return sets, postings, heads


def _part(parts: str = "parts") -> Column:
    """The part of a long list that a document is dealt to."""
    return F.expr(f"pmod(xxhash64(doc_id), {parts})")


def near_duplicates(df: DataFrame, size: int = 5, percent: int = 75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, class_id (smallest doc_id with an equal set) and component_id of every row."""
    docs, features, reps = _classes(df, size, doc_id, text)
    sets, postings, heads = _index(docs, features, reps, size, percent)
    listed = postings.join(bounded(heads), "token").withColumn("part", _part())
    by_place = Window.partitionBy("token", "part").orderBy(F.col("central").desc(), "doc_id")
    lists = materialize(listed.withColumn("before", F.lag(F.struct("doc_id", "n")).over(by_place)).drop("central", "parts", "part"), "lists")
    near = lists.select("doc_id", "n", F.explode(F.array("before", "head")).alias("other")).where(F.col("other").isNotNull() & (F.col("other.doc_id") != F.col("doc_id")) & _fit(F.col("n"), F.col("other.n"), percent))
    first = materialize(near.select(F.greatest("doc_id", "other.doc_id").alias("a"), F.least("doc_id", "other.doc_id").alias("b")).distinct(), "pairs")
    links = materialize(_verified(first, sets, percent), "links")
    # what is still apart within a list: all pairs across components
    labels = materialize(connected_components(links), "labels")
    apart = lists.select("token", "doc_id", "n", "at").join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    mixed = apart.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("token")
    apart = materialize(apart.join(mixed, "token"), "apart")
    x, y = apart.select(*[F.col(c).alias(f"x_{c}") for c in apart.columns]), apart.select(*[F.col(c).alias(f"y_{c}") for c in apart.columns])
    crossing = x.join(y, (F.col("x_token") == F.col("y_token")) & (F.col("x_doc_id") > F.col("y_doc_id")) & (F.col("x_component") != F.col("y_component")) & _reachable(percent))
    second = crossing.select(F.col("x_doc_id").alias("a"), F.col("y_doc_id").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    more = materialize(_verified(materialize(second, "pairs"), sets, percent), "links")
    found = materialize(connected_components(links.unionByName(more)), "labels")
    out = features.join(reps.drop("n", "copies"), ["d1", "d2"], "left").withColumn("class_id", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")))
    out = out.join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
    known = F.col("doc_id").isNotNull()
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(known, F.col("class_id")).alias("class_id"), F.when(known, F.coalesce("component", "class_id")).alias("component_id"))


def links(df: DataFrame, size: int = 5, percent: int = 75, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """All links between different sets, as pairs a > b of class ids; and the membership (doc_id, class_id, n_shingles) of every row.

    Unlike ``near_duplicates`` it verifies the pairs within components too, so its work follows the number of
    candidate pairs, which a group of m near copies (not of exact ones) raises to m * m / 2. Long lists are met in
    pairs of parts of about LIST_PART documents, so no task has a whole list to itself.
    Rows without doc_id have no class and no link; empty texts are their own class and have none. Rows that repeat a
    doc_id and its text count once; of a doc_id with different texts the links are not defined.
    """
    docs, features, reps = _classes(df, size, doc_id, text)
    sets, postings, heads = _index(docs, features, reps, size, percent)
    listed = postings.join(bounded(heads.select("token", "parts")), "token").withColumn("part", _part())
    listed = materialize(listed.select("token", "doc_id", "n", "at", "part", "parts"), "lists")
    # a document of part p meets part k under the key (greater, smaller) of the two
    met = listed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    met = met.select("token", F.greatest("part", "other").alias("hi"), F.least("part", "other").alias("lo"), "doc_id", "n", "at", "part")
    x, y = met.select(*[F.col(c).alias(f"x_{c}") for c in met.columns]), met.select(*[F.col(c).alias(f"y_{c}") for c in met.columns])
    same = (F.col("x_token") == F.col("y_token")) & (F.col("x_hi") == F.col("y_hi")) & (F.col("x_lo") == F.col("y_lo"))
    once = (F.col("x_doc_id") > F.col("y_doc_id")) & ((F.col("x_part") != F.col("y_part")) | (F.col("x_hi") == F.col("x_lo")))
    pairs = x.join(y, same & once & _reachable(percent)).select(F.col("x_doc_id").alias("a"), F.col("y_doc_id").alias("b")).distinct()
    found = _verified(materialize(pairs, "pairs"), sets, percent)
    members = features.join(reps.drop("n", "copies"), ["d1", "d2"], "left").withColumn("class_id", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")))
    return found, members.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id"), F.col("n").alias("n_shingles"))


def link_counts(df: DataFrame, size: int = 5, percent: int = 75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, class_id and n_links of every row: how many other doc_ids it is linked with, copies included.

    Counts are added up by class, so copies are not expanded into pairs; work and odd cases are those of ``links``.
    """
    found, members = links(df, size, percent, doc_id, text)
    found, members = materialize(found, "links"), materialize(members, "members")
    sizes = members.where("doc_id is not null and n_shingles > 0").select("doc_id", "class_id").distinct().groupBy("class_id").agg(F.count(F.lit(1)).alias("members"))
    both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(sizes.withColumnRenamed("class_id", "b"), "b").groupBy(F.col("a").alias("class_id")).agg(F.sum("members").alias("others"))
    counts = materialize(sizes.join(others, "class_id", "left").select("class_id", (F.col("members") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "counts")
    return members.join(bounded(counts), "class_id", "left").select("doc_id", "n_shingles", "class_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
