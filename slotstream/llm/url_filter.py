"""URL filters: a blocked Bloom filter passes possible hits to an exact join.

The list is a table of entries (host, path, verdict); an entry fits its host and all subdomains where the url's
path starts with the entry's. Every (domain suffix, path start) of a url is probed in one 256-bit block of the
filter; only possible hits go on to the exact hash join with the list, which removes false positives. The filter is
a table of blocks that grows with the list: it is broadcast while it is small, and joined by block beyond that.

Null urls and urls without `://` have empty host and path and fit nothing. Repeated list entries count once;
where equal entries disagree, block wins. Of rules of equal length the one with the longer host decides. Urls of any
length are judged whole. Repeated pages are judged each by itself; an empty table gives an empty result. Extra
columns of the pages are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotstream.llm.common import bounded, materialize

LANES = 8  # 32-bit lanes of a block, one bit in each
BROADCAST_BLOCKS = 1 << 17  # of nine numbers each, about 8 MB as a table; larger filters are joined by shuffle
BITS_PER_KEY = 16


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    return F.coalesce(_ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Key of a page in a list of canonical urls: host without leading www., path without trailing slash."""
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.lit(" "), F.regexp_replace(path, "/+$", ""))


class BlockedBloom:
    """A blocked Bloom filter over string keys, held as a table (block, l0..l7) of as many blocks as the keys need."""

    def __init__(self, keys: DataFrame, key: str):
        n = keys.count()
        wanted = max(1, n * BITS_PER_KEY // (32 * LANES))
        self.blocks = 1 << (wanted - 1).bit_length() if wanted > 1 else 1
        table = keys.select(self.block(F.col(key)).alias("block"), *[self.bit(F.col(key), i).alias(f"l{i}") for i in range(LANES)])
        self.table = materialize(table.groupBy("block").agg(*[F.bit_or(f"l{i}").alias(f"l{i}") for i in range(LANES)]), "bloom")

    def block(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.blocks))

    @staticmethod
    def bit(key: Column, lane: int) -> Column:
        """One bit of a lane, from five bits of a second hash."""
        shift = F.shiftrightunsigned(F.xxhash64(key, F.lit("lane")), 5 * lane).bitwiseAND(F.lit(31)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), shift)

    def possible(self, df: DataFrame, key: str) -> DataFrame:
        """Rows of ``df`` whose key may be listed: no listed key is ever lost."""
        probe = df.withColumn("_block", self.block(F.col(key)))
        hit = F.lit(True)
        for i in range(LANES):
            hit = hit & (F.col(f"l{i}").bitwiseAND(self.bit(F.col(key), i)) != 0)
        table = self.table.withColumnRenamed("block", "_block")
        return probe.join(F.broadcast(table) if self.blocks <= BROADCAST_BLOCKS else table, "_block").where(hit).select(*df.columns)


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame | None = None, page_id: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    ``rules``: host, path, verdict. The longest fitting rule decides (ties: the longer host). Without one,
    a page whose canonical url is in ``listed`` (column ``canonical``) is blocked; any other gets ``default``.
    """
    urls = materialize(pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")), "urls")
    distinct = materialize(urls.where(F.col("host") != "").select("host", "path").distinct(), "distinct")
    rules = rules.select(F.lower("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict").groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("rule_verdict"))
    rules = materialize(rules.withColumn("key", F.concat_ws(" ", "rule_host", "rule_path")), "rules")
    # path starts to probe: the lengths of the listed paths, at most as many as a url is long
    lengths = sorted(r[0] for r in rules.select(F.length("rule_path")).distinct().collect())
    found = distinct.limit(0).select("host", "path", F.lit("").alias("rule"), F.lit("").alias("found"))
    if lengths:
        labels = F.split("host", r"\.")
        suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
        starts = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]), lambda p: p.isNotNull())
        probes = distinct.withColumn("suffix", F.explode(suffixes)).withColumn("start", F.explode(starts)).withColumn("key", F.concat_ws(" ", "suffix", "start")).drop("suffix", "start")
        hits = BlockedBloom(rules, "key").possible(probes, "key").join(bounded(rules), "key")
        best = F.max(F.struct((F.length("rule_host") + F.length("rule_path")).alias("n"), F.length("rule_host").alias("h"), "rule_host", "rule_path", "rule_verdict"))
        best = hits.groupBy("host", "path").agg(best.alias("b"))
        found = materialize(best.select("host", "path", F.concat("b.rule_host", "b.rule_path").alias("rule"), F.col("b.rule_verdict").alias("found")), "ruled")
    if listed is not None:
        listed = materialize(listed.select("canonical").where(F.col("canonical").isNotNull()).distinct(), "listed")
        open_urls = distinct.join(found, ["host", "path"], "left_anti").withColumn("canonical", canonical(F.col("host"), F.col("path")))
        blocked = BlockedBloom(listed, "canonical").possible(open_urls, "canonical").join(listed, "canonical", "left_semi")
        found = materialize(found.unionByName(blocked.select("host", "path", F.lit(None).cast("string").alias("rule"), F.lit("block").alias("found"))), "found")
    return urls.join(bounded(found), ["host", "path"], "left").select("page_id", "host", "path", "rule", F.coalesce("found", F.lit(default)).alias("verdict"))


def rule_table(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A rule table from literal (verdict, host, path) entries."""
    return spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for v, h, p in rules])))
