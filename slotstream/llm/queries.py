"""The registered queries of the corpus operators, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.llm import bpe, license_scan, mixing, ngram_join, phrases, pii, quality_rules, simhash, substring_dedup, token_counts, topk_search, url_filter, variants
from slotstream.llm.common import bounded, materialize

VOCABULARY = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The histogram of encoded lengths with suffix sums for every context limit."""
    count = bpe.counter(spark, public_tokenizers.path(VOCABULARY))
    lengths = _table(spark, sf_dir, "documents").select(count("text").alias("n_tokens"))
    return token_counts.suffix_sums(materialize(token_counts.length_histogram(lengths, "n_tokens"), "histogram"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document under 5-word shingles and a Jaccard similarity of 0.75."""
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"), size=5, percent=75).select("doc_id", "n_shingles", "component_id", "class_id")


OP2_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, s FROM (
  SELECT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y, k = nx.n AND k = ny.n AS equal FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 75 * (nx.n + ny.n - k)),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT a, y FROM reach JOIN links ON x = b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(b) AS component_id, coalesce(least(d.doc_id, min(e.y)), d.doc_id) AS class_id
FROM d LEFT JOIN n USING (doc_id) JOIN reach ON a = d.doc_id LEFT JOIN (SELECT x, min(y) AS y FROM links WHERE equal GROUP BY x) e ON e.x = d.doc_id
GROUP BY d.doc_id, n.n
"""

#: The rules of the url list: verdict, host, path.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts by the rules, else by a list: the canonical urls of pages whose title another page has too."""
    pages = _table(spark, sf_dir, "pages")
    title = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)
    key = url_filter.canonical(url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url")))
    titled = materialize(pages.select(title.alias("title"), key.alias("canonical")).where("title <> ''"), "titles")
    shared = titled.groupBy("title").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("title")
    listed = titled.join(bounded(materialize(shared, "shared")), "title", "left_semi").select("canonical")
    return url_filter.judge(pages, url_filter.rule_table(spark, URL_RULES), listed)


OP3_SQL = """
WITH u AS (
  SELECT page_id,
         CASE WHEN position('://' IN url) > 0 THEN translate(regexp_extract(substr(url, position('://' IN url) + 3), '^[^/?#]*'),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN position('://' IN url) > 0 THEN regexp_extract(substr(url, position('://' IN url) + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
rules(verdict, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
judged AS (
  SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS ruled
  FROM (SELECT DISTINCT host, path FROM u) JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY host, path),
keyed AS (SELECT u.*, regexp_replace(host, '^www\\.', '') || ' ' || regexp_replace(path, '/+$', '') AS canonical FROM u),
titled AS (SELECT canonical, count(*) OVER (PARTITION BY title) AS n FROM (
  SELECT k.canonical, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title FROM keyed k JOIN pages USING (page_id)) WHERE title <> ''),
listed AS (SELECT DISTINCT canonical FROM titled WHERE n > 1)
SELECT k.page_id, k.host, k.path, j.rule,
       coalesce(j.ruled, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM keyed k LEFT JOIN judged j USING (host, path) LEFT JOIN listed l USING (canonical)
"""


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own or inherited licence of every document, filed as source/thousands/hundreds/doc_id.txt."""
    place = F.concat_ws("/", "source", F.floor(F.col("doc_id") / 1000), F.floor(F.col("doc_id") / 100), F.concat("doc_id", F.lit(".txt")))
    scanned = license_scan.scan(_table(spark, sf_dir, "documents").select("doc_id", place.alias("path"), "text")).drop("text")
    return license_scan.inherit(materialize(scanned, "scanned")).withColumn("score", F.round("score", 9)).drop("share")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, distances and verdict of every document."""
    judged = quality_rules.judge(_table(spark, sf_dir, "documents"))
    return judged.withColumns({c: F.round(c, 9) for c in ("class_distance", "word_distance")})


_BINS = ", ".join(f"({i}, '{w}')" for i, w in enumerate(quality_rules.WORD_BINS))
_CLASS = "length(t) - length(regexp_replace(t, '{}', '', 'g'))"
_CLASS_COUNTS = ", ".join(_CLASS.format(c.removesuffix("+").replace("'", "''")) for c in (quality_rules.SEPARATOR.encode().decode("unicode_escape"), *quality_rules.CLASSES))
_LIMITS = quality_rules.Limits()
OP5_SQL = f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM g WHERE n > 1) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
c AS (SELECT doc_id, t, [{_CLASS_COUNTS}] AS c FROM d),
bins(bin, word) AS (VALUES {_BINS}),
hits AS (SELECT doc_id, bin, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word FROM d) JOIN bins USING (word) GROUP BY ALL),
classes AS (SELECT doc_id, 'c' AS kind, unnest(range(0, 7)) AS bin, unnest(list_append(c, length(t) - list_sum(c))) AS n FROM c),
common AS (SELECT d.doc_id, 'w' AS kind, b.bin, coalesce(h.n, 0) AS n FROM d CROSS JOIN bins b LEFT JOIN hits h ON h.doc_id = d.doc_id AND h.bin = b.bin
  UNION ALL SELECT d.doc_id, 'w', -1, len(w) - coalesce((SELECT sum(n) FROM hits h WHERE h.doc_id = d.doc_id), 0) FROM d),
counts AS (SELECT * FROM classes UNION ALL SELECT * FROM common),
shares AS (SELECT doc_id, kind, bin, n, n / sum(n) OVER (PARTITION BY doc_id, kind) AS p FROM counts QUALIFY sum(n) OVER (PARTITION BY doc_id, kind) > 0),
refs AS (SELECT lang, kind, bin, sum(counts.n) / sum(sum(counts.n)) OVER (PARTITION BY lang, kind) AS q FROM counts JOIN d USING (doc_id) LEFT JOIN r USING (doc_id)
  WHERE len(w) >= 50 AND 100 * coalesce(r.n, 0) <= 50 * len(w) AND lang IN ('de', 'en', 'es', 'fr') AND len(w) >= {_LIMITS.min_words} AND length(t) >= {_LIMITS.min_chars} GROUP BY lang, kind, bin),
js AS (SELECT shares.doc_id, kind, refs.lang, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS x
  FROM shares JOIN refs USING (kind, bin) JOIN d ON d.doc_id = shares.doc_id AND d.lang = refs.lang GROUP BY shares.doc_id, kind, refs.lang),
near AS (SELECT doc_id, min(x) FILTER (kind = 'c') AS class_distance, min(x) FILTER (kind = 'w') AS word_distance FROM js GROUP BY doc_id),
base AS (SELECT d.doc_id, len(w) AS n_words, length(t) - c.c[1] AS word_chars, c.c[5] AS n_symbols, coalesce(l.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, length(t) AS n_chars,
  near.class_distance, near.word_distance, len(w) < 50 OR 100 * coalesce(r.n, 0) > 50 * len(w) AS base_failed
  FROM d JOIN (SELECT doc_id, c FROM c) c USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN near USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, round(class_distance, 9) AS class_distance, round(word_distance, 9) AS word_distance, base_failed,
  NOT base_failed AND NOT (n_chars >= {_LIMITS.min_chars} AND coalesce(class_distance, 0) > {_LIMITS.class_distance}) AND NOT (n_words >= {_LIMITS.min_words} AND coalesce(word_distance, 0) > {_LIMITS.word_distance}) AS kept
FROM base
"""


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words or more that an earlier document has, as digests."""
    kept = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"), words=50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP6_SQL = """
WITH d AS (SELECT doc_id, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS pos FROM d WHERE len(w) >= 50),
h AS (SELECT s.doc_id, s.pos, sha256(array_to_string(list_slice(d.w, s.pos, s.pos + 49), ' ')) AS h FROM s JOIN d USING (doc_id)),
f AS (SELECT h, min(doc_id) AS first_doc FROM h GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS i FROM h JOIN f USING (h) WHERE doc_id > first_doc),
g AS (SELECT doc_id, count(*) AS n, list(i) AS gone FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(w), 0) AS n_words, coalesce(g.n, 0) AS n_removed,
       sha256(coalesce(array_to_string(list_filter(w, lambda x, i: g.gone IS NULL OR NOT list_contains(g.gone, i)), ' '), '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
"""


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return bpe.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best rows for every hundredth vector."""
    return topk_search.search(_table(spark, sf_dir, "embeddings"), k=10, every=100)


OP8_SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""


#: Key of the surrogates in these queries; a production run passes its own secret.
PII_KEY = b"surrogates of the registered queries"


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates in place of its entities."""
    return pii.replace_entities(_table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phase, block, slot and position of every document, by source weights tempered with the square root."""
    return mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "source"), alpha=0.5)


OP10_SQL = f"""
WITH RECURSIVE sizes AS (SELECT coalesce('=' || source, '') AS s, count(*) AS n FROM documents GROUP BY ALL),
sources AS (SELECT s, w, n // w AS full_rounds, n % w AS rest FROM (SELECT *, greatest(1, CAST(round({mixing.FINEST} * pow(n / (SELECT min(n) FROM sizes), 0.5)) AS BIGINT)) AS w FROM sizes)),
firsts AS (SELECT r, coalesce(lead(r) OVER (ORDER BY r), last_round) - r AS rounds, row_number() OVER (ORDER BY r) - 1 AS phase FROM (
  SELECT DISTINCT r, last_round FROM (SELECT 0 AS r UNION ALL SELECT full_rounds FROM sources UNION ALL SELECT full_rounds + 1 FROM sources), (SELECT max(full_rounds + CAST(rest > 0 AS BIGINT)) AS last_round FROM sources) WHERE r < last_round)),
active AS (SELECT phase, r, rounds, s, CASE WHEN r < full_rounds THEN w ELSE rest END AS c FROM firsts JOIN sources ON r < full_rounds OR (r = full_rounds AND rest > 0)),
phases AS (SELECT phase, r, rounds, list(s ORDER BY s) AS names, list(c ORDER BY s) AS c, CAST(sum(c) AS BIGINT) AS slots FROM active GROUP BY ALL),
placed AS (SELECT *, coalesce(CAST(sum(slots * rounds) OVER (ORDER BY phase ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS first_slot FROM phases),
edf(phase, t, names, c, slots, k, chosen) AS (
  SELECT phase, CAST(-1 AS BIGINT), names, c, slots, [CAST(0 AS BIGINT) FOR x IN c], CAST(0 AS BIGINT) FROM phases
  UNION ALL
  SELECT phase, t, names, c, slots, list_transform(range(1, len(c) + 1), lambda j: k[j] + CAST(j = chosen AS BIGINT)), chosen FROM (
    SELECT phase, t + 1 AS t, names, c, slots, k,
      list_min([((k[j] + 1) * slots + c[j] - 1) // c[j] * 1000000 + j FOR j IN range(1, len(c) + 1) IF k[j] < c[j] AND k[j] * slots // c[j] <= t + 1]) % 1000000 AS chosen
    FROM edf WHERE t + 1 < slots)),
places AS (SELECT phase, t, names[chosen] AS s, row_number() OVER (PARTITION BY phase, chosen ORDER BY t) - 1 AS nth FROM edf WHERE t >= 0),
numbered AS (SELECT doc_id, source, coalesce('=' || source, '') AS s, row_number() OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS block FROM documents),
dealt AS (SELECT d.*, block // w AS round, block % w AS nth FROM numbered d JOIN sources USING (s))
SELECT doc_id, source, p.phase, block, first_slot + (round - r) * slots + t AS slot, first_slot + (round - r) * slots + t AS position
FROM dealt d JOIN placed p ON round >= r AND round < r + rounds JOIN places x ON x.phase = p.phase AND x.s = d.s AND x.nth = d.nth
"""


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of seven letters or more with their frequent forms and roots."""
    return variants.group(_table(spark, sf_dir, "documents").select("doc_id", "text"), least_length=7, least_count=2, ratio=10, one_in=31)


_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP11_SQL = f"""
WITH RECURSIVE crc AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_prepend(i, [CAST(0 AS BIGINT) FOR x IN range(8)]), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
runs AS (SELECT doc_id, run, count(*) AS k, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM (
  SELECT doc_id, {_FOLD.format("unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{7,}'))")} AS run FROM documents) GROUP BY doc_id, run),
summed AS (SELECT run, k, xor(list_reduce(list_prepend(4294967295, [CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT) FOR i IN range(length(x) // 2)]),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM runs, crc),
words AS (SELECT w, CAST(sum(k) AS BIGINT) AS n FROM (
  SELECT k, CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS w FROM summed) WHERE length(w) >= 7 GROUP BY w HAVING sum(k) >= 2),
cut AS (SELECT w, i, left(w, i) || substr(w, i + 2) AS c FROM (SELECT w, unnest(range(length(w))) AS i FROM words)),
near AS (SELECT a.w, b.w AS v FROM cut a JOIN cut b ON a.c = b.c AND a.i = b.i AND a.w <> b.w
  UNION SELECT a.w, b.w FROM cut a JOIN words b ON a.c = b.w UNION SELECT b.w, a.w FROM cut a JOIN words b ON a.c = b.w),
best AS (SELECT w, count(*) AS n_near, arg_max(v, n) FILTER (first) AS form, max(n) AS form_n FROM (
  SELECT near.w, v, n, row_number() OVER (PARTITION BY near.w ORDER BY n DESC, v) = 1 AS first FROM near JOIN words ON words.w = v) GROUP BY w),
forms AS (SELECT words.w, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN form END AS form, CASE WHEN form_n >= 10 * n THEN form_n END AS form_n FROM words LEFT JOIN best USING (w)),
ways(w, root) AS (SELECT w, w FROM forms UNION ALL SELECT ways.w, form FROM ways JOIN forms ON forms.w = ways.root WHERE form IS NOT NULL),
ends AS (SELECT ways.w, root FROM ways JOIN forms ON forms.w = ways.root WHERE form IS NULL)
SELECT w AS word, form, root, n, n_near, form_n FROM forms JOIN ends USING (w)
"""


def op12_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 4-word shingles, and components of those that differ in 4 bits at most."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"), threshold=4, size=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "class_id")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of two and three words of each language."""
    return phrases.collocations(_table(spark, sf_dir, "documents").select("lang", "text"), least=10, percent=50, top=2000)


OP13_SQL = f"""
WITH pieces AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_FOLD.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
f AS (SELECT lang, p, len(p) AS k, count(*) AS f FROM (
  SELECT lang, list_slice(w, i, i + size - 1) AS p FROM places, (VALUES (1), (2), (3)) s(size) WHERE i + size - 1 <= len(w)) GROUP BY lang, p),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 10),
cuts AS (SELECT c.lang, c.p, c.k, c.f AS a, j, l.f AS l, r.f AS r, CAST(1000000 * CAST(c.f AS HUGEINT) * c.f // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c JOIN f l ON l.lang = c.lang AND l.p = list_slice(c.p, 1, j) JOIN f r ON r.lang = c.lang AND r.p = list_slice(c.p, j + 1, c.k)),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
longer AS (SELECT lang, q, max(f) AS f FROM (SELECT lang, list_slice(p, 1, 2) AS q, f FROM c WHERE k = 3 UNION ALL SELECT lang, list_slice(p, 2, 3), f FROM c WHERE k = 3) GROUP BY lang, q),
kept AS (SELECT x.lang, array_to_string(p, ' ') AS phrase, a, l, r, score FROM lowest x LEFT JOIN longer y ON y.lang = x.lang AND y.q = x.p WHERE y.f IS NULL OR 100 * y.f < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang) USING (lang) WHERE rank <= 2000
"""


QUERIES = {"op1_token_counts": op1_token_counts, "op2_ngram_join": op2_ngram_join, "op3_url_filters": op3_url_filters, "op4_license_scans": op4_license_scans, "op5_quality_rules": op5_quality_rules, "op6_substring_dedup": op6_substring_dedup, "op7_bpe": op7_bpe, "op8_topk": op8_topk, "op9_pii": op9_pii, "op10_mixing": op10_mixing, "op11_spelling_variants": op11_spelling_variants, "op12_simhash_dedup": op12_simhash_dedup, "op13_collocations": op13_collocations}
ORACLE_SQL = {"op2_ngram_join": OP2_SQL, "op3_url_filters": OP3_SQL, "op5_quality_rules": OP5_SQL, "op6_substring_dedup": OP6_SQL, "op8_topk": OP8_SQL, "op10_mixing": OP10_SQL, "op11_spelling_variants": OP11_SQL, "op13_collocations": OP13_SQL}
