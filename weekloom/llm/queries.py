"""One query for each operator over its whole table, and the SQL that some of them equal."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import backoff, bpe, cascade, convtrie, decontam, divergence, kdshard, langid, linedup, multiindex, repeats, simhash, triecount

SHARDS = 24

# The rules (host, path, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
# The listed share of all addresses: those whose MD5 begins with one of these digits (one in eight).
LISTED = "01"


def listed_address(address: Column) -> Column:
    """A list that grows with the addresses and has no pattern a filter could use."""
    return F.substring(F.md5(address), 1, 1).isin(*LISTED)


def reachable(spark: SparkSession) -> None:
    """Let the tasks' Python import this package from where the driver has it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.contained(docs, table(spark, sf_dir, "benchmark"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.without_repeats(docs, 20).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op3_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kdshard.shard(table(spark, sf_dir, "documents"), SHARDS)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return cascade.judge(pages, RULES, listed_address).select("page_id", "host", "path", "rule", "verdict")


def op5_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = backoff.score(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", F.round("log_score", 4).alias("log_score"),
        F.round("mean_log_score", 4).alias("mean_log_score"),
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = bpe.digests(docs, vocabulary_file("word_bpe_49k.json"))
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op8_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scores = triecount.piece_scores(vocabulary_file("piece_bpe_32k.model"))
    return triecount.count_tokens(docs, scores).select("doc_id", "n_words", "n_tokens")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convtrie.trie(table(spark, sf_dir, "conversations"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linedup.drop_common_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_substring_dedup, op3_kd_sharding, op4_url_cascade, op5_backoff_scores,
        op6_simhash, op7_bpe, op8_multi_index, op9_language, op10_token_counts,
        op11_prefix_trie, op12_source_divergence, op13_line_dedup, pipeline,
    )
}

_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"
_PLAIN = r"regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE: dict[str, str] = {
    "op1_decontamination": f"""
WITH d AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
q AS (SELECT item_id, {_PLAIN} AS w FROM benchmark),
n AS (SELECT item_id, w, least(5, len(w)) AS k FROM q WHERE len(w) > 0),
qs AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
       FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM n)),
ks AS (SELECT DISTINCT k FROM qs),
ds AS (SELECT DISTINCT doc_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks)),
total AS (SELECT item_id, count(*) AS n_shingles FROM qs GROUP BY item_id)
SELECT doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles AS containment
FROM (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN qs USING (k, s) GROUP BY ALL) JOIN total USING (item_id)
WHERE n_shared >= 0.8 * n_shingles""",
    "op2_substring_dedup": f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
        FROM (SELECT *, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op4_url_cascade": r"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(d, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                      ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (
  SELECT page_id, arg_max(d || p, length(d || p)) AS rule, arg_max(v, length(d || p)) AS v
  FROM h JOIN r ON (host = d OR ends_with(host, '.' || d)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN md5(host || path)[1] IN ('0', '1') THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN m USING (page_id)""",
    "op5_backoff_scores": f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
uni AS MATERIALIZED (SELECT x, count(*) AS n FROM word GROUP BY x),
c AS MATERIALIZED (SELECT sum(n) AS n FROM uni),
pair AS MATERIALIZED (SELECT doc_id, p, x AS b, lag(x) OVER (PARTITION BY doc_id ORDER BY p) AS a FROM word),
bi AS MATERIALIZED (
  SELECT a, b, count(*) AS n, min(doc_id) <> max(doc_id) AS shared FROM pair WHERE a IS NOT NULL GROUP BY a, b),
s AS (
  SELECT doc_id, CASE WHEN pair.a IS NULL THEN log10(ub.n) - log10((SELECT sum(n) FROM c))
    WHEN bi.shared THEN log10(bi.n) - log10(ua.n)
    ELSE log10(0.4) + log10(ub.n) - log10((SELECT sum(n) FROM c)) END AS l
  FROM pair LEFT JOIN bi ON bi.a = pair.a AND bi.b = pair.b JOIN uni ub ON ub.x = pair.b LEFT JOIN uni ua ON ua.x = pair.a),
t AS (SELECT doc_id, sum(l) AS l, count(*) AS n FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_words, round(coalesce(l, 0), 4) AS log_score, round(l / n, 4) AS mean_log_score
FROM (SELECT DISTINCT doc_id FROM d) LEFT JOIN t USING (doc_id)""",
    "op11_prefix_trie": r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
c AS MATERIALIZED (
  SELECT conv_id AS c, xor(list_reduce(list_prepend(4294967295, list_transform(
      string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda a, b:
      list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i:
        CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c, 0 AS k, p, role, text FROM c JOIN t ON t.conv_id = c - c % 5 AND p <= h
  UNION ALL SELECT c, 1, p, role, text FROM c JOIN t ON t.conv_id = c AND p > h),
n AS MATERIALIZED (
  SELECT c, row_number() OVER w AS d, strlen(text) AS b,
    string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '') OVER w AS s FROM r WINDOW w AS (PARTITION BY c ORDER BY k, p)
  UNION ALL SELECT c, 0, 0, '' FROM c),
e AS (SELECT c, max(d) AS d FROM n GROUP BY c),
node AS MATERIALIZED (SELECT d, s, min(c) AS conv_id, count(*) AS n, max(b) AS b FROM n GROUP BY d, s),
up AS MATERIALIZED (
  SELECT node.d, node.s, n.d AS ad, n.s AS a_s, node.n, node.b FROM node JOIN n ON n.c = node.conv_id AND n.d <= node.d),
kids AS MATERIALIZED (SELECT ad AS d, a_s AS s, count(*) AS k FROM up WHERE ad = d - 1 GROUP BY ALL),
total AS (
  SELECT ad AS d, a_s AS s, count(*) FILTER (k IS NULL) AS leaves, sum((n - 1) * b) AS saved
  FROM up LEFT JOIN kids USING (d, s) GROUP BY ALL),
ends AS (SELECT d, s, string_agg(c::VARCHAR, ',' ORDER BY c) AS x FROM n SEMI JOIN e USING (c, d) GROUP BY ALL),
parent AS (SELECT up.d, up.s, node.conv_id AS parent FROM up JOIN node ON node.d = ad AND node.s = a_s WHERE ad = up.d - 1)
SELECT conv_id, d::BIGINT AS depth, parent AS parent_conv_id, n AS n_convs, coalesce(k, 0) AS n_children, leaves AS n_leaves,
  saved::BIGINT AS saved_tokens, sha256(coalesce(x, '')) AS ends_sha256
FROM node JOIN total USING (d, s) LEFT JOIN kids USING (d, s) LEFT JOIN parent USING (d, s) LEFT JOIN ends USING (d, s)""",
    "op12_source_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
w AS MATERIALIZED (
  SELECT id, lang, source, term, count(*) AS n FROM (SELECT id, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS MATERIALIZED (SELECT lang, term, sum(n)::HUGEINT AS n FROM w GROUP BY lang, term HAVING count(*) >= 30),
c AS MATERIALIZED (
  SELECT lang, source, term, sum(w.n)::HUGEINT AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS MATERIALIZED (
  SELECT lang, source, v, coalesce(t.n, 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang) USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source) t USING (lang, source)),
p AS MATERIALIZED (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.n + 5 * g.v) AS p,
    1 + (1000000000::HUGEINT * (kept.n + 5)) // (sum(kept.n) OVER (PARTITION BY g.lang, g.source) + 5 * g.v) AS q
  FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
  row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM f QUALIFY part = 'pair' OR rank <= 50""",
    "op13_line_dedup": r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents),
l AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
k AS MATERIALIZED (
  SELECT *, translate(regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l),
c AS MATERIALIZED (
  SELECT k, max(doc_id) AS last FROM k WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (doc_id < last) AS n_dropped,
  sha256(coalesce(string_agg(x, chr(10) ORDER BY p) FILTER (last IS NULL OR doc_id >= last), '')) AS kept_sha256
FROM k LEFT JOIN c USING (k) GROUP BY doc_id""",
}
