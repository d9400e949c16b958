"""The registered queries of this subpackage, each over its whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.layers import materialize
from . import (
    convtrie,
    decontam,
    licenses,
    maxscore,
    neardup,
    packing,
    pii,
    quality,
    secretscan,
    substring,
    topk,
    urlfilter,
    veclinks,
)
from .common import pick

PII_KEY = b"wardline example key"
TOKENIZER = "word_bpe_49k.json"
END_ID = 2
# Rules of the URL query: (verdict, host/path).
URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
# Hosts on the block list: those with one of these words in their name.
LISTED_HOSTS = "(spam|casino|pills|adult|bets|ads)"
KEEP_SCORE = 0.7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- 1 ---------------------------------------------------------------------------------------


def op1_pii(spark, sf_dir):
    """Every document with its personal numbers and dates replaced by pseudonyms."""
    return pii.pseudonymise(table(spark, sf_dir, "documents"), PII_KEY)


# --- 2 ---------------------------------------------------------------------------------------


def load_tokenizer():
    import os

    import public_tokenizers
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
    return Tokenizer.from_file(public_tokenizers.path(TOKENIZER))


def op2_packing(spark, sf_dir):
    return packing.pack(
        table(spark, sf_dir, "documents"), load_tokenizer, END_ID, packing.WINDOW, width="<u2"
    )


# --- 3 ---------------------------------------------------------------------------------------


def secret_model(docs: DataFrame) -> secretscan.MarkovModel:
    samples = secretscan.labelled_samples(pick(docs, "doc_id", "text"))
    return secretscan.train(materialize(samples, "secret-samples"))


def op3_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = secretscan.scan(docs, secret_model(docs))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secretscan.span_text(F.col("base")), 256).alias("base_sha256"),
        secretscan.span_text(F.col("spans")).alias("spans"),
    )


# --- 4 ---------------------------------------------------------------------------------------


def op4_urls(spark, sf_dir):
    return urlfilter.judge(
        table(spark, sf_dir, "pages"), URL_RULES, lambda host: host.rlike(LISTED_HOSTS), materialize
    )


OP4_SQL = f"""
WITH parsed AS (
  SELECT page_id,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM parsed),
rules(rule, verdict) AS (VALUES {", ".join(f"('{r}', '{v}')" for v, r in URL_RULES)}),
parts AS (
  SELECT rule, verdict, split_part(rule, '/', 1) AS rule_host,
    substr(rule, instr(rule, '/')) AS rule_path
  FROM rules),
fits AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM split JOIN parts
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT s.page_id, s.host, s.path, f.rule,
  coalesce(f.verdict, CASE WHEN regexp_matches(s.host, '{LISTED_HOSTS}') THEN 'block' ELSE 'allow' END) AS verdict
FROM split s LEFT JOIN fits f USING (page_id)
"""


# --- 5 ---------------------------------------------------------------------------------------


def op5_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


# --- 6 ---------------------------------------------------------------------------------------


def op6_decontam(spark, sf_dir):
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# --- 7 ---------------------------------------------------------------------------------------


def op7_neardup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), 85)


# --- 8 ---------------------------------------------------------------------------------------


def quality_model(documents: DataFrame, labels: DataFrame) -> quality.CompressionModel:
    """Model from the labelled documents of the training folds."""
    marks = pick(labels, "doc_id", "quality").where(
        F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    # The smallest by hash are chosen among the narrow labels first, so that few texts move.
    chosen = quality.sample_ids(marks.select(F.col("doc_id").alias("id"), F.col("quality").alias("label")))
    texts = pick(documents, "doc_id", "text").toDF("id", "text")
    return quality.fit(texts.join(chosen, "id"))


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def op8_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"),
    )


# --- 9 ---------------------------------------------------------------------------------------


def op9_substring(spark, sf_dir):
    kept = substring.dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
win AS (
  SELECT rid, doc_id, p, array_to_string(w[p:p + 12], ' ') AS k
  FROM d, unnest(range(1, len(w) - 11)) AS t(p)),
firsts AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
covered AS (
  SELECT DISTINCT rid, p + o AS q
  FROM win JOIN firsts USING (k), range(0, 13) AS r(o) WHERE m < doc_id),
words AS (SELECT rid, q, w[q] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(q)),
kept AS (
  SELECT rid, count(c.q) AS n_removed, string_agg(word, ' ' ORDER BY q) FILTER (c.q IS NULL) AS text
  FROM words LEFT JOIN covered c USING (rid, q) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN kept k USING (rid)
"""


# --- 10 --------------------------------------------------------------------------------------


def op10_topk(spark, sf_dir):
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank"
  FROM scored)
SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= 5
"""


# --- 11 --------------------------------------------------------------------------------------


def op11_maxscore(spark, sf_dir):
    return maxscore.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
total AS (SELECT count(*) FILTER (len(w) > 0) AS n, sum(len(w)) AS l FROM d),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark),
tf AS (
  SELECT rid, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT rid, unnest(w) AS t FROM d)
  WHERE t IN (SELECT t FROM wanted) GROUP BY rid, t),
weight AS (
  SELECT t, CAST(floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, total GROUP BY t),
factor AS (SELECT rid, doc_id, CAST(10 + (90 * len(w) * n) // l AS BIGINT) AS m FROM d, total WHERE len(w) > 0),
scored AS (
  SELECT item_id, rid, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM wanted JOIN weight USING (t) JOIN tf USING (t) JOIN factor USING (rid)
  WHERE doc_id IS NOT NULL GROUP BY item_id, rid, doc_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS "rank"
  FROM scored WHERE score > 0)
SELECT item_id, "rank", doc_id, score FROM ranked WHERE "rank" <= 10
"""


# --- 12 --------------------------------------------------------------------------------------


def op12_convtrie(spark, sf_dir):
    return convtrie.prefix_trie(table(spark, sf_dir, "conversations"))


# CRC-32 is computed byte by byte from its polynomial; ids are decimal digits, so bytes are code points.
OP12_SQL = """
WITH crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)),
    lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) ORDER BY i) AS t
  FROM range(256) r(i)),
turns AS (
  SELECT conv_id AS c, coalesce("role", '') AS r, coalesce(text, '') AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce("role", ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - ((c % 100) + 100) % 100 AS base, xor(list_reduce(
      list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda z: CAST(ascii(z) AS BIGINT))),
      lambda a, b: xor(a // 256, t[CAST(xor(a % 256, b) AS INTEGER) + 1])), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM turns), crc),
rebuilt AS (
  SELECT c, list({'r': r, 'x': x} ORDER BY own, i) AS s
  FROM (
    SELECT v.c, 0 AS own, b.i, b.r, b.x FROM convs v JOIN turns b ON b.c = v.base AND b.i <= v.h
    UNION ALL SELECT v.c, 1, o.i, o.r, o.x FROM convs v JOIN turns o ON o.c = v.c AND o.i > v.h)
  GROUP BY c),
seqs AS (SELECT c, coalesce(s, []) AS s, coalesce(len(s), 0) AS n FROM convs LEFT JOIN rebuilt USING (c)),
member AS (
  SELECT c, n, d, CASE WHEN d > 0 THEN md5(CAST(s[1:d] AS VARCHAR)) ELSE '' END AS k,
    CASE WHEN d > 1 THEN md5(CAST(s[1:d - 1] AS VARCHAR)) WHEN d = 1 THEN '' END AS pk, length(s[d].x) AS size
  FROM seqs, unnest(range(n + 1)) AS u(d)),
node AS (
  SELECT d, k, any_value(pk) AS pk, min(c) AS c, count(*) AS n, (count(*) - 1) * coalesce(any_value(size), 0) AS own,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d), '')) AS ends
  FROM member GROUP BY d, k),
child AS (SELECT d - 1 AS d, pk AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
total AS (
  SELECT u.d, u.k, sum(v.own) AS saved, count(*) FILTER (w.n IS NULL) AS leaves
  FROM node v LEFT JOIN child w USING (d, k) JOIN member u ON u.c = v.c AND u.d <= v.d GROUP BY u.d, u.k)
SELECT a.c AS conv_id, a.d AS "depth", p.c AS parent_conv_id, a.n AS n_convs,
  CAST(coalesce(w.n, 0) AS BIGINT) AS n_children, CAST(t.leaves AS BIGINT) AS n_leaves,
  CAST(t.saved AS BIGINT) AS saved_tokens, a.ends AS ends_sha256
FROM node a JOIN total t USING (d, k) LEFT JOIN child w USING (d, k)
  LEFT JOIN node p ON p.d = a.d - 1 AND p.k = a.pk
"""


# --- 13 --------------------------------------------------------------------------------------


def op13_veclinks(spark, sf_dir):
    return veclinks.near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 0.9)


OP13_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS rid, vec_id,
    CASE WHEN len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    THEN list_transform(embedding, lambda x: CAST(x AS DOUBLE)) END AS e
  FROM embeddings),
links AS (
  SELECT a.rid AS x, b.rid AS y FROM v a JOIN v b ON len(a.e) = len(b.e) AND a.rid <> b.rid
  WHERE list_dot_product(a.e, b.e)
    / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.9),
reach AS (SELECT rid, rid AS other FROM v UNION SELECT r.rid, l.y FROM reach r JOIN links l ON r.other = l.x),
least AS (SELECT r.rid, min(o.vec_id) AS component_id FROM reach r JOIN v o ON o.rid = r.other GROUP BY r.rid),
degree AS (SELECT x AS rid, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id,
  component_id IS NULL OR coalesce(vec_id = component_id, false) AS kept
FROM v JOIN least USING (rid) LEFT JOIN degree USING (rid)
"""


def queries() -> dict:
    return {
        "op1_pii": op1_pii,
        "op2_packing": op2_packing,
        "op3_secrets": op3_secrets,
        "op4_urls": op4_urls,
        "op5_licenses": op5_licenses,
        "op6_decontam": op6_decontam,
        "op7_neardup": op7_neardup,
        "op8_quality": op8_quality,
        "op9_substring": op9_substring,
        "op10_topk": op10_topk,
        "op11_maxscore": op11_maxscore,
        "op12_convtrie": op12_convtrie,
        "op13_veclinks": op13_veclinks,
    }


def oracle_sql() -> dict:
    return {
        "op4_urls": OP4_SQL,
        "op9_substring": OP9_SQL,
        "op10_topk": OP10_SQL,
        "op11_maxscore": OP11_SQL,
        "op12_convtrie": OP12_SQL,
        "op13_veclinks": OP13_SQL,
    }
