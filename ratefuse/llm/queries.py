"""Registered queries of the corpus operators, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ratefuse.llm import (
    html_text, jaccard, language, line_quality, minhash, mixing, packing, periodic_runs,
    prefix_trie, repeats, secret_scan, topk, toxicity,
)
from ratefuse.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


@query("op1_secrets")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(read(spark, sf_dir, "documents"))


@query("op2_language")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language.detect(docs, language.learn(docs))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op6_html_text")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


@query("op3_jaccard_join")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read(spark, sf_dir, "documents"))


@query("op4_repeats")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(read(spark, sf_dir, "documents"))


@query("op7_mixing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


_TOPK_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
    AS rank
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op8_topk", _TOPK_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read(spark, sf_dir, "embeddings"))


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


@query("op10_minhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprint_edits(read(spark, sf_dir, "documents"))


@query("minhash_near_copies")
def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_copies(read(spark, sf_dir, "documents"))


@query("op11_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.report(read(spark, sf_dir, "documents"), edit=True)


# The checksum bit by bit: 3988292384 is its polynomial, reversed.
_TRIE_SQL = r"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (
      PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
      md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))
    ) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(
      string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
    lambda crc, byte: list_reduce(
      list_prepend(xor(crc, byte), [CAST(k AS BIGINT) for k in range(8)]),
      lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))
  ), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM own)
), said AS (
  SELECT c.conv_id, 0 AS part, o.pos, o.role, o.text
  FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 20 AND o.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, o.pos, o.role, o.text
  FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h
), steps AS (
  SELECT conv_id, row_number() OVER w AS depth,
    string_agg(md5(length(role) || ':' || role || text), ',') OVER w AS path,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM said WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)
  UNION ALL
  SELECT conv_id, 0, '', 0 FROM convs
), ended AS (
  SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, arg_max(path, depth) AS path FROM steps GROUP BY conv_id) GROUP BY path
), node AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words,
    CASE WHEN depth = 0 THEN NULL WHEN depth = 1 THEN '' ELSE left(path, length(path) - 33) END
      AS above
  FROM steps GROUP BY path, depth
), kids AS (SELECT above, count(*) AS n FROM node GROUP BY above),
sums AS (
  SELECT s.path, sum((k.n IS NULL)::INT) AS leaves, sum((v.n_convs - 1) * v.words) AS saved
  FROM node v JOIN steps s ON s.conv_id = v.conv_id AND s.depth <= v.depth
  LEFT JOIN kids k ON k.above = v.path
  GROUP BY s.path
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
  CAST(coalesce(k.n, 0) AS BIGINT) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM node n JOIN sums s ON s.path = n.path LEFT JOIN node p ON p.path = n.above
LEFT JOIN kids k ON k.above = n.path LEFT JOIN ended e ON e.path = n.path
"""


@query("op12_trie", _TRIE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.family_trie(read(spark, sf_dir, "conversations"))


@query("op13_quality")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return line_quality.score_documents(docs, labels)
