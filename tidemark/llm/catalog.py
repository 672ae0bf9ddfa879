"""Queries that apply each operator to its whole table, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    class_lm,
    decontaminate,
    language,
    licences,
    line_dedup,
    near_vectors,
    order_minhash,
    pieces,
    prefix_trie,
    records,
    token_counts,
    toxicity,
    whitening,
)
from tidemark.llm.storage import Written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PIECE_MODEL = "piece_bpe_32k.model"
BYTE_BPE = "byte_bpe_50k.json"


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


_OP1_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
  least(e.vec_id, coalesce((SELECT min(b) FROM reach r WHERE r.a = e.vec_id), e.vec_id)) AS component_id,
  e.vec_id <= coalesce((SELECT min(b) FROM reach r WHERE r.a = e.vec_id), e.vec_id) AS kept
FROM embeddings e
"""


@_query
def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


ORACLES["op1_near_vectors"] = _OP1_SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs.select("doc_id", "text"), model)
    held_out = toxicity.held_out().alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted")


@_query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pieces.encoded(docs, public_tokenizers.path(PIECE_MODEL))


@_query
def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicate_classes(_table(spark, sf_dir, "documents"))


@_query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_decisions(_table(spark, sf_dir, "documents"))


@_query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontaminate.contaminated(docs, items).withColumn(
        "similarity", F.round("similarity", 9)
    )


@_query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    lengths = token_counts.document_lengths(docs, public_tokenizers.path(BYTE_BPE))
    counts = Written(token_counts.histogram(lengths), "length-histogram").df
    return token_counts.length_table(counts)


@_query
def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return records.write_records(docs, public_tokenizers.path(BYTE_BPE), end_id=2).digests()


@_query
def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_scan(_table(spark, sf_dir, "documents"))


@_query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    languages, table = language.train(_table(spark, sf_dir, "documents"))
    return language.identify(_table(spark, sf_dir, "pages"), languages, table)


@_query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


@_query
def op11_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return class_lm.score_documents(docs, class_lm.train(docs))


@_query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


# The unsigned CRC-32 of a decimal number, byte by byte and bit by bit.
_CRC32 = """xor(list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT),
        list_transform(string_split(CAST({c} AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
      lambda s, b: list_reduce(list_prepend(xor(s, b), CAST(range(8) AS BIGINT[])),
        lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v >> 1, CAST(3988292384 AS BIGINT)) ELSE v >> 1 END)),
    CAST(4294967295 AS BIGINT))"""

ORACLES["op12_prefix_trie"] = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST,
    left(sha256(strlen(role) || ':' || role || text), 32)) AS turns
  FROM t GROUP BY conv_id),
headed AS (SELECT *, {_CRC32.format(c="conv_id")} % 4 AS h FROM own),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS turns
  FROM headed a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20),
steps AS (
  SELECT conv_id, turns, d AS depth, turns[1:d] AS path
  FROM rebuilt, unnest(range(len(turns) + 1)) AS u(d)),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
      FILTER (WHERE len(turns) = depth), '') AS ends
  FROM steps GROUP BY path, depth),
children AS (
  SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children,
    CASE WHEN n.depth = 0 THEN 0
      ELSE len(regexp_extract_all(n.path[n.depth].text, '[^ \\t\\n\\x0B\\f\\r]+')) END AS words
  FROM nodes n LEFT JOIN children c ON c.path = n.path),
below AS (
  SELECT path[1:d] AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
    sum((n_convs - 1) * words) AS saved
  FROM counted, unnest(range(depth + 1)) AS u(d) GROUP BY 1)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children,
  b.n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(c.ends) AS ends_sha256
FROM counted c JOIN below b ON b.path = c.path
LEFT JOIN nodes p ON c.depth > 0 AND p.depth = c.depth - 1 AND p.path = c.path[1:c.depth - 1]
"""
