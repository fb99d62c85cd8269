"""Queries of the operators on vectors, conversations and sequences, with DuckDB SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cost_packing, shared_lists, turn_repair

TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return shared_lists.mine(vectors.select("vec_id", "embedding", noisy.alias("label")), every=100, positives=5, negatives=10, low=30, high=90)


OP11_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, coalesce(list_sum(list_transform(range(1, least(len(a.v), len(c.v)) + 1), lambda i: a.v[i] * c.v[i])), 0)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(_table(spark, sf_dir, "conversations"), damage=True)


# Edits of one row: (state before, role initial or * for any, inserts and edit, cost, state after).
_CRC_SQL = """xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(k) + 1), lambda i: ascii(k[i])::BIGINT)),
    lambda c, b: xor(c >> 8, list_reduce([xor(c, b) & 255, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))), 4294967295)"""
OP12_SQL = rf"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
h AS (SELECT *, {_CRC_SQL} % 20 AS h FROM k),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM h, unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i, rtrim(text, E' \t\n\x0b\x0c\r') AS r FROM d),
f AS (SELECT *, CASE WHEN r = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN r[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
  lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair FROM o),
ins(s, e, c, n, t) AS (SELECT s, '', 0, s, '' FROM unnest([0, 1, 2, 3]) u(s)
  UNION ALL SELECT s, e || 'I', c + 5, CASE WHEN n = 2 THEN 3 ELSE 2 END, t || CASE WHEN n = 2 THEN 'assistant:' ELSE 'user:' END || chr(10) FROM ins WHERE length(e) < 3),
moves AS (SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)) m(n, initial, n2)),
walk AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS s, 0 AS cost, '' AS audit, '' AS lines FROM d
  UNION ALL
  SELECT conv_id, i, s, cost, audit, lines FROM (
    SELECT f.conv_id, f.i, e.n2 AS s, w.cost + ins.c + e.c AS cost, w.audit || ins.e || e.e AS audit, w.lines || ins.t || e.line AS lines
    FROM walk w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1 JOIN ins ON ins.s = w.s,
    LATERAL (SELECT 'D' AS e, 2 AS c, ins.n AS n2, '' AS line
      UNION ALL SELECT 'K', CASE f.fault WHEN 'truncated' THEN 5 ELSE 0 END, m.n2, f.role || ':' || f.text || chr(10) FROM moves m WHERE m.n = ins.n AND m.initial = f.role[1] AND f.fault IN ('none', 'truncated')
      UNION ALL SELECT 'R', CASE f.fault WHEN 'truncated' THEN 6 ELSE 1 END, CASE ins.n WHEN 2 THEN 3 ELSE 2 END, CASE ins.n WHEN 2 THEN 'assistant:' ELSE 'user:' END || f.text || chr(10) WHERE f.fault IN ('none', 'truncated')) e
  ) QUALIFY row_number() OVER (PARTITION BY conv_id, i, s ORDER BY cost, audit) = 1),
ends AS (SELECT w.conv_id, w.cost + ins.c AS cost, w.audit || ins.e AS audit, w.lines || ins.t AS lines
  FROM walk w JOIN (SELECT conv_id, max(i) AS n FROM f GROUP BY conv_id) z ON z.conv_id IS NOT DISTINCT FROM w.conv_id AND z.n = w.i JOIN ins ON ins.s = w.s WHERE ins.n IN (0, 3)),
best AS (SELECT * FROM ends QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
all_ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(lines[:-2], '')) AS repaired_sha256
FROM all_ids a LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM a.conv_id
"""


def op13_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = cost_packing.pack(_table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {f.__name__: f for f in (op11_hard_negatives, op12_conversation_repair, op13_balanced_packing)}
ORACLE = {"op11_hard_negatives": OP11_SQL, "op12_conversation_repair": OP12_SQL}
