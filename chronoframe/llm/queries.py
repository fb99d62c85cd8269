"""Registered queries of the text operators, with DuckDB SQL where it can express them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import decontam, gumbel, html_blocks, jaccard, kneser_ney, langid, maxscore, packing, queries_late, secret_scan, warc

#: Folder of the public vocabulary files, the same on every executor.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(col: str = "doc_id"):
    """The held-out fold: remainder 1. A null id is in the training folds."""
    return F.coalesce(F.crc32(F.col(col).cast("string")) % 3, F.lit(0)) == 1


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", _fold().alias("held_out"))
    model = langid.train(docs.where(~F.col("held_out")))
    return langid.predict(docs.drop("lang"), model)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(_table(spark, sf_dir, "documents"))
    named = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    count = lambda test: F.size(F.filter("spans", test)).cast("bigint")
    of_kind = lambda kind: count(lambda s: s["kind"] == kind).alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE))
    return found.select(
        "doc_id",
        *map(of_kind, secret_scan.BASE),
        F.sha2(F.array_join(F.transform(base, named), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", named), ",").alias("spans"),
        count(lambda s: s["owned"]).alias("n_owned"),
        count(lambda s: ~s["owned"]).alias("n_copied"),
    )


def _spans_sql(kind: str, order: int, pattern: str, keep: str, value: str = "m[i]") -> str:
    return f"""SELECT row, {order} AS k, '{kind}' AS kind, {value} AS value,
          (list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s, length(m[i]) AS n
        FROM (SELECT row, regexp_extract_all(text, '{pattern}') AS m, string_split_regex(text, '{pattern}') AS p FROM d), unnest(range(1, len(m) + 1)) AS u(i)
        WHERE {keep}"""


_ASSIGN_SQL = secret_scan.ASSIGN.replace("'", "''")
OP2_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text FROM documents),
base AS (
  {_spans_sql("assign", 0, _ASSIGN_SQL, f"length(regexp_extract(m[i], '{_ASSIGN_SQL}', 2)) >= 12", f"regexp_extract(m[i], '{_ASSIGN_SQL}', 2)")}
  UNION ALL {_spans_sql("access", 1, secret_scan.ACCESS, "length(m[i]) >= 18")}
  UNION ALL {_spans_sql("hex", 2, secret_scan.HEX, "length(m[i]) >= 16")}),
mixed AS ({_spans_sql("mixed", 3, "[A-Za-z0-9+/_=-]+", "length(m[i]) >= 20 AND regexp_matches(m[i], '[0-9]') AND regexp_matches(m[i], '[a-z]') AND regexp_matches(m[i], '[A-Z]')")}),
spans AS (SELECT * FROM base UNION ALL SELECT * FROM mixed x WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.row = x.row AND b.s < x.s + x.n AND x.s < b.s + b.n)),
held AS (SELECT value, count(DISTINCT coalesce(source, '')) AS owners FROM spans JOIN d USING (row) GROUP BY value),
judged AS (SELECT s.*, h.owners < 3 AS owned FROM spans s JOIN held h USING (value)),
kept AS (SELECT *, kind || ':' || s || ':' || (s + n) AS name FROM judged WHERE kind <> 'mixed' OR owned),
per AS (SELECT row, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS c, count(*) FILTER (kind = 'hex') AS h,
  string_agg(name, ',' ORDER BY s, k) FILTER (kind <> 'mixed') AS base, string_agg(name, ',' ORDER BY s, k) AS spans, count(*) FILTER (owned) AS o, count(*) FILTER (NOT owned) AS w FROM kept GROUP BY row)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(o, 0) AS n_owned, coalesce(w, 0) AS n_copied
FROM d LEFT JOIN per USING (row)
"""


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", _fold().alias("held_out"))
    labels = _table(spark, sf_dir, "labels").where(~_fold())
    model = kneser_ney.train(docs, labels)
    return kneser_ney.scores(docs, model).select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.as_responses(_table(spark, sf_dir, "pages"))).withColumnRenamed("key", "page_id")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


_WORDS_SQL = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_SHINGLES_SQL = "list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)"
_LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS_SQL.format(text=_LOWER_SQL)} AS w FROM documents),
sets AS (SELECT doc_id, {_SHINGLES_SQL} AS s FROM w),
each AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM each a JOIN each b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS d, doc_id AS r FROM sets UNION SELECT reach.d, links.b FROM reach JOIN links ON links.a = reach.r)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.r) AS component_id FROM sets s JOIN reach r ON r.d = s.doc_id GROUP BY s.doc_id, len(s.s)
"""


def op6_sampled_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = gumbel.sample_encodings(_table(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model", k=2)
    return got.select("doc_id", "sample", F.size("ids").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"), "log_prob", "perturbed", "inclusion")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    got = html_blocks.extract(pages.select("page_id", "url", "html"), html_blocks.train(pages))
    return got.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(_table(spark, sf_dir, "embeddings"))


OP8_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontam.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return leaks.groupBy("doc_id", "item_id").agg(F.max("n_item").cast("bigint").alias("n_item"), F.max("n_common").cast("bigint").alias("n_common"))


OP9_SQL = f"""
WITH d AS (SELECT doc_id, {_SHINGLES_SQL} AS s FROM (SELECT doc_id, {_WORDS_SQL.format(text="lower(coalesce(text, ''))")} AS w FROM documents)),
b AS (SELECT item_id, {_SHINGLES_SQL} AS s FROM (SELECT item_id, {_WORDS_SQL.format(text="lower(coalesce(text, ''))")} AS w FROM benchmark)),
dg AS (SELECT doc_id, unnest(s) AS g FROM d), bg AS (SELECT item_id, len(s) AS n, unnest(s) AS g FROM b)
SELECT doc_id, item_id, n::BIGINT AS n_item, count(*) AS n_common FROM dg JOIN bg USING (g) GROUP BY doc_id, item_id, n HAVING 100 * count(*) >= 75 * n
"""


def op10_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.tiktoken")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_language_id, op2_secret_scan, op3_toxicity, op4_warc_derivatives, op5_ngram_jaccard_join, op6_sampled_segmentation, op7_main_text, op8_exact_top_k, op9_decontamination, op10_packed_ids, pipeline)} | queries_late.QUERIES
ORACLE = {"op2_secret_scan": OP2_SQL, "op5_ngram_jaccard_join": OP5_SQL, "op8_exact_top_k": OP8_SQL, "op9_decontamination": OP9_SQL} | queries_late.ORACLE | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
