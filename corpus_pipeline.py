"""The training-data pipeline over ``documents``: language ID, near duplicates,
benchmark decontamination, secret scan, sampled tokenisation.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet
and read again as the next one's docs. All but the last return the columns of docs.
A row is named by its doc_id and ``xxhash64(text)``, so null and repeated ids work.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoframe.llm import _spark as S
from chronoframe.llm import decontam, gumbel, jaccard, langid, secret_scan

#: A text of MIN_GRAMS n-grams or more with a smaller share of any known language's is rejected.
MIN_SHARE, MIN_GRAMS = 0.1, 20
SECRET_MARK = "[SECRET]"
SAMPLES = 2
MODEL = os.path.join(os.environ.get("TOKENIZER_DIR", "/opt/tokenizers"), "piece_bpe_32k.model")
#: The stages train a model, contract a graph and sample: SQL cannot express them.
ORACLE_SQL = None

_SAME = "d.doc_id <=> k.doc_id AND d.th = k.th"


def _named(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``th`` of every row, and the row as it is in one column, so that no
    column of docs can clash with what a stage adds."""
    return docs.select(F.col("doc_id"), F.xxhash64("text").alias("th"), F.struct("*").alias("row"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter and texts in none of the languages of ``lang``."""
    model = langid.train(docs)
    judged = langid.predict(docs.select(F.struct("*").alias("row"), F.col("text")), model)
    foreign = (F.col("n_grams") >= MIN_GRAMS) & (F.col("score") < MIN_SHARE)
    return judged.where((F.col("lang_pred") != langid.UNKNOWN) & ~foreign).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked documents keep the one of smallest doc_id (then text
    hash); texts without a word are linked with nothing and stay."""
    groups = jaccard.near_duplicates(docs)
    first = groups.where("group_id IS NOT NULL").groupBy("group_id").agg(F.min(F.struct("doc_id", "th")).alias("k"))
    first = first.select("k.doc_id", "k.th")
    worded = F.coalesce(F.btrim("text", F.lit(decontam.SPACES)), F.lit("")) != ""
    kept = _named(docs.where(worded)).alias("d").join(first.alias("k"), F.expr(_SAME), "left_semi")
    return kept.dropDuplicates(["doc_id", "th"]).select("row.*").unionByName(docs.where(~worded))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold three quarters or more of a benchmark item."""
    leaks = decontam.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaky = leaks.select("doc_id", "th").distinct()
    return _named(docs).alias("d").join(leaky.alias("k"), F.expr(_SAME), "left_anti").select("row.*")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace owner-specific, live-looking credentials; widely copied examples stay."""
    found = secret_scan.scan_secrets(docs).withColumn("spans", F.filter("spans", lambda s: s["owned"]))
    live = found.where(F.size("spans") > 0).select("doc_id", "th", "spans").dropDuplicates(["doc_id", "th"])
    both = _named(docs).alias("d").join(live.alias("k"), F.expr(_SAME), "left")
    text = F.when(F.col("k.spans").isNull(), F.col("d.row.text")).otherwise(secret_scan.masked("d.row.text", "k.spans", SECRET_MARK))
    new = {"text": text} | ({"n_chars": F.when(F.col("k.spans").isNull(), F.col("d.row.n_chars")).otherwise(F.char_length(text)).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return both.select(*(new[c].alias(c) if c in new else F.col(f"d.row.`{c}`").alias(c) for c in docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every text, with their inclusion scores."""
    return gumbel.sample_encodings(docs, MODEL, k=SAMPLES)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secrets), ("encode", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    S.text_batches(spark)
    for name, stage in STAGES:
        docs, _ = S.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
