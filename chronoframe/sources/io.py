"""Writers and readers of feature sources, training tables and metrics."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import time_slice
from ..operators.sampling import neg_sample_exact


def write_source(df: DataFrame, path: str, ts: str = "ts", partition_by_date: bool = False) -> None:
    """A5: a feature source table.

    Rows are sorted by time inside each file, so parquet row-group min/max
    statistics skip whole groups for time-range reads. ``partition_by_date``
    additionally writes one folder per event date (folder pruning); use it
    when a day holds many row groups -- on a small or long, sparse log it
    produces many tiny files.
    """
    if partition_by_date:
        df = df.withColumn("dt_date", F.to_date(ts)).repartition("dt_date").sortWithinPartitions(ts)
        df.write.mode("overwrite").partitionBy("dt_date").parquet(path)
    else:
        df.sortWithinPartitions(ts).write.mode("overwrite").parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    """A training table (overwrite is idempotent on retry)."""
    df.write.mode("overwrite").parquet(path)


def read_training(
    spark: SparkSession,
    path: str,
    *,
    features: Sequence[str],
    categorical: Sequence[str] = (),
    targets: Sequence[str] = (),
    signals: Sequence[str] = (),
    id_cols: Sequence[str] = ("event_id",),
    neg_keep_frac: float = 1.0,
    start=None,
    end=None,
    ts: str = "ts",
) -> DataFrame:
    """A7 + B6 + J6: half-open time range (pushed to the scan), features
    zero-filled, labels left NULL, optional exact negative sampling."""
    df = time_slice(spark.read.parquet(path), ts, start, end)
    cols = list(dict.fromkeys([*id_cols, ts, *features, *categorical, *targets, *signals]))
    df = df.select(*cols).fillna(0.0, subset=list(features))
    if neg_keep_frac < 1.0:
        df = neg_sample_exact(df, signals, id_cols, neg_keep_frac)
    return df


def write_metrics(spark: SparkSession, metrics: DataFrame, path: str, metadata: dict | None = None) -> None:
    """Metrics as JSON lines, plus run metadata as a one-row JSON file."""
    metrics.coalesce(1).write.mode("overwrite").json(f"{path}/metrics")
    if metadata is not None:
        spark.createDataFrame([(json.dumps(metadata, default=str),)], "metadata string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")
