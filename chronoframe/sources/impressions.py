"""Impression logs in files: named splits, an explicit schema, and what does not fit it
set aside (A1, A2, A4, B1).

A CSV log is read with its schema given, never inferred: a file whose ids look like
floats cannot turn them into floats. A line that does not parse, lacks a key or the time,
or has a signal other than 0 or 1 is kept whole, with the reason, for a quarantine table.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import from_epoch_millis
from ..registry import IMPRESSION_SIGNALS

CORRUPT, REASON = "__line", "reason"
KEYS = ("user_id", "video_id", "time_ms")


def log_schema(signals: Sequence[str] = IMPRESSION_SIGNALS, engagement: Sequence[str] = ("play_time_ms", "duration_ms")) -> T.StructType:
    """A1: keys and times as longs, signals as ints; every column may be null in a file."""
    kinds = [(c, T.LongType()) for c in KEYS] + [(s, T.IntegerType()) for s in signals] + [(c, T.LongType()) for c in engagement]
    return T.StructType([T.StructField(n, t, True) for n, t in kinds])


@dataclass(frozen=True)
class Splits:
    """A4: named splits of one log. ``root`` is joined to relative paths; left out, it
    is the environment variable ``root_env`` names."""

    files: dict[str, str | Sequence[str]]
    root: str | None = None
    root_env: str = "DATA_DIR"
    formats: dict[str, str] = field(default_factory=dict)

    def paths(self, split: str) -> list[str]:
        if split not in self.files:
            raise KeyError(f"no split {split!r}; there are {sorted(self.files)}")
        given = self.files[split]
        root = self.root if self.root is not None else os.environ.get(self.root_env, "")
        whole = lambda p: p if "://" in p or p.startswith("/") or not root else f"{root.rstrip('/')}/{p}"
        return [whole(p) for p in ([given] if isinstance(given, str) else given)]

    def format(self, split: str) -> str:
        return self.formats.get(split) or ("csv" if self.paths(split)[0].rstrip("/").endswith((".csv", ".csv.gz")) else "parquet")


def _faults(schema: T.StructType, signals: Sequence[str]) -> Column:
    """Why a row cannot be used, or null."""
    reason = F.when(F.col(CORRUPT).isNotNull(), "unparsed")
    for k in KEYS:
        reason = reason.when(F.col(k).isNull(), f"no {k}")
    for s in (s for s in signals if s in schema.names):
        reason = reason.when(~F.col(s).isin(0, 1), f"{s} is not 0 or 1")
    return reason


def read_log(spark: SparkSession, splits: Splits, split: str, schema: T.StructType | None = None, signals: Sequence[str] = IMPRESSION_SIGNALS) -> DataFrame:
    """A1: one split with ``schema`` plus ``reason`` (null for usable rows) and the raw
    line of rows that did not parse. Nulls in signals stay."""
    schema = schema or log_schema(signals)
    held = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    if splits.format(split) == "csv":
        raw = spark.read.schema(held).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(splits.paths(split))
    else:
        raw = spark.read.schema(schema).parquet(*splits.paths(split)).withColumn(CORRUPT, F.lit(None).cast("string"))
    return raw.withColumn(REASON, _faults(schema, signals))


def usable(log: DataFrame) -> DataFrame:
    """A2 + B1: the rows without a fault, with ``dt`` (an instant) and ``ts_us``."""
    good = log.filter(F.col(REASON).isNull()).drop(REASON, CORRUPT)
    return good.withColumn("dt", from_epoch_millis("time_ms")).withColumn("ts_us", F.col("time_ms") * 1000)


def quarantined(log: DataFrame) -> DataFrame:
    """The rows with a fault, their reason and, if they did not parse, their line."""
    return log.filter(F.col(REASON).isNotNull())


def write_log(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    """A log as CSV with a header, columns in the order of the schema."""
    df.select(*(schema or log_schema()).names).write.mode("errorifexists").option("header", True).csv(path)
