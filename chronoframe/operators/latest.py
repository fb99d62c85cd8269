"""Latest-value tables.

A latest table holds one row per key: the values of the newest event. The
reduction is ``max(struct(ts, rank, values))`` per key, an aggregate Spark
combines map-side, so a key that holds a third of all rows is reduced in
every task before the shuffle and ties resolve the same way on every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import time_slice


def keep_latest(df: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str], *, rank: str | None = None) -> DataFrame:
    """Newest row per key by ``ts``; ties go to the larger ``rank`` then the larger values."""
    keys, cols = list(keys), [c for c in cols if c not in keys and c != ts]
    parts = [F.col(ts).alias("__ts")]
    if rank:
        parts.append(F.col(rank).alias("__rank"))
    parts.append(F.struct(*[F.col(c) for c in cols]).alias("__v"))
    best = df.groupBy(*keys).agg(F.max(F.struct(*parts)).alias("__m"))
    return best.select(*keys, F.col("__m.__ts").alias(ts), *[F.col(f"__m.__v.{c}").alias(c) for c in cols])


def merge_latest(current: DataFrame, updates: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """D3: fold updates into a latest table; an older event never replaces a
    newer one, and on equal time the stored row is kept."""
    cols = [c for c in current.columns if c not in keys and c != ts]
    cur = current.select(*keys, ts, *cols).withColumn("__rank", F.lit(1))
    upd = keep_latest(updates, keys, ts, cols).select(*keys, ts, *cols).withColumn("__rank", F.lit(0))
    return keep_latest(cur.unionByName(upd), keys, ts, cols, rank="__rank")


def materialize(source: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str], start=None, end=None) -> DataFrame:
    """A10: latest table of one view from its source over ``[start, end)``."""
    return keep_latest(time_slice(source, ts, start, end), keys, ts, cols)


def online_lookup(requests: DataFrame, latest: dict, served: Sequence[str], fill: float | None = 0.0) -> DataFrame:
    """C6 + B5 + B6: left-join request rows to each view's latest table, pick the
    served columns by name in contract order and fill misses with 0.0.

    ``latest`` maps a tuple of key columns to that view's latest table.
    """
    out = requests
    for keys, table in latest.items():
        wanted = [c for c in table.columns if c in served]
        out = out.join(table.select(*keys, *wanted), on=list(keys), how="left")
    base = [c for c in requests.columns]
    vec = [F.col(c).cast("double").alias(c) for c in served]
    out = out.select(*base, *vec)
    return out.fillna(fill, subset=list(served)) if fill is not None else out
