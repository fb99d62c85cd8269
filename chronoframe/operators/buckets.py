"""Bucket sizing from distinct counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import next_pow2, next_pow2_col


def bucket_sizes(df: DataFrame, cols: Sequence[str], headroom: int = 4, approx: bool = False) -> DataFrame:
    """One row per id column: distinct count and ``next_pow2(headroom * n)``.

    Exact distinct counts use Spark's two-phase distinct aggregation (one
    shuffle on the id, partial aggregation on both sides); ``approx=True``
    uses HyperLogLog++ sketches instead, which never shuffle the ids.
    """
    cnt = F.approx_count_distinct if approx else F.count_distinct
    row = df.agg(*[cnt(c).alias(c) for c in cols])
    stacked = row.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("id_column"), F.col(c).cast("long").alias("n_distinct")) for c in cols])).alias("s")
    ).select("s.*")
    return stacked.withColumn("n_buckets", next_pow2_col(F.col("n_distinct") * headroom))


def bucket_size_map(df: DataFrame, cols: Sequence[str], headroom: int = 4) -> dict[str, int]:
    """D1 on the driver: ``{column: n_buckets}`` (one aggregate row is collected)."""
    row = df.agg(*[F.count_distinct(c).alias(c) for c in cols]).first()
    return {c: max(2, next_pow2(headroom * int(row[c]))) for c in cols}
