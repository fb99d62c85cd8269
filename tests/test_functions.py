import math

import pytest
from pyspark.sql import functions as F

from chronoframe.functions.hashing import murmur3_ids, next_pow2, with_hash_bucket, with_murmur3
from chronoframe.functions.labels import score_to_label, with_engagement_targets
from chronoframe.functions.timecols import time_slice


def labels(spark, rows):
    df = spark.createDataFrame(rows, "duration_ms long, play_time_ms long")
    return [(r.is_skip, r.dwell_log) for r in with_engagement_targets(df).collect()]


def test_is_skip_cases(spark):
    got = [s for s, _ in labels(spark, [(10000, 1000), (200000, 40000), (3000, 3000), (20000, 18000)])]
    assert got == [1.0, 0.0, 0.0, 0.0]


def test_is_skip_edges(spark):
    got = [s for s, _ in labels(spark, [(10000, 5000), (12500, 5000), (12500, 4999)])]
    assert got == [0.0, 0.0, 1.0]


def test_replay_loop_capped(spark):
    ((s, d),) = labels(spark, [(2000, 10000)])
    assert s == 0.0 and abs(d - math.log(4001)) < 1e-12


def test_invalid_duration_abstains_and_null_play(spark):
    assert labels(spark, [(0, 1000), (-5, 0)]) == [(None, None), (None, None)]
    assert labels(spark, [(1000, None)]) == [(0.0, None)]


def test_threshold(spark):
    df = spark.createDataFrame([(x,) for x in [0.0, 0.49, 0.5, 0.51, 1.0]], "s double")
    assert [r[0] for r in df.select(score_to_label("s")).collect()] == [0, 0, 1, 1, 1]


def test_next_pow2():
    assert [next_pow2(n) for n in [1, 2, 3, 4, 5, 7, 8, 9, 1000]] == [1, 2, 4, 4, 8, 8, 8, 16, 1024]


def test_murmur3_known_vectors_and_engines(spark):
    import numpy as np

    # reference values of MurmurHash3_x86_32(seed 0) for decimal id strings
    ids = [0, 1, 10, 123, -5, 99999999, 9223372036854775807, -9223372036854775808]
    arrow = {r.i: r.h for r in with_murmur3(spark.createDataFrame([(i,) for i in ids], "i long"), "i", "h").collect()}
    expr = {r.i: r.h for r in with_murmur3(spark.createDataFrame([(i,) for i in ids], "i long"), "i", "h", engine="expr").collect()}
    assert arrow == expr
    assert list(murmur3_ids(np.array(ids))) == [arrow[i] for i in ids]


def test_buckets_range_and_missing(spark):
    df = spark.range(2000).withColumnRenamed("id", "v").union(spark.createDataFrame([(None,)], "v long"))
    out = with_hash_bucket(df, "v", 8)
    vals = [r.v_bucket for r in out.filter(F.col("v").isNotNull()).collect()]
    assert min(vals) >= 1 and max(vals) <= 7
    assert out.filter(F.col("v").isNull()).first().v_bucket == 0
    with pytest.raises(ValueError):
        with_hash_bucket(df, "v", 1)
    with pytest.raises(TypeError):
        with_hash_bucket(df.withColumn("v", F.col("v").cast("double")), "v", 8)


def test_half_open_slice(spark):
    df = spark.createDataFrame(
        [("2024-04-21 12:00:00",), ("2024-04-22 00:00:00",), ("2024-04-23 12:00:00",), ("2024-04-24 00:00:00",)], "t string"
    ).select(F.col("t").cast("timestamp_ntz").alias("ts"))
    got = time_slice(df, "ts", "2024-04-22 00:00:00", "2024-04-24 00:00:00").count()
    assert got == 2
