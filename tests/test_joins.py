import pytest
from pyspark.sql import functions as F

from chronoframe.operators.joins import LookupError_, asof_join, attach_lookup, first_unmatched, unmatched_keys


def test_lookup_join_preserves_rows_and_type(spark):
    df = spark.createDataFrame([(1,), (2,), (1,)], "video_id long")
    lk = spark.createDataFrame([(1, 10), (2, 20)], "video_id long, author_id long")
    out = attach_lookup(df, lk, "video_id", "author_id")
    assert sorted(r.author_id for r in out.collect()) == [10, 10, 20]
    assert dict(out.dtypes)["author_id"] == "bigint" and out.count() == 3


def test_lookup_miss_raises_with_first_ids(spark):
    df = spark.createDataFrame([(1,), (2,)], "video_id long")
    lk = spark.createDataFrame([(1, 10)], "video_id long, author_id long")
    with pytest.raises(LookupError_, match=r"1 distinct video_id; smallest of them: \[2\]"):
        attach_lookup(df, lk, "video_id", "author_id")
    assert [r.video_id for r in unmatched_keys(df, lk, "video_id").collect()] == [2]
    assert [r.video_id for r in first_unmatched(df, lk, "video_id").collect()] == [2]
    assert attach_lookup(df, lk, "video_id", "author_id", mode="quarantine").count() == 1


def test_lookup_duplicate_raises(spark):
    df = spark.createDataFrame([(1,)], "video_id long")
    lk = spark.createDataFrame([(1, 10), (1, 11)], "video_id long, author_id long")
    with pytest.raises(LookupError_, match="not unique"):
        attach_lookup(df, lk, "video_id", "author_id")


@pytest.mark.parametrize("strategy", ["direct", "sliced"])
def test_asof_le_lt_and_ttl(spark, strategy):
    left = spark.createDataFrame([(1, 10, 100), (2, 10, 200), (3, 10, 50), (4, 11, 100), (5, None, 100)], "id long, k long, ts_us long")
    right = spark.createDataFrame([(10, 100, 1.0), (10, 90, 2.0), (10, 100, 3.0)], "k long, ts_us long, v double")
    le = {r.id: r.v for r in asof_join(left, right, ["k"], ["v"], strategy=strategy, slice_us=40).collect()}
    assert le == {1: 3.0, 2: 3.0, 3: None, 4: None, 5: None}  # ties on (key, time): largest value wins
    lt = {r.id: r.v for r in asof_join(left, right, ["k"], ["v"], strict=True, strategy=strategy, slice_us=40).collect()}
    assert lt == {1: 2.0, 2: 3.0, 3: None, 4: None, 5: None}
    ttl = {r.id: r.v for r in asof_join(left, right, ["k"], ["v"], ttl_us=50, strategy=strategy, slice_us=40).collect()}
    assert ttl == {1: 3.0, 2: None, 3: None, 4: None, 5: None}


def test_asof_sliced_equals_direct_random(spark):
    import random

    rng = random.Random(3)
    left = spark.createDataFrame([(i, rng.randint(0, 3), rng.randint(0, 1000)) for i in range(400)], "id long, k long, ts_us long")
    right = spark.createDataFrame([(rng.randint(0, 3), rng.randint(0, 1000), float(i)) for i in range(200)], "k long, ts_us long, v double")
    a = asof_join(left, right, ["k"], ["v"], strategy="direct", ttl_us=300).select("id", "v")
    b = asof_join(left, right, ["k"], ["v"], strategy="sliced", slice_us=37, ttl_us=300).select("id", F.col("v").alias("w"))
    rows = a.join(b, "id").collect()
    assert len(rows) == 400 and all(r.v == r.w for r in rows)


def test_asof_sliced_hot_key_equals_direct(spark, monkeypatch):
    """Key 0 holds most rows and gets narrower slices than ``slice_us``."""
    import random

    from chronoframe.operators import skew

    monkeypatch.setattr(skew, "TARGET_ROWS", 30)
    rng = random.Random(5)
    left = spark.createDataFrame(
        [(i, 0 if i < 300 else rng.randint(1, 3), rng.randint(0, 1000)) for i in range(400)], "id long, k long, ts_us long"
    )
    right = spark.createDataFrame(
        [(0 if i < 150 else rng.randint(1, 3), rng.randint(0, 1000), float(i)) for i in range(200)], "k long, ts_us long, v double"
    )
    levels = skew.hot_slices(right.withColumn("__key", F.struct("k")), "__key", "ts_us", 500)
    assert levels and levels[0].filter("size(__bounds) > 1").count()
    a = asof_join(left, right, ["k"], ["v"], strategy="direct").select("id", "v")
    b = asof_join(left, right, ["k"], ["v"], strategy="sliced", slice_us=500).select("id", F.col("v").alias("w"))
    rows = a.join(b, "id").collect()
    assert len(rows) == 400 and all(r.v == r.w for r in rows)


def test_null_lookup_value_is_a_miss(spark):
    log = spark.createDataFrame([(1,), (2,)], "video_id long")
    lk = spark.createDataFrame([(1, 10), (2, None)], "video_id long, author_id long")
    with pytest.raises(LookupError_, match=r"smallest of them: \[2\]"):
        attach_lookup(log, lk, "video_id", "author_id")
    kept = attach_lookup(log, lk, "video_id", "author_id", mode="quarantine")
    assert [tuple(r) for r in kept.collect()] == [(1, 10)]
