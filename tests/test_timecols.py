import datetime as dt

import pytest
from pyspark.sql import functions as F

from chronoframe.functions.timecols import (
    epoch_micros,
    from_epoch_millis,
    hour_floor,
    ntz_from_micros,
    require_rows,
    split_at,
    time_slice,
    zone_bound,
)
from chronoframe.operators.joins import check_row_count


def ntz_frame(spark, times):
    return spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id long, ts timestamp_ntz")


def test_half_open_slice_and_split(spark):
    """[start, end) with optional bounds; the two halves partition the frame."""
    d = [dt.datetime(2024, 4, day) for day in (19, 20, 21, 22)]
    df = ntz_frame(spark, d)
    ids = lambda f: sorted(r.id for r in f.collect())
    assert ids(time_slice(df, "ts", "2024-04-20 00:00:00", "2024-04-22 00:00:00")) == [1, 2]
    assert ids(time_slice(df, "ts", start="2024-04-21 00:00:00")) == [2, 3]
    assert ids(time_slice(df, "ts", end="2024-04-20 00:00:00")) == [0]
    before, after = split_at(df, "2024-04-21 00:00:00")
    assert ids(before) == [0, 1] and ids(after) == [2, 3]


def test_slice_filter_reaches_the_scan(spark, tmp_path):
    """The bounds are plain comparisons, so parquet gets them as pushed filters."""
    path = str(tmp_path / "t")
    ntz_frame(spark, [dt.datetime(2024, 4, 20)]).write.parquet(path)
    plan = time_slice(spark.read.parquet(path), "ts", "2024-04-20 00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_require_rows(spark):
    """An empty frame fails with a clear message."""
    df = ntz_frame(spark, [dt.datetime(2024, 4, 20)])
    assert require_rows(df) is df
    with pytest.raises(ValueError, match="No data to process: arm is empty"):
        require_rows(df.filter("id < 0"), "arm")


def test_hour_floor_and_epoch_round_trip(spark):
    """Epoch conversions are zone-independent; hours truncate."""
    df = ntz_frame(spark, [dt.datetime(2024, 4, 20, 13, 45, 7, 123456)])
    row = df.select(
        hour_floor("ts").alias("h"),
        epoch_micros(df, "ts").alias("us"),
        ntz_from_micros(epoch_micros(df, "ts")).alias("back"),
    ).first()
    assert row.h == dt.datetime(2024, 4, 20, 13, 0)
    assert row.us == int(dt.datetime(2024, 4, 20, 13, 45, 7, 123456, tzinfo=dt.timezone.utc).timestamp() * 1_000_000)
    assert row.back == dt.datetime(2024, 4, 20, 13, 45, 7, 123456)
    ms = spark.createDataFrame([(1713620707123,)], "ms long").select(F.unix_micros(from_epoch_millis("ms")).alias("us")).first()
    assert ms.us == 1713620707123000


def test_zone_bound(spark):
    """H8: a wall-clock date in a zone becomes the matching UTC bound."""
    got = spark.range(1).select(zone_bound("2024-04-22 00:00:00", "Asia/Shanghai").alias("b")).first().b
    assert got == dt.datetime(2024, 4, 21, 16, 0)


def test_check_row_count(spark):
    """A join that changes the row count fails."""
    a = spark.createDataFrame([(1,), (2,)], "k long")
    dup = spark.createDataFrame([(1, 1), (1, 2)], "k long, v long")
    check_row_count(a, a.join(dup.dropDuplicates(["k"]), "k", "left"))
    with pytest.raises(AssertionError, match="2 rows before, 3 after"):
        check_row_count(a, a.join(dup, "k", "left"))
