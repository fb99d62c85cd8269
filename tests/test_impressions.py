import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoframe.operators.joins import LookupError_, attach_observed
from chronoframe.operators.windows import cumulative_sum, rolling_mean, with_history
from chronoframe.registry import DAY_US, IMPRESSION_MODEL_CONTINUOUS, IMPRESSION_SIGNALS, IMPRESSIONS, USER_AUTHOR, VIDEO
from chronoframe.session import scratch_path
from chronoframe.sources.impressions import Splits, log_schema, quarantined, read_log, usable, write_log

HEAD = ",".join(log_schema().names)


def _csv(spark, tmp, lines, name="log.csv"):
    path = scratch_path(spark, f"{tmp.name}-{name}")
    spark.createDataFrame([(x,) for x in (HEAD, *lines)], "value string").coalesce(1).write.text(path)
    return path


def _line(user="1", video="2", time="1712534400000", signals="0,1,0,0,0,0,0,0", tail="100,200"):
    return ",".join([user, video, time, signals, tail])


def test_every_line_is_usable_or_kept_with_a_reason(spark, tmp_path):
    lines = [
        _line(),
        _line(signals="0,,0,0,0,0,0,0", tail=","),  # missing values are allowed
        _line(user="1.0"),  # an id that looks like a float does not become one
        _line(user=""),
        _line(video=""),
        _line(time=""),
        _line(signals="0,2,0,0,0,0,0,0"),
        "1,2,1712534400000",
        _line(tail="100,200,300"),
        _line(time="9" * 30),
    ]
    splits = Splits({"train": _csv(spark, tmp_path, lines)})
    log = read_log(spark, splits, "train").cache()
    assert log.count() == len(lines)
    good = usable(log).collect()
    assert [(r["user_id"], r["is_like"], r["play_time_ms"], r["ts_us"]) for r in good] == [(1, 1, 100, 1712534400000000), (1, None, None, 1712534400000000)]
    assert good[0]["dt"].year == 2024 and [f.dataType for f in usable(log).schema][:3] == [T.LongType()] * 3
    reasons = sorted(r["reason"] for r in quarantined(log).collect())
    assert reasons == ["is_like is not 0 or 1", "no time_ms", "no user_id", "no video_id", "unparsed", "unparsed", "unparsed", "unparsed"]
    assert quarantined(log).where("reason = 'unparsed'").where("__line IS NULL").count() == 0


def test_round_trip_of_named_splits(spark, tmp_path):
    root = scratch_path(spark, tmp_path.name)
    splits = Splits({"train": "a.csv", "test_random": ["b"]}, root=root, formats={"test_random": "parquet"})
    rows = spark.createDataFrame([(1, 2, 3, *[0] * 8, None, 4), (5, 6, 7, *[1] * 8, 8, -1)], log_schema())
    write_log(rows, splits.paths("train")[0])
    rows.write.parquet(splits.paths("test_random")[0])
    for name in splits.files:
        got = usable(read_log(spark, splits, name)).select(*rows.columns)
        assert got.schema == rows.schema and sorted(map(str, got.collect())) == sorted(map(str, rows.collect()))
    with pytest.raises(KeyError, match="no split"):
        splits.paths("valid")


def test_split_roots(monkeypatch):
    splits = Splits({"a": "x.csv", "b": "/abs/y.csv", "c": "s3a://z/w.parquet"})
    monkeypatch.setenv("DATA_DIR", "/data/")
    assert [splits.paths(s) for s in "abc"] == [["/data/x.csv"], ["/abs/y.csv"], ["s3a://z/w.parquet"]]
    assert [splits.format(s) for s in "abc"] == ["csv", "csv", "parquet"]


def test_a_lookup_observed_while_it_runs(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "k long")
    look = spark.createDataFrame([(1, 10), (2, None), (4, 40), (None, 5)], "k long, v long")
    got = attach_observed(df, look, "k", "v")
    assert sorted((r["k"] or 0, r["v"]) for r in got.matched.collect()) == [(1, 10), (1, 10)]
    again = attach_observed(df, look, "k", "v")
    assert sorted(r["k"] or 0 for r in again.quarantine.collect()) == [0, 2, 3]
    whole = attach_observed(df, look, "k", "v")
    whole.rows.write.format("noop").mode("overwrite").save()
    assert whole.report().misses == 3 and whole.report().n_rows == 5
    with pytest.raises(LookupError_, match="no v for 3 rows; smallest unknown k: \\[2\\]"):
        whole.check()
    twice = attach_observed(df, look.unionAll(spark.createDataFrame([(1, 11)], look.schema)), "k", "v")
    twice.rows.write.format("noop").mode("overwrite").save()
    with pytest.raises(LookupError_, match="5 rows before"):
        twice.check()
    fine = attach_observed(df.where("k = 1"), look, "k", "v")
    fine.rows.write.format("noop").mode("overwrite").save()
    fine.check()


def test_history_cut_to_the_window_keeps_running_counts(spark):
    rows = [(k, t * DAY_US, (t + (k or 0)) % 2) for k in (1, 2, None) for t in range(20)]
    log = spark.createDataFrame(rows, "k long, ts_us long, s int")
    history, arm = log.where(F.col("ts_us") < 15 * DAY_US), log.where(F.col("ts_us") >= 15 * DAY_US)
    both = lambda d: cumulative_sum(rolling_mean(d, ["k"], ["s"], 3 * DAY_US), ["k"], ["s"])
    want = sorted(map(str, both(log).where(F.col("ts_us") >= 15 * DAY_US).collect()))
    got = with_history(history, arm, both, lookback_us=3 * DAY_US, totals={"s_cumulative_k": ("s", ["k"])})
    assert sorted(map(str, got.collect())) == want


def test_registry_lookups(spark):
    assert IMPRESSIONS.view("video_features") == VIDEO and IMPRESSIONS.rolling_signals(VIDEO) == list(IMPRESSION_SIGNALS)
    refs = IMPRESSIONS.online_refs
    assert [name for _, name in refs] == list(IMPRESSION_MODEL_CONTINUOUS)
    assert refs[4] == ("user_author_features", "is_click_rolling_user_id_author_id") and refs[-1][0] == "video_features"
    schema = IMPRESSIONS.source_schema(USER_AUTHOR)
    assert schema.names[:3] == ["user_id", "author_id", "ts"] and len(schema) == 11
    IMPRESSIONS.check(spark.createDataFrame([], schema), USER_AUTHOR)
    with pytest.raises(KeyError, match="no view"):
        IMPRESSIONS.view("author_features")
