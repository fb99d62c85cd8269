import random

from chronoframe.operators import skew
from chronoframe.operators.joins import asof_join
from chronoframe.operators.windows import auto_strategies, cumulative_sum, rolling_mean, split_views


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _log(spark, n=120):
    r = random.Random(1)
    rows = [(i, r.choice([None, 1, 2, 3]), r.choice([None, *range(0, 4000, 50)]), r.choice([None, 0, 1])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, k long, ts_us long, c int")


def test_direct_means_of_whole_numbers_have_no_sliding_frame(spark):
    """a sliding frame reads its whole window again for every row."""
    df = _log(spark)
    direct = rolling_mean(df, ["k"], ["c"], 500, names=["r"], strategy="direct")
    assert "RangeFrame, -" not in _plan(direct)
    sliced = rolling_mean(df, ["k"], ["c"], 500, names=["r"])
    assert sorted(map(str, direct.collect())) == sorted(map(str, sliced.collect()))


def test_views_whose_keys_fit_a_task_are_not_copied_by_slice(spark, monkeypatch):
    """one shuffle and no copies of rows."""
    df = _log(spark)
    assert auto_strategies(df, [("k",), ("k", "id")], 500) == ["prefix", "prefix"]
    monkeypatch.setattr(skew, "TARGET_ROWS", 15)
    assert auto_strategies(df, [("k",), ("k", "id")], 500) == ["sliced", "prefix"]
    monkeypatch.setattr(skew, "TARGET_ROWS", 1)
    assert auto_strategies(df, [("k",), ("k", "id")], 500) == ["split", "prefix"]


def test_asof_of_keys_that_fit_a_task_takes_one_shuffle(spark, monkeypatch):
    """the same rows as by slices, without their carry joined on."""
    left = _log(spark)
    right = _log(spark, 60).selectExpr("k", "ts_us", "id as v")
    whole = asof_join(left, right, ["k"], ["v"])
    assert _plan(whole).count("Window") == 1 and "Join" not in _plan(whole)
    monkeypatch.setattr(skew, "TARGET_ROWS", 5)
    sliced = asof_join(left, right, ["k"], ["v"], slice_us=500)
    assert "Join" in _plan(sliced)
    assert sorted(map(str, whole.collect())) == sorted(map(str, sliced.collect()))


def test_split_of_keys_that_fit_a_task_carries_nothing(spark, monkeypatch):
    """one reduction, one prefix window and the join back; the rows are read
    once for both ends of a window. Keys that do not fit are cut, with the same values."""
    df = _log(spark)
    for fn, kw in [(rolling_mean, {"window_us": 500}), (cumulative_sum, {})]:
        want = sorted(map(str, fn(df, ["k"], ["c"], names=["r"], strategy="direct", **kw).collect()))
        monkeypatch.setattr(skew, "TARGET_ROWS", 2_000_000)
        whole = fn(df, ["k"], ["c"], names=["r"], strategy="split", **kw)
        assert (_plan(whole).count("Join"), _plan(whole).count("Window ["), _plan(whole).count("Union")) == (1, 1, 0)
        assert "BroadcastHashJoin" not in whole._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, whole.select("id", "k", "ts_us", "c", "r").collect())) == want
        monkeypatch.setattr(skew, "TARGET_ROWS", 5)
        cut = fn(df, ["k"], ["c"], names=["r"], strategy="split", **kw)
        assert _plan(cut).count("Join") > 1
        assert sorted(map(str, cut.select("id", "k", "ts_us", "c", "r").collect())) == want


def test_split_views_cut_the_same_values(spark, monkeypatch):
    df = _log(spark, 300)
    views = [(["k"], [("c", "a")], []), (["k", "c"], [("c", "b")], [("c", "n")])]

    def rows(target):
        monkeypatch.setattr(skew, "TARGET_ROWS", target)
        return sorted(map(str, split_views(df, views, 500).select("id", "a", "b", "n").collect()))

    assert rows(2_000_000) == rows(40) == rows(3)
