"""One answer in every strategy: null keys, null times, non-integral signals, hot keys."""

import pytest

from chronoframe.operators import skew
from chronoframe.operators.windows import cumulative_sum, rolling_mean

ROWS = [(1, None, 10, 1), (2, None, 20, 0), (3, None, 30, 1), (4, None, 40, 1), (5, 7, 15, 1), (6, 7, None, 1), (7, 7, 25, 0)]


def _log(spark):
    return spark.createDataFrame(ROWS, "id long, k long, ts_us long, s int")


@pytest.mark.parametrize("target", [1, 1_000_000])
def test_null_keys_and_null_times(spark, monkeypatch, target):
    monkeypatch.setattr(skew, "TARGET_ROWS", target)
    for strategy in ("direct", "sliced", "split"):
        out = cumulative_sum(_log(spark), ["k"], ["s"], names=["c"], strategy=strategy, slice_us=12)
        got = {r["id"]: r["c"] for r in out.collect() if r["id"] != 6}
        assert got == {1: 0, 2: 1, 3: 1, 4: 2, 5: 0, 7: 1}, strategy
    for strategy in ("direct", "sliced", "split"):
        out = rolling_mean(_log(spark), ["k"], ["s"], 100, names=["m"], strategy=strategy)
        got = {r["id"]: r["m"] for r in out.collect()}
        assert got[5] is None and got[6] is None and got[7] == 1.0 and got[4] == pytest.approx(2 / 3), strategy


def test_running_sum_rejects_fractions(spark):
    log = spark.createDataFrame([(1, 10, 0.9), (1, 20, 0.9)], "k long, ts_us long, s double")
    with pytest.raises(ValueError, match="integral"):
        cumulative_sum(log, ["k"], ["s"])
