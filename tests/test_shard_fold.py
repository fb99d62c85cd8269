import math
import random

import numpy as np
import pandas as pd
import pytest

from chronoframe.streaming import processor

SIG = ["s0", "s1"]


class Value:
    value = None
    get = lambda self: self.value
    update = lambda self, v: setattr(self, "value", v)


class Map(dict):
    calls = 0
    getValue = dict.__getitem__
    removeKey = dict.pop

    def updateValue(self, k, v):
        Map.calls += 1
        self[k] = v


class Handle:
    def __init__(self):
        self.timers = []

    registerTimer = lambda self, ms: self.timers.append(ms)
    getMapState = lambda self, *a: Map()
    getValueState = lambda self, *a: Value()


class At:
    def __init__(self, ms):
        self.getCurrentWatermarkInMs = lambda: ms


def _fold():
    fold = processor.ShardFold(["user_id", "name"], SIG, 1600_000, ["r0", "r1"], ["s0"], ["c0"])
    fold.init(Handle())
    return fold


def _frame(rows):
    """Rows (user, name, id, us, s0, s1) as the fold receives them."""
    bits = [(u is None) * 1 + (n is None) * 2 + (i is None) * 4 for u, n, i, *_ in rows]
    return pd.DataFrame(
        {
            "user_id": [u or 0 for u, *_ in rows], "name": [r[1] for r in rows], "nulls__": bits, "event_id": [r[2] or 0 for r in rows],
            "ts_us": [r[3] for r in rows], "s0": np.array([r[4] for r in rows], float), "s1": np.array([r[5] for r in rows], float),
        }
    )


def _check(out, seen, exact=True):
    for row in out.itertuples():
        user = None if row.nulls__ & 1 else row.user_id
        name = None if row.nulls__ & 2 else row.name
        past = [x for x in seen if x[:2] == (user, name) and x[3] < row.ts_us]
        window = [x for x in past if x[3] >= row.ts_us - 1600_000]
        for j, c in ((4, "r0"), (5, "r1")):
            known = [x[j] for x in window if x[j] is not None]
            got = getattr(row, c)
            assert got == pytest.approx(sum(known) / len(known), rel=1e-9) if known else math.isnan(got), (row, known)
        assert row.c0 == sum(int(x[4] or 0) for x in past)


@pytest.mark.parametrize("step,part", [(1 << 18, 1 << 16), (16, 8)])
def test_many_keys_to_a_shard_equal_brute_force(monkeypatch, step, part):
    monkeypatch.setattr(processor, "STEP_ROWS", step)
    monkeypatch.setattr(processor, "PART_ROWS", part)
    fold, r, seen, done = _fold(), random.Random(5), [], 0
    for wm in range(500, 20_000, 500):
        n = r.choice([0, 1, 5, 40])
        new = [
            (r.choice([None, 0, 1, 2**60 + 1, 2**60 + 2]), r.choice([None, "a"]), r.choice([None, len(seen) + i]), r.randint((wm - 499) * 1000, (wm + 300) * 1000), r.choice([0.0, 1.0, None]), r.choice([0.5, 1.0]))
            for i in range(n)
        ]
        new = [x for x in new if x[3] > (wm - 500) * 1000]
        assert not new or list(fold.handleInputRows((3,), iter([_frame(new[:20])] + ([_frame(new[20:])] if new[20:] else [])), At(wm - 500))) == []
        seen += new
        for out in fold.handleExpiredTimer((3,), At(wm), None):
            done += len(out)
            _check(out, seen)
        assert len(fold.tiles) == len(fold.sums) <= processor.TILES + 2
    done += sum(len(out) for out in fold.handleExpiredTimer((3,), At(10**9), None))
    assert done == len(seen) and not fold.buf


def test_values_of_one_key_do_not_reach_another():
    fold = _fold()
    rows = [(1, "a", 0, 1000, 1.0, 1e300), (1, "a", 1, 2000, 1.0, float("inf")), (2, "a", 2, 1000, 1.0, 0.1), (2, "a", 3, 2000, 0.0, 0.2), (2, "a", 4, 3000, 0.0, 0.0)]
    list(fold.handleInputRows((0,), iter([_frame(rows)]), At(0)))
    out = pd.concat(list(fold.handleExpiredTimer((0,), At(100), None))).set_index("event_id")
    assert out.r1[3] == pytest.approx(0.1) and out.r1[4] == pytest.approx(0.15)


def test_state_calls_do_not_follow_the_keys():
    fold = _fold()
    Map.calls = 0
    list(fold.handleInputRows((0,), iter([_frame([(u, "a", u, 1000 + u, 1.0, 1.0) for u in range(500)])]), At(0)))
    (out,) = fold.handleExpiredTimer((0,), At(100), None)
    assert len(out) == 500 and Map.calls <= 3


def test_a_large_shard_is_seeded_in_several_calls():
    fold = _fold()
    w = lambda us: {"user_id": 1, "name": "a", "nulls__": 0, "kind": "w", "us": us, "s0": 1.0, "s1": 1.0, "n0": 1, "n1": 1, "c0": None}
    c = {"user_id": 1, "name": "a", "nulls__": 0, "kind": "c", "us": None, "s0": None, "s1": None, "n0": None, "n1": None, "c0": 2}
    for rows in ([w(1000), c], [w(2000)]):
        fold.handleInitialState((0,), pd.DataFrame(rows), At(0))
    list(fold.handleInputRows((0,), iter([_frame([(1, "a", 9, 3000, 0.0, 4.0), (1, "a", 10, 4000, 0.0, 0.0)])]), At(0)))
    out = pd.concat(list(fold.handleExpiredTimer((0,), At(100), None))).set_index("event_id")
    assert (out.r1[9], out.r1[10], out.c0[9]) == (1.0, 2.0, 2)


def test_a_served_row_takes_groups_by_state_partition(spark, monkeypatch):
    """not 512 groups a view whatever the partitions, nor whole stores each micro-batch."""
    from chronoframe.plans import queries_stream as q
    from chronoframe.streaming import replay

    class Seen(Exception):
        pass

    def seen(events, registry, view, **given):
        raise Seen(given["shards"])

    monkeypatch.setattr(replay, "view_stream", seen)
    with pytest.raises(Seen, match=f"^{8 * int(spark.conf.get('spark.sql.shuffle.partitions'))}$"):
        q._stream_served(spark, "/root/testdata/sf0.001")
    set_before = replay.CHANGELOG in spark.conf.getAll and spark.conf.get(replay.CHANGELOG)
    try:
        spark.conf.unset(replay.CHANGELOG)
        replay.use_rocksdb(spark)
        assert spark.conf.get(replay.CHANGELOG) == "true"
        spark.conf.set(replay.CHANGELOG, "false")
        replay.use_rocksdb(spark)
        assert spark.conf.get(replay.CHANGELOG) == "false"  # what the session sets stays
    finally:
        spark.conf.set(replay.CHANGELOG, set_before or "true")
