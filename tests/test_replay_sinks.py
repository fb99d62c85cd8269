import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from chronoframe.operators.metrics import ranking_metrics
from chronoframe.operators.windows import cumulative_sum, rolling_mean
from chronoframe.registry import DAY_US, HOUR_US, FeatureView, Registry
from chronoframe.streaming import processor
from chronoframe.streaming.replay import RESERVED_KEY, account, drain_marker, in_arrival_order, new_dir, on_time, replay_source, run, served_stream, unserved, view_stream
from chronoframe.streaming.sinks import EvalSink, HourReplay, LatestTableSink, Versions

SIG = ["s0", "s1"]
USER = FeatureView("u", ("user_id",), ttl_us=None)
PAIR = FeatureView("p", ("user_id", "item_id"), ttl_us=None)
REG = Registry(signals=tuple(SIG), views=(USER, PAIR), cumulative={"u": ("s0",)}, window_us=2 * DAY_US)
BASE_US = 1_712_534_400_000_000  # 2024-04-08 00:00 UTC
SCHEMA = "user_id long, item_id long, event_id long, ts_us long, s0 int, s1 int"
MARK = {"user_id": RESERVED_KEY, "item_id": RESERVED_KEY, "event_id": RESERVED_KEY, "ts_us": BASE_US + 10**15, "s0": 0, "s1": 0}


def _stream(spark, batches):
    path = new_dir(spark, "in")
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    schema = spark.createDataFrame([], SCHEMA).schema
    drain_marker(spark, schema, MARK, into=path)
    return replay_source(spark, path, schema, max_files_per_trigger=1)


def _rows(n, seed, users=3, step=HOUR_US):
    r = random.Random(seed)
    bit = lambda: r.choice([0, 1, 1, None])
    return [(r.randrange(users) if r.random() < 0.9 else None, r.randrange(3), i, BASE_US + (i // 2) * step + (i % 2 and r.choice([0, 1])), bit(), bit()) for i in range(n)]


def _same(got, want, names):
    assert set(got) == set(want)
    for k, w in want.items():
        for n in names:
            a, b = got[k][n], w[n]
            assert (a is None and b is None) or (a is not None and b is not None and abs(a - b) < 1e-12), (k, n, a, b)


def test_served_row_over_views_equals_batch(spark):
    rows = _rows(160, 1)
    out = new_dir(spark, "out")
    run(served_stream(_stream(spark, [rows[:60], rows[60:120], rows[120:]]), REG, watermark="0 seconds"), out=out)
    got = {r["event_id"]: r for r in on_time(spark.read.parquet(out)).where(F.col("event_id") != RESERVED_KEY).collect()}
    df = spark.createDataFrame(rows, SCHEMA)
    for v in REG.views:
        df = rolling_mean(df, v.keys, SIG, REG.window_us)
    df = cumulative_sum(df, ["user_id"], ["s0"])
    _same(got, {r["event_id"]: r for r in df.collect()}, REG.served)
    assert spark.read.parquet(out).columns == ["event_id", "ts_us", "user_id", "item_id", *REG.served, "late"]


def test_tiles_are_read_and_written_where_they_are_cut():
    """The fold over a plain state: only tiles that gain events are written."""

    class Value:
        value = None
        get = lambda self: self.value
        update = lambda self, v: setattr(self, "value", v)

    class Rows(list):
        get = lambda self: iter(list(self))
        put = lambda self, v: self.__setitem__(slice(None), v)
        appendList = list.extend

    class Tiles(dict):
        written: list = []
        getValue = dict.__getitem__
        removeKey = dict.pop

        def updateValue(self, k, v):
            self.written.append(k[0])
            self[k] = v

    class Handle:
        registerTimer = lambda self, ms: None
        getListState = lambda self, *a: Rows()
        getMapState = lambda self, *a: Tiles()
        getValueState = lambda self, *a: Value()

    fold = processor.WindowFold(["user_id"], SIG, 1600, ["r0", "r1"], ["s0"], ["c0"])
    fold.init(Handle())
    r, seen = random.Random(3), []
    for wm in range(500, 20_000, 500):
        new = [(r.randint(wm - 499, wm), len(seen) + i, r.choice([0.0, 1.0, None]), r.choice([0.0, 1.0])) for i in range(r.choice([0, 1, 5, 40]))]
        seen += new
        fold.buf.appendList(new)
        fold.tiles.written.clear()
        out = fold._emit(7, wm)
        assert set(fold.tiles.written) <= {x[0] // fold.tile_us for x in new} and len(fold.tiles) <= processor.TILES + 2
        if not new:
            assert out is None
            continue
        for row in out.itertuples():
            past = [x for x in seen if row.ts_us - 1600 <= x[0] < row.ts_us]
            for j, name in ((2, "r0"), (3, "r1")):
                known = [x[j] for x in past if x[j] is not None]
                assert getattr(row, name) == pytest.approx(sum(known) / len(known)) if known else str(getattr(row, name)) == "nan"
            assert row.c0 == sum(x[2] or 0 for x in seen if x[0] < row.ts_us)


def test_every_row_is_accounted_for(spark):
    on = [(1, 1, i, BASE_US + i * DAY_US, 1, 0) for i in range(12)]
    behind = [(1, 1, 99, BASE_US + HOUR_US, 1, 1), (1, 1, 99, BASE_US + HOUR_US, 1, 1), (None, 2, None, BASE_US + 2, 1, 1)]
    batches = [on[:3], on[3:6], on[6:9], behind, [*on[9:], (4, 4, 50, None, 1, 1)]]
    out = new_dir(spark, "out")
    query = run(view_stream(_stream(spark, batches), REG, USER, watermark="1 hour"), out=out)
    got = spark.read.parquet(out).where(F.col("user_id").isNull() | (F.col("user_id") != RESERVED_KEY))
    source = spark.createDataFrame([r for b in batches for r in b], SCHEMA)
    counts = account(query, source, got, USER.keys)
    assert counts["on_time"] == 12 and counts["late"] + counts["dropped"] == 3 and counts["no_time"] == 1
    left = unserved(source, got, USER.keys).collect()
    assert sorted((r["event_id"] or 0) for r in left) == [0, 50, 99, 99]
    assert {r["reason"] for r in left if r["event_id"] == 50} == {"no_time"}
    with pytest.raises(RuntimeError, match="rows went in"):
        account(query, source, got.where("event_id <> 3"), USER.keys)


def test_arrival_order(spark):
    path = new_dir(spark, "arrival")
    in_arrival_order(spark.range(10), F.col("id") % 3, path)
    assert spark.read.parquet(path).count() == 10 and spark.read.parquet(path).columns == ["id"]


UPD = "k long, ts_us long, v double"


def test_latest_table_by_bucket(spark):
    path = new_dir(spark, "latest")
    sink = LatestTableSink(spark, path, ["k"], "ts_us", ["v"], buckets=8)
    with pytest.raises(ValueError):
        sink.read()
    sink(spark.createDataFrame([(k, 10, 1.0) for k in range(50)] + [(None, 5, 9.0)], UPD), 0)
    newer = [(3, 20, 2.0), (3, 15, 3.0), (4, 5, 4.0), (60, 1, 5.0), (5, 10, 7.0)]
    sink(spark.createDataFrame(newer, UPD), 1)
    want = {k: (10, 1.0) for k in range(50)} | {None: (5, 9.0), 3: (20, 2.0), 60: (1, 5.0)}
    table = lambda s: {r["k"]: (r["ts_us"], r["v"]) for r in s.read().collect()}
    assert table(sink) == want
    # A new object goes on from storage; a repeated batch changes nothing.
    again = LatestTableSink(spark, path, ["k"], "ts_us", ["v"], buckets=8)
    again(spark.createDataFrame(newer, UPD), 1)
    assert table(again) == want
    # Untouched buckets keep their version, and an empty batch touches none.
    versions = again.manifest.read(1)["versions"]
    assert set(versions.values()) == {0, 1} and sum(v == 1 for v in versions.values()) <= 4
    again(spark.createDataFrame([], UPD), 2)
    assert again.manifest.read(2)["versions"] == versions and table(again) == want
    again(spark.createDataFrame([(k, 30, 0.0) for k in range(50)], UPD), 3)
    before = table(again)
    assert again.vacuum() and table(again) == before and again.manifest.ids() == [3]
    with pytest.raises(ValueError, match="buckets"):
        LatestTableSink(spark, path, ["k"], "ts_us", ["v"], buckets=4)(spark.createDataFrame(newer, UPD), 4)


def test_latest_table_of_an_empty_stream(spark):
    sink = LatestTableSink(spark, new_dir(spark, "latest"), ["k"], "ts_us", ["v"])
    sink(spark.createDataFrame([], UPD), 0)
    assert sink.read().count() == 0 and sink.read().columns == ["k", "ts_us", "v"]


class _Log:
    def __init__(self):
        self.told = []

    def __call__(self, batch, batch_id):
        self.told.append(("rows", batch.count()))

    def hours_start(self, hours, batch_id):
        self.told.append(("start", [h.hour for h in hours]))

    def hours_end(self, hours, batch_id):
        self.told.append(("end", [h.hour for h in hours]))

    def finish(self):
        self.told.append(("finish",))


def test_hours_open_and_close_once(spark):
    path, log = new_dir(spark, "hours"), _Log()
    at = lambda *hours: spark.createDataFrame([(BASE_US + int(h * HOUR_US),) for h in hours], "ts_us long")
    replay = HourReplay(spark, path, [log, lambda batch, batch_id: None])
    replay(at(0, 0.5, 1.1), 0)
    restarted = HourReplay(spark, path, [log])
    restarted(at(1.5, 3), 1)
    restarted(at(), 2)
    restarted.done()
    assert log.told == [("start", [0, 1]), ("rows", 3), ("end", [0]), ("start", [3]), ("rows", 2), ("end", [1]), ("end", [3]), ("finish",)]


def test_metrics_from_merged_counts_equal_one_shot(spark):
    r = random.Random(5)
    hours = [dt.datetime(2024, 4, 8, h) for h in range(3)]
    rows = [(r.choice("ab"), float(r.random() < 0.3), round(r.random(), 1), hours[i * 3 // 300]) for i in range(300)]
    df = spark.createDataFrame(rows, "target string, y_true double, y_score double, hour timestamp")
    sink = EvalSink(spark, new_dir(spark, "eval"), lambda batch: batch)
    for b in range(3):
        part = spark.createDataFrame(rows[b * 100 : (b + 1) * 100], df.schema)
        sink(part, b)
        sink(part, b)  # a batch that ran twice counts once
        sink.hours_end([hours[b]], b)
    sink.finish()
    near = lambda frame: {tuple(x[:-4]): [None if v is None else round(v, 9) for v in x[-4:]] for x in map(tuple, frame.collect())}
    assert near(sink.total()) == near(ranking_metrics(df))
    per = near(sink.per_hour())
    for h in hours:
        for (target,), want in near(ranking_metrics(df.where(F.col("hour") == F.lit(h)))).items():
            assert per[target, h] == want


def test_versions_are_whole(spark):
    v = Versions(spark, new_dir(spark, "versions"))
    assert v.newest() is None and v.read(None) == {}
    v.write(3, {"a": [1, 2]})
    v.write(5, {"a": "x\ny"})
    assert v.newest() == 5 and v.newest(below=5) == 3 and v.read(5) == {"a": "x\ny"}
