import random

from pyspark.sql import functions as F

from chronoframe.operators.windows import cumulative_sum, rolling_mean
from chronoframe.registry import DAY_US, HOUR_US, FeatureView, Registry
from chronoframe.streaming.replay import RESERVED_KEY, drain_marker, new_dir, replay_source, run, view_stream, warm_state

SIG = [f"s{i}" for i in range(3)]
VIEW = FeatureView("v", ("user_id",), ttl_us=None)
REG = Registry(signals=tuple(SIG), views=(VIEW,), cumulative={"v": ("s0",)}, window_us=2 * DAY_US)
BASE_US = 1_712_534_400_000_000  # 2024-04-08 00:00 UTC
SCHEMA = "user_id long, event_id long, ts_us long, s0 int, s1 int, s2 int"


def _events(n=60, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # one event every 5 h per user, plus some tied timestamps
        u = i % 4
        t = BASE_US + (i // 4) * 5 * HOUR_US
        rows.append((u, i, t, rng.randint(0, 1), rng.randint(0, 1), rng.randint(0, 1)))
    rows += [(0, 1000, rows[0][2], 1, 1, 1)]  # a tie with event 0
    rng.shuffle(rows)
    return rows


def test_stream_equals_batch_with_shuffled_arrival(spark):
    rows = _events()
    path = new_dir(spark, "stream-in")
    chunks = [rows[i::4] for i in range(4)]
    for j, c in enumerate(chunks):
        spark.createDataFrame(c, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    schema = spark.createDataFrame([], SCHEMA).schema
    drain_marker(spark, schema, {"user_id": RESERVED_KEY, "event_id": RESERVED_KEY, "ts_us": BASE_US + 10**15, "s0": 0, "s1": 0, "s2": 0}, into=path)
    src = replay_source(spark, path, schema, max_files_per_trigger=1)
    out = new_dir(spark, "stream-out")
    run(view_stream(src, REG, VIEW, watermark="30 days"), out=out)
    got = {r.event_id: r for r in spark.read.parquet(out).filter(F.col("user_id") != RESERVED_KEY).collect()}

    df = spark.createDataFrame(rows, SCHEMA)
    names = [f"{s}_rolling_user_id" for s in SIG]
    batch = rolling_mean(df, ["user_id"], SIG, 2 * DAY_US, names=names)
    batch = cumulative_sum(batch, ["user_id"], ["s0"], names=["s0_cumulative_user_id"])
    exp = {r.event_id: r for r in batch.collect()}
    assert set(got) == set(exp)
    for k, e in exp.items():
        g = got[k]
        for n in names + ["s0_cumulative_user_id"]:
            assert (g[n] is None and e[n] is None) or abs(g[n] - e[n]) < 1e-12, (k, n, g[n], e[n])


def test_warm_state_seeds_counts(spark):
    hist = spark.createDataFrame([(1, 1, 0, 1, 0, 0), (1, 2, HOUR_US, 1, 0, 0), (2, 3, 0, 0, 0, 0)], SCHEMA)
    init = warm_state(hist, REG, VIEW, upto_us=2 * HOUR_US)
    c = {r.user_id: r.c0 for r in init.filter("kind = 'c'").collect()}
    assert c == {1: 2, 2: 0}
    assert init.filter("kind = 'w'").count() == 3


def test_rows_beyond_the_watermark_are_counted(spark):
    """A row older than the watermark is dropped and counted, never folded in."""
    from chronoframe.streaming.replay import late_rows, on_time

    path = new_dir(spark, "stream-late")
    schema = spark.createDataFrame([], SCHEMA).schema
    in_order = [(1, i, BASE_US + i * DAY_US, 1, 0, 0) for i in range(5)]
    spark.createDataFrame(in_order, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    behind = [(1, 99, BASE_US + HOUR_US, 1, 1, 1)]  # 4 days behind, watermark delay 1 hour
    spark.createDataFrame(behind, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    drain_marker(spark, schema, {"user_id": RESERVED_KEY, "event_id": RESERVED_KEY, "ts_us": BASE_US + 10**15, "s0": 0, "s1": 0, "s2": 0}, into=path)
    out = new_dir(spark, "stream-late-out")
    run(view_stream(replay_source(spark, path, schema, max_files_per_trigger=1), REG, VIEW, watermark="1 hour"), out=out)
    res = spark.read.parquet(out).filter(F.col("user_id") != RESERVED_KEY)
    assert sorted(r.event_id for r in on_time(res).collect()) == [0, 1, 2, 3, 4]
    late = late_rows(res).collect()
    assert [(r.event_id, r.s0_rolling_user_id) for r in late] == [(99, None)]
    # the on-time rows never saw the late one: day-1 event sees only day 0
    assert {r.event_id: r.s1_rolling_user_id for r in on_time(res).collect()}[1] == 0.0
