from pyspark.sql import functions as F

from chronoframe.operators.latest import keep_latest, merge_latest, online_lookup
from chronoframe.operators.sampling import neg_sample_exact, neg_sample_hash

SIG = ["is_click", "long_view", "is_hate"]


def rows(spark, spec):
    data = [(i, *r) for i, r in enumerate(spec)]
    return spark.createDataFrame(data, "id long, is_click int, long_view int, is_hate int")


def test_neg_sampling_counts(spark):
    df = rows(spark, [(0, 0, 0)] * 10 + [(1, 0, 0)] * 4)
    out = neg_sample_exact(df, SIG, ["id"], 0.5)
    assert out.count() == 9 and out.filter("is_click = 1").count() == 4


def test_any_signal_protects_and_frac_zero(spark):
    df = rows(spark, [(0, 0, 0)] * 6 + [(0, 1, 0), (0, 0, 1)])
    assert neg_sample_exact(df, SIG, ["id"], 0.0).count() == 2


def test_frac_one_noop_and_reproducible(spark):
    df = rows(spark, [(0, 0, 0)] * 50 + [(1, 0, 0)] * 5)
    assert neg_sample_exact(df, SIG, ["id"], 1.0).count() == 55
    a = sorted(r.id for r in neg_sample_exact(df, SIG, ["id"], 0.3).collect())
    b = sorted(r.id for r in neg_sample_exact(df.repartition(7), SIG, ["id"], 0.3).collect())
    assert a == b and len(a) == 5 + 15
    h = neg_sample_hash(df, SIG, ["id"], 0.5)
    assert h.filter("is_click = 1").count() == 5


def test_keep_latest_in_hour(spark):
    df = spark.createDataFrame([(1, "2024-04-08 00:00:00", 1.0), (1, "2024-04-08 00:30:00", 2.0)], "user_id long, ts string, f double")
    out = keep_latest(df.withColumn("ts", F.col("ts").cast("timestamp_ntz")), ["user_id"], "ts", ["f"]).collect()
    assert [(r.f, str(r.ts)) for r in out] == [(2.0, "2024-04-08 00:30:00")]


def test_merge_never_regresses_and_ties_keep_stored(spark):
    cur = spark.createDataFrame([(1, 10, 1.0), (2, 10, 1.0), (3, 10, 1.0)], "k long, ts long, f double")
    upd = spark.createDataFrame([(1, 5, 9.0), (2, 10, 9.0), (3, 11, 9.0), (4, 1, 9.0)], "k long, ts long, f double")
    got = {r.k: (r.ts, r.f) for r in merge_latest(cur, upd, ["k"], "ts").collect()}
    assert got == {1: (10, 1.0), 2: (10, 1.0), 3: (11, 9.0), 4: (1, 9.0)}


def test_online_miss_is_zero(spark):
    req = spark.createDataFrame([(1, 2)], "user_id long, video_id long")
    lt = spark.createDataFrame([(9, 0.5)], "user_id long, a double")
    out = online_lookup(req, {("user_id",): lt}, ["a"]).collect()
    assert out[0].a == 0.0


def test_neg_sampling_heavy_copies_exact(spark, monkeypatch):
    """A third of the negatives are copies of one row (same id, same hash): the
    kept count stays exact, copies are re-emitted in chunks, and the chosen
    rows equal a brute-force ranking on md5 order."""
    import hashlib

    from chronoframe.operators import sampling

    monkeypatch.setattr(sampling, "PREFIX_HEX", 1)  # few ranges, so the copy group is on a boundary
    spec = [(i, 0, 0, 0) for i in range(200)] + [(7, 0, 0, 0)] * 100 + [(1000 + i, 1, 0, 0) for i in range(5)]
    df = spark.createDataFrame(spec, "id long, is_click int, long_view int, is_hate int")
    for frac in (0.2, 0.45, 0.7):
        got = sorted(r.id for r in sampling.neg_sample_exact(df, SIG, ["id"], frac).collect())
        negs = [r[0] for r in spec if r[1] == 0]
        k = int(len(negs) * frac)
        order = sorted(negs, key=lambda i: (hashlib.md5(f"{i}|{sampling.SEED}".encode()).hexdigest(), i))
        assert got == sorted(order[:k] + [1000 + i for i in range(5)]), frac


def test_copies_are_chunked(spark):
    from chronoframe.operators.sampling import _copies

    rows_ = spark.createDataFrame([(1, 7), (2, 3)], "id long, n long")
    out = _copies(rows_, "n", chunk=2)
    assert sorted(r.id for r in out.collect()) == [1] * 7 + [2] * 3
    assert out.columns == ["id"]
