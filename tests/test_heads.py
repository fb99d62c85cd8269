"""Heads with hashed ids: width check, saved bundle, scoring from ids."""

import pytest
from pyspark.sql import functions as F

from chronoframe.operators.latest import materialize
from chronoframe.plans.heads import MAX_WIDTH, Bundle, fit_bundle, score, score_ids, training_rows, _prep
from chronoframe.plans.training import feature_sources
from chronoframe.sources.bindings import EV, events_log

SF = "/root/testdata/sf0.001"
SPLIT = "2024-01-14 00:00:00"


def test_width_is_checked():
    for bad in (0, 1, MAX_WIDTH + 1):
        with pytest.raises(ValueError, match="width"):
            _prep(["a"], ["b"], bad)


def test_bundle_round_trip_and_scores_from_ids(spark, tmp_path):
    log = events_log(spark, SF)
    table, sizes = training_rows(log, EV, end=SPLIT)
    assert {c: n & (n - 1) for c, n in sizes.items()} == {c: 0 for c in EV.bucket_sources}
    train, valid = table.filter(F.col("ts") < SPLIT), table.filter(F.col("ts") >= SPLIT)
    made = fit_bundle(train, valid, EV, sizes, width=64, grid=(0.01,))
    assert all(m.numFeatures == len(EV.served) + 64 for m in made.heads.binary.values())
    path = made.save(spark, str(tmp_path / "bundle"))
    with pytest.raises(Exception, match="already exists"):
        made.save(spark, path)
    kept = Bundle.load(spark, path)
    assert (kept.sizes, kept.width) == (sizes, 64)

    def scores(b, df):
        return [tuple(r) for r in score(df, b.prep, b.heads).select("event_id", "score_is_click", "pred_dwell_log").orderBy("event_id").collect()]

    assert scores(made, valid) == scores(kept, valid)

    sources = feature_sources(log, EV, "direct")
    latest = {v.keys: materialize(sources[v.name], v.keys, "ts", [c.name for c in EV.cols(v)]).drop("ts") for v in EV.views}
    known = log.select("user_id", "video_id").filter("video_id is not null").first()
    ids = spark.createDataFrame([(0, known.user_id, known.video_id), (1, -5, None), (2, None, None), (3, -5, None), (4, 10**15, 10**15)], "n int, user_id long, video_id long")
    got = {r.n: r for r in score_ids(ids, latest, kept, EV).collect()}
    assert set(got) == set(range(5)) and all(0.0 <= r.score_is_click <= 1.0 for r in got.values())
    assert got[1].score_is_click == got[3].score_is_click and got[2].user_id_bucket == 0
    assert all(got[4][c] == 0.0 for c in EV.served) and got[4].user_id_bucket > 0
    with pytest.raises(ValueError, match="video_id"):
        score_ids(ids, latest, Bundle({"user_id": 8}, 64, kept.prep, kept.heads), EV)


def test_a_fit_has_as_many_tasks_as_its_rows_are_worth(spark):
    """not as many as the shuffle before it had partitions."""
    from chronoframe.plans import heads

    x = spark.range(1000).repartition(64)
    assert heads.in_few_tasks(x).rdd.getNumPartitions() == 1
    many = spark.range(3 * heads.FIT_ROWS).repartition(64)
    assert heads.in_few_tasks(many).rdd.getNumPartitions() == min(3, spark.sparkContext.defaultParallelism)
    assert heads.in_few_tasks(spark.range(0)).count() == 0


def test_one_hot_places_are_unnamed(spark):
    """the vectors of the encoder, without a name for each place."""

    from chronoframe.plans.heads import encode

    rows = [(i, float(v), w, u, i % 3) for i, (v, w, u) in enumerate([(0.5, None, 0), (0.0, 7, 63), (1.5, 0, 64), (2.25, 3, 130), (0.1, 1, 127), (9.0, 2, 63)])]
    df = spark.createDataFrame(rows, "n int, a double, b long, u int, t int").cache()
    prep = _prep(["a", "b"], ["u", "t"]).fit(df)
    new = spark.createDataFrame([(9, 1.0, 1, 65, 2), (10, 0.25, None, 130, 7)], df.schema)
    x = encode(df.unionByName(new), prep, ["a", "b"])
    assert x.columns == [*df.columns, "features"] and x.schema["features"].metadata == {"ml_attr": {"num_attrs": 138}}
    got = {r.n: r.features for r in x.collect()}
    for n, a, b, u, t in [*rows, (9, 1.0, 1, 65, 2), (10, 0.25, None, 130, 7)]:
        want = [a, float(b or 0)] + [0.0] * 136
        want[2 + u] = want[134 + min(t, 3)] = 1.0
        assert got[n].toArray().tolist() == want, n
    # By the encoder's own transform: the same vectors.
    same = prep.transform(df.unionByName(new).fillna(0.0, subset=["a", "b"]))
    assert {r.n: r.features.toArray().tolist() for r in same.collect()} == {n: v.toArray().tolist() for n, v in got.items()}
