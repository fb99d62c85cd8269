import random

import pytest

from chronoframe.operators.metrics import masked_bce, masked_huber, ranking_metrics, rmse


def long(spark, data):
    return spark.createDataFrame(data, "target string, y_true double, y_score double")


@pytest.mark.parametrize("strategy", ["direct", "ranged"])
def test_perfect(spark, strategy):
    df = long(spark, [("t", float(y), s) for y, s in [(0, 0.1), (0, 0.2), (1, 0.8), (1, 0.9)]])
    r = ranking_metrics(df, strategy=strategy).first()
    assert (r.roc_auc, r.recall_precision_auc, r.precision, r.recall) == (1.0, 1.0, 1.0, 1.0)


def test_single_class_is_null(spark):
    r = ranking_metrics(long(spark, [("t", 1.0, 0.3), ("t", 1.0, 0.6), ("t", 1.0, 0.9)])).first()
    assert (r.roc_auc, r.recall_precision_auc, r.precision, r.recall) == (None, None, None, None)


def brute(ys, ss):
    pos = [s for y, s in zip(ys, ss) if y == 1]
    neg = [s for y, s in zip(ys, ss) if y == 0]
    auc = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    ap = 0.0
    for s in sorted(set(ss), reverse=True):
        tp = sum(1 for y, x in zip(ys, ss) if x >= s and y == 1)
        fp = sum(1 for y, x in zip(ys, ss) if x >= s and y == 0)
        p_at = sum(1 for y, x in zip(ys, ss) if x == s and y == 1)
        ap += (p_at / len(pos)) * tp / (tp + fp)
    return auc, ap


@pytest.mark.parametrize("strategy", ["direct", "ranged"])
def test_auc_ap_against_brute_force_with_ties(spark, strategy):
    rng = random.Random(0)
    data = []
    for t in ["a", "b"]:
        for _ in range(300):
            y = rng.randint(0, 1)
            data.append((t, float(y), round(rng.random() * 0.5 + 0.3 * y, 2)))
    got = {r.target: r for r in ranking_metrics(long(spark, data), strategy=strategy, n_ranges=7).collect()}
    for t in ["a", "b"]:
        ys = [int(y) for tt, y, _ in data if tt == t]
        ss = [s for tt, _, s in data if tt == t]
        auc, ap = brute(ys, ss)
        assert abs(got[t].roc_auc - auc) < 1e-12 and abs(got[t].recall_precision_auc - ap) < 1e-12


def test_rmse_masked_and_losses(spark):
    df = long(spark, [("d", 1.0, 1.0), ("d", 2.0, 2.0)])  # the masked third row never reaches the table
    assert rmse(df).first().rmse == 0.0
    assert masked_huber(long(spark, [("d", 0.0, 3.0)])).first().loss == 2.5
    empty = spark.createDataFrame([], "target string, y_true double, y_score double")
    assert masked_huber(empty).first().loss == 0.0
    b = masked_bce(long(spark, [("t", 1.0, 0.0), ("t", 0.0, 0.0)]), pos_weight=2.0).first().loss
    import math

    assert abs(b - (2 * math.log(2) + math.log(2)) / 2) < 1e-12


def test_write_metrics_round_trip(spark):
    """Metrics rows and run metadata land as JSON under the shared folder."""
    import json
    import uuid

    from chronoframe.session import scratch_path
    from chronoframe.sources.io import write_metrics

    path = scratch_path(spark, f"metrics-{uuid.uuid4().hex}")
    m = ranking_metrics(long(spark, [("a", 1.0, 0.9), ("a", 0.0, 0.1)]))
    write_metrics(spark, m, path, metadata={"split": "test", "rows": 2})
    back = spark.read.json(f"{path}/metrics").collect()
    assert [(r.target, r.roc_auc) for r in back] == [("a", 1.0)]
    meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    assert meta == {"split": "test", "rows": 2}


def test_every_named_target_has_a_row(spark):
    from chronoframe.operators import metrics as M

    rows = spark.createDataFrame([("a", 1.0, 2.0), ("a", 0.0, -1.0)], "target string, y_true double, y_score double")
    bce = {r["target"]: r["loss"] for r in M.masked_bce(rows, targets=["a", "b"]).collect()}
    assert bce["b"] == 0.0 and bce["a"] > 0
    none = rows.filter("false")
    both = M.combined_loss(rows, none, targets=["a", "b"]).first()
    assert abs(both["binary_loss"] - bce["a"] / 2) < 1e-12
    got = {r["target"]: r for r in M.ranking_metrics(rows, targets=["a", "b"]).collect()}
    assert got["a"]["roc_auc"] == 1.0 and got["b"]["roc_auc"] is None
    assert {r["target"]: r["rmse"] for r in M.rmse(rows, targets=["b"]).collect()}["b"] is None


def test_score_ranges_follow_the_distinct_scores(spark, monkeypatch):
    """The split of the score axis has no cap, and never changes a metric."""
    from chronoframe.operators import metrics

    rows = [("t", float(i % 3 == 0), (i * 37 % 101) / 101) for i in range(400)]
    want = ranking_metrics(long(spark, rows), strategy="direct").first()
    monkeypatch.setattr(metrics, "RANGE_SCORES", 1)
    assert metrics._ranges_for(metrics.score_counts(long(spark, rows))) == 101
    got = ranking_metrics(long(spark, rows)).first()
    assert got.asDict() == pytest.approx(want.asDict())
