"""Catalog: fitted heads. Model values have no SQL oracle; what holds for any rightly
fitted heads has (``heads_contract``)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.labels import with_engagement_targets
from ..functions.timecols import time_slice
from ..operators.latest import materialize
from ..operators.metrics import bce_with_logits, huber, ranking_metrics, rmse, to_long
from ..operators.sampling import neg_sample_exact
from ..registry import POS_WEIGHT
from ..session import scratch_path
from ..sources.bindings import EV, events_log
from .catalog import register
from .heads import Bundle, fit_bundle, score, score_ids, select_heads, training_rows
from .queries_eval import ARM_START, BINARY
from .queries_features import _DWELL_SQL, _SKIP_SQL
from .sqlfrag import EV_SQL
from .training import feature_sources, training_table

VALID_START = "2024-01-14 00:00:00"


def _fit_and_score(spark, sf_dir):
    table = training_table(events_log(spark, sf_dir), EV).persist()
    train = time_slice(table, "ts", end=VALID_START)
    valid = time_slice(table, "ts", VALID_START, ARM_START)
    test = time_slice(table, "ts", start=ARM_START)
    feats = list(EV.served)
    cats = EV.bucket_columns
    prep, heads, _ = select_heads(train, valid, feats, cats, BINARY, ["dwell_log"], grid=(0.0, 0.01))
    return score(test, prep, heads)


@register("fit_score_heads")
def _fit_score(spark, sf_dir):
    """J1-J4 + J3: fit on the train window, pick by validation loss, score the arm."""
    scored = _fit_and_score(spark, sf_dir)
    return scored.select("event_id", *[f"score_{t}" for t in BINARY], "pred_dwell_log")


@register("heads_eval_metrics")
def _heads_eval(spark, sf_dir):
    """S9-style report of the fitted heads on the arm: ranking metrics + RMSE per target."""
    scored = _fit_and_score(spark, sf_dir).select(*BINARY, "dwell_log", *[f"score_{t}" for t in BINARY], "pred_dwell_log").persist()
    rank = ranking_metrics(to_long(scored, BINARY), targets=BINARY)
    err = rmse(to_long(scored, ["dwell_log"], score="pred_{t}"), ["dwell_log"]).select(
        "target", *[F.lit(None).cast("double").alias(c) for c in ["roc_auc", "recall_precision_auc", "precision", "recall"]], "rmse"
    )
    return rank.withColumn("rmse", F.lit(None).cast("double")).unionByName(err)


def _beats_constant(bundle, train) -> dict[str, bool]:
    """Per target: on the rows it was fitted on, no more loss than the best constant."""
    scored = score(train, bundle.prep, bundle.heads)
    y, s = F.col("y_true"), F.col("y_score")
    mean = F.avg("y_true").alias("mean")
    logits = to_long(scored, BINARY, score="logit_{t}").groupBy("target")
    rows = logits.agg(F.avg(bce_with_logits(y, s, POS_WEIGHT)).alias("loss"), mean).collect()  # one row per target
    p = {r.target: POS_WEIGHT * r["mean"] / (POS_WEIGHT * r["mean"] + 1 - r["mean"]) for r in rows}
    consts = F.create_map(*[F.lit(x) for t, v in p.items() for x in (t, float(v))])
    best = -(POS_WEIGHT * y * F.log(consts[F.col("target")]) + (1 - y) * F.log(1 - consts[F.col("target")]))
    const = {r.target: r.loss for r in logits.agg(F.avg(best).alias("loss")).collect()}
    ok = {r.target: r.loss <= const[r.target] + 1e-6 for r in rows}
    preds = to_long(scored, ["dwell_log"], score="pred_{t}")
    centre = preds.agg(mean).first()["mean"]
    r = preds.agg(F.avg(huber(y, s)).alias("loss"), F.avg(huber(y, F.lit(centre))).alias("const")).first()
    return ok | {"dwell_log": r.loss <= r.const + 1e-6}


_CONTRACT_LABELS = {**{t: t for t in BINARY}, "is_skip": _SKIP_SQL, "dwell_log": _DWELL_SQL}


@register(
    "heads_contract",
    " UNION ALL ".join(
        f"SELECT '{t}' AS target, count(*) AS n_scored, count({e}) AS n_valid, CAST(coalesce(sum(CASE WHEN {e} >= 0.5 THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_positive, "
        f"count(*) AS n_in_range, TRUE AS not_above_constant FROM {EV_SQL} WHERE ts >= TIMESTAMP '{ARM_START}'"
        for t, e in _CONTRACT_LABELS.items()
    ),
)
def _heads_contract(spark, sf_dir):
    """Heads fitted on the sampled training rows, saved and loaded, score the arm
    from its ids and the latest values before it. Each arm row is scored once per target,
    in range, and no head loses to a constant on its training rows."""
    log = events_log(spark, sf_dir)
    table, sizes = training_rows(log, EV, end=VALID_START)
    path = scratch_path(spark, f"heads-{uuid.uuid4().hex}")
    table.write.parquet(f"{path}/table")
    table = spark.read.parquet(f"{path}/table")
    train, valid = time_slice(table, "ts", end=VALID_START), time_slice(table, "ts", VALID_START, ARM_START)
    clicks = ["is_click", "is_signup", "is_purchase"]
    fit_bundle(train, valid, EV, sizes, negatives=0.5, signals=clicks, id_cols=["event_id"]).save(spark, f"{path}/bundle")
    bundle = Bundle.load(spark, f"{path}/bundle")
    ok = _beats_constant(bundle, neg_sample_exact(train, clicks, ["event_id"], 0.5))  # the rows it was fitted on

    sources = feature_sources(time_slice(log, "ts", end=ARM_START), EV)
    latest = {v.keys: materialize(sources[v.name], v.keys, "ts", [c.name for c in EV.cols(v)]).drop("ts") for v in EV.views}
    arm = time_slice(with_engagement_targets(log), "ts", start=ARM_START)
    scored = score_ids(arm.select("event_id", "user_id", "video_id", *BINARY, "dwell_log"), latest, bundle, EV)
    inside = {t: F.col(f"score_{t}").between(0.0, 1.0) for t in BINARY}
    inside["dwell_log"] = F.abs("pred_dwell_log") < float("inf")
    cells = [F.struct(F.lit(t).alias("target"), F.col(t).cast("double").alias("y"), good.alias("good"), F.lit(ok[t]).alias("fits")) for t, good in inside.items()]
    return scored.select(F.explode(F.array(*cells)).alias("c")).select("c.*").groupBy("target").agg(
        F.count(F.lit(1)).alias("n_scored"), F.count("y").alias("n_valid"), F.count_if(F.col("y") >= 0.5).alias("n_positive"),
        F.count_if("good").alias("n_in_range"), F.bool_and("fits").alias("not_above_constant"),
    )
