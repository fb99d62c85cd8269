"""Catalog: latest tables, losses and metrics over a deterministic scored EV table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import sigmoid, with_engagement_targets
from ..functions.timecols import time_slice
from ..operators.latest import keep_latest, materialize, merge_latest, online_lookup
from ..operators.metrics import combined_loss, masked_bce, masked_huber, ranking_metrics, rates, rmse, to_long
from ..operators.windows import rolling_mean, view_source
from ..registry import POS_WEIGHT, ROLLING, feature_name
from ..sources.bindings import EV, EV_ITEM, EV_SIGNALS, EV_USER, EV_USER_ITEM, events_log
from .catalog import register
from .queries_features import _DWELL_SQL, _SKIP_SQL, _cum_cols, _roll_cols
from .sqlfrag import EV_SQL

BINARY = [*EV_SIGNALS, "is_skip"]
ARM_START = "2024-01-16 00:00:00"
UPD_START, UPD_END = "2024-01-10 00:00:00", "2024-01-20 00:00:00"
SERVE_AT = "2024-01-29 00:00:00"


# -- a deterministic scored table: logits from the user's rolling rates ----------------
def _logit_of(t: str):
    src = "is_click" if t == "is_skip" else t
    bias = -1.0 if t == "is_skip" else -2.0
    return F.lit(4.0) * F.coalesce(F.col(feature_name(src, ROLLING, ["user_id"])), F.lit(0.0)) + F.lit(bias)


def scored_events(spark, sf_dir) -> DataFrame:
    log = with_engagement_targets(events_log(spark, sf_dir))
    f = rolling_mean(log, ["user_id"], EV_SIGNALS, EV.window_us)
    cols = {f"logit_{t}": _logit_of(t) for t in BINARY}
    cols["pred_dwell_log"] = F.lit(8.0) + F.coalesce(F.col(feature_name("is_view", ROLLING, ["user_id"])), F.lit(0.0))
    f = f.withColumns(cols)
    return f.withColumns({f"score_{t}": sigmoid(f"logit_{t}") for t in BINARY})


def _logit_sql(t: str) -> str:
    src = "is_click" if t == "is_skip" else t
    bias = "-1.0" if t == "is_skip" else "-2.0"
    return f"(4.0 * coalesce({feature_name(src, ROLLING, ['user_id'])}, 0.0) + {bias})"


SCORED_SQL = (
    f"(SELECT *, {', '.join(f'1.0 / (1.0 + exp(-{_logit_sql(t)})) AS score_{t}, {_logit_sql(t)} AS logit_{t}' for t in BINARY)}, "
    f"8.0 + coalesce({feature_name('is_view', ROLLING, ['user_id'])}, 0.0) AS pred_dwell_log FROM "
    f"(SELECT *, {_SKIP_SQL} AS is_skip, {_DWELL_SQL} AS dwell_log, {_roll_cols(['user_id'], EV_SIGNALS, 7)} FROM {EV_SQL}))"
)


def _long_sql(kind: str) -> str:
    if kind == "dwell":
        return f"(SELECT 'dwell_log' AS target, dwell_log AS y_true, pred_dwell_log AS y_score FROM {SCORED_SQL} WHERE dwell_log IS NOT NULL)"
    col = "logit" if kind == "logit" else "score"
    parts = [f"SELECT '{t}' AS target, CAST({t} AS DOUBLE) AS y_true, {col}_{t} AS y_score FROM {SCORED_SQL} WHERE {t} IS NOT NULL" for t in BINARY]
    return "(" + " UNION ALL ".join(parts) + ")"


def _r9(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in cols})


_SOFTPLUS = "(ln(1 + exp(-abs({x}))) + greatest({x}, 0.0))"


def _bce_sql(y: str, x: str, w: float) -> str:
    return f"({w} * {y} * {_SOFTPLUS.format(x='-' + x)} + (1.0 - {y}) * {_SOFTPLUS.format(x=x)})"


_HUBER_SQL = "CASE WHEN abs(y_score - y_true) <= 1.0 THEN 0.5 * (y_score - y_true) * (y_score - y_true) ELSE abs(y_score - y_true) - 0.5 END"


@register(
    "masked_bce",
    f"SELECT target, round(sum({_bce_sql('y_true', 'y_score', POS_WEIGHT)}) / greatest(count(*), 1), 9) AS loss FROM {_long_sql('logit')} GROUP BY target",
)
def _bce(spark, sf_dir):
    return _r9(masked_bce(to_long(scored_events(spark, sf_dir), BINARY, score="logit_{t}"), POS_WEIGHT), ["loss"])


@register("masked_huber", f"SELECT round(coalesce(sum({_HUBER_SQL}), 0.0) / greatest(count(*), 1), 9) AS loss FROM {_long_sql('dwell')}")
def _huber(spark, sf_dir):
    return _r9(masked_huber(to_long(scored_events(spark, sf_dir), ["dwell_log"], score="pred_dwell_log")), ["loss"])


@register(
    "combined_loss",
    f"""WITH b AS (SELECT avg(l) AS binary_loss FROM (SELECT target, sum({_bce_sql('y_true', 'y_score', POS_WEIGHT)}) / greatest(count(*), 1) AS l
                   FROM {_long_sql('logit')} GROUP BY target)),
         h AS (SELECT coalesce(sum({_HUBER_SQL}), 0.0) / greatest(count(*), 1) AS continuous_loss FROM {_long_sql('dwell')})
    SELECT round(binary_loss, 9) AS binary_loss, round(continuous_loss, 9) AS continuous_loss, round(binary_loss + continuous_loss, 9) AS loss FROM b, h""",
)
def _combined(spark, sf_dir):
    s = scored_events(spark, sf_dir)
    out = combined_loss(to_long(s, BINARY, score="logit_{t}"), to_long(s, ["dwell_log"], score="pred_dwell_log"), POS_WEIGHT)
    return _r9(out, ["binary_loss", "continuous_loss", "loss"])


def _ranking_sql(cols: list[str]) -> str:
    body = f"""WITH c AS (SELECT target, y_score, sum(CASE WHEN y_true >= 0.5 THEN 1 ELSE 0 END) AS p, sum(CASE WHEN y_true >= 0.5 THEN 0 ELSE 1 END) AS n
                  FROM {_long_sql('score')} GROUP BY target, y_score),
         r AS (SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM c
               WINDOW w AS (PARTITION BY target ORDER BY y_score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
         g AS (SELECT target, sum(p) AS P, sum(n) AS N, sum(n * (tp - p / 2.0)) AS auc, sum(p * tp / (tp + fp)) AS ap,
                      sum(CASE WHEN y_score >= 0.5 THEN p ELSE 0 END) AS tp5, sum(CASE WHEN y_score >= 0.5 THEN p + n ELSE 0 END) AS pp5
               FROM r GROUP BY target)
    SELECT target,
      round(CASE WHEN P > 0 AND N > 0 THEN auc / (P * N) END, 9) AS roc_auc,
      round(CASE WHEN P > 0 AND N > 0 THEN ap / P END, 9) AS recall_precision_auc,
      round(CASE WHEN P > 0 AND N > 0 AND pp5 > 0 THEN tp5 / pp5 END, 9) AS precision,
      round(CASE WHEN P > 0 AND N > 0 THEN tp5 / P END, 9) AS recall
    FROM g"""
    return f"SELECT {', '.join(['target', *cols])} FROM ({body})"


_ALL_RANK = ["roc_auc", "recall_precision_auc", "precision", "recall"]


def _ranking(strategy: str, cols: list[str]):
    def q(spark, sf_dir):
        long = to_long(scored_events(spark, sf_dir), BINARY)
        return _r9(ranking_metrics(long, strategy=strategy), _ALL_RANK).select("target", *cols)

    return q


register("ranking_metrics", _ranking_sql(_ALL_RANK))(_ranking("ranged", _ALL_RANK))
register("ranking_metrics_direct", _ranking_sql(_ALL_RANK))(_ranking("direct", _ALL_RANK))
register("roc_auc", _ranking_sql(["roc_auc"]))(_ranking("ranged", ["roc_auc"]))
register("avg_precision", _ranking_sql(["recall_precision_auc"]))(_ranking("ranged", ["recall_precision_auc"]))
register("prec_recall", _ranking_sql(["precision", "recall"]))(_ranking("ranged", ["precision", "recall"]))


@register("rmse", f"SELECT target, round(sqrt(avg((y_true - y_score) * (y_true - y_score))), 9) AS rmse FROM {_long_sql('dwell')} GROUP BY target")
def _rmse(spark, sf_dir):
    return _r9(rmse(to_long(scored_events(spark, sf_dir), ["dwell_log"], score="pred_dwell_log")), ["rmse"])


@register(
    "signal_rates",
    f"SELECT ts >= TIMESTAMP '{ARM_START}' AS late_arm, {', '.join(f'round(avg(CAST({s} AS DOUBLE)), 9) AS {s}_rate' for s in BINARY)} "
    f"FROM (SELECT *, {_SKIP_SQL} AS is_skip FROM {EV_SQL}) GROUP BY 1",
)
def _rates(spark, sf_dir):
    log = with_engagement_targets(events_log(spark, sf_dir)).withColumn("late_arm", F.col("ts") >= F.lit(ARM_START).cast("timestamp_ntz"))
    return _r9(rates(log, BINARY, by=["late_arm"]), [f"{s}_rate" for s in BINARY])


# -- D2 / D3 / A10 / C6: latest-value tables ---------------------------------------------
_UFEAT = [feature_name(s, ROLLING, ["user_id"]) for s in EV_SIGNALS]
_USER_SRC_SQL = f"(SELECT user_id, ts, {_roll_cols(['user_id'], EV_SIGNALS, 7)} FROM {EV_SQL})"


def _latest_sql(src: str, keys: list[str], cols: list[str], where: str = "") -> str:
    return (
        f"SELECT {', '.join(keys)}, ts, {', '.join(cols)} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
        f"ORDER BY ts DESC) AS __rn FROM {src} {where}) WHERE __rn = 1"
    )


@register("latest_user", _latest_sql(_USER_SRC_SQL, ["user_id"], _UFEAT))
def _latest_user(spark, sf_dir):
    src = view_source(events_log(spark, sf_dir), EV, EV_USER)
    return keep_latest(src, ["user_id"], "ts", _UFEAT)


@register(
    "merge_latest",
    f"""SELECT user_id, ts, {', '.join(_UFEAT)} FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, prio DESC) AS __rn FROM (
        SELECT *, 1 AS prio FROM ({_latest_sql(_USER_SRC_SQL, ['user_id'], _UFEAT, f"WHERE ts < TIMESTAMP '{ARM_START}'")})
        UNION ALL
        SELECT *, 0 AS prio FROM ({_latest_sql(_USER_SRC_SQL, ['user_id'], _UFEAT, f"WHERE ts >= TIMESTAMP '{UPD_START}' AND ts < TIMESTAMP '{UPD_END}'")})))
    WHERE __rn = 1""",
)
def _merge(spark, sf_dir):
    src = view_source(events_log(spark, sf_dir), EV, EV_USER)
    current = materialize(src, ["user_id"], "ts", _UFEAT, end=ARM_START)
    updates = time_slice(src, "ts", UPD_START, UPD_END)
    return merge_latest(current, updates, ["user_id"], "ts")


def _online_sql() -> str:
    views = [(["user_id"], EV_USER), (["user_id", "video_id"], EV_USER_ITEM), (["video_id"], EV_ITEM)]
    parts, joins = [], []
    for i, (keys, view) in enumerate(views):
        cols = [c.name for c in EV.cols(view)]
        cum = _cum_cols(keys, ["is_click"]) if view is EV_ITEM else None
        src = f"(SELECT {', '.join(keys)}, ts, {_roll_cols(keys, EV_SIGNALS, 7)}{', ' + cum if cum else ''} FROM {EV_SQL})"
        parts.append(f"v{i} AS ({_latest_sql(src, keys, cols, f'WHERE ts < TIMESTAMP {chr(39)}{SERVE_AT}{chr(39)}')})")
        joins.append(f"LEFT JOIN v{i} USING ({', '.join(keys)})")
    served = ", ".join(f"CAST(coalesce({c}, 0.0) AS DOUBLE) AS {c}" for c in EV.served)
    req = f"(SELECT DISTINCT user_id, video_id FROM {EV_SQL} WHERE ts >= TIMESTAMP '{SERVE_AT}')"
    return f"WITH {', '.join(parts)} SELECT user_id, video_id, {served} FROM {req} r {' '.join(joins)}"


@register("online_vector", _online_sql())
def _online(spark, sf_dir):
    log = events_log(spark, sf_dir)
    latest = {}
    for view in EV.views:
        src = view_source(log, EV, view)
        latest[view.keys] = materialize(src, view.keys, "ts", [c.name for c in EV.cols(view)], end=SERVE_AT)
    req = time_slice(log, "ts", start=SERVE_AT).select("user_id", "video_id").distinct()
    return online_lookup(req, latest, EV.served)
