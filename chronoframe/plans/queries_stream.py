"""Catalog: streaming replay queries, each checked value for value against the batch SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import hour_floor
from ..operators.joins import asof_join
from ..operators.metrics import ranking_metrics, to_long
from ..functions.labels import sigmoid, with_engagement_targets
from ..sources.bindings import EV, EV_ITEM, EV_SIGNALS, EV_USER, EV_USER_ITEM, bind_events, events_log, table
from ..streaming.replay import (
    RESERVED_KEY,
    account,
    drain_marker,
    in_arrival_order,
    new_dir,
    on_time,
    replay_source,
    run,
    served_stream,
    shards_for,
    unserved,
    view_stream,
    warm_state,
    with_ntz,
)
from ..streaming.sinks import EvalSink, HourReplay, LatestTableSink
from .catalog import register
from .queries_eval import ARM_START, BINARY, SCORED_SQL, _ALL_RANK, _logit_of, _r9, _ranking_sql, _latest_sql, _USER_SRC_SQL, _UFEAT
from .queries_features import _cum_cols, _roll_cols, _rolling_sql
from .sqlfrag import EV_SQL

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
DRAIN = {
    "event_id": RESERVED_KEY,
    "ts": dt.datetime(2200, 1, 1),
    "user_id": RESERVED_KEY,
    "event_type": "none",
    "value": 0.0,
    "props": '{"k": %d}' % RESERVED_KEY,
}


def ev_stream(spark, sf_dir, start: str | None = None, max_files_per_trigger: int | None = None, path: str | None = None):
    """The events table as a stream, plus the drain marker, bound to EV roles."""
    raw = replay_source(spark, path or sf_dir, EVENTS_SCHEMA, glob=None if path else "events.parquet", max_files_per_trigger=max_files_per_trigger)
    raw = raw.unionByName(replay_source(spark, drain_marker(spark, EVENTS_SCHEMA, DRAIN), EVENTS_SCHEMA))
    ev = bind_events(raw)
    if start is not None:
        ev = ev.filter((F.col("ts") >= F.lit(start).cast("timestamp_ntz")) | (F.col("event_id") == RESERVED_KEY))
    return ev


def _real(df, keys):
    cond = F.lit(True)
    for k in keys:
        cond = cond & ~F.col(k).eqNullSafe(F.lit(RESERVED_KEY))  # null keys are real
    return df.filter(cond)


def stream_view(spark, sf_dir, view, start=None, initial_state=None, path=None, max_files_per_trigger=None):
    s = view_stream(ev_stream(spark, sf_dir, start, max_files_per_trigger, path), EV, view, initial_state=initial_state)
    out = new_dir(spark, "stream-out")
    run(s, out=out)
    return _real(with_ntz(on_time(spark.read.parquet(out))), view.keys)


@register("stream_rolling_user", _rolling_sql(EV_SQL, ["event_id"], ["user_id"], EV_SIGNALS, 7))
def _stream_user(spark, sf_dir):
    """S1 + S3: the user view folded on a stream equals the batch window."""
    return stream_view(spark, sf_dir, EV_USER).select("event_id", "user_id", "ts", *[c.name for c in EV.cols(EV_USER)])


@register(
    "stream_running_count",
    f"SELECT event_id, video_id, ts, {_roll_cols(['video_id'], EV_SIGNALS, 7)}, {_cum_cols(['video_id'], ['is_click'])} FROM {EV_SQL}",
)
def _stream_item(spark, sf_dir):
    """S1 + S2: the item view (rolling means and the running click count)."""
    return stream_view(spark, sf_dir, EV_ITEM).select("event_id", "video_id", "ts", *[c.name for c in EV.cols(EV_ITEM)])


@register(
    "stream_warm_start",
    f"SELECT * FROM ({_rolling_sql(EV_SQL, ['event_id'], ['user_id'], EV_SIGNALS, 7)}) WHERE ts >= TIMESTAMP '{ARM_START}'",
)
def _stream_warm(spark, sf_dir):
    """State seeded in batch from the history before the arm; only the arm is streamed."""
    log = events_log(spark, sf_dir)
    arm_start_us = int((dt.datetime.fromisoformat(ARM_START) - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    init = warm_state(log, EV, EV_USER, upto_us=arm_start_us)
    out = stream_view(spark, sf_dir, EV_USER, start=ARM_START, initial_state=init)
    return out.select("event_id", "user_id", "ts", *[c.name for c in EV.cols(EV_USER)])


@register("stream_latest_user", _latest_sql(_USER_SRC_SQL, ["user_id"], _UFEAT))
def _stream_latest(spark, sf_dir):
    """The online latest table kept by a foreachBatch sink."""
    s = on_time(view_stream(ev_stream(spark, sf_dir), EV, EV_USER))
    s = with_ntz(s).drop("ts_us", "event_id")
    sink = LatestTableSink(spark, new_dir(spark, "latest"), ["user_id"], "ts", _UFEAT)
    run(s, [sink])
    return _real(sink.read(), ["user_id"]).select("user_id", "ts", *_UFEAT)


@register(
    "stream_hourly_latest",
    f"""SELECT user_id, hour, ts, {', '.join(_UFEAT)} FROM (
      SELECT *, date_trunc('hour', ts) AS hour, row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts DESC) AS __rn
      FROM {_USER_SRC_SQL}) WHERE __rn = 1""",
)
def _stream_hourly(spark, sf_dir):
    """Newest served value per user and hour (what an hourly push writes)."""
    s = with_ntz(on_time(view_stream(ev_stream(spark, sf_dir), EV, EV_USER))).withColumn("hour", hour_floor("ts"))
    sink = LatestTableSink(spark, new_dir(spark, "hourly"), ["user_id", "hour"], "ts", _UFEAT)
    run(s.drop("ts_us", "event_id"), [sink])
    return _real(sink.read(), ["user_id"]).select("user_id", "hour", "ts", *_UFEAT)


@register(
    "freshness_lag",
    "SELECT e.event_id, e.user_id, e.ts, epoch_us(e.ts) - epoch_us(s.ts) AS freshness_lag_us "
    "FROM events e ASOF LEFT JOIN events s ON e.user_id = s.user_id AND e.ts > s.ts",
)
def _freshness(spark, sf_dir):
    """Age of the served value at read time -- the value refreshes only on
    the user's previous event, so the lag is the time since it (strict as-of)."""
    log = events_log(spark, sf_dir).select("event_id", "user_id", "ts", "ts_us")
    src = log.select("user_id", "ts_us", F.lit(1).alias("__seen"))
    out = asof_join(log, src, ["user_id"], ["__seen"], strict=True, matched_ts="__mts")
    return out.select("event_id", "user_id", "ts", (F.col("ts_us") - F.col("__mts")).alias("freshness_lag_us"))


def _labelled(served, labels):
    """Served rows with their labels. Spark guesses the size of a fold's rows from the
    micro-batch's new files: a batch that only moves the watermark looks empty and would
    be broadcast through the driver, with all that the fold held. So the join is named."""
    return served.join(labels.hint("merge"), "event_id")


@register("stream_eval_metrics", _ranking_sql(_ALL_RANK))
def _stream_eval(spark, sf_dir):
    """Every micro-batch of served features is scored (stream-static
    join to the labels) and appended by a foreachBatch sink; the metrics run once
    over all appended batches."""
    from ..streaming.replay import parquet_append_sink

    labels = with_engagement_targets(events_log(spark, sf_dir)).select("event_id", *EV_SIGNALS, "is_skip")
    served = on_time(view_stream(ev_stream(spark, sf_dir), EV, EV_USER))
    scored = _labelled(served, labels).withColumns({f"score_{t}": sigmoid(_logit_of(t)) for t in BINARY})
    path = new_dir(spark, "scored")
    run(scored, [parquet_append_sink(path)])
    return _r9(ranking_metrics(to_long(spark.read.parquet(path), BINARY)), _ALL_RANK)


@register(
    "stream_online_source",
    f"""WITH lt AS ({_latest_sql(_USER_SRC_SQL, ['user_id'], _UFEAT, f"WHERE ts < TIMESTAMP '{ARM_START}'")})
    SELECT e.event_id, e.user_id, e.ts, {', '.join(f'coalesce(lt.{c}, 0.0) AS {c}' for c in _UFEAT)},
           epoch_us(e.ts) - epoch_us(lt.ts) AS served_age_us
    FROM events e LEFT JOIN lt USING (user_id) WHERE e.ts >= TIMESTAMP '{ARM_START}'""",
)
def _stream_online(spark, sf_dir):
    """S10(b) + S12: serve the arm's events from the online table (materialised
    from history before the arm) with a stream-static left join; the values are
    as stale as the table, which ``served_age_us`` reports."""
    from ..functions.timecols import epoch_micros
    from ..operators.latest import materialize, online_lookup
    from ..operators.windows import view_source

    src = view_source(events_log(spark, sf_dir), EV, EV_USER)
    latest = materialize(src, ["user_id"], "ts", _UFEAT, end=ARM_START).withColumnRenamed("ts", "served_ts")
    latest = latest.withColumn("served_us", epoch_micros(latest, "served_ts")).drop("served_ts")
    req = ev_stream(spark, sf_dir, start=ARM_START).select("event_id", "user_id", "ts", "ts_us")
    served = online_lookup(req.join(latest.select("user_id", "served_us"), "user_id", "left"), {("user_id",): latest.drop("served_us")}, _UFEAT)
    served = served.withColumn("served_age_us", F.col("ts_us") - F.col("served_us"))
    out = new_dir(spark, "served")
    run(served.select("event_id", "user_id", "ts", *_UFEAT, "served_age_us"), out=out)
    return _real(spark.read.parquet(out), ["user_id"])


# -- several micro-batches, late and keyless rows ---------------------------------------
N_FILES, DELAY_US, LAG_MS = 4, 3 * 86_400_000_000, 3_600_000
#: Every tenth event arrives three days after its time.
ARRIVAL = f"(__us + CASE WHEN event_id % 10 = 0 THEN {DELAY_US} ELSE 0 END)"


def arrived(spark, sf_dir, n_files: int = N_FILES, arrival: str = "__us", user: str = "user_id"):
    """The events table as ``n_files`` files by arrival time, and its path with the drain
    marker as the newest file."""
    from ..functions.timecols import epoch_micros

    raw = table(spark, sf_dir, "events").select(*EVENTS_SCHEMA.names).withColumn("user_id", F.expr(user))
    timed = raw.withColumn("__us", epoch_micros(raw, "ts")).withColumn("__at", F.expr(arrival))
    lo, hi = timed.agg(F.min("__at"), F.max("__at")).first()
    path = new_dir(spark, "arrived")
    if lo is not None:
        in_arrival_order(timed, F.expr(f"((__at - {lo}) * {n_files}) div ({hi} - {lo} + 1)"), path, EVENTS_SCHEMA.names)
    drain_marker(spark, EVENTS_SCHEMA, DRAIN, into=path)
    return raw, path


def _replayed(spark, path):
    return bind_events(replay_source(spark, path, EVENTS_SCHEMA, max_files_per_trigger=1))


def _arrived_sql(arrival: str) -> str:
    """Events with ``late``: behind the greatest time of earlier files less the lag."""
    return f"""(SELECT *, coalesce(__us <= (seen // 1000 - {LAG_MS}) * 1000, false) AS late FROM (
      SELECT * FROM (SELECT *, ((__at - min(__at) OVER ()) * {N_FILES}) // (max(__at) OVER () - min(__at) OVER () + 1) AS f FROM (SELECT *, {arrival} AS __at FROM (SELECT *, epoch_us(ts) AS __us FROM {EV_SQL})))
      LEFT JOIN (SELECT f, max(max(__us)) OVER (ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM (
        SELECT __us, ((__at - min(__at) OVER ()) * {N_FILES}) // (max(__at) OVER () - min(__at) OVER () + 1) AS f FROM (SELECT *, {arrival} AS __at FROM (SELECT *, epoch_us(ts) AS __us FROM {EV_SQL}))) GROUP BY f) USING (f)))"""


def _with_late_rows(spark, sf_dir):
    raw, path = arrived(spark, sf_dir, arrival=ARRIVAL)
    out = new_dir(spark, "stream-late")
    q = run(view_stream(_replayed(spark, path), EV, EV_USER), out=out)
    log, got = bind_events(raw), _real(spark.read.parquet(out), ["user_id"])
    account(q, log, got, EV_USER.keys)
    return log, got


@register("stream_late_rows", f"SELECT event_id, user_id, ts FROM {_arrived_sql(ARRIVAL)} WHERE late")
def _stream_late(spark, sf_dir):
    """Rows behind the watermark, whether the fold saw them or Spark dropped them
    before it; input = on time + late, checked against Spark's own count."""
    log, got = _with_late_rows(spark, sf_dir)
    return with_ntz(unserved(log, got, EV_USER.keys)).select("event_id", "user_id", "ts")


@register("stream_on_time_rows", _rolling_sql(f"(SELECT * FROM {_arrived_sql(ARRIVAL)} WHERE NOT late)", ["event_id"], ["user_id"], EV_SIGNALS, 7))
def _stream_on_time(spark, sf_dir):
    """Rows in time get the batch values over the rows in time."""
    _, got = _with_late_rows(spark, sf_dir)
    return with_ntz(on_time(got)).select("event_id", "user_id", "ts", *[c.name for c in EV.cols(EV_USER)])


_NULL_USER = "CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id END"


@register(
    "stream_null_key",
    _rolling_sql(f"(SELECT * REPLACE ({_NULL_USER} AS user_id) FROM {EV_SQL})", ["event_id"], ["user_id"], EV_SIGNALS, 7),
)
def _stream_null_key(spark, sf_dir):
    """S1 over four micro-batches; events without a user are one key."""
    _, path = arrived(spark, sf_dir, user=_NULL_USER)
    out = new_dir(spark, "stream-null")
    run(view_stream(_replayed(spark, path), EV, EV_USER), out=out)
    return _real(with_ntz(on_time(spark.read.parquet(out))), ["user_id"]).select("event_id", "user_id", "ts", *[c.name for c in EV.cols(EV_USER)])


_ALL_VIEWS_SQL = ", ".join(f"{_roll_cols(list(v.keys), EV_SIGNALS, 7)}" for v in EV.views) + ", " + _cum_cols(["video_id"], ["is_click"])


@register("stream_served_row", f"SELECT event_id, user_id, video_id, ts, {_ALL_VIEWS_SQL} FROM {EV_SQL}")
def _stream_served(spark, sf_dir):
    """One row per event with all three views' features in contract order, from three
    folds joined on the stream, over several micro-batches."""
    _, path = arrived(spark, sf_dir, n_files=3)
    out = new_dir(spark, "served-row")
    run(served_stream(_replayed(spark, path), EV, shards=shards_for(spark)), out=out)
    return _real(with_ntz(on_time(spark.read.parquet(out))), ["user_id"]).select("event_id", "user_id", "video_id", "ts", *EV.served)


def _latest_of(view):
    """The view's online table, kept over several micro-batches."""

    def q(spark, sf_dir):
        _, path = arrived(spark, sf_dir)
        keys, feats = list(view.keys), [c.name for c in EV.cols(view)]
        sink = LatestTableSink(spark, new_dir(spark, "latest"), keys, "ts", feats, buckets=16)
        run(with_ntz(on_time(view_stream(_replayed(spark, path), EV, view))).drop("ts_us", "event_id"), [sink])
        return _real(sink.read(), keys).select(*keys, "ts", *feats)

    return q


def _view_sql(view) -> tuple[str, list[str]]:
    keys = list(view.keys)
    cum = EV.cumulative.get(view.name, ())
    cols = _roll_cols(keys, EV_SIGNALS, 7) + (", " + _cum_cols(keys, cum) if cum else "")
    return f"(SELECT {', '.join(keys)}, ts, {cols} FROM {EV_SQL})", [c.name for c in EV.cols(view)]


for _name, _view in (("stream_latest_item", EV_ITEM), ("stream_latest_user_item", EV_USER_ITEM)):
    register(_name, _latest_sql(_view_sql(_view)[0], list(_view.keys), _view_sql(_view)[1]))(_latest_of(_view))


# -- S6/S7/S9/D12: one replay, two sinks, hours ------------------------------------------


def _hourly_ranking_sql() -> str:
    long = " UNION ALL ".join(
        f"SELECT '{t}' AS target, {hour} AS hour, CAST({t} AS DOUBLE) AS y_true, score_{t} AS y_score FROM {SCORED_SQL} WHERE {t} IS NOT NULL"
        for t in BINARY
        for hour in ("CAST(date_trunc('hour', ts) AS TIMESTAMP)", "CAST(NULL AS TIMESTAMP)")
    )
    return f"""WITH c AS (SELECT target, hour, y_score, sum(CASE WHEN y_true >= 0.5 THEN 1 ELSE 0 END) AS p, sum(CASE WHEN y_true >= 0.5 THEN 0 ELSE 1 END) AS n FROM ({long}) GROUP BY ALL),
      r AS (SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM c WINDOW w AS (PARTITION BY target, hour ORDER BY y_score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
      g AS (SELECT target, hour, sum(p) AS P, sum(n) AS N, sum(n * (tp - p / 2.0)) AS auc, sum(p * tp / (tp + fp)) AS ap, sum(CASE WHEN y_score >= 0.5 THEN p ELSE 0 END) AS tp5,
        sum(CASE WHEN y_score >= 0.5 THEN p + n ELSE 0 END) AS pp5 FROM r GROUP BY target, hour)
    SELECT target, hour, round(CASE WHEN P > 0 AND N > 0 THEN auc / (P * N) END, 9) AS roc_auc, round(CASE WHEN P > 0 AND N > 0 THEN ap / P END, 9) AS recall_precision_auc,
      round(CASE WHEN P > 0 AND N > 0 AND pp5 > 0 THEN tp5 / pp5 END, 9) AS precision, round(CASE WHEN P > 0 AND N > 0 THEN tp5 / P END, 9) AS recall FROM g"""


def _write_and_eval(spark, sf_dir):
    """One replay of the user view feeding the online table and the evaluation."""
    _, path = arrived(spark, sf_dir)
    labels = with_engagement_targets(events_log(spark, sf_dir)).select("event_id", *EV_SIGNALS, "is_skip")
    served = with_ntz(on_time(view_stream(_replayed(spark, path), EV, EV_USER)))
    scored = _labelled(served, labels).withColumns({f"score_{t}": sigmoid(_logit_of(t)) for t in BINARY})
    at = new_dir(spark, "write-and-eval")
    table_sink = LatestTableSink(spark, f"{at}/latest", ["user_id"], "ts", _UFEAT, buckets=16)
    eval_sink = EvalSink(spark, f"{at}/eval", lambda rows: to_long(rows, BINARY, keep=["hour"]))
    replay = HourReplay(spark, at, [table_sink, eval_sink])
    run(scored, [replay])
    replay.done()
    return table_sink, eval_sink


@register("stream_write_and_eval", _hourly_ranking_sql())
def _stream_write_and_eval(spark, sf_dir):
    """Metrics per closed hour and, with hour NULL, of the whole replay,
    from counts added up batch by batch."""
    _, sink = _write_and_eval(spark, sf_dir)
    both = sink.per_hour().unionByName(sink.total().withColumn("hour", F.lit(None).cast("timestamp")))
    return _r9(both, _ALL_RANK).select("target", F.col("hour").cast("timestamp_ntz").alias("hour"), *_ALL_RANK)


@register("stream_write_and_eval_latest", _latest_sql(_USER_SRC_SQL, ["user_id"], _UFEAT))
def _stream_write_and_eval_latest(spark, sf_dir):
    """What the same replay's other sink left in the online table."""
    return _write_and_eval(spark, sf_dir)[0].read().select("user_id", "ts", *_UFEAT)
