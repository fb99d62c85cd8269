"""Catalog: impression logs in files, one-pass lookups, masked targets, time splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.labels import score_to_label
from ..functions.timecols import split_at, time_slice, zone_bound
from ..operators.joins import attach_observed
from ..operators.metrics import masked_bce, ranking_metrics, rmse, to_long
from ..operators.windows import cumulative_sum, with_history
from ..registry import CUMULATIVE, POS_WEIGHT, feature_name
from ..sources.bindings import EV, EV_SIGNALS, events_log, table
from ..sources.impressions import Splits, log_schema, quarantined, read_log, usable, write_log
from ..session import scratch_path
from .catalog import register
from .queries_eval import ARM_START, BINARY, SCORED_SQL, _ALL_RANK, _bce_sql, _r9, _ranking_sql, scored_events
from .queries_features import _cum_cols
from .sqlfrag import EV_SQL

LOG_SCHEMA = log_schema(EV_SIGNALS)
_SPLIT_SQL = f"CASE WHEN ts < TIMESTAMP '{ARM_START}' THEN 'train' ELSE 'test_standard' END"


def impression_splits(spark, sf_dir) -> Splits:
    """The events as an impression log in two CSV splits. Every fiftieth event has a time
    that is no number, the next one a signal of 7, the next no user."""
    import uuid

    ev = events_log(spark, sf_dir).withColumn("time_ms", F.expr("ts_us div 1000"))
    bad = lambda r: F.col("event_id") % 50 == r
    broken = ev.withColumn("time_ms", F.when(bad(0), F.concat(F.lit("x"), F.col("time_ms").cast("string"))).otherwise(F.col("time_ms").cast("string")))
    broken = broken.withColumn("is_click", F.when(bad(1), 7).otherwise(F.col("is_click"))).withColumn("user_id", F.when(~bad(2), F.col("user_id")))
    root = scratch_path(spark, f"impressions-{uuid.uuid4().hex}")
    train, test = split_at(broken, ARM_START)
    splits = Splits({"train": "log_train.csv", "test_standard": "log_standard.csv"}, root=root)
    for name, part in (("train", train), ("test_standard", test)):
        write_log(part, splits.paths(name)[0], LOG_SCHEMA)
    return splits


def _both(spark, sf_dir, pick):
    splits = impression_splits(spark, sf_dir)
    parts = [pick(read_log(spark, splits, s, LOG_SCHEMA, EV_SIGNALS)).withColumn("split", F.lit(s)) for s in splits.files]
    return parts[0].unionByName(parts[1])


@register(
    "impression_log",
    f"SELECT {_SPLIT_SQL} AS split, user_id, video_id, epoch_us(ts) // 1000 AS time_ms, {', '.join(EV_SIGNALS)}, play_time_ms, duration_ms, (epoch_us(ts) // 1000) * 1000 AS ts_us FROM {EV_SQL} WHERE event_id % 50 > 2",
)
def _impression_log(spark, sf_dir):
    """A1/A2/A4/B1: CSV splits with an explicit schema, the usable rows with event time."""
    return _both(spark, sf_dir, usable).select("split", *LOG_SCHEMA.names, "ts_us")


@register(
    "impression_quarantine",
    f"SELECT {_SPLIT_SQL} AS split, CASE event_id % 50 WHEN 0 THEN 'unparsed' WHEN 1 THEN 'is_click is not 0 or 1' ELSE 'no user_id' END AS reason, count(*) AS n FROM {EV_SQL} WHERE event_id % 50 <= 2 GROUP BY ALL",
)
def _impression_quarantine(spark, sf_dir):
    """A1: rows that do not fit the schema, kept and counted by reason."""
    return _both(spark, sf_dir, quarantined).groupBy("split", "reason").agg(F.count("*").alias("n"))


# -- C1 / C5 / C7 in one pass: a lookup with null values ---------------------------------
_LOOKUP_SQL = "(SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 THEN p_size END AS p_size FROM part)"


def _observed(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 9 != 0, F.col("p_size")).alias("p_size"))
    return attach_observed(events_log(spark, sf_dir).select("event_id", "video_id"), part, "video_id", "p_size", lookup_key="p_partkey")


@register("attach_observed", f"SELECT event_id, video_id, p_size FROM {EV_SQL} JOIN {_LOOKUP_SQL} ON video_id = p_partkey WHERE p_size IS NOT NULL")
def _attach_observed(spark, sf_dir):
    """Matched rows of a lookup join without a validation job before it."""
    return _observed(spark, sf_dir).matched


@register("lookup_quarantine", f"SELECT event_id, video_id FROM {EV_SQL} LEFT JOIN {_LOOKUP_SQL} ON video_id = p_partkey WHERE p_size IS NULL")
def _lookup_quarantine(spark, sf_dir):
    """Rows without a lookup row, or whose lookup value is null."""
    return _observed(spark, sf_dir).quarantine


@register(
    "lookup_report",
    f"SELECT count(*) AS n_before, count(*) AS n_after, count(*) FILTER (p_size IS NULL) AS misses, min(CASE WHEN p_size IS NULL THEN video_id END) AS least_unknown FROM {EV_SQL} LEFT JOIN {_LOOKUP_SQL} ON video_id = p_partkey",
)
def _lookup_report(spark, sf_dir):
    """What the join itself counted while an action ran through it."""
    got = _observed(spark, sf_dir)
    got.rows.write.format("noop").mode("overwrite").save()
    r = got.report()
    return spark.createDataFrame([(r.n_rows, r.n_keys, r.misses, r.first_misses[0] if r.first_misses else None)], "n_before long, n_after long, misses long, least_unknown long")


# -- D4 / D6 / D10 / D11 with a target that has no valid label ---------------------------
MASKED = "is_error"


def _masked_scores(spark, sf_dir):
    return scored_events(spark, sf_dir).withColumn(MASKED, F.lit(None).cast("int"))


@register(
    "masked_targets_metrics",
    f"SELECT * FROM ({_ranking_sql(_ALL_RANK)}) WHERE target <> '{MASKED}' UNION ALL SELECT '{MASKED}', NULL, NULL, NULL, NULL",
)
def _masked_metrics(spark, sf_dir):
    """A target named but without a valid label has a row of NULLs."""
    return _r9(ranking_metrics(to_long(_masked_scores(spark, sf_dir), BINARY), targets=BINARY), _ALL_RANK)


@register(
    "masked_targets_loss",
    "SELECT target, round(avg(loss), 9) AS loss FROM ("
    + " UNION ALL ".join(f"SELECT '{t}' AS target, {_bce_sql(f'CAST({t} AS DOUBLE)', f'logit_{t}', POS_WEIGHT)} AS loss FROM {SCORED_SQL} WHERE {t} IS NOT NULL" for t in BINARY if t != MASKED)
    + f") GROUP BY target UNION ALL SELECT '{MASKED}', 0.0",
)
def _masked_loss(spark, sf_dir):
    """A fully masked target's loss is 0 and counts in the mean over targets."""
    return _r9(masked_bce(to_long(_masked_scores(spark, sf_dir), BINARY, score="logit_{t}"), POS_WEIGHT, BINARY), ["loss"])


@register("masked_rmse", "SELECT 'dwell_log' AS target, CAST(NULL AS DOUBLE) AS rmse")
def _masked_rmse(spark, sf_dir):
    """NULL for a continuous target without a valid label."""
    none = scored_events(spark, sf_dir).withColumn("dwell_log", F.lit(None).cast("double"))
    return rmse(to_long(none, ["dwell_log"], score="pred_{t}"), ["dwell_log"])


# -- B12 / B14 / H8 / G2 -----------------------------------------------------------------
@register("score_labels", f"SELECT event_id, {', '.join(f'CAST(score_{t} >= 0.5 AS INTEGER) AS label_{t}' for t in BINARY)} FROM {SCORED_SQL}")
def _score_labels(spark, sf_dir):
    """Score >= 0.5 is a positive label."""
    return scored_events(spark, sf_dir).select("event_id", *[score_to_label(f"score_{t}").cast("int").alias(f"label_{t}") for t in BINARY])


@register("time_split", f"SELECT event_id, ts >= TIMESTAMP '{ARM_START}' AS valid FROM {EV_SQL}")
def _time_split(spark, sf_dir):
    """Complementary train and validation frames at a cutoff."""
    train, valid = split_at(events_log(spark, sf_dir), ARM_START)
    return train.select("event_id", F.lit(False).alias("valid")).unionByName(valid.select("event_id", F.lit(True).alias("valid")))


@register("zone_slice", f"SELECT event_id, ts FROM {EV_SQL} WHERE ts >= TIMESTAMP '2024-01-07 16:00:00' AND ts < TIMESTAMP '2024-01-14 16:00:00'")
def _zone_slice(spark, sf_dir):
    """H8: a half-open week by wall-clock bounds of another zone (UTC+8)."""
    bound = lambda at: zone_bound(at, "Asia/Shanghai")
    return time_slice(events_log(spark, sf_dir), "ts", bound("2024-01-08 00:00:00"), bound("2024-01-15 00:00:00")).select("event_id", "ts")


@register("warm_history_counts", f"SELECT * FROM (SELECT event_id, video_id, ts, {_cum_cols(['video_id'], ['is_click'])} FROM {EV_SQL}) WHERE ts >= TIMESTAMP '{ARM_START}'")
def _warm_counts(spark, sf_dir):
    """History cut to the window for the window features; running counts keep what
    was cut off as totals per key."""
    history, arm = split_at(events_log(spark, sf_dir), ARM_START)
    name = feature_name("is_click", CUMULATIVE, ["video_id"])
    out = with_history(history, arm, lambda d: cumulative_sum(d, ["video_id"], ["is_click"]), lookback_us=EV.window_us, totals={name: ("is_click", ["video_id"])})
    return out.select("event_id", "video_id", "ts", name)
