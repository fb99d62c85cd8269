"""Catalog: feature computation queries (windows, joins, labels, hashing, sampling).

EV = the events log, LI = lineitem joined to orders (see ``sources.bindings``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import murmur3_sql, with_hash_bucket
from ..functions.labels import completion, with_engagement_targets, with_masks
from ..functions.timecols import hour_floor, time_slice
from ..operators.buckets import bucket_size_map, bucket_sizes
from ..operators.joins import asof_join, attach_lookup, first_unmatched, unmatched_keys
from ..operators.sampling import SEED, neg_sample_exact, neg_sample_hash
from ..operators.windows import cumulative_sum, keys_fit, rolling_mean, view_source, with_history
from ..registry import CUMULATIVE, DAY_US, ROLLING, feature_name
from ..sources.io import write_table
from ..sources.bindings import (
    EV,
    EV_ITEM,
    EV_SIGNALS,
    LI,
    LI_EVENT_ID,
    LI_SIGNALS,
    events_log,
    lineitem_log,
    table,
)
from .catalog import register
from .sqlfrag import EV_SQL, LI_SQL, prior_frame, range_frame
from .training import training_table, training_table_asof

EV_IDS = ["event_id"]
LI_IDS = list(LI_EVENT_ID)
ARM_START = "2024-01-16 00:00:00"
SLICE_START, SLICE_END = "2024-01-08 00:00:00", "2024-01-15 00:00:00"


def _roll_cols(keys, signals, days):
    return ", ".join(f"avg({s}) OVER {range_frame(keys, days)} AS {feature_name(s, ROLLING, keys)}" for s in signals)


def _cum_cols(keys, signals):
    return ", ".join(f"CAST(coalesce(sum({s}) OVER {prior_frame(keys)}, 0) AS BIGINT) AS {feature_name(s, CUMULATIVE, keys)}" for s in signals)


def _rolling_sql(src, ids, keys, signals, days, where=""):
    sel = ", ".join(dict.fromkeys([*ids, *keys]))
    return f"SELECT {sel}, ts, {_roll_cols(keys, signals, days)} FROM {src} {where}"


def _rolling_query(load, ids, keys, signals, window_us, strategy="sliced"):
    def q(spark, sf_dir):
        out = rolling_mean(load(spark, sf_dir), keys, signals, window_us, strategy=strategy)
        return out.select(*dict.fromkeys([*ids, *keys]), "ts", *[feature_name(s, ROLLING, keys) for s in signals])

    return q


def _item_log(spark, sf_dir):
    return lineitem_log(spark, sf_dir, user=False)


# -- E1 / E6: rolling means ------------------------------------------------------
for _name, _load, _ids, _keys, _sig, _days, _strategy in [
    ("rolling_user", events_log, EV_IDS, ["user_id"], EV_SIGNALS, 7, "sliced"),
    ("rolling_user_item", events_log, EV_IDS, ["user_id", "video_id"], EV_SIGNALS, 7, "sliced"),
    ("rolling_user_direct", events_log, EV_IDS, ["user_id"], EV_SIGNALS, 7, "direct"),
    ("rolling_prefix_item", events_log, EV_IDS, ["video_id"], EV_SIGNALS, 7, "prefix"),
    ("rolling_item_ties", _item_log, LI_IDS, ["video_id"], LI_SIGNALS, 365, "sliced"),
    ("rolling_item_ties_direct", _item_log, LI_IDS, ["video_id"], LI_SIGNALS, 365, "direct"),
    ("rolling_user_author_li", lineitem_log, LI_IDS, ["user_id", "author_id"], LI_SIGNALS, 365, "sliced"),
    ("rolling_user_split", events_log, EV_IDS, ["user_id"], EV_SIGNALS, 7, "split"),
    ("rolling_item_ties_split", _item_log, LI_IDS, ["video_id"], LI_SIGNALS, 365, "split"),
]:
    register(_name, _rolling_sql(EV_SQL if _load is events_log else LI_SQL, _ids, _keys, _sig, _days))(
        _rolling_query(_load, _ids, _keys, _sig, _days * DAY_US, _strategy)
    )


# -- E2: running counts ----------------------------------------------------------
def _cum_query(load, ids, keys, signals, strategy):
    def q(spark, sf_dir):
        out = cumulative_sum(load(spark, sf_dir), keys, signals, strategy=strategy, slice_us=7 * DAY_US)
        return out.select(*dict.fromkeys([*ids, *keys]), "ts", *[feature_name(s, CUMULATIVE, keys) for s in signals])

    return q


for _name, _load, _ids, _keys, _sig, _strategy in [
    ("cumulative_item", events_log, EV_IDS, ["video_id"], ["is_click"], "sliced"),
    ("cumulative_item_direct", events_log, EV_IDS, ["video_id"], ["is_click"], "direct"),
    ("cumulative_item_ties", _item_log, LI_IDS, ["video_id"], ["is_returned"], "sliced"),
    ("cumulative_item_ties_split", _item_log, LI_IDS, ["video_id"], ["is_returned"], "split"),
]:
    _sel = ", ".join(dict.fromkeys([*_ids, *_keys]))
    register(_name, f"SELECT {_sel}, ts, {_cum_cols(_keys, _sig)} FROM {EV_SQL if _load is events_log else LI_SQL}")(
        _cum_query(_load, _ids, _keys, _sig, _strategy)
    )


@register(
    "cumulative_item_sequence",
    f"SELECT {', '.join(LI_IDS)}, video_id, ts, CAST(coalesce(sum(is_returned) OVER (PARTITION BY video_id ORDER BY ts, "
    f"l_orderkey, l_linenumber, l_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS is_returned_seq_video_id FROM {LI_SQL}",
)
def _cum_sequence(spark, sf_dir):
    """E2 with ``ties="sequence"``: tied rows are ordered by an explicit tiebreak."""
    log = lineitem_log(spark, sf_dir).withColumn("__tb", F.struct("l_orderkey", "l_linenumber", "l_suppkey"))
    out = cumulative_sum(log, ["video_id"], ["is_returned"], names=["is_returned_seq_video_id"], ties="sequence", tiebreak="__tb")
    return out.select(*LI_IDS, "video_id", "ts", "is_returned_seq_video_id")


# -- E5: a whole view source (rolling + cumulative) ------------------------------
@register(
    "item_source",
    f"SELECT video_id, ts, {_roll_cols(['video_id'], EV_SIGNALS, 7)}, {_cum_cols(['video_id'], ['is_click'])} FROM {EV_SQL}",
)
def _item_source(spark, sf_dir):
    return view_source(events_log(spark, sf_dir), EV, EV_ITEM).drop("ts_us")


# -- G2: warm-up history + live arm ----------------------------------------------
@register(
    "warm_history_arm",
    f"SELECT * FROM ({_rolling_sql(EV_SQL, EV_IDS, ['user_id'], EV_SIGNALS, 7)}) WHERE ts >= TIMESTAMP '{ARM_START}'",
)
def _warm(spark, sf_dir):
    log = events_log(spark, sf_dir)
    history = time_slice(log, "ts", end=ARM_START)
    arm = time_slice(log, "ts", start=ARM_START)
    out = with_history(history, arm, lambda d: rolling_mean(d, ["user_id"], EV_SIGNALS, EV.window_us), lookback_us=EV.window_us)
    return out.select("event_id", "user_id", "ts", *[feature_name(s, ROLLING, ["user_id"]) for s in EV_SIGNALS])


# -- C1 / C7 / F3 / B3 / B9 --------------------------------------------------------
@register(
    "attach_lookup",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, p_brand FROM lineitem LEFT JOIN part ON l_partkey = p_partkey",
)
def _attach(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(*LI_IDS)
    part = table(spark, sf_dir, "part")
    return attach_lookup(li, part, "l_partkey", "p_brand", lookup_key="p_partkey")


@register(
    "attach_lookup_supplier",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, s_nationkey FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey",
)
def _attach_supp(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(*LI_IDS)
    return attach_lookup(li, table(spark, sf_dir, "supplier"), "l_suppkey", "s_nationkey", lookup_key="s_suppkey")


@register(
    "unmatched_keys",
    "SELECT event_id, user_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id AND c.c_acctbal > 0)",
)
def _unmatched(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id")
    positive = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 0)
    return unmatched_keys(ev, positive, "user_id", "c_custkey")


@register(
    "first_unmatched",
    "SELECT DISTINCT l_partkey FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 25) ORDER BY l_partkey LIMIT 10",
)
def _first_unmatched(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_partkey")
    big = table(spark, sf_dir, "part").filter(F.col("p_size") > 25)
    return first_unmatched(li, big, "l_partkey", "p_partkey")


@register(
    "time_slice",
    f"SELECT event_id, user_id, ts FROM events WHERE ts >= TIMESTAMP '{SLICE_START}' AND ts < TIMESTAMP '{SLICE_END}'",
)
def _slice(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return time_slice(ev, "ts", SLICE_START, SLICE_END)


@register("hourly_counts", "SELECT date_trunc('hour', ts) AS hour, count(*) AS n_events FROM events GROUP BY 1")
def _hourly(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.groupBy(hour_floor("ts").alias("hour")).agg(F.count(F.lit(1)).alias("n_events"))


# -- C2: as-of joins --------------------------------------------------------------
_UF = [feature_name(s, ROLLING, ["user_id"]) for s in EV_SIGNALS]
_PF = [feature_name(s, ROLLING, ["video_id"]) for s in LI_SIGNALS] + [feature_name("is_returned", CUMULATIVE, ["video_id"])]


def _ev_user_source(log):
    src = rolling_mean(log, ["user_id"], EV_SIGNALS, EV.window_us)
    return src.filter(F.col("is_click") == 1).select("user_id", "ts_us", *_UF)


def _asof_ev(strategy, ttl_us=None):
    def q(spark, sf_dir):
        log = events_log(spark, sf_dir)
        ent = log.select("event_id", "user_id", "ts", "ts_us")
        out = asof_join(ent, _ev_user_source(log), ["user_id"], _UF, ttl_us=ttl_us, strategy=strategy, slice_us=2 * DAY_US, matched_ts="__mts")
        return out.withColumn("feature_age_us", F.col("ts_us") - F.col("__mts")).drop("ts_us", "__mts")

    return q


def _asof_ev_sql(ttl_days=None):
    src = f"(SELECT user_id, ts, {_roll_cols(['user_id'], EV_SIGNALS, 7)}, is_click FROM {EV_SQL})"
    ok = "s.ts IS NOT NULL" + (f" AND s.ts >= e.ts - INTERVAL {ttl_days} DAYS" if ttl_days else "")
    vals = ", ".join(f"CASE WHEN {ok} THEN s.{c} END AS {c}" for c in _UF)
    return (
        f"SELECT e.event_id, e.user_id, e.ts, {vals}, CASE WHEN {ok} THEN epoch_us(e.ts) - epoch_us(s.ts) END AS feature_age_us "
        f"FROM events e ASOF LEFT JOIN (SELECT * FROM {src} WHERE is_click = 1) s ON e.user_id = s.user_id AND e.ts >= s.ts"
    )


register("asof_user", _asof_ev_sql())(_asof_ev("sliced"))
register("asof_user_direct", _asof_ev_sql())(_asof_ev("direct"))
register("asof_ttl", _asof_ev_sql(2))(_asof_ev("sliced", 2 * DAY_US))


def _asof_li(strict):
    def q(spark, sf_dir):
        log = _item_log(spark, sf_dir)
        whole = keys_fit(log, ["video_id"], "ts_us")  # then one shuffle, without copies of rows
        src = rolling_mean(log, ["video_id"], LI_SIGNALS, LI.window_us, strategy="prefix" if whole else "sliced")
        src = cumulative_sum(src, ["video_id"], ["is_returned"], strategy="direct" if whole else "sliced").filter(F.col("is_returned") == 1)
        ent = log.select(*LI_IDS, "video_id", "ts", "ts_us")
        out = asof_join(ent, src.select("video_id", "ts_us", *_PF), ["video_id"], _PF, strict=strict, ttl_us=LI.views[2].ttl_us, slice_us=90 * DAY_US)
        return out.drop("ts_us")

    return q


def _asof_li_sql(strict):
    src = f"(SELECT video_id, ts, is_returned, {_roll_cols(['video_id'], LI_SIGNALS, 365)}, {_cum_cols(['video_id'], ['is_returned'])} FROM {LI_SQL})"
    op = ">" if strict else ">="
    ok = "s.ts IS NOT NULL AND s.ts >= e.ts - INTERVAL 365 DAYS"
    vals = ", ".join(f"CASE WHEN {ok} THEN s.{c} END AS {c}" for c in _PF)
    return (
        f"SELECT {', '.join('e.' + c for c in LI_IDS)}, e.video_id, e.ts, {vals} FROM {LI_SQL} e "
        f"ASOF LEFT JOIN (SELECT * FROM {src} WHERE is_returned = 1) s ON e.video_id = s.video_id AND e.ts {op} s.ts"
    )


register("asof_item_li", _asof_li_sql(False))(_asof_li(False))
register("asof_strict", _asof_li_sql(True))(_asof_li(True))


# -- H1-H3, B7: labels ---------------------------------------------------------------
_SKIP_SQL = (
    "CASE WHEN duration_ms > 0 THEN CASE WHEN least(play_time_ms / duration_ms, 1.0) < 0.5 AND play_time_ms < 5000 "
    "THEN 1.0 ELSE 0.0 END END"
)
_DWELL_SQL = "CASE WHEN duration_ms > 0 AND play_time_ms IS NOT NULL THEN round(ln(1 + least(play_time_ms, 2 * duration_ms)), 9) END"
_COMPLETION_SQL = "round(CASE WHEN duration_ms > 0 THEN least(play_time_ms / duration_ms, 1.0) END, 9)"


@register(
    "engagement_labels",
    f"SELECT event_id, play_time_ms, duration_ms, {_COMPLETION_SQL} AS completion, {_SKIP_SQL} AS is_skip, {_DWELL_SQL} AS dwell_log FROM {EV_SQL}",
)
def _labels(spark, sf_dir):
    log = events_log(spark, sf_dir).select("event_id", "play_time_ms", "duration_ms")
    out = with_engagement_targets(log).withColumn("completion", F.round(completion(), 9))
    return out.withColumn("dwell_log", F.round("dwell_log", 9))


@register(
    "label_masks",
    f"SELECT event_id, {', '.join(s + ' IS NOT NULL AS ' + s + '_valid' for s in EV_SIGNALS)}, ({_SKIP_SQL}) IS NOT NULL AS is_skip_valid, "
    f"({_DWELL_SQL}) IS NOT NULL AS dwell_log_valid FROM {EV_SQL}",
)
def _masks(spark, sf_dir):
    log = with_engagement_targets(events_log(spark, sf_dir))
    return with_masks(log, [*EV_SIGNALS, "is_skip", "dwell_log"]).select("event_id", *[f"{t}_valid" for t in [*EV_SIGNALS, "is_skip", "dwell_log"]])


# -- H4-H7, D1: hashing and bucket sizes ---------------------------------------------
def _np2_sql(n: str) -> str:
    return f"(CASE WHEN {n} <= 1 THEN 1 ELSE CAST(1 AS BIGINT) << length(bin({n} - 1)) END)"


_SIZES_SQL = f"(SELECT {_np2_sql('4 * count(DISTINCT user_id)')} AS nu, {_np2_sql('4 * count(DISTINCT video_id)')} AS nv FROM {EV_SQL})"


def _bucketed_ev_sql(src: str) -> str:
    inner = murmur3_sql(src, "user_id", "__hu")
    return murmur3_sql(f"({inner})", "video_id", "__hv")


_BUCKET_COLS_SQL = (
    "CAST(CASE WHEN __hu IS NULL THEN 0 ELSE __hu % (sz.nu - 1) + 1 END AS INTEGER) AS user_id_bucket, "
    "CAST(CASE WHEN __hv IS NULL THEN 0 ELSE __hv % (sz.nv - 1) + 1 END AS INTEGER) AS video_id_bucket"
)


@register(
    "hash_buckets",
    f"SELECT event_id, user_id, video_id, {_BUCKET_COLS_SQL} FROM ({_bucketed_ev_sql(EV_SQL)}) h, {_SIZES_SQL} sz",
)
def _hash_buckets(spark, sf_dir):
    log = events_log(spark, sf_dir)
    sizes = bucket_size_map(log, ["user_id", "video_id"])
    out = log.select("event_id", "user_id", "video_id")
    for c in ["user_id", "video_id"]:
        out = with_hash_bucket(out, c, sizes[c])
    return out


@register(
    "murmur3_ids",
    murmur3_sql("(SELECT c_custkey FROM customer)", "c_custkey", "murmur3", keep="c_custkey"),
)
def _murmur(spark, sf_dir):
    from ..functions.hashing import with_murmur3

    return with_murmur3(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", "murmur3", engine="expr")


@register(
    "murmur3_ids_arrow",
    murmur3_sql("(SELECT l_orderkey FROM lineitem)", "l_orderkey", "murmur3", keep="l_orderkey"),
)
def _murmur_arrow(spark, sf_dir):
    from ..functions.hashing import with_murmur3

    return with_murmur3(table(spark, sf_dir, "lineitem").select("l_orderkey"), "l_orderkey", "murmur3")


@register(
    "bucket_sizes",
    f"SELECT id_column, n_distinct, {_np2_sql('4 * n_distinct')} AS n_buckets FROM ("
    f"SELECT 'user_id' AS id_column, CAST(count(DISTINCT user_id) AS BIGINT) AS n_distinct FROM {EV_SQL} UNION ALL "
    f"SELECT 'video_id', CAST(count(DISTINCT video_id) AS BIGINT) FROM {EV_SQL})",
)
def _bucket_sizes(spark, sf_dir):
    return bucket_sizes(events_log(spark, sf_dir), ["user_id", "video_id"])


# -- B10 / B11: negative sampling ------------------------------------------------------
# Engagement signals of the sampling queries: a click or a purchase protects a row.
ENGAGED = ("is_click", "is_purchase")
_NEG_SQL = " + ".join(f"coalesce({s}, 0)" for s in ENGAGED) + " = 0"


@register(
    "neg_sample_exact",
    f"""WITH b AS (SELECT *, {_NEG_SQL} AS neg, md5(concat_ws('|', CAST(event_id AS VARCHAR), '{SEED}')) AS h FROM {EV_SQL}),
    n AS (SELECT CAST(floor(count(*) * 0.5) AS BIGINT) AS k FROM b WHERE neg)
    SELECT event_id, user_id, {', '.join(EV_SIGNALS)} FROM b WHERE NOT neg
    UNION ALL
    SELECT event_id, user_id, {', '.join(EV_SIGNALS)} FROM (SELECT *, row_number() OVER (ORDER BY h, event_id) AS r FROM b WHERE neg) x, n WHERE r <= n.k""",
)
def _neg_exact(spark, sf_dir):
    log = events_log(spark, sf_dir).select("event_id", "user_id", *EV_SIGNALS)
    return neg_sample_exact(log, ENGAGED, ["event_id"], 0.5)


@register(
    "neg_sample_hash",
    f"SELECT event_id, user_id, {', '.join(EV_SIGNALS)} FROM {EV_SQL} WHERE NOT ({_NEG_SQL}) OR "
    f"CAST(('0x' || substr(md5(concat_ws('|', CAST(event_id AS VARCHAR), '{SEED}')), 1, 8)) AS BIGINT) < {int(0.5 * 16**8)}",
)
def _neg_hash(spark, sf_dir):
    log = events_log(spark, sf_dir).select("event_id", "user_id", *EV_SIGNALS)
    return neg_sample_hash(log, ENGAGED, ["event_id"], 0.5)


# -- The training table (flagship) and its as-of twin ------------------------------------
def _training_sql() -> str:
    views = [["user_id"], ["user_id", "video_id"], ["video_id"]]
    feats = ", ".join(_roll_cols(k, EV_SIGNALS, 7) for k in views)
    return (
        f"SELECT event_id, ts, user_id, video_id, {', '.join(EV_SIGNALS)}, play_time_ms, duration_ms, "
        f"{_SKIP_SQL} AS is_skip, {_DWELL_SQL} AS dwell_log, {_BUCKET_COLS_SQL}, {feats}, {_cum_cols(['video_id'], ['is_click'])} "
        f"FROM ({_bucketed_ev_sql(EV_SQL)}) h, {_SIZES_SQL} sz"
    )


def _training(fn, strategy):
    def q(spark, sf_dir):
        out = fn(events_log(spark, sf_dir), EV, strategy=strategy)
        return out.withColumn("dwell_log", F.round("dwell_log", 9))

    return q


register("training_table", _training_sql())(_training(training_table, "auto"))
register("training_table_sliced", _training_sql())(_training(training_table, "sliced"))
register("training_table_direct", _training_sql())(_training(training_table, "direct"))
register("training_table_split", _training_sql())(_training(training_table, "split"))
@register("training_table_asof", _training_sql())
def _training_asof(spark, sf_dir):
    """Feature-store path: sources built and stored under the shared checkpoint
    folder (A5), read back and as-of joined onto the impressions (C2-C4)."""
    from ..streaming.replay import new_dir

    out = training_table_asof(events_log(spark, sf_dir), EV, store_path=new_dir(spark, "sources"))
    return out.withColumn("dwell_log", F.round("dwell_log", 9))


def _training_li_sql() -> str:
    views = [["user_id"], ["user_id", "author_id"], ["video_id"]]
    feats = ", ".join(_roll_cols(k, LI_SIGNALS, 365) for k in views)
    inner = murmur3_sql(LI_SQL, "user_id", "__hu")
    inner = murmur3_sql(f"({inner})", "author_id", "__ha")
    sizes = f"(SELECT {_np2_sql('4 * count(DISTINCT user_id)')} AS nu, {_np2_sql('4 * count(DISTINCT author_id)')} AS na FROM {LI_SQL})"
    return (
        f"SELECT {', '.join(LI_IDS)}, ts, user_id, author_id, video_id, {', '.join(LI_SIGNALS)}, "
        "CAST(CASE WHEN __hu IS NULL THEN 0 ELSE __hu % (sz.nu - 1) + 1 END AS INTEGER) AS user_id_bucket, "
        "CAST(CASE WHEN __ha IS NULL THEN 0 ELSE __ha % (sz.na - 1) + 1 END AS INTEGER) AS author_id_bucket, "
        f"{feats}, {_cum_cols(['video_id'], ['is_returned'])} FROM ({inner}) h, {sizes} sz"
    )


@register("training_table_li", _training_li_sql())
def _training_li(spark, sf_dir):
    return training_table(lineitem_log(spark, sf_dir), LI)


@register("training_table_li_asof", _training_li_sql())
def _training_li_asof(spark, sf_dir):
    from ..streaming.replay import new_dir

    # Sources, sizes and impressions read the log again and again: its join is stored once.
    path = new_dir(spark, "log")
    write_table(lineitem_log(spark, sf_dir), path)
    return training_table_asof(spark.read.parquet(path), LI, store_path=new_dir(spark, "sources"))


# -- A6 / A7: stored training table read back by time range, sampled, zero-filled ------------
READ_START, READ_END = "2024-01-05 00:00:00", "2024-01-25 00:00:00"


def _read_training_sql(frac: float) -> str:
    feats = [c.name for c in EV.store_cols]
    sel = f"event_id, ts, {', '.join(f'coalesce({c}, 0) AS {c}' for c in feats)}, user_id_bucket, video_id_bucket, is_skip, dwell_log, {', '.join(ENGAGED)}"
    base = f"(SELECT * FROM ({_training_sql()}) WHERE ts >= TIMESTAMP '{READ_START}' AND ts < TIMESTAMP '{READ_END}')"
    if frac >= 1.0:
        return f"SELECT {sel} FROM {base}"
    return f"""WITH b AS (SELECT *, {_NEG_SQL} AS neg, md5(concat_ws('|', CAST(event_id AS VARCHAR), '{SEED}')) AS h FROM {base}),
    n AS (SELECT CAST(floor(count(*) * {frac}) AS BIGINT) AS k FROM b WHERE neg)
    SELECT {sel} FROM b WHERE NOT neg
    UNION ALL
    SELECT {sel} FROM (SELECT *, row_number() OVER (ORDER BY h, event_id) AS r FROM b WHERE neg) x, n WHERE r <= n.k"""


def _read_training(frac: float):
    def q(spark, sf_dir):
        from ..sources.io import read_training, write_table
        from ..streaming.replay import new_dir

        path = new_dir(spark, "training")
        write_table(training_table(events_log(spark, sf_dir), EV).withColumn("dwell_log", F.round("dwell_log", 9)), path)
        return read_training(
            spark,
            path,
            features=[c.name for c in EV.store_cols],
            categorical=["user_id_bucket", "video_id_bucket"],
            targets=["is_skip", "dwell_log"],
            signals=list(ENGAGED),
            neg_keep_frac=frac,
            start=READ_START,
            end=READ_END,
        )

    return q


register("read_training_range", _read_training_sql(1.0))(_read_training(1.0))
register("read_training_sampled", _read_training_sql(0.5))(_read_training(0.5))
