"""Bindings of the parquet tables to the impression-log roles (A1, A2, A4).

An impression log has: an event id, an event time ``ts`` (plus ``ts_us``,
epoch microseconds), ``user_id``, ``author_id``, ``video_id`` (the item),
binary signals and, optionally, ``play_time_ms`` / ``duration_ms``.

``EV`` binds the ``events`` table (one-hot event types as signals, the
``k`` property as the item, ``value`` seconds as play time and ``k`` seconds
as duration); ``LI`` binds ``lineitem`` joined to ``orders`` (customer as
user, supplier as author, part as item, ship date as time, return flag and
line status as signals). Both are full-table scans with pruned columns.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import with_event_time
from ..operators.joins import attach_lookup
from ..registry import DAY_US, FeatureView, Registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A1: scan one parquet table; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# -- EV: the events table ------------------------------------------------------
EV_SIGNALS = ("is_click", "is_view", "is_signup", "is_purchase", "is_error")
EV_TYPES = ("click", "view", "signup", "purchase", "error")
EV_USER = FeatureView("user_features", ("user_id",), ttl_us=None)
EV_USER_ITEM = FeatureView("user_item_features", ("user_id", "video_id"), ttl_us=None)
EV_ITEM = FeatureView("item_features", ("video_id",), ttl_us=None)
EV = Registry(
    signals=EV_SIGNALS,
    views=(EV_USER, EV_USER_ITEM, EV_ITEM),
    cumulative={EV_ITEM.name: ("is_click",)},
    bucket_sources=("user_id", "video_id"),
    window_us=7 * DAY_US,
)


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind_events(table(spark, sf_dir, "events"))


def bind_events(ev: DataFrame) -> DataFrame:
    """EV roles from a raw ``events`` frame -- batch or streaming alike."""
    k = F.get_json_object("props", "$.k").cast("long")
    df = ev.select(
        "event_id",
        "ts",
        "user_id",
        k.alias("video_id"),
        *[(F.col("event_type") == t).cast("int").alias(s) for t, s in zip(EV_TYPES, EV_SIGNALS)],
        F.round(F.col("value") * 1000).cast("long").alias("play_time_ms"),
        (k * 1000).alias("duration_ms"),
    )
    return with_event_time(df, "ts", "ts_us")


# -- LI: lineitem joined to orders ---------------------------------------------
LI_SIGNALS = ("is_returned", "is_open")
LI_USER = FeatureView("customer_features", ("user_id",), ttl_us=365 * DAY_US)
LI_USER_AUTHOR = FeatureView("customer_supplier_features", ("user_id", "author_id"), ttl_us=365 * DAY_US)
LI_ITEM = FeatureView("part_features", ("video_id",), ttl_us=365 * DAY_US)
LI = Registry(
    signals=LI_SIGNALS,
    views=(LI_USER, LI_USER_AUTHOR, LI_ITEM),
    cumulative={LI_ITEM.name: ("is_returned",)},
    window_us=365 * DAY_US,
)
LI_EVENT_ID = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


def lineitem_log(spark: SparkSession, sf_dir: str, validate: str = "raise", *, user: bool = True) -> DataFrame:
    """LI roles. ``user=False`` for features without the user: every order is looked up and
    checked all the same, but later passes over the log need not join it again."""
    li = table(spark, sf_dir, "lineitem").select(
        *LI_EVENT_ID,
        F.col("l_returnflag"),
        F.col("l_linestatus"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = attach_lookup(li, orders, "l_orderkey", "o_custkey", lookup_key="o_orderkey", mode=validate, used=user)
    df = li.select(
        *LI_EVENT_ID,
        F.col("l_shipdate").alias("ts"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_suppkey").alias("author_id"),
        F.col("l_partkey").alias("video_id"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_returned"),
        (F.col("l_linestatus") == "O").cast("int").alias("is_open"),
    )
    return with_event_time(df, "ts", "ts_us")
