"""DuckDB SQL fragments for the oracle side of the catalog (bindings as SQL)."""

from __future__ import annotations

from ..sources.bindings import EV_SIGNALS, EV_TYPES

EV_SQL = (
    "(SELECT event_id, ts, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS video_id, "
    + ", ".join(f"CAST(event_type = '{t}' AS INTEGER) AS {s}" for t, s in zip(EV_TYPES, EV_SIGNALS))
    + ", CAST(round(value * 1000) AS BIGINT) AS play_time_ms"
    + ", CAST(json_extract_string(props, '$.k') AS BIGINT) * 1000 AS duration_ms FROM events)"
)

LI_SQL = (
    "(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_shipdate AS ts, "
    "o_custkey AS user_id, l_suppkey AS author_id, l_partkey AS video_id, "
    "CAST(l_returnflag = 'R' AS INTEGER) AS is_returned, CAST(l_linestatus = 'O' AS INTEGER) AS is_open "
    "FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)"
)


def range_frame(keys: list[str], days: int) -> str:
    return (
        f"(PARTITION BY {', '.join(keys)} ORDER BY ts RANGE BETWEEN INTERVAL {days} DAYS PRECEDING "
        f"AND INTERVAL 1 MICROSECOND PRECEDING)"
    )


def prior_frame(keys: list[str]) -> str:
    return f"(PARTITION BY {', '.join(keys)} ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)"
