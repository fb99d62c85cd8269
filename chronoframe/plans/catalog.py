"""The query catalog: every registered query (spark, sf_dir) -> DataFrame and,
where SQL can express it, the equivalent DuckDB SQL over the same tables.

Every query reads whole tables. Doubles whose summation order differs
between engines are rounded to 9 digits on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def _load_all() -> None:
    from . import queries_eval, queries_features, queries_heads, queries_sources, queries_stream  # noqa: F401  (registration side effects)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
