"""The offline training table (lifecycle 3.1): labels, hash buckets and every
view's point-in-time features on each impression.

``training_table`` computes the features directly on the log (each feature
excludes its own event, so this equals the as-of join back onto the same
log); ``training_table_asof`` builds the per-view source tables and as-of
joins them onto the impressions, the way a feature store serves history.
Both give the same rows -- the parity gate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.hashing import with_hash_bucket
from ..functions.labels import with_engagement_targets
from ..operators.buckets import bucket_size_map
from ..operators.joins import asof_features
from ..operators.windows import auto_strategies, cumulative_sum, has_integral, rolling_mean, split_join_views, split_view_tables, view_source
from ..registry import CUMULATIVE, ROLLING, Registry


def with_buckets(df: DataFrame, registry: Registry, sizes: dict[str, int] | None = None, source: DataFrame | None = None) -> DataFrame:
    """H6: ``{col}_bucket`` for every bucketed id; sizes from D1 on ``source`` (default: ``df``)."""
    sizes = sizes or bucket_size_map(source if source is not None else df, registry.bucket_sources)
    for c in registry.bucket_sources:
        df = with_hash_bucket(df, c, sizes[c])
    return df


def impression_frame(log: DataFrame, registry: Registry, sizes: dict[str, int] | None = None) -> DataFrame:
    """A2 + H1-H3 + H6: the entity side -- log columns, labels, buckets."""
    df = log
    if "play_time_ms" in log.columns and "duration_ms" in log.columns:
        df = with_engagement_targets(df)
    return with_buckets(df, registry, sizes, source=log)


def _split_spec(registry: Registry, view) -> tuple:
    return (
        view.keys,
        [(c.signal, c.name) for c in registry.cols(view, ROLLING)],
        [(c.signal, c.name) for c in registry.cols(view, CUMULATIVE)],
    )


def add_view_features(df: DataFrame, registry: Registry, strategy: str = "auto") -> DataFrame:
    """E3-E5 on the full frame: one shuffle per view key, all signals in one window pass.

    ``strategy="auto"`` picks ``prefix``, ``sliced`` or ``split`` per view (:func:`auto_strategies`).
    """
    base_cols = df.columns
    if strategy == "auto":
        per_view = auto_strategies(df, [v.keys for v in registry.views], registry.window_us)
    else:
        per_view = [strategy] * len(registry.views)
    # Differences of running sums are exact for integers only, whatever the size.
    per_view = ["sliced" if s == "split" and not has_integral(df, [c.signal for c in registry.cols(v)]) else s for v, s in zip(registry.views, per_view)]
    split = [_split_spec(registry, v) for v, s in zip(registry.views, per_view) if s == "split"]
    # Split views' tables come from the base frame; they are joined on last.
    tables = split_view_tables(df, split, registry.window_us) if split else []
    for view, s in zip(registry.views, per_view):
        if s == "split":
            continue
        strategy = s
        rolling = registry.cols(view, ROLLING)
        cum = registry.cols(view, CUMULATIVE)
        df = rolling_mean(df, view.keys, [c.signal for c in rolling], registry.window_us, names=[c.name for c in rolling], strategy=strategy)
        if cum:
            df = cumulative_sum(df, view.keys, [c.signal for c in cum], names=[c.name for c in cum], strategy="direct" if strategy in ("direct", "prefix") else "sliced")
    if tables:
        df = split_join_views(tables, df)
    return df.select(*base_cols, *_feature_names(registry))


def _feature_names(registry: Registry) -> list[str]:
    return [c.name for view in registry.views for c in registry.cols(view)]


def training_table(log: DataFrame, registry: Registry, *, strategy: str = "auto", sizes: dict[str, int] | None = None) -> DataFrame:
    ent = impression_frame(log, registry, sizes)
    return add_view_features(ent, registry, strategy).drop("ts_us")


def feature_sources(log: DataFrame, registry: Registry, strategy: str = "auto", path: str | None = None) -> dict[str, DataFrame]:
    """A5: one source table per view (keys, time, features).

    With ``path`` each source is written as a parquet table (time-sorted
    within files) under ``path/<view>`` and read back, as a feature store holds
    them: later as-of joins read stored tables instead of recomputing windows,
    and the lineage is cut.
    """
    if strategy == "auto":
        per_view = auto_strategies(log, [v.keys for v in registry.views], registry.window_us)
    else:
        per_view = [strategy] * len(registry.views)
    out = {v.name: view_source(log, registry, v, strategy=s) for v, s in zip(registry.views, per_view)}
    for v in registry.views:
        registry.check(out[v.name], v)
    if path is None:
        return out
    from ..sources.io import write_source

    spark = log.sparkSession
    stored = {}
    for name, df in out.items():
        write_source(df, f"{path}/{name}")
        stored[name] = spark.read.parquet(f"{path}/{name}")
    return stored


def training_table_asof(
    log: DataFrame,
    registry: Registry,
    sources: dict[str, DataFrame] | None = None,
    *,
    strategy: str = "auto",
    sizes: dict[str, int] | None = None,
    store_path: str | None = None,
) -> DataFrame:
    """C2-C4 path: as-of join every view's source table onto the impressions.

    Without ``sources`` they are built from ``log`` (and stored under
    ``store_path`` when given).
    """
    sources = sources or feature_sources(log, registry, strategy, path=store_path)
    ent = impression_frame(log, registry, sizes)
    for view in registry.views:
        names = [c.name for c in registry.cols(view)]
        ent = asof_features(ent, sources[view.name], view.keys, names, ttl_us=view.ttl_us, strategy="direct" if strategy == "direct" else "sliced")
    return ent.drop("ts_us")
