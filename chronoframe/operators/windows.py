"""Point-in-time window features per entity.

Semantics (one tie rule everywhere, ``ties="exclude"``): the feature of an
event at time ``t`` sees the events of the same key with time in
``[t - W, t)`` -- the lower edge is included, the event itself and every
event with the same key and timestamp are not. NULL signals are skipped; an
empty window gives NULL.

Three physical strategies, same results on integral signals:

``direct``
    ``avg(s) OVER (PARTITION BY keys ORDER BY us RANGE BETWEEN W PRECEDING AND 1 PRECEDING)``.
    Spark re-evaluates a sliding frame for every row, O(n*w) per key, so integral
    signals take the growing frames of ``prefix``, which give the same value.
``prefix``
    Difference of two growing frames ``S(<= t-1) - S(<= t-W-1)`` (sum and
    count). Growing frames are incremental, so this is O(n) per key. Exact
    for integral signals only; double signals fall back to the sliding frame.
``sliced`` (default)
    The prefix form evaluated per ``(keys, time slice)`` instead of per key.
    Slices are ``ceil(W / m)`` wide and every event is copied into its own
    slice and the ``m`` following ones, so the partition of slice ``b`` holds
    everything any window ending in ``b`` can see. One key that holds a third
    of all rows is spread over ``span / slice`` window partitions instead of
    one task, at the price of ``m + 1`` copies in the single shuffle.

``split``
    For keys too hot even for one window of time per task. Events are first
    reduced to one row per ``(keys, time)`` (map-side partial aggregation, so
    a hot tied group collapses before the shuffle; exact because tied events
    never see each other). Every reduced row at ``t`` is added at ``t`` and, by a
    *leave* row, taken away after ``t + W``, so a running sum over both is the
    window's. Each row's exclusive prefix (``< time``) is a growing frame inside
    its ``(keys, sub-slice)`` plus the carried total of the earlier sub-slices,
    so no task ever needs more than one sub-slice of one key. A key that fits a
    task is one sub-slice and carries nothing; larger ones are cut by counts
    (``skew.hot_slices``), first into widths of ``sub_us``. The result is
    joined back to the events (one row per ``(keys, t)`` on the right, which AQE
    splits when the left is skewed). Integral signals only.

The running (cumulative) count has the same choice: ``direct`` is a growing
frame per key; ``sliced`` is a growing frame per ``(keys, slice)`` plus a
carried-in total of the earlier slices, computed on the small per-slice
totals table; ``split`` is the form above without leave rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..registry import CUMULATIVE, DAY_US, ROLLING, FeatureView, Registry, feature_name
from .skew import WHOLE, hot_slices, with_slice

_INTEGRAL = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)
UNBOUNDED = Window.unboundedPreceding


def _is_integral(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, _INTEGRAL)


def has_integral(df: DataFrame, signals: Sequence[str]) -> bool:
    """Whether all ``signals`` are integral, as the split strategy needs."""
    return all(_is_integral(df, s) for s in signals)


def _num(col: str) -> Column:
    """Booleans count as 0/1."""
    return F.col(col).cast("long")


def _timed(ts_us: str, value: Column) -> Column:
    """The signal of a row with an event time; rows without one are in no window."""
    return F.when(F.col(ts_us).isNotNull(), value)


def _finite(col: str) -> Column:
    """A double signal, NaN as missing."""
    v = F.col(col).cast("double")
    return F.when(~F.isnan(v), v)


def slice_of(ts_us: str, width_us: int) -> Column:
    """Floor division of epoch micros by the slice width (correct for negatives)."""
    return F.expr(f"(`{ts_us}` - pmod(`{ts_us}`, {int(width_us)})) div {int(width_us)}")


def _prefix_mean(sig: str, w, window_us: int, ts_us: str) -> Column:
    num = _timed(ts_us, _num(sig))
    upto_prev = w.rangeBetween(UNBOUNDED, -1)
    upto_edge = w.rangeBetween(UNBOUNDED, -(int(window_us) + 1))
    s = F.sum(num).over(upto_prev) - F.coalesce(F.sum(num).over(upto_edge), F.lit(0))
    c = F.count(num).over(upto_prev) - F.count(num).over(upto_edge)
    return F.when(c > 0, s.cast("double") / c)


def _sliding_mean(sig: str, w, window_us: int, ts_us: str) -> Column:
    return F.avg(_timed(ts_us, _finite(sig))).over(w.rangeBetween(-int(window_us), -1))


def _split_table(
    df: DataFrame,
    keys: Sequence[str],
    rolling: Sequence[tuple[str, str]],
    cumulative: Sequence[tuple[str, str]],
    window_us: int,
    ts_us: str,
    sub_us: int,
    fits: bool = False,
) -> DataFrame:
    """The ``split`` strategy's feature table: one row per (keys, time), the keys named
    ``__k0`` ... and the time ``__t`` (see module doc). ``fits``: no key is too large for
    a task, as the caller knows."""
    means = list(dict.fromkeys(s for s, _ in rolling))
    sums = list(dict.fromkeys(s for s, _ in cumulative))
    src = df.filter(F.col(ts_us).isNotNull()).select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(ts_us).alias("__t"), *[_num(s).alias(f"__v_{s}") for s in dict.fromkeys([*means, *sums])]
    )
    key_cols = [f"__k{i}" for i in range(len(keys))]
    aggs = {f"__s_{s}": F.sum(f"__v_{s}") for s in dict.fromkeys([*means, *sums])} | {f"__c_{s}": F.count(f"__v_{s}") for s in means}
    rows = src.groupBy(*key_cols, "__t").agg(*[v.alias(n) for n, v in aggs.items()])
    # What a row adds at its time: ``__m_`` and ``__n_`` it takes away again ``W`` later.
    if rolling:
        sign = F.col("__sign")
        rows = rows.withColumn("__sign", F.explode(F.array(F.lit(1).cast("long"), F.lit(-1).cast("long"))))
        shown = F.when(sign > 0, F.col("__t")).otherwise(F.try_add(F.col("__t"), F.lit(int(window_us))))
        rows = rows.withColumn("__t", shown).filter(F.col("__t").isNotNull())
    meas = {f"__m_{s}": F.col(f"__s_{s}") * sign for s in means} | {f"__n_{s}": F.col(f"__c_{s}") * sign for s in means}
    meas |= {f"__u_{s}": F.when(sign > 0, F.col(f"__s_{s}")) if rolling else F.col(f"__s_{s}") for s in sums}
    u = rows.select(*key_cols, "__t", *(["__sign"] if rolling else []), *[v.alias(m) for m, v in meas.items()])
    # A key that fits a task is one sub-slice; larger ones are cut where their rows stand.
    # Counting the log's rows is enough to see that none is too large.
    part, levels = key_cols, []
    if not fits and not keys_fit(df, keys, ts_us, 2 if rolling else 1):
        keyed = u.withColumn("__key", F.struct(*key_cols))
        levels = hot_slices(keyed, "__key", "__t", sub_us, whole=True)
    if levels:
        u, part = with_slice(keyed, "__key", "__t", levels, sub_us, "__b", whole=True), ["__key", "__b"]
    # Exclusive prefix inside the row's own sub-slice ...
    w = Window.partitionBy(*part).orderBy("__t").rangeBetween(UNBOUNDED, -1)
    pref = u.withColumns({f"__p{m}": F.coalesce(F.sum(m).over(w), F.lit(0).cast("long")) for m in meas})
    total = {m: F.col(f"__p{m}") for m in meas}
    if rolling:
        pref = pref.filter(sign > 0)
    if levels:
        # ... plus the totals of all earlier sub-slices of a cut key (one row per sub-slice).
        totals = u.filter(F.col("__b") != F.lit(WHOLE)).groupBy("__key", "__b").agg(*[F.sum(m).alias(f"__t{m}") for m in meas])
        wk = Window.partitionBy("__key").orderBy("__b").rowsBetween(UNBOUNDED, -1)
        carry = totals.select("__key", "__b", *[F.sum(f"__t{m}").over(wk).alias(f"__k{m}") for m in meas])
        pref = pref.join(carry, on=["__key", "__b"], how="left")
        total = {m: v + F.coalesce(F.col(f"__k{m}"), F.lit(0).cast("long")) for m, v in total.items()}
    out_cols = {name: total[f"__u_{s}"] for s, name in cumulative}
    for s, name in rolling:
        c = total[f"__n_{s}"]
        out_cols[name] = F.when(c > 0, total[f"__m_{s}"].cast("double") / c)
    return pref.select(*key_cols, "__t", *[v.alias(k) for k, v in out_cols.items()])


def keys_fit(df: DataFrame, keys: Sequence[str], ts_us: str, copies: int = 1) -> bool:
    """Whether ``copies`` of every row of the largest key fit a task; one row reaches the driver."""
    from . import skew

    fits = skew.TARGET_ROWS // copies
    return skew.largest_key(df.filter(F.col(ts_us).isNotNull()), keys, fits) <= fits


def _split_join(df: DataFrame, keys: Sequence[str], table: DataFrame, cumulative: Sequence[tuple[str, str]], ts_us: str) -> DataFrame:
    """Join a ``_split_table`` back onto the events (one row per (key, time)
    on the right; AQE splits a skewed left side). A null key matches itself. Merged at
    every size: the table has a row per event, which the size of the files does not tell."""
    same = F.col(ts_us) == F.col("__t")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    joined = df.join(table.hint("merge"), same, "left").drop("__t", *[f"__k{i}" for i in range(len(keys))])
    fill = {name: F.coalesce(F.col(name), F.lit(0).cast("long")) for _, name in cumulative}
    return joined.withColumns(fill) if fill else joined


def _split_prefix(
    df: DataFrame,
    keys: Sequence[str],
    rolling: Sequence[tuple[str, str]],
    cumulative: Sequence[tuple[str, str]],
    window_us: int,
    ts_us: str,
    sub_us: int,
) -> DataFrame:
    """The ``split`` strategy: add rolling means and prior sums (see module doc)."""
    sigs = list(dict.fromkeys([s for s, _ in rolling] + [s for s, _ in cumulative]))
    table = _split_table(df.select(*keys, ts_us, *sigs), keys, rolling, cumulative, window_us, ts_us, sub_us)
    return _split_join(df, keys, table, cumulative, ts_us)


def split_features(
    df: DataFrame,
    keys: Sequence[str],
    rolling: Sequence[tuple[str, str]],
    cumulative: Sequence[tuple[str, str]],
    window_us: int,
    *,
    ts_us: str = "ts_us",
    sub_us: int | None = None,
) -> DataFrame:
    """The ``split`` strategy for one view: rolling means ``(signal, name)``
    and prior sums in one pass (one reduction, one prefix window)."""
    if not all(_is_integral(df, s) for s, _ in [*rolling, *cumulative]):
        raise ValueError("the split strategy needs integral signals")
    sub = int(sub_us) if sub_us else max(1, int(window_us) // 7)
    return _split_prefix(df, list(keys), list(rolling), list(cumulative), window_us, ts_us, sub)


def split_views(
    df: DataFrame,
    views: Sequence[tuple[Sequence[str], Sequence[tuple[str, str]], Sequence[tuple[str, str]]]],
    window_us: int,
    *,
    ts_us: str = "ts_us",
    sub_us: int | None = None,
) -> DataFrame:
    """Several views' ``(keys, rolling, cumulative)`` features on ``df``.

    Every view's table is computed from ``df`` itself (pruned to its keys,
    time and signals) and then joined back, one join per view; chaining the
    views instead would re-read the growing frame once per view and join.
    """
    return split_join_views(split_view_tables(df, views, window_us, ts_us=ts_us, sub_us=sub_us), df, ts_us=ts_us)


def split_view_tables(df, views, window_us: int, *, ts_us: str = "ts_us", sub_us: int | None = None) -> list:
    """The per-view feature tables of :func:`split_views`, all computed from ``df``."""
    sub = int(sub_us) if sub_us else max(1, int(window_us) // 7)
    tables, small = [], []
    for keys, rolling, cumulative in views:
        if not all(_is_integral(df, s) for s, _ in [*rolling, *cumulative]):
            raise ValueError("the split strategy needs integral signals")
        sigs = list(dict.fromkeys([s for s, _ in rolling] + [s for s, _ in cumulative]))
        # Keys within a view's keys that fit a task fit one too.
        fits = any(set(k) <= set(keys) for k in small) or keys_fit(df, keys, ts_us, 2)
        small += [keys] if fits else []
        t = _split_table(df.select(*keys, ts_us, *sigs), list(keys), list(rolling), list(cumulative), window_us, ts_us, sub, fits)
        tables.append((list(keys), t, list(cumulative)))
    return tables


def split_join_views(tables: list, onto: DataFrame, *, ts_us: str = "ts_us") -> DataFrame:
    """Join :func:`split_view_tables` onto ``onto``, one join per view."""
    out = onto
    for keys, t, cumulative in tables:
        out = _split_join(out, keys, t, cumulative, ts_us)
    return out


def pick_strategies(
    df: DataFrame, views: Sequence[Sequence[str]], window_us: int, *, ts_us: str = "ts_us", target_rows: int | None = None
) -> list[str]:
    """``"sliced"`` or ``"split"`` per view key list.

    ``sliced`` puts at least one window of a key's time into one task, so a
    view whose largest (key, window-slice) group exceeds ``target_rows`` gets
    ``split``. One job: the per-view maxima (one row per view) are unioned
    and collected together.
    """
    from . import skew

    target = int(target_rows or skew.TARGET_ROWS)
    worst = _largest_groups(df, views, window_us, ts_us)
    return ["split" if in_slice > target else "sliced" for in_slice, _ in worst]


def auto_strategies(df: DataFrame, views: Sequence[Sequence[str]], window_us: int, *, ts_us: str = "ts_us") -> list[str]:
    """:func:`pick_strategies`, and ``"prefix"`` for a view whose largest key fits a task
    as it is: one shuffle, without the copies of ``sliced``."""
    from . import skew

    target = skew.TARGET_ROWS
    if all(skew.largest_key(df, keys) <= target for keys in _narrowest(views)):
        return ["prefix"] * len(views)
    worst = _largest_groups(df, views, window_us, ts_us)
    return ["prefix" if of_key <= target else "split" if in_slice > target else "sliced" for in_slice, of_key in worst]


def _narrowest(views: Sequence[Sequence[str]]) -> list[Sequence[str]]:
    """Views' keys that hold no other view's: keys within a key that fits a task fit too."""
    return [v for v in views if not any(set(o) < set(v) for o in views)]


def _largest_groups(df: DataFrame, views: Sequence[Sequence[str]], window_us: int, ts_us: str) -> list[tuple[int, int]]:
    """Rows of each view's largest (key, window-slice) and of its largest key."""
    parts = []
    for i, keys in enumerate(views):
        per = df.groupBy(*keys, slice_of(ts_us, window_us).alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
        whole = per.groupBy(*keys).agg(F.max("__n").alias("__m"), F.sum("__n").alias("__k"))
        parts.append(whole.agg(F.max("__m").alias("m"), F.max("__k").alias("k")).select(F.lit(i).alias("v"), "m", "k"))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    worst = {r["v"]: (r["m"] or 0, r["k"] or 0) for r in u.collect()}  # one row per view
    return [worst.get(i, (0, 0)) for i in range(len(views))]


def rolling_mean(
    df: DataFrame,
    keys: Sequence[str],
    signals: Sequence[str],
    window_us: int,
    *,
    ts_us: str = "ts_us",
    names: Sequence[str] | None = None,
    strategy: str = "sliced",
    slice_factor: int = 1,
    sub_us: int | None = None,
) -> DataFrame:
    """Add one leak-free rolling mean per signal (DoubleType).

    ``sub_us`` is the width into which the ``split`` strategy first cuts a key too large
    for a task (default W/7).
    """
    keys = list(keys)
    names = list(names) if names is not None else [feature_name(s, ROLLING, keys) for s in signals]
    if strategy == "split":
        if all(_is_integral(df, s) for s in signals):
            sub = int(sub_us) if sub_us else max(1, int(window_us) // 7)
            return _split_prefix(df, keys, list(zip(signals, names)), [], window_us, ts_us, sub)
        strategy = "sliced"  # differences are exact for integers only
    if strategy in ("direct", "prefix"):
        w = Window.partitionBy(*keys).orderBy(ts_us)
        return df.withColumns(
            {
                n: _prefix_mean(s, w, window_us, ts_us) if _is_integral(df, s) else _sliding_mean(s, w, window_us, ts_us)
                for s, n in zip(signals, names)
            }
        )
    if strategy != "sliced":
        raise ValueError(f"unknown strategy {strategy!r}")
    m = max(1, int(slice_factor))
    width = -(-int(window_us) // m)
    own, part = "__own", "__part"
    copies = F.when(F.col(ts_us).isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(m)))
    rep = (
        df.withColumn("__lag", F.explode(copies))
        .withColumn(part, slice_of(ts_us, width) + F.col("__lag"))
        .withColumn(own, F.col("__lag") == 0)
        .drop("__lag")
    )
    w = Window.partitionBy(*keys, part).orderBy(ts_us)
    feats = {
        n: _prefix_mean(s, w, window_us, ts_us) if _is_integral(df, s) else _sliding_mean(s, w, window_us, ts_us)
        for s, n in zip(signals, names)
    }
    out = rep.withColumns(feats).filter(F.col(own)).drop(own, part)
    return out


def cumulative_sum(
    df: DataFrame,
    keys: Sequence[str],
    signals: Sequence[str],
    *,
    ts_us: str = "ts_us",
    names: Sequence[str] | None = None,
    ties: str = "exclude",
    tiebreak: str | None = None,
    strategy: str = "sliced",
    slice_us: int = 7 * DAY_US,
) -> DataFrame:
    """Prior running sum per key (LongType, 0 for the first event).

    ``ties="exclude"``: events at the same (key, time) do not see each other.
    ``ties="sequence"``: order by (time, ``tiebreak``) and count earlier rows.
    """
    keys = list(keys)
    names = list(names) if names is not None else [feature_name(s, CUMULATIVE, keys) for s in signals]
    if ties not in ("exclude", "sequence"):
        raise ValueError("ties must be 'exclude' or 'sequence'")
    if ties == "sequence" and not tiebreak:
        raise ValueError("ties='sequence' needs a tiebreak column")
    if not all(_is_integral(df, s) for s in signals):
        raise ValueError("a running sum needs integral signals")

    def prior(w) -> Callable[[str], Column]:
        if ties == "exclude":
            frame = w.orderBy(ts_us).rangeBetween(UNBOUNDED, -1)
        else:
            frame = w.orderBy(ts_us, tiebreak).rowsBetween(UNBOUNDED, -1)
        return lambda s: F.coalesce(F.sum(_timed(ts_us, _num(s))).over(frame), F.lit(0).cast("long"))

    if strategy == "direct":
        p = prior(Window.partitionBy(*keys))
        return df.withColumns({n: p(s) for s, n in zip(signals, names)})
    if strategy == "split" and ties == "exclude":
        return _split_prefix(df, keys, [], list(zip(signals, names)), 0, ts_us, int(slice_us))
    if strategy == "split":
        strategy = "sliced"
    if strategy != "sliced":
        raise ValueError(f"unknown strategy {strategy!r}")
    sl = "__slice"
    base = df.withColumn(sl, slice_of(ts_us, slice_us))
    p = prior(Window.partitionBy(*keys, sl))
    within = base.withColumns({n: p(s) for s, n in zip(signals, names)})
    # Totals per (keys, slice) are small: one row per key and slice.
    totals = base.groupBy(*keys, sl).agg(*[F.sum(_timed(ts_us, _num(s))).alias(f"__tot{i}") for i, s in enumerate(signals)])
    wk = Window.partitionBy(*keys).orderBy(sl).rowsBetween(UNBOUNDED, -1)
    carry = totals.select(
        *keys, sl, *[F.coalesce(F.sum(f"__tot{i}").over(wk), F.lit(0).cast("long")).alias(f"__carry{i}") for i in range(len(signals))]
    )
    # Null-safe: a null key is a key like any other.
    same = None
    for c in [*keys, sl]:
        one = F.col(f"__w.{c}").eqNullSafe(F.col(f"__c.{c}"))
        same = one if same is None else same & one
    carried = [F.col(f"__c.__carry{i}") for i in range(len(signals))]
    joined = within.alias("__w").join(carry.alias("__c"), same, "left").select("__w.*", *carried)
    return joined.withColumns(
        {n: F.col(n) + F.coalesce(F.col(f"__carry{i}"), F.lit(0).cast("long")) for i, n in enumerate(names)}
    ).drop(sl, *[f"__carry{i}" for i in range(len(signals))])


def view_source(
    base: DataFrame,
    registry: Registry,
    view: FeatureView,
    *,
    ts: str = "ts",
    ts_us: str = "ts_us",
    strategy: str = "sliced",
    extra: Sequence[str] = (),
) -> DataFrame:
    """E3/E4/E5 + B2: one feature-source table of ``view`` (keys, time, features).

    Columns are pruned before the window so only keys, time and the signals
    travel through the shuffle.
    """
    keys = list(view.keys)
    rolling = registry.cols(view, ROLLING)
    cum = registry.cols(view, CUMULATIVE)
    needed = list(dict.fromkeys([*keys, ts, ts_us, *extra, *[c.signal for c in rolling + cum]]))
    df = base.select(*needed)
    if strategy == "split" and all(_is_integral(df, c.signal) for c in rolling + cum):
        sub = max(1, int(registry.window_us) // 7)
        df = _split_prefix(df, keys, [(c.signal, c.name) for c in rolling], [(c.signal, c.name) for c in cum], registry.window_us, ts_us, sub)
        return df.select(*keys, ts, ts_us, *extra, *[c.name for c in rolling + cum])
    df = rolling_mean(
        df, keys, [c.signal for c in rolling], registry.window_us, ts_us=ts_us, names=[c.name for c in rolling], strategy=strategy
    )
    if cum:
        df = cumulative_sum(
            df, keys, [c.signal for c in cum], ts_us=ts_us, names=[c.name for c in cum], strategy="direct" if strategy in ("direct", "prefix") else "sliced"
        )
    return df.select(*keys, ts, ts_us, *extra, *[c.name for c in rolling + cum])


def with_history(
    history: DataFrame,
    arm: DataFrame,
    compute: Callable[[DataFrame], DataFrame],
    *,
    ts_us: str = "ts_us",
    lookback_us: int | None = None,
    totals: dict[str, tuple[str, Sequence[str]]] | None = None,
) -> DataFrame:
    """Features of ``arm`` rows with state seeded by ``history``.

    ``history`` and ``arm`` are unioned (history optionally cut to the last
    ``lookback_us`` before the arm starts, given as a literal bound), the
    window ``compute`` runs over both, and only the arm's rows are kept.

    The cut is for window features, which see no further back. Running counts do:
    ``totals`` maps each of them to its ``(signal, keys)``, and what the rows that were
    cut off add to it is summed per key (combined map-side) and added back.
    """
    h, cut = history, None
    if lookback_us is not None:
        start = arm.agg(F.min(ts_us)).first()[0]
        if start is not None:
            since = F.col(ts_us) >= F.lit(int(start) - int(lookback_us))
            h, cut = h.filter(since), history.filter(~since)
    both = h.withColumn("__arm", F.lit(False)).unionByName(arm.withColumn("__arm", F.lit(True)))
    out = compute(both).filter(F.col("__arm")).drop("__arm")
    if cut is None:
        return out
    order = out.columns
    for i, (name, (signal, keys)) in enumerate((totals or {}).items()):
        before = cut.groupBy(*(F.col(k).alias(f"__k{j}") for j, k in enumerate(keys))).agg(F.sum(signal).alias(f"__before{i}"))
        same = [out[k].eqNullSafe(before[f"__k{j}"]) for j, k in enumerate(keys)]
        out = out.join(before, same, "left").drop(*(f"__k{j}" for j in range(len(keys))))
        out = out.withColumn(name, F.col(name) + F.coalesce(F.col(f"__before{i}"), F.lit(0))).drop(f"__before{i}")
    return out.select(*order)
