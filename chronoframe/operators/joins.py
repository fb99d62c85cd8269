"""Lookup joins and point-in-time (as-of) joins.

As-of join semantics: for each left row, the newest right row of the same
key with ``right_ts <= left_ts`` (``strict=True``: ``<``) and, when a TTL is
given, ``right_ts >= left_ts - ttl``; no match gives NULL values. Among right
rows tied on (key, time) the largest value struct wins, so the result does
not depend on arrival order.

The join is a union of both sides followed by ``last(struct, ignorenulls)``
over a window ordered by (time, side) -- one shuffle, no range join, and
never more output rows than left rows. ``strategy="sliced"`` partitions by
(key, time slice) and carries the newest right row of earlier slices in
through a small per-(key, slice) table, so a key that holds a third of all
rows is spread over many tasks; keys too dense in time for ``slice_us`` get
slices cut by their own counts (``skew.hot_slices``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..registry import DAY_US
from . import skew
from .skew import hot_slices, with_slice

#: Lookup tables up to this many rows are broadcast; larger ones are shuffled.
BROADCAST_MAX_ROWS = 2_000_000


class LookupError_(ValueError):
    """A validated lookup join found duplicate or missing keys."""


@dataclass(frozen=True)
class LookupReport:
    n_rows: int
    n_keys: int
    misses: int = 0
    distinct_misses: int = 0
    first_misses: tuple = ()


def lookup_profile(lookup: DataFrame, key: str) -> LookupReport:
    """Row count and distinct key count of a lookup table (one aggregate job)."""
    row = lookup.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("k")).first()
    return LookupReport(int(row["n"]), int(row["k"]))


def unmatched_keys(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key has no lookup row (NULL keys never match)."""
    lk = lookup.select(F.col(lookup_key or key).alias(key)).distinct()
    return df.join(lk, on=key, how="left_anti")


def unmatched_report(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str | None = None) -> LookupReport:
    """Number of misses, distinct missing keys and the first 10 sorted.

    Two bounded results reach the driver: one aggregate row and at most ten keys.
    """
    miss = unmatched_keys(df.select(key), lookup, key, lookup_key)
    row = miss.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("k")).first()
    first = [r[key] for r in first_unmatched(df, lookup, key, lookup_key).collect()] if row["n"] else []
    return LookupReport(0, 0, int(row["n"]), int(row["k"]), tuple(first))


def first_unmatched(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str | None = None, n: int = 10) -> DataFrame:
    """the first ``n`` sorted distinct unknown keys (a top-k report)."""
    return unmatched_keys(df.select(key), lookup, key, lookup_key).distinct().orderBy(key).limit(n)


def attach_lookup(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    value: str,
    *,
    lookup_key: str | None = None,
    out: str | None = None,
    mode: str = "raise",
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
    used: bool = True,
) -> DataFrame:
    """Validated many-to-one left lookup join.

    * a duplicate lookup key always raises (checked with one aggregate job
      that also yields the row count used to decide on a broadcast);
    * ``mode="raise"``: any left row without a value raises, reporting the
      count, the distinct keys and the first 10 sorted (one anti-join job);
    * ``mode="quarantine"``: returns only the matched rows; call
      :func:`unmatched_keys` for the rest;
    * ``mode="lazy"``: no miss job; a miss fails the query when the column is
      computed (``raise_error``), which Catalyst skips if the column is pruned.

    Rows are preserved (left join) and the value keeps its type, non-null. ``used=False``
    for a caller that only wants the checks: the lookup is grouped by its (unique) key, so
    that Catalyst drops the join where the value is not selected.
    """
    out = out or value
    lk = lookup.select(F.col(lookup_key or key).alias(key), F.col(value).alias(out))
    prof = lookup_profile(lk.filter(F.col(key).isNotNull()), key)
    if prof.n_rows != prof.n_keys:
        dups = lk.groupBy(key).count().filter("count > 1").orderBy(key).limit(10)
        raise LookupError_(f"lookup key {key} is not unique: {prof.n_rows} rows over {prof.n_keys} keys; e.g. {[r[key] for r in dups.collect()]}")
    known = lk.filter(F.col(out).isNotNull())  # a null value is a miss
    one = known if used else known.groupBy(key).agg(F.any_value(out).alias(out))
    right = F.broadcast(one) if prof.n_rows <= broadcast_max_rows else one
    if mode == "raise":
        rep = unmatched_report(df, known, key)
        if rep.misses:
            raise LookupError_(f"no {out} for {rep.misses} rows, {rep.distinct_misses} distinct {key}; smallest of them: {list(rep.first_misses)}")
        joined = df.join(right, on=key, how="left")
    elif mode == "quarantine":
        joined = df.join(right, on=key, how="inner")
    elif mode == "lazy":
        joined = df.join(right, on=key, how="left").withColumn(
            out, F.coalesce(F.col(out), F.raise_error(F.concat(F.lit(f"no {out} for {key}="), F.col(key).cast("string"))).cast(lk.schema[out].dataType))
        )
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return joined


@dataclass(frozen=True)
class Attached:
    """C1/C5/C7 in one pass: ``rows`` has every left row with ``out`` (null for a miss);
    once an action has run over it, :meth:`report` tells its misses."""

    rows: DataFrame
    key: str
    out: str
    before: Observation
    after: Observation

    @property
    def matched(self) -> DataFrame:
        return self.rows.filter(F.col(self.out).isNotNull())

    @property
    def quarantine(self) -> DataFrame:
        """The left rows without a value; null keys never match."""
        return self.rows.filter(F.col(self.out).isNull()).drop(self.out)

    def report(self) -> LookupReport:
        """Counts of the last action over all of ``rows``, taken while it ran."""
        got = self.after.get
        return LookupReport(int(self.before.get["n"]), int(got["n"]), int(got["misses"]), 0, () if got["least"] is None else (got["least"],))

    def check(self) -> None:
        """Fail on a miss, or if the join changed the number of rows."""
        r = self.report()
        if r.n_rows != r.n_keys:
            raise LookupError_(f"{r.n_rows} rows before the lookup of {self.out}, {r.n_keys} after")
        if r.misses:
            raise LookupError_(f"no {self.out} for {r.misses} rows; smallest unknown {self.key}: {list(r.first_misses)}")


def attach_observed(df: DataFrame, lookup: DataFrame, key: str, value: str, *, lookup_key: str | None = None, out: str | None = None) -> Attached:
    """C1 without a job of its own before the join.

    The join counts its rows, misses and smallest unknown key while whatever action the
    caller runs goes through it (``observe``); ``check()`` then raises as
    :func:`attach_lookup` does. A lookup row with a null value is a miss; several values
    of a key become one row more, which ``check()`` reports. No size is guessed: whether
    the lookup is broadcast follows its bytes at run time (adaptive execution).
    """
    out = out or value
    known = lookup.select(F.col(lookup_key or key).alias("__k"), F.col(value).alias(out)).filter(F.col("__k").isNotNull() & F.col(out).isNotNull())
    before, after = Observation(), Observation()
    left = df.observe(before, F.count(F.lit(1)).alias("n"))
    joined = left.join(known, left[key] == known["__k"], "left").drop("__k")
    miss = F.col(out).isNull()
    rows = joined.observe(after, F.count(F.lit(1)).alias("n"), F.count_if(miss).alias("misses"), F.min(F.when(miss, F.col(key))).alias("least"))
    return Attached(rows, key, out, before, after)


def distinct_requests(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """C4: distinct (keys, time) request rows (partial aggregation map-side)."""
    return df.select(*keys, ts).distinct()


def check_row_count(before: DataFrame, after: DataFrame, what: str = "join") -> None:
    """Fail when a join changed the number of rows (two count jobs)."""
    a, b = before.count(), after.count()
    if a != b:
        raise AssertionError(f"{what}: {a} rows before, {b} after")


def _any_null(keys: Sequence[str]) -> Column:
    c = F.lit(False)
    for k in keys:
        c = c | F.col(k).isNull()
    return c


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    *,
    left_ts: str = "ts_us",
    right_ts: str = "ts_us",
    ttl_us: int | None = None,
    strict: bool = False,
    strategy: str = "sliced",
    slice_us: int = 7 * DAY_US,
    matched_ts: str | None = None,
    adaptive: bool = True,
) -> DataFrame:
    """Point-in-time left join of ``right[values]`` onto every ``left`` row.

    ``matched_ts`` optionally names an output column with the matched right
    time (epoch micros), e.g. for freshness reports (S12).
    """
    keys, values = list(keys), list(values)
    lcols = left.columns
    clash = [v for v in values if v in lcols]
    if clash:
        raise ValueError(f"value columns already on the left: {clash}")
    r_side = 2 if strict else 0
    rstruct = F.struct(F.col(right_ts).alias("__rt"), *[F.col(v) for v in values])
    # The keys and the time of a left row are columns of their own: the rest goes beside them.
    beside = [c for c in lcols if c not in keys and c != left_ts]
    lstruct = F.struct(*beside) if beside else F.struct(F.lit(True).alias("__row"))
    R = right.filter(~_any_null(keys) & F.col(right_ts).isNotNull()).select(
        *keys,
        F.col(right_ts).alias("__t"),
        F.lit(r_side).alias("__side"),
        F.lit(None).cast(left.select(lstruct.alias("__l")).schema[0].dataType).alias("__l"),
        rstruct.alias("__r"),
    )
    L = left.select(
        *keys,
        F.col(left_ts).alias("__t"),
        F.lit(1).alias("__side"),
        lstruct.alias("__l"),
        F.lit(None).cast(right.select(rstruct).schema[0].dataType).alias("__r"),
    )
    # NULL keys never match; spread such left rows instead of piling them into one task.
    salt = F.when(_any_null(keys), F.pmod(F.xxhash64(*keys, "__t", "__l"), F.lit(256))).otherwise(F.lit(0))
    u = L.unionByName(R).withColumn("__salt", salt)
    if strategy == "sliced" and adaptive and skew.largest_key(u.filter(~_any_null(keys)), keys) <= skew.TARGET_ROWS:
        strategy = "direct"  # every key fits a task: one shuffle, without slices and their carry
    if strategy == "direct":
        w = Window.partitionBy(*keys, "__salt").orderBy("__t", "__side", "__r").rowsBetween(Window.unboundedPreceding, 0)
        picked = u.withColumn("__m", F.last("__r", ignorenulls=True).over(w)).filter(F.col("__side") == 1)
        picked = picked.withColumn("__m", F.when(~_any_null(keys), F.col("__m")))
    elif strategy == "sliced":
        # Slices of ``slice_us``, cut where a key has too many rows in one.
        ku = u.withColumn("__key", F.struct(*keys))
        levels = hot_slices(ku.filter(~_any_null(keys)), "__key", "__t", slice_us) if adaptive else []

        def sliced(df: DataFrame, ts: str) -> DataFrame:
            keyed = df if "__key" in df.columns else df.withColumn("__key", F.struct(*keys))
            return with_slice(keyed, "__key", ts, levels, slice_us, "__s").drop("__key")

        u = sliced(ku, "__t").withColumn("__s", F.coalesce(F.col("__s"), F.lit(-(2**62))))
        w = Window.partitionBy(*keys, "__s", "__salt").orderBy("__t", "__side", "__r").rowsBetween(Window.unboundedPreceding, 0)
        ent = u.withColumn("__m", F.last("__r", ignorenulls=True).over(w)).filter(F.col("__side") == 1)
        # Newest right row of every (key, slice), and the slices the left side needs.
        rl = sliced(R, "__t").groupBy(*keys, "__s").agg(F.max("__r").alias("__rl"))
        # Slices the left side needs, straight from its key and time columns.
        need = (
            sliced(left.filter(~_any_null(keys) & F.col(left_ts).isNotNull()).select(*keys, left_ts), left_ts)
            .select(*keys, "__s")
            .distinct()
            .withColumn("__rl", F.lit(None).cast(rl.schema["__rl"].dataType))
        )
        wk = Window.partitionBy(*keys).orderBy("__s").rangeBetween(Window.unboundedPreceding, -1)
        carry = (
            rl.withColumn("__need", F.lit(False))
            .unionByName(need.withColumn("__need", F.lit(True)))
            .withColumn("__carry", F.last("__rl", ignorenulls=True).over(wk))
            .filter("__need")
            .select(*keys, "__s", "__carry")
        )
        picked = ent.join(carry, on=[*keys, "__s"], how="left").withColumn(
            "__m", F.when(~_any_null(keys), F.coalesce(F.col("__m"), F.col("__carry")))
        )
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    m = F.col("__m")
    ok = m.isNotNull()
    if ttl_us is not None:
        ok = ok & (m["__rt"] >= F.col("__t") - F.lit(int(ttl_us)))
    named = {c: F.col(f"__l.{c}") for c in beside} | {left_ts: F.col("__t")} | {k: F.col(k) for k in keys}
    out = [named[c].alias(c) for c in lcols] + [F.when(ok, m[v]).alias(v) for v in values]
    if matched_ts:
        out.append(F.when(ok, m["__rt"]).alias(matched_ts))
    return picked.select(*out)


def asof_features(
    entity: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    *,
    ts: str = "ts",
    ts_us: str = "ts_us",
    ttl_us: int | None = None,
    strict: bool = False,
    strategy: str = "sliced",
    slice_us: int = 7 * DAY_US,
) -> DataFrame:
    """C4 -> C2 -> C3: as-of join of one feature view onto an entity frame.

    Requests are reduced to distinct (keys, time) first, so copies of one
    request collapse map-side before the shuffle; the answers are then joined
    back on (keys, time), a join AQE can split when one request is hot.
    """
    req = distinct_requests(entity, keys, ts_us)  # ``ts`` is the same time as ``ts_us``
    ans = asof_join(req, source, keys, values, left_ts=ts_us, right_ts=ts_us, ttl_us=ttl_us, strict=strict, strategy=strategy, slice_us=slice_us)
    first = [*keys, ts, ts_us]
    return entity.join(ans, on=[*keys, ts_us], how="left").select(*first, *[c for c in entity.columns if c not in first], *values)
