"""Hot-key handling shared by the split window and as-of forms.

Time slicing spreads a key over ``span / width`` window partitions; a burst of one
key still fills one. ``hot_slices`` finds the ``(key, slice)`` groups with more rows
than a task should hold and refines them from counts: a hot slice is cut into ``FAN``
equal parts, neighbours are put together again up to half of ``target_rows``, and a
part that alone exceeds that is refined in turn, down to one microsecond. So slices
are about equally deep wherever the rows stand, and only rows of one key and one
microsecond cannot be parted.

A level has at most ``2 * rows / target_rows`` slices of at most ``FAN`` bounds. It
stays a distributed table, joined on (key, slice). Results never depend on the
slices (they only choose the task), so this is purely a balancing decision.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

TARGET_ROWS = 2_000_000
#: Parts of a hot slice per level: a slice of 7 days is down to 1 microsecond after 5.
FAN = 256
#: Where the slice of a whole key begins: before any time.
WHOLE = -(2**63)


#: Groups of keys that are counted together to see that no key is large.
GROUPS = 1 << 13


def largest_key(df: DataFrame, keys: Sequence[str], fits: int | None = None) -> int:
    """Rows of the largest key. A number up to ``fits`` (default ``TARGET_ROWS``) may be
    that of several keys together: groups of keys are counted first, at most ``GROUPS``
    rows from a task, and only keys of a group above it one by one."""
    fits = int(fits or TARGET_ROWS)
    group = F.pmod(F.xxhash64(*keys), F.lit(GROUPS))
    per = df.groupBy(group.alias("__g")).agg(F.count(F.lit(1)).alias("__n"))
    row = per.agg(F.max("__n"), F.collect_list(F.when(F.col("__n") > fits, F.col("__g")))).first()
    if not row[1]:
        return row[0] or 0
    each = df.filter(group.isin(row[1])).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return each.agg(F.max("__n")).first()[0]


def _start(ts_us: str, base_us: int) -> Column:
    """Where the base slice of a time begins (also before 1970)."""
    return F.expr(f"`{ts_us}` - pmod(`{ts_us}`, {int(base_us)})")


def _same(key: str) -> Column:
    return F.col(f"__l.{key}").eqNullSafe(F.col(f"__r.{key}")) & (F.col("__l.__from") == F.col("__r.__from"))


def hot_slices(df: DataFrame, key: str, ts_us: str, base_us: int, *, target_rows: int | None = None, whole: bool = False) -> list[DataFrame]:
    """Levels of ``(key, __from, __bounds)``: the slice that begins at ``__from`` falls
    into the ones that begin at ``__bounds``. Empty when no slice is hot, which one job
    finds out. ``key`` is one (struct) column; rows without a time are in no slice.
    ``whole``: a key is one slice at first, and a hot one is cut into parts of ``base_us``."""
    target, width = int(target_rows or TARGET_ROWS), int(base_us)
    first = F.lit(WHOLE) if whole else _start(ts_us, width)
    rows = df.filter(F.col(ts_us).isNotNull()).select(key, F.col(ts_us).alias("__t"), first.alias("__from"))
    hot = rows.groupBy(key, "__from").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > target).select(key, "__from")
    levels: list[DataFrame] = []
    while (width > 1 or whole) and not hot.isEmpty():
        if whole:
            part, whole = _start("__t", width), False
        else:
            width = -(-width // FAN)
            part = F.expr(f"__from + ((__t - __from) div {width}) * {width}")
        inside = rows.alias("__l").join(hot.alias("__r"), _same(key), "left_semi").withColumn("__part", part)
        # At most FAN rows per hot slice; stored, since bounds and the next level read them.
        ensure_checkpoint_dir(df.sparkSession)
        counts = inside.groupBy(key, "__from", "__part").agg(F.count(F.lit(1)).alias("n")).checkpoint()
        before = F.sum("n").over(Window.partitionBy(key, "__from").orderBy("__part")) - F.col("n")
        heavy = F.col("n") * 2 > target
        groups = counts.select(key, "__from", "__part", F.floor(before * 2 / target).alias("__g"), heavy.alias("__heavy"))
        bounds = groups.groupBy(key, "__from", "__g", "__heavy").agg(F.min("__part").alias("__part"))
        levels.append(bounds.groupBy(key, "__from").agg(F.collect_list("__part").alias("__bounds")))
        hot = counts.filter(heavy).select(key, F.col("__part").alias("__from"))
        rows = inside.select(key, "__t", F.col("__part").alias("__from"))
    return levels


def with_slice(df: DataFrame, key: str, ts_us: str, levels: list[DataFrame], base_us: int, out: str, *, whole: bool = False) -> DataFrame:
    """Attach where each row's slice begins; it names the slice within its key, and
    slices of a key are in time order by it. Null for a row without a time. ``whole`` as
    for ``hot_slices``; a key not cut has the slice ``WHOLE``."""
    df = df.withColumn("__from", F.when(F.col(ts_us).isNotNull(), F.lit(WHOLE)) if whole else _start(ts_us, base_us))
    for level in levels:
        both = df.alias("__l").join(level.alias("__r"), _same(key), "left").select("__l.*", "__r.__bounds")
        inner = F.array_max(F.filter("__bounds", lambda b: b <= F.col(ts_us)))
        df = both.withColumn("__from", F.coalesce(inner, F.col("__from"))).drop("__bounds")
    return df.withColumnRenamed("__from", out)
