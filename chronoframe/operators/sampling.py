"""Reproducible negative down-sampling.

A *pure negative* has every engagement signal equal to 0 (derived labels such
as ``is_skip`` never count). All other rows are kept. Of the ``n`` pure
negatives, exactly ``floor(n * frac)`` are kept: the ones that come first in
the order of ``md5(id || ':' || seed)`` (ties by id). Hashing instead of
``rand()`` keeps the choice stable under repartitioning and retries and
expressible in SQL.

The exact form never sorts globally in one task: the hash's first four hex
digits split the negatives into 65,536 ranges of near-equal size; per-range
counts (at most 65,536 rows, collected) give each range's offset. Ranges
before the k-th row are kept whole; the one boundary range is split again by
eight hex digits (counts collected again), and only the rows of the one
boundary sub-range are ranked -- after copies of a row (which share a hash)
are collapsed map-side into a count, so a heavy group of copies never sits in
one task; kept copies are re-emitted in bounded chunks.
``neg_sample_hash`` keeps a row when its hash falls below ``frac`` of the
hash space: one pass, no shuffle, about ``frac`` of the negatives.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isclose

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 43
PREFIX_HEX = 4
COPY_CHUNK = 1_000_000


def is_pure_negative(signals: Sequence[str]) -> Column:
    """The sum of the signals is 0 (a NULL signal counts as 0)."""
    total = F.lit(0)
    for s in signals:
        total = total + F.coalesce(F.col(s).cast("int"), F.lit(0))
    return total == 0


def _order_key(id_cols: Sequence[str], seed: int) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in id_cols]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def _cut(counts: dict[str, int], k: int) -> tuple[str | None, str | None, int]:
    """Over prefix -> count in prefix order, the first prefix not kept whole,
    the prefix holding the k-th row (None when k falls on a range edge), and
    the number of rows before that boundary prefix."""
    run = 0
    for b in sorted(counts):
        if run + counts[b] > k:
            return b, (b if run < k else None), run
        run += counts[b]
    return None, None, run


def _copies(rows: DataFrame, n: str, chunk: int = COPY_CHUNK) -> DataFrame:
    """Re-emit ``n`` copies of every row, in chunks of at most ``chunk`` rows
    spread over tasks, so one heavy copy group never lands in one task."""
    parts = rows.withColumn("__i", F.explode(F.sequence(F.lit(0), F.expr(f"(`{n}` - 1) div {chunk}"))))
    parts = parts.withColumn("__m", F.least(F.lit(chunk), F.col(n) - F.col("__i") * chunk)).repartition("__i")
    return parts.withColumn("__j", F.explode(F.sequence(F.lit(1), F.col("__m")))).drop("__i", "__m", "__j", n)


def neg_sample_exact(df: DataFrame, signals: Sequence[str], id_cols: Sequence[str], frac: float, seed: int = SEED) -> DataFrame:
    """Keep all non-pure-negatives and exactly floor(n_neg * frac) pure negatives."""
    if isclose(frac, 1.0):
        return df
    neg = is_pure_negative(signals)
    pos_rows = df.filter(~neg)
    if frac <= 0:
        return pos_rows
    cols = df.columns
    keyed = df.filter(neg).withColumn("__h", _order_key(id_cols, seed)).withColumn("__b", F.substring("__h", 1, PREFIX_HEX))
    counts = {r["__b"]: r["count"] for r in keyed.groupBy("__b").count().collect()}  # at most 16**PREFIX_HEX rows
    k = int(sum(counts.values()) * frac)
    # Ranges are ordered hex prefixes: every range before the one holding the
    # k-th row is kept whole (one comparison), only that boundary range is cut.
    whole_before, boundary, before = _cut(counts, k)
    parts = [pos_rows]
    if whole_before is None:  # k == n_neg: every negative is kept
        parts.append(keyed.select(*cols))
    else:
        parts.append(keyed.filter(F.col("__b") < F.lit(whole_before)).select(*cols))
    if boundary is not None:
        # Second level inside the boundary range: 8 hex digits, counts collected again.
        need = k - before
        edge = keyed.filter(F.col("__b") == boundary).withColumn("__b2", F.substring("__h", 1, 2 * PREFIX_HEX))
        counts2 = {r["__b2"]: r["count"] for r in edge.groupBy("__b2").count().collect()}  # at most 16**PREFIX_HEX rows
        whole2, boundary2, before2 = _cut(counts2, need)
        if whole2 is not None:
            parts.append(edge.filter(F.col("__b2") < F.lit(whole2)).select(*cols))
        if boundary2 is not None:
            # Copies of one row share the hash: collapse them (map-side), rank the
            # few distinct rows left (about n / 16**8), then emit the kept copies.
            distinct = edge.filter(F.col("__b2") == boundary2).groupBy("__h", *cols).agg(F.count(F.lit(1)).alias("__c"))
            w = Window.orderBy("__h", *id_cols, F.xxhash64(*cols)).rowsBetween(Window.unboundedPreceding, -1)
            ranked = distinct.withColumn("__prior", F.coalesce(F.sum("__c").over(w), F.lit(0)))
            keep = ranked.withColumn("__k", F.least(F.col("__c"), F.greatest(F.lit(need - before2) - F.col("__prior"), F.lit(0))))
            parts.append(_copies(keep.filter(F.col("__k") > 0).select(*cols, "__k"), "__k"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def neg_sample_hash(df: DataFrame, signals: Sequence[str], id_cols: Sequence[str], frac: float, seed: int = SEED) -> DataFrame:
    """B11, streaming-friendly form: keep a pure negative when the first 8 hex
    digits of its hash, as a fraction of 16^8, are below ``frac``."""
    if isclose(frac, 1.0):
        return df
    h = F.conv(F.substring(_order_key(id_cols, seed), 1, 8), 16, 10).cast("long")
    return df.filter(~is_pure_negative(signals) | (h < F.lit(int(frac * 16**8))))
