"""Masked losses and tie-aware ranking / regression metrics per target.

Scores arrive as a *long* table ``(target, y_true, y_score)`` -- use
:func:`to_long` on a wide scored table (D13). A masked cell is a NULL label
and is dropped; partial batches are just more rows (D12).

ROC-AUC and average precision are computed exactly from counts per distinct
score: ``AUC = sum_s n_s (TP_above(s) + p_s / 2) / (P N)`` and
``AP = sum_s (p_s / P) * TP(>= s) / (TP(>= s) + FP(>= s))`` (step sum over
distinct thresholds). The running totals over descending scores are the
only ordered step. ``strategy="ranged"`` (default) splits every target's
distinct scores into ranges at approximate quantiles, runs the running
total per (target, range) and adds each range's offset from a table of
``targets x ranges`` rows, so no task holds a whole target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import score_to_label, sigmoid

#: Distinct scores of a target that one range, and so one task, should hold.
RANGE_SCORES = 1_000_000


def to_long(df: DataFrame, targets: Sequence[str], y: str = "{t}", score: str = "score_{t}", keep: Sequence[str] = ()) -> DataFrame:
    """Wide [rows x targets] -> long (target, y_true, y_score), masked cells dropped.

    A valid label without a score fails the query: it would leave the metrics unseen.
    """
    cells = F.array(
        *[
            F.struct(F.lit(t).alias("target"), F.col(y.format(t=t)).cast("double").alias("y_true"), F.col(score.format(t=t)).cast("double").alias("y_score"))
            for t in targets
        ]
    )
    out = df.select(*keep, F.explode(cells).alias("__c")).select(*keep, "__c.*")
    out = out.filter(F.col("y_true").isNotNull())
    unscored = F.raise_error(F.concat(F.lit("no score for a valid label of "), F.col("target"))).cast("double")
    return out.withColumn("y_score", F.coalesce("y_score", unscored))


def _with_targets(per_target: DataFrame, targets: Sequence[str] | None, **fill) -> DataFrame:
    """One row for each of ``targets``, also those without a valid label."""
    if targets is None:
        return per_target
    names = per_target.sparkSession.createDataFrame([(t,) for t in targets], "target string")
    out = names.join(per_target, "target", "left")
    return out.fillna(fill) if fill else out


def _softplus(x: Column) -> Column:
    return F.log1p(F.exp(-F.abs(x))) + F.greatest(x, F.lit(0.0))


def bce_with_logits(y: Column, logit: Column, pos_weight: float = 1.0) -> Column:
    """Numerically stable weighted binary cross-entropy from a logit."""
    return F.lit(float(pos_weight)) * y * _softplus(-logit) + (F.lit(1.0) - y) * _softplus(logit)


def huber(y: Column, pred: Column, delta: float = 1.0) -> Column:
    d = F.abs(pred - y)
    return F.when(d <= delta, 0.5 * d * d).otherwise(delta * (d - 0.5 * delta))


def masked_bce(long_logits: DataFrame, pos_weight: float = 1.0, targets: Sequence[str] | None = None) -> DataFrame:
    """Per target, sum of losses over valid rows / max(valid count, 1); with
    ``targets`` given, 0 for one without valid rows."""
    loss = bce_with_logits(F.col("y_true"), F.col("y_score"), pos_weight)
    per = long_logits.groupBy("target").agg((F.sum(loss) / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("loss"))
    return _with_targets(per, targets, loss=0.0)


def masked_huber(long_preds: DataFrame, delta: float = 1.0) -> DataFrame:
    """One global mean over every valid cell; 0.0 when nothing is valid."""
    h = huber(F.col("y_true"), F.col("y_score"), delta)
    return long_preds.agg(F.coalesce(F.sum(h), F.lit(0.0)).alias("__s"), F.count(F.lit(1)).alias("__n")).select(
        (F.col("__s") / F.greatest(F.col("__n"), F.lit(1))).alias("loss")
    )


def combined_loss(long_logits: DataFrame, long_preds: DataFrame, pos_weight: float = 1.0, targets: Sequence[str] | None = None) -> DataFrame:
    """Mean over binary targets of D4 (fully masked ones count 0 when ``targets``
    names them), plus D5 -- computed as one aggregate row."""
    bce = masked_bce(long_logits, pos_weight, targets).agg(F.avg("loss").alias("binary_loss"))
    hub = masked_huber(long_preds).withColumnRenamed("loss", "continuous_loss")
    # Both sides are single aggregate rows: tag and fold them together.
    both = bce.select(F.col("binary_loss"), F.lit(None).cast("double").alias("continuous_loss")).unionByName(
        hub.select(F.lit(None).cast("double").alias("binary_loss"), "continuous_loss")
    )
    row = both.agg(F.max("binary_loss").alias("binary_loss"), F.max("continuous_loss").alias("continuous_loss"))
    return row.withColumn("loss", F.col("binary_loss") + F.col("continuous_loss"))


def score_counts(long_scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Positives ``p`` and negatives ``n`` per (target, *by, score): all that the
    ranking metrics need of scored rows, and additive over batches of them."""
    return long_scores.groupBy("target", *by, "y_score").agg(
        F.sum(F.when(F.col("y_true") >= 0.5, 1).otherwise(0)).cast("long").alias("p"),
        F.sum(F.when(F.col("y_true") >= 0.5, 0).otherwise(1)).cast("long").alias("n"),
    )


def _ranges_for(counts: DataFrame) -> int:
    """Ranges of the score axis, so that the target with most distinct scores has
    RANGE_SCORES in each (one row reaches the driver)."""
    most = counts.groupBy("target").count().agg(F.max("count")).first()[0] or 0
    return max(8, -(-most // RANGE_SCORES))


def merged_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Stored counts of many batches added up, kept apart only per ``by``."""
    return counts.groupBy("target", *by, "y_score").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))


def _running_counts(c: DataFrame, strategy: str, n_ranges: int | None) -> DataFrame:
    """Per (target, score): p, n and inclusive running TP / FP over descending scores."""
    if strategy == "direct":
        w = Window.partitionBy("target").orderBy(F.desc("y_score")).rowsBetween(Window.unboundedPreceding, 0)
        return c.withColumn("tp", F.sum("p").over(w)).withColumn("fp", F.sum("n").over(w))
    if strategy != "ranged":
        raise ValueError(f"unknown strategy {strategy!r}")
    # Everything below hangs off the per-(target, score) counts: the scored rows
    # are read and reduced once (partial aggregation map-side), and the range
    # bounds are quantiles of the *distinct* scores, which is what balances the
    # window partitions.
    n_ranges = n_ranges or _ranges_for(c)
    qs = [i / n_ranges for i in range(1, n_ranges)]
    bounds = c.groupBy("target").agg(F.percentile_approx("y_score", qs, max(10_000, 10 * n_ranges)).alias("__b"))
    # targets x n_ranges values: a proven, small bound -> broadcast.
    c = c.join(F.broadcast(bounds), "target").withColumn(
        "__r", F.size(F.filter("__b", lambda b: b > F.col("y_score")))
    ).drop("__b")  # range 0 holds the highest scores
    tot = c.groupBy("target", "__r").agg(F.sum("p").alias("__rp"), F.sum("n").alias("__rn"))
    wo = Window.partitionBy("target").orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(
        "target",
        "__r",
        F.coalesce(F.sum("__rp").over(wo), F.lit(0)).alias("__op"),
        F.coalesce(F.sum("__rn").over(wo), F.lit(0)).alias("__on"),
    )
    w = Window.partitionBy("target", "__r").orderBy(F.desc("y_score")).rowsBetween(Window.unboundedPreceding, 0)
    c = c.withColumn("tp", F.sum("p").over(w)).withColumn("fp", F.sum("n").over(w))
    c = c.join(F.broadcast(off), ["target", "__r"])
    return c.select("target", "y_score", "p", "n", (F.col("tp") + F.col("__op")).alias("tp"), (F.col("fp") + F.col("__on")).alias("fp"))


def ranking_metrics(long_scores: DataFrame, threshold: float = 0.5, strategy: str = "ranged", n_ranges: int | None = None, targets: Sequence[str] | None = None) -> DataFrame:
    """roc_auc, recall_precision_auc (AP), precision, recall per target.

    All four are NULL when the target has no valid row or only one class.
    """
    return _with_targets(ranking_from_counts(score_counts(long_scores), threshold, strategy, n_ranges), targets)


def ranking_from_counts(counts: DataFrame, threshold: float = 0.5, strategy: str = "ranged", n_ranges: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """:func:`ranking_metrics` of :func:`score_counts`, one row per (target, *by)."""
    if by:
        counts = counts.select(F.struct("target", *by).alias("target"), "y_score", "p", "n")
    rc = _running_counts(counts, strategy, n_ranges)
    per = rc.groupBy("target").agg(
        F.sum("p").alias("P"),
        F.sum("n").alias("N"),
        F.sum(F.col("n").cast("double") * (F.col("tp") - F.col("p") / 2.0)).alias("__auc"),
        F.sum(F.col("p").cast("double") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("__ap"),
        F.sum(F.when(F.col("y_score") >= threshold, F.col("p")).otherwise(0)).alias("__tp"),
        F.sum(F.when(F.col("y_score") >= threshold, F.col("p") + F.col("n")).otherwise(0)).alias("__pp"),
    )
    ok = (F.col("P") > 0) & (F.col("N") > 0)
    return per.select(
        *([F.col(f"target.{c}").alias(c) for c in ("target", *by)] if by else ["target"]),
        F.when(ok, F.col("__auc") / (F.col("P").cast("double") * F.col("N"))).alias("roc_auc"),
        F.when(ok, F.col("__ap") / F.col("P")).alias("recall_precision_auc"),
        F.when(ok & (F.col("__pp") > 0), F.col("__tp") / F.col("__pp")).alias("precision"),
        F.when(ok, F.col("__tp") / F.col("P")).alias("recall"),
    )


def rmse(long_preds: DataFrame, targets: Sequence[str] | None = None) -> DataFrame:
    """Per continuous target over valid rows; NaN labels are masked; with
    ``targets`` given, NULL for one without valid rows."""
    long_preds = long_preds.filter(~F.isnan("y_true"))
    per = long_preds.groupBy("target").agg(F.sqrt(F.avg(F.pow(F.col("y_true") - F.col("y_score"), 2))).alias("rmse"))
    return _with_targets(per, targets)


def rates(df: DataFrame, signals: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean positive rate of each signal (optionally per split / arm)."""
    return df.groupBy(*by).agg(*[F.avg(F.col(s).cast("double")).alias(f"{s}_rate") for s in signals])


__all__ = [
    "to_long",
    "bce_with_logits",
    "huber",
    "masked_bce",
    "masked_huber",
    "combined_loss",
    "merged_counts",
    "ranking_from_counts",
    "ranking_metrics",
    "rmse",
    "rates",
    "score_counts",
    "score_to_label",
    "sigmoid",
]
