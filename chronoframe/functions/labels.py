"""Engagement labels, validity masks and score helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the label definitions: skip = completion below one half and
# less than five seconds played; dwell is capped at twice the duration.
SKIP_COMPLETION = 0.5
SKIP_MAX_PLAY_MS = 5000
DWELL_CAP = 2


def completion(play: str = "play_time_ms", dur: str = "duration_ms") -> Column:
    """H1: min(play / duration, 1); NULL unless duration > 0."""
    return F.when(F.col(dur) > 0, F.least(F.col(play) / F.col(dur), F.lit(1.0)))


def is_skip(play: str = "play_time_ms", dur: str = "duration_ms") -> Column:
    """H2: 1.0 when completion < 0.5 and play < 5000 ms (both strict), else 0.0;
    NULL unless duration > 0. A NULL play with a valid duration gives 0.0."""
    skipped = (completion(play, dur) < SKIP_COMPLETION) & (F.col(play) < SKIP_MAX_PLAY_MS)
    return F.when(F.col(dur) > 0, F.when(skipped, F.lit(1.0)).otherwise(F.lit(0.0)))


def dwell_log(play: str = "play_time_ms", dur: str = "duration_ms") -> Column:
    """H3: log1p(min(play, 2*duration)); NULL unless duration > 0 and play is known.

    ``least`` skips NULLs, so the NULL-play guard is explicit.
    """
    valid = (F.col(dur) > 0) & F.col(play).isNotNull()
    return F.when(valid, F.log1p(F.least(F.col(play).cast("double"), F.col(dur).cast("double") * DWELL_CAP)))


def with_engagement_targets(df: DataFrame, play: str = "play_time_ms", dur: str = "duration_ms") -> DataFrame:
    """Add ``is_skip`` and ``dwell_log`` (double, NULL when undefined)."""
    return df.withColumns({"is_skip": is_skip(play, dur), "dwell_log": dwell_log(play, dur)})


def with_masks(df: DataFrame, targets: Iterable[str], suffix: str = "_valid") -> DataFrame:
    """One boolean validity column per target."""
    return df.withColumns({f"{t}{suffix}": F.col(t).isNotNull() for t in targets})


def score_to_label(score: str | Column, threshold: float = 0.5) -> Column:
    """Score >= threshold -> 1 (0.5 counts as positive)."""
    c = F.col(score) if isinstance(score, str) else score
    return (c >= F.lit(threshold)).cast("int")


def sigmoid(logit: str | Column) -> Column:
    """Logit -> probability."""
    c = F.col(logit) if isinstance(logit, str) else logit
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c))
