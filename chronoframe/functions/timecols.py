"""Event-time helpers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_micros(df: DataFrame, col: str) -> Column:
    """Microseconds since the epoch, independent of the session time zone.

    ``timestamp_ntz`` values are read as UTC wall-clock (how the parquet
    inputs are written); ``timestamp`` values are instants already.
    """
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", _epoch_ntz(), F.col(col))
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(F.col(col))
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return F.col(col).cast("long")
    raise TypeError(f"{col}: cannot take epoch micros of {dtype}")


def with_event_time(df: DataFrame, ts: str = "ts", out: str = "ts_us") -> DataFrame:
    return df.withColumn(out, epoch_micros(df, ts))


def from_epoch_millis(col: str | Column) -> Column:
    """B1: epoch milliseconds -> event time (an instant)."""
    return F.timestamp_millis(F.col(col) if isinstance(col, str) else col)


def ntz_literal(value) -> Column:
    """A ``timestamp_ntz`` literal from a string, date or naive datetime."""
    if isinstance(value, (_dt.datetime, _dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def zone_bound(local_wall_clock: str, zone: str) -> Column:
    """H8: a wall-clock time in ``zone`` as a UTC ``timestamp_ntz`` bound."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), ntz_literal(local_wall_clock))


def _bound(df: DataFrame, ts: str, value) -> Column:
    if isinstance(value, Column):
        return value
    dtype = df.schema[ts].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return ntz_literal(value)
    return F.lit(value).cast(dtype)


def time_slice(df: DataFrame, ts: str = "ts", start=None, end=None) -> DataFrame:
    """Half-open ``[start, end)`` filter; either bound may be omitted.

    Expressed as plain comparisons against literals so the filter reaches the
    parquet scan (``PushedFilters``) and partition pruning when ``ts`` is a
    partition column.
    """
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(ts) >= _bound(df, ts, start))
    if end is not None:
        cond = cond & (F.col(ts) < _bound(df, ts, end))
    return df.filter(cond)


def require_rows(df: DataFrame, what: str = "frame") -> DataFrame:
    """Fail when a (batch) frame is empty. Runs one short job (``isEmpty``)."""
    if df.isEmpty():
        raise ValueError(f"No data to process: {what} is empty")
    return df


def hour_floor(ts: str | Column = "ts") -> Column:
    """Truncate event time to the hour."""
    return F.date_trunc("hour", F.col(ts) if isinstance(ts, str) else ts)


def split_at(df: DataFrame, cutoff, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """Complementary ``[.., cutoff)`` and ``[cutoff, ..)`` frames."""
    return time_slice(df, ts, end=cutoff), time_slice(df, ts, start=cutoff)


def ntz_from_micros(us: str | Column) -> Column:
    """Epoch microseconds -> ``timestamp_ntz`` (UTC wall clock), zone-independent."""
    c = F.col(us) if isinstance(us, str) else us
    return F.timestamp_add("MICROSECOND", c, _epoch_ntz())
