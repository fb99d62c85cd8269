"""Sinks of a replay: the bucketed latest table, mergeable evaluation, and the hours
that a replay opens and closes (A9, D12, S6-S9).

Sinks run in ``foreachBatch``: Spark may run a micro-batch again after a failure, so each
writes under the batch's id and finds what came before it on storage, never in memory.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import hour_floor, ntz_from_micros
from ..operators.latest import keep_latest, merge_latest
from ..operators.metrics import merged_counts, ranking_from_counts, score_counts


class Versions:
    """Small JSON documents named by micro-batch id under one folder; written whole,
    so a reader sees a version or none."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _fs(self):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def ids(self) -> list[int]:
        found = self._fs().globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v=*/_SUCCESS")) or []
        return sorted(int(f.getPath().getParent().getName().removeprefix("v=")) for f in found)

    def newest(self, below: int | None = None) -> int | None:
        return max((i for i in self.ids() if below is None or i < below), default=None)

    def read(self, version: int | None) -> dict:
        if version is None:
            return {}
        return json.loads(self.spark.read.text(f"{self.path}/v={version}", wholetext=True).first()[0])

    def write(self, version: int, document: dict) -> None:
        self.spark.createDataFrame([(json.dumps(document, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/v={version}")

    def drop_below(self, version: int) -> None:
        for i in self.ids():
            if i < version:
                self._fs().delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v={i}"), True)


class LatestTableSink:
    """Keep a latest-value table current, copy-on-write by key bucket.

    A key belongs to one of ``buckets`` buckets by hash. A micro-batch is reduced to its
    newest row per key, merged with the stored buckets it touches (an older event never
    replaces a newer one) and written to those buckets of its own version; a manifest
    then names each bucket's version. Buckets that a batch does not touch are not read
    or written. A batch that runs again overwrites its own version from the same
    predecessor; a new sink object, also after a restart, goes on from storage.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], ts: str, cols: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.ts, self.cols, self.buckets = spark, path, list(keys), ts, list(cols), int(buckets)
        self.manifest = Versions(spark, f"{path}/manifest")

    def _stored(self, versions: dict, buckets: Sequence[int], like: DataFrame) -> DataFrame:
        paths = [f"{self.path}/data/v={versions[str(b)]}/__b={b}" for b in buckets if str(b) in versions]
        if not paths:
            return like.limit(0)
        return self.spark.read.schema(like.schema).parquet(*paths)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        new = keep_latest(batch, self.keys, self.ts, self.cols)
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        before = self.manifest.read(self.manifest.newest(below=batch_id))
        if before and before["buckets"] != self.buckets:
            raise ValueError(f"{self.path} has {before['buckets']} buckets, not {self.buckets}")
        versions = before.get("versions", {})
        # At most ``buckets`` numbers reach the driver.
        touched = sorted(r[0] for r in new.select(bucket.alias("b")).distinct().collect())
        if touched:
            merged = merge_latest(self._stored(versions, touched, new), new, self.keys, self.ts)
            merged.withColumn("__b", bucket).repartition("__b").write.mode("overwrite").partitionBy("__b").parquet(f"{self.path}/data/v={batch_id}")
            versions = versions | {str(b): batch_id for b in touched}
        kinds = [[f.name, f.dataType.simpleString()] for f in new.schema]
        self.manifest.write(batch_id, {"buckets": self.buckets, "versions": versions, "schema": kinds})

    def read(self) -> DataFrame:
        """The table as of the newest complete micro-batch."""
        version = self.manifest.newest()
        if version is None:
            raise ValueError("no version written yet")
        now = self.manifest.read(version)
        like = self.spark.createDataFrame([], ", ".join(f"`{n}` {t}" for n, t in now["schema"]))
        return self._stored(now["versions"], sorted(map(int, now["versions"])), like)

    def vacuum(self) -> list[int]:
        """Remove data that the newest version no longer names, and older manifests. Not
        for use while readers hold an older version. Gives the data versions removed."""
        newest = self.manifest.newest()
        if newest is None:
            return []
        held = set(self.manifest.read(newest)["versions"].items())
        fs, path = self.manifest._fs(), self.spark._jvm.org.apache.hadoop.fs.Path
        gone = set()
        for f in fs.globStatus(path(f"{self.path}/data/v=*/__b=*")) or []:
            at = f.getPath()
            version, b = int(at.getParent().getName()[2:]), at.getName().removeprefix("__b=")
            if version <= newest and (b, version) not in held:
                fs.delete(at, True)
                gone.add(version)
        self.manifest.drop_below(newest)
        return sorted(gone)


class EvalSink:
    """Scored rows kept as counts per (hour, target, score), one table per
    micro-batch. The metrics of an hour and of the whole replay are those of the added
    counts, so no scored row is read again.

    ``long`` makes ``target, y_true, y_score`` and ``hour`` of a micro-batch's rows.
    """

    def __init__(self, spark: SparkSession, path: str, long):
        self.spark, self.path, self.long = spark, path, long

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        score_counts(self.long(batch), ["hour"]).write.mode("overwrite").parquet(f"{self.path}/counts/batch_id={batch_id}")

    def counts(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/counts")

    def hours_end(self, hours: Sequence, batch_id: int) -> None:
        """Per-hour metrics of hours that are complete."""
        held = merged_counts(self.counts().where(F.col("hour").isin(list(hours))), ["hour"])
        ranking_from_counts(held, by=["hour"]).write.mode("overwrite").parquet(f"{self.path}/hours/batch_id={batch_id}")

    def finish(self) -> None:
        ranking_from_counts(merged_counts(self.counts())).write.mode("overwrite").parquet(f"{self.path}/total")

    def per_hour(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/hours").drop("batch_id")

    def total(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/total")


class HourReplay:
    """One fold's rows to every sink, with the hours they open and close.

    A sink is called with ``(batch, batch_id)`` and may have ``hours_start(hours,
    batch_id)``, ``hours_end(hours, batch_id)`` and ``finish()``. The fold emits in the
    order of the watermark: once a row of a later hour is out, an hour is complete. Open
    hours are kept on storage by micro-batch, so a restarted replay closes each hour
    once. ``done`` is called after the query ended and closes what is left.
    """

    def __init__(self, spark: SparkSession, path: str, sinks: Sequence, us: str = "ts_us"):
        self.spark, self.sinks, self.us = spark, list(sinks), us
        self.open = Versions(spark, f"{path}/open-hours")

    def _tell(self, event: str, *args) -> None:
        for sink in self.sinks:
            if (call := getattr(sink, event, None)) is not None:
                call(*args)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        timed = batch.withColumn("hour", hour_floor(ntz_from_micros(self.us)))
        # Hours of one micro-batch: as many as the replayed time has, not its rows.
        new = [r[0] for r in timed.select(F.date_format("hour", "yyyy-MM-dd HH:mm:ss").alias("h")).where("h IS NOT NULL").distinct().orderBy("h").collect()]
        before = self.open.read(self.open.newest(below=batch_id)).get("hours", [])
        if new:
            self._tell("hours_start", [_hour(h) for h in new if h not in before], batch_id)
            for sink in self.sinks:
                sink(timed, batch_id)
        hours = sorted({*before, *new})
        closed = [h for h in hours if new and h < new[-1]]
        if closed:
            self._tell("hours_end", [_hour(h) for h in closed], batch_id)
        self.open.write(batch_id, {"hours": [h for h in hours if h not in closed]})

    def done(self) -> None:
        newest = self.open.newest()
        left = self.open.read(newest).get("hours", [])
        if left:
            self._tell("hours_end", [_hour(h) for h in left], newest + 1)
            self.open.write(newest + 1, {"hours": []})
        self._tell("finish")


def _hour(text: str):
    import datetime as dt

    return dt.datetime.fromisoformat(text)
