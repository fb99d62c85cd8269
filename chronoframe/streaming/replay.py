"""Event-ordered replay on Structured Streaming.

``replay_source`` reads a parquet log as a file stream (``maxFilesPerTrigger``
bounds a micro-batch); ``view_stream`` runs the keyed fold of one view with an
event-time watermark; ``run`` drives a query with ``availableNow`` and fans
every micro-batch out to a list of sinks through one ``foreachBatch`` (the
batch is persisted once, whatever the number of sinks). Checkpoints and
written tables live under the session's shared checkpoint folder.

Rows newer than the final watermark stay buffered in state until later input
moves the watermark past them; a replay that must drain completely appends a
far-future control row under a reserved key (:func:`drain_marker`).
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import ntz_from_micros
from ..registry import CUMULATIVE, ROLLING, FeatureView, Registry
from ..session import scratch_path, ship
from .processor import ShardFold

Sink = Callable[[DataFrame, int], None]
RESERVED_KEY = -(1 << 62)
#: Groups of keys that a view's fold is dealt over. A checkpoint keeps to its number.
SHARDS = 512
SHARDS_PER_PARTITION = 8
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
#: Micro-batches whose progress a replay keeps for the account of dropped rows.
KEPT_PROGRESS = 100_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """The fold keeps several named states per key, which needs the RocksDB provider;
    its workers need the package."""
    ship(spark)
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, "") != ROCKSDB:
        spark.conf.set(key, ROCKSDB)
    # A micro-batch writes what it changed, not the whole state of every store.
    if CHANGELOG not in spark.conf.getAll:
        spark.conf.set(CHANGELOG, "true")


def shards_for(spark: SparkSession) -> int:
    """Groups of keys for a new checkpoint: a few to a state partition, whose number the
    checkpoint keeps too; every group costs state calls in each micro-batch."""
    return SHARDS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))


def new_dir(spark: SparkSession, what: str) -> str:
    return scratch_path(spark, f"{what}-{uuid.uuid4().hex[:12]}")


def replay_source(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet log as a file stream (explicit schema, no inference)."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(path)


def drain_marker(spark: SparkSession, schema: T.StructType, values: dict, into: str | None = None) -> str:
    """Write one far-future control row (reserved key) that moves the final
    watermark past every real event.

    With ``into`` the row is appended as the newest file of the replay folder,
    so a ``maxFilesPerTrigger`` replay (oldest files first) reads it last; without
    it, the row goes to its own folder for a second stream, which is only
    correct when the whole log arrives in the first micro-batch.
    """
    path = into or new_dir(spark, "drain")
    row = {f.name: values.get(f.name) for f in schema.fields}
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(path)
    return path


def view_stream(
    events: DataFrame,
    registry: Registry,
    view: FeatureView,
    *,
    id_col: str = "event_id",
    watermark: str = "1 hour",
    initial_state: DataFrame | None = None,
    event_time: str = "",
    shards: int = SHARDS,
) -> DataFrame:
    """S4 for one view: the keyed fold over a stream of bound events.

    ``events`` needs the view keys, ``id_col``, ``ts_us`` and the signals.
    Emits one row per event: keys, ``id_col``, ``ts_us``, the view's features
    and ``late`` -- true for a row that arrived after the watermark had passed
    it, which gets no features (see :func:`on_time`, :func:`late_rows`). Rows that
    Spark drops before the fold are found by :func:`unserved`. ``event_time`` names
    a timestamp column added to the output, on which a later stateful operator of
    the same query goes by the same watermark. Keys are dealt over ``shards`` groups by
    hash, which must not change over restarts from one checkpoint.
    """
    use_rocksdb(events.sparkSession)
    rolling = registry.cols(view, ROLLING)
    cum = registry.cols(view, CUMULATIVE)
    fold = ShardFold(
        view.keys,
        registry.signals,
        registry.window_us,
        [c.name for c in rolling],
        [c.signal for c in cum],
        [c.name for c in cum],
        id_col=id_col,
        event_time=event_time,
    )
    key_types = [events.schema[k].dataType for k in view.keys]
    named = [*view.keys, id_col]
    timed = events.select(*named, "ts_us", *registry.signals).withColumn("__et", F.timestamp_micros("ts_us"))
    src = _sharded(timed, view.keys, named, fold, shards).withWatermark("__et", watermark).groupBy(fold.shard)
    init = _sharded(initial_state, view.keys, view.keys, fold, shards).groupBy(fold.shard) if initial_state is not None else None
    out = src.transformWithStateInPandas(
        statefulProcessor=fold,
        outputStructType=fold.output_schema(key_types),
        outputMode="Append",
        timeMode="EventTime",
        initialState=init,
        eventTimeColumnName=event_time,
    )
    given = {c: F.when(F.col(fold.nulls).bitwiseAND(F.lit(1 << i)) == 0, F.col(c)).alias(c) for i, c in enumerate(named)}
    return out.select(*[given.get(c, F.col(c)) for c in out.columns if c != fold.nulls])


def _sharded(df: DataFrame, keys: Sequence[str], named: Sequence[str], fold: ShardFold, shards: int) -> DataFrame:
    """Rows with the shard of their keys and, for the fold, which of ``named`` are null."""
    bits = [F.when(F.col(c).isNull(), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, c in enumerate(named)]
    df = df.withColumn(fold.shard, F.pmod(F.xxhash64(*keys), F.lit(int(shards))).cast("int")).withColumn(fold.nulls, functools.reduce(lambda a, b: a + b, bits))
    numbers = [c for c in named if isinstance(df.schema[c].dataType, T.NumericType)]
    filled = {c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in numbers}
    return df.withColumns(filled).select(fold.shard, *[c for c in df.columns if c != fold.shard])


def served_stream(
    events: DataFrame,
    registry: Registry,
    *,
    id_col: str = "event_id",
    watermark: str = "1 hour",
    initial_states: dict[str, DataFrame] | None = None,
    shards: int = SHARDS,
) -> DataFrame:
    """One row per event with the features of all views, in contract order.

    Every view folds the same stream under its own key. The folds emit an event in
    the same micro-batch (they share one watermark), so the inner stream-stream joins
    on (id, event time) hold state only until the watermark passes the event, however
    long the stream. ``id_col`` has to tell events of one time apart. Gives ``id_col``,
    ``ts_us``, the keys, the served features and ``late``.
    """
    time = "__served_at"
    out, keys = None, []
    for view in registry.views:
        state = (initial_states or {}).get(view.name)
        one = view_stream(events, registry, view, id_col=id_col, watermark=watermark, initial_state=state, event_time=time, shards=shards)
        keys += [k for k in view.keys if k not in keys]
        if out is None:
            out = one
            continue
        new = [c.name for c in registry.cols(view)] + [k for k in view.keys if k not in out.columns]
        other = one.select(F.col(id_col).alias("__id"), F.col(time).alias("__at"), *new)
        out = out.join(other, (out[id_col] == other["__id"]) & (out[time] == other["__at"])).drop("__id", "__at")
    return out.select(id_col, "ts_us", *keys, *registry.served, "late")


def warm_state(history: DataFrame, registry: Registry, view: FeatureView, upto_us: int | None = None) -> DataFrame:
    """Initial state of one view from batch history -- the window's last
    ``W`` of events per key, reduced per (key, time) to signal sums and
    non-NULL counts (kind ``w``), and the running totals (kind ``c``)."""
    cum = registry.cols(view, CUMULATIVE)
    k = len(registry.signals)
    h = history if upto_us is None else history.filter(F.col("ts_us") < F.lit(int(upto_us)))
    end = h.agg(F.max("ts_us")).first()[0] if upto_us is None else upto_us
    ncum = max(1, len(cum))
    nullc = [F.lit(None).cast("long").alias(f"c{i}") for i in range(ncum)]
    sig = [F.coalesce(F.sum(F.col(s).cast("double")), F.lit(0.0)).alias(f"s{i}") for i, s in enumerate(registry.signals)]
    cnt = [F.count(F.col(s)).alias(f"n{i}") for i, s in enumerate(registry.signals)]
    w = (
        h.filter(F.col("ts_us") >= F.lit(int(end or 0) - registry.window_us))
        .groupBy(*view.keys, F.col("ts_us").alias("us"))
        .agg(*sig, *cnt)
        .select(*view.keys, F.lit("w").alias("kind"), "us", *[f"s{i}" for i in range(k)], *[f"n{i}" for i in range(k)], *nullc)
    )
    sums = [F.sum(F.col(c.signal).cast("long")).alias(f"c{i}") for i, c in enumerate(cum)] or [F.lit(0).cast("long").alias("c0")]
    c = h.groupBy(*view.keys).agg(*sums).select(
        *view.keys,
        F.lit("c").alias("kind"),
        F.lit(None).cast("long").alias("us"),
        *[F.lit(None).cast("double").alias(f"s{i}") for i in range(k)],
        *[F.lit(None).cast("long").alias(f"n{i}") for i in range(k)],
        *[F.col(f"c{i}") for i in range(ncum)],
    )
    return w.unionByName(c)


def fan_out(sinks: Sequence[Sink]) -> Sink:
    """One persisted micro-batch feeds every sink."""

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return each


def parquet_append_sink(path: str) -> Sink:
    """Append the batch to a table; the batch id column makes a retried batch
    detectable (readers keep the highest attempt per id via the folder)."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return sink


def run(stream: DataFrame, sinks: Sequence[Sink] | None = None, *, out: str | None = None, checkpoint: str | None = None, timeout_s: int | None = None):
    """Drive a streaming query to the end of its input (``availableNow``)."""
    spark = stream.sparkSession
    checkpoint = checkpoint or new_dir(spark, "ckpt")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(KEPT_PROGRESS))
    w = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if sinks:
        q = w.foreachBatch(fan_out(sinks)).start()
    else:
        q = w.format("parquet").outputMode("append").start(out)
    if q.awaitTermination(timeout_s) is False:
        q.stop()
        raise TimeoutError(f"the stream did not end within {timeout_s} s; its output is partial")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def on_time(stream: DataFrame) -> DataFrame:
    """The fold's rows that were folded in order (``late`` = false)."""
    return stream.filter(~F.col("late")).drop("late")


def late_rows(df: DataFrame) -> DataFrame:
    """The rows that a fold received after the watermark had passed them, without
    features. Rows even later never reach it: see :func:`unserved`."""
    return df.filter(F.col("late")).drop("late")


def dropped_by_watermark(query) -> int:
    """Input rows that a finished query's stateful operators dropped as too late,
    over all its micro-batches. Fails if progress of a batch is no longer held."""
    progress = {p["batchId"]: p for p in query.recentProgress}
    if progress and sorted(progress) != list(range(max(progress) + 1)) and len(progress) >= KEPT_PROGRESS:
        raise RuntimeError(f"progress of {max(progress) + 1 - len(progress)} micro-batches is gone")
    return sum(op["numRowsDroppedByWatermark"] for p in progress.values() for op in p["stateOperators"])


def unserved(source: DataFrame, output: DataFrame, keys: Sequence[str], id_col: str = "event_id") -> DataFrame:
    """Every row of the replayed log that got no features, with the ``reason``:
    ``late`` (behind the watermark when the fold read it), ``dropped`` (so far behind
    that Spark left it out before the fold) or ``no_time``.

    ``source``: the log as a batch (with ``ts_us``); ``output``: what the fold wrote.
    Rows are matched as a multiset on (keys, id, time), so repeated rows, null ids and
    null keys are accounted for one by one, in one shuffle.
    """
    cols = [*keys, id_col, "ts_us"]
    timed = source.select(*cols).filter(F.col("ts_us").isNotNull())
    lost = timed.exceptAll(output.select(*cols)).withColumn("reason", F.lit("dropped"))
    late = output.filter(F.col("late")).select(*cols, F.lit("late").alias("reason"))
    no_time = source.select(*cols).filter(F.col("ts_us").isNull()).withColumn("reason", F.lit("no_time"))
    return lost.unionByName(late).unionByName(no_time)


def account(query, source: DataFrame, output: DataFrame, keys: Sequence[str], id_col: str = "event_id") -> dict[str, int]:
    """``on_time``, ``late``, ``dropped`` and ``no_time`` counts of a finished
    replay. Fails unless every input row is in just one of them and Spark's own count
    of dropped rows agrees, so no row can vanish unseen."""
    counts = {r["reason"]: r["n"] for r in unserved(source, output, keys, id_col).groupBy("reason").agg(F.count("*").alias("n")).collect()}
    got = {"on_time": on_time(output).count(), **{k: counts.get(k, 0) for k in ("late", "dropped", "no_time")}}
    n, told = source.count(), dropped_by_watermark(query)
    if sum(got.values()) != n or got["dropped"] != told:
        raise RuntimeError(f"{n} rows went in, {told} dropped by the watermark, but found {got}")
    return got


def in_arrival_order(events: DataFrame, batch: Column, path: str, cols: Sequence[str] | None = None) -> None:
    """Store a log (or ``cols`` of it) as one file per value of ``batch``, in
    ascending order, so that a replay of one file per trigger reads it as it arrived."""
    spread = events.withColumn("__batch", batch)
    for b in [r[0] for r in spread.select("__batch").distinct().orderBy("__batch").collect()]:
        spread.filter(F.col("__batch").eqNullSafe(F.lit(b))).select(*(cols or events.columns)).coalesce(1).write.mode("append").parquet(path)


def with_ntz(df: DataFrame, us: str = "ts_us", out: str = "ts") -> DataFrame:
    return df.withColumn(out, ntz_from_micros(us))
