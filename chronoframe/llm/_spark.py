"""Spark helpers of the text operators: scratch tables, bounded count tables summed
across tasks, Bloom bitmaps, connected components."""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir, scratch_path, ship

#: Texts are long: rows per Arrow batch that keep a batch to a few MB.
BATCH_ROWS = 1000
#: Counts in one blob of a count table.
SLICE = 1 << 14


def text_batches(spark: SparkSession) -> None:
    """Prepare a session for whole texts: the package in the workers, a checkpoint
    folder, smaller Arrow batches (never larger ones)."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    ensure_checkpoint_dir(spark)


def others(df: DataFrame, *replaced: str) -> list[str]:
    """Columns of ``df`` but the replaced ones, whatever case their names are in."""
    gone = {name.lower() for name in replaced}
    return [c for c in df.columns if c.lower() not in gone]


def with_last(df: DataFrame, passed: list[str], column: str) -> tuple[DataFrame, StructType]:
    """The passed columns and ``column`` after them, named by their place, so that no name
    clashes or needs quoting; and the schema of the passed ones under their own names."""
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in (*passed, column)]
    return df.select(*(c.alias(f"c{i}") for i, c in enumerate(quoted))), df.select(*quoted[:-1]).schema


def stored(df: DataFrame, what: str) -> tuple[DataFrame, str]:
    """Write ``df`` as a table in the shared folder and read it back: cut lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{what}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, *paths: str) -> None:
    """Remove scratch tables that nothing reads any more."""
    for p in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class CountTable:
    """Counts of one task by (kind, bucket): a dense table per kind, given back as
    blobs of SLICE counts, empty blobs left out."""

    def __init__(self, bits: int):
        self.size, self.tables, self.held = 1 << bits, {}, {}

    def add(self, kind: str, buckets: np.ndarray) -> None:
        parts = self.held.setdefault(kind, [])
        parts.append(buckets)
        if sum(map(len, parts)) > self.size // 2:
            self._fold(kind)

    def _fold(self, kind: str) -> None:
        parts = self.held.pop(kind, [])
        if parts:
            got = np.bincount(np.concatenate(parts), minlength=self.size)
            if kind in self.tables:
                self.tables[kind] += got
            else:
                self.tables[kind] = got

    def blobs(self):
        for kind in list(self.held):
            self._fold(kind)
        for kind, table in self.tables.items():
            for at in range(0, self.size, SLICE):
                part = table[at : at + SLICE]
                if part.any():
                    yield kind, at // SLICE, packed_counts(part)


def packed_counts(counts: np.ndarray) -> bytes:
    """Counts in the narrowest integers that hold them, deflated."""
    width = next(w for w in (1, 2, 4, 8) if int(counts.max(initial=0)) < 1 << (8 * w - 1))
    return bytes([width]) + zlib.compress(counts.astype(f"<i{width}").tobytes(), 1)


def unpacked_counts(blob: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(blob[1:]), f"<i{blob[0]}").astype(np.int64)


BLOB_TYPE = "kind string, slice int, blob binary"


def blob_batch(blobs) -> pa.RecordBatch:
    kinds, slices, data = ([], [], []) if not (rows := list(blobs)) else map(list, zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(slices, pa.int32()), pa.array(data, pa.binary())], ["kind", "slice", "blob"])


def summed_blobs(blobs: DataFrame, partitions: int = 32) -> DataFrame:
    """One blob per (kind, slice): each task adds up the blobs it reads one by one,
    holding one running sum per slice, however many tasks sent some."""

    def add(batches):
        total: dict = {}
        for batch in batches:
            for kind, at, blob in zip(*(c.to_pylist() for c in batch.columns)):
                got = unpacked_counts(blob)
                total[kind, at] = total[kind, at] + got if (kind, at) in total else got
        yield blob_batch((k, at, packed_counts(v)) for (k, at), v in total.items())

    return blobs.repartition(partitions, "kind", "slice").mapInArrow(add, BLOB_TYPE)


def count_tables(blobs: DataFrame, bits: int) -> dict[str, np.ndarray]:
    """The summed tables on the driver: 2**bits counts per kind, a fixed size."""
    out: dict = {}
    for kind, at, blob in summed_blobs(blobs).collect():
        got = unpacked_counts(blob)
        out.setdefault(kind, np.zeros(1 << bits, np.int64))[at * SLICE : at * SLICE + len(got)] += got
    return out


def bloom(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bitmap of 2**bits bits over the low bits of keys that are hashes already; ORed
    in Spark, at most 2**(bits-6) words reach the driver. False positives only cost
    later work."""
    h = F.col(column)
    words = (
        keys.select(F.shiftrightunsigned(h, 6).bitwiseAND((1 << (bits - 6)) - 1).alias("word"), h.bitwiseAND(63).cast("int").alias("bit"))
        .select("word", F.expr("shiftleft(1L, bit)").alias("mask"))
        .groupBy("word")
        .agg(F.bit_or("mask").alias("mask"))
    )
    out = np.zeros(1 << (bits - 6), np.uint64)
    got = words.toArrow()
    out[got.column("word").to_numpy()] = got.column("mask").to_numpy().astype(np.int64).view(np.uint64)
    return out


def in_bloom(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    h = np.ascontiguousarray(hashes).view(np.uint64)
    word = bitmap[((h >> np.uint64(6)) & np.uint64(len(bitmap) - 1)).astype(np.int64)]
    return (word >> (h & np.uint64(63))) & np.uint64(1) > 0


#: Rows of a small round table that one task takes.
ROUND_ROWS = 100_000


def settled(df: DataFrame, rows: int) -> DataFrame:
    """Checkpoint a table of at most about ``rows`` rows in as many partitions as they
    need: rounds over few rows don't spread them over every shuffle partition."""
    return df.coalesce(max(1, -(-rows // ROUND_ROWS))).checkpoint()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node of ``edges``; equal label = same component.

    Each round contracts every node into the neighbour (or itself) of smallest
    random priority, which shrinks the graph by a constant factor, so the rounds
    grow with the logarithm of the longest chain. All of it is joins and grouped
    minima with map-side combining; round tables are checkpointed, in fewer partitions
    as they shrink.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct().checkpoint()
    names, n = None, e.count()
    e, nodes = e.coalesce(max(1, -(-n // ROUND_ROWS))), 2 * n
    for r in range(200):
        if not n:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(r), F.col(c)), F.col(c).alias("id"))
        to = settled(both.groupBy("u").agg(F.least(F.min(rank("v")), rank("u")).getField("id").alias("to")), 2 * n)
        left = to.select(F.col("u"), F.col("to").alias("p"))
        right = to.select(F.col("u").alias("v"), F.col("to").alias("q"))
        e = settled(e.join(left, "u").join(right, "v").where("p <> q").select(F.least("p", "q").alias("u"), F.greatest("p", "q").alias("v")).distinct(), n)
        n = e.count()
        if names is None:
            names = to.select(F.col("u").alias("node"), F.col("to").alias("label"))
        else:
            step = to.select(F.col("u").alias("label"), "to")
            names = settled(names.join(step, "label", "left").select("node", F.coalesce("to", "label").alias("label")), nodes)
    else:
        raise RuntimeError("the components did not settle")
    if names is None:
        return edges.select(F.col(a).alias("node"), F.col(a).alias("label")).limit(0)
    return names
