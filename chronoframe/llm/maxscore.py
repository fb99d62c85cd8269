"""Exact top-k inner products with MaxScore bounds, shard by shard.

Each vector component is floor(scale * x), an integer. Vectors are cut into shards of
bounded size, queries into blocks; a block meets every shard that bounds of their ranges
do not rule out, and the shards' best k are merged. Within a shard each dimension is a query term whose contribution to
a score lies between bounds known from the shard's smallest and largest component. The
terms with the largest bounds are essential: the others together cannot lift a vector
over the threshold (the k-th best score of some seed vectors). Essential terms are
accumulated for the whole shard; the others are probed, a few at a time, only for
vectors whose score so far plus the remaining bounds still reaches the threshold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _spark as S

#: Terms that each probing step adds; seeds that set the threshold, per k.
PROBE, SEEDS = 8, 8
#: Blocks or shards that share a lane of one shard or block.
LANE = 256
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def top_in_shard(query: np.ndarray, own, ids: np.ndarray, x: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: int, threshold: int | None = None) -> list[tuple[int, int]]:
    """The k best (score, id) of a shard, by score, then smaller id, without ``own``, as
    far as they reach a threshold known from elsewhere.
    x: one column per vector's component, exact integers; lo/hi: their range."""
    floor, top = np.minimum(query * lo, query * hi), np.maximum(query * lo, query * hi)
    order = np.argsort(-(top - floor).astype(np.float64), kind="stable")
    rest = np.append(np.cumsum(top[order][::-1])[::-1], 0)  # bound of what the terms from here on add
    free = np.flatnonzero(ids != own)
    if not len(free):
        return []
    first = order[:PROBE]
    score = x[:, first] @ query[first]
    done = len(first)
    if len(free) > k:
        seeds = free if len(free) <= SEEDS * k else free[np.argpartition(-score[free].astype(np.float64), SEEDS * k - 1)[: SEEDS * k]]
        full = np.sort(x[seeds] @ query)
        threshold = full[-k] if threshold is None else max(full[-k], threshold)
    if threshold is not None:
        least = np.append(0, np.cumsum(floor[order]))
        while done < len(order) and least[done] + rest[done] >= threshold:  # still essential
            more = order[done : done + PROBE]
            score = score + x[:, more] @ query[more]
            done += len(more)
        free = free[score[free] + rest[done] >= threshold]
    score = score[free]
    while done < len(order) and len(free):
        more = order[done : done + PROBE]
        score = score + x[np.ix_(free, more)] @ query[more]
        done += len(more)
        if threshold is not None:
            keep = score + rest[done] >= threshold
            free, score = free[keep], score[keep]
    best = sorted(zip((-int(s) for s in score), ids[free].tolist()))[:k]
    return [(-s, i) for s, i in best]


def _matrix(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, "<f8").reshape(n, -1)


def _packed(vectors: DataFrame, rows: int, what: str) -> tuple[DataFrame, str]:
    """Up to ``rows`` vectors as one row, stored: its number, how many, their ids, their
    matrix and the least and largest component of each dimension."""

    def run(batches):
        ids, vecs = [], []

        def out():
            m = np.zeros((len(vecs), max(map(len, vecs))), "<f8")
            for i, v in enumerate(vecs):
                m[i, : len(v)] = v
            row = (len(ids), np.array(ids, "<i8").tobytes(), m.tobytes(), m.min(axis=0).tolist(), m.max(axis=0).tolist())
            types = (pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64()))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], ["n", "ids", "matrix", "lo", "hi"])

        for batch in batches:
            lists = batch.column(1)
            flat, off = np.asarray(lists.values), np.asarray(lists.offsets)
            for i, key in enumerate(batch.column(0).to_pylist()):
                ids.append(key)
                vecs.append(np.array(flat[off[i] : off[i + 1]], np.float64))
                if len(ids) == rows:
                    yield out()
                    ids.clear(), vecs.clear()
        if ids:
            yield out()

    packed = vectors.mapInArrow(run, "n int, ids binary, matrix binary, lo array<double>, hi array<double>")
    return S.stored(packed.select(F.monotonically_increasing_id().alias("no"), "*"), what)


def _pairs(blocks: DataFrame, shards: DataFrame, n_shards: int) -> DataFrame:
    """(block, shard, bound) of all blocks and shards: no score of theirs exceeds it. Only
    ranges meet, in lanes of about LANE shards."""
    lanes = max(1, -(-n_shards // LANE))
    b = blocks.select(F.col("no").alias("block"), "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"))
    s = shards.select(F.col("no").alias("shard"), F.col("lo").alias("s_lo"), F.col("hi").alias("s_hi"), F.pmod(F.xxhash64("no"), F.lit(lanes)).cast("int").alias("lane"))
    # Dimensions that one side lacks are zeros and add nothing.
    ends = "zip_with(zip_with(lo, hi, (a, b) -> struct(a, b)), zip_with(s_lo, s_hi, (a, b) -> struct(a, b)), (q, s) -> array(q.a * s.a, q.a * s.b, q.b * s.a, q.b * s.b))"
    total = "aggregate({ends}, 0D, (t, e) -> t + coalesce({each}, 0D))"
    top, size = total.format(ends=ends, each="array_max(e)"), total.format(ends=ends, each="array_max(transform(e, x -> abs(x)))")
    return b.join(s, "lane").select("block", "shard", F.expr(f"{top} + 1e-9D * {size}").alias("bound"))  # the last: rounding


def _search(pairs: DataFrame, blocks: DataFrame, shards: DataFrame, n_blocks: int, k: int) -> DataFrame:
    """``block, m, query_id, vec_id, score``: each query's k best of each given (block,
    shard) pair, as far as they reach its ``least``. A task reads a shard, then the
    blocks of its lane one by one."""
    body = ("no", "n", "ids", "matrix")
    lanes = max(1, -(-n_blocks // LANE))
    dealt = pairs.select("block", "shard", F.pmod(F.xxhash64("block"), F.lit(lanes)).alias("lane"))
    right = dealt.join(blocks.select(*body, "least"), F.col("block") == F.col("no")).select("shard", "lane", *body, "least", F.lit(True).alias("asks"))
    left = dealt.select(F.col("shard").alias("s"), "lane").distinct().join(shards.select(*body), F.col("s") == F.col("no"))
    left = left.select(F.col("s").alias("shard"), "lane", *body, F.lit(None).cast(right.schema["least"].dataType).alias("least"), F.lit(False).alias("asks"))

    def run(batches):
        shard = None
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in (*body, "asks", "least")}
                ids, x = np.frombuffer(row["ids"], "<i8"), _matrix(row["matrix"], row["n"])
                if not row["asks"]:
                    shard = ids, x
                    continue
                q, (s_ids, x) = x, shard
                width = max(q.shape[1], x.shape[1])
                q, x = (np.pad(y, ((0, 0), (0, width - y.shape[1]))) for y in (q, x))
                if width and np.abs(q).max() * np.abs(x).max() * width >= 2**52:  # sums of products are not exact in doubles
                    q, x = (np.array([[int(y) for y in z] for z in m], object).reshape(m.shape) for m in (q, x))
                lo, hi = x.min(axis=0), x.max(axis=0)
                least = dict(row["least"] or [])
                for m, (own, one) in enumerate(zip(ids, q)):
                    for score, i in top_in_shard(one, own, s_ids, x, lo, hi, k, least.get(m)):
                        for col, value in zip(out, (row["no"], m, own, i, max(LEAST, min(MOST, score)))):
                            col.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["block", "m", "query_id", "vec_id", "score"])

    met = left.unionByName(right).repartition("shard", "lane").sortWithinPartitions("shard", "lane", "asks")
    return met.mapInArrow(run, "block bigint, m int, query_id bigint, vec_id bigint, score bigint")


def top_k(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 50, k: int = 5, scale: int = 256, shard_rows: int = 4096, block_rows: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score`` for every row whose id is divisible by ``every``.

    Candidates are all rows but those with the query's own id. Ties go to the smaller
    id. Vectors null, holding null or non-finite components, or with a null id take no
    part; equal repeated rows are one query and several candidates; shorter vectors count as filled up with zeros. Scores beyond a long saturate.
    Every block meets its most promising shard first. Its queries' k-th scores there are
    thresholds for the rest: a pair whose bound stays below all of them is dropped before
    any matrix is sent. There are as many tasks as shards and lanes of LANE blocks.
    """
    spark = vectors.sparkSession
    S.text_batches(spark)
    fine = f"{id_col} IS NOT NULL AND {vec_col} IS NOT NULL AND forall({vec_col}, x -> x IS NOT NULL AND abs({scale}D * cast(x AS double)) < double('Infinity'))"
    v = vectors.where(fine).select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    queries = v.where(F.col("id") % every == 0)
    n, n_q = v.agg(F.count("*"), F.count_if(F.col("id") % every == 0)).first()

    def floored(batches):
        for batch in batches:
            lists = batch.column(1)
            whole = np.floor(np.asarray(lists.values) * float(scale))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(lists.offsets, pa.array(whole))], ["id", "v"])

    integers = lambda df: df.mapInArrow(floored, "id bigint, v array<double>")
    shards, at_shards = _packed(integers(v).repartition(max(1, -(-n // shard_rows))), shard_rows, "shards")
    blocks, at_blocks = _packed(integers(queries.distinct()).repartition(max(1, -(-n_q // block_rows))), block_rows, "blocks")
    n_shards, n_blocks = shards.count(), blocks.count()
    pairs, at_pairs = S.stored(_pairs(blocks, shards, n_shards), "pairs")
    first = pairs.groupBy("block").agg(F.max(F.struct("bound", "shard")).alias("p")).select("block", "p.shard")
    free = blocks.withColumn("least", F.lit(None).cast("map<int, bigint>"))
    one, at_one = S.stored(_search(first, free, shards, n_blocks, k), "first")
    place = Window.partitionBy("block", "m").orderBy(F.desc("score"))
    kth = one.withColumn("place", F.row_number().over(place)).where(F.col("place") == k).where(F.col("score") > LEAST)
    least = kth.groupBy(F.col("block").alias("no")).agg(F.map_from_entries(F.collect_list(F.struct("m", "score"))).alias("least"), F.min("score").alias("need"), F.count("*").alias("known"))
    raised, at_raised = S.stored(blocks.join(least, "no", "left"), "raised")
    # A block with a query that has no k scores yet meets every shard.
    need = raised.select(F.col("no").alias("block"), F.when(F.col("known") == F.col("n"), F.col("need").cast("double")).alias("need"))
    rest = pairs.join(first, ["block", "shard"], "left_anti").join(need, "block").where("need IS NULL OR bound >= need")
    got = one.unionByName(_search(rest.select("block", "shard"), raised, shards, n_blocks, k))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    got = got.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    got, _ = S.stored(got, "top")
    S.dropped(spark, at_shards, at_blocks, at_pairs, at_one, at_raised)
    return got
