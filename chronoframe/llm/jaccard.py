"""N-gram Jaccard self-join: rare-first prefix filtering with length, positional and
suffix filters, joined on prefix n-grams, verified once per pair.

Every text becomes the set of its distinct ``width``-word shingles. Texts with equal
sets form one class (``sid``, a 64-bit hash of the set); only classes are joined, so
copies never multiply. Shingles are ordered by how often they occur (counts by hash
bucket, in a table sized by the text), then by hash: any total order keeps prefix
filtering exact, and this one keeps passages that many texts share out of the prefixes.

Two classes of n and m shingles link when ``den * common >= num * union``. Then the
first ``n - ceil(num * n / den) + 1`` shingles of each share one. For every prefix
shingle that two classes have, candidates go

1. in ``rounds`` rounds every posting meets a few pivots of its shingle only, which is
   linear however large a group of near copies is, and links are contracted into
   components; postings whose shingle meets a single component drop out;
2. classes of different components that share a shingle then meet pair by pair, in
   blocks of bounded size, so a shingle of many classes is spread over tasks.

A pair is skipped only when a chain of verified links joins it already, so components
are those of all links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _spark as S
from . import _vec as V

HIST = 16
#: Pivots per shingle and size.
PIVOTS = 16
#: Classes of one shingle that a block of the last join holds.
BLOCK_ROWS = 500
#: Bytes of text to a bucket of the count table; its bits, and those of a key bitmap, at
#: least and at most (memory bounds: a table is 4 bytes a bucket, a bitmap a bit).
BUCKET_BYTES, TABLE_BITS, BITMAP_BITS = 160, (16, 24), (20, 28)


def _bits(n: int, within: tuple[int, int]) -> int:
    """Bits of the next power of two from n on, within bounds."""
    return min(max(int(n).bit_length(), within[0]), within[1])


def _ceil(num, n, den):
    return -(-num * n // den)


def _sets(batch: pa.RecordBatch, width: int):
    """Per slice of a batch: (row a, row b, set values, sizes, class ids)."""
    raw, offsets = V.text_bytes(batch.column("text"))
    for a, b in V.steps(offsets):
        w = V.Words(raw, offsets, a, b)
        values, n = V.shingle_sets(w.hash, w.count, width)
        sid = V.mix(V.row_sums(V.mix(values ^ V.M2), n) + n.astype(V.U) * V.SEQ).view(np.int64)
        yield a, b, values, n, sid


def profiles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, bits: int = 21) -> DataFrame:
    """One pass: per document ``doc_id, th`` (hash of the text), ``n, sid`` (null if
    empty) with ``kind`` null, and per task its counts of shingles as blobs."""

    def run(batches):
        counts = S.CountTable(bits)
        for batch in batches:
            n_all, sid_all, some = [], [], []
            for _, _, values, n, sid in _sets(batch, width):
                counts.add("df", (values >> V.U(64 - bits)).astype(np.int32))
                n_all.append(n), sid_all.append(sid), some.append(n > 0)
            if not n_all:
                continue
            k = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(k, pa.string()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary()), batch.column("doc_id"), batch.column("th"),
                 pa.array(np.concatenate(n_all).astype(np.int64)), pa.array(np.concatenate(sid_all), mask=~np.concatenate(some))],
                ["kind", "slice", "blob", "doc_id", "th", "n", "sid"],
            )
        blobs = S.blob_batch(counts.blobs())
        k = blobs.num_rows
        yield pa.RecordBatch.from_arrays([*blobs.columns, *(pa.nulls(k, pa.int64()) for _ in range(4))], ["kind", "slice", "blob", "doc_id", "th", "n", "sid"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))
    return rows.mapInArrow(run, S.BLOB_TYPE + ", doc_id bigint, th bigint, n bigint, sid bigint")


def _postings(docs: DataFrame, text_col: str, width: int, bits: int, num: int, den: int, table, keys=None) -> DataFrame:
    """(key, sid, n, pos) of every prefix shingle, or of those in the bitmap ``keys``; a
    task sends a class once. The key leads with the capped frequency, so ascending keys
    are the rare-first order."""

    def run(batches):
        df, seen = table.value, set()
        for batch in batches:
            for _, _, values, n, sid in _sets(batch, width):
                often = np.minimum(df[(values >> V.U(64 - bits)).astype(np.int64)], (1 << 19) - 1).astype(V.U)
                key = (often << V.U(44)) | (values >> V.U(20))
                rows = np.array([i for i in np.flatnonzero(n > 0).tolist() if (x := int(sid[i])) not in seen and not seen.add(x)], np.int64)
                if not len(rows):
                    continue
                size = n[rows]
                key = V.row_sorted(key[V.ranges((np.cumsum(n) - n)[rows], size)], size)
                p = size - _ceil(num, size, den) + 1
                key = key[V.ranges(np.cumsum(size) - size, p)].view(np.int64)
                cols = [key, np.repeat(sid[rows], p), np.repeat(size, p).astype(np.int32), (V.ranges(np.zeros(len(p), np.int64), p) + 1).astype(np.int32)]
                if keys is not None:
                    some = S.in_bloom(keys.value, key)
                    cols = [c[some] for c in cols]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["key", "sid", "n", "pos"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "key bigint, sid bigint, n int, pos int")


def _class_sets(docs: DataFrame, text_col: str, width: int, wanted) -> DataFrame:
    """(sid, n, values, hist) of the classes in the bitmap, once each. hist counts the
    set's shingles by the lowest bits of their hash."""

    def run(batches):
        bitmap, seen = wanted.value, set()
        for batch in batches:
            for _, _, values, n, sid in _sets(batch, width):
                new = S.in_bloom(bitmap, sid) & (n > 0)
                rows = np.array([i for i in np.flatnonzero(new).tolist() if (x := int(sid[i])) not in seen and not seen.add(x)], np.int64)
                if not len(rows):
                    continue
                at, size = (np.cumsum(n) - n)[rows], n[rows]
                got = values[V.ranges(at, size)]
                owner = np.repeat(np.arange(len(rows)), size)
                hist = np.bincount(owner * HIST + (got & V.U(HIST - 1)).astype(np.int64), minlength=len(rows) * HIST).astype(np.int32)
                ends = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sid[rows]), pa.array(size.astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends), pa.array(got.view(np.int64))),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * HIST), pa.array(hist))],
                    ["sid", "n", "values", "hist"],
                )

    sets = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "sid bigint, n int, values array<bigint>, hist array<int>")
    return sets.dropDuplicates(["sid"])


def _fits(num: int, den: int, x=("na", "pa", "sa", "fa"), y=("nb", "pb", "sb", "fb")) -> str:
    """Length filter, and the positional filter of shingles matched together, the first
    at positions f, the last at p. Two linked sets meet under the first shingle that
    they have in common, and all else they have in common follows it in both: other
    matches are passed over, so those that stay are not all that a pair has and must
    not be summed. At the last, s of the shingles up to it are shared by any two
    classes at all, so the lesser of both, and what follows, bounds the overlap."""
    (n, p, s, f), (m, q, t, g) = x, y
    need = f"{num} * ({n} + {m})"
    first = f"(least({n} - {f}, {m} - {g}) + 1) * {num + den} >= {need}"
    return f"{den} * least({n}, {m}) >= {num} * greatest({n}, {m}) and {first} and (least({s}, {t}) + least({n} - {p}, {m} - {q})) * {num + den} >= {need}"


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs that link. Suffix filter first: the two histograms bound the overlap;
    then the exact intersection."""
    x = sets.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("values").alias("va"), F.col("hist").alias("ha"))
    y = sets.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("values").alias("vb"), F.col("hist").alias("hb"))
    bound = f"aggregate(zip_with(ha, hb, (p, q) -> least(p, q)), 0, (s, p) -> s + p) * {num + den} >= {num} * (na + nb)"
    exact = f"size(array_intersect(va, vb)) * {num + den} >= {num} * (na + nb)"
    return pairs.join(x, "a").join(y, "b").where(f"CASE WHEN {bound} THEN {exact} ELSE false END").select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, num: int = 75, den: int = 100, rounds: int = 2) -> DataFrame:
    """``doc_id, th, n_shingles, group_id, component_id`` per row of ``docs``.

    component_id is the smallest doc_id reachable by links, itself included; group_id
    is a hash that just the component's rows share (null if empty); th is
    ``xxhash64(text)``, which with doc_id names the row. Null or blank texts have
    n_shingles 0 and are linked with nothing. Rows of equal text link (also with
    equal doc_id). A null doc_id takes part but is never the smallest unless all
    are null. The frequency table and the bitmaps of keys grow with the input up to a
    memory bound (TABLE_BITS, BITMAP_BITS); they only affect speed.
    """
    spark = docs.sparkSession
    S.text_batches(spark)
    sc = spark.sparkContext
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    bits = _bits(size // BUCKET_BYTES, TABLE_BITS)
    one_pass, _ = S.stored(profiles(docs, id_col, text_col, width, bits), "profiles")
    rows = one_pass.where("kind is null").select("doc_id", "th", "n", "sid")
    table = S.count_tables(one_pass.where("kind is not null").select("kind", "slice", "blob"), bits).get("df", np.zeros(1 << bits, np.int64))
    order = sc.broadcast(np.minimum(table, (1 << 31) - 1).astype(np.int32))

    # Postings of shingles that two classes or more have in their prefixes.
    postings = _postings(docs, text_col, width, bits, num, den, order)
    multi = postings.groupBy("key").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi")).where("lo < hi").select("key")
    multi, at_multi = S.stored(multi, "multi")
    keys = sc.broadcast(S.bloom(multi, "key", _bits(128 * multi.count(), BITMAP_BITS)))
    shared = _postings(docs, text_col, width, bits, num, den, order, keys).join(multi, "key").dropDuplicates(["key", "sid"])
    shared, at_shared = S.stored(shared, "shared")
    # Shingles that just the same classes have become one, m shingles strong.
    members = shared.groupBy("key").agg(F.count("*").alias("n"), *(F.bit_xor(F.xxhash64(F.lit(i), "sid")).alias(f"x{i}") for i in (0, 1)))
    members = members.select("key", F.xxhash64("n", "x0", "x1").alias("group"))
    ranked = shared.withColumn("s", F.row_number().over(Window.partitionBy("sid").orderBy("pos")))
    left = ranked.join(members, "key").groupBy("group", "sid", "n").agg(F.max("pos").alias("pos"), F.min("pos").alias("f"), F.max("s").alias("s"))
    left, at_left = S.stored(left.select(F.col("group").alias("key"), "sid", "n", "pos", "f", "s", F.col("sid").alias("label")), "grouped")
    S.dropped(spark, at_multi, at_shared)
    label = None  # (node, label) of the classes linked so far

    tried: list[tuple[DataFrame, str]] = []
    # A map stage that AQE no longer needs may still run when its query has ended, so
    # broadcasts stay until the last table is written.
    sent = [order, keys]

    def linked(pairs: DataFrame) -> DataFrame:
        """(u, v): labels that verified pairs of classes join."""
        pairs = pairs.select("a", "b").distinct()
        for before, _ in tried:  # a pair is verified once
            pairs = pairs.join(before, ["a", "b"], "left_anti")
        tried.append(S.stored(pairs, "pairs"))
        pairs = tried[-1][0]
        ends = pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid")))
        wanted = sc.broadcast(S.bloom(ends, "sid", _bits(128 * pairs.count(), BITMAP_BITS)))
        sent.append(wanted)
        links = _verified(pairs, _class_sets(docs, text_col, width, wanted), num, den)
        names = left.select("sid", "label").distinct()
        edges = links.join(names.select(F.col("sid").alias("a"), F.col("label").alias("u")), "a").join(names.select(F.col("sid").alias("b"), F.col("label").alias("v")), "b")
        return S.stored(edges.select("u", "v").distinct(), "edges")[0]

    def relabelled(df: DataFrame, step: DataFrame) -> DataFrame:
        return df.join(step.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left").withColumn("label", F.coalesce("to", "label")).drop("to")

    def extended(label: DataFrame | None, step: DataFrame) -> DataFrame:
        """Labels after one more contraction: of classes named before and of new ones."""
        if label is None:
            return step
        return S.stored(relabelled(label, step).unionByName(step.join(label.select("node"), "node", "left_anti")), "labels")[0]

    for r in range(rounds):
        # A key's pivots: of its classes of each size (to a fourteenth) in each of
        # PIVOTS random parts, the first by hash.
        h = F.xxhash64(F.lit(r), "sid")
        pivot = F.min(F.struct(h.alias("h"), F.col("sid"), F.col("n"), F.col("pos"), F.col("f"), F.col("s"), F.col("label")))
        ends = left.groupBy("key", F.floor(F.log("n") * 14).alias("size"), F.pmod(h, F.lit(PIVOTS)).alias("part")).agg(pivot.alias("p")).select("key", "p.*")
        ends = ends.select("key", F.col("sid").alias("s2"), F.col("n").alias("n2"), F.col("pos").alias("p2"), F.col("s").alias("s_2"), F.col("f").alias("f2"), F.col("label").alias("lb"))
        met = left.join(ends, "key").where("label <> lb").where(_fits(num, den, ("n", "pos", "s", "f"), ("n2", "p2", "s_2", "f2")))
        # Either order of a pair becomes one.
        met = met.select(F.least("sid", "s2").alias("a"), F.greatest("sid", "s2").alias("b"))
        edges = linked(met)
        if edges.isEmpty():
            break
        step = S.components(edges, "u", "v")
        label = extended(label, step)
        closed, at_closed = S.stored(relabelled(left, step), f"closed{r}")
        some = closed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key")
        S.dropped(spark, at_left)
        left, at_left = S.stored(closed.join(some, "key").select("key", "sid", "n", "pos", "f", "s", "label"), f"open{r}")
        S.dropped(spark, at_closed)

    # A key of k blocks of classes meets as k * (k + 1) / 2 pairs of blocks.
    blocks = left.groupBy("key").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks")).where("blocks > 1")
    dealt = left.join(blocks, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", F.pmod(F.xxhash64(F.lit("block"), "sid"), F.col("blocks")).cast("int"))
    x = dealt.select("key", F.col("own").alias("i"), F.explode(F.expr("sequence(own, blocks - 1)")).alias("j"), F.col("sid").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("s").alias("sa"), F.col("f").alias("fa"), F.col("label").alias("la"))
    y = dealt.select("key", F.explode(F.expr("sequence(0, own)")).alias("i"), F.col("own").alias("j"), F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("s").alias("sb"), F.col("f").alias("fb"), F.col("label").alias("lb"))
    met = x.join(y, ["key", "i", "j"]).where(f"(i < j or a < b) and la <> lb and {_fits(num, den)}")
    met = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    label = extended(label, S.components(linked(met), "u", "v"))
    least = rows.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("least")).join(label.withColumnRenamed("node", "sid"), "sid", "left")
    least = least.select("sid", F.coalesce("label", "sid").alias("label"), "least")
    linked = least.groupBy("label").agg(F.min("least").alias("component_id"))
    named, _ = S.stored(least.join(linked, "label").select("sid", F.col("label").alias("group_id"), "component_id"), "named")
    S.dropped(spark, at_left, *(at for _, at in tried))
    for b in sent:
        b.destroy()
    out = rows.join(named, "sid", "left")
    return out.select("doc_id", "th", F.col("n").alias("n_shingles"), "group_id", F.coalesce("component_id", "doc_id").alias("component_id"))
