"""Hard negatives by shared candidate lists of anchor clusters.

Components become floor(scale * x); scores are integer inner products. Anchors of like
label and direction form clusters (blocks) of bounded size, candidates form shards of
bounded size the same way. A cluster knows its direction c and the widest angle of a
member to it. A candidate at angle t to c scores at most

    |member| * |candidate| * cos(max(0, t - widest))

so for each cluster a shard's candidates are sorted once by |candidate| * cos(...), and
every member walks that one list. A member stops where its bound falls below all it still
wants: its k-th best score so far, or the least score that counts.

The same bound between the two cones of a cluster and a shard orders and drops whole
pairs before any matrix is sent: each cluster first meets its most promising shard, and
the k-th best scores from there tell which others can still matter. Positives come first
(candidates of the anchor's label); their scores set the bands that negatives lie in.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _spark as S

#: Groups that labels are hashed to, directions at most, vectors that fit them at most.
GROUPS, DIRECTIONS, FIT_ROWS = 64, 256, 8192
#: Candidates of a list that one step scores; blocks that share a lane of a shard.
STEP, LANE_BLOCKS = 512, 64
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def directions(sample: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Up to k unit vectors by spherical k-means; the first distinct rows start it."""
    norm = np.linalg.norm(sample, axis=1, keepdims=True)
    unit = np.unique((sample / np.where(norm > 0, norm, 1))[norm[:, 0] > 0], axis=0)
    if k <= 1 or len(unit) <= 1:
        return np.zeros((1, sample.shape[1] if sample.ndim == 2 else 0))
    centre = unit[np.linspace(0, len(unit) - 1, min(k, len(unit))).astype(int)]
    for _ in range(rounds):
        near = np.argmax(unit @ centre.T, axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, near, unit)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        centre = np.where(size > 0, total / np.where(size > 0, size, 1), centre)
    return centre


def _lists(column: pa.Array) -> list[np.ndarray]:
    flat, off = np.asarray(column.values, np.float64), np.asarray(column.offsets)
    return [flat[a:b] for a, b in zip(off, off[1:])]


def _matrix(rows: list[np.ndarray], width: int | None = None) -> np.ndarray:
    width = max(map(len, rows), default=0) if width is None else width
    out = np.zeros((len(rows), width), "<f8")
    for i, v in enumerate(rows):
        out[i, : len(v)] = v[:width]
    return out


def cone(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """(unit direction, widest angle to it, greatest norm) of the rows of x."""
    norm = np.linalg.norm(x, axis=1)
    unit = x[norm > 0] / norm[norm > 0, None]
    c = unit.sum(axis=0) if len(unit) else np.zeros(x.shape[1])
    size = np.linalg.norm(c)
    if size < 1e-9:
        return np.zeros(x.shape[1]), float(np.pi), float(norm.max(initial=0))
    c = c / size
    return c, float(np.arccos(np.clip(unit @ c, -1, 1)).max(initial=0)), float(norm.max(initial=0))


class Shard:
    """Candidates, with what does not depend on the cluster that meets them."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        self.norm = np.linalg.norm(x, axis=1)

    def walk(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, wants: list[dict], k: int, same: bool):
        """(member, candidate, score) of each member's k best per want, by score, then
        smaller id. wants: per member {want: (least, most)} scores that count. The
        cluster is the rows of q."""
        width = max(q.shape[1], self.x.shape[1])
        q, x = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, self.x))
        centre, widest, _ = cone(q)
        with np.errstate(invalid="ignore", divide="ignore"):
            angle = np.arccos(np.clip(np.where(self.norm > 0, x @ centre / self.norm, 1), -1, 1))
        bound = self.norm * np.cos(np.maximum(0, angle - widest)) + self.norm * 1e-6
        order = np.argsort(-bound, kind="stable")  # the list that all members share
        bound = bound[order]
        size = np.linalg.norm(q, axis=1)
        if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, width) >= 2**52:
            q, x = (np.array([[int(y) for y in r] for r in m], object).reshape(m.shape) for m in (q, x))
        best: dict = {(m, j): [] for m, w in enumerate(wants) for j in w}
        least = {mj: wants[mj[0]][mj[1]][0] for mj in best}
        active = np.array([m for m, w in enumerate(wants) if w], np.int64)
        low = np.array([min(least[m, j] for j in w) if w else MOST for m, w in enumerate(wants)], np.float64)
        high = np.array([max(v[1] for v in w.values()) if w else LEAST for w in wants], np.float64)
        for at in range(0, len(order), STEP):
            # Equal scores may still win by a smaller id, so only a lower bound ends a walk.
            active = active[size[active] * bound[at] * (1 + 1e-9) + 1e-6 >= low[active]]
            if not len(active):
                break
            some = order[at : at + STEP]
            score = q[active] @ x[some].T
            fits = ((labels[active][:, None] == self.labels[some]) == same) & (ids[active][:, None] != self.ids[some])
            fits &= (score >= low[active][:, None] * (1 - 1e-12 * np.sign(low[active][:, None]))) & (score <= high[active][:, None] * (1 + 1e-12 * np.sign(high[active][:, None])))
            for i in np.flatnonzero(fits.any(axis=1)):
                m, hit = int(active[i]), np.flatnonzero(fits[i])
                got = list(zip((int(s) for s in score[i, hit]), self.ids[some[hit]].tolist(), some[hit].tolist()))
                for j, (_, most) in wants[m].items():
                    new = [(-s, v, c) for s, v, c in got if least[m, j] <= s <= most]
                    if new:
                        best[m, j] = sorted(best[m, j] + new)[:k]
                        if len(best[m, j]) == k:
                            least[m, j] = max(least[m, j], -best[m, j][-1][0])
                low[m] = min(least[m, j] for j in wants[m])
        found = {(m, c): (m, v, -s) for (m, _), rows in best.items() for s, v, c in rows}
        return list(found.values())


PACK = "no bigint, grp int, n int, ids binary, labels binary, matrix binary, dir array<double>, angle double, norm double, lab_lo bigint, lab_hi bigint"


def _packed(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of one group and direction, up to ``limit``, as one: ids, labels, matrix and
    the cone that they lie in."""
    names = [c.split()[0] for c in PACK.split(", ")]

    def run(batches):
        part, no, key, held = TaskContext.get().partitionId() << 32, 0, None, []

        def out():
            x = _matrix([v for _, _, v in held])
            ids, labels = (np.array([h[i] for h in held], "<i8") for i in (0, 1))
            c, angle, norm = cone(x)
            row = (part + no, key[0], len(held), ids.tobytes(), labels.tobytes(), x.tobytes(), c.tolist(), angle, norm, int(labels.min()), int(labels.max()))
            types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.float64(), pa.float64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

        for batch in batches:
            for i, label, v, *at in zip(batch.column("id").to_pylist(), batch.column("label").to_pylist(), _lists(batch.column("v")), batch.column("grp").to_pylist(), batch.column("direction").to_pylist()):
                if held and (at != key or len(held) == limit):
                    yield out()
                    held, no = [], no + 1
                key = at
                held.append((i, label, v.copy()))
        if held:
            yield out()

    order = ["grp", "direction", "salt"]
    return rows.repartition(*order).sortWithinPartitions(*order, "id").mapInArrow(run, PACK)


def _pairs(blocks: DataFrame, shards: DataFrame, n_shards: int) -> DataFrame:
    """(block, shard, bound, grp, sgrp, label ranges) of all clusters and shards, by
    lanes of shards; no matrix is read."""
    lanes = max(1, -(-n_shards // 256))
    cols = ("grp", "dir", "angle", "norm", "lab_lo", "lab_hi")
    b = blocks.select(F.col("no").alias("block"), *cols, F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"))
    s = shards.select(F.col("no").alias("shard"), *(F.col(c).alias(f"s_{c}") for c in cols), F.pmod(F.xxhash64("no"), F.lit(lanes)).cast("int").alias("lane"))
    dot = "aggregate(zip_with(dir, s_dir, (x, y) -> coalesce(x, 0D) * coalesce(y, 0D)), 0D, (t, x) -> t + x)"
    apart = F.expr(f"greatest(0D, acos(greatest(-1D, least(1D, {dot}))) - angle - s_angle)")
    bound = F.col("norm") * F.col("s_norm") * (F.greatest(F.lit(0.0), F.cos(apart)) + 1e-6)
    return b.join(s, "lane").select("block", "shard", bound.alias("bound"), "grp", "s_grp", "lab_lo", "lab_hi", "s_lab_lo", "s_lab_hi")


def _walk(pairs: DataFrame, blocks: DataFrame, shards: DataFrame, n_blocks: int, wants: DataFrame, k: int, same: bool) -> DataFrame:
    """``block, m, anchor_id, id, score`` of the given (block, shard) pairs. Each task
    reads a shard, then the blocks of its lane one by one."""
    per_block = wants.groupBy(F.col("block").alias("no")).agg(F.collect_list(F.struct("m", "j", "least", "most")).alias("wants"))
    body = ("no", "n", "ids", "labels", "matrix")
    lanes = max(1, -(-n_blocks // LANE_BLOCKS))
    dealt = pairs.select("block", "shard", F.pmod(F.xxhash64("block"), F.lit(lanes)).alias("lane"))
    right = dealt.join(blocks.select(*body).join(per_block, "no"), F.col("block") == F.col("no")).select("shard", "lane", *body, "wants")
    left = dealt.select(F.col("shard").alias("s"), "lane").distinct().join(shards.select(*body), F.col("s") == F.col("no")).select(F.col("s").alias("shard"), "lane", *body, F.lit(None).cast(right.schema["wants"].dataType).alias("wants"))

    def run(batches):
        shard = None
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for r in range(batch.num_rows):
                x = {c: batch.column(c)[r].as_py() for c in (*body, "wants")}
                ids, labels = np.frombuffer(x["ids"], "<i8"), np.frombuffer(x["labels"], "<i8")
                matrix = np.frombuffer(x["matrix"], "<f8").reshape(x["n"], -1)
                if x["wants"] is None:
                    shard = Shard(ids, labels, matrix)
                    continue
                members: list[dict] = [{} for _ in range(x["n"])]
                for w in x["wants"]:
                    members[w["m"]][w["j"]] = (w["least"], w["most"])
                for m, i, score in shard.walk(ids, labels, matrix, members, k, same):
                    for col, v in zip(out, (x["no"], m, int(ids[m]), i, max(LEAST, min(MOST, score)))):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["block", "m", "anchor_id", "id", "score"])

    met = left.unionByName(right).repartition("shard", "lane").sortWithinPartitions("shard", "lane", F.col("wants").isNotNull())
    return met.mapInArrow(run, "block bigint, m int, anchor_id bigint, id bigint, score bigint")


def _ranked(found: DataFrame, wants: DataFrame, k: int) -> DataFrame:
    """The k best per want, ranked from 1 by score, then smaller id."""
    order = Window.partitionBy("block", "m", "j").orderBy(F.desc("score"), "id")
    fit = found.join(wants, ["block", "m"]).where("least <= score AND score <= most")
    return fit.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _searched(pairs: DataFrame, blocks: DataFrame, shards: DataFrame, n_blocks: int, wants: DataFrame, k: int, same: bool) -> DataFrame:
    """The k best of every want over the given pairs: the most promising pair of each
    block first, then those that its k-th best scores leave open."""
    first = pairs.groupBy("block").agg(F.max(F.struct("bound", "shard")).alias("p")).select("block", "p.shard", "p.bound")
    one, at_one = S.stored(_walk(first, blocks, shards, n_blocks, wants, k, same), "walk")
    kth = _ranked(one, wants, k).where(F.col("rank") == k).select("block", "m", "j", F.col("score").alias("kth"))
    raised = wants.join(kth, ["block", "m", "j"], "left").select("block", "m", "j", F.greatest("least", "kth").alias("least"), "most")
    raised, at_raised = S.stored(raised, "wants")
    need = raised.groupBy("block").agg(F.min("least").alias("need"))
    rest = pairs.join(first.select("block", "shard"), ["block", "shard"], "left_anti").join(need, "block").where("bound * (1 + 1e-9D) + 1e-6D >= need")
    two = _walk(rest.select("block", "shard"), blocks, shards, n_blocks, raised, k, same)
    got, _ = S.stored(_ranked(one.unionByName(two), wants, k), "found")
    S.dropped(blocks.sparkSession, at_one, at_raised)
    return got


def mine(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256, shard_rows: int = 4096, block_rows: int = 256) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id is divisible by ``every``. An anchor's positives are
    its first ``positives`` other rows of the same label; per positive, negatives are the
    first ``negatives`` rows of other labels with ``low * positive_score <= 100 *
    negative_score <= high * positive_score`` (none if the positive's score is below 0).
    Higher scores come first, ties go to the smaller id; a positive or negative may be
    missing if there are fewer. Rows with a null id or label, or a vector null or with
    null or non-finite components, take no part; "other" rows have another id; equal
    repeated anchor rows are one anchor and several candidates; shorter vectors count as
    filled up with zeros; scores beyond a long saturate. Labels are integers. An empty
    table gives no rows; extra columns are left out. Directions that shards and clusters
    follow are fitted on at most FIT_ROWS vectors; they decide only what is skipped.
    """
    spark = vectors.sparkSession
    S.text_batches(spark)
    raw = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"), F.col(vec_col).cast("array<double>").alias("v"))
    fine = f"id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND forall(v, x -> x IS NOT NULL AND abs({scale}D * x) < double('Infinity'))"
    rows = raw.where(fine).withColumn("grp", F.pmod(F.xxhash64("label"), F.lit(GROUPS)).cast("int"))
    anchor = F.col("id") % every == 0
    sizes = {r["grp"]: (r["n"], r["a"]) for r in rows.groupBy("grp").agg(F.count("*").alias("n"), F.count_if(anchor).alias("a")).collect()}
    total = sum(n for n, _ in sizes.values())
    k = max(1, min(DIRECTIONS, total // (4 * shard_rows * max(1, len(sizes)))))
    sample = [] if k == 1 else rows.where(F.pmod(F.xxhash64("id"), F.lit(max(1, total // FIT_ROWS))) == 0).select("v").limit(FIT_ROWS).toArrow().column("v").to_pylist()
    centre = directions(_matrix([np.floor(np.array(v) * scale) for v in sample]), k)

    def placed(batches):
        for batch in batches:
            column = batch.column("v")
            lists = [np.floor(v * float(scale)) for v in _lists(column)]
            near = np.argmax(_matrix(lists, centre.shape[1]) @ centre.T, axis=1) if len(lists) and len(centre) > 1 else np.zeros(len(lists), np.int64)
            offsets = pa.array(np.cumsum([0] + [len(v) for v in lists]).astype(np.int32))
            whole = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(lists) if lists else np.zeros(0)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), whole, batch.column("grp"), pa.array(near.astype(np.int32))], ["id", "label", "v", "grp", "direction"])

    put = rows.mapInArrow(placed, "id bigint, label bigint, v array<double>, grp int, direction int")

    def salted(df, at, limit):
        parts = [max(1, -(-sizes[g][at] // (limit * len(centre)))) if g in sizes else 1 for g in range(GROUPS)]
        return df.withColumn("salt", F.pmod(F.xxhash64("id"), F.element_at(F.array(*map(F.lit, parts)), F.col("grp") + 1)))

    shards, at_shards = S.stored(_packed(salted(put, 0, shard_rows), shard_rows), "shards")
    blocks, at_blocks = S.stored(_packed(salted(put.where(anchor).distinct(), 1, block_rows), block_rows), "blocks")
    n_blocks = blocks.count()
    pairs = _pairs(blocks, shards, shards.count())
    everyone = blocks.select(F.col("no").alias("block"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("m"))
    wants = everyone.select("block", "m", F.lit(0).alias("j"), F.lit(LEAST).alias("least"), F.lit(MOST).alias("most"))
    may_same = pairs.where("grp = s_grp AND lab_lo <= s_lab_hi AND s_lab_lo <= lab_hi")
    near = _searched(may_same, blocks, shards, n_blocks, wants, positives, True)
    near = near.select("block", "m", F.col("rank").alias("j"), "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    wide = F.col("positive_score").cast("decimal(20,0)")
    bands = near.where("positive_score >= 0").select("block", "m", "j", F.ceil(wide * low / 100).cast("bigint").alias("least"), F.floor(wide * high / 100).cast("bigint").alias("most"))
    may_differ = pairs.where("NOT (lab_lo = lab_hi AND s_lab_lo = s_lab_hi AND lab_lo = s_lab_lo)")
    far = _searched(may_differ, blocks, shards, n_blocks, bands, negatives, False)
    S.dropped(spark, at_shards, at_blocks)
    far = far.select("block", "m", "j", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return far.join(near, ["block", "m", "j"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
