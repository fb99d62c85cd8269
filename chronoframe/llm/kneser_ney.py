"""Toxicity by class-conditional Kneser-Ney models.

Two models, of toxic and of ordinary texts, give every word its probability after the
word before it. Each backs off by absolute discounting from the pair of words to the
word, and from the word through its stems of 7, 5 and 3 letters; the lower orders count
distinct left neighbours, not occurrences. The last backoff of both models is shared:
shares of words among their stems in the whole corpus, so an expression that neither
class knows says nothing, and one that a single class knows is held against how common
it is everywhere. A toxic text is ordinary but for some expressions, so its likelihood
is that of the mixture of both models with a share ``TOXIC_SHARE`` of the toxic one. The
difference of the two log-likelihoods per word (length-normalised) goes on a 0-1 scale
by a logistic curve over its logarithm, fitted on training texts that the counts left
out, both classes weighing the same.

What a model says about a word depends only on the word, its stems and its neighbour,
so a trained model is five small tables of log ratios, looked up by hash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _spark as S
from . import _vec as V

DISCOUNT = 0.75
STEMS = (7, 5, 3)
#: Share of the toxic model in a toxic text, and the floor under the mean's logarithm.
TOXIC_SHARE, FLOOR = 0.01, 0.01
LEVELS = ("w", "s7", "s5", "s3")
#: Distinct words whose counts a task holds before it sends them.
HELD = 1 << 18
#: Bytes that end a word: all of ASCII but letters and digits.
_BREAK = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def _tokens(text: pa.Array):
    """Per slice: words, and the hashes of level w, s7, s5, s3."""
    raw, offsets = V.text_bytes(text)
    for a, b in V.steps(offsets):
        w = V.Words(raw, offsets, a, b, _BREAK)
        yield w, [w.hash, *(w.prefix_hash(c, c) for c in STEMS)]


def _previous(w: V.Words) -> np.ndarray:
    """Hash of the word before each word; 0 for a text's first."""
    prev = np.zeros(len(w.hash), V.U)
    prev[1:] = w.hash[:-1]
    start = (np.cumsum(w.count) - w.count)[w.count > 0]
    prev[start] = 0
    return prev


def _pair(prev: np.ndarray, word: np.ndarray) -> np.ndarray:
    return V.mix(prev * V.SEQ + word)


@dataclass
class Model:
    """Sorted hash keys and log ratios (toxic over ordinary) per table."""

    words: tuple
    stems: list  # per stem length, the ratio of a word that the stem's entry does not list
    contexts: tuple
    pairs: tuple
    unseen: float
    slope: float = 1.0
    offset: float = 0.0

    def prepared(self) -> "Model":
        index = lambda t: (V.HashIndex(t[0]), t[1])
        return Model(index(self.words), [index(t) for t in self.stems], index(self.contexts), index(self.pairs), self.unseen, self.slope, self.offset)

    def ratios(self, w: V.Words, levels: list[np.ndarray]) -> np.ndarray:
        """Log ratio of every word of a slice (on a prepared model)."""
        out = np.full(len(w.hash), self.unseen)
        left = np.arange(len(w.hash))
        for (index, value), keys in zip([self.words, *self.stems], levels):
            at = index.find(keys[left])
            out[left[at >= 0]] = value[at[at >= 0]]
            left = left[at < 0]
        prev = _previous(w)
        at = self.contexts[0].find(prev)
        out[at >= 0] += self.contexts[1][at[at >= 0]]
        some = np.flatnonzero(at >= 0)  # pairs are listed only after listed contexts
        pair = self.pairs[0].find(_pair(prev[some], w.hash[some]))
        out[some[pair >= 0]] = self.pairs[1][pair[pair >= 0]]
        return out

    def means(self, text: pa.Array) -> np.ndarray:
        """Length-normalised log ratio of mixture and ordinary model; 0 without words."""
        gain = lambda r: np.log1p(TOXIC_SHARE * np.expm1(np.minimum(r, 50)))
        got = [V.row_sums(gain(self.ratios(w, levels)), w.count) / np.maximum(w.count, 1) for w, levels in _tokens(text)]
        return np.concatenate(got) if got else np.zeros(0)

    def score(self, means: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * _evidence(means) + self.offset, -50, 50)))


def _evidence(means: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(means, 0) + FLOOR)


def _shared_counts(docs: DataFrame, counted: DataFrame) -> tuple[dict[str, tuple], int]:
    """Per level, the sorted hashes that ``counted`` lists and how often each occurs in
    all texts; and how many words there are in all. A task sends a word once, or once
    per HELD distinct ones."""

    def run(batches):
        held, size = [], 0

        def summed():
            rows = np.concatenate(held) if held else np.zeros((0, 5), np.int64)
            _, first, at = np.unique(rows[:, 0], return_index=True, return_inverse=True)
            out = rows[first]
            out[:, 4] = np.bincount(at, rows[:, 4], len(first)).astype(np.int64)
            return out

        def sent(rows):
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], [*LEVELS, "n"])

        for batch in batches:
            for _, levels in _tokens(batch.column(0)):
                _, first, n = np.unique(levels[0], return_index=True, return_counts=True)
                held.append(np.column_stack([*(x.view(np.int64)[first] for x in levels), n]))
                size += len(first)
            if size >= 2 * HELD:
                held = [summed()]
                size = len(held[0])
                if size >= HELD:
                    yield sent(held[0])
                    held, size = [], 0
        yield sent(summed())

    words = docs.mapInArrow(run, ", ".join(f"{x} bigint" for x in (*LEVELS, "n")))
    words, at = S.stored(words.groupBy(*LEVELS).agg(F.sum("n").alias("n")), "toxic-words")
    out = {}
    for level in LEVELS:
        keys, n = _columns(words.join(counted.select(level).distinct(), level).groupBy(level).agg(F.sum("n").alias("n")), level, "n")
        order = np.argsort(keys)
        out[level] = keys[order], n[order]
    total = words.agg(F.sum("n")).first()[0] or 0
    S.dropped(docs.sparkSession, at)
    return out, total


def _counted(rows: DataFrame) -> DataFrame:
    """(toxic, prev, w, s7, s5, s3, n) over labelled texts."""

    def run(batches):
        for batch in batches:
            label = batch.column(1).to_numpy()
            done = 0
            for w, levels in _tokens(batch.column(0)):
                owner = np.repeat(label[done : done + len(w.count)], w.count)
                done += len(w.count)
                key = _pair(_previous(w), w.hash) + owner.astype(V.U)
                _, first, n = np.unique(key, return_index=True, return_counts=True)
                cols = [owner.astype(np.int32)[first], _previous(w).view(np.int64)[first], *(x.view(np.int64)[first] for x in levels), n]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["toxic", "prev", *LEVELS, "n"])

    raw = rows.select("text", F.col("toxic").cast("int")).mapInArrow(run, "toxic int, prev bigint, w bigint, s7 bigint, s5 bigint, s3 bigint, n bigint")
    return raw.groupBy("toxic", "prev", *LEVELS).agg(F.sum("n").alias("n"))


def _columns(df: DataFrame, *names: str) -> list[np.ndarray]:
    got = df.select(*names).toArrow()
    return [got.column(n).to_numpy() for n in names]


def _both(keys: np.ndarray, labels: np.ndarray, values: np.ndarray):
    """Distinct keys, and values summed per (key, class)."""
    uniq, at = np.unique(keys, return_inverse=True)
    out = np.zeros((2, len(uniq)))
    np.add.at(out, (labels, at), values)
    return uniq, out


def _leftover(have: np.ndarray, at: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Per class and context, the share that its listed pairs (pair i after context
    ``at[i]``) leave; with their discounted shares it makes 1."""
    left = have.copy()
    for c in (0, 1):
        np.subtract.at(left[c], at, np.maximum(seen[c] - DISCOUNT, 0))
    return np.where(have > 0, left / np.maximum(have, 1), 1.0)


def _fit_tables(counted: DataFrame, shared: dict[str, tuple], total_words: int, min_pair: int, min_context: int) -> Model:
    safe = lambda p: np.log(np.maximum(p, 1e-300))
    common = lambda level, keys: shared[level][1][np.searchsorted(shared[level][0], keys)] + 0.5
    by_word = counted.groupBy("toxic", *LEVELS).agg(F.count("*").alias("n"))
    label, *keys, n = _columns(by_word, "toxic", *LEVELS, "n")
    words, cont = _both(keys[0], label, n)
    first = np.zeros(len(words), np.int64)
    first[np.searchsorted(words, keys[0])] = np.arange(len(keys[0]))
    ids, counts, parent, tables = [words], [cont], [], []
    for level in keys[1:]:
        of_word = level[first]
        uniq, at = np.unique(of_word, return_inverse=True)
        up = np.zeros((2, len(uniq)))
        for c in (0, 1):
            np.add.at(up[c], at, cont[c])
        ids.append(uniq), counts.append(up), parent.append(at)
    # at[i]: the entry of level i+1 that each *word* belongs to; turn into per-entry parents
    chain = []
    for i in range(len(ids) - 1):
        mine = np.arange(len(words)) if i == 0 else parent[i - 1]
        up = np.zeros(len(ids[i]), np.int64)
        up[mine] = parent[i]
        chain.append(up)
    total = counts[-1].sum(axis=1)
    kinds = (counts[-1] > 0).sum(axis=1)
    top = common(LEVELS[-1], ids[-1])
    logp = safe((np.maximum(counts[-1] - DISCOUNT, 0) + DISCOUNT * kinds[:, None] * (top / max(1.0, total_words))) / np.maximum(total, 1)[:, None])
    escape = safe(DISCOUNT * kinds / np.maximum(total, 1))
    unseen = float(escape[1] - escape[0])
    stems = []
    for i in range(len(ids) - 2, -1, -1):
        up, above = chain[i], counts[i + 1]
        types = np.zeros_like(above)
        for c in (0, 1):
            np.add.at(types[c], up, counts[i][c] > 0)
        lam = np.where(above > 0, DISCOUNT * types / np.maximum(above, 1), 1.0)
        stems.insert(0, (ids[i + 1].view(np.uint64), (logp[1] - logp[0]) + safe(lam[1]) - safe(lam[0])))
        share = np.minimum(1.0, common(LEVELS[i], ids[i]) / common(LEVELS[i + 1], ids[i + 1])[up])
        p = np.where(above[:, up] > 0, (np.maximum(counts[i] - DISCOUNT, 0) / np.maximum(above[:, up], 1)) + lam[:, up] * share, share)
        logp = logp[:, up] + safe(p)
    word_logp = logp
    # Contexts and pairs.
    around = counted.where("prev <> 0").groupBy("prev").agg(*(F.sum(F.when(F.col("toxic") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in (0, 1)))
    prev, n0, n1 = _columns(around.where(f"n0 + n1 >= {min_context}"), "prev", "n0", "n1")
    have = np.array([n0, n1], float).reshape(2, -1)
    both = counted.where("prev <> 0").groupBy("prev", "w").agg(*(F.sum(F.when(F.col("toxic") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in (0, 1))).where(f"n0 + n1 >= {min_pair}")
    p_prev, p_word, m0, m1 = _columns(both, "prev", "w", "n0", "n1")
    order = np.argsort(prev)
    at = np.searchsorted(prev[order], p_prev)
    at = order[np.minimum(at, max(0, len(order) - 1))] if len(order) else np.zeros(0, np.int64)
    known = prev[at] == p_prev if len(order) else np.zeros(len(p_prev), bool)
    p_prev, p_word, at = p_prev[known], p_word[known], at[known]
    seen = np.array([m0[known], m1[known]], float).reshape(2, -1)
    # What the listed pairs leave goes to the lower order, that of pairs not listed too.
    lam = _leftover(have, at, seen)
    contexts = (prev.view(np.uint64), safe(lam[1]) - safe(lam[0]))
    lower = np.exp(word_logp[:, np.searchsorted(words, p_word)]) if len(p_word) else np.zeros((2, 0))
    p = np.where(have[:, at] > 0, (np.maximum(seen - DISCOUNT, 0) / np.maximum(have[:, at], 1)) + lam[:, at] * lower, lower)
    pairs = (_pair(p_prev.view(np.uint64), p_word.view(np.uint64)), safe(p[1]) - safe(p[0]))
    return Model((words.view(np.uint64), word_logp[1] - word_logp[0]), stems, contexts, pairs, unseen)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset by Newton steps on the weighted, slightly ridged likelihood."""
    if len(set(y.tolist())) < 2:
        return 1.0, 0.0
    scale = max(float(np.std(x)), 1e-9)
    z = np.column_stack([x / scale, np.ones(len(x))])
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        grad = z.T @ (weight * (y - p)) - ridge * len(x) * np.array([b[0], 0])
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge * len(x) * np.eye(2)
        step = np.linalg.solve(hess, grad)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0] / scale), float(b[1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fit_rows: int = 5000, min_pair: int = 3, min_context: int = 5) -> Model:
    """Fit on labelled texts; shared counts are exact, over all of ``docs``.

    Class counts and the logistic curve use a sample of about ``fit_rows`` labelled
    texts per class, picked by a hash of the id (all, if there are fewer): the bound of
    everything that reaches the driver.
    Pairs of words seen less than ``min_pair`` times and contexts seen less than
    ``min_context`` times back off. Rows without text or label are not fitted on; an id
    with both labels counts for each.
    """
    spark = docs.sparkSession
    S.text_batches(spark)
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lab = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("toxic")).where("toxic IN (0, 1) AND _id IS NOT NULL").distinct()
    have = {r["toxic"]: r["n"] for r in lab.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.lit("fit"), F.col("_id")), F.lit(1 << 20)) / (1 << 20)
    share = F.when(F.col("toxic") == 1, fit_rows / max(1, have.get(1, 0))).otherwise(fit_rows / max(1, have.get(0, 0)))
    lab = lab.where(draw < share).withColumn("held", F.pmod(F.xxhash64(F.lit("curve"), F.col("_id")), F.lit(4)) == 0)
    sample, at = S.stored(texts.join(F.broadcast(lab), "_id").select("text", "toxic", "held"), "toxic-sample")
    counted = _counted(sample.where("NOT held")).checkpoint()
    shared, total_words = _shared_counts(texts.select("text"), counted)
    model = _fit_tables(counted, shared, total_words, min_pair, min_context)
    sent = spark.sparkContext.broadcast(model)

    def measure(batches):
        m = sent.value.prepared()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(m.means(batch.column(0))), batch.column(1)], ["mean", "toxic"])

    mean, toxic = _columns(sample.where("held").select("text", "toxic").mapInArrow(measure, "mean double, toxic int"), "mean", "toxic")
    toxic = toxic.astype(float)
    weight = np.where(toxic == 1, (toxic == 0).sum() / max(1.0, toxic.sum()), 1.0)
    model.slope, model.offset = _logistic(_evidence(mean), toxic, weight)
    S.dropped(spark, at)
    return model


def scores(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``mean_ratio`` and ``score`` (0 to 1); columns of
    these names, in any case, are replaced.

    A null text is empty; an empty text has mean ratio 0, so the score of no evidence.
    """
    spark = docs.sparkSession
    S.text_batches(spark)
    sent = spark.sparkContext.broadcast(model)
    passed = S.others(docs, text_col, "mean_ratio", "score")

    def run(batches):
        m = sent.value.prepared()
        for batch in batches:
            mean = m.means(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(mean), pa.array(m.score(mean))], [*passed, "mean_ratio", "score"])

    rows, schema = S.with_last(docs, passed, text_col)
    return rows.mapInArrow(run, schema.add("mean_ratio", "double").add("score", "double"))
