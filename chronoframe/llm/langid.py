"""Language ID by language-bitmask n-gram filters.

Training counts the letter n-grams of every labelled text per language. A language's
set holds its most frequent n-grams, down to the count with which they make up the share
``coverage`` of all its occurrences, whatever other languages contain; n-grams rarer
than ``min_rate`` are noise, so a set has at most ``1 / min_rate`` members whatever the
corpus. The sets go into one bit-sliced Bloom filter, sized by the largest set: a slot is a bitmask with one bit per language, an n-gram sets its language's
bit in ``hashes`` slots, and the AND of the slots is the set of all languages that
contain the n-gram, found at once.

A text's n-grams give one popcount per language. Slots fill by chance, so a language's
filter also accepts a known share f of foreign n-grams: with c hits among n n-grams the
corrected share is ``(c / n - f) / (1 - f)``, over the share of the language's own
occurrences that its set covers: a language of many rare n-grams is held against what
its own texts reach. The largest one decides.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _spark as S
from . import _vec as V

STEP_CHARS = 500_000
UNKNOWN = "und"
_SPACE, _LINE = 0x20, 0x0A


def _letters() -> np.ndarray:
    """Letter flags of the code points of the basic plane (others: asked one by one)."""
    return np.array([chr(i).isalpha() for i in range(0x10000)])


class Grams:
    """Hashes of the letter n-grams of texts, words padded by a blank on either side."""

    def __init__(self, n: int):
        self.n, self.letter = n, _letters()

    def of(self, texts: list[str]):
        """(hashes, n-grams per text, has a letter per text)."""
        low = [t.lower() for t in texts]
        points = np.frombuffer("\n".join(["", *low, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
        is_letter = self.letter[np.minimum(points, 0xFFFF)]
        high = points > 0xFFFF
        if high.any():
            is_letter = is_letter | (high & np.array([chr(p).isalpha() for p in points.tolist()]) if high.sum() > 1000 else self._few(points, high))
        size = np.array([len(t) for t in low], np.int64)
        # Row numbers per code point; rows are separated by one line break.
        row = np.repeat(np.arange(len(low)), size + 1)
        here = np.where(is_letter, points, _SPACE).astype(V.U)
        # Drop the blanks after a blank: one blank between words.
        keep = is_letter.copy()
        keep[1:] |= is_letter[:-1]
        keep[0] = True
        owner = np.concatenate(([0], row))[keep]
        here = here[keep]
        m = len(here) - self.n + 1
        if m <= 0:
            return np.zeros(0, V.U), np.zeros(len(low), np.int64), np.zeros(len(low), bool)
        acc = np.zeros(m, V.U)
        blanks = np.zeros(m, np.int8)
        for j in range(self.n):
            acc = acc * V.SEQ + here[j : j + m]
            if 0 < j < self.n - 1:
                blanks += here[j : j + m] == _SPACE
        good = blanks == 0  # inside one word with its padding
        where = owner[self.n // 2 : self.n // 2 + m][good]
        letters = np.bincount(np.concatenate(([0], row))[is_letter], minlength=len(low)) > 0 if is_letter.any() else np.zeros(len(low), bool)
        return V.mix(acc[good]), np.bincount(where, minlength=len(low))[: len(low)], letters[: len(low)]

    @staticmethod
    def _few(points, high):
        out = np.zeros(len(points), bool)
        at = np.flatnonzero(high)
        out[at] = [chr(p).isalpha() for p in points[at].tolist()]
        return out


def _slices(texts: list[str]):
    """Consecutive slices of about STEP_CHARS characters."""
    a, size = 0, 0
    for b, t in enumerate(texts):
        if size and size + len(t) > STEP_CHARS:
            yield a, b
            a, size = b, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


@dataclass
class LanguageFilter:
    """The trained bit-sliced filter: slots[word][slot] holds bits of 64 languages."""

    languages: list[str]
    n: int
    hashes: int
    slots: np.ndarray
    false_rate: np.ndarray
    cover: np.ndarray

    def masks(self, grams: np.ndarray) -> list[np.ndarray]:
        """Per 64 languages: the bitmask of those that contain each n-gram."""
        size = V.U(self.slots.shape[1] - 1)
        out = []
        for plane in self.slots:
            got = None
            for r in range(self.hashes):
                slot = plane[(V.mix(grams + V.salt(r + 1)) & size).astype(np.int64)]
                got = slot if got is None else got & slot
            out.append(got)
        return out

    def scores(self, grams: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Corrected share per text (rows) and language (columns); it may exceed 1."""
        out = np.zeros((len(count), len(self.languages)))
        masks = self.masks(grams)
        for i in range(len(self.languages)):
            hit = ((masks[i // 64] >> V.U(i % 64)) & V.U(1)).astype(np.int64)
            out[:, i] = V.row_sums(hit, count)
        return np.maximum((out / np.maximum(count, 1)[:, None] - self.false_rate) / (1 - self.false_rate), 0) / self.cover


#: Distinct n-grams whose counts a task holds before it sends them.
HELD = 1 << 19


def counted(labelled: DataFrame, text_col: str, lang_col: str, n: int) -> DataFrame:
    """(lang, gram, n): occurrences of every n-gram, known by 64 bits, per language. A
    task sends an n-gram once, or once per HELD distinct ones."""

    def run(batches):
        grams, held, size = Grams(n), {}, 0

        def summed(parts):
            keys, counts = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            keys, at = np.unique(keys, return_inverse=True)
            return keys, np.bincount(at, counts, len(keys)).astype(np.int64)

        def sent():
            for lang, parts in held.items():
                keys, counts = summed(parts)
                yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(keys)), pa.array(keys.view(np.int64)), pa.array(counts)], ["lang", "gram", "n"])

        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for a, b in _slices(texts):
                h, per, _ = grams.of(texts[a:b])
                owner = np.repeat(langs[a:b], per)
                for lang in set(langs[a:b].tolist()):
                    got = np.unique(h[owner == lang], return_counts=True)
                    held.setdefault(lang, []).append(got)
                    size += len(got[0])
            if size >= 2 * HELD:
                held = {lang: [summed(parts)] for lang, parts in held.items()}
                size = sum(len(parts[0][0]) for parts in held.values())
                if size >= HELD:
                    yield from sent()
                    held, size = {}, 0
        yield from sent()

    rows = labelled.where(F.col(lang_col).isNotNull()).select(F.col(text_col), F.col(lang_col).cast("string"))
    raw = rows.mapInArrow(run, "lang string, gram bigint, n bigint")
    return raw.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", n: int = 4, coverage: float = 0.99, min_rate: float = 1e-6, hashes: int = 3, slots_per_gram: int = 8) -> LanguageFilter:
    """Learn from every row with a non-null language: n-grams are counted in Spark, and
    each language's set, at most ``1 / min_rate`` hashes, reaches the driver."""
    spark = labelled.sparkSession
    S.text_batches(spark)
    table, at = S.stored(counted(labelled, text_col, lang_col, n), "lang-grams")
    # Counts that occur, from the largest: a set ends with the count that reaches the coverage.
    levels = table.groupBy("lang", "n").agg(F.sum("n").alias("mass"))
    down, whole = Window.partitionBy("lang").orderBy(F.desc("n")), Window.partitionBy("lang")
    levels = levels.withColumn("total", F.sum("mass").over(whole)).withColumn("before", F.sum("mass").over(down) - F.col("mass"))
    inside = levels.where((F.col("before") < coverage * F.col("total")) & (F.col("n") >= min_rate * F.col("total")))
    cuts = inside.groupBy("lang").agg(F.min("n").alias("least"), (F.sum("mass") / F.first("total")).alias("cover"))
    cover = {r["lang"]: r["cover"] for r in cuts.collect()}
    langs = sorted(cover)
    kept = table.join(cuts, "lang").where("n >= least").select("lang", "gram").toArrow()
    S.dropped(spark, at)
    of, grams = kept.column("lang").to_pandas().to_numpy(), kept.column("gram").to_numpy().view(V.U)
    sets = [grams[of == lang] for lang in langs]
    slot_bits = max(10, (slots_per_gram * max(map(len, sets), default=1)).bit_length())
    slots = np.zeros((max(1, -(-len(langs) // 64)), 1 << slot_bits), V.U)
    rates = np.zeros(len(langs))
    for i, member in enumerate(sets):
        for r in range(hashes):
            slots[i // 64, (V.mix(member + V.salt(r + 1)) & V.U((1 << slot_bits) - 1)).astype(np.int64)] |= V.U(1) << V.U(i % 64)
        filled = ((slots[i // 64] >> V.U(i % 64)) & V.U(1)).mean()
        rates[i] = min(filled**hashes, 0.99)
    return LanguageFilter(langs, n, hashes, slots, rates, np.array([cover[x] for x in langs]))


def predict(docs: DataFrame, model: LanguageFilter, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``lang_pred``, ``score`` (the winner's corrected
    share) and ``n_grams`` (how many it rests on); columns of these names, in any case, are replaced.

    ``und`` and 0 for a null text, one without a letter, or an empty model. Ties go to
    the language first by name. Other columns are kept and never read.
    """
    spark = docs.sparkSession
    S.text_batches(spark)
    sent = spark.sparkContext.broadcast(model)
    passed = S.others(docs, text_col, "lang_pred", "score", "n_grams")

    def run(batches):
        m = sent.value
        grams = Grams(m.n)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            names, scores, seen = [], [], []
            for a, b in _slices(texts):
                h, per, letters = grams.of(texts[a:b])
                seen.append(per)
                if m.languages:
                    share = m.scores(h, per)
                    win = share.argmax(axis=1)
                    names += [m.languages[w] if ok else UNKNOWN for w, ok in zip(win, letters)]
                    scores += np.where(letters, np.minimum(share[np.arange(len(win)), win], 1), 0.0).tolist()
                else:
                    names += [UNKNOWN] * (b - a)
                    scores += [0.0] * (b - a)
            cols = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(np.concatenate([np.zeros(0, np.int64), *seen]))], [*passed, "lang_pred", "score", "n_grams"])

    rows, schema = S.with_last(docs, passed, text_col)
    return rows.mapInArrow(run, schema.add("lang_pred", "string").add("score", "double").add("n_grams", "long"))
