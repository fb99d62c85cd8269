"""Distinct sampled segmentations of a text over a SentencePiece vocabulary: Gumbel
top-k without replacement by perturbed A-star search, and decoding.

A segmentation's probability is the product of its pieces' probabilities, normalised
over the lattice of all segmentations. Perturbing every segmentation's log-probability
with its own Gumbel noise and taking the k largest draws k without replacement. The
search never lists them: the noise of a set of segmentations is that of its summed
probability, so the best of the whole lattice is drawn first and handed down, at each
node, to one edge picked by its share, while all other edges of the node together get
the best value below it that their summed share allows. Exact backward sums over the
lattice make every node's bound tight (the A-star heuristic), so each next sample is
the largest set kept, descended the same way.

The inclusion score of a sample with log-probability p is ``1 - exp(-exp(p - t))``, with
t the (k+1)-th largest perturbed value.

The vocabulary's pieces are ordered by merge rank and carry no probabilities, so a piece
of rank r gets a share proportional to ``1 / (r + 2.7)`` (Zipf). Nothing is trained.
Pieces never join the end of one word to the blank of the next, so the lattice falls
apart at word starts; equal words of a slice share their lattice. Randomness is a hash
of the row key, the sample and the place in the text, independent of partitioning.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _spark as S
from . import _vec as V

STEP_CHARS = 500_000
BLANK = "▁"
_BLANK = ord(BLANK)


class Pieces:
    """Vocabulary as hash tables of piece strings and their proper prefixes."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        self.byte_of = {int(i): b for b, i in enumerate(self.byte_ids)}
        self.hidden = {i for i in range(size) if sp.is_control(i)}
        plain.sort(key=lambda i: (-sp.get_score(i), i))
        if any(c == BLANK and p and p[-1] != BLANK for i in plain for p, c in ((self.text[i][:j], self.text[i][j]) for j in range(1, len(self.text[i])))):
            raise ValueError("a piece spans a word's end and the next blank; the lattice would not fall apart at words")
        share = -np.log(np.arange(len(plain)) + 2.7)
        norm = np.log(np.exp(share).sum() + 256 / (len(plain) + 2.7))
        self.byte_score = float(-np.log(len(plain) + 2.7) - norm)
        # Trie: a state per distinct prefix; transitions by hash of (state, code point).
        state, steps = {"": 0}, []
        self.id, self.score = [-1], [0.0]
        for i, sc in zip(plain, share - norm):
            at = 0
            for j in range(1, len(self.text[i]) + 1):
                prefix = self.text[i][:j]
                if prefix not in state:
                    state[prefix] = len(state)
                    steps.append((at << 21) | ord(prefix[-1]))
                    self.id.append(-1), self.score.append(0.0)
                at = state[prefix]
            self.id[at], self.score[at] = i, float(sc)
        self.id, self.score = np.array(self.id, np.int32), np.array(self.score)
        self.longest = max(map(len, state))
        self.first = np.full(0x110000, -1, np.int32)
        steps = np.array(steps, np.int64)
        root = steps < 1 << 21
        to = np.arange(1, len(state), dtype=np.int32)
        self.first[steps[root]] = to[root]
        self.index, self.to = V.HashIndex(V.mix(steps.view(V.U))), to

    def step(self, state: np.ndarray, point: np.ndarray) -> np.ndarray:
        """Next states, -1 where no piece goes on so."""
        at = self.index.find(V.mix((state.astype(V.U) << V.U(21)) | point.astype(V.U)))
        return np.where(at >= 0, self.to[at], -1)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _prefix_sums(points: np.ndarray):
    run = np.zeros(len(points) + 1, V.U)
    np.cumsum((points.astype(V.U) + V.U(1)) * V.powers(V.BYTE, len(points)), out=run[1:])
    return run, V.powers(V.BYTE_INV, len(points) + 1)


def _substring(run, inv, start, n):
    return V.mix((run[start + n] - run[start]) * inv[start] + n.astype(V.U) * V.SEQ)


def _stream(key: np.ndarray, what: int) -> np.ndarray:
    """One random stream per row key and purpose."""
    return V.mix(key + V.salt(what))


def _uniform(stream: np.ndarray, at: np.ndarray) -> np.ndarray:
    """In (0, 1), by stream and place."""
    h = V.mix(stream + at.astype(V.U) * V.SEQ)
    return ((h >> V.U(12)).astype(np.float64) + 0.5) * 2.0**-52


class Lattice:
    """Lattices of the distinct words of a slice, edges grouped by source node."""

    def __init__(self, vocab: Pieces, points: np.ndarray, start: np.ndarray, size: np.ndarray):
        chars = points[V.ranges(start, size)].astype(np.int64)
        begin = np.cumsum(size) - size
        end = np.repeat(begin + size, size)
        left = end - np.arange(len(chars))  # characters to the word's end
        # Nodes are the characters, nearest to their word's end first.
        order = np.argsort(left.astype(np.uint16) if len(left) and left.max() < 1 << 16 else left, kind="stable")
        name = np.empty(len(chars) + 1, np.int64)
        name[order] = np.arange(len(chars))
        name[-1] = len(chars)
        left = left[order]
        wide = vocab.longest
        hits = np.full((len(chars), wide), -1, np.int32)  # column wide - n: the state after n characters
        state = vocab.first[chars[order]]
        live = np.flatnonzero(state >= 0)
        state = state[live]
        for n in range(1, wide + 1):
            some = vocab.id[state] >= 0
            hits[live[some], wide - n] = state[some]
            go = left[live] > n
            live, state = live[go], state[go]
            if not len(live) or n == wide:
                break
            state = vocab.step(state, chars[order[live] + n])
            live, state = live[state >= 0], state[state >= 0]
        # A character that is no piece goes as its bytes: state 0.
        bare = hits[:, wide - 1] < 0
        hits[bare, wide - 1] = 0
        flat = np.flatnonzero(hits.ravel() >= 0)
        self.src, column = np.divmod(flat, wide)
        self.length = wide - column
        state = hits.ravel()[flat]
        self.ids, score = vocab.id[state].astype(np.int64), vocab.score[state]
        spelled = np.flatnonzero(state == 0)
        point = chars[order[self.src[spelled]]]
        self.ids[spelled] = -1 - point
        score[spelled] = (1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF)) * vocab.byte_score
        self.degree = np.bincount(self.src, minlength=len(chars))
        self.first = np.cumsum(self.degree) - self.degree
        into = np.where(self.length < left[self.src], name[np.minimum(order[self.src] + self.length, len(chars))], len(chars))
        # Backward sums, nearest to the word's end first; beyond the end it is 0.
        back = np.zeros(len(chars) + 1)
        value = np.empty(len(flat))
        cuts = np.flatnonzero(np.append(True, left[1:] != left[:-1])) if len(left) else np.zeros(0, np.int64)
        for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(left)).tolist()):
            n = self.degree[a:b]
            x, y = self.first[a], self.first[b - 1] + self.degree[b - 1]
            v = score[x:y] + back[into[x:y]]
            head = self.first[a:b] - x
            top = np.maximum.reduceat(v, head)
            total = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, n)), head))
            back[a:b] = total
            value[x:y] = v - np.repeat(total, n)
        self.logp = np.minimum(value, 0.0)  # conditional on the source node
        share = np.exp(value)
        run = np.cumsum(share)
        self.reach = run - (run[self.first] - share[self.first])[self.src]  # cumulated within the node
        self.reach[self.first + self.degree - 1] = 2.0
        self.other = np.full(len(flat), -np.inf)
        several = np.flatnonzero(self.degree[self.src] > 1)
        self.other[several] = np.log(np.maximum(-np.expm1(self.logp[several]), 1e-300))
        self.left, self.order, self.name, self.word = left, order, name, begin

    def inside(self, word: np.ndarray, offset: np.ndarray) -> np.ndarray:
        """Nodes of the characters at ``offset`` of the given words."""
        return self.name[self.word[word] + offset]

    def draw(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge of each node by conditional probability."""
        e = self.first[node]
        on = np.flatnonzero(u >= self.reach[e])
        while len(on):
            e[on] += 1
            on = on[u[on] >= self.reach[e[on]]]
        return e

    def walk(self, node: np.ndarray, place: np.ndarray, stream: np.ndarray):
        """Edges from each node to its word's end: (which start, edge, place), in order."""
        who, owner, edges, places = np.arange(len(node)), [], [], []
        while len(who):
            e = self.draw(node, _uniform(stream[who], place))
            owner.append(who), edges.append(e), places.append(place)
            n = self.length[e]
            more = np.flatnonzero(n < self.left[node])
            node = self.name[self.order[node[more]] + n[more]]
            who, place = who[more], place[more] + n[more]
        owner, edges, places = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (owner, edges, places))
        order = np.argsort(owner, kind="stable")
        return owner[order], edges[order], places[order]


#: Least value of log(-log(u)) of a uniform of this module; it bounds what noise can do.
LEAST_NOISE = -37.0


class _Path:
    """One segmentation of a text, and for each of its nodes the set of the node's other
    edges, whose best value below the path's own is ``-logaddexp(-value, late)``."""

    def __init__(self, lat: Lattice, edges, places, fresh: int, value: float, stream, k: int):
        self.edges, self.places, self.value, self.gone = edges, places, value, {}
        run = np.concatenate(([0.0], np.cumsum(lat.logp[edges])))
        self.before, self.logp = run[:-1], float(run[-1])
        # late = noise - log-share of the set. Nodes so deep that even the least noise
        # leaves them later than k + 1 others are never among the next k samples.
        self.late = np.full(len(edges), np.inf)
        a, step, kth = fresh, 128, min(k, max(0, len(edges) - 1))
        while a < len(edges):
            b = min(a + step, len(edges))
            noise = np.log(-np.log(_uniform(stream, places[a:b])))
            self.late[a:b] = noise - (self.before[a:b] + lat.other[edges[a:b]])
            if b < len(edges) and LEAST_NOISE - self.before[b] > np.partition(self.late, kth)[kth]:
                break
            a, step = b, 4 * step

    def best(self) -> tuple[float, int]:
        """Value of the best set left, and its node; -inf if none is."""
        if not len(self.late):
            return -np.inf, 0
        t = int(self.late.argmin())
        return float(-np.logaddexp(-self.value, self.late[t])) if self.late[t] < np.inf else -np.inf, t


def _sampled(vocab: Pieces, texts: list[str], keys: np.ndarray, k: int):
    """Per text a list of (ids, log-probability, perturbed value, inclusion score)."""
    lined = [BLANK + t.replace(" ", BLANK) if t else "" for t in texts]
    size = np.array([len(t) for t in lined], np.int64)
    points = np.frombuffer("".join(lined).encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(points):
        return [[] for _ in texts]
    start = np.cumsum(size) - size
    blank = points == _BLANK
    head = blank.copy()
    head[1:] &= ~blank[:-1]
    head[start[size > 0]] = True
    at = np.flatnonzero(head)
    n = np.diff(np.append(at, len(points)))
    run, inv = _prefix_sums(points)
    _, pick, word = np.unique(_substring(run, inv, at, n), return_index=True, return_inverse=True)
    lat = Lattice(vocab, points, at[pick], n[pick])
    node = lat.inside(word, np.zeros(len(word), np.int64))
    doc = np.searchsorted(start, at, side="right") - 1  # an empty text shares its start with the next
    place = at - start[doc]
    first_word = np.searchsorted(doc, np.arange(len(texts)))
    end_word = np.searchsorted(doc, np.arange(len(texts)), side="right")

    found: list[list[_Path]] = [[] for _ in texts]
    owner, edges, places = lat.walk(node, place, _stream(keys, 1)[doc])
    noise, root = _stream(keys, 2), _uniform(_stream(keys, 3), np.zeros(len(texts), np.int64))
    cut = np.searchsorted(owner, first_word), np.searchsorted(owner, end_word)
    for d in np.flatnonzero(size > 0).tolist():
        a, b = cut[0][d], cut[1][d]
        found[d].append(_Path(lat, edges[a:b], places[a:b], 0, float(-np.log(-np.log(root[d]))), noise[d], k))
    bound = np.full(len(texts), -np.inf)
    for r in range(1, k + 1):
        todo, starts, spots, who = [], [], [], []
        pick_stream, noise_stream = _stream(keys, 4 * r + 1), _stream(keys, 4 * r + 2)
        for d, paths in enumerate(found):
            if len(paths) != r:
                continue  # empty, or all its segmentations are taken
            (value, t), p = max(((p.best(), p) for p in paths), key=lambda x: x[0][0])
            bound[d] = value
            if value == -np.inf or r == k:
                continue
            # The other edges of node t: one gets the value, the rest stay a set.
            e0 = int(p.edges[t])
            gone = p.gone.setdefault(t, {e0})
            lo = int(lat.first[lat.src[e0]])
            options = [e for e in range(lo, lo + int(lat.degree[lat.src[e0]])) if e not in gone]
            share = np.exp(lat.logp[options])
            here = p.places[t : t + 1]
            u = _uniform(pick_stream[d], here)[0]
            e1 = options[min(int(np.searchsorted(np.cumsum(share) / share.sum(), u)), len(options) - 1)]
            gone.add(e1)
            kept = sum(float(np.exp(lat.logp[e])) for e in options if e != e1)
            # What is left of the set lies below the value just taken.
            late = np.log(-np.log(_uniform(noise_stream[d], here)[0])) - (p.before[t] + np.log(kept)) if kept > 0 else np.inf
            p.late[t] = np.logaddexp(late, np.log(np.maximum(np.expm1(p.value - value), 0)) - p.value if p.value > value else -np.inf)
            spot = int(here[0]) + int(lat.length[e1])
            w = first_word[d] + int(np.searchsorted(place[first_word[d] : end_word[d]], here[0], side="right")) - 1
            mid = spot < place[w] + n[w]
            first = lat.inside(word[w : w + 1], np.array([spot - place[w]])) if mid else []
            words = slice(w + 1, end_word[d])
            starts.append(np.concatenate((np.array(first, np.int64), node[words])))
            spots.append(np.concatenate((np.array([spot] if mid else [], np.int64), place[words])))
            who.append(np.full(len(starts[-1]), d))
            todo.append((d, p, t, e1, value))
        if not todo:
            continue
        counts = np.cumsum([0] + [len(x) for x in starts])
        owner, edges, places = lat.walk(np.concatenate(starts), np.concatenate(spots), _stream(keys, 4 * r + 3)[np.concatenate(who)])
        below = _stream(keys, 4 * r + 4)
        cuts = np.searchsorted(owner, counts)
        for (d, p, t, e1, value), x, y in zip(todo, cuts, cuts[1:]):
            all_edges = np.concatenate((p.edges[:t], [e1], edges[x:y]))
            found[d].append(_Path(lat, all_edges, np.concatenate((p.places[: t + 1], places[x:y])), t + 1, value, below[d], k))
    out = []
    for d, paths in enumerate(found):
        out.append([(_ids(vocab, lat.ids[p.edges]), p.logp, p.value, float(-np.expm1(-np.exp(min(p.logp - bound[d], 700.0))))) for p in paths])
    return out


def _ids(vocab: Pieces, ids: np.ndarray) -> np.ndarray:
    short = (ids < 0) & (ids >= -0x80)
    if short.any():
        ids = np.where(short, vocab.byte_ids[np.where(short, -1 - ids, 0)], ids)
    if len(ids) and ids.min() < 0:
        parts, at = [], 0
        for i in np.flatnonzero(ids < 0).tolist():
            raw = chr(-1 - int(ids[i])).encode("utf-8", "surrogatepass")
            parts += [ids[at:i], vocab.byte_ids[list(raw)]]
            at = i + 1
        ids = np.concatenate([*parts, ids[at:]])
    return ids.astype(np.int32)


def sample_encodings(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", k: int = 3, seed: int = 0) -> DataFrame:
    """``doc_id, sample (from 1), ids, log_prob, perturbed, inclusion``: up to k distinct
    segmentations per row, by falling perturbed value.

    Fewer rows only if the text has fewer segmentations. A null or empty text has the
    empty segmentation: one row without ids, log_prob 0 and inclusion 1 (perturbed null). The row
    key is doc_id; rows with equal doc_id and text get equal samples, a null doc_id is a
    key like any other. model_path: vocabulary file, the same path on every executor.
    """
    S.text_batches(docs.sparkSession)
    names = ["doc_id", "sample", "ids", "log_prob", "perturbed", "inclusion"]

    def run(batches):
        vocab = pieces(model_path)
        for batch in batches:
            ids, keys = batch.column(0).to_pylist(), batch.column(1).to_numpy().view(np.uint64)
            texts = [t or "" for t in batch.column(2).to_pylist()]
            a = 0
            while a < len(texts):
                b, size = a + 1, len(texts[a])
                while b < len(texts) and size + len(texts[b]) <= STEP_CHARS:
                    size += len(texts[b])
                    b += 1
                rows = [(ids[a + i], s + 1, *x) for i, got in enumerate(_sampled(vocab, texts[a:b], keys[a:b], k)) for s, x in enumerate(got or [(np.zeros(0, np.int32), 0.0, None, 1.0)])]
                end = np.concatenate(([0], np.cumsum([len(r[2]) for r in rows]))).astype(np.int32)
                flat = np.concatenate([r[2] for r in rows])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.ListArray.from_arrays(pa.array(end), pa.array(flat, pa.int32())), *(pa.array([r[i] for r in rows], pa.float64()) for i in (3, 4, 5))], names
                )
                a = b

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(F.lit(seed), F.col(id_col).cast("string")).alias("key"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, sample int, ids array<int>, log_prob double, perturbed double, inclusion double")


def decoded(vocab: Pieces, ids: list[int]) -> str:
    """Text of a sequence of ids; byte ids join up as UTF-8 (broken runs as U+FFFD)."""
    out, raw = [], bytearray()
    for i in ids:
        if i in vocab.byte_of:
            raw.append(vocab.byte_of[i])
            continue
        if raw:
            out.append(raw.decode("utf-8", "replace"))
            raw.clear()
        if i not in vocab.hidden:
            out.append(vocab.text[i])
    if raw:
        out.append(raw.decode("utf-8", "replace"))
    text = "".join(out).replace(BLANK, " ")
    return text[1:] if text[:1] == " " else text


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``text`` (replaced if there): the inverse of any segmentation, except that U+2581
    comes back as a blank (the vocabulary's own sign for it). Null ids give null."""
    S.text_batches(encoded.sparkSession)
    encoded = encoded.drop("text")
    names = encoded.columns
    at = names.index(ids_col)

    def run(batches):
        vocab = pieces(model_path)
        for batch in batches:
            texts = [None if x is None else decoded(vocab, x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, "text"])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("text", T.StringType())]))
