"""Cost-balanced packing of documents into sequences of token ids.

A piece of n tokens is estimated to cost ``linear * n + quadratic * n * n`` (layers work
in proportion to n, attention to its square). Documents are taken in descending length;
each goes to the sequence of lowest cost so far that still has room for all of it. When
none has, the sequence of lowest cost with any room is filled up and the rest of the
document is taken again at its own length. So long and short documents mix, and no
sequence holds much more attention work than another.

A buffer's sequences have together as many places as it has tokens: full ones of
``row_len``, and for the remainder one for each of its binary digits. A length that is a
power of two needs no padding, so there is none. Tasks pack their own rows in buffers of
bounded size: nothing is shuffled, and a lost task packs the same split alike.
"""

from __future__ import annotations

import heapq
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _spark as S
from . import _vec as V

#: Longer words are tokenised each time, shorter ones once per worker while they are held.
WORD_BYTES, WORDS_HELD, IDS_HELD = 128, 1_000_000, 8_000_000
#: A text with a special token's string is tokenised in parts of about this many characters.
PART_CHARS = 200_000
#: Fixed: what opens the vocabulary's special tokens. No word of a text that holds it is held.
SPECIAL = b"<|"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b',.;:!?)]}"')] = True


class Balance:
    """Open sequences by room: a tree over rooms 0..size whose nodes hold the least
    (cost, sequence) below them."""

    def __init__(self, size: int):
        self.leaves = 1 << int(size).bit_length()
        self.least: list = [None] * (2 * self.leaves)
        self.open: dict[int, list] = {}

    def _refresh(self, room: int) -> None:
        at, least = room + self.leaves, self.least
        least[at] = self.open[room][0] if self.open.get(room) else None
        while at > 1:
            at >>= 1
            a, b = least[2 * at], least[2 * at + 1]
            new = a if b is None or (a is not None and a <= b) else b
            if least[at] == new:
                break
            least[at] = new

    def put(self, room: int, cost: float, sequence: int) -> None:
        heapq.heappush(self.open.setdefault(room, []), (cost, sequence, room))
        self._refresh(room)

    def take(self, need: int) -> tuple[float, int, int] | None:
        """(cost, sequence, room) of lowest cost with room >= need, removed."""
        lo, hi, best = need + self.leaves, 2 * self.leaves, None
        while lo < hi:
            if lo & 1:
                if (x := self.least[lo]) is not None and (best is None or x < best):
                    best = x
                lo += 1
            lo, hi = lo >> 1, hi >> 1
        if best is not None:
            heapq.heappop(self.open[best[2]])
            self._refresh(best[2])
        return best


def capacities(tokens: int, row_len: int) -> list[int]:
    """Sequence lengths that add up to ``tokens``: full ones, then powers of two."""
    full, rest = divmod(tokens, row_len)
    return [row_len] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def balanced(lengths: list[int], row_len: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(item, start, length, sequence, offset) of every piece."""
    room, used = Balance(row_len), []
    for seq, size in enumerate(capacities(sum(lengths), row_len)):
        room.put(size, 0.0, seq)
        used.append(0)
    heap = [(-n, i, 0) for i, n in enumerate(lengths) if n]
    heapq.heapify(heap)
    out = []
    while heap:
        n, i, start = heapq.heappop(heap)
        n = -n
        cost, seq, free = (room.take(n) if n <= row_len else None) or room.take(1)
        k = min(n, free)
        out.append((i, start, k, seq, used[seq]))
        used[seq] += k
        if free > k:
            room.put(free - k, cost + linear * k + quadratic * k * k, seq)
        if n > k:
            heapq.heappush(heap, (k - n, i, start + k))
    return out


class WordIds:
    """Ids of whole texts by a vocabulary that drops white space and never joins words.

    Texts are cut at white space, and between an ASCII letter and a closing mark, where
    no token can lie across; every distinct piece is tokenised once while it is held.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._clear()

    def _clear(self) -> None:
        self.place: dict[int, int] = {}
        self.start, self.size, self.ids = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(1 << 14, np.uint32)
        self.n_ids = 0

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def whole(self, text: str) -> np.ndarray:
        """Ids of a text by the tokenizer alone; a long one part by part."""
        out, at = [], 0
        while at < len(text):
            end = at + PART_CHARS
            while end < len(text) and text[end] not in " \t\n\r\v\f":
                end += 1
            part = text[at:end].strip(" \t\n\r\v\f")
            if part:
                out.extend(self._encode([part])[0])
            at = end
        return np.array(out, np.uint32)

    def _hold(self, hashes: list[int], words: list[str]) -> None:
        for h, ids in zip(hashes, self._encode(words)):
            at = len(self.place)
            if at == len(self.start):
                self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
            while self.n_ids + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.place[h], self.start[at], self.size[at] = at, self.n_ids, len(ids)
            self.ids[self.n_ids : self.n_ids + len(ids)] = ids
            self.n_ids += len(ids)

    def rows(self, column: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text of the column, nulls as empty."""
        raw, offsets = V.text_bytes(column)
        for a, b in V.steps(offsets):
            if b == a + 1 and offsets[b] - offsets[a] > V.STEP_BYTES or SPECIAL in raw[offsets[a] : offsets[b]].tobytes():
                yield from (self._one(raw[x:y].tobytes()) for x, y in zip(offsets[a:b], offsets[a + 1 : b + 1]))
            else:
                yield from self._step(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])

    def _one(self, data: bytes) -> np.ndarray:
        if SPECIAL in data:
            return self.whole(data.decode())
        parts, at = [], 0
        while at < len(data):  # a very long text, cut at white space
            end = min(len(data), at + V.STEP_BYTES)
            while end < len(data) and not _SPACE[data[end]]:
                end += 1
            part = np.frombuffer(data, np.uint8)[at:end]
            parts.extend(self._step(part, np.array([0, len(part)])))
            at = end
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def _step(self, data: np.ndarray, edge: np.ndarray) -> list[np.ndarray]:
        n = len(data)
        if not n:
            return [np.zeros(0, np.uint32)] * (len(edge) - 1)
        solid = ~_SPACE[data]
        cut = np.zeros(n, bool)
        cut[edge[edge < n]] = True
        cut[1:] |= _LETTER[data[:-1]] & _STOP[data[1:]] | ~solid[:-1]
        start = np.flatnonzero(solid & cut)
        ends = np.zeros(n, bool)
        ends[:-1] = solid[:-1] & (cut[1:] | ~solid[1:])
        ends[-1] = solid[-1]
        end = np.flatnonzero(ends) + 1
        low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(V.U) + V.U(1)
        run = np.zeros(n + 1, V.U)
        np.cumsum(low * V.powers(V.BYTE, n), out=run[1:])
        h = V.mix((run[end] - run[start]) * V.powers(V.BYTE_INV, n + 1)[start] + (end - start).astype(V.U) * V.SEQ)
        count = np.diff(np.searchsorted(start, edge))
        keys, first, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.place) + len(keys) > WORDS_HELD or self.n_ids > IDS_HELD:
            self._clear()
        names = keys.tolist()
        new = [i for i, k in enumerate(names) if k not in self.place]
        buffer = data.tobytes()
        word = lambda i: buffer[start[first[i]] : end[first[i]]].decode()
        long = {i: np.array(self._encode([word(i)])[0], np.uint32) for i in new if end[first[i]] - start[first[i]] > WORD_BYTES}
        short = [i for i in new if i not in long]
        self._hold([names[i] for i in short], [word(i) for i in short])
        at = np.array([self.place.get(k, -1) for k in names], np.int64)
        size = np.where(at >= 0, self.size[at], 0)
        for i, ids in long.items():
            size[i] = len(ids)
        n_ids = size[back]
        done = np.cumsum(n_ids)
        ids = np.zeros(int(done[-1]) if len(done) else 0, np.uint32)
        some = at[back] >= 0
        ids[V.ranges((done - n_ids)[some], n_ids[some])] = self.ids[V.ranges(self.start[at[back][some]], n_ids[some])]
        for w in np.flatnonzero(~some):
            ids[done[w] - n_ids[w] : done[w]] = long[back[w]]
        row_end = np.concatenate(([0], done))[np.cumsum(count)]
        return np.split(ids, row_end[:-1])


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One per worker: workers live on from task to task, and with them the held words."""
    return WordIds(path)


SCHEMA = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", row_len: int = 4096, end_id: int = 2, linear: float = 1.0, quadratic: float = 1 / 24576, buffer_tokens: int = 4_000_000) -> DataFrame:
    """One row per piece of a document: ``doc_id, start`` (its ids before the piece),
    ``length, doc_tokens`` (all ids of the document, the end id included),
    ``sequence_id, offset`` (its place there, without gaps from 0) and ``ids``
    (little-endian unsigned 32-bit).

    Every id lies in one piece; no sequence is longer than ``row_len``, and each is full
    or as long as a power of two. A null or empty text is just the end id. Repeated rows
    and null doc_ids are packed like others, also under one doc_id; extra columns are
    left out; an empty table gives no rows. vocabulary: a file of the tokenizers library
    whose normaliser drops white space and whose pre-tokens never span it, at the same
    path on every executor. linear, quadratic: estimated work per token and per pair of
    tokens (by default, layers 24576 / 6 wide). Memory per task: ``buffer_tokens`` ids,
    one document and one Arrow batch.
    """
    S.text_batches(docs.sparkSession)

    def pieces_of(held, first):
        out: list[list] = [[] for _ in range(7)]
        for i, start, n, seq, offset in balanced([len(ids) for _, ids in held], row_len, linear, quadratic):
            doc, ids = held[i]
            for col, v in zip(out, (doc, start, n, len(ids), first + seq, offset, ids[start : start + n].tobytes())):
                col.append(v)
        for at in range(0, len(out[0]), 1000):
            yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 1000], t) for c, t in zip(out, [pa.int64()] * 6 + [pa.binary()])], [x.split()[0] for x in SCHEMA.split(", ")])

    def run(batches):
        words, held, size = word_ids(vocabulary), [], 0
        next_id = TaskContext.get().partitionId() << 33
        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), words.rows(batch.column(1))):
                held.append((doc, np.append(ids, np.uint32(end_id)).astype("<u4")))
                size += len(ids) + 1
                if size >= buffer_tokens:
                    yield from pieces_of(held, next_id)
                    next_id += len(capacities(size, row_len))
                    held, size = [], 0
        if held:
            yield from pieces_of(held, next_id)

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA)


def sequences(pieces: DataFrame, row_len: int = 4096, pad_id: int = 0) -> DataFrame:
    """One row per sequence: ``sequence_id, n_tokens, input_ids`` (little-endian unsigned
    32-bit, filled up with ``pad_id`` to ``row_len`` unless n_tokens is a power of two),
    ``cu_seqlens`` (0, then each piece's end) and ``doc_ids``. A sequence has at most
    ``row_len`` pieces, so groups are bounded."""
    one = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))
    got = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), one.alias("p"))
    pad = F.lit(int(pad_id).to_bytes(4, "little"))
    missing = F.when(F.expr("bit_count(n_tokens) = 1"), F.lit(0)).otherwise(row_len - F.col("n_tokens"))
    filled = F.concat(F.aggregate("p", F.lit(b""), lambda s, x: F.concat(s, x["ids"])), F.expr("unhex(repeat({}, cast({} as int)))".format("hex(pad)", "missing")))
    return (
        got.withColumn("missing", missing).withColumn("pad", pad).withColumn("input_ids", filled)
        .select("sequence_id", "n_tokens", "input_ids", F.concat(F.array(F.lit(0)), F.transform("p", lambda x: (x["offset"] + x["length"]).cast("int"))).alias("cu_seqlens"), F.col("p.doc_id").alias("doc_ids"))
    )
