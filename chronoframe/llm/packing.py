"""Token-id packing: best-fit-decreasing with a segment-tree search for capacity.

Texts are tokenised, each closed by an end id. Parts of a full row length leave an
overlong document as rows of their own; what is left of it, and every shorter document,
is placed best-fit-decreasing: longest first, into the open row with the least room that
still holds it. Tasks pack their own rows in bounded buffers, so nothing is shuffled and
a lost task is packed again alike from the same input split.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _spark as S

#: Fixed: the pre-token pattern that the public byte-level vocabulary was made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A stretch of text longer than this is tokenised in parts cut before white space.
PART_CHARS = 200_000
#: Runs of white space from this length on are cut by hand.
LONG = 5_000
#: Fixed: the characters that the pattern's \s stands for.
LONG_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG)


class Capacities:
    """Segment tree over row capacities 0..size: how many open rows have each."""

    def __init__(self, size: int):
        self.leaves = 1 << max(1, int(size).bit_length())
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def _add(self, room: int, by: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += by
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) of the open row with the least room >= need, removed."""
        at = need + self.leaves
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.leaves
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Rows as lists of item positions; no row's lengths add up to more than ``size``."""
    room, rows = Capacities(size), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        got = room.take(lengths[i])
        if got is None:
            got = (size, len(rows))
            rows.append([])
        rows[got[1]].append(i)
        if got[0] > lengths[i]:
            room.put(got[0] - lengths[i], got[1])
    return rows


@lru_cache(maxsize=4)
def encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("pack", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_ids(enc, text: str) -> np.ndarray:
    """Ids of the whole text. Long runs of white space, on which the pattern would
    backtrack, are cut as it would cut them: all of a run at the end of the text, else
    all but its last character, is one pre-token. Very long stretches between go part
    by part."""
    out, at = [], 0
    for run in LONG_RUN.finditer(text) if len(text) > LONG else ():
        end = run.end() if run.end() == len(text) else run.end() - 1
        out += [*_stretch(enc, text[at : run.start()]), np.array(enc._encode_single_piece(text[run.start() : end]), np.uint32)]
        at = end
    out += _stretch(enc, text[at:])
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def _stretch(enc, text: str) -> list[np.ndarray]:
    """Ids of a text without long runs, in parts cut before a space so that the pattern
    sees the same pre-tokens."""
    out, at = [], 0
    while at < len(text):
        end = at + PART_CHARS
        while end < len(text) and not (text[end] == " " and text[end - 1].isalnum() and text[end + 1 : end + 2].isalnum()):
            end += 1
        out.append(enc.encode_to_numpy(text[at:end]))
        at = end
    return out


SCHEMA = "pack_id bigint, n_tokens int, input_ids binary, cu_seqlens array<int>, position_resets array<int>, doc_ids array<bigint>, parts array<int>"


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", row_len: int = 2048, end_id: int = 50256, pad_id: int = 50256, buffer_tokens: int = 4_000_000) -> DataFrame:
    """Packed rows of ``row_len`` ids.

    input_ids: row_len little-endian uint32; ids from n_tokens on are ``pad_id``.
    cu_seqlens: 0, then the end of each segment; position_resets: where positions start
    again at 0 (each segment's start); doc_ids and parts name each segment's document
    and its place among the document's parts (0, 1, ...), which concatenate to its ids.
    A null text is empty: just the end id. Repeated rows and null doc_ids are packed
    like others. An empty table gives no rows. vocabulary: file of ranks, the same path
    on every executor. Memory per task: buffer_tokens ids and one Arrow batch.
    """
    spark = docs.sparkSession
    S.text_batches(spark)

    def rows_of(items, first):
        lengths = [len(x[2]) for x in items]
        cols: list[list] = [[] for _ in range(7)]
        for members in best_fit(lengths, row_len):
            ids = np.full(row_len, pad_id, "<u4")
            ends = np.cumsum([0] + [lengths[i] for i in members])
            for i, at in zip(members, ends):
                ids[at : at + lengths[i]] = items[i][2]
            for col, v in zip(cols, (first, int(ends[-1]), ids.tobytes(), ends.tolist(), ends[:-1].tolist(), [items[i][0] for i in members], [items[i][1] for i in members])):
                col.append(v)
            first += 1
        i32 = pa.list_(pa.int32())
        for at in range(0, len(cols[0]), 500):
            part = [pa.array(c[at : at + 500], t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.binary(), i32, i32, pa.list_(pa.int64()), i32))]
            yield pa.RecordBatch.from_arrays(part, [x.split()[0] for x in SCHEMA.split(", ")])

    def run(batches):
        enc, held, size = encoder(vocabulary), [], 0
        next_id = TaskContext.get().partitionId() << 33
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(token_ids(enc, text.as_py() or ""), np.uint32(end_id))
                for part, at in enumerate(range(0, len(ids), row_len)):
                    held.append((doc, part, ids[at : at + row_len]))
                size += len(ids)
                if size >= buffer_tokens:
                    for out in rows_of(held, next_id):
                        next_id += out.num_rows
                        yield out
                    held, size = [], 0
        for out in rows_of(held, next_id):
            next_id += out.num_rows
            yield out

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def unpacked(packs: DataFrame) -> DataFrame:
    """Back to ``doc_id, ids`` (array of int, end id included): the inverse of ``pack``
    for distinct doc_ids. Parts are put in order per document."""

    def cut(batches):
        for batch in batches:
            out = [[], [], []]
            for ids, ends, docs, parts in zip(*(batch.column(c).to_pylist() for c in ("input_ids", "cu_seqlens", "doc_ids", "parts"))):
                row = np.frombuffer(ids, "<u4").astype(np.int32)
                for a, b, d, p in zip(ends, ends[1:], docs, parts):
                    for col, v in zip(out, (d, p, row[a:b].tolist())):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.list_(pa.int32()))], ["doc_id", "part", "ids"])

    pieces = packs.select("input_ids", "cu_seqlens", "doc_ids", "parts").mapInArrow(cut, "doc_id bigint, part int, ids array<int>")
    return pieces.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("part", "ids"))).alias("p")).select("doc_id", F.flatten("p.ids").alias("ids"))


def write_packs(packs: DataFrame, path: str) -> None:
    """Parquet files of fixed-width id rows with their segment lengths and resets."""
    packs.write.mode("errorifexists").parquet(path)
