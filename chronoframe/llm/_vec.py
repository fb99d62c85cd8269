"""NumPy helpers for whole Arrow text columns: word hashes, word-shingle sets,
open-addressing tables. They run inside Spark tasks on bounded slices of a batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
#: Odd multipliers: the two of the splitmix64 finaliser, one for sequences, one for bytes.
M1, M2, SEQ, BYTE = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)
BYTE_INV = U(pow(int(BYTE), -1, 1 << 64))
#: Bytes of text that one vectorised step handles (a longer single text is one step).
STEP_BYTES = 250_000

#: The six white-space bytes that end a word.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE_BYTES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> U(30))) * M1
    x = (x ^ (x >> U(27))) * M2
    return x ^ (x >> U(31))


def salt(k: int) -> np.uint64:
    """The k-th of a sequence of constants that tell hashes of one key apart."""
    return U(k * int(SEQ) & ((1 << 64) - 1))


_POWERS: dict = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64; kept for the usual lengths."""
    got = _POWERS.get(int(base))
    if got is None or len(got) < n:
        out = np.full(max(n, STEP_BYTES + 1), base, U)
        out[0] = 1
        got = np.multiply.accumulate(out)
        if len(got) <= 4 * STEP_BYTES:
            _POWERS[int(base)] = got
    return got[:n]


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying; a null is empty."""
    if pa.types.is_large_string(col.type):
        kind = np.int64
    else:
        col, kind = col.cast(pa.string()), np.int32
    if col.null_count:
        col = col.fill_null("")
    _, off, data = col.buffers()
    if off is None or not len(col):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offsets = np.frombuffer(off, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(offsets: np.ndarray, limit: int = STEP_BYTES):
    """Row ranges (a, b) of at most ``limit`` bytes, or of one longer row."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


class Words:
    """The words (runs of non-space bytes, A-Z lower-cased) of rows a..b of a text
    column: ``hash`` per word, ``count`` words per row, byte ``start``/``end``.
    ``space``: flags of the 256 bytes that end a word, if not white space."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, a: int, b: int, space: np.ndarray = _IS_SPACE):
        lo = offsets[a]
        data = _LOWER[raw[lo : offsets[b]]]
        edge = offsets[a : b + 1] - lo
        n = len(data)
        solid = ~space[data]
        cut = np.zeros(n + 1, bool)
        cut[edge] = True  # a word never spans two rows
        first = solid.copy()
        first[1:] &= ~solid[:-1] | cut[1:n]
        last = solid.copy()
        last[:-1] &= ~solid[1:] | cut[1:n]
        self.data, self.edge = data, edge
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        run = np.zeros(n + 1, U)
        np.cumsum((data.astype(U) + U(1)) * powers(BYTE, n), out=run[1:])
        self._run, self._inv = run, powers(BYTE_INV, n + 1)
        self.hash = self.span_hash(self.start, self.end)
        self.count = np.diff(np.searchsorted(self.start, edge))

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the bytes [start, end), equal for equal bytes anywhere."""
        return mix((self._run[end] - self._run[start]) * self._inv[start] + (end - start).astype(U) * SEQ)


    def prefix_hash(self, chars: int, k: int) -> np.ndarray:
        """Hash of each word's first ``chars`` characters (all of a shorter word)."""
        heads = np.append(np.flatnonzero((self.data & 0xC0) != 0x80), len(self.data))
        first = np.searchsorted(heads, self.start)
        end = np.minimum(heads[np.minimum(first + chars, len(heads) - 1)], self.end)
        return mix(self.span_hash(self.start, end) + salt(k))


def ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[i], start[i]+1, ... n[i] of them, for all i, concatenated."""
    done = np.cumsum(n)
    return np.repeat(start - (done - n), n) + np.arange(done[-1] if len(n) else 0)


def shingles(hashes: np.ndarray, count: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's ``width``-word shingles in order, and how many each row
    has; a row of fewer words has its whole sequence as one, an empty row none."""
    end = np.cumsum(count)
    start = end - count
    n = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    out = np.zeros(int(n.sum()), U)
    at = np.cumsum(n) - n
    full = count >= width
    if full.any():
        idx = ranges(start[full], n[full])
        acc = hashes[idx]
        for j in range(1, width):
            acc = acc * SEQ + hashes[idx + j]
        out[ranges(at[full], n[full])] = mix(acc + U(width))
    for k in range(1, width):
        some = count == k
        if some.any():
            acc = hashes[start[some]]
            for j in range(1, k):
                acc = acc * SEQ + hashes[start[some] + j]
            out[at[some]] = mix(acc + U(k))
    return out, n


def row_sorted(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sort each row's stretch of ``values`` in place."""
    at = 0
    for k in n.tolist():
        if k > 1:
            values[at : at + k].sort()
        at += k
    return values


def shingle_sets(hashes: np.ndarray, count: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct shingle hashes, ascending, and the set sizes."""
    values, n = shingles(hashes, count, width)
    row_sorted(values, n)
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    at = np.cumsum(n) - n
    keep[at[n > 0]] = True
    sizes = np.diff(np.concatenate(([0], np.cumsum(keep)))[np.concatenate((at, [len(values)]))])
    return values[keep], sizes


def row_sums(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Per-row sums of consecutive stretches (0 for empty rows); wraps for uint64."""
    run = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=run[1:])
    end = np.cumsum(n)
    return run[end] - run[end - n]


class HashIndex:
    """Positions of distinct uint64 keys by double-hashed probing, vectorised."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.ascontiguousarray(keys, U)
        size = 1 << max(8, int(max(1, len(keys)) * 3).bit_length())
        self.mask = U(size - 1)
        self.slot = np.full(size, -1, np.int32)
        left, self.rounds = np.arange(len(keys), dtype=np.int32), 0
        while len(left):
            at = self._probe(self.keys[left], self.rounds)
            free = self.slot[at] < 0
            self.slot[at[free]] = left[free]  # the last of several wins
            left = left[self.slot[at] != left]
            self.rounds += 1

    def _probe(self, keys, r):
        return ((keys + U(r) * ((keys >> U(32)) | U(1))) & self.mask).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 if absent."""
        out = np.full(len(keys), -1, np.int32)
        if not len(self.keys) or not len(keys):
            return out
        got = self.slot[self._probe(keys, 0)]
        hit = (got >= 0) & (self.keys[got] == keys)
        out[hit] = got[hit]
        left = np.flatnonzero(~hit & (got >= 0))
        for r in range(1, self.rounds):
            if not len(left):
                break
            got = self.slot[self._probe(keys[left], r)]
            hit = (got >= 0) & (self.keys[got] == keys[left])
            out[left[hit]] = got[hit]
            left = left[~hit & (got >= 0)]
        return out
