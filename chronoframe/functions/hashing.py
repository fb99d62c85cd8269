"""Murmur3 (x86, 32-bit) of an id's decimal string, hash buckets and next_pow2 (H4-H7).

Spark's own ``hash`` is Murmur3 with seed 42 over the binary value, which
does not give the bucket numbers the model contract fixes, so the 32-bit
algorithm is spelled out with built-in integer expressions. Two equivalent forms:

* ``engine="arrow"`` (default): a vectorised NumPy kernel in an Arrow-batched
  pandas UDF -- whole batches of ids are rendered to fixed-width decimal
  bytes, viewed as little-endian 32-bit blocks and mixed with wrapping
  ``uint32`` arithmetic; about 1 us per id on one core.
* ``engine="expr"``: the same mixing written once as a list of small steps
  over built-in integer expressions, run as consecutive projections. It stays
  in the JVM, but its generated method is too large for the JIT (measured
  about 20 us per id), so it serves as the cross-check. :func:`murmur3_sql`
  renders the same steps as DuckDB SQL for the oracle.

ANSI mode rejects overflowing BIGINT products, so the expression form
multiplies in 16-bit halves.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of MurmurHash3_x86_32 (public algorithm constants), seed 0.
C1 = 0xCC9E2D51
C2 = 0x1B873593
BLOCK_ADD = 0xE6546B64
FMIX1 = 0x85EBCA6B
FMIX2 = 0xC2B2AE35
SEED = 0
MASK32 = 0xFFFFFFFF
MAX_ID_CHARS = 20  # longest decimal BIGINT, "-9223372036854775808"


class _Dialect:
    def __init__(self, spark: bool):
        self.spark = spark

    def band(self, a, b):
        return f"({a} & {b})"

    def bor(self, a, b):
        return f"({a} | {b})"

    def bxor(self, a, b):
        return f"({a} ^ {b})" if self.spark else f"xor({a}, {b})"

    def shl(self, a, n):
        return f"shiftleft({a}, {n})" if self.spark else f"({a} << {n})"

    def shr(self, a, n):
        return f"shiftright({a}, {n})" if self.spark else f"({a} >> {n})"

    def idiv(self, a, b):
        return f"({a} div {b})" if self.spark else f"({a} // {b})"

    def to_str(self, a):
        return f"CAST({a} AS STRING)" if self.spark else f"CAST({a} AS VARCHAR)"

    def mul32(self, a, c):
        lo = f"({self.band(a, 65535)} * {c})"
        hi = self.shl(self.band(f"({self.shr(a, 16)} * {c})", 65535), 16)
        return self.band(f"({lo} + {hi})", MASK32)

    def rotl32(self, a, r):
        return self.band(self.bor(self.shl(a, r), self.shr(a, 32 - r)), MASK32)


def _steps(d: _Dialect, id_col: str, p: str) -> list[tuple[str, str]]:
    """The hash as (column name, expression) steps over earlier step columns."""
    s, n, nb = f"{p}s", f"{p}len", f"{p}nb"
    steps = [
        (s, d.to_str(id_col)),
        (n, f"length({s})"),
        (nb, d.idiv(n, 4)),
        (f"{p}h0", str(SEED)),
    ]

    def byte(pos: str) -> str:
        return f"(CASE WHEN {pos} < {n} THEN ascii(substring({s}, {pos} + 1, 1)) ELSE 0 END)"

    for i in range((MAX_ID_CHARS + 3) // 4):
        h = f"{p}h{i}"
        k = d.bor(
            d.bor(byte(str(4 * i)), d.shl(byte(str(4 * i + 1)), 8)),
            d.bor(d.shl(byte(str(4 * i + 2)), 16), d.shl(byte(str(4 * i + 3)), 24)),
        )
        steps += [
            (f"{p}k{i}a", d.mul32(k, C1)),
            (f"{p}k{i}b", d.rotl32(f"{p}k{i}a", 15)),
            (f"{p}k{i}c", d.mul32(f"{p}k{i}b", C2)),
            (f"{p}x{i}", d.rotl32(d.bxor(h, f"{p}k{i}c"), 13)),
            (f"{p}y{i}", d.band(f"({d.mul32(f'{p}x{i}', 5)} + {BLOCK_ADD})", MASK32)),
            (f"{p}h{i + 1}", f"(CASE WHEN {nb} > {i} THEN {p}y{i} ELSE {h} END)"),
        ]
    last = f"{p}h{(MAX_ID_CHARS + 3) // 4}"
    base = f"(4 * {nb})"
    rem = f"({n} % 4)"
    tail = d.bxor(
        d.bxor(
            f"(CASE WHEN {rem} >= 3 THEN {d.shl(byte(f'{base} + 2'), 16)} ELSE 0 END)",
            f"(CASE WHEN {rem} >= 2 THEN {d.shl(byte(f'{base} + 1'), 8)} ELSE 0 END)",
        ),
        f"(CASE WHEN {rem} >= 1 THEN {byte(base)} ELSE 0 END)",
    )
    steps += [
        (f"{p}t0", tail),
        (f"{p}t1", d.mul32(f"{p}t0", C1)),
        (f"{p}t2", d.rotl32(f"{p}t1", 15)),
        (f"{p}t3", d.mul32(f"{p}t2", C2)),
        (f"{p}g0", d.bxor(d.bxor(last, f"(CASE WHEN {rem} > 0 THEN {p}t3 ELSE 0 END)"), n)),
        (f"{p}g1", d.bxor(f"{p}g0", d.shr(f"{p}g0", 16))),
        (f"{p}g2", d.mul32(f"{p}g1", FMIX1)),
        (f"{p}g3", d.bxor(f"{p}g2", d.shr(f"{p}g2", 13))),
        (f"{p}g4", d.mul32(f"{p}g3", FMIX2)),
        (f"{p}g5", d.bxor(f"{p}g4", d.shr(f"{p}g4", 16))),
    ]
    return steps


def _check_integral(df: DataFrame, col: str) -> None:
    dtype = df.schema[col].dataType
    if not isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        # Hashing str() of a float gives "10.0", not "10": ids must be integral.
        raise TypeError(f"{col}: hash buckets need an integral id column, got {dtype}")


def murmur3_ids(ids: np.ndarray) -> np.ndarray:
    """Vectorised unsigned Murmur3_x86_32 (seed 0) of the decimal strings of int64 ids."""
    text = np.asarray(ids, dtype=np.int64).astype(f"S{MAX_ID_CHARS}")  # zero-padded ASCII
    raw = text.tobytes()
    byts = np.frombuffer(raw, dtype=np.uint8).reshape(-1, MAX_ID_CHARS)
    blocks = np.frombuffer(raw, dtype="<u4").reshape(-1, MAX_ID_CHARS // 4)
    n = (byts != 0).sum(axis=1).astype(np.uint32)
    nb = n // 4
    h = np.full(len(n), SEED, dtype=np.uint32)
    u = np.uint32

    def rotl(x, r):
        return (x << u(r)) | (x >> u(32 - r))

    with np.errstate(over="ignore"):
        for i in range(MAX_ID_CHARS // 4):
            k = rotl(blocks[:, i] * u(C1), 15) * u(C2)
            h = np.where(nb > i, rotl(h ^ k, 13) * u(5) + u(BLOCK_ADD), h)
        rem = n % 4
        rows = np.arange(len(n))
        base = nb.astype(np.int64) * 4

        def byte(off):
            return byts[rows, np.minimum(base + off, MAX_ID_CHARS - 1)].astype(np.uint32)

        k1 = np.where(rem >= 3, byte(2) << u(16), u(0)).astype(np.uint32)
        k1 ^= np.where(rem >= 2, byte(1) << u(8), u(0)).astype(np.uint32)
        k1 ^= np.where(rem >= 1, byte(0), u(0)).astype(np.uint32)
        k1 = rotl(k1 * u(C1), 15) * u(C2)
        h = np.where(rem > 0, h ^ k1, h) ^ n
        h ^= h >> u(16)
        h = h * u(FMIX1)
        h ^= h >> u(13)
        h = h * u(FMIX2)
        h ^= h >> u(16)
    return h.astype(np.int64)


@F.pandas_udf(T.LongType())
def _murmur3_udf(ids: pd.Series) -> pd.Series:
    valid = ids.notna().to_numpy()
    out = pd.Series(murmur3_ids(ids.fillna(0).astype("int64").to_numpy()), index=ids.index, dtype="Int64")
    return out.where(valid, None)


def with_murmur3(df: DataFrame, col: str, out: str, engine: str = "arrow") -> DataFrame:
    """H4: add ``out`` = unsigned Murmur3_x86_32(seed 0) of the decimal string of ``col``."""
    _check_integral(df, col)
    if engine == "arrow":
        return df.withColumn(out, _murmur3_udf(F.col(col).cast("long")))
    p = f"__mh_{out}_"
    steps = _steps(_Dialect(spark=True), f"`{col}`", p)
    for name, expr in steps:
        df = df.withColumn(name, F.expr(expr))
    final = steps[-1][0]
    df = df.withColumn(out, F.when(F.col(col).isNotNull(), F.col(final)))
    return df.drop(*[name for name, _ in steps])


def with_hash_bucket(df: DataFrame, col: str, n_buckets: int, out: str | None = None, engine: str = "arrow") -> DataFrame:
    """H5/H6: ``{col}_bucket`` = murmur3 mod (n-1) + 1; a missing id maps to bucket 0."""
    if n_buckets < 2:
        raise ValueError("n_buckets must be >= 2 (bucket 0 is reserved for missing ids)")
    out = out or f"{col}_bucket"
    tmp = f"__hash_{out}"
    df = with_murmur3(df, col, tmp, engine)
    bucket = F.when(F.col(tmp).isNull(), F.lit(0)).otherwise(F.col(tmp) % (n_buckets - 1) + 1)
    return df.withColumn(out, bucket.cast("int")).drop(tmp)


def murmur3_sql(source: str, id_col: str, out: str, keep: str = "*") -> str:
    """The same hash as DuckDB SQL over ``source`` (a table name or subquery)."""
    p = f"__mh_{out}_"
    steps = _steps(_Dialect(spark=False), id_col, p)
    sql = f"(SELECT * FROM {source})"
    for name, expr in steps:
        sql = f"(SELECT *, {expr} AS {name} FROM {sql})"
    final = steps[-1][0]
    if keep == "*":
        keep = f"* EXCLUDE ({', '.join(name for name, _ in steps)})"
    return f"SELECT {keep}, CASE WHEN {id_col} IS NOT NULL THEN {final} END AS {out} FROM {sql}"


def next_pow2(n: int) -> int:
    """H7: smallest power of two >= n (1 -> 1, 3 -> 4, 9 -> 16)."""
    return 1 << (int(n) - 1).bit_length() if n > 1 else 1


def next_pow2_col(n: str | Column) -> Column:
    """H7 as an expression: 1 for n <= 1, else 2^bitlength(n-1)."""
    c = F.col(n) if isinstance(n, str) else n
    return F.when(c <= 1, F.lit(1).cast("long")).otherwise(F.pow(F.lit(2.0), F.length(F.bin(c - 1))).cast("long"))
