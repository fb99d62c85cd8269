"""Conversation structure repair by rank-convergence parallel Viterbi.

The role initials of a repaired conversation read ``(s?(ua)+)?``. An automaton of four
states accepts them: 0 nothing yet, 1 after s, 2 after u, 3 after a; it may end in 0 or
3. Edits are Keep (0), Rerole to user or assistant (1), Delete (2, required for blank
and duplicate rows) and Insert of an empty user or assistant turn (5); a truncated row
that is not deleted adds 5. ``B[i][s]`` is the least cost of rows i.. from state s.

Rows are sorted across tasks, so a long conversation lies in many chunks:

1. every chunk runs backwards from a speculative cost vector, that of an end;
2. in fix-up passes a chunk whose right neighbour now begins with another vector (two
   vectors are the same if they differ by a constant) runs again, until the vector at
   some row is what it was before; left of that row all stays. A pass handles runs of
   chunks in order, longer runs each pass, so passes grow with the logarithm of the
   chunks even where vectors never converge;
3. the stitched vectors go back to their rows. Each conversation is then read once in
   order, in bounded memory: of the edits on a cheapest path the ASCII-least is taken,
   and kept texts are added to the hash. (One hash of a whole conversation can only be
   taken in order; all else is done in chunks.)
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _spark as S

RUN = 64
DELETE, RETURN, INSERT, CUT = 2, 1, 5, 5
#: Where a role initial leads from each state (-1: not allowed).
MOVES = {"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1)}
#: What may be inserted (or a row be reroled to) in each state, and where it leads.
NEXT = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
END = (0, 2 * INSERT, INSERT, 0)
SPACES = " \t\n\x0b\x0c\r"
#: Faults of rows that need not be deleted.
SEEN = ("none", "truncated")


@lru_cache(maxsize=None)
def back(sym: str, after: tuple) -> tuple[tuple, int]:
    """Cost vector before a row, given the one after it: (vector less its least, that).
    sym: role initial (x: another), upper case if truncated."""
    role, cut = sym.lower(), CUT if sym.isupper() else 0
    cost = []
    for s in range(4):
        keep = MOVES.get(role, (-1,) * 4)[s]
        cost.append(min(DELETE + after[s], RETURN + cut + after[NEXT[s][1]], cut + after[keep] if keep >= 0 else 1 << 30))
    for _ in range(3):
        for s in range(4):
            cost[s] = min(cost[s], INSERT + cost[NEXT[s][1]])
    least = min(cost)
    return tuple(c - least for c in cost), least


@lru_cache(maxsize=None)
def forward(sym: str, after: tuple, state: int) -> tuple[str, int, int]:
    """(edits, cost, next state): ASCII-least of the cheapest edits of a row and before it."""
    before, least = back(sym, after)
    role, cut = sym.lower(), CUT if sym.isupper() else 0
    edits, cost = "", 0
    while True:
        left = before[state] + least
        keep = MOVES.get(role, (-1,) * 4)[state]
        if left == DELETE + after[state]:
            return edits + "D", cost + DELETE, state
        if left == INSERT + before[NEXT[state][1]] + least:
            edits, cost, state = edits + "I", cost + INSERT, NEXT[state][1]
        elif keep >= 0 and left == cut + after[keep]:
            return edits + "K", cost + cut, keep
        else:
            return edits + "R", cost + RETURN + cut, NEXT[state][1]


def packed(vector: tuple) -> int:
    return sum(v << 8 * i for i, v in enumerate(vector))


def unpacked(code: int) -> tuple:
    return tuple(code >> 8 * i & 255 for i in range(4))


def swept(syms: str, after: tuple, old: list[int] | None = None) -> tuple[list[int], tuple]:
    """(packed vector after each row, vector before the first), right to left. With
    ``old`` (the same from another start), stops where the two meet."""
    out = list(old) if old is not None else [0] * len(syms)
    for i in range(len(syms) - 1, -1, -1):
        code = packed(after)
        if old is not None and old[i] == code:
            return out, back(syms[0], unpacked(out[0]))[0]
        out[i] = code
        after = back(syms[i], after)[0]
    return out, after


def _damaged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, turn, role, text, copies``; copies 0 is a dropped row."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(space(conv), F.lit(":"), space(turn))) % 20
    got = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"), space(role).alias("role"), space(text).alias("text"), h.alias("h"))
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("h") == 0, 0).when(F.col("h") == 3, 2).otherwise(1)
    return got.select("conv", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.cast("bigint").alias("copies"))


def _as_given(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select(F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"), space(role).alias("role"), space(text).alias("text"), F.lit(1).cast("bigint").alias("copies"))


def _blank() -> Column:
    return F.rtrim("text", F.lit(SPACES)) == ""


def _symbol() -> Column:
    """The role's initial, x for another, upper case if the text is truncated."""
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    last = F.substring(F.rtrim("text", F.lit(SPACES)), -1, 1)
    return F.when(last.isin(".", "!", "?"), initial).otherwise(F.upper(initial))


CELL = "turn bigint, role string, th string, n bigint, fault string, sym string"
_CELL_TYPE = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("th", pa.string()), ("n", pa.int64()), ("fault", pa.string()), ("sym", pa.string())])


def _cells(base: DataFrame) -> DataFrame:
    """Equal rows as one: ``conv, turn, role, th`` (hash of the text), ``n`` of them,
    ``fault`` of the first (blank, duplicate, truncated or none) and ``sym``."""
    rows = base.where("copies > 0").select("conv", "turn", "role", F.md5("text").alias("th"), "copies", F.when(_blank(), "-").otherwise(_symbol()).alias("sym"))
    cells = rows.groupBy("conv", "turn", "role", "th").agg(F.sum("copies").alias("n"), F.min("sym").alias("sym"))
    # Null turns come first, so (is not null, turn) is the order of turns.
    order = lambda c: F.struct(F.col(c).isNotNull().alias("known"), F.col(c).alias("t"))
    first = cells.groupBy("conv", "role", "th").agg(F.min(order("turn")).alias("first")).alias("f")
    same = F.col("c.conv").eqNullSafe(F.col("f.conv")) & (F.col("c.role") == F.col("f.role")) & (F.col("c.th") == F.col("f.th"))
    seen = ~F.col("f.first.t").eqNullSafe(F.col("c.turn"))
    fault = F.when(F.col("c.sym") == "-", "blank").when(seen, "duplicate").when(F.upper("c.sym") == F.col("c.sym"), "truncated").otherwise("none")
    return cells.alias("c").join(first, same).select("c.*", fault.alias("fault"))


def _chunks(cells: DataFrame, chunk_rows: int) -> DataFrame:
    """Sorted over the cluster and cut: ``conv, at`` (ascending place of the chunk),
    ``cells, syms`` (of rows that need not be deleted), ``vecs`` and ``head`` from the
    speculative start, ``used`` (the vector that it started from)."""
    cell = ",".join(c.replace(" ", ":") for c in CELL.split(", "))
    schema = f"conv {_kind(cells, 'conv')}, at bigint, cells array<struct<{cell}>>, syms string, vecs array<bigint>, head bigint, used bigint"

    def run(batches):
        key, held = None, []
        part, no = TaskContext.get().partitionId() << 32, 0

        def out():
            core = [x for x in held if x["fault"] in SEEN]
            syms = "".join(x["sym"] for x in core)
            vecs, head = swept(syms, END)
            rows = [{c: x[c] for c in ("turn", "role", "th", "n", "fault", "sym")} for x in held]
            return pa.RecordBatch.from_arrays(
                [pa.array([key], conv_type), pa.array([part + no]), pa.array([rows], pa.list_(_CELL_TYPE)), pa.array([syms]), pa.array([vecs], pa.list_(pa.int64())), pa.array([packed(head)]), pa.array([packed(END)])],
                ["conv", "at", "cells", "syms", "vecs", "head", "used"],
            )

        for batch in batches:
            conv_type = batch.schema.field("conv").type
            for x in batch.to_pylist():
                if held and (x["conv"] != key or len(held) == chunk_rows):
                    yield out()
                    held, no = [], no + 1
                key = x["conv"]
                held.append(x)
        if held:
            yield out()

    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv", "turn", "role", "th"]
    return cells.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(run, schema)


def _fixed(chunks: DataFrame, run_chunks: int) -> DataFrame:
    """One fix-up pass over ``conv, at, idx, syms, vecs, head, used, nxt``: within a run
    of chunks each starts from its neighbour's new vector, a run's last from ``nxt``."""
    names = ["conv", "at", "idx", "syms", "vecs", "head", "used"]

    def run(batches):
        last = None  # (conv, idx, head) of the chunk to the right
        for batch in batches:
            rows = batch.to_pylist()
            for x in rows:
                near = last is not None and last[0] == x["conv"] and last[1] == x["idx"] + 1 and last[1] // run_chunks == x["idx"] // run_chunks
                start = last[2] if near else x["nxt"]
                if start is not None and start != x["used"]:
                    vecs, head = swept(x["syms"], unpacked(start), x["vecs"])
                    x.update(vecs=vecs, head=packed(head), used=start)
                last = (x["conv"], x["idx"], x["head"])
            yield pa.RecordBatch.from_pylist([{c: x[c] for c in names} for x in rows], schema=pa.schema([batch.schema.field(c) for c in names]))

    block = F.floor(F.col("idx") / run_chunks)
    ordered = chunks.withColumn("block", block).repartition("conv", "block").sortWithinPartitions("conv", F.desc("idx")).drop("block")
    return ordered.mapInArrow(run, chunks.select(*names).schema)


def cost_vectors(cells: DataFrame, chunk_rows: int) -> DataFrame:
    """``cells`` with ``vec``: the stitched cost vector after each row that need not be
    deleted (null for the others), less its least."""
    spark = cells.sparkSession
    chunks, at_chunks = S.stored(_chunks(cells, chunk_rows), "chunks")
    core = chunks.where("syms <> ''")
    long = core.groupBy("conv").agg(F.count("*").alias("k")).where("k > 1").select(F.col("conv").alias("c2"))
    # idx counts a conversation's chunks; a row here stands for chunk_rows rows.
    order = Window.partitionBy("conv").orderBy("at")
    many = core.join(long, F.col("conv").eqNullSafe(F.col("c2")), "left_semi").select("conv", "at", (F.row_number().over(order) - 1).cast("bigint").alias("idx"), "syms", "vecs", "head", "used")
    state, path = S.stored(many, "vectors")
    length, paths = 1, [path]
    while True:
        linked = state.withColumn("nxt", F.lead("head").over(Window.partitionBy("conv").orderBy("idx")))
        if linked.where("nxt <> used").isEmpty():
            break
        state, path = S.stored(_fixed(linked, length), "vectors")
        paths.append(path)
        length *= RUN
    fixed = state.select(F.col("at").alias("a2"), F.col("vecs").alias("v2"))
    both = chunks.join(fixed, F.col("at") == F.col("a2"), "left").select("conv", "cells", F.coalesce("v2", "vecs").alias("vecs"))
    names = [f.name for f in _CELL_TYPE]

    def opened(batches):
        for batch in batches:
            out, convs = [], []
            for conv, cells, vecs in zip(*(c.to_pylist() for c in batch.columns)):
                left = iter(vecs)
                for x in cells:
                    out.append({**x, "vec": next(left) if x["fault"] in SEEN else None})
                    convs.append(conv)
            got = pa.RecordBatch.from_pylist(out, schema=pa.schema([*_CELL_TYPE, ("vec", pa.int64())]))
            yield pa.RecordBatch.from_arrays([pa.array(convs, batch.schema.field("conv").type), *got.columns], ["conv", *names, "vec"])

    return both.mapInArrow(opened, f"conv {_kind(cells, 'conv')}, {CELL}, vec bigint")


LEGAL = ("su", "ua", "au")


class _Conversation:
    """One conversation, read in order; holds counts, the audit so far and a hash."""

    def __init__(self):
        self.turns, self.least, self.most, self.turn = 0, None, None, None
        self.count = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.initial, self.state, self.cost, self.audit = None, 0, 0, []
        self.hash, self.lines, self.wanted = hashlib.sha256(), 0, None

    def line(self, role: str, text: str) -> None:
        self.hash.update(("\n" if self.lines else "").encode() + f"{role}:{text}".encode())
        self.lines += 1

    def inserts(self, n: int, state: int) -> int:
        for _ in range(n):
            role, state = NEXT[state]
            self.line(role, "")
        return state

    def cell(self, turn, role, th, n, fault, sym, vec) -> None:
        if turn is not None and turn != self.turn:
            self.turns, self.turn, self.most = self.turns + 1, turn, turn
            self.least = turn if self.least is None else self.least
        initial = role[:1]
        if fault != "none":
            self.count[fault] += 1
        self.count["blank" if fault == "blank" else "duplicate"] += n - 1
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.count["illegal"] += 1
        if initial + initial not in LEGAL:
            self.count["illegal"] += n - 1
        self.initial = initial
        if fault in SEEN:
            edits, cost, state = forward(sym, unpacked(vec), self.state)
            before = self.inserts(edits.count("I"), self.state)
            if edits[-1] == "K":
                self.wanted = (turn, role, th, role)
            elif edits[-1] == "R":
                self.wanted = (turn, role, th, NEXT[before][0])
            self.cost, self.state = self.cost + cost, state
            self.audit.append(edits)
            n -= 1
        self.cost += DELETE * n
        if n:
            self.audit.append("D" * n)

    def text(self, turn, role, th, text) -> None:
        if self.wanted is not None and self.wanted[:3] == (turn, role, th):
            self.line(self.wanted[3], text)
            self.wanted = None

    def done(self) -> dict:
        while END[self.state]:
            self.audit.append("I")
            self.cost, self.state = self.cost + INSERT, self.inserts(1, self.state)
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return {"gaps": gaps, **self.count, "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.hash.hexdigest()}


def _kind(df: DataFrame, column: str) -> str:
    return next(f.dataType.simpleString() for f in df.schema if f.name == column)


OUT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", chunk_rows: int = 256, damage: bool = False) -> DataFrame:
    """Per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256``.

    Rows go by turn (nulls first); rows of one turn by role, then by md5 of the text, so
    repeated rows are neighbours. gaps: missing turns between the least and the greatest
    one. A row's first fault counts: blank (no text but white space), duplicate (role and
    text seen before), truncated (last character but white space not ``[.!?]``). illegal:
    neighbours whose role initials are not su, ua or au. audit: initials of the cheapest
    edits in order, the ASCII-least of several; cost: theirs. repaired_sha256: of the
    repaired ``role:text`` lines. Null roles and texts read as one space; a null conv_id
    is a conversation of its own; a conversation without rows after damage has zeros, an
    empty audit and the hash of nothing. Extra columns are left out; an empty table gives
    no rows. damage: first drop, empty, cut, repeat or rerole rows by
    ``crc32("conv_id:turn") % 20`` (0 to 4). chunk_rows: rows that one Viterbi chunk
    holds at most. Memory per task: a chunk or a batch; a conversation's audit.
    """
    S.text_batches(rows.sparkSession)
    base = (_damaged if damage else _as_given)(rows, conv_col, turn_col, role_col, text_col)
    cells = cost_vectors(_cells(base), chunk_rows)
    # Cells and texts meet by sorting: each cell comes just before the texts it stands for.
    names = [f.name for f in _CELL_TYPE]
    said = F.when((F.col("copies") > 0) & ~_blank(), F.col("text"))
    texts = base.select("conv", "turn", "role", F.md5("text").alias("th"), *(F.lit(None).cast(t).alias(c) for c, t in (("n", "bigint"), ("fault", "string"), ("sym", "string"), ("vec", "bigint"))), said.alias("text"))
    both = cells.withColumn("text", F.lit(None).cast("string")).unionByName(texts)
    keyed = both.repartition("conv").sortWithinPartitions("conv", "turn", "role", "th", F.col("n").isNull())
    conv_kind = _kind(both, "conv")

    def read(batches):
        key, one = None, None
        for batch in batches:
            convs, found = [], []
            for conv, *cell, vec, text in zip(*(batch.column(c).to_pylist() for c in ("conv", *names, "vec", "text"))):
                if one is None or conv != key:
                    if one is not None:
                        convs.append(key), found.append(one.done())
                    key, one = conv, _Conversation()
                if cell[3] is not None:
                    one.cell(*cell, vec)
                elif text is not None:
                    one.text(*cell[:3], text)
            yield closed(convs, found, batch.schema.field("conv").type)
        if one is not None:
            yield closed([key], [one.done()], batch.schema.field("conv").type)

    def closed(convs, found, kind):
        got = pa.RecordBatch.from_pylist(found, schema=pa.schema([(c.split()[0], pa.string() if "string" in c else pa.int64()) for c in OUT.split(", ")]))
        return pa.RecordBatch.from_arrays([pa.array(convs, kind), *got.columns], ["conv", *got.schema.names])

    return keyed.mapInArrow(read, f"conv {conv_kind}, {OUT}").withColumnRenamed("conv", conv_col)
