"""Hard negatives, conversation repair and balanced packing against brute force."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chronoframe.llm import cost_packing, shared_lists, turn_repair

VOCABULARY = os.path.join(os.environ.get("TOKENIZER_DIR", "/opt/tokenizers"), "word_bpe_49k.json")
VEC = "vec_id long, label int, embedding array<double>, Score string"
TURN = "conv_id long, turn long, role string, text string, CONV string"


def _mined(rows, every, n_pos, n_neg, low, high, scale=256):
    fine = [(i, lab, np.floor(np.array(v, float) * scale).astype(np.int64)) for i, lab, v, _ in rows if None not in (i, lab, v) and all(x is not None and np.isfinite(x) for x in v)]
    width = max(len(v) for *_, v in fine)
    x = np.array([np.pad(v, (0, width - len(v))) for *_, v in fine])
    out, seen = [], set()
    for n, (i, lab, v) in enumerate(fine):
        if i % every or (i, lab, tuple(v)) in seen:
            continue
        seen.add((i, lab, tuple(v)))
        score = [int(y) for y in x @ x[n]]
        pos = sorted((-score[j], fine[j][0]) for j in range(len(fine)) if fine[j][0] != i and fine[j][1] == lab)[:n_pos]
        neg = sorted((-score[j], fine[j][0]) for j in range(len(fine)) if fine[j][0] != i and fine[j][1] != lab)
        for p, p_id in pos:
            fit = [(s, k) for s, k in neg if low * -p <= 100 * -s <= high * -p][:n_neg]
            out += [(i, p_id, r, k, -p, -s) for r, (s, k) in enumerate(fit, 1)]
    return sorted(tuple(map(int, t)) for t in out)


@pytest.mark.parametrize("case", ["clusters", "ties", "large"])
def test_hard_negatives_against_brute_force(spark, case, monkeypatch):
    r = np.random.default_rng(0)
    n = 500
    if case == "clusters":
        monkeypatch.setattr(shared_lists, "DIRECTIONS", 4)
        v = r.normal(0, 1, (6, 12))[r.integers(0, 6, n)] + r.normal(0, 0.1, (n, 12))
    elif case == "ties":
        v = r.integers(-1, 2, (n, 4)) / 4
        v[100:400] = v[3]  # a group of copies
    else:
        v = r.normal(0, 1, (n, 6)) * 1e6  # sums beyond what doubles hold exactly
    rows = [(int(i), int(r.integers(0, 5)), x.round(3).tolist(), "x") for i, x in enumerate(v)]
    rows += [(2000, 1, None, None), (2010, None, [1.0] * 4, ""), (2020, 1, [float("nan")] * 4, ""), (2030, 2, [None, 1.0], ""), (2040, 3, [1.0], ""), (None, 1, [0.5] * 4, "")]
    rows += [(0, *rows[0][1:]), (10, *rows[10][1:]), (2050, 4, [], ""), (2060, 0, [0.0] * 4, ""), (2070, 77, [0.1] * 4, "")]
    got = shared_lists.mine(spark.createDataFrame(rows, VEC).repartition(5), every=20, shard_rows=64, block_rows=8).collect()
    assert sorted(tuple(x) for x in got) == _mined(rows, 20, 5, 10, 30, 90)


def test_hard_negatives_stop_their_walk_early():
    r = np.random.default_rng(1)
    centres = r.normal(0, 1, (8, 24)) * 200
    x = np.floor(np.repeat(centres, 2000, axis=0) + r.normal(0, 4, (16000, 24)))
    shard, scored = shared_lists.Shard(np.arange(len(x)), np.zeros(len(x), np.int64), x), []
    q = x[:16]
    seen = type("Count", (np.ndarray,), {"__getitem__": lambda s, i: (scored.append(np.size(i)), np.asarray(s)[i])[1]})
    shard.x = x.view(seen)
    got = shard.walk(np.arange(16), np.zeros(16, np.int64), q, [{0: (shared_lists.LEAST, shared_lists.MOST)}] * 16, 5, True)
    for m in range(16):
        want = sorted((-int(s), i) for i, s in enumerate(x @ q[m]) if i != m)[:5]
        assert sorted((-s, i) for k, i, s in got if k == m) == want


def test_hard_negatives_empty(spark):
    assert shared_lists.mine(spark.createDataFrame([], VEC)).count() == 0
    assert shared_lists.mine(spark.createDataFrame([(100, 1, None, "")], VEC)).count() == 0


def _damage(rows):
    for c, t, r, x, _ in rows:
        name = lambda v: " " if v is None else str(v)
        h = zlib.crc32(f"{name(c)}:{name(t)}".encode()) % 20
        x = {1: "", 2: re.sub("[.!?]", "", name(x))}.get(h, name(x))
        for _ in range({0: 0, 3: 2}.get(h, 1)):
            yield c, t, "user" if h == 4 else name(r), x


def _goes(state, role):
    return {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(role[:1], {}).get(state)


def _repaired(rows):
    """Forwards, with every edit, audit and text written out."""
    rows = sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0, x[2].encode(), hashlib.md5(x[3].encode()).hexdigest()))
    seen, count, best = set(), dict.fromkeys(("blank", "duplicate", "truncated"), 0), {0: (0, "", [])}

    def put(into, state, cost, audit, lines):
        if state is not None and (state not in into or (cost, audit) < into[state][:2]):
            into[state] = (cost, audit, lines)

    def inserted(best):
        for _ in range(4):
            for s, (c, a, got) in list(best.items()):
                for role in ("user", "assistant"):
                    put(best, _goes(s, role), c + 5, a + "I", got + [role + ":"])
        return best

    best = inserted(best)
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\r\v\f")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            count[fault] += 1
        new = {}
        for s, (c, a, got) in best.items():
            put(new, s, c + 2, a + "D", got)
            if fault in (None, "truncated"):
                c += 5 if fault else 0
                put(new, _goes(s, role), c, a + "K", got + [f"{role}:{text}"])
                for other in ("user", "assistant"):
                    put(new, _goes(s, other), c + 1, a + "R", got + [f"{other}:{text}"])
        best = inserted(new)
    cost, audit, lines = min((best[s] for s in (0, 3) if s in best), key=lambda b: b[:2])
    turns = [t for _, t, _, _ in rows if t is not None]
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *count.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _turns():
    r, rows = random.Random(2), []
    for c in [*range(40), None]:
        odd = r.random()
        for t in range(r.choice([0, 1, 3, 8, 40])):
            role = r.choice(["user", "assistant", "system", "tool", None, ""]) if r.random() < odd else ("user", "assistant")[t % 2]
            rows.append((c, None if r.random() < 0.05 else t * r.choice([1, 1, 1, 2]), role, r.choice(["ok.", "Yes!", "no", "  ", None, "x.. ", "?", f"{t} fine.", f"{t} cut", f"é\n{t}."]), "x"))
    rows += [(7, 5, "user", "ok.", "")] * 9  # copies of a row
    rows += [(100, t, "user", f"never ended {t}", "") for t in range(60)]  # no vector settles
    rows += [(101, t, "user" if t % 2 else "assistant", f"{t}.", "") for t in range(300)]
    return rows


@pytest.mark.parametrize("chunk_rows, damage", [(2, False), (3, True), (256, True)])
def test_repair_against_brute_force(spark, chunk_rows, damage, monkeypatch):
    monkeypatch.setattr(turn_repair, "RUN", 4)
    rows = _turns()
    frame = spark.createDataFrame(rows, TURN).repartition(5)
    got = {x["conv_id"]: tuple(x)[1:] for x in turn_repair.repair(frame, chunk_rows=chunk_rows, damage=damage).collect()}
    name = lambda v: " " if v is None else v
    base = list(_damage(rows)) if damage else [(c, t, name(r), name(x)) for c, t, r, x, _ in rows]
    want = {c: _repaired([x for x in base if x[0] == c]) for c in {x[0] for x in rows}}
    assert got == want


def test_fix_up_passes_stop_where_vectors_meet():
    syms = "ua" * 500
    vecs, head = turn_repair.swept(syms, turn_repair.END)
    other = turn_repair.back("x", turn_repair.END)[0]
    again = list(vecs)
    again[-3] = -1  # a mark that a rerun must overwrite
    again[10] = -2  # and one that it must not reach
    fixed, new_head = turn_repair.swept(syms, (0, 12, 3, 1), again)
    plain, plain_head = turn_repair.swept(syms, (0, 12, 3, 1))
    assert fixed[10] == -2 and fixed[-3] == plain[-3] and fixed[11:] == plain[11:] and other is not None
    assert plain_head == head


def test_repair_empty_and_dropped(spark):
    assert turn_repair.repair(spark.createDataFrame([], TURN)).count() == 0
    gone = next(t for t in range(500) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    got = turn_repair.repair(spark.createDataFrame([(5, gone, "user", "a.", "")], TURN), damage=True).collect()
    assert [tuple(x) for x in got] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_word_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer

    plain, r = Tokenizer.from_file(VOCABULARY), random.Random(1)
    letters = [*"aAbé İßK'’st.,!?)\"<|≯̇=   \n\t1中ǅﬀ", "<|endoftext|>", "'s", "é", "z" * 300]
    texts = ["".join(r.choices(letters, k=r.randint(0, 40))) for _ in range(1500)] + [None, "", " \n ", "ab, " * 100_000, " " * 3_000_000 + "x.", "b" * 100_000]
    got = list(cost_packing.WordIds(VOCABULARY).rows(pa.array(texts, pa.string())))
    for text, ids in zip(texts, got, strict=True):
        assert plain.encode(text or "", add_special_tokens=False).ids == ids.tolist()


def test_held_words_are_let_go(monkeypatch):
    monkeypatch.setattr(cost_packing, "WORDS_HELD", 50)
    words = cost_packing.WordIds(VOCABULARY)
    texts = [f"word{i} other{i * 7}, again" for i in range(200)]
    once = [list(words.rows(pa.array([t])))[0].tolist() for t in texts]
    assert once == [x.tolist() for x in cost_packing.WordIds(VOCABULARY).rows(pa.array(texts))]
    assert len(words.place) <= 60


def test_balanced_pieces():
    r = random.Random(4)
    lengths = [r.choice([0, 1, 3, 50, 700, 4096, 5000, 20000]) for _ in range(300)] + [700] * 50
    pieces = cost_packing.balanced(lengths, 4096, 1.0, 1e-4)
    for i, n in enumerate(lengths):
        own = sorted((s, k) for j, s, k, *_ in pieces if j == i)
        assert [s for s, _ in own] == [sum(k for _, k in own[:x]) for x in range(len(own))] and sum(k for _, k in own) == n
    size = {}
    for _, _, k, seq, offset in sorted(pieces, key=lambda p: p[3:]):
        assert offset == size.get(seq, 0)
        size[seq] = offset + k
    assert sorted(size.values()) == sorted(cost_packing.capacities(sum(lengths), 4096)) and all(n == 4096 or n & (n - 1) == 0 for n in size.values())


def test_pieces_go_to_the_cheapest_sequence():
    """Against a plain scan of all open sequences."""
    r = random.Random(6)
    lengths = [r.randint(1, 90) for _ in range(200)]
    room, cost, todo, want = dict(enumerate(cost_packing.capacities(sum(lengths), 64))), {}, [(-n, i, 0) for i, n in enumerate(lengths)], []
    while todo:
        todo.sort()
        n, i, start = todo.pop(0)
        fit = [s for s in room if room[s] >= -n] or [s for s in room if room[s]]
        s = min(fit, key=lambda s: (cost.get(s, 0.0), s))
        k = min(-n, room[s])
        want.append((i, start, k, s))
        room[s] -= k
        cost[s] = cost.get(s, 0.0) + 2.0 * k + 0.5 * k * k
        if -n > k:
            todo.append((n + k, i, start + k))
    assert [p[:4] for p in cost_packing.balanced(lengths, 64, 2.0, 0.5)] == want


def test_packed_sequences_hold_every_document(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(VOCABULARY)
    texts = ["a b c", None, "", "one, two. " * 900, "Zürich <|endoftext|> ok", "a b c"]
    rows = [(i if i < 5 else None, t, "x") for i, t in enumerate(texts)]
    pieces = cost_packing.pack(spark.createDataFrame(rows, "doc_id long, text string, IDS string").coalesce(1), VOCABULARY, row_len=64).cache()
    got = {}
    for x in sorted(pieces.collect(), key=lambda x: x["start"]):
        ids = np.frombuffer(x["ids"], "<u4").tolist()
        assert len(ids) == x["length"] and x["start"] == len(got.get(x["doc_id"], []))
        got.setdefault(x["doc_id"], []).extend(ids)
    assert got == {d: plain.encode(t or "", add_special_tokens=False).ids + [2] for d, t, _ in rows}
    for x in cost_packing.sequences(pieces, 64, pad_id=9).collect():
        ids = np.frombuffer(x["input_ids"], "<u4")
        assert len(ids) == (64 if x["n_tokens"] & (x["n_tokens"] - 1) else x["n_tokens"]) and x["cu_seqlens"][-1] == x["n_tokens"]
        assert (ids[x["n_tokens"] :] == 9).all()
    assert cost_packing.pack(spark.createDataFrame([], "doc_id long, text string"), VOCABULARY).count() == 0
    assert pieces.where(F.col("length") < 1).count() == 0
