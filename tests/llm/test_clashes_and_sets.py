"""Clashing column names, language sets and k-best bounds against brute force, long texts."""

import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoframe.llm import _vec as V
from chronoframe.llm import html_blocks, kneser_ney, langid, maxscore, secret_scan

TEXT = "some plain words here and there"


def _extra(frame, *names):
    return frame.select("*", *(F.lit(f"old {n}").alias(n) for n in names))


@pytest.mark.parametrize("clash", [("_text", "input", "Score", "LANG_PRED", "a.b"), ("_html", "Input", "input_", "N_KEPT", "N_grams")])
def test_clashing_columns(spark, clash):
    docs = _extra(spark.createDataFrame([(1, TEXT), (2, None)], "doc_id long, body string"), *clash)
    kept = lambda *new: ["doc_id", *(c for c in clash if c.lower() not in new), *new]
    model = langid.train(spark.createDataFrame([(TEXT, "en")], "text string, lang string"))
    lang = langid.predict(docs, model, "body")
    toxic = kneser_ney.train(spark.createDataFrame([(1, TEXT)], "doc_id long, text string"), spark.createDataFrame([(1, 0)], "doc_id long, toxic int"))
    score = kneser_ney.scores(docs, toxic, "body")
    pages = html_blocks.extract(docs, html_blocks.fit([], made_pages=20, epochs=1), "body")
    for got, new in ((lang, ("lang_pred", "score", "n_grams")), (score, ("mean_ratio", "score")), (pages, ("text", "n_blocks", "n_kept"))):
        assert got.columns == kept(*new)
        rows = got.select(*(f"`{c}`" for c in got.columns)).collect()
        assert {r["doc_id"] for r in rows} == {1, 2} and all(r[c] == f"old {c}" for r in rows for c in clash if c.lower() not in new)


def _grams(text):
    return [p[i : i + 4] for w in re.findall("[^\\W\\d_]+", text.lower()) for p in [f" {w} "] for i in range(len(p) - 3)]


def _hash(gram):
    acc = np.zeros(1, V.U)
    for c in gram:
        acc = acc * V.SEQ + V.U(ord(c))
    return V.mix(acc)[0]


def test_language_sets_against_brute_force(spark, monkeypatch):
    """Every n-gram of a language's covering set is in its filter, whatever other languages
    hold it too; few others are; shares follow from hits, false rate and coverage."""
    monkeypatch.setattr(langid, "HELD", 200)
    r = random.Random(5)
    word = lambda: "".join(r.choices("abcdefghijklmnopqrstuvwxyz\u00e9\u0436", k=r.randint(2, 8)))
    both = [word() for _ in range(100)]
    own = {k: [word() for _ in range(300)] + both for k in ("aa", "bb", "cc")}
    odds = {k: [1 / (i + 1) for i in r.sample(range(400), 400)] for k in own}
    rows = [(" ".join(r.choices(own[k], odds[k], k=r.randint(0, 60))), k) for k in own for _ in range(40)] + [(None, "aa"), ("", None)]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string").repartition(3), coverage=0.9)
    assert model.languages == ["aa", "bb", "cc"]
    seen = {k: Counter(g for t, lang in rows if lang == k for g in _grams(t or "")) for k in own}
    every = sorted(set().union(*seen.values()))
    mask = model.masks(np.array([_hash(g) for g in every], V.U))[0]
    for i, k in enumerate(model.languages):
        total, before, least = sum(seen[k].values()), 0, None
        for n, times in sorted(Counter(seen[k].values()).items(), reverse=True):
            if before >= 0.9 * total:
                break
            before, least = before + n * times, n
        assert model.cover[i] == pytest.approx(before / total)
        hit = {g for g, m in zip(every, mask.tolist()) if m >> i & 1}
        inside = {g for g in every if seen[k][g] >= least}
        assert inside <= hit and len(hit - inside) <= 0.1 * (len(every) - len(inside))
    texts = [t for t, _ in rows[:20]] + ["zzzz 12"]
    grams, count, _ = langid.Grams(4).of(texts)
    share = model.scores(grams, count)
    for t, row in zip(texts, share):
        hits = model.masks(np.array([_hash(g) for g in _grams(t)], V.U))[0] if _grams(t) else np.zeros(0, V.U)
        for i, f in enumerate(model.false_rate):
            c = sum(int(m) >> i & 1 for m in hits)
            assert row[i] == pytest.approx(max(0, (c / max(1, len(hits)) - f) / (1 - f)) / model.cover[i])


def test_what_pairs_leave_makes_one():
    have = np.array([[10.0, 4.0, 0.0], [3.0, 0.0, 7.0]])
    at, seen = np.array([0, 0, 1, 2]), np.array([[6.0, 3.0, 4.0, 0.0], [2.0, 0.0, 0.0, 5.0]])
    got = kneser_ney._leftover(have, at, seen)
    for c in (0, 1):
        for x in range(3):
            listed = sum(max(seen[c, i] - kneser_ney.DISCOUNT, 0) for i in np.flatnonzero(at == x))
            assert got[c, x] + (listed / have[c, x] if have[c, x] else 0) == pytest.approx(1)


def _best(vecs, ids, every, k):
    out = set()
    for own in {i for i in ids if i % every == 0}:
        for q in {tuple(v) for i, v in zip(ids, vecs) if i == own}:
            scores = sorted((-sum(int(a) * int(b) for a, b in zip(q, v)), i) for i, v in zip(ids, vecs) if i != own)
            out |= {(own, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])}
    return out


@pytest.mark.parametrize("spread, lane", [(0.0, 2), (0.02, 256)])
def test_top_k_in_far_apart_groups(spark, monkeypatch, spread, lane):
    """Groups of far apart vectors, whose shards are ruled out by their ranges, with
    repeated rows, ties, vectors of several lengths and fewer rows than k."""
    monkeypatch.setattr(maxscore, "LANE", lane)
    r = np.random.default_rng(2)
    groups = r.normal(0, 10, (6, 12))
    vecs = [np.floor(groups[i % 6] + spread * r.normal(0, 1, 12)).tolist()[: 12 - i % 3] for i in range(300)]
    ids = list(range(300))
    rows = list(zip(ids, vecs)) + [(7, vecs[7])] * 2
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = maxscore.top_k(frame, every=10, k=4, scale=1, shard_rows=20, block_rows=3)
    assert {tuple(x) for x in got.collect()} == _best([v for _, v in rows], [i for i, _ in rows], 10, 4) and got.count() == 120
    few = maxscore.top_k(frame.where("vec_id < 3"), every=1, k=9, scale=1, shard_rows=2, block_rows=1).collect()
    assert len(few) == 6 and maxscore.top_k(frame.where("vec_id < 0")).count() == 0


def test_pairs_that_bounds_rule_out_are_not_sent(spark):
    near = [(i, [100.0 + i % 5, 1.0]) for i in range(0, 40)]
    far = [(i, [-100.0, 1.0]) for i in range(41, 99)]
    blocks, _ = maxscore._packed(spark.createDataFrame(near[:4], "id long, v array<double>").coalesce(1), 4, "b")
    shards, _ = maxscore._packed(spark.createDataFrame(near + far, "id long, v array<double>").coalesce(1), 40, "s")
    bounds = sorted(x["bound"] for x in maxscore._pairs(blocks, shards, 3).collect())
    assert len(bounds) == 3 and bounds[0] < 0 and bounds[-1] >= 104 * 103 + 1


def test_a_hundred_thousand_spans_in_one_text(spark):
    tokens = [f"token={i:012d}abcdefgh" for i in range(50_000)]
    text = " ".join(tokens)
    frame = spark.createDataFrame([(1, "s", text)], "doc_id long, source string, text string")
    start = time.time()
    found = secret_scan.scan_secrets(frame).withColumn("spans", F.filter("spans", lambda s: s["owned"]))
    got = found.join(frame, "doc_id").select(F.size("spans").alias("n"), secret_scan.masked("text", "spans", "#").alias("m")).first()
    assert got["n"] == 100_000 and got["m"] == " ".join("#" for _ in tokens)
    assert time.time() - start < 60


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_stages_with_clashing_columns_and_empty_tables(spark, tmp_path, empty):
    import corpus_pipeline as P

    r = random.Random(3)
    words = ["".join(r.choices("abdeikmnorst", k=5)) for _ in range(300)]
    text = lambda: " ".join(r.choices(words, k=40))
    item, live = text(), "token = Aq9Zx7Lm2Wk4Rt6Yp8Nv0B"
    first = text()
    rows = [(1, first), (2, first), (3, f"{text()} {item}"), (4, f"{text()} {live}"), (5, f"{text()} {live}"), (None, text()), (7, None)]
    clash = ("_th", "th", "row", "spans", "_spans", "k", "d", "group_id", "kind", "a.b", "Score", "c0", "g")
    docs = spark.createDataFrame([] if empty else [(i, t, "en", f"o{i}") for i, t in rows], "doc_id long, text string, lang string, source string")
    docs = _extra(docs, *clash)
    spark.createDataFrame([] if empty else [(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    columns = docs.columns
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns, name
        path = str(tmp_path / name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    got = docs.collect()
    assert all(x[c] == f"old {c}" for x in got for c in clash)
    assert sorted((x["doc_id"] or 0) for x in got) == ([] if empty else [0, 1, 4, 5])
    assert sum(P.SECRET_MARK in x["text"] for x in got) == (0 if empty else 2)
    out = P.encode(spark, docs, str(tmp_path))
    assert out.count() >= len(got)
