"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks: runs of text between block-level tags.
Each block is described by its tag path (tags, class, id and role words, hashed), its
words (hashed) and a few counts. A numpy bidirectional LSTM reads the sequence both
ways, so each block is classified with the whole document as context.

The network is trained here, on the driver, from a fixed seed, on two bounded sets: up
to ``fit_pages`` pages of the table whose one ``article`` or ``main`` element marks the
main text, and ``made_pages`` pages laid out at random from common parts (menus, headers,
notices, adverts, sidebars, forms, reader comments, footers around and inside main text)
filled with sentences of those pages.
"""

from __future__ import annotations

import html
import math
import random
import re
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _spark as S
from ._html import attributes, tokens

#: Elements without main text, and those with a syntax of their own.
RAW, NESTED = frozenset("script style textarea title iframe".split()), frozenset("noscript template select svg".split())
FOREIGN = frozenset(["svg", "math"])
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: An open element that a start tag of one of the named kinds ends.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPE = {"ul", "ol", "menu", "dl", "table", "article", "aside", "nav", "section", "div", "td", "main"}
_WORD = re.compile(r"[a-z0-9]+")


#: Elements that say where main text is, in the pages to train on.
MARKS = frozenset("article main nav aside footer form".split())
PATHS, WORDS = 1024, 512
COUNTS = 8


@dataclass
class Block:
    """``path``: ids of the features of all open tags; ``inside``: which MARKS are open."""

    path: list[int]
    text: str
    linked: int
    inside: set = frozenset()


@lru_cache(1 << 16)
def _hash(word: str, size: int) -> int:
    return 1 + zlib.crc32(word.encode("utf-8", "surrogatepass")) % (size - 1)


#: What a start tag ends, and where looking for it stops.
_CLOSES = {tag: (ENDS.get(tag, set()) | {"p"}, SCOPE - ENDS.get(tag, set())) for tag in BLOCK}


@lru_cache(1 << 14)
def _step(outer: str, tag: str) -> tuple[int, ...]:
    return (_hash("t:" + tag, PATHS), _hash(f"{outer}>{tag}", PATHS))


class _Open:
    """The open elements and, kept as they open and close, the ids of their path."""

    def __init__(self):
        self.stack: list[tuple[str, str, tuple[int, ...]]] = []  # tag, innermost tag of the path, ids
        self.at: dict[str, list[int]] = {}  # open tags only
        self.ids: dict[int, int] = {}

    def last(self, tags) -> int:
        """Where the innermost of ``tags`` is open; -1: nowhere."""
        return max((self.at[t][-1] for t in tags if t in self.at), default=-1)

    def push(self, tag: str, ids: tuple[int, ...]) -> None:
        outer = self.stack[-1][1] if self.stack else ""
        if tag not in ("html", "body"):
            ids += _step(outer, tag)
            outer = tag
        self.at.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, outer, ids))
        for x in ids:
            self.ids[x] = self.ids.get(x, 0) + 1

    def cut(self, depth: int) -> None:
        while len(self.stack) > depth:
            tag, _, ids = self.stack.pop()
            at = self.at[tag]
            at.pop()
            if not at:
                del self.at[tag]
            for x in ids:
                if self.ids[x] == 1:
                    del self.ids[x]
                else:
                    self.ids[x] -= 1

    def path(self) -> list[int]:
        return sorted({*self.ids, _hash((self.stack[-1][1] if self.stack else "") + ">", PATHS)})


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order; text decoded, its white space single and trimmed."""
    out: list[Block] = []
    opened = _Open()
    parts: list[str] = []
    linked = 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(opened.path(), text, linked, MARKS & opened.at.keys()))
            parts.clear()
        linked = 0

    for kind, tag, value, _ in tokens(page, RAW, NESTED, FOREIGN):
        if kind == "text":
            text = html.unescape(value)
            parts.append(text)
            linked += len(text.strip()) if "a" in opened.at else 0
        elif kind == "hidden":
            parts.append(" ")
        elif kind in ("start", "end"):
            if tag in BLOCK:
                flush()
            if kind == "end":
                if tag in opened.at:
                    opened.cut(opened.at[tag][-1])
                continue
            if tag == "br":
                parts.append(" ")
            if tag in BLOCK:
                closes, scope = _CLOSES[tag]
                while (at := opened.last(closes)) >= 0 and at > opened.last(scope):
                    ended = opened.stack[at][0]
                    opened.cut(at)
                    if ended != "p":
                        break
            if tag in VOID or value.endswith("/") and tag not in BLOCK and tag != "a":
                continue
            named = [x for x in attributes(value) if x[0] in ("class", "id", "role")] if "=" in value else ()
            opened.push(tag, tuple(_hash(f"{k[0]}:{w}", PATHS) for k, v in named for w in _WORD.findall(v.lower())))
    flush()
    return out


@lru_cache(1 << 17)
def _word(word: str) -> int:
    return 1 + zlib.crc32(word.strip(".,;:!?()\"'").encode("utf-8", "surrogatepass")) % (WORDS - 1)


def features(page: list[Block]) -> tuple[list[list[int]], list[dict[int, float]], np.ndarray]:
    """Per block: ids of its whole path, shares of the ids of all its words, counts."""
    words, counts = [], []
    last = max(1, len(page) - 1)
    for i, b in enumerate(page):
        found = b.text.lower().split()
        k = len(found)
        words.append({w: c / k for w, c in Counter(map(_word, found)).items()} or {0: 1.0})
        n, stops = len(b.text), sum(map(b.text.count, ".,;:!?"))
        counts.append((math.log1p(n) / 8, math.log1p(k) / 6, min(1.0, b.linked / n), stops / n * 10, i / last, 1.0 * (i == 0), 1.0 * (i == len(page) - 1), 1.0))
    return [b.path for b in page], words, np.array(counts).reshape(-1, COUNTS)


class Labeller:
    """Embedding sums, a bidirectional LSTM, a logistic output over both states and the input."""

    def __init__(self, seed: int = 7, width: int = 24, hidden: int = 16):
        r = np.random.default_rng(seed)
        d, h = width, hidden
        self.h = h
        self.p = {"path": r.normal(0, 0.1, (PATHS, d)), "word": r.normal(0, 0.1, (WORDS, d)), "count": r.normal(0, 0.3, (COUNTS, d)), "out": r.normal(0, 0.1, 2 * h + d), "bias": np.zeros(1)}
        for k in "fb":
            self.p["w" + k] = r.normal(0, 1 / np.sqrt(d + h), (d + h, 4 * h))
            self.p["c" + k] = np.concatenate([np.ones(h), np.zeros(3 * h)])  # forget gates start open

    def inputs(self, batch):
        """[pages, blocks, width] inputs, the mask, and what the gradients need."""
        n, t = len(batch), max(len(x[0]) for x in batch)
        x = np.zeros((n, t, self.p["count"].shape[1]))
        mask = np.zeros((n, t))
        counts = np.zeros((n, t, COUNTS))
        owner, path, wowner, word, share = [], [], [], [], []
        for i, (ps, ws, cs) in enumerate(batch):
            mask[i, : len(ps)] = 1
            counts[i, : len(ps)] = cs
            for j, (p, w) in enumerate(zip(ps, ws)):
                owner += [i * t + j] * len(p)
                path += p
                wowner += [i * t + j] * len(w)
                word += w
                share += w.values()
        at = tuple(np.array(v, np.int64) for v in (owner, path, wowner, word)) + (np.array(share)[:, None],)
        flat = x.reshape(n * t, -1)
        _add_rows(flat, at[0], self.p["path"][at[1]])
        _add_rows(flat, at[2], self.p["word"][at[3]] * at[4])
        x += counts @ self.p["count"]
        return np.tanh(x), mask, counts, at

    def _run(self, x, mask, way):
        w, c, h = self.p["w" + way], self.p["c" + way], self.h
        n, t, _ = x.shape
        hs, state, keep = np.zeros((n, t, h)), (np.zeros((n, h)), np.zeros((n, h))), []
        for i in range(t) if way == "f" else range(t - 1, -1, -1):
            z = np.concatenate((x[:, i], state[0]), axis=1)
            a = z @ w + c
            f, g, o = (1 / (1 + np.exp(-a[:, k * h : (k + 1) * h])) for k in range(3))
            u = np.tanh(a[:, 3 * h :])
            cell = f * state[1] + g * u
            live = mask[:, i : i + 1]
            cell = live * cell + (1 - live) * state[1]
            tc = np.tanh(cell)
            out = live * (o * tc) + (1 - live) * state[0]
            keep.append((i, z, f, g, o, u, state[1], tc, live))
            state = (out, cell)
            hs[:, i] = out
        return hs, keep

    def logits(self, batch):
        x, mask, counts, at = self.inputs(batch)
        (hf, kf), (hb, kb) = self._run(x, mask, "f"), self._run(x, mask, "b")
        z = np.concatenate((hf, hb, x), axis=2)
        return z @ self.p["out"] + self.p["bias"], mask, (x, counts, at, z, kf, kb)

    def gradients(self, batch, labels):
        out, mask, (x, counts, at, z, kf, kb) = self.logits(batch)
        y = np.zeros_like(out)
        for i, lab in enumerate(labels):
            y[i, : len(lab)] = lab
        err = mask * (1 / (1 + np.exp(-out)) - y) / mask.sum()
        h = self.h
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["out"], g["bias"] = np.einsum("nt,ntk->k", err, z), np.array([err.sum()])
        dz = err[:, :, None] * self.p["out"]
        dx = dz[:, :, 2 * h :].copy()
        for way, keep, part in (("f", kf, dz[:, :, :h]), ("b", kb, dz[:, :, h : 2 * h])):
            dh, dc = np.zeros((len(batch), h)), np.zeros((len(batch), h))
            for i, zi, f, gi, o, u, before, tc, live in reversed(keep):
                dh_all = dh + part[:, i]
                dh, dc_in = dh_all * live, dc * live
                dcell = dc_in + dh * o * (1 - tc**2)
                da = np.concatenate((dcell * before * f * (1 - f), dcell * u * gi * (1 - gi), dh * tc * o * (1 - o), dcell * gi * (1 - u**2)), axis=1)
                g["w" + way] += zi.T @ da
                g["c" + way] += da.sum(axis=0)
                back = da @ self.p["w" + way].T
                dx[:, i] += back[:, :-h]
                dh = back[:, -h:] + dh_all * (1 - live)
                dc = dcell * f + dc * (1 - live)
        dx *= (1 - x**2) * mask[:, :, None]
        flat = dx.reshape(-1, dx.shape[2])
        np.add.at(g["path"], at[1], flat[at[0]])
        np.add.at(g["word"], at[3], flat[at[2]] * at[4])
        g["count"] = np.einsum("ntk,ntd->kd", counts, dx)
        return g

    def fit(self, pages, labels, epochs: int = 14, batch: int = 24, rate: float = 0.01, seed: int = 1):
        r = random.Random(seed)
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        step = 0
        order = [i for i, p in enumerate(pages) if p[0]]
        for epoch in range(epochs):
            r.shuffle(order)
            for a in range(0, len(order), batch):
                pick = order[a : a + batch]
                # Half of the blocks go without their words: the layout must do.
                seen = [(pages[i][0], [w if r.random() < 0.5 else {0: 1.0} for w in pages[i][1]], pages[i][2]) for i in pick]
                g = self.gradients(seen, [labels[i] for i in pick])
                step += 1
                lr = rate * (1 - epoch / epochs) + 1e-4
                for k in self.p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                    self.p[k] -= lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def keeps(self, pages, cells: int = 20_000) -> list[np.ndarray]:
        """Per page, whether each block is main text. Pages of like length go together,
        about ``cells`` padded blocks at a time (or one longer page)."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if p[0]), key=lambda i: len(pages[i][0]))
        a = 0
        while a < len(order):
            b = a + 1
            while b < len(order) and len(pages[order[b]][0]) * (b + 1 - a) <= cells:
                b += 1
            got, _, _ = self.logits([pages[i] for i in order[a:b]])
            for row, i in zip(got, order[a:b]):
                out[i] = row[: len(pages[i][0])] > 0
            a = b
        return out


def _add_rows(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """into[rows] += values for ascending rows."""
    if len(rows):
        head = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        into[rows[head]] += np.add.reduceat(values, head, axis=0)


# -- training pages ----------------------------------------------------------------

MENU = "Home|News|About|About us|Contact|Products|Services|Blog|Sign in|Log in|Search|Help|FAQ|Shop|Careers|Archive|Sports|World|Politics".split("|")
FOOT = "Privacy Policy|Terms of Service|All rights reserved|Contact us|Imprint|Sitemap|Powered by our CMS|Accessibility|Cookie settings".split("|")
NOTICE = "We use cookies to improve your experience.|This site uses cookies. Accept|Subscribe to continue reading.|Please enable JavaScript.|Your browser is out of date.".split("|")
FORM = "Email address|Your name|Subscribe|Send|Password|Search|Submit|Message|I agree to the terms".split("|")
ADVERT = "Advertisement|Sponsored|Buy now and save|Limited offer|Special deal for you|Promoted content".split("|")
SHARE = "Share|Tweet|Like|Print|Share on Facebook|Email this|Related articles|Read more|You may also like|Tags".split("|")


class _Maker:
    def __init__(self, sentences: list[str], seed: int):
        self.r, self.deeper = random.Random(seed), random.Random(seed + 1)
        self.s = sentences or ["Some text of a page goes here."]

    def say(self, n: int = 1) -> str:
        return " ".join(self.r.choice(self.s) for _ in range(n))

    def word(self) -> str:
        return self.r.choice(self.say().split() or ["x"])

    def name(self, names: str) -> str:
        pick = self.r.choice(names.split("|"))
        how = self.r.random()
        more = self.r.choice(["", "", " box", " block-%d" % self.r.randint(1, 9), " wide"])
        return "" if how < 0.1 else f' class="{pick}{more}"' if how < 0.7 else f' id="{pick}"' if how < 0.9 else f' id="{pick}" class="{self.r.choice(["container", "row", "col", "wrap"])}"'

    def named(self, names: str) -> str:
        while not (got := self.name(names)):
            pass
        return got

    def some(self, fixed: list[str], long: float = 0.3) -> str:
        how = self.r.random()
        return self.say(self.r.randint(1, 3)) if how < long else self.word() if how < 0.5 else self.r.choice(fixed)

    def links(self, k: int, fixed: list[str], names: str) -> str:
        item = lambda: f'<a href="/{self.r.randint(1, 999)}">{self.r.choice(fixed) if self.r.random() < 0.4 else self.word()}</a>'
        if self.r.random() < 0.7:
            return f"<ul{self.name(names)}>" + "".join(f"<li>{item()}</li>" for _ in range(k)) + "</ul>"
        return " | ".join(item() for _ in range(k))

    def deep(self, part: str) -> str:
        """Some parts have their content under many plain wrappers."""
        m = re.fullmatch(r"(<(?!p\b)[^>]+>)(.*)(</\w+>)", part, re.S)
        if not m or self.deeper.random() > 0.2:
            return part
        k = self.deeper.randint(1, 30)
        return m[1] + "<div>" * k + m[2] + "</div>" * k + m[3]

    def menu(self):
        names = "menu|nav|navbar|main-menu|navigation|breadcrumb|breadcrumbs|topnav|tabs"
        body = self.links(self.r.randint(2, 8), MENU, names)
        return f"<nav{self.name(names)}>{body}</nav>" if self.r.random() < 0.6 else f"<div{self.named(names)}>{body}</div>"

    def head(self):
        names = "header|masthead|banner|site-header|topbar|page-header|logo"
        body = "".join(self.r.sample([f"<a href=\"/\">{self.some(MENU)}</a>", f"<h1>{self.some(MENU)}</h1>", f"<p>{self.say()}</p>", f"<div>{self.some(MENU)}</div>", self.menu()], self.r.randint(1, 3)))
        return f"<header{self.name(names)}>{body}</header>" if self.r.random() < 0.6 else f"<div{self.named(names)}>{body}</div>"

    def foot(self):
        names = "footer|site-footer|bottom|copyright|colophon|legal"
        text = f"&copy; {self.word()}.example.com &middot; {self.say()}" if self.r.random() < 0.5 else self.some(FOOT)
        body = "".join(self.r.sample([text, f"<p>{text}</p>", self.links(self.r.randint(2, 5), FOOT, "links|menu"), f"<div>{self.say(2)}</div>"], self.r.randint(1, 3)))
        return f"<footer{self.name(names)}>{body}</footer>" if self.r.random() < 0.6 else f"<div{self.named(names)}>{body}</div>"

    def advert(self):
        names = "ad|ads|advert|advertisement|sponsored|sponsor|promo|banner-ad|adbox|adsense"
        tag = self.r.choice(["div", "div", "aside", "section", "p"])
        body = self.r.choice([self.say(self.r.randint(1, 4)), f"<a href=\"#\">{self.some(ADVERT)}</a>", self.r.choice(ADVERT)])
        return f"<{tag}{self.named(names)}>{body if tag == 'p' or self.r.random() < 0.6 else f'<p>{body}</p>'}</{tag}>"

    def notice(self):
        names = "cookie|cookie-banner|cookies|consent|notice|alert|newsletter|popup|modal|gdpr|disclaimer|message"
        tag = self.r.choice(["div", "div", "section", "aside", "p"])
        body = self.some(NOTICE, 0.5)
        return f"<{tag}{self.named(names)}{self.r.choice(['', ' role=\"alert\"', ' role=\"dialog\"'])}>{body}{' <button>OK</button>' if self.r.random() < 0.4 else ''}</{tag}>"

    def side(self):
        names = "sidebar|side|aside|widget|related|recent|popular|trending|right-col|left-col|teaser"
        body = "".join(self.r.sample([f"<h3>{self.some(SHARE)}</h3>", self.links(self.r.randint(2, 6), SHARE, "list|links"), f"<p>{self.say(self.r.randint(1, 3))}</p>", f"<div>{self.say()}</div>"], self.r.randint(1, 3)))
        return f"<aside{self.name(names)}>{body}</aside>" if self.r.random() < 0.6 else f"<div{self.named(names)}>{body}</div>"

    def form(self):
        parts = [f"<label>{self.some(FORM)}</label><input name=\"x\">" for _ in range(self.r.randint(1, 3))] + [f"<p>{self.say()}</p>", f"<button>{self.r.choice(FORM)}</button>"]
        body = "".join(self.r.sample(parts, self.r.randint(1, len(parts))))
        return f"<form{self.name('search|login|subscribe|contact-form|signup')}>{body}</form>"

    def comments(self):
        names = "comments|comment-list|replies|discussion|responses|disqus|reader-comments|user-comments"
        one = lambda: f"<{(t := self.r.choice(['div', 'li', 'article', 'div']))}{self.named('comment|reply|comment-body|response')}>{f'<b>{self.word()}</b>' if self.r.random() < 0.5 else ''}<p>{self.say(self.r.randint(1, 4))}</p></{t}>"
        body = (f"<h2>{self.r.choice(['Comments', 'Reader comments', 'Leave a reply', '3 comments', 'Discussion'])}</h2>" if self.r.random() < 0.6 else "") + "".join(one() for _ in range(self.r.randint(1, 5)))
        tag = self.r.choice(["section", "div", "div", "ol", "aside"])
        return f"<{tag}{self.named(names)}>{body}</{tag}>"

    def share(self):
        return f"<div{self.named('share|social|tags|byline-share|related-links|share-buttons')}>{self.links(self.r.randint(2, 4), SHARE, 'links')}</div>"

    def main(self) -> str:
        parts = [f"<h1>{self.say()}</h1>"] if self.r.random() < 0.8 else []
        for _ in range(self.r.choice([0, 1, 2, 3, 5, 8, 12, 20])):
            how = self.r.random()
            body = self.say(self.r.choice([1, 1, 2, 3, 5, 9])) if self.r.random() < 0.9 else self.word()
            if self.r.random() < 0.15:
                body = f'{body} <a href="/x">{self.word()}</a> {self.say()}'
            parts.append(
                f"<p>{body}</p>" if how < 0.7 else f"<{(h := self.r.choice(['h2', 'h3', 'h4']))}>{self.say()}</{h}>" if how < 0.77 else f"<ul>{''.join(f'<li>{self.say()}</li>' for _ in range(3))}</ul>" if how < 0.82
                else f"<blockquote>{body}</blockquote>" if how < 0.86 else f"<p><b>{body}<br>" if how < 0.92 else f"<pre>{body}</pre>" if how < 0.94 else f"<div>{body}</div>" if how < 0.97 else f"<table><tr><td>{self.word()}</td><td>{self.say()}</td></tr></table>"
            )
        body = "\x01" + "\x02\x01".join(parts) + "\x02" if parts else ""
        pieces = body.split("\x02\x01") if body else []
        for _ in range(self.r.choice([0, 0, 0, 1, 2])):  # parts of others inside the main text
            if pieces:
                part = self.r.choice([self.advert, self.share, self.notice, self.side, self.form, self.comments])()
                at = self.r.randint(1, len(pieces))
                pieces.insert(at, f"\x02{part}\x01" if at < len(pieces) else part)
        body = "".join(pieces) if pieces else ""
        how = self.r.random()
        names = "content|article|post|entry|entry-content|post-body|story|article-body|main-content|text"
        if how < 0.55:
            return f"<article{self.name(names) if self.r.random() < 0.4 else ''}>{body}</article>"
        if how < 0.75:
            return f"<main{self.name(names) if self.r.random() < 0.4 else ''}>{body}</main>"
        return f"<div{self.named(names)}>{body}</div>"

    def page(self) -> str:
        pool = [self.menu, self.menu, self.head, self.advert, self.advert, self.notice, self.side, self.form, self.share]
        before = [f() for f in self.r.sample(pool, self.r.randint(0, 4))]
        after = [f() for f in self.r.sample([self.comments, self.comments, self.side, self.advert, self.form, self.foot, self.foot, self.notice, self.menu], self.r.randint(0, 4))]
        body = "".join(map(self.deep, [*before, self.main(), *after]))
        if self.r.random() < 0.3:
            body = f'<div class="{self.r.choice(["page", "wrapper", "container", "site", "layout"])}">{body}</div>'
        return f"<!DOCTYPE html><html><head><title>x</title></head><body>{body}</body></html>"


_MARK = re.compile("[\x01\x02]")


def _made(page: str) -> tuple[list[Block], list[int]]:
    """Blocks and labels of a made page: \\x01 and \\x02 stand around main text."""
    inside, labels, out = False, [], []
    for b in blocks(re.sub("([\x01\x02])", r"<hr>\1<hr>", page)):
        if _MARK.fullmatch(b.text):
            inside = b.text == "\x01"
        else:
            out.append(b)
            labels.append(int(inside))
    return out, labels


def fit(sample: list[str], made_pages: int = 1000, seed: int = 11, epochs: int = 14) -> Labeller:
    """Train on sampled pages of the table and on made pages."""
    pages, labels, sentences = [], [], []
    for source in sample:
        got = blocks(source)
        marked = {t for t in ("article", "main") if len(re.findall(rf"<{t}[\s>]", source, re.I)) == 1}
        if got and marked:
            box = "article" if "article" in marked else "main"
            pages.append(features(got))
            labels.append([int(box in b.inside and not b.inside & {"nav", "aside", "footer", "form"}) for b in got])
        sentences += [html.escape(b.text[:400]) for b in got if len(b.text) > 20][:20]
    real, maker = len(pages), _Maker(sentences, seed)
    for _ in range(made_pages):
        got, lab = _made(maker.page())
        pages.append(features(got)), labels.append(lab)
    return Labeller().fit(pages[:real] + pages, labels[:real] + labels, epochs)  # the table's own weigh double


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", fit_pages: int = 300, **options) -> Labeller:
    """Fit the labeller; ``fit_pages`` pages, the first by a hash of their id, are the
    bound of what reaches the driver. Tasks send hashes first, then only the picked pages,
    each once however often it is repeated."""
    S.text_batches(pages.sparkSession)
    some = pages.where(F.col(html_col).isNotNull()).select(F.col(html_col).alias("html"), F.xxhash64(F.col(id_col).cast("string"), F.xxhash64(html_col)).alias("h"))
    picked = [r["h"] for r in some.select("h").orderBy("h").limit(fit_pages).collect()]
    if not picked:
        return fit([], **options)
    whole = {r["h"]: r["html"] for r in some.where(F.col("h") <= picked[-1]).groupBy("h").agg(F.first("html").alias("html")).collect()}
    return fit([whole[h] for h in picked], **options)


def extract(pages: DataFrame, model: Labeller, html_col: str = "html") -> DataFrame:
    """``pages`` without its html, with ``text`` (the kept blocks, one per line), and
    ``n_blocks``/``n_kept``; columns of these names, in any case, are replaced.

    A null or empty page, and one without a block of main text, has the empty text.
    Every page is read whole; repeated rows repeat their result.
    """
    spark = pages.sparkSession
    S.text_batches(spark)
    sent = spark.sparkContext.broadcast(model)
    passed = S.others(pages, html_col, "text", "n_blocks", "n_kept")

    def run(batches):
        m = sent.value
        for batch in batches:
            found = [blocks(x or "") for x in batch.column(batch.num_columns - 1).to_pylist()]
            kept = m.keeps([features(x) for x in found])
            texts = ["\n".join(b.text for b, k in zip(x, keep) if k) for x, keep in zip(found, kept)]
            more = [pa.array(texts, pa.string()), pa.array([len(x) for x in found], pa.int32()), pa.array([int(k.sum()) for k in kept], pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *more], [*passed, "text", "n_blocks", "n_kept"])

    rows, schema = S.with_last(pages, passed, html_col)
    return rows.mapInArrow(run, schema.add("text", "string").add("n_blocks", "integer").add("n_kept", "integer"))
