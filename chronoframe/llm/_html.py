"""Web pages as tokens, in time linear in the page whatever its markup is like."""

from __future__ import annotations

import re
from collections import Counter

#: A quote counts after an equals sign only; the value runs to the next such quote.
_QUOTED = r"(?:[^>\"'=]++|=\s*+(?:\"[^\"]*\"|'[^']*')|[=\"'])*+"


def _pattern(attributes: str) -> re.Pattern:
    return re.compile(
        r"<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?:(?P<attr>" + attributes + r")>|(?P<open>[^>]*+)(?:>|\Z))"
        r"|(?P<text>[^<]++)|(?P<note><!--.*?(?:-->|\Z))|(?P<other><[!/?][^>]*+(?:>|\Z))|<",
        re.S,
    )


#: A tag that quotes would carry to the page's end closes at its first ``>``, and quotes
#: no longer count from there on, so no part of a page is searched twice for a closing one.
_QUOTING, _PLAIN = _pattern(_QUOTED), _pattern(r"[^>]*+")
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s]+)))?")


#: (kind, name, value, end): kind is text, start, end, gap (a comment), hidden (an element
#: without text) or other; ``end`` is where it ends in the page.
Token = tuple[str, str, str, int]
_GAP, _HIDDEN, _OTHER = ("gap", "", "", 0), ("hidden", "", "", 0), ("other", "", "", 0)


def tokens(page: str, raw: frozenset, nested: frozenset, foreign: frozenset) -> list[Token]:
    """Tokens of a page in order; ``value`` is a text or a start tag's attributes.

    ``raw`` elements hold no tags and run to the page's end if unclosed. Closed
    ``nested`` ones are one hidden token; an unclosed one is a tag like any other, as is
    a self-closed ``foreign`` one, in which self-closed raw elements are whole. A tag
    without a ``>`` after it takes the rest of the page, as in browsers.
    """
    found: list[Token] = []
    hidden: list[tuple[int, int]] = []
    opened: list[tuple[str, int]] = []
    depth = Counter()
    closing: dict[str, re.Pattern] = {}
    pattern = _QUOTING
    matches = pattern.finditer(page)
    while (m := next(matches, None)) is not None:
        kind = m.lastgroup
        if kind == "text" or kind is None:
            found.append(("text", "", m[0], m.end()))
            continue
        if kind == "note" or kind == "other":
            found.append(_GAP if kind == "note" else _OTHER)
            continue
        ending, name, value = m.group("end", "name", "attr")
        name = name.lower()
        if value is None:
            if m.end() == len(page) and page[-1] != ">":
                break
            value = m["open"]
            if pattern is _QUOTING:
                pattern = _PLAIN
                matches = pattern.finditer(page, m.end())
        whole = value.endswith("/")
        if ending:
            if name in depth and depth[name]:
                while True:
                    top, start = opened.pop()
                    depth[top] -= 1
                    if top == name:
                        break
                if name in nested:
                    while hidden and hidden[-1][0] >= start:
                        hidden.pop()
                    hidden.append((start, len(found)))
            found.append(("end", name, "", m.end()))
            continue
        if name in raw:
            if not (whole and any(depth[x] for x in foreign)):
                found.append(_HIDDEN)
                if name not in closing:
                    closing[name] = re.compile(rf"</{name}\s*>", re.I)
                end = closing[name].search(page, m.end())
                if end is None:
                    break
                matches = pattern.finditer(page, end.end())
                continue
        elif (name in nested or name in foreign) and not (whole and name in foreign):
            opened.append((name, len(found)))
            depth[name] += 1
        found.append(("start", name, value, m.end()))
    out, at = [], 0
    for start, end in hidden:
        out += found[at:start]
        out.append(_HIDDEN)
        at = end + 1
    return out + found[at:]


def attributes(value: str) -> list[tuple[str, str]]:
    """(lower-case name, value) of every attribute of a start tag, in order."""
    return [(m[1].lower(), m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(value)]
