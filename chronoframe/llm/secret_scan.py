"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Spans are found by pattern in whole texts: the base kinds ``assign``, ``access`` and
``hex`` and one more, ``mixed`` (a long token of upper case, lower case and digits that
touches no base span). Every span's value is hashed; hashes are aggregated by distinct
repositories and owners of the whole corpus. A value that ``copied_owners`` owners or
more hold is a widely copied example; any other is owner-specific and looks live.
Matching spans of the base kinds always stay; a ``mixed`` span is reported only if it
is owner-specific.

Aggregation goes through (hash, owner, repository), then (hash, owner), then hash, each
with map-side combining, so a credential copied into a third of all rows spreads out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _spark as S

#: Fixed patterns of the base kinds, in the order of the kinds; minimal code points of
#: the value (group 2 of assign, else the match).
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
BASE = {"assign": 12, "access": 18, "hex": 16}
KINDS = (*BASE, "mixed")
MIXED_LEN = 20
#: Whole runs of token characters; every access, hex and mixed span lies in one of 16+.
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"
HEX_RUN = r"(?<![0-9a-f])[0-9a-f]{16,}+"

#: Elements that one step of a running value copies; see ``_before``.
BLOCK = 256


def _bound(x: Column, f) -> Column:
    """``f`` of a variable that holds ``x``, so that x is computed once."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def _before(x: Column, op) -> Column:
    """What ``op`` (sum or greatest, from 0) makes of the elements before each one of an
    array of ints. Within blocks, and then over the blocks' totals: appending to an array
    copies it, so one run over a long array would take the square of its length."""

    def running(values: Column, first: Column) -> Column:
        step = lambda s, v: F.struct(op(s["acc"], v).alias("acc"), F.concat(s["out"], F.array(s["acc"])).alias("out"))
        return F.aggregate(values, F.struct(first.alias("acc"), F.array().cast("array<int>").alias("out")), step, lambda s: s["out"])

    def over(values: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")), lambda k: F.slice(values, k * BLOCK + 1, BLOCK))
        total = lambda b: F.aggregate(b, F.lit(0), op)
        return _bound(blocks, lambda bs: F.flatten(F.zip_with(bs, running(F.transform(bs, total), F.lit(0)), running)))

    return _bound(x, lambda values: F.when(F.size(values) > 0, over(values)).otherwise(F.array().cast("array<int>")))


def _spans(text: Column, kind: str, pattern: str, guard: Column) -> Column:
    """Spans of the matches of ``pattern``: the text splits into the pieces around them,
    whose lengths add up to the offsets. One-element arrays bind the matches and pieces
    to variables, so a text is scanned once, and split only if something matched."""
    none = F.array().cast("array<struct<kind:int,start:int,end:int,value:string>>")

    def summed(found: Column, pieces: Column) -> Column:
        def span(at):
            def one(value, i):
                start = F.get(at, i) + F.length(F.get(pieces, i))
                return F.struct(F.lit(KINDS.index(kind)).alias("kind"), start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"))

            return F.transform(found, one)

        return _bound(_before(F.transform(found, lambda value, i: F.length(F.get(pieces, i)) + F.length(value)), lambda x, y: x + y), span)

    split = lambda found: _bound(F.split(text, pattern, -1), lambda pieces: summed(found, pieces))
    some = lambda found: F.when(F.size(found) > 0, split(found)).otherwise(none)
    return F.when(guard, _bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), some)).otherwise(none)


def _free(spans: Column) -> Column:
    """Sorted spans without the ``mixed`` ones that touch a base span: one before that
    ends later than they start, or the next one (mixed spans never meet each other)."""
    mixed = KINDS.index("mixed")
    ends = F.transform(spans, lambda s: F.when(s["kind"] < mixed, s["end"]).otherwise(0))

    def kept(reach):
        def free(s, i):
            later = F.get(spans, i + 1)
            touched = (F.get(reach, i) > s["start"]) | F.coalesce((later["kind"] < mixed) & (later["start"] < s["end"]), F.lit(False))
            return (s["kind"] < mixed) | ~touched

        return F.filter(spans, free)

    return _bound(_before(ends, lambda x, y: F.greatest(x, y)), kept)


def find_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``spans``: kind, start, end (code points, end exclusive), value, by
    start, then kind. ``mixed`` spans that touch a base span are left out."""
    df = docs.withColumn("text", F.coalesce(F.col(text_col), F.lit("")))
    t = F.col("text")
    value = lambda s: s["value"]
    secret = F.transform(_spans(t, "assign", ASSIGN, t.contains(":") | t.contains("=")), lambda s: s.withField("value", F.regexp_extract(s["value"], ASSIGN, 2)))
    secret = F.filter(secret, lambda s: F.length(value(s)) >= BASE["assign"])
    # The other kinds lie in long runs of token characters: without one, nothing more is scanned.
    run = t.rlike(RUN)
    access = F.filter(_spans(t, "access", ACCESS, t.contains("AKIA")), lambda s: F.length(value(s)) >= BASE["access"])
    tokens = F.filter(_spans(t, "mixed", RUN, run), lambda s: (F.length(value(s)) >= MIXED_LEN) & value(s).rlike("[0-9]") & value(s).rlike("[a-z]") & value(s).rlike("[A-Z]"))
    found = F.concat(secret, access, _spans(t, "hex", HEX_RUN, run), tokens)
    by_place = lambda x, y: F.when(x["start"] != y["start"], x["start"] - y["start"]).otherwise(x["kind"] - y["kind"])
    return df.withColumn("spans", _bound(F.array_sort(found, by_place), lambda spans: F.when(F.size(spans) > 0, _free(spans)).otherwise(spans)))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id", copied_owners: int = 3) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, th, spans`` with spans an array of
    (kind, start, end, hash, owners, repos, owned), by start, then kind.

    th is ``xxhash64(text)``. A null text is empty and has no spans; a null owner or
    repository counts as one more owner or repository. Repeated rows give repeated
    results and count as one repository.
    """
    S.text_batches(docs.sparkSession)
    cols = [F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(owner_col).alias("owner"), F.col(repo_col).alias("repo"), F.col(text_col).alias("text")]
    found = find_spans(docs.select(*cols)).withColumn("spans", F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.sha2(s["value"], 256).alias("hash"))))
    found, _ = S.stored(found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "th", "owner", "repo", "spans"), "secrets")
    each = found.where(F.size("spans") > 0).select("row", "doc_id", "th", "owner", "repo", F.explode("spans").alias("s")).select("row", "doc_id", "th", "owner", "repo", "s.*")
    by_owner = each.groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one")).groupBy("hash", "owner").agg(F.count("*").alias("repos"))
    held = by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"))
    span = F.struct("start", "kind", "end", "hash", "owners", "repos", (F.col("owners") < copied_owners).alias("owned"))
    judged = each.join(held, "hash").groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("th").alias("th"), F.array_sort(F.collect_list(span)).alias("spans"))
    kinds = F.array(*map(F.lit, KINDS))
    named = F.transform("spans", lambda s: F.struct(F.element_at(kinds, s["kind"] + 1).alias("kind"), *(s[c].alias(c) for c in ("start", "end", "hash", "owners", "repos", "owned"))))
    judged = judged.withColumn("spans", F.filter(named, lambda s: (s["kind"] != "mixed") | s["owned"])).drop("row")
    none = found.where(F.size("spans") == 0).select("doc_id", "th", F.array().cast(judged.schema["spans"].dataType).alias("spans"))
    return judged.unionByName(none)


def masked(text: str, spans: str, mark: str) -> Column:
    """The text with every span of the array column replaced by ``mark``; spans that
    overlap become one. Spans go in blocks, each with its own part of the text: finding a
    place in a text walks there from its start."""
    ends = F.transform(spans, lambda s: s["end"])
    last = F.array_max(ends)

    def joined(reach):
        def block(k):
            first = k * BLOCK
            base = F.get(reach, first)

            def pieces(part):
                def piece(i):
                    start, before = F.get(F.col(spans), i)["start"], F.get(reach, i)
                    return F.when(start >= before, F.concat(F.substring(part, before - base + 1, start - before), F.lit(mark))).otherwise("")

                return F.array_join(F.transform(F.sequence(first, F.least(first + BLOCK, F.size(spans)) - 1), piece), "")

            return _bound(F.substring(text, base + 1, F.coalesce(F.get(reach, first + BLOCK), last) - base), pieces)

        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / BLOCK).cast("int")), block)
        return F.concat(F.array_join(blocks, ""), F.substring(text, last + 1, F.length(text)))

    return F.when(F.size(spans) > 0, _bound(_before(ends, lambda x, y: F.greatest(x, y)), joined)).otherwise(F.col(text))
