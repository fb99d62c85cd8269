"""Size-partitioned MinHash containment search for benchmark items inside documents,
in DataFrame functions only.

An item is the set of its distinct ``width``-word shingles; it leaks into a document
that holds ``num / den`` of them or more. A document's own MinHash is of no use here:
the Jaccard similarity of a short item and a long document is near zero whatever the
item's share. So only items are sketched. They are partitioned by size (powers of two);
an item of n shingles may miss ``n - ceil(num * n / den)`` of them, so its sketch is that
many plus one of its smallest hashes: a document with enough of the item must hold one
of the sketch, and no leak is lost. Documents shorter than an item's partition requires
are skipped for it. Every candidate is then verified by exact shingle containment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _spark as S

#: White space between words, as in a Java pattern and as characters to trim.
SPACE, SPACES = r"[\x20\x09-\x0D]+", " \t\n\x0b\f\r"
#: Rows of an item sketch (about 50 bytes each) or of candidates up to which a side is broadcast.
BROADCAST_ROWS = 500_000


def with_shingles(df: DataFrame, text_col: str, width: int) -> DataFrame:
    """``df`` with ``shingles``: the 64-bit hashes of its word shingles in order
    (lower case); fewer words than ``width``: the whole sequence as one; none: empty."""
    words = F.split(F.btrim(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(SPACES)), SPACE)
    hashed = F.filter(F.transform(words, lambda w: F.when(w != "", F.xxhash64(w))), lambda h: h.isNotNull())
    # The one-element array binds the word hashes to a variable: evaluated once per row.
    bound = F.transform(F.array(hashed), lambda w: _of_words(w, width))
    return df.withColumn("shingles", F.element_at(bound, 1))


def _of_words(w, width: int):
    at = lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(width)))
    full = F.transform(F.sequence(F.lit(0), F.size(w) - width), at)
    none = F.array().cast("array<bigint>")
    return F.when(F.size(w) >= width, full).otherwise(F.when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(none))


def sketched(items: DataFrame, id_col: str, text_col: str, width: int, num: int, den: int) -> DataFrame:
    """``item_id, item (sorted distinct shingles), n_item, band, need, sketch``."""
    df = with_shingles(items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")), "text", width)
    df = df.withColumn("item", F.array_sort(F.array_distinct("shingles"))).drop("text", "shingles")
    df = df.withColumn("n_item", F.size("item")).where("n_item > 0")
    df = df.withColumn("band", F.floor(F.log2("n_item")).cast("int")).withColumn("need", F.expr(f"cast(ceil({num} * n_item / {den}) as int)"))
    return df.withColumn("sketch", F.expr("slice(item, 1, n_item - need + 1)"))


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", width: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """``doc_id, th, item_id, n_item, n_common`` for every document (named by doc_id and
    th = ``xxhash64(text)``) and item of which it holds ``num/den`` or more.

    Null or blank texts and items leak nothing. Repeated documents or items give their
    pair once. An item of fewer than ``width`` words matches documents that are just
    those words. A null id is an id like any other.
    """
    S.text_batches(docs.sparkSession)
    sketches, _ = S.stored(sketched(items, item_id_col, item_text_col, width, num, den).distinct(), "items")
    keys = sketches.select("item_id", "band", "n_item", F.explode("sketch").alias("h"))
    small = lambda df: F.broadcast(df) if df.count() <= BROADCAST_ROWS else df
    # One row per (hash, band): many items may share a hash, a document meets it once.
    probe = keys.select("h", "band").distinct()

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("th", F.xxhash64("text"))
    own = with_shingles(texts, "text", width).select("doc_id", "th", F.size("shingles").alias("n_doc"), F.explode("shingles").alias("h"))
    # A band's smallest item has 2**band shingles, of which num/den must be there.
    fits = F.expr(f"n_doc >= ceil({num} * shiftleft(1L, band) / {den})")
    met = own.join(small(probe), "h").where(fits).select("doc_id", "th", "h", "band").distinct()
    near = met.join(small(keys), ["h", "band"]).select("doc_id", "th", "item_id", "n_item").distinct()
    near, _ = S.stored(near, "leak-candidates")
    pick = near.select("doc_id", "th").distinct().withColumn("_doc", F.col("doc_id"))
    chosen = texts.alias("t").join(small(pick).alias("p"), F.expr("t.doc_id <=> p._doc AND t.th = p.th"), "left_semi").dropDuplicates(["doc_id", "th"])
    exact = with_shingles(chosen, "text", width).select("doc_id", "th", "shingles")
    item = sketches.select(F.col("item_id").alias("_item"), F.col("n_item").alias("_n"), "item", "need")
    pairs = near.alias("c").join(exact.alias("e"), F.expr("c.doc_id <=> e.doc_id AND c.th = e.th")).select("c.doc_id", "c.th", "item_id", "n_item", "shingles")
    pairs = pairs.join(item, F.expr("item_id <=> _item AND n_item = _n"))
    pairs = pairs.withColumn("n_common", F.size(F.array_intersect("item", "shingles"))).where("n_common >= need")
    return pairs.select("doc_id", "th", "item_id", "n_item", "n_common").distinct()
