"""Document fingerprints: bottom-k sketches of shingle hashes, with DataFrame functions alone.

A sketch is the k smallest distinct 64-bit hashes of a text's five-word shingles (A-Z lower-cased words between white
space; a shorter text is one shingle of all its words), in ascending order.  Sketches of parts merge into the sketch of
the whole set; two sketches estimate resemblance and containment, one the number of distinct shingles.

Defined cases: null and empty texts have the empty sketch, alike only to another empty one; equal texts have equal
sketches; hash values that would be sorted in vain are cut off first, and a text with so many repeated shingles that
this cut left too few is sorted whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 128
WORDS = 5
NO_ID = -(1 << 63)
#: Documents of one window, about, and most windows.
DEAL, MOST_DEALS = 4000, 10_000
_WHITE = r"[\x20\x09-\x0D]+"
_RANGE = 18446744073709551616.0


def _let(value: Column, f) -> Column:
    """f of a value that is computed once, however often f uses it and wherever the optimizer moves the expression."""
    return F.element_at(F.transform(F.array(value), f), 1)


def sketch(text: Column, k: int = K, words: int = WORDS) -> Column:
    """The sketch of a text, an array of longs."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    parts = F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), upper, lower), _WHITE), lambda x: x != "")

    def shingles(w: Column) -> Column:
        several = F.transform(F.sequence(F.lit(1), F.size(w) - (words - 1)), lambda i: F.xxhash64(F.slice(w, i, words)))
        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).when(F.size(w) <= words, F.array(F.xxhash64(w))).otherwise(several)

    def least(h: Column) -> Column:
        # about 4 k hashes lie below the cut
        cut = (F.lit(-_RANGE / 2) + F.lit(_RANGE) * F.lit(4.0 * k) / F.size(h)).cast("long")
        small = F.when(F.size(h) <= 4 * k, F.array_distinct(h)).otherwise(_let(cut, lambda c: F.array_distinct(F.filter(h, lambda x: x <= c))))
        return _let(small, lambda s: F.slice(F.sort_array(F.when((F.size(s) >= k) | (F.size(h) <= 4 * k), s).otherwise(F.array_distinct(h))), 1, k))

    return _let(F.transform(parts, lambda x: F.xxhash64(x)), lambda w: _let(shingles(w), least))


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity; two empty sketches: 1."""
    union = merge(a, b, k)
    return F.when(F.size(union) == 0, 1.0).otherwise(F.size(F.array_intersect(F.array_intersect(a, b), union)) / F.size(union))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(a, -1).cast("double") + F.lit(_RANGE / 2)) / F.lit(_RANGE)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has; an empty a: 1."""
    share = resemblance(a, b, k) * distinct_count(merge(a, b, k), k) / distinct_count(a, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), share))


def as_text(a: Column) -> Column:
    """16 hexadecimal digits a hash."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def from_text(a: Column) -> Column:
    parts = F.regexp_extract_all(a, F.lit("([0-9a-f]{16})"), 1)
    # conv gives unsigned digits; halves keep the sign
    return F.transform(parts, lambda x: F.shiftleft(F.conv(F.substring(x, 1, 8), 16, 10).cast("long"), 32).bitwiseOR(F.conv(F.substring(x, 9, 8), 16, 10).cast("long")))


def _place(splits: list[int], value: Column) -> Column:
    """How many of the ascending splits are below the value, in two steps of about the square root."""
    if not splits:
        return F.lit(0)
    step = math.isqrt(len(splits)) + 1
    blocks = [splits[i : i + step] for i in range(0, len(splits), step)]
    below = lambda xs: F.size(F.filter(xs, lambda x: x < value))
    long = lambda xs: F.array(*(F.lit(x).cast("long") for x in xs))
    block = below(long([b[0] for b in blocks]))  # the last block whose first split is below the value
    inner = F.element_at(F.array(*(long(b) for b in blocks)), F.greatest(block, F.lit(1)))
    return F.when(block == 0, 0).otherwise((block - 1) * step + below(inner))


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", deal: int = DEAL) -> tuple[DataFrame, Window]:
    """Rows ``id, doc_id, text, deal, copy`` for windows in document order that see each row's next document, and that window.

    The ids are dealt out in ranges by approximate quantiles; each range also gets a copy of the first document of the
    next one (``copy`` true; after the last: of the first), which sorts behind it.  Only id quantiles and the ranges'
    first ids (at most ``MOST_DEALS``) are gathered.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"))
    n = min(MOST_DEALS, math.ceil(docs.count() / deal))
    splits = []
    if n > 1:
        got = rows.agg(F.percentile_approx("id", [i / n for i in range(1, n)], 10 * n)).first()[0]
        splits = sorted(set(got or []))
    rows = rows.withColumn("order", F.xxhash64("text")).withColumn("deal", _place(splits, F.col("id")))
    firsts = rows.groupBy("deal").agg(F.min(F.struct("id", "order")).alias("first"))
    by_deal = Window.orderBy("deal")  # at most MOST_DEALS rows
    firsts = firsts.select("first.*", F.coalesce(F.lag("deal").over(by_deal), F.max("deal").over(by_deal.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("before"))
    copies = rows.drop("deal").join(F.broadcast(firsts), ["id", "order"]).select("doc_id", "text", "id", "order", F.col("before").alias("deal"), F.lit(True).alias("copy"))
    both = rows.withColumn("copy", F.lit(False)).unionByName(copies)
    return both, Window.partitionBy("deal").orderBy("copy", "id", "order")


def edited_likeness(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, deal: int = DEAL) -> DataFrame:
    """Fingerprints of every text and of its edited text: the last half replaced by as many code points of the next document's beginning.

    Columns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.  Of equal ids
    the text's hash decides the order; a null id comes first; null text is empty; a lone document is its own next.
    """
    rows, order = with_next(docs.withColumn(text, F.coalesce(F.col(text), F.lit(""))), doc_id, text, deal)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("next", F.lead("text").over(order))
    rows = rows.withColumn("edited", F.concat(F.col("text").substr(F.lit(1), n - half), F.coalesce(F.col("next"), F.lit("")).substr(F.lit(1), half))).drop("next")
    rows = rows.withColumn("own", sketch(F.col("text"), k))
    rows = rows.withColumn("following", F.lead("own").over(order)).where(~F.col("copy"))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "edited", "own", "following")
    rows = rows.withColumn("changed", sketch(F.col("edited"), k))
    return rows.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"), as_text(F.col("changed")).alias("edited_fingerprint"), resemblance(F.col("own"), F.col("changed"), k).alias("near_edited"), resemblance(F.col("own"), F.col("following"), k).alias("near_next"))
