"""Document fingerprints as threshold-scaled sketches (DataFrame functions only).

A text's shingles are runs of ``shingle`` words (fewer words: the whole sequence). A sketch
keeps every distinct shingle hash (XXH64 folded to 63 bits) below ``fraction`` of the hash
range, whatever the document's length, so sketches of unequal documents sample the same
shingles: the share of one sketch found in another estimates containment, and the sketch of a
union is the union of the sketches. The smallest hash is kept even above the threshold, so no
text with words has an empty sketch (``merge`` drops such a hash when it is not the smallest any
more).

``with_next`` puts each document beside its successor in id order without a single-task window:
ids are cut into ranges (quantiles of the ids, each split evenly), the first document of every
range is also sent to the range before it, and the window runs inside the ranges. Texts are
shuffled once.

Defined results: null text is the empty text, whose sketch is empty; two empty sketches are alike
(1.0), an empty and a non-empty one are not (0.0); null ids come first; rows that share an id follow
each other in order of their text hash; a single row is its own successor; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import col, cut, dense_index, stored, text_of, words_of

SHINGLE, FRACTION = 5, 0.25
TOP = (1 << 63) - 1


def with_sketch(df: DataFrame, text_col: str, out: str, shingle: int = SHINGLE, fraction: float = FRACTION) -> DataFrame:
    """``df`` plus ``out``: the sorted array of kept hashes of ``text_col`` (never null)."""
    ws, hs = f"__w_{out}", f"__h_{out}"
    n = F.size(ws)
    hashed = F.transform(
        F.sequence(F.lit(0), F.greatest(n - shingle, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(shingle)]).bitwiseAND(F.lit(TOP)))
    low = F.filter(hs, lambda h: h < F.lit(int(fraction * TOP)))
    kept = F.array_sort(F.array_distinct(F.when(F.size(low) > 0, low).otherwise(F.array(F.array_min(hs)))))
    none = F.array().cast("array<bigint>")
    return (df.withColumn(ws, words_of(F.col(text_col)))
            .withColumn(hs, F.when(n > 0, hashed).otherwise(none))  # missing words at the end hash as absent
            .withColumn(out, F.when(F.size(hs) > 0, kept).otherwise(none)).drop(ws, hs))


def alike(a: Column, b: Column) -> Column:
    """Containment of the smaller sketch in the larger one, 0 to 1."""
    small = F.least(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b)).cast("double")
    return F.when(F.greatest(F.size(a), F.size(b)) == 0, 1.0).when(small == 0, 0.0).otherwise(both / small)


def contained(a: Column, b: Column) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def merge(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of both texts' shingles together."""
    u = F.array_sort(F.array_union(a, b))
    low = F.filter(u, lambda h: h < F.lit(int(fraction * TOP)))
    return F.when(F.size(low) > 0, low).otherwise(F.slice(u, 1, 1))


def encode(sketch: Column) -> Column:
    """A sketch as text: 16 lowercase hex digits per hash, ascending."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def decode(text: Column) -> Column:
    """The sketch of an encoded fingerprint."""
    one = F.sequence(F.lit(0), F.floor(F.length(text) / 16).cast("int") - 1)
    digits = F.transform(one, lambda i: F.conv(F.substring(text, (i * 16 + 1).cast("int"), F.lit(16)), 16, 10).cast("long"))
    return F.when(F.length(text) > 0, digits).otherwise(F.array().cast("array<bigint>"))


def id_range(ids: DataFrame, rows_per_range: int, cuts: int = 64) -> Column:
    """A non-decreasing range number of ``doc_id`` (null: -1): ``cuts`` quantile ranges, each split evenly by value."""
    r = ids.where(F.col("doc_id").isNotNull()).agg(
        F.count(F.lit(1)), F.percentile_approx("doc_id", [i / cuts for i in range(cuts + 1)], 10_000)).first()
    n, q = r[0], sorted(set(r[1] or [0]))
    each = max(1, -(-n // (rows_per_range * max(len(q) - 1, 1))))
    at = F.size(F.filter(F.array(*[F.lit(int(x)) for x in q]), lambda b: F.col("doc_id") >= b))  # at most cuts + 1 literals
    lows, highs = [q[0], *q], [q[0], *q[1:], q[-1]]
    span = [max(h - lo, 1) for lo, h in zip(lows, highs)]
    lo = F.element_at(F.array(*[F.lit(int(x)) for x in lows]), at + 1)
    width = F.element_at(F.array(*[F.lit(float(x)) for x in span]), at + 1)
    sub = F.least(F.greatest(F.floor((F.col("doc_id") - lo) * F.lit(float(each)) / width), F.lit(0)), F.lit(each - 1))
    return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(at.cast("long") * each + sub).cast("long")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_range: int = 1024) -> DataFrame:
    """``(doc_id, text, sketch, next_text, next_sketch)``: every row and its successor (the last row's is the first)."""
    base = docs.select(col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    number = id_range(base.select("doc_id"), rows_per_range)
    keyed = base.withColumn("rng", number).withColumn("tie", F.xxhash64("text"))
    key = F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "tie")  # nulls first
    firsts = dense_index(keyed.groupBy("rng").agg(F.min(key).alias("first")), [F.col("rng")], "k")
    firsts = cut(firsts)
    n = firsts.count()
    before = firsts.select(F.pmod(F.col("k") + 1, F.lit(max(n, 1))).alias("k"), F.col("rng").alias("prev"))
    # one row per range, written so that Spark knows its size and broadcasts it or not
    marks = stored(firsts.join(before, "k").select("rng", "first", "prev"), "ranges")
    marked = keyed.withColumn("key", key).join(marks, "rng")
    also = F.when(F.col("key") == F.col("first"), F.array(
        F.struct(F.col("rng").alias("to"), F.lit(0).alias("copy")), F.struct(F.col("prev").alias("to"), F.lit(1).alias("copy")))
    ).otherwise(F.array(F.struct(F.col("rng").alias("to"), F.lit(0).alias("copy"))))
    dealt = marked.select("key", "doc_id", "text", F.inline(also)).repartition("to")
    w = Window.partitionBy("to").orderBy("copy", "key")
    beside = with_sketch(dealt, "text", "sketch").select(
        "doc_id", "text", "sketch", "copy", F.lead(F.struct("text", "sketch")).over(w).alias("next"))
    return beside.where("copy = 0").select("doc_id", "text", "sketch", F.col("next.text").alias("next_text"),
                                           F.col("next.sketch").alias("next_sketch"))


def edited(text: Column, next_text: Column) -> Column:
    """``text`` with its last half replaced by as many code points from the start of ``next_text``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(next_text, F.lit(1), half))
