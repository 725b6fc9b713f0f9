"""SimHash near-duplicates by deletion-variant signatures.

Fingerprint: the words of the lower-cased text (A-Z only) form ``shingle``-word
shingles (repeats included, joined by one space; fewer words: the whole sequence); each
is hashed with XXH64 (seed 42); a bit is 1 when more than half of the hashes have it.
A text without words has fingerprint 0, linked like any other.

Search: two fingerprints that differ in at most ``max_bits`` of 64 bits are cut into
``max_bits // 2 + 1`` segments, so some segment differs in at most one bit (fewer
segments than the usual ``max_bits + 1``). Every fingerprint is indexed under its
one-wildcard variants: for each bit position, the position and the segment that holds it
without that bit. Segments that differ in at most one bit share a variant, so an
equality grouping on the variant meets every pair to verify.

* Only distinct fingerprints are indexed; any number of copies is one entry.
* Within a variant's bucket the exact distance is verified. Small buckets compare all
  their entries; larger ones grow components breadth first, dropping an entry once it is
  linked, so a bucket yields fewer links than entries (connectivity is kept, not all pairs).
* Every variant row is dealt, whether its bucket is shared or not: the rows are 64 per distinct
  fingerprint at any size (by chance, shared buckets alone would grow with the square of the entries).
* A bucket with more than ``block`` entries is dealt as pairs of blocks to separate tasks.
* Components of the links come from star contraction joins (``common.components``).

Defined results: null text is the empty text; a null id never becomes a class id unless all
ids of the class are null; repeated rows share a class; an empty table gives an empty
result; other columns of the input are not read (``deduplicate`` keeps them).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, components, cut, fresh, text_of

SHINGLE, MAX_BITS, SEED = 4, 4, 42  # fixed values of the contract
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_SMALL = 8


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text (unsigned)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends - 1)[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, stops)), dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 65536):  # bounded memory for very long texts
        bits = np.unpackbits(h[at:at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)``, one row per input row; ``fp`` is the fingerprint as a signed long."""
    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            out = np.fromiter((fingerprint(t, shingle) for t in s), dtype=np.uint64, count=len(s))
            yield pd.Series(out.view(np.int64))

    return docs.select(col(id_col).alias("doc_id"), fp(text_of(text_col)).alias("fp"))


def segments(max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """``(lowest bit, width)`` of each segment: ``max_bits // 2 + 1`` of them over 64 bits."""
    n = max_bits // 2 + 1
    edges = [round(64 * i / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def variants(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(bit, rest, fp)``: a row per wildcard position; ``rest`` is the position's segment without that bit."""
    keys = []
    for low, width in segments(max_bits):
        mask = (1 << width) - 1 << low
        for bit in range(low, low + width):
            m = mask & ~(1 << bit)
            m = m - (1 << 64) if m >> 63 else m  # signed long literal
            keys.append(F.struct(F.lit(bit).cast("byte").alias("bit"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("rest")))
    return fps.select("fp", F.inline(F.array(*keys)))


def _close(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    return np.bitwise_count(np.bitwise_xor(a, b)) <= max_bits


def bucket_links(fp: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect the entries of one bucket exactly as all its verified pairs would."""
    out = []
    left = fp
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            hit = _close(left, x, max_bits)
            if hit.any():
                got = left[hit]
                out.append((np.full(len(got), x), got))
                todo.extend(got.tolist())
                left = left[~hit]
    return out


def _links(keys: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of whole buckets: ``keys`` are bucket numbers, ascending, of the entries ``fp``."""
    a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    cuts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.append(cuts, len(keys)))
    small = np.repeat(sizes <= _SMALL, sizes)
    for lag in range(1, min(_SMALL, len(fp))):
        ok = small[lag:] & (keys[lag:] == keys[:-lag])
        ok[ok] = _close(fp[lag:][ok], fp[:-lag][ok], max_bits)
        a.append(fp[:-lag][ok])
        b.append(fp[lag:][ok])
    for at, n in zip(cuts[sizes > _SMALL].tolist(), sizes[sizes > _SMALL].tolist()):
        for x, y in bucket_links(fp[at:at + n], max_bits):
            a.append(x.astype(np.uint64))
            b.append(y)
    return np.concatenate(a), np.concatenate(b)


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = 4096) -> DataFrame:
    """``(a, b)``: verified links between distinct fingerprints, enough to connect every linked pair."""
    # few tasks read the fingerprints back; dealt anew, so that many make the 64 variants of each
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = variants(fps.repartition(tasks, "fp"), max_bits)
    # a bucket beyond ``block`` is cut in parts; each unordered pair of parts is one task's bucket
    large = (index.groupBy("bit", "rest").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
             .select("bit", "rest", F.ceil(F.col("n") / block).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    mine = F.pmod(F.xxhash64("fp"), parts).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), parts - 1), lambda o: F.struct(
        F.least(o, mine).alias("i"), F.greatest(o, mine).alias("j")))
    dealt = index.join(large, ["bit", "rest"], "left").select("bit", "rest", "fp", F.inline(pairs))
    # the bucket number is only a grouping: entries that meet by chance fail the verification
    dealt = dealt.select("fp", F.xxhash64("bit", "rest", "i", "j").alias("bucket"))
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket", "fp")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        for pdf in batches:
            keys = np.concatenate((keys, pdf["bucket"].to_numpy(np.int64)))
            fp = np.concatenate((fp, pdf["fp"].to_numpy(np.int64).view(np.uint64)))
            whole = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last bucket may go on
            if whole:
                a, b = _links(keys[:whole], fp[:whole], max_bits)
                yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})
                keys, fp = keys[whole:], fp[whole:]
        if len(keys):
            a, b = _links(keys, fp, max_bits)
            yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return dealt.mapInPandas(verify, "a long, b long").distinct()


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
            max_bits: int = MAX_BITS, block: int = 4096) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row: the smallest id reachable over links."""
    marked = cut(fingerprints(docs, id_col, text_col, shingle))
    fps = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("low")))
    comp = components(links(fps.select("fp"), max_bits, block))
    # fingerprints without links are their own class
    rooted = fps.join(comp, fps["fp"] == comp["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    per_fp = rooted.join(lows, "root").select("fp", "component_id")
    return marked.join(per_fp, "fp").select("doc_id", "fp", "component_id")


def hex_of(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each class: the smallest id (nulls last), then the smallest text hash.

    Rows that repeat in id and text are reduced to one. The kept rows are found on ids and
    hashes; only the final join reads the texts again.
    """
    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(np.fromiter((fingerprint(t, shingle) for t in s), dtype=np.uint64, count=len(s)).view(np.int64))

    row_hash = F.xxhash64(*[col(c) for c in docs.columns if docs.schema[c].dataType.simpleString()[:3] != "map"])
    marked = cut(docs.select(col(id_col).alias("doc_id"), row_hash.alias("h"), fp(text_of(text_col)).alias("fp")))
    fps = cut(marked.select("fp").distinct())
    comp = components(links(fps, max_bits))
    rooted = marked.join(comp, marked["fp"] == comp["node"], "left").withColumn("root", F.coalesce("root", "fp"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h"))
    keep = rooted.groupBy("root").agg(first.alias("k")).select(F.col("k.doc_id").alias("doc_id"), F.col("k.h").alias("h"))
    copies = marked.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("n"))
    same = (F.col("k.doc_id").eqNullSafe(F.col("c.doc_id"))) & (F.col("k.h") == F.col("c.h"))
    keep = cut(keep.alias("k").join(copies.alias("c"), same).select("k.doc_id", "k.h", "n"))
    kid, kh, n = fresh(docs, "kept_id"), fresh(docs, "kept_hash"), fresh(docs, "kept_n")
    keep = keep.select(F.col("doc_id").alias(kid), F.col("h").alias(kh), F.col("n").alias(n))
    hashed = docs.withColumn(fresh(keep, kh + "_row"), row_hash)
    rows = hashed.join(keep, (col(fresh(keep, kh + "_row")) == F.col(kh)) & col(id_col).eqNullSafe(F.col(kid)))
    plain = [col(c) for c in docs.columns]
    # identical rows are rare: only they take the extra shuffle
    return rows.where(F.col(n) == 1).select(*plain).unionByName(
        rows.where(F.col(n) > 1).dropDuplicates([kid, kh]).select(*plain))
