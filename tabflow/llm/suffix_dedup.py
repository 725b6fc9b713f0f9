"""Suffix-array dedup: remove every byte covered by a ``length``-byte string that starts earlier.

Texts are UTF-8 bytes; matches stay inside a document; earlier means a smaller id, or an earlier
start in the same document; strings are judged on the input.

Sharding. Equal strings must meet in one shard without sending every suffix anywhere. Each
``length``-byte window is owned by its smallest ``GRAM``-byte hash (leftmost of equals), which
depends on the window's bytes alone, so equal windows have equal owners. Consecutive windows with
the same owner form a *stretch* of on average about 40 windows (140 bytes); a stretch is the unit that
moves. Three steps thin the stretches out exactly:

* an owner hash that only one stretch has cannot hold a repeat: dropped by a count and a join (hot owners are dealt
  by content there, so a line that a third of all documents hold is no single task);
* byte-identical stretches are one group: the first stays, every other one is covered whole;
* of the rest, only firsts whose owner has several different stretches go to a shard.

Shards. A task takes whole owner groups up to about ``shard_bytes``, concatenates their stretches,
builds the suffix array by induced sorting, and reads the repeats off the permuted common
prefixes: neighbours sharing ``length`` bytes form a run, whose earliest start stays. An owner with more
than ``block`` different stretches (a passage that a large share of documents quote; ``block`` of them are
about 5 MB of text, what a task's memory takes) is dealt over several shards; the earliest start of each of its runs is then compared across shards by the
window's hash.

Removed bytes are grouped per document (its own length bounds them) and joined to its text.

Defined results: null text is empty; a text shorter than ``length`` bytes is kept; repeated
rows (same id and text) are one document and lose the same bytes; one id with different texts counts
as several documents in order of their text hash; a null id comes first; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import col, dense_index, stored, text_of
from .suffix_array import common_prefixes, suffix_array

LENGTH, GRAM = 100, 16
HOT, DEAL = 4096, 64  # an owner of more than 1/HOT of the stretches is dealt to DEAL parts
SEGMENT = 1 << 17  # bytes hashed at a time: the working arrays stay in cache
_POS = np.uint64(21)  # low bits of a window key that hold the position in a segment
_NO_ID = -(1 << 63)
_BITS = 20  # low bits of a packed span that hold its length
_U = np.uint64


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * _U(2) + _U(1)


_BASE = int(_odd(7, 1)[0])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(29))


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


class _Hasher:
    """Substring hashes modulo 2^64 over one segment at a time (tables are built once per task)."""

    def __init__(self, n: int):
        self.table = _odd(11, 256)
        self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)

    def prefix(self, flat: np.ndarray) -> np.ndarray:
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.table[flat] * self.up[:len(flat)], dtype=np.uint64)))

    def of(self, prefix: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return _mix((prefix[b] - prefix[a]) * self.down[a])


def _slide(op, a: np.ndarray, width: int) -> np.ndarray:
    """``op`` over every ``width`` consecutive entries, by doubling."""
    n, m = 1, a
    while 2 * n <= width:
        m, n = op(m[:-n], m[n:]), 2 * n
    return op(m[:-(width - n)], m[width - n:]) if n < width else m


def _grams(flat: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` (16) bytes from each position."""
    w = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(flat, 8)).view("<u8").ravel()
    return _mix(w[:-8] * _U(0x9E3779B97F4A7C15) ^ _mix(w[8:]))


def stretches(texts: list[bytes], hasher: _Hasher | None, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """``(text number, first window, n bytes, owner hash, content hash)`` of every stretch of the texts
    (content hash 0 without a ``hasher``).

    A text beyond a segment is cut by windows; a stretch cut there is two stretches, which the shards
    treat like any other different stretches.
    """
    pieces, size, out = [], 0, []

    def flush():
        if not pieces:
            return
        flat = np.frombuffer(b"".join(p[2] for p in pieces) + b"\0" * 16, np.uint8)
        lens = np.array([len(p[2]) for p in pieces])
        ends = np.cumsum(lens)
        starts = ends - lens
        piece = np.repeat(np.arange(len(pieces)), lens)
        h = _grams(flat)
        key = (h >> _POS << _POS) | np.arange(len(h), dtype=np.uint64)
        low = _slide(np.minimum, key, length - GRAM + 1)
        p = np.flatnonzero(np.arange(len(piece)) + length <= ends[piece])  # windows inside their piece
        q = (low[p] & ((_U(1) << _POS) - _U(1))).astype(np.int64)
        new = np.concatenate(([True], (q[1:] != q[:-1]) | (p[1:] != p[:-1] + 1)))
        first = p[new]
        last = p[np.append(np.flatnonzero(new)[1:] - 1, len(p) - 1)]
        owner = q[new]
        stop = last + length
        content = np.zeros(len(first), dtype=np.uint64)
        if hasher is not None:
            shape = ((owner - first) << 32 | (stop - first)).astype(np.uint64)
            content = _mix(hasher.of(hasher.prefix(flat), first, stop) + _mix(shape))
        no = piece[first]
        offset = np.array([x[1] for x in pieces])
        doc = np.array([x[0] for x in pieces])
        out.append((doc[no], offset[no] + first - starts[no], stop - first, h[owner], content))

    for i, t in enumerate(texts):
        if len(t) < length:
            continue
        step = SEGMENT - length
        for at in range(0, len(t) - length + 1, step):
            part = t[at:at + step + length - 1]
            if size + len(part) > SEGMENT:
                flush()
                pieces, size = [], 0
            pieces.append((i, at, part))
            size += len(part)
    flush()
    if not out:
        z = np.empty(0, np.int64)
        return z, z, z, z.view(np.uint64), z.view(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _bytes(s: pd.Series) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in s]


def stretch_rows(base: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(h, c, doc, at, n, later)``: owner hash, content hash, place; ``later`` marks one that this batch holds earlier."""
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = _Hasher(SEGMENT + 64)
        for pdf in batches:
            no, at, n, h, c = stretches(_bytes(pdf["text"]), hasher, length)
            doc = pdf["doc"].to_numpy(np.int64)[no]
            order = np.lexsort((at, doc, c, h))
            h, c, doc, at, n = h[order], c[order], doc[order], at[order], n[order]
            same = np.zeros(len(h), dtype=bool)
            same[1:] = (h[1:] == h[:-1]) & (c[1:] == c[:-1])
            again = same.copy()  # a repeated row: the very same stretch
            again[1:] &= (doc[1:] == doc[:-1]) & (at[1:] == at[:-1])
            out = pd.DataFrame({"h": h.view(np.int64), "c": c.view(np.int64), "doc": doc, "at": at, "n": n, "later": same})
            yield out[~again]

    return base.select("doc", "text").mapInPandas(emit, "h long, c long, doc long, at long, n long, later boolean")


def owner_counts(base: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(h, k)``: how many stretches each owner hash has (counted per batch, then summed)."""
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            h, k = np.unique(stretches(_bytes(pdf["text"]), None, length)[3], return_counts=True)
            yield pd.DataFrame({"h": h.view(np.int64), "k": k})

    return base.select("text").mapInPandas(emit, "h long, k long").groupBy("h").agg(F.sum("k").alias("k"))


def thin(base: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(r, h, doc, at, n)``, stored: stretches whose owner repeats, ``r`` = 1 for the first of each content.

    Rows with ``r`` > 1 are covered whole; the very same place seen twice (repeated rows) has ``r`` 0.
    """
    owners = stored(owner_counts(base, length).where("k > 1"), "owners")
    # an owner with more than 1/HOT of these stretches is hot (there are fewer than HOT of them); its rows are dealt
    # by content, and it meets them once for every part of the deal
    total = owners.agg(F.sum("k")).first()[0] or 0
    hot = owners.where(F.col("k") > total / HOT).select("h", F.lit(True).alias("hot"))
    dealt = owners.select("h", F.explode(F.when(F.col("k") > total / HOT, F.sequence(F.lit(0), F.lit(DEAL - 1)))
                                         .otherwise(F.array(F.lit(0)))).alias("deal"))
    # each batch leaves one row of a content that is not ``later``, so a hot content is few rows here;
    # the ``later`` ones are settled and only need to be spread
    salt = F.when(F.col("later"), F.pmod(F.xxhash64("doc", "at"), F.lit(1 << 30)) + 1).otherwise(F.lit(0))
    part = F.when(F.col("hot"), F.pmod(F.xxhash64("c", "salt"), F.lit(DEAL)).cast("int")).otherwise(F.lit(0))
    rows = (stretch_rows(base, length).withColumn("salt", salt).join(F.broadcast(hot), "h", "left")
            .withColumn("deal", part).drop("hot"))
    shared = rows.join(dealt, ["h", "deal"])
    w = Window.partitionBy("h", "deal", "c", "salt").orderBy("doc", "at")
    first = (F.first("doc").over(w) == F.col("doc")) & (F.first("at").over(w) == F.col("at"))
    r = F.when(F.col("later"), 2).when(F.row_number().over(w) == 1, 1).when(first, 0).otherwise(2)
    return stored(shared.select(r.alias("r"), "h", "doc", "at", "n"), "stretches")


def shard_repeats(groups: np.ndarray, doc: np.ndarray, at: np.ndarray, parts: list[bytes], length: int = LENGTH,
                  want: np.ndarray | None = None):
    """Repeats inside one shard of stretches.

    Returns ``(doc, start, end)`` of the bytes covered by later windows, and, for stretches with ``want`` set,
    ``(doc, start, window bytes)`` of the earliest window of every run.
    """
    size = np.array([len(p) for p in parts])
    # bytes + 1, a 255 between stretches (UTF-8 has no 254 or 255), a 0 at the end
    t = np.frombuffer(b"\xfe".join(parts) + b"\xff", np.uint8) + np.uint8(1)
    start = np.cumsum(size + 1) - size - 1
    sa = suffix_array(t, length)
    plcp = common_prefixes(t, sa, 2 * length, start)
    which = np.repeat(np.arange(len(parts), dtype=np.int32), size + 1)
    inside = np.arange(len(t), dtype=np.int32) - np.repeat(start.astype(np.int32), size + 1)
    whole = inside <= np.repeat((size - length).astype(np.int32), size + 1)  # a window starts here
    pos = sa[whole[sa]]
    del sa, whole
    run = np.cumsum(plcp[pos] < length, dtype=np.int32)
    del plcp
    # order of (doc, start) as one number: ranks of documents, then the place
    rank = np.unique(doc, return_inverse=True)[1].reshape(-1)
    place = rank[which[pos]].astype(np.int64) << 40 | (at[which[pos]] + inside[pos])
    heads = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
    low = np.minimum.reduceat(place, heads)
    first = place == np.repeat(low, np.diff(np.append(heads, len(pos))))
    later = np.zeros(len(t), dtype=bool)
    later[pos[~first]] = True
    edge = np.diff(np.concatenate(([0], later.astype(np.int8), [0])))
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)  # runs of later windows never leave a stretch
    covered = doc[which[a]], at[which[a]] + inside[a], at[which[a]] + inside[a] + (b - a) + length - 1
    firsts = []
    if want is not None and want.any():
        keep = pos[first]
        keep = keep[want[which[keep]]]
        raw = (t - np.uint8(1)).tobytes()
        firsts = [(int(doc[which[p]]), int(at[which[p]] + inside[p]), raw[p:p + length]) for p in keep.tolist()]
    return covered, firsts


def sharded(base: DataFrame, wanted: DataFrame, length: int = LENGTH, block: int = 32768,
            shard_bytes: int = 800_000) -> DataFrame:
    """``(doc, a, b, w1, w2)``: covered bytes (``w1`` null), and first windows of dealt owners with their hash."""
    # the stretches of a document, bounded by its length, travel to its text
    lists = wanted.groupBy("doc").agg(*[F.collect_list(c).alias(c) for c in ("h", "at", "n", "m")])
    texts = base.select("doc", "text").join(lists, "doc")

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = [b[a:a + n] for b, at, ns in zip(_bytes(pdf["text"]), pdf["at"], pdf["n"])
                     for a, n in zip(at.tolist(), ns.tolist())]
            h, m, at = (np.concatenate(pdf[c].tolist()) if len(pdf) else np.empty(0, np.int64) for c in ("h", "m", "at"))
            yield pd.DataFrame({"h": h, "m": m, "doc": np.repeat(pdf["doc"].to_numpy(), [len(x) for x in pdf["at"]]),
                                "at": at, "part": parts})

    got = texts.mapInPandas(fetch, "h long, m long, doc long, at long, part binary")
    deal = F.pmod(F.xxhash64("doc", "at"), F.ceil(F.col("m") / block)).cast("int")
    dealt = got.withColumn("deal", deal).repartition("h", "deal").sortWithinPartitions("h", "deal")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for pdf in batches:
            held.append(pdf)
            size += _sizes(pdf).sum()
            if size >= shard_bytes:
                whole = pd.concat(held, ignore_index=True)
                last = (whole["h"] == whole["h"].iat[-1]) & (whole["deal"] == whole["deal"].iat[-1])  # it may go on
                for part in _shards(whole[~last], shard_bytes):
                    yield _rows(part, block, length)
                held = [whole[last]]
                size = _sizes(held[0]).sum()
        if held:
            for part in _shards(pd.concat(held, ignore_index=True), shard_bytes):
                yield _rows(part, block, length)

    return dealt.mapInPandas(search, "doc long, a long, b long, w1 long, w2 long")


def _sizes(pdf: pd.DataFrame) -> np.ndarray:
    return np.fromiter(map(len, pdf["part"]), dtype=np.int64, count=len(pdf))


def _shards(pdf: pd.DataFrame, shard_bytes: int) -> Iterator[pd.DataFrame]:
    """Whole owner groups of about ``shard_bytes`` together."""
    if not len(pdf):
        return
    h, d = pdf["h"].to_numpy(), pdf["deal"].to_numpy()
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])))
    before = np.cumsum(_sizes(pdf)) // shard_bytes
    shard = np.maximum.accumulate(np.where(new, before, 0))
    for _, part in pdf.groupby(shard, sort=False):
        yield part


def _rows(pdf: pd.DataFrame, block: int, length: int) -> pd.DataFrame:
    doc, at = pdf["doc"].to_numpy(np.int64), pdf["at"].to_numpy(np.int64)
    want = pdf["m"].to_numpy(np.int64) > block
    (d, a, b), firsts = shard_repeats(pdf["h"].to_numpy(), doc, at, pdf["part"].tolist(), length, want)
    out = pd.DataFrame({"doc": d, "a": a, "b": b})
    out["w1"], out["w2"] = pd.array([None] * len(out), dtype="Int64"), pd.array([None] * len(out), dtype="Int64")
    if firsts:
        w = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x[2]) for x in firsts), ">i8").astype(np.int64).reshape(-1, 2)
        more = pd.DataFrame({"doc": [x[0] for x in firsts], "a": [x[1] for x in firsts],
                             "b": [x[1] + length for x in firsts], "w1": w[:, 0], "w2": w[:, 1]})
        out = pd.concat([out, more.astype({"w1": "Int64", "w2": "Int64"})], ignore_index=True)
    return out


def removed(base: DataFrame, length: int = LENGTH, block: int = 32768, shard_bytes: int = 800_000) -> DataFrame:
    """``(doc, spans array<long>)``: the byte ranges to remove (start and length packed), possibly overlapping."""
    kept = thin(base, length)
    firsts = kept.where("r = 1")
    # written first: a join side that is an aggregate on the join's own key would keep Spark from splitting a hot owner
    many = stored(firsts.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "owners-of-several")
    found = stored(sharded(base, firsts.join(many, "h"), length, block, shard_bytes), "shards")
    # owners dealt over several shards: the first windows of each shard meet by content
    dealt = found.where("w1 is not null")
    lows = dealt.groupBy("w1", "w2").agg(F.min(F.struct("doc", "a")).alias("f"), F.count(F.lit(1)).alias("k")).where("k > 1")
    across = dealt.join(lows, ["w1", "w2"]).where("doc <> f.doc or a <> f.a").select("doc", "a", "b")
    spans = (kept.where("r = 2").select("doc", F.col("at").alias("a"), (F.col("at") + F.col("n")).alias("b"))
             .unionByName(found.where("w1 is null").select("doc", "a", "b")).unionByName(across))
    packed = F.shiftleft("a", _BITS).bitwiseOR(F.col("b") - F.col("a"))  # no span is longer than a stretch
    return spans.groupBy("doc").agg(F.collect_list(packed).alias("spans"))


def without(data: bytes, spans) -> tuple[bytes, int, int]:
    """The bytes outside ``spans``, how many bytes went, and in how many maximal runs."""
    if spans is None or not len(spans):
        return data, 0, 0
    x = np.asarray(spans, dtype=np.int64)
    edge = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(edge, x >> _BITS, 1)
    np.add.at(edge, (x >> _BITS) + (x & ((1 << _BITS) - 1)), -1)
    gone = np.cumsum(edge)[:-1] > 0
    runs = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, doc, text)``: ``doc`` orders the documents and tells different texts apart.

    It is the id itself (null: the smallest number) unless an id comes with different texts; then all
    documents are numbered in order of (id, text hash).
    """
    base = docs.select(col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    base = base.withColumn("doc", F.coalesce("doc_id", F.lit(_NO_ID)))
    known = base.select("doc", F.xxhash64("text").alias("tie")).distinct()
    if known.groupBy("doc").count().where("count > 1").isEmpty():
        return base
    number = dense_index(known, [F.col("doc"), F.col("tie")], "number")
    return (base.withColumn("tie", F.xxhash64("text")).join(number, ["doc", "tie"])
            .select("doc_id", F.col("number").alias("doc"), "text"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                block: int = 32768, shard_bytes: int = 800_000) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)`` for every row; ``kept`` is binary (a cut may split a character)."""
    base = keyed(docs, id_col, text_col)
    rows = base.join(removed(base, length, block, shard_bytes), "doc", "left").select("doc_id", "text", "spans")

    def cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            data = _bytes(pdf["text"])
            got = [without(b, s) for b, s in zip(data, pdf["spans"])]
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "n_bytes": [len(b) for b in data],
                                "n_removed": [g[1] for g in got], "n_spans": [g[2] for g in got], "kept": [g[0] for g in got]})

    return rows.mapInPandas(cut_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
