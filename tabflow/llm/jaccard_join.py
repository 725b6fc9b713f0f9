"""Exact n-gram Jaccard self-join: rare-first prefixes, length, positional and suffix filters.

A document's set holds its distinct ``shingle``-word shingles (A-Z lower-cased, joined by one space; fewer words:
the whole sequence) as XXH64 hashes. Two sets link when ``100 * |x & y| >= percent * |x | y|``; classes are the
connected components of the links.

1. Sets are packed in blocks of some hundred documents, in a table bucketed by block. Documents with equal sets (by a
   128-bit digest of the sorted set) are one set from here on, whatever their number.
2. Every block asks for its distinct tokens (packed, dealt by hash range; a token comes once per block, however
   many documents hold it) and learns which of them other sets hold, and how many. A token is asked for by its
   range and its low 32 bits. The number of ranges follows the number of tokens, so at any size about one token in 2000
   shares these with another and counts as more frequent than it is; the order below stays one and the same for all.
   The answers meet the blocks in their buckets: the sets themselves are written once and never shuffled.
3. Tokens are ordered by (frequency, hash), rarest first. Tokens that no other set holds come first and can match
   nothing, so a set whose prefix is made of them is out. The others emit their prefix tokens, with the position, the
   set's size and, for the suffix filter, how many of the tokens behind that position fall in each of 8 hash ranges.
4. Sets that share a prefix token are candidates when the shorter one has it in its index prefix and the longer one in
   its probe prefix, the sizes allow the similarity, and the upper bounds on the overlap by position (tokens left) and by
   suffix (the smaller count per range) reach what it takes. The bounds hold at the first common token, where
   every linked pair is met.
5. Two rounds keep groups of copies from making all their pairs. The first only pairs the ``LEADERS`` most central
   entries of a bucket (fewest tokens of their own) with the rest; the verified links give classes. The second takes
   every candidate pair of different classes, in all buckets that still hold more than one class; nothing is capped.
   Buckets beyond ``BLOCK`` entries are dealt as parts (first round) or pairs of parts (second).
6. Every pair is verified once, exactly, by a join with the sets.

Defined results: a null text is empty; without words the set is empty, linked with nothing, and the document is its
own class; repeated rows and equal texts share a class; a null id never becomes a class id unless all ids of
the class are null; an empty table gives an empty result; other columns are not read. Two different shingles with
one 64-bit hash count as one (about one pair in 10^19).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import col, components, cut, stored, text_of

SHINGLE, PERCENT = 4, 85  # fixed values of the contract
BLOCK_TOKENS, BLOCK_DOCS = 1 << 17, 1 << 13
PART_TOKENS = 1 << 21
LEADERS, BLOCK = 2, 4096
RANGES = 8
_IDX = 13  # bits of a set's number in its block
_SMALL = 16


def tokens_of(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted distinct shingle hashes of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(len(words) - shingle + 1, 1)
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends - 1)[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(line[a:b]) for a, b in zip(starts, stops)), dtype=np.uint64, count=n))


def pack(docs: DataFrame, id_col: str, text_col: str, shingle: int, name: str) -> DataFrame:
    """One row per block: ids, set sizes, set digests and the tokens of the block's distinct sets, all packed; written as table ``name``."""
    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, sizes, keys, lens, flat, seen, held = [], [], [], [], [], set(), 0

        def row():
            return pd.DataFrame({"ids": [np.array([i for i, _ in ids], "<i8").tobytes()], "none": [bytes(x for _, x in ids)],
                                 "sizes": [np.array(sizes, "<i4").tobytes()], "keys": [b"".join(keys)], "lens": [np.array(lens, "<i4").tobytes()],
                                 "tokens": [np.concatenate([np.empty(0, np.uint64), *flat]).astype("<u8").tobytes()], "n_tokens": [held]})

        for pdf in batches:
            for i, none, t in zip(pdf["doc_id"].tolist(), pdf["no_id"].tolist(), pdf["text"]):
                x = tokens_of(t, shingle)
                key = hashlib.md5(x.tobytes()).digest() if len(x) else bytes(16)
                ids.append((i, none))
                sizes.append(len(x))
                keys.append(key)
                lens.append(0 if key in seen else len(x))
                if lens[-1]:
                    seen.add(key)
                    flat.append(x)
                    held += len(x)
                if held >= BLOCK_TOKENS or len(ids) >= BLOCK_DOCS:
                    yield row()
                    ids, sizes, keys, lens, flat, seen, held = [], [], [], [], [], set(), 0
        if ids:
            yield row()

    doc_id = col(id_col).cast("long")
    base = docs.select(F.coalesce(doc_id, F.lit(0)).alias("doc_id"), doc_id.isNull().alias("no_id"), text_of(text_col).alias("text"))
    rows = base.mapInPandas(blocks, "ids binary, none binary, sizes binary, keys binary, lens binary, tokens binary, n_tokens long")
    m = F.monotonically_increasing_id()
    # (partition, number in it) leaving _IDX low bits for the set's number in the block
    rows = rows.withColumn("block", F.shiftright(m, 33) * (1 << 20) + m.bitwiseAND(F.lit((1 << 33) - 1)))
    spark = docs.sparkSession
    rows.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").option("path", scratch_path(spark, name)).saveAsTable(name)
    return spark.table(name)


def members(blocks: DataFrame) -> DataFrame:
    """``(doc_id, n, k1, k2, rid, first)`` per document; ``first`` marks a block's first document of its set."""
    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                ids, k = np.frombuffer(r.ids, "<i8"), np.frombuffer(r.keys, "<i8").reshape(-1, 2)
                yield pd.DataFrame({"doc_id": ids, "no_id": np.frombuffer(r.none, bool), "n": np.frombuffer(r.sizes, "<i4").astype(np.int64),
                                    "k1": k[:, 0], "k2": k[:, 1], "rid": (r.block << _IDX) + np.arange(len(ids)),
                                    "first": np.frombuffer(r.lens, "<i4") > 0})

    rows = blocks.select("block", "ids", "none", "sizes", "keys", "lens").mapInPandas(
        unpack, "doc_id long, no_id boolean, n long, k1 long, k2 long, rid long, first boolean")
    return rows.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")


def _ranges(t: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash ranges that ascending tokens fall in, and where each begins."""
    part = ((t >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    return part[cuts], cuts


def shared_tokens(blocks: DataFrame, parts: int) -> DataFrame:
    """``(block, part, at, df)``: per block and hash range, which of the block's tokens there several sets hold, and how many do; written."""
    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for block, raw in zip(pdf["block"], pdf["tokens"]):
                t, n = np.unique(np.frombuffer(raw, "<u8"), return_counts=True)
                if not len(t):
                    continue
                part, cuts = _ranges(t, parts)
                ends, low = np.append(cuts[1:], len(t)), t.astype("<u4")
                # most tokens occur once in their block: only the others' numbers are sent
                many = [np.flatnonzero(n[a:b] > 1) for a, b in zip(cuts, ends)]
                yield pd.DataFrame({"part": part, "block": block, "tokens": [low[a:b].tobytes() for a, b in zip(cuts, ends)],
                                    "at": [m.astype("<u4").tobytes() for m in many], "n": [n[a:b][m].astype("<u4").tobytes() for a, b, m in zip(cuts, ends, many)]})

    def reply(pdf: pd.DataFrame) -> pd.DataFrame:
        t = np.concatenate([np.frombuffer(x, "<u4") for x in pdf["tokens"]])
        sizes = np.array([len(x) // 4 for x in pdf["tokens"]])
        first = np.cumsum(sizes) - sizes
        n = np.ones(len(t), dtype=np.int64)
        for f, at, m in zip(first.tolist(), pdf["at"], pdf["n"]):
            n[f + np.frombuffer(at, "<u4").astype(np.int64)] = np.frombuffer(m, "<u4")
        order = np.argsort(t, kind="stable")
        cuts = np.flatnonzero(np.concatenate(([True], t[order][1:] != t[order][:-1])))
        df = np.empty(len(t), dtype=np.int64)
        df[order] = np.repeat(np.add.reduceat(n[order], cuts), np.diff(np.append(cuts, len(t))))
        out = []
        for block, f, size in zip(pdf["block"], first.tolist(), sizes.tolist()):
            hit = np.flatnonzero(df[f:f + size] > 1)
            if len(hit):
                out.append((block, int(pdf["part"].iloc[0]), hit.astype("<u4").tobytes(), df[f + hit].astype("<i8").tobytes()))
        return pd.DataFrame(out, columns=["block", "part", "at", "df"])

    asks = blocks.select("block", "tokens").mapInPandas(ask, "part long, block long, tokens binary, at binary, n binary")
    return stored(asks.groupBy("part").applyInPandas(reply, "block long, part long, at binary, df binary"), "frequencies")


def _ceil(a, b: int):
    return -(-a // b)


def prefixes(blocks: DataFrame, shared: DataFrame, reps: DataFrame, percent: int, parts: int) -> DataFrame:
    """``(rid, n, own, tokens, at, pos, behind)`` of every first set with a shared token in its prefix; written.

    ``at``/``pos`` are the prefix tokens that other sets hold and their positions, ``behind`` the counts of
    later tokens per hash range, ``own`` the number of tokens no other set holds.
    """
    info = shared.withColumn("sets", F.lit(None).cast("array<int>")).unionByName(
        reps.groupBy(F.shiftright("rep", _IDX).alias("block")).agg(F.collect_list(F.col("rep").bitwiseAND(F.lit((1 << _IDX) - 1)).cast("int")).alias("sets")),
        allowMissingColumns=True)

    def choose(key: tuple, mine: pd.DataFrame, info: pd.DataFrame) -> pd.DataFrame:
        cols = ["rid", "n", "own", "tokens", "at", "pos", "behind"]
        known = info[info["at"].notna()]
        sets = sorted(int(i) for s in info["sets"] if s is not None for i in s)
        if not len(known) or not len(mine):
            return pd.DataFrame(columns=cols)
        every = np.unique(np.frombuffer(mine["tokens"].iloc[0], "<u8"))
        begins = dict(zip(*(x.tolist() for x in _ranges(every, parts))))
        at = np.concatenate([begins[int(p)] + np.frombuffer(a, "<u4").astype(np.int64) for p, a in zip(known["part"], known["at"])])
        df = np.concatenate([np.frombuffer(x, "<i8") for x in known["df"]])
        order = np.argsort(at)
        t, df = every[at[order]], df[order]
        flat = np.frombuffer(mine["tokens"].iloc[0], "<u8")
        ends = np.cumsum(np.frombuffer(mine["lens"].iloc[0], "<i4"), dtype=np.int64)
        out = []
        for i in sets:
            x = flat[(ends[i - 1] if i else 0):ends[i]]
            n = len(x)
            where = np.minimum(np.searchsorted(t, x), len(t) - 1)
            many = np.where(t[where] == x, df[where], 1)
            own = int((many == 1).sum())
            length = n - int(_ceil(percent * n, 100)) + 1
            if own >= length:
                continue
            rank = np.lexsort((x, many))
            by_range = (x[rank] >> np.uint64(61)).astype(np.int64)
            left = np.bincount(by_range, minlength=RANGES) - np.bincount(by_range[:own], minlength=RANGES)
            pos = np.arange(own, length)
            one = np.zeros((len(pos), RANGES), dtype=np.int64)
            one[np.arange(len(pos)), by_range[own:length]] = 1
            behind = left - np.cumsum(one, axis=0)
            out.append(((int(key[0]) << _IDX) + i, n, own, x.tobytes(), x[rank[own:length]].view(np.int64), pos, behind.astype("<i4").tobytes()))
        return pd.DataFrame(out, columns=cols)

    found = blocks.select("block", "tokens", "lens").groupBy("block").cogroup(info.groupBy("block")).applyInPandas(
        choose, "rid long, n int, own int, tokens binary, at array<long>, pos array<int>, behind binary")
    return stored(found, "prefixes")


ENTRY = "t long, rid long, n int, own int, pos int, behind binary"


def entries(active: DataFrame) -> DataFrame:
    """``ENTRY`` rows: one per prefix token."""
    def unfold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            k = pdf["at"].map(len).to_numpy()
            width = 4 * RANGES
            yield pd.DataFrame({"t": np.concatenate([np.empty(0, np.int64), *pdf["at"]]), "rid": np.repeat(pdf["rid"].to_numpy(), k),
                                "n": np.repeat(pdf["n"].to_numpy(), k), "own": np.repeat(pdf["own"].to_numpy(), k),
                                "pos": np.concatenate([np.empty(0, np.int32), *pdf["pos"]]),
                                "behind": [b[i:i + width] for b in pdf["behind"] for i in range(0, len(b), width)]})

    return active.select("rid", "n", "own", "at", "pos", "behind").mapInPandas(unfold, ENTRY)


class Entries:
    """Sorted entries as columns; runs of equal keys are buckets."""

    def __init__(self, pdf: pd.DataFrame, keys: list[str]):
        self.n, self.own, self.pos = (pdf[c].to_numpy(np.int64) for c in ("n", "own", "pos"))
        self.rid = pdf["rid"].to_numpy(np.int64)
        self.behind = np.frombuffer(b"".join(pdf["behind"]), "<i4").reshape(-1, RANGES)
        k = pdf[keys].to_numpy()
        self.starts = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]).any(axis=1))))
        self.sizes = np.diff(np.append(self.starts, len(k)))

    def passing(self, i: np.ndarray, j: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """The pairs ``(i, j)`` of entries of one bucket that pass the length, prefix, positional and suffix filters."""
        n, m, p, q = self.n[i], self.n[j], self.pos[i], self.pos[j]
        short = (n < m) | (n == m) & (self.rid[i] < self.rid[j])  # whether i is the shorter, indexed one
        least, most = np.minimum(n, m), np.maximum(n, m)
        ok = (100 * least >= percent * most) & (np.where(short, p, q) <= least - _ceil(2 * percent * least, 100 + percent))
        need = _ceil(percent * (n + m), 100 + percent)
        ok &= np.minimum(n - p, m - q) >= need  # the common token and what is left behind it
        i, j, need = i[ok], j[ok], need[ok]
        ok = 1 + np.minimum(self.behind[i], self.behind[j]).sum(axis=1) >= need
        return self.rid[i[ok]], self.rid[j[ok]]


def _whole_buckets(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """A sorted stream in stretches that end where a bucket ends."""
    rest = None
    for pdf in batches:
        if rest is not None and len(rest):
            pdf = pd.concat([rest, pdf], ignore_index=True)
        if not len(pdf):
            continue
        last = (pdf[keys] != pdf[keys].iloc[-1]).any(axis=1).to_numpy().nonzero()[0]  # the last bucket may go on
        cut_at = int(last[-1]) + 1 if len(last) else 0
        if cut_at:
            yield pdf.iloc[:cut_at]
        rest = pdf.iloc[cut_at:]
    if rest is not None and len(rest):
        yield rest


def _pairs(found: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
    """Distinct pairs, the smaller id first."""
    a = np.concatenate([np.empty(0, np.int64), *(x for x, _ in found)])
    b = np.concatenate([np.empty(0, np.int64), *(x for _, x in found)])
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()


def star_pairs(rows: DataFrame, percent: int, leaders: int = LEADERS, block: int = BLOCK) -> DataFrame:
    """``(a, b)``: the most central entries of every bucket (part) with the others; parts' first leaders meet again."""
    large = cut(rows.groupBy("t").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > block)
                .select("t", F.ceil(F.col("m") / block).cast("int").alias("parts")))
    dealt = rows.join(large, "t", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("rid", "t"), F.col("parts")), F.lit(0)).cast("int"))
    shape = "a long, b long"

    def lead(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _whole_buckets(batches, ["t", "part"]):
            x = Entries(pdf, ["t", "part"])
            run = np.repeat(np.arange(len(x.starts)), x.sizes)
            order = np.lexsort((x.rid, x.own / np.maximum(x.n, 1), run))  # the most central first, bucket by bucket
            found = []
            for k in range(leaders):
                nth = np.repeat(x.starts + k, x.sizes)
                later = np.flatnonzero(np.arange(len(run)) > nth)
                found.append(x.passing(order[nth[later]], order[later], percent))
            yield _pairs(found)

    first = dealt.repartition("t", "part").sortWithinPartitions("t", "part").mapInPandas(lead, shape)
    # the most central entry of every part of a large bucket, with those of the bucket's other parts
    tops = (dealt.where("parts > 1").groupBy("t", "part").agg(F.min_by(F.struct("rid", "n", "own", "pos", "behind"), F.struct(F.col("own") / F.col("n"), "rid")).alias("e"))
            .select("t", F.lit(0).alias("part"), "e.*"))
    again = tops.repartition("t").sortWithinPartitions("t", "part").mapInPandas(lead, shape)
    return first.unionByName(again).distinct()


def cross_pairs(rows: DataFrame, roots: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """``(a, b)``: all candidate pairs of different classes; ``roots(node, root)`` are the classes so far."""
    marked = rows.join(roots, rows["rid"] == roots["node"], "left").withColumn("root", F.coalesce("root", "rid")).drop("node")
    mixed = cut(marked.groupBy("t").agg(F.count(F.lit(1)).alias("m"), F.min("root").alias("lo"), F.max("root").alias("hi"))
                .where("lo < hi").select("t", F.ceil(F.col("m") / block).cast("int").alias("parts")))
    mine = F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least(o, mine).alias("i"), F.greatest(o, mine).alias("j"), mine.alias("side")))
    dealt = marked.join(mixed, "t").select("t", "rid", "n", "own", "pos", "behind", "root", F.inline(meets))

    def cross(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _whole_buckets(batches, ["t", "i", "j"]):
            x = Entries(pdf, ["t", "i", "j"])
            root, side = pdf["root"].to_numpy(np.int64), pdf["side"].to_numpy(np.int64)
            apart = (pdf["i"] != pdf["j"]).to_numpy()  # two parts: only pairs across them, the others meet elsewhere
            run = np.repeat(np.arange(len(x.starts)), x.sizes)
            small = (x.sizes <= _SMALL)[run]
            found, held = [], 0
            for lag in range(1, min(_SMALL, len(run))):
                i = np.flatnonzero(small[lag:] & (run[lag:] == run[:-lag]) & (root[lag:] != root[:-lag]))
                i = i[~apart[i] | (side[i] != side[i + lag])]
                found.append(x.passing(i, i + lag, percent))
            for at, size in zip(x.starts[x.sizes > _SMALL].tolist(), x.sizes[x.sizes > _SMALL].tolist()):
                _, cls, many = np.unique(root[at:at + size], return_inverse=True, return_counts=True)
                order = np.argsort(many[cls], kind="stable")  # the largest class last: its members need no turn of their own
                for k in range(size - int(many.max())):
                    rest = order[k + 1:]
                    rest = rest[cls[rest] != cls[order[k]]]
                    i = at + order[k]
                    if apart[i]:
                        rest = rest[side[at + rest] != side[i]]
                    found.append(x.passing(np.full(len(rest), i), at + rest, percent))
                    held += len(found[-1][0])
                    if held > 1 << 17:
                        yield _pairs(found)
                        found, held = [], 0
            yield _pairs(found)

    return dealt.repartition("t", "i", "j").sortWithinPartitions("t", "i", "j").mapInPandas(cross, "a long, b long").distinct()


def verified(pairs: DataFrame, active: DataFrame, percent: int) -> DataFrame:
    """The pairs that link, by their whole sets."""
    sets = active.select("rid", "tokens")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = []
            for x, y in zip(pdf["x"], pdf["y"]):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = np.concatenate((x, y))
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pdf.loc[keep, ["a", "b"]]

    with_x = pairs.join(sets.select(F.col("rid").alias("a"), F.col("tokens").alias("x")), "a")
    return with_x.join(sets.select(F.col("rid").alias("b"), F.col("tokens").alias("y")), "b").select("a", "b", "x", "y").mapInPandas(check, "a long, b long")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
            leaders: int = LEADERS, block: int = BLOCK) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row."""
    name = f"jaccard_sets_{uuid.uuid4().hex}"
    blocks = pack(docs, id_col, text_col, shingle, name)
    docs_of = stored(members(blocks), "members")
    sets = cut(docs_of.where("n > 0").groupBy("k1", "k2").agg(F.min(F.when(F.col("first"), F.col("rid"))).alias("rep"), F.min("doc_id").alias("low")))
    parts = max(1, -(-(blocks.agg(F.sum("n_tokens")).first()[0] or 0) // PART_TOKENS))
    active = prefixes(blocks, shared_tokens(blocks, parts), sets.select("rep"), percent, parts)
    docs.sparkSession.sql(f"DROP TABLE {name}")  # all that reads it is written; its files stay in the shared folder until that is cleared
    rows = entries(active)
    star = cut(star_pairs(rows, percent, leaders, block))
    near = cut(verified(star, active, percent))
    rest = cross_pairs(rows, components(near), percent, block).join(star, ["a", "b"], "left_anti")
    comp = components(near.unionByName(verified(cut(rest), active, percent)))
    rooted = sets.join(comp, sets["rep"] == comp["node"], "left").select("k1", "k2", "low", F.coalesce("root", "rep").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    per_set = cut(rooted.join(lows, "root").select("k1", "k2", "component_id"))
    found = docs_of.where("n > 0").join(per_set, ["k1", "k2"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return found.unionByName(docs_of.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
