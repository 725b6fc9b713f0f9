"""Cross-tokenizer alignment with an identity-map fast path.

Two tokenizers cut the same bytes (one space and the text): A, a byte-level BPE that gets space + text,
and B, a piece BPE with byte fallback that adds the space itself. Byte offsets where a token of A and a
token of B both end cut a text into groups; the last A token and the last B token of a group are linked.

* The identity map, an array from A id to the B id with the same bytes, is precomputed from the two
  vocabularies. A group of one A and one B token that the map knows is exact. Exact links are counted in
  vectors as long as A's vocabulary, one per task, summed by id.
* Only links of irregular groups enter the pair shuffle, as partial counts per task.
* Scoring needs the corpus count of every link. Exact links take it from the vector. Irregular pairs that
  hold at least 1 of ``HOT`` irregular links (there can be no more than ``HOT`` of them, at any size) come
  from a broadcast table; links of all rarer pairs are joined with their counts, and no key of that join is
  hot by construction.
* Encoding: neither tokenizer has a token across a non-space and the single space behind it, so a text is cut there
  into units that are encoded and aligned on their own. A task keeps the units it has seen (up to
  ``UNITS`` of them, then it starts anew), encodes new ones in batches, and no encoder call holds more than one unit
  of a long text. ``Pair`` checks the property on B's vocabulary and refuses tokenizers without it.

The tokenizer files are parameters; the driver reads them and broadcasts their contents (2 MB, fixed).

Defined results: a null or empty text, and one whose joined token bytes differ from space + text in either
tokenizer, has no tokens (zeros, empty digest); special tokens' strings are plain text; repeated rows are
rows of their own and count each; null ids are kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, cut, stored, text_of

FOLDER = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
HOT = 1 << 20  # pairs in the broadcast table, at most
UNITS = 1 << 18  # cached units of a task, at most
_CUT = re.compile(r"(?<=\S) (?=\S)")
_CHARS = 1 << 20  # characters handled at once
_CODES = 1 << 21  # link codes counted at once
_RUN = 1 << 16  # characters of new units encoded at once


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for the 256 bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers, the bytes of their tokens and the identity map."""

    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters = byte_alphabet()
        self.n_a, self.n_b = self.a.get_vocab_size(with_added_tokens=True), self.b.get_piece_size()
        special = {i for i, t in self.a.get_added_tokens_decoder().items() if t.special}
        self.a_bytes = [b""] * self.n_a
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            self.a_bytes[i] = token.encode() if i in special else bytes(letters[c] for c in token)
        self.b_bytes, same = [], {}
        for i in range(self.n_b):
            piece, is_byte = self.b.id_to_piece(i), self.b.is_byte(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode())
            if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i)):
                if re.search("[^▁]▁", piece):
                    raise ValueError(f"piece {piece!r} crosses a space: texts cannot be cut into units")
                if not is_byte or self.b_bytes[i] not in same:
                    same[self.b_bytes[i]] = i  # a piece goes before the byte of the same value
        self.identity = np.array([-1 if i in special else same.get(x, -1) for i, x in enumerate(self.a_bytes)], dtype=np.int64)
        self.a_len = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], dtype=np.int64)

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bool]]:
        """A ids, their number per unit, B ids, their number per unit, and whether both tokenizers give the unit's bytes.

        Units without white space at their ends are encoded joined by spaces (they are cut there again,
        by bytes); the others, and all units of a run whose bytes differ, one by one.
        """
        run = [u for u in units if u and u == u.strip()]
        if len(run) == len(units) and run:
            text = " ".join(units)
            want = (" " + text).encode("utf-8", "surrogatepass")
            a = np.array(self.a.encode(" " + text, add_special_tokens=False).ids, dtype=np.int64)
            b = np.array(self.b.encode(text), dtype=np.int64)
            if b"".join(map(self.a_bytes.__getitem__, a.tolist())) == want == b"".join(map(self.b_bytes.__getitem__, b.tolist())):
                ends = np.cumsum(np.fromiter((len(u.encode("utf-8", "surrogatepass")) + 1 for u in units), np.int64, len(units)))
                n_a = np.diff(np.searchsorted(np.cumsum(self.a_len[a]), ends, "right"), prepend=0)
                n_b = np.diff(np.searchsorted(np.cumsum(self.b_len[b]), ends, "right"), prepend=0)
                return a, n_a, b, n_b, [True] * len(units)
        a = [e.ids for e in self.a.encode_batch([" " + u for u in units], add_special_tokens=False)]
        b = self.b.encode(units, num_threads=1)
        valid = [b"".join(map(self.a_bytes.__getitem__, x)) == (" " + u).encode("utf-8", "surrogatepass") == b"".join(map(self.b_bytes.__getitem__, y))
                 for u, x, y in zip(units, a, b)]
        a, b = [x if ok else [] for x, ok in zip(a, valid)], [x if ok else [] for x, ok in zip(b, valid)]
        return (np.array([i for x in a for i in x], dtype=np.int64), np.array([len(x) for x in a], dtype=np.int64),
                np.array([i for x in b for i in x], dtype=np.int64), np.array([len(x) for x in b], dtype=np.int64), valid)


class Units:
    """Alignments of the units seen so far, as flat arrays: exact A ids and irregular link codes of each."""

    def __init__(self, pair: Pair):
        self.pair, self.a_text, self.b_text = pair, [str(i) for i in range(pair.n_a)], [str(i) for i in range(pair.n_b)]
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[str] = []
        self.counts: list[np.ndarray] = []  # (valid, A tokens, B tokens, groups, exact, irregular) of each unit
        self.exact: list[np.ndarray] = []
        self.odd: list[np.ndarray] = []
        self.tokens = 0

    def add(self, units: list[str]) -> None:
        """Take in new units: runs of plain ones, then those with white space at an end."""
        plain = [u for u in units if u and u == u.strip()]
        rest = [u for u in units if not u or u != u.strip()]
        for i, j in _slices(plain, _RUN):
            self._add(plain[i:j])
        if rest:
            self._add(rest)

    def _add(self, units: list[str]) -> None:
        p = self.pair
        a, n_a, b, n_b, valid = p.encode(units)
        # units follow each other, so ends are unique; both tokenizers give the same bytes, so every unit's end is common
        _, at_a, at_b = np.intersect1d(np.cumsum(p.a_len[a]), np.cumsum(p.b_len[b]), assume_unique=True, return_indices=True)
        unit = np.repeat(np.arange(len(units)), n_a)[at_a]
        n_groups = np.bincount(unit, minlength=len(units))
        one = (np.diff(at_a, prepend=-1) == 1) & (np.diff(at_b, prepend=-1) == 1)
        last_a, last_b = a[at_a], b[at_b]
        fast = one & (p.identity[last_a] == last_b)
        texts_a, texts_b = list(map(self.a_text.__getitem__, a.tolist())), list(map(self.b_text.__getitem__, b.tolist()))
        lines, i, j = [], 0, 0
        for x, y, single in zip((at_a + 1).tolist(), (at_b + 1).tolist(), one.tolist()):
            lines.append(f"{texts_a[i]}|{texts_b[j]}" if single else ",".join(texts_a[i:x]) + "|" + ",".join(texts_b[j:y]))
            i, j = x, y
        k, at = 0, len(self.groups)
        for n in n_groups.tolist():
            self.groups.append(lines[k] if n == 1 else ";".join(lines[k:k + n]))
            k += n
        self.index.update(zip(units, range(at, at + len(units))))
        n_fast = np.bincount(unit[fast], minlength=len(units))
        self.counts.append(np.stack([np.array(valid, dtype=np.int64), n_a, n_b, n_groups, n_fast, n_groups - n_fast], axis=1))
        self.exact.append(last_a[fast])
        self.odd.append(last_a[~fast] * p.n_b + last_b[~fast])
        self.tokens += len(a) + len(b)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        for x in (self.counts, self.exact, self.odd):
            if len(x) > 1:
                x[:] = [np.concatenate(x)]
        return self.counts[0], self.exact[0], self.odd[0]


def _gather(flat: np.ndarray, ends: np.ndarray, n: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` (``n`` long, ending at ``ends``) of the units ``at``, one after the other."""
    sizes = n[at]
    shift = ends[at] - np.cumsum(sizes)
    return flat[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]


def align_texts(units: Units, texts: list[str], with_groups: bool = False) -> list[tuple]:
    """``(n_a, n_b, n_groups, digest, exact ids, irregular link codes[, groups])`` of every text."""
    cuts = [_CUT.split(t) if t else [] for t in texts]
    if len(units.index) > UNITS or units.tokens > 8 * UNITS:
        units.clear()
    new = list({u: None for c in cuts for u in c if u not in units.index})
    if new:
        units.add(new)
    if not units.groups:
        units.add([""])  # all texts are empty: the tables still need their shape
    counts, exact, odd = units.tables()
    e_ends, o_ends = np.cumsum(counts[:, 4]), np.cumsum(counts[:, 5])
    out = []
    for c in cuts:
        at = np.fromiter(map(units.index.__getitem__, c), np.int64, len(c))
        if not len(at) or not counts[at, 0].all():
            out.append((0, 0, 0, "", exact[:0], odd[:0], ""))
            continue
        line = ";".join(map(units.groups.__getitem__, at.tolist()))
        s = counts[at, 1:4].sum(axis=0).tolist()
        out.append((*s, hashlib.sha256(line.encode()).hexdigest(), _gather(exact, e_ends, counts[:, 4], at),
                    _gather(odd, o_ends, counts[:, 5], at), line if with_groups else ""))
    return out


def _slices(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield at, i
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def load(folder: str = FOLDER, a_file: str = A_FILE, b_file: str = B_FILE) -> tuple[str, bytes]:
    """The contents of the two tokenizer files (read on the driver)."""
    with open(f"{folder}/{a_file}", encoding="utf-8") as f:
        a_json = f.read()
    with open(f"{folder}/{b_file}", "rb") as f:
        return a_json, f.read()


def align(docs: DataFrame, files: tuple[str, bytes] | None = None, id_col: str = "doc_id", text_col: str = "text",
          with_groups: bool = False) -> DataFrame:
    """``(row, doc_id, n_a, n_b, n_groups, groups_sha256, exact, odd[, groups])`` per row, written to the shared folder.

    ``exact`` holds the A ids of exact groups and ``odd`` the link codes ``a * |B| + b`` of irregular
    ones, both as little-endian bytes; ``groups`` is the alignment as text.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(files or load())

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        units = Units(Pair(*shared.value))
        for pdf in batches:
            texts = pdf["text"].tolist()
            for i, j in _slices(texts, _CHARS):
                got = align_texts(units, texts[i:j], with_groups)
                out = {"doc_id": pdf["doc_id"].iloc[i:j].to_numpy(), "no_id": pdf["no_id"].iloc[i:j].to_numpy(), "n_a": [g[0] for g in got], "n_b": [g[1] for g in got],
                       "n_groups": [g[2] for g in got], "groups_sha256": [g[3] for g in got],
                       "exact": [g[4].astype("<u4").tobytes() for g in got], "odd": [g[5].astype("<u4" if units.pair.n_a * units.pair.n_b < 1 << 32 else "<u8").tobytes() for g in got]}
                yield pd.DataFrame(out | ({"groups": [g[6] for g in got]} if with_groups else {}))

    schema = "doc_id long, no_id boolean, n_a long, n_b long, n_groups long, groups_sha256 string, exact binary, odd binary" + ", groups string" * with_groups
    doc_id = col(id_col).cast("long")
    rows = docs.select(F.coalesce(doc_id, F.lit(0)).alias("doc_id"), doc_id.isNull().alias("no_id"), text_of(text_col).alias("text")).mapInPandas(encode, schema)
    rows = rows.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "aligned")


def link_counts(aligned: DataFrame, n_a: int, n_b: int) -> tuple[DataFrame, DataFrame]:
    """``(a, n)`` of exact links, and ``(code, n)`` of irregular pairs; both corpus-wide and materialised."""
    kind = np.dtype("<u4" if n_a * n_b < 1 << 32 else "<u8")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vector, codes, held = np.zeros(n_a, dtype=np.int64), [], 0

        def pairs():
            c, n = np.unique(np.concatenate(codes), return_counts=True)
            return pd.DataFrame({"exact": False, "id": c.astype(np.int64), "n": n.astype(np.int64)})

        for pdf in batches:
            for e in pdf["exact"]:
                vector += np.bincount(np.frombuffer(e, "<u4"), minlength=n_a)
            for o in pdf["odd"]:
                codes.append(np.frombuffer(o, kind))
                held += len(codes[-1])
                if held >= _CODES:
                    yield pairs()
                    codes, held = [], 0
        if held:
            yield pairs()
        seen = np.flatnonzero(vector)
        yield pd.DataFrame({"exact": True, "id": seen, "n": vector[seen]})

    parts = aligned.select("exact", "odd").mapInPandas(count, "exact boolean, id long, n long")
    both = cut(parts.groupBy("exact", "id").agg(F.sum("n").alias("n")))
    return (both.where("exact").select(F.col("id").alias("a"), "n"), both.where("not exact").select(F.col("id").alias("code"), "n"))


def score(aligned: DataFrame, files: tuple[str, bytes] | None = None, hot: int = HOT) -> DataFrame:
    """``aligned`` with ``n_links``, ``n_best`` (links whose pair count is their B id's highest) and ``count_sum``."""
    spark = aligned.sparkSession
    pair = Pair(*(files or load()))
    n_a, n_b, identity = pair.n_a, pair.n_b, pair.identity
    exact_df, pairs = link_counts(aligned, n_a, n_b)
    vector = np.zeros(n_a, dtype=np.int64)
    for r in exact_df.toLocalIterator():  # as long as A's vocabulary
        vector[r.a] = r.n
    best = np.zeros(n_b, dtype=np.int64)
    np.maximum.at(best, identity[vector > 0], vector[vector > 0])
    b_of = (F.col("code") % n_b).cast("int")
    total = 0
    for r in pairs.groupBy(b_of.alias("b")).agg(F.max("n").alias("m"), F.sum("n").alias("s")).toLocalIterator():  # as long as B's
        best[r.b] = max(best[r.b], r.m)
        total += r.s
    # at most ``hot`` pairs can hold 1 of ``hot`` links each
    is_hot = F.col("n").cast("decimal(38,0)") * hot >= F.lit(total).cast("decimal(38,0)")
    head = pairs.where(is_hot).toPandas().sort_values("code")
    codes, counts = head["code"].to_numpy(np.int64), head["n"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast((vector, vector == np.where(identity >= 0, best[identity], -1), codes, counts,
                                           counts == best[codes % n_b]))
    kind = np.dtype("<u4" if n_a * n_b < 1 << 32 else "<u8")

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vector, vector_best, codes, counts, code_best = shared.value
        for pdf in batches:
            n_best, sums, cold = [], [], []
            for e, o in zip(pdf["exact"], pdf["odd"]):
                e, o = np.frombuffer(e, "<u4"), np.frombuffer(o, kind).astype(np.int64)
                at = np.minimum(np.searchsorted(codes, o), max(len(codes) - 1, 0))
                known = codes[at] == o if len(codes) else np.zeros(len(o), dtype=bool)
                at = at[known]
                n_best.append(int(vector_best[e].sum() + code_best[at].sum()))
                sums.append(int(vector[e].sum() + counts[at].sum()))
                cold.append(o[~known])
            yield pd.DataFrame({"at": pdf["row"], "n_best": n_best, "count_sum": sums, "cold": cold})

    half = stored(aligned.select("row", "exact", "odd").mapInPandas(look_up, "at long, n_best long, count_sum long, cold array<long>"), "links")
    tops = spark.createDataFrame([(i, int(n)) for i, n in enumerate(best.tolist()) if n], "b int, top long")
    rare = pairs.where(~is_hot).join(F.broadcast(tops), b_of == F.col("b")).select("code", "n", (F.col("n") == F.col("top")).cast("long").alias("is_best"))
    cold = half.select("at", F.explode("cold").alias("code")).join(rare, "code").select("at", F.col("is_best").alias("n_best"), F.col("n").alias("count_sum"))
    sums = (half.select("at", "n_best", "count_sum").unionByName(cold).groupBy("at")
            .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    return aligned.join(sums, F.col("row") == F.col("at")).select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")
