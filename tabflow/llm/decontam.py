"""Benchmark decontamination: a BM25 index of the test items, searched by every training passage.

Index: items are documents, their words terms; an item's impacts ``idf * tf-part`` are divided by
its own total, so a passage holding every word of an item scores 1. Document frequencies, the number of items and
their mean length come from one Spark aggregation over all items, so a score does not depend on how the items
are dealt. Items are cut into blocks of ``block`` items; postings hold the largest impact per (term, block).

Search (block-max WAND, a batch of passages at a time): passages are windows of ``2 L`` words every
``L`` words, so an item of up to ``L`` words lies whole in one of them. A passage's distinct terms
give three bounds that are tightened in turn: the sum of term maxima over the index, the sum of
block maxima per block, and the exact scores of the items of the blocks that remain. What cannot
reach ``threshold`` is skipped unscored; every item at or above it is retrieved.

Verification: an item's question (up to its last question mark; without one, its first half) and
answer (the rest) must both overlap the passage: at least ``overlap`` of each part's word trigrams
(of the whole part when it is shorter) occur in it.

Scale: the index is not assumed small. Items are dealt into length classes (``L`` = 64, 128, ...) and scans of about
``pass_items`` items; a scan's indexes (sparse: an entry per item and term) are what the driver and tasks hold, and its
matches are written before its broadcast goes and the next begins. The training text is read once per scan and never
shuffled. One tokenizer, Python's, counts and cuts words on both sides.

Defined results: null or empty text has no passages; items without words never match; repeated
rows or items are matched each; an empty table on either side gives an empty result; other columns
are not read (``clean`` returns the documents' columns unchanged).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, fresh, stored, text_of, union_all

K1, B = 1.2, 0.75  # usual BM25 constants
THRESHOLD, OVERLAP, GRAM, MIN_LENGTH, BLOCK, PASS_ITEMS = 0.6, 0.5, 3, 64, 8, 8192
_WORD = re.compile(r"\w+")
_SLACK = 1e-6  # bounds are sums in another order than scores


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _grams(ids: list[int]) -> set[tuple[int, ...]]:
    n = min(GRAM, len(ids))
    return set(zip(*(ids[i:] for i in range(n)))) if n else set()


def build(items: list[tuple], length: int, block: int = BLOCK, df: dict[str, int] | None = None, n_items: int | None = None,
          mean_words: float | None = None) -> dict:
    """The index of ``(item id, text)`` rows as plain arrays, lists and dicts (tasks need no class of this package).

    ``df``, ``n_items`` and ``mean_words`` are those of the whole test set; without them, of these rows.
    """
    toks = [words(t) for _, t in items]
    if df is None:
        df, n_items, mean_words = {}, len(items), sum(map(len, toks)) / max(len(items), 1)
        for ws in toks:
            for w in set(ws):
                df[w] = df.get(w, 0) + 1
    vocab: dict[str, int] = {}
    terms, impacts, questions, answers = [], [], [], []
    for (_, text), ws in zip(items, toks):
        tf: dict[str, int] = {}
        for w in ws:
            tf[w] = tf.get(w, 0) + 1
        own = list(tf)  # in order of first use: the order of every later sum
        f = np.array([tf[w] for w in own], dtype=np.float64)
        d = np.array([df[w] for w in own], dtype=np.float64)
        norm = K1 * (1 - B + B * len(ws) / max(mean_words, 1.0))
        x = np.log1p((n_items - d + 0.5) / (d + 0.5)) * f * (K1 + 1) / (f + norm)
        impacts.append(x / max(x.sum(), 1e-9))
        terms.append(np.array([vocab.setdefault(w, len(vocab)) for w in own], dtype=np.int64))
        q = len(words(text[:text.rfind("?") + 1])) if "?" in text else (len(ws) + 1) // 2
        ids = [vocab[w] for w in ws]
        questions.append(_grams(ids[:q]))
        answers.append(_grams(ids[q:]))
    n_blocks = -(-len(items) // block)
    flat = np.concatenate([t * n_blocks + j // block for j, t in enumerate(terms)])
    order = np.argsort(flat, kind="stable")
    cells, first = np.unique(flat[order], return_index=True)
    peak = np.maximum.reduceat(np.concatenate(impacts)[order], first)
    starts = np.searchsorted(cells // n_blocks, np.arange(len(vocab) + 1))
    return {"items": [i for i, _ in items], "vocab": vocab, "terms": terms, "impacts": impacts, "questions": questions, "answers": answers,
            "length": length, "block": block, "n_blocks": n_blocks, "starts": starts, "blocks": cells % n_blocks, "peak": peak,
            "top": np.maximum.reduceat(peak, starts[:-1])}


def search(index: dict, texts: list[str], threshold: float = THRESHOLD, overlap: float = OVERLAP):
    """``(text number, item number, score, question overlap, answer overlap)`` of the verified passages."""
    size, n_terms = index["length"], len(index["vocab"])
    get, ids, block_of, owner, n_blocks = index["vocab"].get, [], [], [], 0
    starts = []  # first word of each text's blocks, for verification
    for k, t in enumerate(texts):
        ws = words(t)
        if not ws:
            continue
        x = np.fromiter(map(get, ws, repeat(-1)), dtype=np.int64, count=len(ws))
        ids.append(x)
        nb = -(-len(x) // size)
        block_of.append(n_blocks + np.arange(len(x)) // size)
        owner += [k] * nb
        starts += [(len(ids) - 1, b) for b in range(nb)]
        n_blocks += nb
    if not ids:
        return []
    flat, blocks, owner = np.concatenate(ids), np.concatenate(block_of), np.array(owner)
    known = flat >= 0
    pairs = np.unique(blocks[known] * n_terms + flat[known])  # distinct terms of each block
    # passage b is block b and, in the same text, block b + 1
    b = pairs // n_terms
    back = pairs[(b > 0) & (owner[b] == owner[np.maximum(b - 1, 0)])] - n_terms
    pairs = np.union1d(pairs, back)
    passage, term = pairs // n_terms, pairs % n_terms
    if not len(pairs):
        return []
    # 1: term maxima over the whole index
    bound = np.bincount(passage, index["top"][term], n_blocks)
    live = bound[passage] >= threshold - _SLACK
    passage, term = passage[live], term[live]
    if not len(passage):
        return []
    first = np.flatnonzero(np.concatenate(([True], passage[1:] != passage[:-1])))
    ends = np.append(first[1:], len(passage))
    found, width, here = [], index["n_blocks"], np.zeros(n_terms, dtype=bool)
    step = max(1, (1 << 21) // width)
    for at in range(0, len(first), step):  # a bounded number of passages at a time
        s, e = first[at:at + step], ends[at:at + step]
        # 2: block maxima, from the postings of the passages' terms
        mine = term[s[0]:e[-1]]
        many = index["starts"][mine + 1] - index["starts"][mine]
        post = np.repeat(index["starts"][mine + 1] - np.cumsum(many), many) + np.arange(int(many.sum()))
        cell = np.repeat(np.repeat(np.arange(len(s)), e - s), many) * width + index["blocks"][post]
        by_block = np.bincount(cell, index["peak"][post], len(s) * width).reshape(len(s), width)
        for p, blk in zip(*np.nonzero(by_block >= threshold - _SLACK)):
            # 3: exact scores inside a block that remains
            here[term[s[p]:e[p]]] = True
            for i in range(blk * index["block"], min((blk + 1) * index["block"], len(index["items"]))):
                score = float(index["impacts"][i][here[index["terms"][i]]].sum())
                if score >= threshold - _SLACK:
                    found.append((int(passage[s[p]]), int(i), score))
            here[term[s[p]:e[p]]] = False
    out, grams = [], {}
    for p, i, score in found:
        if p not in grams:
            doc, b = starts[p]
            grams.clear()
            x = ids[doc][b * size:(b + 2) * size].tolist()
            grams[p] = {n: set(zip(*(x[j:] for j in range(n)))) for n in range(1, GRAM + 1)}
        shares = []
        for part in (index["questions"][i], index["answers"][i]):
            n = len(next(iter(part))) if part else 0
            shares.append(len(part & grams[p][n]) / len(part) if part else 1.0)
        if min(shares) >= overlap:
            out.append((int(owner[p]), i, score, shares[0], shares[1]))
    return out


def sized(items: DataFrame) -> tuple[DataFrame, int, float]:
    """``(item_id, text, n, length, terms, dfs)`` of the items with words, written; their number; their mean words."""
    def cut_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ws = [words(t) for t in pdf["text"]]
            yield pd.DataFrame({"item_id": pdf["item_id"], "no_id": pdf["no_id"], "text": pdf["text"], "n": [len(w) for w in ws],
                                "length": [max(MIN_LENGTH, 1 << max(len(w) - 1, 0).bit_length()) for w in ws], "terms": [list(dict.fromkeys(w)) for w in ws]})

    base = items.select(F.coalesce("item_id", F.lit(0)).alias("item_id"), F.col("item_id").isNull().alias("no_id"), "text")
    rows = base.mapInPandas(cut_words, "item_id long, no_id boolean, text string, n int, length int, terms array<string>").where("n > 0")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "items")
    n, mean = rows.agg(F.count(F.lit(1)), F.avg("n")).first()
    each = rows.select("row", F.posexplode("terms").alias("at", "term"))
    df = stored(each.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "item-terms")  # written, so that Spark can split a hot term's join
    dfs = each.join(df, "term").groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "df"))), lambda x: x["df"]).alias("dfs"))
    item_id = F.when(~F.col("no_id"), F.col("item_id")).alias("item_id")
    return stored(rows.join(dfs, "row").select(item_id, "text", "n", "length", "terms", "dfs"), "items-sized"), n, mean or 0.0


def scans(items: DataFrame, pass_items: int = PASS_ITEMS, block: int = BLOCK) -> Iterator[list[dict]]:
    """The indexes of each scan over the training text: about ``pass_items`` items on the driver at a time."""
    table, n, mean = sized(items)
    jobs = []
    for r in sorted(table.groupBy("length").count().collect()):
        parts = -(-r["count"] // pass_items)
        jobs += [(r["length"], p, 2 * parts if parts > 1 else 1, -(-r["count"] // (2 * parts if parts > 1 else 1))) for p in range(2 * parts if parts > 1 else 1)]
    held, size = [], 0
    for length, p, parts, about in jobs:
        if held and size + about > pass_items:
            yield held
            held, size = [], 0
        deal = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
        got = table.where((F.col("length") == length) & (deal == p)).collect()
        if got:
            rows = sorted(((x["item_id"], x["text"]) for x in got), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
            held.append(build(rows, length, block, {t: d for x in got for t, d in zip(x["terms"], x["dfs"])}, n, mean))
            size += len(got)
    if held:
        yield held


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP, block: int = BLOCK,
            pass_items: int = PASS_ITEMS) -> DataFrame:
    """``(doc_id, item_id, score, question_overlap, answer_overlap)``: each document's best passage per item."""
    doc_id = col(id_col).cast("long")
    base = docs.select(F.coalesce(doc_id, F.lit(0)).alias("doc_id"), doc_id.isNull().alias("no_id"), text_of(text_col).alias("text"))
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    tests = items.select(col(item_col).cast("long").alias("item_id"), text_of(item_text).alias("text"))
    found = []
    for indexes in scans(tests, pass_items, block):
        shared = docs.sparkSession.sparkContext.broadcast(indexes)

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                rows = []
                for at in _slices(pdf["text"]):
                    part = pdf.iloc[at]
                    ids, none, texts = part["doc_id"].tolist(), part["no_id"].tolist(), part["text"].tolist()
                    for index in shared.value:
                        rows += [(ids[d], none[d], index["items"][i], s, q, a) for d, i, s, q, a in search(index, texts, threshold, overlap)]
                out = pd.DataFrame(rows, columns=["doc_id", "no_id", "item_id", "score", "question_overlap", "answer_overlap"])
                yield out.astype({"doc_id": "int64", "no_id": "bool", "item_id": "Int64"})

        found.append(stored(base.mapInPandas(run, "doc_id long, no_id boolean, " + schema.split(", ", 1)[1]), "leaks"))
        shared.unpersist()
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    best = F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("m")
    rows = union_all(found).withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id")))
    return rows.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "m.*")


def _slices(texts: pd.Series, max_chars: int = 2_000_000) -> Iterator[slice]:
    """Runs of whole texts of about ``max_chars`` characters (bounded memory per search)."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= max_chars:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _hit_udf(shared, threshold: float, overlap: float):
    @F.pandas_udf("boolean")
    def hit(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            out = np.zeros(len(s), dtype=bool)
            for at in _slices(s):
                for index in shared.value:
                    for d, *_ in search(index, s.iloc[at].tolist(), threshold, overlap):
                        out[at.start + d] = True
            yield pd.Series(out)
    return hit


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
          threshold: float = THRESHOLD, overlap: float = OVERLAP, block: int = BLOCK,
          pass_items: int = PASS_ITEMS) -> DataFrame:
    """``docs`` without the contaminated documents; every column as it was, no shuffle.

    One scan filters as it reads; with more, what a scan keeps is written for the next.
    """
    tests = items.select(col(item_col).cast("long").alias("item_id"), text_of(item_text).alias("text"))
    flag, shared = fresh(docs, "dirty"), None
    for indexes in scans(tests, pass_items, block):
        if shared is not None:
            docs = stored(docs, "clean")
            shared.unpersist()
        shared = docs.sparkSession.sparkContext.broadcast(indexes)
        docs = docs.withColumn(flag, _hit_udf(shared, threshold, overlap)(text_of(text_col))).where(~F.col(flag)).drop(flag)
    return docs
