"""Substring dedup on sliding sentence spans.

A text is cut into sentences (a full stop, question or exclamation mark followed by white
space ends one; so does a line break). From every sentence starts one span, and at every sentence ends
one: ``run`` consecutive sentences (at least), and as many more as it takes to hold ``min_words`` words
(so that a few one-word sentences are not evidence of copying, and two long ones are). Every sentence of
a repeated passage that large lies in one of the two kinds inside the passage. Sentences are compared lower-cased with single
spaces; a span is its 128-bit hash. Spans are joined globally on the hash: the first
(smallest id, then position) stays, and every sentence covered by any other occurrence is
removed, together with the white space after it.

Plan: one pass emits (hash, id, position) rows; the first of each repeated hash comes from a
map-side combined aggregate; an equi-join marks the others (a span shared by a third of all
documents is a hot join key Spark can split); marks are grouped per document (an id and its
text), whose own length bounds them, and joined back to the texts.

Defined results: null or empty text has no sentences and an empty result text; a text shorter
than one span is kept; repeated rows (id and text) are one document and lose nothing to each other;
rows that share an id but not the text are documents of their own, first by id, then by text hash;
a null id comes first; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .suffix_dedup import keyed

RUN, MIN_WORDS = 2, 20
_END = re.compile(r"(?<=[.!?。！？])\s+|\s*\n\s*")
_BITS = 20  # low bits of a mark that hold the span's sentence count


def sentences(text: str) -> list[tuple[int, int]]:
    """``(start, next start)`` of every sentence; the ranges cover the text from its first sentence on."""
    out, at = [], 0
    for m in _END.finditer(text):
        if m.end() > at:
            if text[at:m.start()].strip():
                out.append((at, m.end()))
                at = m.end()
            elif not out:
                at = m.end()
    if text[at:].strip():
        out.append((at, len(text)))
    return out


def spans(text: str, run: int = RUN, min_words: int = MIN_WORDS) -> list[tuple[int, int, bytes]]:
    """``(first sentence, number of sentences, 128-bit digest)`` of every span of a text."""
    words = [text[a:b].lower().split() for a, b in sentences(text)]
    digests = [xxhash.xxh3_128_digest(" ".join(w).encode("utf-8", "surrogatepass")) for w in words]
    total = np.concatenate(([0], np.cumsum([len(w) for w in words])))
    n = len(words)
    # the smallest end that gives enough sentences and enough words, for every start
    ends = np.maximum(np.arange(n + 1) + run, np.searchsorted(total, total + min_words)).tolist()
    # the largest such start, for every end
    starts = np.minimum(np.arange(n + 1) - run, np.searchsorted(total, total - min_words, "right") - 1).tolist()
    both = {(i, j) for i, j in enumerate(ends) if j <= n} | {(i, j) for j, i in enumerate(starts) if i >= 0}
    return [(i, j - i, xxhash.xxh3_128_digest(b"".join(digests[i:j]))) for i, j in sorted(both)]


def span_rows(base: DataFrame, run: int = RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """``(h1, h2, doc, mark)`` of ``base(doc, text)``: every span's hash; ``mark`` packs the first sentence and the sentence count."""
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            docs, marks, digests = [], [], []
            for i, t in zip(pdf["doc"], pdf["text"]):
                for first, n, d in spans(t, run, min_words):
                    docs.append(i)
                    marks.append(first << _BITS | n)
                    digests.append(d)
            h = np.frombuffer(b"".join(digests), dtype=">i8").astype(np.int64).reshape(-1, 2)
            yield pd.DataFrame({"h1": h[:, 0], "h2": h[:, 1], "doc": np.array(docs, dtype=np.int64),
                                "mark": np.array(marks, dtype=np.int64)})

    return base.select("doc", "text").mapInPandas(emit, "h1 long, h2 long, doc long, mark long")


def repeats(rows: DataFrame) -> DataFrame:
    """``(doc, marks)``: the spans of each document that also occur earlier."""
    first = (rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "mark")).alias("f"))
             .where("n > 1").select("h1", "h2", F.col("f.doc").alias("f_doc"), F.col("f.mark").alias("f_mark")))
    # written first: a join side that is an aggregate on the join's own key would keep Spark from splitting a hot span
    later = rows.join(stored(first, "first-spans"), ["h1", "h2"]).where("doc <> f_doc or mark <> f_mark")
    return later.groupBy("doc").agg(F.collect_set("mark").alias("marks"))


def without(text: str, marks) -> tuple[str, int, int]:
    """The text without the sentences its marks cover, the number of sentences, and how many went."""
    s = sentences(text)
    if marks is None or not len(marks):
        return text, len(s), 0
    gone = np.zeros(len(s) + 1, dtype=np.int64)
    m = np.asarray(marks, dtype=np.int64)
    np.add.at(gone, m >> _BITS, 1)
    np.add.at(gone, (m >> _BITS) + (m & ((1 << _BITS) - 1)), -1)
    out = np.cumsum(gone)[:-1] > 0
    kept = "".join(text[a:b] for (a, b), g in zip(s, out.tolist()) if not g)
    return text[:s[0][0]] + kept, len(s), int(out.sum())


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN,
                min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, n_sentences, n_removed, text)`` for every row."""
    base = keyed(docs, id_col, text_col)
    joined = base.join(repeats(span_rows(base, run, min_words)), "doc", "left").select("doc_id", "text", "marks")

    def cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [without(t, m) for t, m in zip(pdf["text"], pdf["marks"])]
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "n_sentences": [g[1] for g in got],
                                "n_removed": [g[2] for g in got], "text": [g[0] for g in got]})

    return joined.mapInPandas(cut_out, "doc_id long, n_sentences long, n_removed long, text string")
