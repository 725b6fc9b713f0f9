"""Quality classifier: a byte-level convolutional network in numpy.

A text is its UTF-8 bytes. ``n_filters`` learned filters of ``width`` bytes slide over
overlapping chunks (``stride`` positions each, reading ``width - 1`` bytes into the same text's next
chunk) that cover the whole document; behind its end a text has padding symbols of its own, and positions that
start in padding do not compete. So a score is a function of the text and the model alone: equal texts have
bit-equal scores in any batch, order or partitioning. A filter's response is the sum of learned per-byte,
per-offset weights; each chunk keeps the largest response (max-pool, ReLU). A document's
features are the mean and the maximum of its chunks' pooled responses; one logistic unit
combines them into a probability. No other column is an input.

Training runs on a bounded sample of the labelled documents: at most ``max_rows`` rows (half of
them per class) and ``max_bytes`` bytes (half per class, and what the other class leaves), in the
order of a hash of the id, weighted back to the class shares of all learnable labels. A text that
does not fit is passed over and later ones are taken; the shortest text seen of a class of which none
fits is taken all the same. Gradients reach a filter through its arg-max positions.
Scoring runs over every document in Spark tasks; the model is about 100 KB.

Defined results: null or empty text is scored as one chunk with one position, all padding; a label that is null or not
0/1 is ignored, contradicting labels of an id count by their mean (a tie is 1); a null id is held
out; repeated rows are scored each; with labels of fewer than two classes every text gets the
same score (the label share; 0.5 without labels); empty tables give empty results; other columns
are not read (``keep_good`` returns them unchanged).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, fresh, text_of

FOLDS, THRESHOLD = 5, 0.3  # fixed values of the contract
PAD = 256  # byte value of padding


@dataclass
class ByteCnn:
    """``table`` (width, 257, filters), ``bias`` (filters), ``out`` (2 * filters), ``intercept``; ``constant`` if not trained."""

    table: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    intercept: float
    stride: int
    constant: float | None = None

    @property
    def width(self) -> int:
        return self.table.shape[0]

    def chunks(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The symbols of every chunk (one row each, padded), the chunk count of each text, and the positions that count in each chunk."""
        s, over = self.stride, self.width - 1
        counts = np.array([max(1, -(-len(t) // s)) for t in texts])
        flat = np.full(int(counts.sum()) * s + len(texts) * over, PAD, dtype=np.int16)  # every text is followed by padding of its own
        starts = np.cumsum(counts * s + over) - (counts * s + over)
        for t, at in zip(texts, starts.tolist()):
            flat[at:at + len(t)] = np.frombuffer(t, np.uint8)
        nth = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        first = np.repeat(starts, counts) + nth * s
        symbols = np.lib.stride_tricks.sliding_window_view(flat, s + over)[first]
        lengths = np.array([max(1, len(t)) for t in texts])
        return symbols, counts, np.minimum(np.repeat(lengths, counts) - nth * s, s)

    def responses(self, symbols: np.ndarray) -> np.ndarray:
        """Filter responses at every position of the given chunks."""
        symbols, s = symbols.astype(np.intp), self.stride
        out = np.take(self.table[0], symbols[:, :s], axis=0)
        buf = np.empty_like(out)
        for j in range(1, self.width):
            np.take(self.table[j], symbols[:, j:j + s], axis=0, out=buf, mode="clip")
            out += buf
        return out

    def pooled(self, symbols: np.ndarray, valid: np.ndarray, where: bool = False, step: int = 512):
        """Max response per chunk (and, with ``where``, its position), a bounded number of chunks at a time."""
        n, k, s = len(symbols), self.table.shape[2], self.stride
        best, pos = np.empty((n, k), np.float32), np.empty((n, k), np.int64) if where else None
        for c in range(0, n, step):
            d = min(n, c + step)
            r = self.responses(symbols[c:d])
            short = np.flatnonzero(valid[c:d] < s)  # text ends
            if len(short):
                r[short] = np.where((np.arange(s) < valid[c:d][short][:, None])[:, :, None], r[short], -np.inf)
            if where:
                pos[c:d] = r.argmax(axis=1)
                best[c:d] = np.take_along_axis(r, pos[c:d][:, None, :], axis=1)[:, 0]
            else:
                r.max(axis=1, out=best[c:d])
        return (best, pos) if where else best

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        if not texts:
            return np.empty(0)
        symbols, counts, valid = self.chunks(texts)
        h = np.maximum(self.pooled(symbols, valid) + self.bias, 0).astype(np.float64)
        z, at = np.empty(len(texts)), 0
        for i, n in enumerate(counts.tolist()):  # text by text: no sum depends on what else is in the batch
            mine = np.ascontiguousarray(h[at:at + n].T)
            feats = np.concatenate((mine.sum(axis=1) / n, mine.max(axis=1)))
            z[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, float((feats * self.out).sum()) + self.intercept))))
            at += n
        return z


def train(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, n_filters: int = 16, width: int = 6,
          stride: int = 128, epochs: int = 6, batch: int = 64, rate: float = 0.02, min_steps: int = 300, seed: int = 42) -> ByteCnn:
    """Fit with Adam on the weighted log loss; a fixed seed and order make it repeatable.

    A small sample is passed more often, until ``min_steps`` steps are made.
    """
    if len(texts) == 0 or len(set(labels.tolist())) < 2:
        share = float(np.average(labels, weights=weights)) if len(texts) else 0.5
        return ByteCnn(np.zeros((width, PAD + 1, n_filters), np.float32), np.zeros(n_filters, np.float32),
                       np.zeros(2 * n_filters, np.float32), 0.0, stride, share)
    epochs = max(epochs, -(-min_steps * batch // len(texts)))
    rng = np.random.default_rng(seed)
    model = ByteCnn(rng.normal(0, 0.3, (width, PAD + 1, n_filters)).astype(np.float32), np.zeros(n_filters, np.float32),
                    rng.normal(0, 0.1, 2 * n_filters).astype(np.float32), 0.0, stride)
    params = [model.table, model.bias, model.out, np.zeros(1, np.float32)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    turn, k = 0, n_filters
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            ids = order[at:at + batch]
            symbols, counts, valid = model.chunks([texts[i] for i in ids])
            best, pos = model.pooled(symbols, valid, where=True)
            pre = best + model.bias
            h = np.maximum(pre, 0)
            starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
            mean, top = np.add.reduceat(h, starts, axis=0) / counts[:, None], np.maximum.reduceat(h, starts, axis=0)
            feats = np.hstack([mean, top])
            z = np.clip(feats @ model.out + params[3][0], -30, 30)
            err = ((1 / (1 + np.exp(-z)) - labels[ids]) * weights[ids] / len(ids)).astype(np.float32)
            doc = np.repeat(np.arange(len(ids)), counts)
            g = (err[doc] / counts[doc])[:, None] * model.out[:k]
            is_top = h >= top[doc]
            share = is_top / np.add.reduceat(is_top, starts, axis=0)[doc]
            g = np.where(pre > 0, g + err[doc][:, None] * model.out[k:] * share, 0).astype(np.float32)
            g_table = np.empty_like(model.table)
            cols = np.broadcast_to(np.arange(k), pos.shape)
            for j in range(width):
                cell = np.take_along_axis(symbols, pos + j, axis=1).astype(np.int64) * k + cols
                g_table[j] = np.bincount(cell.ravel(), g.ravel(), (PAD + 1) * k).reshape(PAD + 1, k)
            turn += 1
            step = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            for p, grad, (m, v) in zip(params, [g_table, g.sum(0), feats.T @ err + 1e-4 * model.out, np.array([err.sum()])], moments):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                p -= step * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.999 ** turn)) + 1e-8)
    model.intercept = float(params[3][0])
    return model


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo the number of folds (fold 0 is held out; so is a null id)."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string")), F.lit(FOLDS)), F.lit(0))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        max_rows: int = 4000, max_bytes: int = 24_000_000, **options) -> ByteCnn:
    """Train on a bounded sample of the learnable labels (see the module text)."""
    known = (labels.select(col(id_col).alias("id"), col(label_col).cast("int").alias("y"))
             .where(F.col("y").isin(0, 1) & (fold(F.col("id")) != 0))
             .groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("y")))
    shares = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    text_rows = docs.select(col(id_col).alias("id"), text_of(text_col).alias("text"))

    def of(sample: list[tuple]) -> DataFrame:
        few = docs.sparkSession.createDataFrame(sample, known.schema)
        rows = (text_rows.join(F.broadcast(few), "id")  # at most max_rows small rows
                .groupBy("id").agg(F.min("text").alias("text"), F.first("y").alias("y"), F.xxhash64(F.first("id")).alias("h")))
        return rows.withColumn("n", F.octet_length("text"))

    # the byte bound is settled on lengths before any text is collected
    half, room, after = max_rows // 2, {}, {}
    taken, shortest = {y: [] for y in shares}, {}
    todo = sorted(shares)
    while todo:
        picked = []
        for y in todo:  # at most max_rows / 2 ids of each class: the next ones by hash, a bounded top-n
            more = known.where(F.col("y") == y).withColumn("h", F.xxhash64("id"))
            if y in after:
                h, i = after[y]
                more = more.where((F.col("h") > F.lit(h)) | (F.col("h") == F.lit(h)) & (F.col("id") > F.lit(i)))
            new = more.orderBy("h", "id").limit(half - len(taken[y])).collect()
            if new:
                after[y] = new[-1]["h"], new[-1]["id"]
            else:
                after.pop(y, None)
            picked += [(r["id"], y) for r in new]
        if not picked:
            break
        got = sorted(of(picked).select("id", "n", "h", "y").collect(), key=lambda r: (r["h"], r["id"]))
        if not room:  # half of the bytes for each class, and what the other class leaves
            need = {y: sum(r["n"] for r in got if r["y"] == y) for y in (0, 1)}
            room = {y: max(max_bytes // 2, max_bytes - need[1 - y]) for y in (0, 1)}
            full = {y: room[y] // 2 for y in room}
        for r in got:  # a row that does not fit makes way for the next ones
            y = r["y"]
            if r["n"] <= room[y]:
                room[y] -= r["n"]
                taken[y].append(r["id"])
            shortest[y] = min(shortest.get(y, (r["n"], r["id"])), (r["n"], r["id"]))
        todo = [y for y in todo if y in after and len(taken[y]) < half and room[y] > full[y]]
    for y in shortest:  # a class whose every row is beyond the bound is still learnt
        taken[y] = taken[y] or [shortest[y][1]]
    ids = [(i, y) for y in sorted(taken) for i in taken[y]]
    if not ids:
        return train([], np.empty(0), np.empty(0), **options)
    got = sorted(of(ids).select("id", "text", "y", "h").collect(), key=lambda r: (r["h"], r["id"]))
    y = np.array([r["y"] for r in got], dtype=np.float32)
    n_all = sum(shares.values())
    weight = {c: (shares[c] / n_all) / max((y == c).mean(), 1e-9) for c in shares}
    return train([r["text"].encode("utf-8", "surrogatepass") for r in got], y,
                 np.array([weight[int(v)] for v in y], dtype=np.float32), **options)


def score_udf(model: ByteCnn, max_bytes: int = 4_000_000):
    """Arrow function text -> probability; a batch is scored about ``max_bytes`` at a time, every text whole."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            out, group, size = [], [], 0
            for t in s:
                b = t.encode("utf-8", "surrogatepass")
                group.append(b)
                size += len(b)
                if size >= max_bytes:
                    out.append(model.score(group))
                    group, size = [], 0
            out.append(model.score(group))
            yield pd.Series(np.concatenate(out), dtype="float64")
    return score


def classify(docs: DataFrame, model: ByteCnn, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row."""
    s = docs.select(col(id_col).alias("doc_id"), score_udf(model)(text_of(text_col)).alias("score"))
    return s.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: ByteCnn, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows the model rejects; every column as it was."""
    s = fresh(docs, "score")
    return docs.withColumn(s, score_udf(model)(text_of(text_col))).where(F.col(s) >= threshold).drop(s)
