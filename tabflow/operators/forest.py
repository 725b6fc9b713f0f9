"""A random forest grown on packed blocks of bins, for stacks that fit many forests.

``RandomForestClassifier`` looks at its rows one by one, each of them as a JVM object with a bootstrap count and a cached
node id a tree; a stack of several forests spends its time and memory there. ``fit_forest`` grows the same kind of forest
from the same settings (every row, every tree, every level, the same split rule) on columns of bins and returns Spark's own
``RandomForestClassificationModel``:

* bin edges come from Spark's rule (all midpoints of a feature with few values, else equal shares of the sample it takes);
* rows become packed blocks of bins and labels, a byte a feature, which are kept for all levels;
* a row's bootstrap count is drawn anew from (seed, tree, block) at every level, so no count and no node id is stored;
* one Spark job a level: every task sums label counts per (node, feature, bin) of all trees over its blocks, the sums of a
  tree meet in one task that picks its splits, and only the splits reach the driver.

Settings it does not know (weights, other impurities or sampling rates, more classes than two) are left to Spark's learner.
"""

from __future__ import annotations

import math
import threading
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import qcol
from ..session import scratch_path

BLOCK_ROWS = 1 << 16  # rows of a block, about: its columns stay in the processor's cache while all trees read them
HIST_BYTES = 256 << 20  # label counts that a task holds; larger forests are left to Spark's learner, which grows them in parts


def edges_of(values: np.ndarray, max_bins: int) -> np.ndarray:
    """Spark's thresholds of a continuous feature: at or below a threshold goes left."""
    v, n = np.unique(values[~np.isnan(values)], return_counts=True)
    if len(v) < 2:
        return np.empty(0)
    mid = (v[:-1] + v[1:]) / 2
    if len(mid) <= max_bins - 1:
        return mid
    stride = n.sum() / max_bins
    cuts, upto, goal = [], np.cumsum(n), stride
    for i in range(len(mid)):
        if abs(upto[i] - goal) < abs(upto[i + 1] - goal):
            cuts.append(mid[i])
            goal += stride
    return np.array(cuts)


def bins_of(x: np.ndarray, edges: list[np.ndarray | None]) -> np.ndarray:
    """Bins as (features, rows); a categorical feature (no edges) is its own bin. A missing value is the highest bin."""
    out = np.empty(x.shape[::-1], dtype=np.uint8)
    for f, e in enumerate(edges):
        out[f] = x[:, f] if e is None else np.searchsorted(e, x[:, f], side="left")
    return out


def draws(seed: int, tree: int, block: int, n: int) -> np.ndarray:
    """How often each row of a block is in a tree's bootstrap sample: Poisson counts of mean 1, the same at every call."""
    u = np.random.SFC64([seed % (1 << 63), tree, block]).random_raw((n + 1) // 2).view(np.uint32)[:n]
    out, p, total, k = np.zeros(n, dtype=np.uint8), math.exp(-1.0), 0.0, 0
    while True:
        total += p
        cut = round(total * (1 << 32))
        if cut >= 1 << 32:
            return out
        more = u >= np.uint32(cut)
        if not more.any():
            return out
        out += more.view(np.uint8)
        k += 1
        p /= k


def _gini(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    n = np.maximum(n0 + n1, 1.0)  # counts are whole numbers
    return np.where(n0 + n1 > 0, 1 - (n0 * n0 + n1 * n1) / (n * n), 0.0)


def best_splits(hist: np.ndarray, categorical: np.ndarray, min_rows: int, min_gain: float) -> tuple[np.ndarray, ...]:
    """Of each node's ``hist`` (nodes, slots, bins, 2 labels) the best split: gain (0 if none), slot, bins that go left, left's labels."""
    nodes, slots, bins, _ = hist.shape
    rows = hist.sum(axis=3)
    # ordered by the share of label 1, bins of a category can be cut in one place; empty ones come last
    share = np.where(rows > 0, hist[..., 1] / np.maximum(rows, 1), np.inf)
    order = np.where(categorical[..., None], np.argsort(share, axis=2, kind="stable"), np.arange(bins))
    left = np.cumsum(np.take_along_axis(hist, order[..., None], axis=2), axis=2)[:, :, :-1]
    total = hist.sum(axis=2, keepdims=True)
    right = total - left
    nl, nr, n = left.sum(axis=3), right.sum(axis=3), np.maximum(total.sum(axis=3), 1)
    gain = _gini(total[..., 0], total[..., 1]) - nl / n * _gini(left[..., 0], left[..., 1]) - nr / n * _gini(right[..., 0], right[..., 1])
    gain[(nl < min_rows) | (nr < min_rows) | (gain < min_gain)] = 0.0
    flat = gain.reshape(nodes, -1)
    at = flat.argmax(axis=1)
    slot, cut = np.divmod(at, max(1, bins - 1))
    here = np.arange(nodes)
    goes = np.zeros((nodes, bins), dtype=bool)
    np.put_along_axis(goes, order[here, slot], np.arange(bins)[None, :] <= cut[:, None], axis=1)
    return flat[here, at], slot, goes, left[here, slot, cut]


class _Grown:
    """A tree while it grows: its nodes, and a routing table a level for the tasks."""

    def __init__(self):
        self.stats, self.split, self.kids = [None], [None], [None]
        self.active, self.levels = [0], []  # node of each place of the level; (feature, next place or -1) of the levels above

    def grow(self, gain, feature, goes, left, total, depth: int, max_depth: int) -> None:
        table, after = np.full(goes.shape, -1, dtype=np.int16), []
        for i, node in enumerate(self.active):
            if self.stats[node] is None:  # the root
                self.stats[node] = total[i]
            if gain[i] <= 0:
                continue
            both, kids = (left[i], self.stats[node] - left[i]), []
            for side, s in zip((goes[i], ~goes[i]), both):
                kids.append(len(self.stats))
                self.stats.append(s)
                self.split.append(None)
                self.kids.append(None)
                if depth + 1 < max_depth and s.min() > 0:  # neither at the last level nor pure
                    table[i, side] = len(after)
                    after.append(kids[-1])
            self.split[node], self.kids[node] = (int(feature[i]), goes[i].copy(), float(gain[i])), kids
        self.levels.append((feature.astype(np.int16), table))
        self.active = after

    def rows(self, tree: int, edges: list, arity: dict[int, int]) -> list[tuple]:
        """Rows of Spark's node table, in pre-order. As there, two leaves of one prediction become one leaf."""
        said = [float(np.argmax(s)) for s in self.stats]
        leaf = [k is None for k in self.kids]
        for node in range(len(self.stats) - 1, -1, -1):  # a child comes after its parent
            if not leaf[node]:
                a, b = self.kids[node]
                leaf[node] = leaf[a] and leaf[b] and said[a] == said[b]
                if leaf[node]:
                    said[node] = said[a]
        out: list[tuple] = []

        def add(node: int) -> int:
            at, s = len(out), self.stats[node]
            head = (at, said[node], float(_gini(s[0], s[1])), [float(v) for v in s], int(s.sum()))
            out.append(())
            if leaf[node]:
                out[at] = (tree, (*head, -1.0, -1, -1, (-1, [], -1)))
                return at
            f, goes, gain = self.split[node]
            if f in arity:
                cut = (f, [float(c) for c in range(arity[f]) if goes[c]], arity[f])
            else:
                cut = (f, [float(edges[f][int(goes.sum()) - 1])], -1)
            kids = [add(k) for k in self.kids[node]]
            out[at] = (tree, (*head, gain, *kids, cut))
            return at

        add(0)
        return out


def _arities(rows: DataFrame, features: str) -> dict[int, int]:
    attrs = rows.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    out = {a["idx"]: 2 for a in attrs.get("binary", [])}
    return out | {a["idx"]: len(a["vals"]) if "vals" in a else a["num_vals"] for a in attrs.get("nominal", []) if "vals" in a or "num_vals" in a}


def _per_node(strategy: str, trees: int, p: int) -> int | None:
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt"
    return {"all": p, "sqrt": math.ceil(math.sqrt(p)), "log2": max(1, math.ceil(math.log2(p))), "onethird": math.ceil(p / 3)}.get(strategy)


class Stub:
    """A model of a learner's settings whose nodes are to be replaced; the forests of one stack share it."""

    def __init__(self):
        self._lock, self._model = threading.Lock(), None

    def of(self, learner: RandomForestClassifier, spark, p: int) -> RandomForestClassificationModel:
        with self._lock:
            if self._model is None:
                x = Vectors.dense([0.0] * p)
                rows = spark.createDataFrame([(x, float(i % 2)) for i in range(64)], ["x", "y"]).coalesce(1)
                self._model = learner.fit(rows.select(F.col("x").alias(learner.getOrDefault("featuresCol")), F.col("y").alias(learner.getOrDefault("labelCol"))))
            return self._model


def fit_forest(learner: RandomForestClassifier, rows: DataFrame, stub: Stub | None = None) -> RandomForestClassificationModel:
    """``learner`` fitted on ``rows`` (``dealt`` in even parts) through packed blocks, or by Spark where its settings are not known here.

    Fits of the same settings and features may share a ``stub``."""
    get = learner.getOrDefault
    features, label, trees, max_depth = get("featuresCol"), get("labelCol"), get("numTrees"), get("maxDepth")
    plain = (get("impurity") == "gini" and get("minWeightFractionPerNode") == 0.0 and not learner.isSet("weightCol")
             and get("subsamplingRate") == 1.0 and get("maxBins") <= 256 and max_depth > 0)
    if not plain:
        return learner.fit(rows)
    pairs = rows.select(vector_to_array(features).alias("x"), qcol(label).cast("double").alias("y"))
    n_of = {r["y"]: r["count"] for r in pairs.groupBy("y").count().collect()}
    if set(n_of) != {0.0, 1.0}:
        return learner.fit(rows)
    n, arity, seed = sum(n_of.values()), _arities(rows, features), get("seed")
    max_bins = min(get("maxBins"), n)
    wanted = max(max_bins * max_bins, 10_000)  # the rows Spark takes bin edges from
    some = np.array([r["x"] for r in (pairs if wanted >= n else pairs.sample(False, wanted / n, seed)).select("x").collect()])
    p = some.shape[1] if len(some) else 0
    m = _per_node(get("featureSubsetStrategy"), trees, p) if p else None
    if not m or max(arity.values(), default=0) > max_bins or trees * 2 ** (max_depth - 1) * m * max_bins * 16 > HIST_BYTES:
        return learner.fit(rows)
    edges = [None if f in arity else edges_of(some[:, f], max_bins) for f in range(p)]
    n_bins = max(2, *(arity[f] if e is None else len(e) + 1 for f, e in enumerate(edges)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block():
            x, y = np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held])
            for f, k in arity.items():
                if not ((x[:, f] >= 0) & (x[:, f] < k) & (x[:, f] == np.floor(x[:, f]))).all():
                    raise ValueError(f"feature {f} holds a value outside its {k} categories")
            return pa.RecordBatch.from_pydict({"n": pa.array([len(y)], pa.int32()), "bins": [bins_of(x, edges).tobytes()], "y": [y.astype(np.uint8).tobytes()]})

        held, size = [], 0
        for b in batches:
            if b.num_rows:
                held.append((b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, p), b.column(1).to_numpy(zero_copy_only=False)))
                size += b.num_rows
            if size >= BLOCK_ROWS:
                yield block()
                held, size = [], 0
        if held:
            yield block()

    blocks = pairs.mapInArrow(pack, "n int, bins binary, y binary").withColumn("block", F.monotonically_increasing_id()).persist(StorageLevel.MEMORY_AND_DISK)
    grown = [_Grown() for _ in range(trees)]
    drawn = (seed, get("bootstrap"))
    for depth in range(max_depth):
        todo = [t for t in range(trees) if grown[t].active]
        if not todo:
            break
        chosen = {t: np.random.default_rng([seed % (1 << 63), t, depth]).random((len(grown[t].active), p)).argsort(axis=1)[:, :m].astype(np.int16) for t in todo}
        plan = [(t, grown[t].levels, chosen[t]) for t in todo]
        for r in _level(blocks, plan, drawn, arity, n_bins, get("minInstancesPerNode"), get("minInfoGain")):
            k = len(chosen[r.tree])
            slot = np.frombuffer(r.slot, np.int64)
            grown[r.tree].grow(np.frombuffer(r.gain), chosen[r.tree][np.arange(k), slot], np.frombuffer(r.goes, bool).reshape(k, n_bins),
                               np.frombuffer(r.left).reshape(k, 2), np.frombuffer(r.total).reshape(k, 2), depth, max_depth)
    blocks.unpersist()
    spark = rows.sparkSession
    return _model((stub or Stub()).of(learner, spark, p), spark, [row for t, g in enumerate(grown) for row in g.rows(t, edges, arity)])


def _level(blocks: DataFrame, plan: list, drawn: tuple[int, bool], arity: dict[int, int], n_bins: int, min_rows: int, min_gain: float) -> list:
    """The best split of every node of the level, a row a tree."""

    def look(column: np.ndarray, feature: np.ndarray, node: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        # every place is inside: the modes only leave out numpy's check
        place = (feature * n).take(node, mode="clip")
        place += at
        return column.take(place, mode="wrap")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = [(t, [(f.astype(np.int64), nxt.astype(np.int64).ravel()) for f, nxt in levels], of.astype(np.int64).T.copy()) for t, levels, of in plan]
        sums = [np.zeros((len(of), of.shape[1] * n_bins * 2)) for _, _, of in trees]
        seen = False
        for pdf in batches:
            for r in pdf.itertuples():
                seen = True
                bins = np.frombuffer(r.bins, np.uint8)
                both = (bins.reshape(-1, r.n).astype(np.uint16) * 2 + np.frombuffer(r.y, np.uint8)).ravel()
                for (t, levels, of), total in zip(trees, sums):
                    w = draws(drawn[0], t, r.block, r.n) if drawn[1] else np.ones(r.n, dtype=np.uint8)
                    at = np.flatnonzero(w > 0)
                    node = np.zeros(len(at), dtype=np.int64)
                    for feature, nxt in levels:
                        if len(at):
                            node = nxt.take(node * n_bins + look(bins, feature, node, at, r.n), mode="clip")
                        if len(at) and node.min() < 0:
                            on = np.flatnonzero(node >= 0)
                            node, at = node.take(on), at.take(on)
                    if not len(at):
                        continue
                    times = w.take(at).astype(np.float64)
                    node_at = node * (n_bins * 2)
                    for j, f in enumerate(of):
                        total[j] += np.bincount(look(both, f, node, at, r.n) + node_at, times, total.shape[1])
        if seen:
            yield pd.DataFrame({"tree": [t for t, _, _ in trees], "sums": [s.astype(np.int32).tobytes() for s in sums]})

    slots = {t: of for t, _, of in plan}
    is_cat = np.zeros(1 + max(int(of.max()) for of in slots.values()), dtype=bool)
    is_cat[[f for f in arity if f < len(is_cat)]] = True

    def pick(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        of, total = slots[key[0]], 0
        for s in pdf["sums"]:
            total = total + np.frombuffer(s, np.int32).astype(np.float64)
        hist = total.reshape(of.shape[1], len(of), n_bins, 2).transpose(1, 0, 2, 3)
        gain, slot, goes, left = best_splits(hist, is_cat[of], min_rows, min_gain)
        return pd.DataFrame({"tree": [key[0]], "gain": [gain.tobytes()], "slot": [slot.astype(np.int64).tobytes()], "goes": [goes.tobytes()],
                             "left": [np.ascontiguousarray(left).tobytes()], "total": [np.ascontiguousarray(hist[:, 0].sum(axis=1)).tobytes()]})

    parts = blocks.mapInPandas(count, "tree int, sums binary")
    return parts.groupBy("tree").applyInPandas(pick, "tree int, gain binary, slot binary, goes binary, left binary, total binary").collect()


def _model(stub: RandomForestClassificationModel, spark, nodes: list[tuple]) -> RandomForestClassificationModel:
    """Spark's model with these nodes: the stub is saved, its node table replaced, and loaded."""
    path = scratch_path(spark, f"forests/{stub.uid}-{np.random.default_rng().integers(1 << 62):x}")
    stub.write().save(path)
    schema = spark.read.parquet(f"{path}/data").schema
    spark.createDataFrame(nodes, schema, verifySchema=False).coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)
