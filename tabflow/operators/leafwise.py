"""Leaf-wise gradient boosting with early stopping by patience, as Spark jobs.

``GBTClassifier`` grows trees level by level to a depth. Here a tree grows best leaf first to a number of leaves, on
quantised features:

* features become at most ``maxBins`` bins by approximate quantiles (one pass; a missing value is a bin of its own, the
  lowest); rows are written as packed blocks of bins, label and margin;
* one Spark aggregation per growth step: every task routes its rows through the tree so far and sums gradient,
  hessian and count per (wanted leaf, feature, bin); the partial sums are added per (leaf, feature) and only these small
  tables reach the driver. A step splits the ``leavesPerStep`` leaves of highest gain (1: strictly best first), and only
  the smaller child of each split is summed, its sibling is the parent less it;
* no row, gradient or margin ever leaves the executors; every ``rewriteEvery`` rounds the blocks are written anew with their
  margins, so a round routes rows through a few trees at most and a lost executor recomputes no more than that;
* the validation fold (``validationIndicatorCol``, rows of the training split) is scored by exact AUC at every rewriting;
  boosting stops when the AUC has not risen for ``patience`` rounds, and the trees of the best round are kept.

Sums are added in block order, so a refit on the same partitions gives the same trees.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasStepSize, HasValidationIndicatorCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import qcol
from ..session import scratch_path
from .metrics import auc_by_group

BLOCK = "n int, bins binary, y binary, fold binary, margin binary"


def quantise(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin numbers (rows, features): 0 for a missing value, else 1 + the edges at or below the value."""
    out = np.empty(x.shape, dtype=np.uint8)
    for f, e in enumerate(edges):
        out[:, f] = np.where(np.isnan(x[:, f]), 0, 1 + np.searchsorted(e, x[:, f], side="right"))
    return out


class Tree:
    """Nodes as arrays; a node without a left child is a leaf with its value."""

    def __init__(self):
        self.feature, self.bin, self.left, self.right, self.value = [0], [0], [-1], [-1], [0.0]

    def split(self, node: int, feature: int, at: int) -> tuple[int, int]:
        kids = len(self.left), len(self.left) + 1
        self.feature[node], self.bin[node], self.left[node], self.right[node] = feature, at, *kids
        for c in (self.feature, self.bin):
            c += [0, 0]
        for c in (self.left, self.right):
            c += [-1, -1]
        self.value += [0.0, 0.0]
        return kids

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row: bins at or below a node's bin go left."""
        at = np.zeros(len(bins), dtype=np.int64)
        left, right, feature, cut = (np.array(c) for c in (self.left, self.right, self.feature, self.bin))
        while True:
            inner = np.flatnonzero(left[at] >= 0)
            if not len(inner):
                return at
            node = at[inner]
            at[inner] = np.where(bins[inner, feature[node]] <= cut[node], left[node], right[node])

    def state(self) -> list:
        return [self.feature, self.bin, self.left, self.right, self.value]

    @classmethod
    def of(cls, state: list) -> "Tree":
        t = cls()
        t.feature, t.bin, t.left, t.right, t.value = state
        return t


def _margins(trees: list[list], bins: np.ndarray, base: np.ndarray) -> np.ndarray:
    out = base.copy()
    for s in trees:
        t = Tree.of(s)
        out += np.array(t.value)[t.leaves(bins)]
    return out


def best_split(hist: np.ndarray, min_rows: int, reg: float) -> tuple[float, int, int]:
    """``(gain, feature, bin)`` of the best split of a leaf's ``hist`` (features, bins, [gradient, hessian, rows]); gain 0 if none."""
    left = np.cumsum(hist, axis=1)[:, :-1]
    total = hist.sum(axis=1, keepdims=True)
    right = total - left
    score = lambda s: s[..., 0] ** 2 / (s[..., 1] + reg)
    gain = score(left) + score(right) - score(total)
    gain[(left[..., 2] < min_rows) | (right[..., 2] < min_rows)] = 0.0
    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
    return float(gain[f, b]), int(f), int(b)


class _LeafwiseParams(HasFeaturesCol, HasLabelCol, HasMaxIter, HasStepSize, HasValidationIndicatorCol):
    numLeaves = Param(Params._dummy(), "numLeaves", "leaves of a tree, at most", typeConverter=TypeConverters.toInt)
    patience = Param(Params._dummy(), "patience", "rounds without a higher validation AUC before boosting stops", typeConverter=TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature, at most (up to 255)", typeConverter=TypeConverters.toInt)
    minRows = Param(Params._dummy(), "minRows", "rows of a leaf, at least", typeConverter=TypeConverters.toInt)
    reg = Param(Params._dummy(), "reg", "L2 term of leaf values", typeConverter=TypeConverters.toFloat)
    leavesPerStep = Param(Params._dummy(), "leavesPerStep", "leaves split in one growth step (1: strictly best first)", typeConverter=TypeConverters.toInt)
    rewriteEvery = Param(Params._dummy(), "rewriteEvery", "rounds between writings of the margins", typeConverter=TypeConverters.toInt)


class LeafwiseClassifier(Estimator, _LeafwiseParams, DefaultParamsReadable, DefaultParamsWritable):
    """Binary classifier; defaults are the settings the hooks of the reference use (500 rounds, 63 leaves, patience 50)."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="target", maxIter=500, stepSize=0.05, validationIndicatorCol=None, numLeaves=63,
                 patience=50, maxBins=64, minRows=20, reg=1.0, leavesPerStep=8, rewriteEvery=5):
        super().__init__()
        self._set(**{k: v for k, v in {**dict(maxIter=500, stepSize=0.05, numLeaves=63, patience=50, maxBins=64, minRows=20, reg=1.0, leavesPerStep=8,
                                              rewriteEvery=5, featuresCol="features", labelCol="target"), **self._input_kwargs}.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "LeafwiseModel":
        get = self.getOrDefault
        flag = qcol(get("validationIndicatorCol")) if self.isSet("validationIndicatorCol") else F.lit(False)
        rows = dataset.select(vector_to_array(get("featuresCol")).alias("x"), qcol(get("labelCol")).cast("int").alias("y"), flag.cast("boolean").alias("fold"))
        spark = dataset.sparkSession
        first = rows.select(F.size("x").alias("p")).first()
        if first is None:
            raise ValueError("no training rows")
        p, n_bins = first["p"], get("maxBins")
        wide = rows.select(*[F.col("x")[i].alias(f"f{i}") for i in range(p)])
        probs = [i / n_bins for i in range(1, n_bins)]
        wide = wide.select(*[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in wide.columns])
        edges = [np.unique(np.array(q, dtype=np.float64)) for q in wide.approxQuantile(wide.columns, probs, 0.25 / n_bins)]
        counts = {(r["fold"], r["y"]): r["n"] for r in rows.groupBy("fold", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
        n1, n0 = counts.get((False, 1), 0), counts.get((False, 0), 0)
        base = float(np.log((n1 + 0.5) / (n0 + 0.5)))
        held = any(f for f, _ in counts)

        def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                x = np.stack(pdf["x"].to_list()) if len(pdf) else np.empty((0, p))
                yield pd.DataFrame({"n": [len(pdf)], "bins": [quantise(x, edges).tobytes()], "y": [pdf["y"].to_numpy(np.uint8).tobytes()],
                                    "fold": [pdf["fold"].to_numpy(bool).tobytes()], "margin": [np.full(len(pdf), base).tobytes()]})

        folder, round_ = scratch_path(spark, f"leafwise/{self.uid}-{np.random.default_rng().integers(1 << 62):x}"), 0
        blocks = _written(rows.mapInPandas(pack, BLOCK).withColumn("block", F.monotonically_increasing_id()), f"{folder}/0")
        trees, recent, best = [], [], (-1.0, 0)
        while len(trees) < get("maxIter"):
            tree = self._tree(blocks, recent, p, n_bins + 1)
            if tree is None:  # no leaf can be split any more
                break
            trees.append(tree.state())
            recent.append(trees[-1])
            if len(recent) >= get("rewriteEvery") or len(trees) == get("maxIter"):
                round_ += 1
                blocks = _written(_advanced(blocks, recent, p), f"{folder}/{round_}")
                recent = []
                if held:
                    auc = _fold_auc(blocks)
                    best = max(best, (auc, -len(trees)))  # of equal AUCs the fewer trees
                    if len(trees) + best[1] >= get("patience"):
                        break
        kept = -best[1] if held and best[1] else len(trees)
        m = LeafwiseModel()
        m._set(featuresCol=get("featuresCol"), model=json.dumps({"base": base, "edges": [e.tolist() for e in edges], "trees": trees[:kept], "tried": len(trees)}))
        return m

    def _tree(self, blocks: DataFrame, recent: list, p: int, n_bins: int) -> Tree | None:
        get = self.getOrDefault
        tree, reg, min_rows = Tree(), get("reg"), get("minRows")
        hist = {0: _histograms(blocks, recent, tree, [0], p, n_bins)[0]}
        sums = {0: hist[0][0].sum(axis=0)}
        leaves = 1
        while True:
            gains = sorted(((-g, leaf, f, b) for leaf, h in hist.items() for g, f, b in [best_split(h, min_rows, reg)] if g > 1e-9))
            todo = gains[:min(get("leavesPerStep"), get("numLeaves") - leaves)]
            if not todo:
                break
            small = {}
            for _, leaf, f, b in todo:
                a, c = tree.split(leaf, f, b)
                sums[a] = hist[leaf][f, :b + 1].sum(axis=0)
                sums[c] = sums.pop(leaf) - sums[a]
                small[a if sums[a][2] <= sums[c][2] else c] = (hist.pop(leaf), c if sums[a][2] <= sums[c][2] else a)
                leaves += 1
            if leaves >= get("numLeaves"):
                break  # values need the sums only
            got = _histograms(blocks, recent, tree, list(small), p, n_bins)
            for (leaf, (parent, other)), h in zip(small.items(), got):
                hist[leaf], hist[other] = h, parent - h
        if leaves == 1:
            return None
        for leaf, (g, h, _) in sums.items():
            tree.value[leaf] = float(-g / (h + reg) * get("stepSize"))
        return tree


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _open(r, p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(r.bins, np.uint8).reshape(r.n, p), np.frombuffer(r.y, np.uint8), np.frombuffer(r.fold, bool), np.frombuffer(r.margin, np.float64))


def _advanced(blocks: DataFrame, recent: list, p: int) -> DataFrame:
    """The blocks with the trees since the last writing added to their margins."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            margins = []
            for r in pdf.itertuples():
                bins, _, _, margin = _open(r, p)
                margins.append(_margins(recent, bins, margin).tobytes())
            yield pdf.assign(margin=margins)
    return blocks.mapInPandas(run, blocks.schema)


def _histograms(blocks: DataFrame, recent: list, tree: Tree, wanted: list[int], p: int, n_bins: int) -> list[np.ndarray]:
    """``(features, bins, [gradient, hessian, rows])`` of each wanted leaf, over the rows outside the validation fold."""
    state = tree.state()

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, at = np.zeros((len(wanted), p, n_bins, 3)), None
        t, slot = Tree.of(state), np.full(len(state[0]), -1)
        slot[wanted] = np.arange(len(wanted))
        for pdf in batches:
            for r in pdf.itertuples():
                at = r.block if at is None else min(at, r.block)
                bins, y, fold, margin = _open(r, p)
                bins, y, margin = bins[~fold], y[~fold], margin[~fold]
                mine = slot[t.leaves(bins)]
                here = mine >= 0
                bins, y, margin, mine = bins[here], y[here], margin[here], mine[here]
                q = 1 / (1 + np.exp(-_margins(recent, bins, margin)))
                for f in range(p):
                    cell = mine * n_bins + bins[:, f]
                    for k, w in enumerate((q - y, q * (1 - q), None)):
                        total[:, f, :, k] += np.bincount(cell, w, len(wanted) * n_bins).reshape(len(wanted), n_bins)
        if at is not None:
            yield pd.DataFrame({"slot": np.repeat(np.arange(len(wanted)), p), "feature": np.tile(np.arange(p), len(wanted)), "at": at,
                                "h": [total[s, f].tobytes() for s in range(len(wanted)) for f in range(p)]})

    def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        parts = pdf.sort_values("at")["h"]  # in block order: sums do not depend on which task came first
        return pd.DataFrame({"slot": [key[0]], "feature": [key[1]], "h": [sum(np.frombuffer(h, np.float64) for h in parts).tobytes()]})

    parts = blocks.mapInPandas(partial, "slot int, feature int, at long, h binary")
    out = [np.zeros((p, n_bins, 3)) for _ in wanted]
    for r in parts.groupBy("slot", "feature").applyInPandas(add, "slot int, feature int, h binary").collect():  # leaves x features small tables
        out[r.slot][r.feature] = np.frombuffer(r.h, np.float64).reshape(n_bins, 3)
    return out


def _fold_auc(blocks: DataFrame) -> float:
    """Exact AUC of the validation fold at the margins written."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                y, fold, margin = np.frombuffer(r.y, np.uint8), np.frombuffer(r.fold, bool), np.frombuffer(r.margin, np.float64)
                yield pd.DataFrame({"model_id": "fold", "p1": margin[fold], "target": y[fold].astype(np.int32)})
    got = auc_by_group(blocks.mapInPandas(run, "model_id string, p1 double, target int")).first()
    return -1.0 if got is None or got["auc"] is None else float(got["auc"])


class LeafwiseModel(Model, HasFeaturesCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` (a vector of two) like the library's classifiers."""

    model = Param(Params._dummy(), "model", "edges and trees as JSON", typeConverter=TypeConverters.toString)

    @property
    def trees(self) -> int:
        return len(json.loads(self.getOrDefault("model"))["trees"])

    @property
    def tried(self) -> int:
        """Rounds that were run before boosting stopped."""
        return json.loads(self.getOrDefault("model"))["tried"]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        text = self.getOrDefault("model")

        @F.pandas_udf("double")
        def positive(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            m = json.loads(text)
            edges = [np.array(e) for e in m["edges"]]
            for s in batches:
                x = np.stack(s.to_list()) if len(s) else np.empty((0, len(edges)))
                yield pd.Series(1 / (1 + np.exp(-_margins(m["trees"], quantise(x, edges), np.full(len(s), m["base"])))))

        p1 = positive(vector_to_array(self.getOrDefault("featuresCol")))
        return dataset.withColumn("__p1", p1).withColumn("probability", array_to_vector(F.array(1 - F.col("__p1"), F.col("__p1")))).drop("__p1")
