"""Centroid clustering by dimension-sharded Lloyd rounds in exact integers.

A vector's components x become integers floor(1024 * x). The vectors are laid out by columns: a shard is a
block of ``WIDTH`` dimensions, cut into chunks of rows, and a task only ever sees one shard's columns. A round is

1. every (shard, chunk) computes the exact partial squared distances of its rows to its slice of each centroid;
2. the partial matrices of a chunk are added across shards (reduce by chunk), and the argmin is the assignment
   (ties: the smaller number);
3. the assignment goes back to every shard's chunk, which adds its columns by cluster; the sums are reduced by
   shard, combined per task first, and each shard replaces its own slice by floor(sum / count), keeping the
   slices of empty clusters.

What the driver holds is one slice per shard: clusters x dimensions integers. The vectors are written once and dealt
by chunk once; the rounds' shuffles move packed partial distances (clusters x 8 bytes a row and shard) and labels.

Start: the ``k`` kept vectors with the smallest SHA-256 of ``3:<vec_id>``, in that order (equal ids: by
components; null ids after all others); fewer vectors give fewer centroids.

Defined results: vectors that are null, of another length, or with a null or non-finite component are not kept
and have no row; integers beyond +-2^27 are taken as +-2^27, so that every squared distance fits a long; repeated
rows are vectors of their own; a null id is kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, cut, stored

K, ROUNDS, DIMS, SCALE, SEED_TEXT = 8, 10, 64, 1024, "3:"  # fixed values of the contract
WIDTH = 16  # dimensions of a shard
CHUNK = 4096  # rows of a chunk, at most
LIMIT = 1 << 27


def kept(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``(vec_id, x)``: the usable vectors as integer arrays."""
    v = vectors.select(col(id_col).cast("long").alias("vec_id"), col(vector_col).cast("array<double>").alias("v"))
    good = (F.size("v") == dims) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    whole = F.transform("v", lambda x: F.greatest(F.least(F.floor(F.least(F.greatest(x * scale, F.lit(-2.0 ** 40)), F.lit(2.0 ** 40))),
                                                          F.lit(LIMIT)), F.lit(-LIMIT)).cast("int"))
    return v.where(F.col("v").isNotNull() & F.coalesce(good, F.lit(False))).select("vec_id", whole.alias("x"))


def seeds(points: DataFrame, k: int = K, prefix: str = SEED_TEXT) -> np.ndarray:
    """The starting centroids, one row each (at most ``k`` rows reach the driver)."""
    h = F.sha2(F.concat(F.lit(prefix), F.col("vec_id").cast("string")), 256)
    first = points.orderBy(F.col("vec_id").isNull(), h, "x").select("x").limit(k).collect()
    return np.array([r.x for r in first], dtype=np.int64)


def shards(points: DataFrame, dims: int = DIMS, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """``(shard, chunk, block)`` and ``(chunk, ids)``, written: every chunk's rows as one packed matrix per shard."""
    cuts = list(range(0, dims, width))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), CHUNK):
                part = pdf.iloc[at:at + CHUNK]
                m = np.stack(part["x"].to_list()).astype("<i4")
                out = [(-1, part["vec_id"].to_numpy("<i8").tobytes() + part["no_id"].to_numpy(bool).tobytes())]
                out += [(s, np.ascontiguousarray(m[:, c:c + width]).tobytes()) for s, c in enumerate(cuts)]
                yield pd.DataFrame({"shard": [s for s, _ in out], "n": len(part), "block": [b for _, b in out]})

    packed = points.select(F.coalesce("vec_id", F.lit(0)).alias("vec_id"), F.col("vec_id").isNull().alias("no_id"), "x").mapInPandas(pack, "shard int, n int, block binary")
    # a chunk's rows follow each other in one task: its number is that of its first row there
    marked = packed.withColumn("at", F.monotonically_increasing_id())
    table = stored(marked.withColumn("chunk", F.expr("at - (shard + 1)")).drop("at"), "shards")
    return table.where("shard >= 0"), table.where("shard < 0").select("chunk", "n", F.col("block").alias("ids"))


def assign(blocks: DataFrame, slices: list[np.ndarray]) -> DataFrame:
    """``(chunk, best)``: packed labels (int32) and squared distances (int64) of a chunk's rows."""
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for s, n, block in zip(pdf["shard"], pdf["n"], pdf["block"]):
                m = np.frombuffer(block, "<i4").reshape(n, -1).astype(np.int64)
                out.append(np.stack([((m - c) ** 2).sum(axis=1) for c in slices[s]], axis=1).astype("<i8").tobytes())
            yield pd.DataFrame({"chunk": pdf["chunk"], "n": pdf["n"], "part": out})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["n"].iloc[0])
        total = sum(np.frombuffer(p, "<i8") for p in pdf["part"]).reshape(n, -1)
        label = total.argmin(axis=1)
        d = total[np.arange(n), label]
        return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "labels": [label.astype("<i4").tobytes()], "distances": [d.astype("<i8").tobytes()]})

    parts = blocks.select("shard", "chunk", "n", "block").mapInPandas(partial, "chunk long, n int, part binary")
    return parts.groupBy("chunk").applyInPandas(add, "chunk long, labels binary, distances binary")


def updated(blocks: DataFrame, labels: DataFrame, slices: list[np.ndarray]) -> list[np.ndarray]:
    """Every shard's new slice: floor of the mean of its columns by cluster, exact; empty clusters keep theirs."""
    k = len(slices[0])

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        for pdf in batches:
            for s, n, block, label in zip(pdf["shard"], pdf["n"], pdf["block"], pdf["labels"]):
                m = np.frombuffer(block, "<i4").reshape(n, -1).astype(np.int64)
                at = np.frombuffer(label, "<i4")
                mine = held.setdefault(s, np.zeros((k, m.shape[1] + 1), dtype=np.int64))
                np.add.at(mine, at, np.concatenate([m, np.ones((n, 1), dtype=np.int64)], axis=1))
        at = [(s, c, d if d + 1 < mine.shape[1] else -1, int(mine[c, d]))  # -1: the number of rows
              for s, mine in held.items() for c in range(k) for d in range(mine.shape[1])]
        yield pd.DataFrame(at, columns=["shard", "cluster", "dim", "v"])

    parts = blocks.join(labels.select("chunk", "labels"), "chunk").select("shard", "n", "block", "labels").mapInPandas(
        sums, "shard int, cluster int, dim int, v long")
    new = [s.copy() for s in slices]
    found: dict[tuple[int, int], dict[int, int]] = {}
    # clusters x (dimensions + shards) rows; sums as decimals, so no number of vectors overflows them
    for r in parts.groupBy("shard", "cluster", "dim").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect():
        found.setdefault((r.shard, r.cluster), {})[r.dim] = int(r.v)
    for (s, c), sums_of in found.items():
        count = sums_of.pop(-1)
        if count:
            new[s][c] = [sums_of[d] // count for d in range(len(sums_of))]
    return new


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, rounds: int = ROUNDS,
            dims: int = DIMS, width: int = WIDTH) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, cluster, distance)`` per kept vector, and the final centroids (``k`` x ``dims``)."""
    spark = vectors.sparkSession
    points = kept(vectors, id_col, vector_col, dims)
    start = seeds(points, k)
    if not len(start):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, dims), dtype=np.int64)
    blocks, ids = shards(points, dims, width)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # dealt by chunk once: the rounds' joins with the labels find both sides in place (a lost copy is read from the table again)
    blocks = blocks.repartition(tasks, "chunk").persist(StorageLevel.MEMORY_AND_DISK)
    slices = [start[:, c:c + width].copy() for c in range(0, dims, width)]
    for _ in range(rounds):
        new = updated(blocks, assign(blocks, slices), slices)
        if all((a == b).all() for a, b in zip(new, slices)):
            break  # a round that changes nothing repeats itself
        slices = new

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for n, i, label, d in zip(pdf["n"], pdf["ids"], pdf["labels"], pdf["distances"]):
                vec = pd.arrays.IntegerArray(np.frombuffer(i[:8 * n], "<i8").copy(), np.frombuffer(i[8 * n:], dtype=bool).copy())
                yield pd.DataFrame({"vec_id": vec, "cluster": np.frombuffer(label, "<i4"), "distance": np.frombuffer(d, "<i8")})

    last = cut(ids.join(assign(blocks, slices), "chunk").mapInPandas(rows, "vec_id long, cluster int, distance long"))
    blocks.unpersist()
    return last, np.concatenate(slices, axis=1)


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``found`` with the distance sums of its cluster and of all, and the SHA-256 of its final centroid."""
    spark = found.sparkSession
    per = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    rows = [(c, per.get(c, 0), sum(per.values()), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest())
            for c, x in enumerate(centroids.tolist())]
    info = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(info), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
